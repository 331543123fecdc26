"""Edit tables of many pairs of sequences at once, held as bits in arrays.

The step of a column is that of Myers (1999) and Hyyrö (2003) in blocks of 64 rows. A block of a column needs the block above and the
column before, so all blocks of a diagonal are stepped together, for a group of pairs of about the same size: what a step costs in
Python is shared among them. A group's arrays stay within ``ROOM``; pairs without enough company are left to the caller.

A distance needs only the blocks about the diagonal that a path of that many edits can reach (Ukkonen 1985). It is looked for in a band that
is widened until the cost found is one that the band allows for, or, if the caller names a limit, until the band is that wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of the columns that are kept for one group, its blocks at most, and the fewest pairs that are worth the calls.
ROOM = 32 << 20
BLOCKS = 4096
FEW = 16
# Numbers up to which a table by number takes the place of a sort.
_TABLE = 1 << 22
OK, SUB, INS, DEL = range(4)


@dataclass
class Sequences:
    """Sequences of numbers, one after another: ``size`` of them from ``start`` in ``codes``."""

    codes: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def picked(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, code) of each item of some sequences."""
        size = self.size[rows]
        row = np.repeat(np.arange(len(rows)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        return row, place, self.codes[self.start[rows][row] + place]


def sequences(codes: np.ndarray, size: np.ndarray) -> Sequences:
    size = size.astype(np.int64)
    return Sequences(codes, np.cumsum(size) - size, size)


def word_sequences(*columns: pa.Array) -> tuple[list[Sequences], pa.Array]:
    """Arrow columns of word lists, in numbers, and the words that these stand for; null lists are empty, null words are a word."""
    flat = [c.flatten().cast(pa.large_string()) for c in columns]
    coded = pa.chunked_array(flat, pa.large_string()).combine_chunks().dictionary_encode(null_encoding="encode") if flat else None
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    codes, out, low = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [], 0
    for column, items in zip(columns, flat):
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        out.append(sequences(codes[low : low + len(items)], size))
        low += len(items)
    return out, coded.dictionary


def text_sequences(*columns: pa.Array) -> list[Sequences]:
    """Arrow columns of texts as their characters, in numbers; null texts are empty."""
    texts, sizes = [], []
    for column in columns:
        column = pc.fill_null(column, "")
        texts.append("".join(column.to_pylist()))
        sizes.append(pc.utf8_length(column).to_numpy(zero_copy_only=False))
    try:
        # Small numbers as they are, in an eighth of the room.
        return [sequences(np.frombuffer(t.encode("latin-1"), np.uint8), s) for t, s in zip(texts, sizes)]
    except UnicodeEncodeError:
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    seen = np.zeros(0x110000, bool)
    for p in points:
        seen[p] = True
    number = np.cumsum(seen) - 1
    return [sequences(number[p], s) for p, s in zip(points, sizes)]


def groups(ref: Sequences, hyp: Sequences) -> Iterator[np.ndarray]:
    """Rows to be worked on together, all of whose columns are held. Rows that are better left alone come one by one."""
    blocks = np.maximum(1, -(-ref.size // 64))
    # Sizes within a quarter of one another are company.
    rung = np.ceil(np.log(blocks) / np.log(1.25)).astype(np.int64)
    order = np.lexsort((hyp.size, rung))
    at = 0
    while at < len(order):
        first = order[at]
        rows = order[at : at + BLOCKS]
        rows = rows[(rung[rows] == rung[first]) & (hyp.size[rows] <= hyp.size[first] * 1.25 + 32)]
        high = int(blocks[rows].max())
        most = min(BLOCKS // high, ROOM // (16 * high * (int(hyp.size[rows[-1]]) + high)))
        rows = rows[: max(1, most)]
        at += len(rows)
        yield from [rows] if len(rows) >= FEW else rows[:, None]


def bands(ref: Sequences, hyp: Sequences, rows: np.ndarray, within: np.ndarray) -> Iterator[np.ndarray]:
    """As ``groups``, some rows whose blocks are stepped only as far as a band that allows for so many edits reaches.

    A narrow band of few pairs is done before a step's calls are paid for, so pairs are put together up to the room there is, whatever their sizes,
    the longest first.
    """
    longest = np.maximum(ref.size[rows], hyp.size[rows])
    span = np.minimum(longest // 64, within[rows] // 65) + 2
    turn = np.ceil(np.log2(span / 3)).astype(np.int64)
    order = np.lexsort((-longest, turn))
    codes = 1 + int(ref.codes.max(initial=0))
    at = 0
    while at < len(order):
        picked = order[at : at + BLOCKS]
        picked = picked[turn[picked] == turn[picked[0]]]
        long = int(longest[picked[0]])
        high = long // 64 + 1
        most = min(BLOCKS // int(span[picked].max()), ROOM // (8 * high * min(64 * high, codes) + 8 * (long + 2 * high)))
        picked = picked[: max(1, BLOCKS // high, most)]
        at += len(picked)
        yield from [rows[picked]] if len(picked) >= FEW else rows[picked][:, None]


def _numbered(values: np.ndarray, wanted: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct ``values`` below ``most`` numbered from 1: the numbers of the values, those of ``wanted``, 0 for what is no value, and how many there are."""
    if most <= _TABLE:
        seen = np.zeros(most, bool)
        seen[values] = True
        number = np.cumsum(seen, dtype=np.int32)
        count = int(number[-1]) if most else 0
        number[~seen] = 0
        return number[values], number[wanted], count
    known, number = np.unique(values, return_inverse=True)
    if not len(known):
        return number, np.zeros(len(wanted), np.int64), 0
    found = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return number + 1, np.where(known[found] == wanted, found + 1, 0), len(known)


def columns(ref: Sequences, hyp: Sequences, rows: np.ndarray, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray] | np.ndarray:
    """For step, block and pair, bits that say where the cost equals that of the diagonal cell and where it exceeds the cell to the left; block b
    of column j belongs to step j + b.

    If ``within`` names a number of edits for each pair, no less than its sizes differ by, only the last cost of each pair: right if it is
    within that number, else maybe too high, never too low.
    """
    n_pairs, blocks, longest = len(rows), max(1, -(-int(ref.size[rows].max()) // 64)), int(hyp.size[rows].max())
    row, place, code = ref.picked(rows)
    hyp_row, hyp_place, hyp_code = hyp.picked(rows)
    # Items of these pairs, then a mask for each item of each pair; 0 is an item that no ``ref`` has, and the mask of one that its own has not.
    number, hyp_number, many = _numbered(code, hyp_code, 1 + int(max(code.max(initial=0), hyp_code.max(initial=0))))
    mask_of, hyp_mask, n_masks = _numbered(row * (many + 1) + number, hyp_row * (many + 1) + hyp_number, n_pairs * (many + 1))
    width = n_masks + 1
    # The bits of a mask are distinct, so their sums in halves of 32 bits are exact.
    spot = (place >> 5) * width + mask_of
    halves = np.bincount(spot, np.ldexp(1.0, (place & 31).astype(np.int32)), 2 * blocks * width).astype(np.uint64).reshape(blocks, 2, width)
    match = (halves[:, 0] | halves[:, 1] << np.uint64(32)).ravel()
    # The latest column is first, and before and after the text nothing matches.
    steps = longest + blocks - 1
    seen = np.zeros((steps + blocks - 1, n_pairs), np.intp)
    seen[steps - 1 - hyp_place, hyp_row] = hyp_mask
    first_of = (np.arange(blocks) * width)[:, None]

    shape, one, top, kept = (blocks, n_pairs), np.uint64(1), np.uint64(63), within is None
    up, down = np.full(shape, ~np.uint64(0)), np.zeros(shape, np.uint64)
    # What a block hands over to the one below: whether the cost of its last row rises or falls.
    over, under = np.ones((blocks + 1, n_pairs), np.uint64), np.zeros((blocks + 1, n_pairs), np.uint64)
    levels, rises = (np.zeros((steps if kept else 1, *shape), np.uint64) for _ in range(2))
    x, fall, at = np.empty(shape, np.uint64), np.empty(shape, np.uint64), np.empty(shape, np.intp)
    if not kept:
        # How far a path of so many edits goes below and above the diagonal.
        more = hyp.size[rows] - ref.size[rows]
        below, above = max(1, int(((within - more) // 2).max())), int(((within + more) // 2).max())
        # The cost in the last row of a block, and for each pair what its last block has at its last column.
        cost, last = np.zeros(shape, np.int64), np.maximum(0, -(-ref.size[rows] // 64) - 1)
        last_up, last_down, last_cost = np.zeros(n_pairs, np.uint64), np.zeros(n_pairs, np.uint64), np.zeros(n_pairs, np.int64)
        done = np.maximum(hyp.size[rows], 1) - 1 + last
        by_step = np.argsort(done, kind="stable")
        ends = np.searchsorted(done[by_step], np.arange(steps + 1)).tolist()
    first, live = 0, 0
    for step in range(steps):
        had, was, first, live = first, live, 0, min(blocks, step + 1)
        if not kept:
            first, live = min(blocks - 1, max(0, -((63 + above - step) // 65))), min(live, (step + below) // 65 + 1)
            if first == had:
                # Nothing is known above the band but that no cost rises by more than one.
                over[first], under[first] = one, 0
            if live > was:
                # Nor to the left of it, but that none rises by more than one from row to row.
                cost[was] = 64 + (cost[was - 1] - over[was].view(np.int64) + under[was].view(np.int64) if was else 0)
        level, rise = (levels[step, :live], rises[step, :live]) if kept else (levels[0, first:live], rises[0, first:live])
        u, d, x_, f, o, n = (a[first:live] for a in (up, down, x, fall, over, under))
        low = steps - 1 - step
        np.add(seen[low + first : low + live], first_of[first:live], at[first:live])
        match.take(at[first:live], out=x_, mode="clip")
        x_ |= n
        np.bitwise_and(x_, u, level)
        level += u
        level ^= u
        level |= x_
        level |= d
        np.bitwise_or(level, u, rise)
        np.invert(rise, rise)
        rise |= d
        np.bitwise_and(level, u, f)
        # x is free now: rises and falls moved down by a row, with what the blocks above hand over.
        np.left_shift(rise, one, x_)
        x_ |= o
        np.left_shift(f, one, d)
        d |= n
        np.right_shift(rise, top, over[first + 1 : live + 1])
        np.right_shift(f, top, under[first + 1 : live + 1])
        np.bitwise_or(level, x_, u)
        np.invert(u, u)
        u |= d
        np.bitwise_and(level, x_, d)
        if not kept:
            cost[first:live] += over[first + 1 : live + 1].view(np.int64)
            cost[first:live] -= under[first + 1 : live + 1].view(np.int64)
            if ends[step] < ends[step + 1]:
                ended = by_step[ends[step] : ends[step + 1]]
                last_up[ended], last_down[ended], last_cost[ended] = (a[last[ended], ended] for a in (up, down, cost))
    if kept:
        return levels, rises
    # Back from the last row of the block to that of the text.
    left = ref.size[rows] - 64 * last
    beyond = np.where(left == 64, np.uint64(0), ~np.uint64(0) << np.minimum(left, 63).astype(np.uint64))
    found = last_cost - np.bitwise_count(last_up & beyond).astype(np.int64) + np.bitwise_count(last_down & beyond)
    return np.where(hyp.size[rows] == 0, ref.size[rows], found)


def _least(ref: Sequences, hyp: Sequences) -> np.ndarray:
    """Edits that each pair needs at least: an edit adds one item, or takes one away, or both. Items count by the last bits of their numbers."""
    out = np.zeros(len(ref.size), np.int64)
    for low in range(0, len(out), BLOCKS):
        high = min(low + BLOCKS, len(out))
        more = np.zeros((high - low) * 64, np.int64)
        for side, sign in ((ref, 1), (hyp, -1)):
            kind = side.codes[side.start[low] : side.start[high - 1] + side.size[high - 1]] & 63
            more += sign * np.bincount(np.repeat(np.arange(0, len(more), 64), side.size[low:high]) + kind, minlength=len(more))
        more = more.reshape(-1, 64)
        out[low:high] = np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1))
    return out


def distances(ref: Sequences, hyp: Sequences, alone, most: np.ndarray | None = None) -> np.ndarray:
    """Edit distance of each pair; ``alone(row)`` gives that of a pair without company.

    ``most`` names a number for each pair: a distance above it is not needed, and any number above it may stand for one.
    """
    out, longest = _least(ref, hyp), np.maximum(ref.size, hyp.size)
    limit = longest if most is None else np.minimum(most, longest)
    # No pair needs more edits than its longer side has items.
    rows = np.flatnonzero((out <= limit) & (out < longest))
    within = np.minimum(limit, np.maximum(128, out + out // 2))
    while len(rows):
        for group in bands(ref, hyp, rows, within):
            out[group] = alone(int(group[0])) if len(group) < FEW else columns(ref, hyp, group, within[group])
        rows = rows[(out[rows] > within[rows]) & (within[rows] < limit[rows])]
        within[rows] = np.minimum(limit[rows], 3 * within[rows])
    return out


def walks(ref: Sequences, hyp: Sequences, alone) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of pairs (rows, op, i, j), a row for each move of each pair from left to right: what it is and the positions it starts at.

    The order of preference is that of ``alignment.walk``; ``alone(row)`` gives the moves of a pair without company from its end.
    """
    for rows in groups(ref, hyp):
        if len(rows) < FEW:
            moves = np.array(alone(int(rows[0])), np.int64).reshape(-1, 3)[::-1]
            yield np.full(len(moves), rows[0]), moves[:, 0], moves[:, 1], moves[:, 2]
            continue
        levels, rises = columns(ref, hyp, rows)
        i, j, pair = ref.size[rows].copy(), hyp.size[rows].copy(), np.arange(len(rows))
        ref_at, hyp_at = ref.start[rows], hyp.start[rows]
        steps = []
        while True:
            live = (i > 0) | (j > 0)
            if not live.all():
                i, j, pair = i[live], j[live], pair[live]
                if not len(pair):
                    break
            op = np.where(i > 0, DEL, INS)
            inner = np.flatnonzero((i > 0) & (j > 0))
            a, b, p = i[inner] - 1, j[inner] - 1, pair[inner]
            same = ref.codes[ref_at[p] + a] == hyp.codes[hyp_at[p] + b]
            bit, block = (a & 63).astype(np.uint64), a >> 6
            level = (levels[b + block, block, p] >> bit & np.uint64(1)).astype(bool)
            rise = (rises[b + block, block, p] >> bit & np.uint64(1)).astype(bool)
            op[inner] = np.where(same, OK, np.where(~level, SUB, np.where(rise, INS, DEL)))
            i, j = i - (op != INS), j - (op != DEL)
            steps.append((pair, op, i, j))
        if not steps:
            continue
        pair, op, i, j = (np.concatenate(c) for c in zip(*steps[::-1]))
        order = np.argsort(pair, kind="stable")
        yield rows[pair[order]], op[order], i[order], j[order]
