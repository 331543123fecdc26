"""A set of words as a tree of their bytes in flat arrays, walked from every place of many texts at once.

A node is a number, an edge is the key ``node * 256 + byte`` in an open hash table that gives the child. Trees are built
level by level from sorted words, and texts are walked level by level: all places where a word may start are one array of
nodes, which thins out as they go down. So neither words nor characters are looped over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are walked together; a longer text is walked alone.
BLOCK = 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Trie:
    """``keys`` and ``child``: the hash table of edges, -1 where a slot is free. ``word``: what ends at a node, or -1. ``size``: bytes of each word."""

    keys: np.ndarray
    child: np.ndarray
    word: np.ndarray
    size: np.ndarray

    def step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The children along ``bytes_``, or -1."""
        keys = nodes.astype(np.int64) * 256 + bytes_
        mask = len(self.keys) - 1
        slot = _slots(keys, len(self.keys))
        found = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            seen = self.keys[slot]
            hit = seen == keys[open_]
            found[open_[hit]] = self.child[slot[hit]]
            going = ~hit & (seen >= 0)
            open_, slot = open_[going], (slot[going] + 1) & mask
        return found


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    bits = size.bit_length() - 1
    return ((keys.astype(np.uint64) * _FACTOR) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def build(words: Sequence[bytes]) -> Trie:
    """The tree of distinct words that are not empty; words keep their places in the list."""
    size = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    node = np.zeros(len(words), np.int64)
    ends: dict[int, np.ndarray] = {}
    edges, children, count, level = [], [], 1, 0
    live = np.flatnonzero(size > 0)
    while len(live):
        keys, place = np.unique(node[live] * 256 + data[start[live] + level], return_inverse=True)
        edges.append(keys)
        children.append(count + np.arange(len(keys)))
        node[live] = count + place
        count += len(keys)
        level += 1
        done = size[live] == level
        ends[level] = live[done]
        live = live[~done]
    word = np.full(count, -1, np.int32)
    for at in ends.values():
        word[node[at]] = at
    keys = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    child = np.concatenate(children) if children else np.zeros(0, np.int64)
    table = 1 << max(4, (2 * len(keys)).bit_length())
    slots, kept, left = np.full(table, -1, np.int64), np.full(table, -1, np.int32), np.arange(len(keys))
    slot = _slots(keys, table)
    while len(left):
        # Of those that want a free slot the first gets it; the others go on to the next.
        free = slots[slot] < 0
        taken, first = np.unique(slot[free], return_index=True)
        won = np.flatnonzero(free)[first]
        slots[taken], kept[taken] = keys[left[won]], child[left[won]]
        rest = np.ones(len(left), bool)
        rest[won] = False
        left, slot = left[rest], (slot[rest] + 1) & (table - 1)
    return Trie(slots, kept, word, size)


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in the bytes); null texts are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = min(len(texts), max(low + 1, int(np.searchsorted(at, at[low] + BLOCK, "right")) - 1))
        yield low, high, raw[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def occurrences(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, words) for words of one byte, then of two, and so on: where each stands in the texts, overlaps included."""
    # Words start where characters do.
    at = np.flatnonzero((data & 0xC0) != 0x80)
    end = np.repeat(offsets[1:], np.diff(offsets))
    nodes = np.zeros(len(at), np.int32)
    depth = 0
    while len(at):
        nodes = trie.step(nodes, data[at + depth])
        going = nodes >= 0
        at, nodes, depth = at[going], nodes[going], depth + 1
        words = trie.word[nodes]
        hit = words >= 0
        if hit.any():
            yield at[hit], words[hit]
        inside = at + depth < end[at]
        at, nodes = at[inside], nodes[inside]


def contained(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word), each once, in order of row and word: which words a text contains."""
    many = max(1, len(trie.size))
    found = [np.unique((np.searchsorted(offsets, at, "right") - 1) * many + words) for at, words in occurrences(trie, data, offsets)]
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // many, pairs % many


def longest(trie: Trie, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the longest word that stands there, or -1."""
    best = np.full(len(data), -1, np.int64)
    for at, words in occurrences(trie, data, offsets):
        best[at] = words
    return best


def chosen(size: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places where words of ``size`` bytes, 0 for none, are taken when texts are read from left to right.

    A word is taken where no earlier one covers its start. The ways from place to place are followed by doubling.
    """
    starts = np.flatnonzero(size)
    if not len(starts):
        return starts
    reach = np.maximum.accumulate(starts + size[starts])
    if (starts[1:] >= reach[:-1]).all():
        return starts
    # From each start to the first start that it does not cover, and from the last to itself.
    jump = np.append(np.searchsorted(starts, starts + size[starts]), len(starts))
    seen = np.zeros(len(starts) + 1, bool)
    seen[np.searchsorted(starts, offsets[:-1])] = True
    while True:
        further = seen.copy()
        further[jump[seen]] = True
        if (jump[jump] == jump).all():
            break
        seen, jump = further, jump[jump]
    return starts[further[:-1]]


def replace(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, size: np.ndarray, new: np.ndarray, new_at: np.ndarray, new_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with ``size`` bytes at each place ``at`` replaced by ``new_size`` bytes of ``new`` from ``new_at``, and their offsets."""
    pool = np.concatenate([data, new])
    # Pieces in turn: what stands before a place, then its replacement; after the last place, the rest.
    before = np.concatenate([[0], at + size])
    kept = np.append(at, len(data)) - before
    source = np.empty(2 * len(at) + 1, np.int64)
    length = np.empty_like(source)
    source[::2], source[1::2] = before, len(data) + new_at
    length[::2], length[1::2] = kept, new_size
    total = np.cumsum(length)
    index = np.repeat(source - (total - length), length) + np.arange(int(total[-1]) if len(total) else 0)
    grown = np.concatenate([[0], np.cumsum(new_size - size)])
    return pool[index], offsets + grown[np.searchsorted(at, offsets, "left")]
