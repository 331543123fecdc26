"""The best splits of many run-together texts into words at once, over arrays.

Only known words have rows of their own; unknown words of all sizes are one sum over the latest letters of all texts. Letters are
numbered with the first letters of all texts first, then the second ones, so a step of the search is a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log10

import numpy as np

# Fixed value: the longest word a token is split into; longer vocabulary words are not used, nor counted in totals.
MAX_WORD = 24
# Letters that one number holds; longer words have two.
_HALF = 12
# Letters whose words are looked for at a time: few enough that all that is known of them stays near.
_BLOCK = 1 << 14
# Pairs of known words that are looked up at a time.
_PAIRS = 1 << 20
# So few texts are stepped one by one.
_NARROW = 16
# Counts below this have their logarithms in a table.
_SMALL = 1 << 13
# Scores as close as this may become equal when a number is added to both.
_CLOSE = 1e-9

# Numbers from 1 of the letters and digits that words are made of; 0 is any other byte, which no word holds.
_DIGIT = np.zeros(256, np.int64)
_DIGIT[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = np.arange(1, 37)
_SIZES = np.arange(1, MAX_WORD + 1, dtype=np.int8)[:, None]


@dataclass
class Texts:
    """Texts letter by letter as they came: the digit, the place in its text, the row of its text, the longest first. A letter has the number
    ``base[place + 1] + row``; numbers below ``base[1]`` are what stands before the texts."""

    digits: np.ndarray
    place: np.ndarray
    row: np.ndarray
    size: np.ndarray
    base: np.ndarray


@dataclass
class Words:
    """Known words in texts, by the number of their last letter and their size: number and count of the word, -1 if only pairs know it."""

    letter: np.ndarray
    size: np.ndarray
    start: np.ndarray
    row: np.ndarray
    number: np.ndarray
    count: np.ndarray


def laid_out(data: np.ndarray, offsets: np.ndarray) -> Texts:
    """Bytes of texts, one after another, in steps."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    rank = np.empty(len(size), np.int64)
    rank[order] = np.arange(len(size))
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    base = np.cumsum(np.append([0, len(size)], np.bincount(place)))
    return Texts(_DIGIT[data], place, np.repeat(rank, size), size[order], base)


def word_codes(data: np.ndarray, ends: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that no other word of up to ``MAX_WORD`` letters has: of its last letters and of those before them."""
    low, high = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for k in range(min(int(size.max(initial=0)), MAX_WORD), 0, -1):
        has = np.flatnonzero(size >= k)
        code = high if k > _HALF else low
        code[has] = code[has] * 37 + _DIGIT[data[ends[has] - k]]
    return low, high


def known_words(texts: Texts, may: Callable, find: Callable) -> Words:
    """All known words; ``may`` tells fast which codes cannot be known, ``find`` gives the numbers and counts of codes."""
    n = len(texts.digits)
    found = [x for low in range(0, n, _BLOCK) for x in _likely_words(texts, low, min(low + _BLOCK, n), may)]
    last, size, low, high = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    number, count = find(low, high)
    known = np.flatnonzero(number >= 0)
    last, size = last[known], size[known].astype(np.int64)
    row, place = texts.row[last], texts.place[last]
    letter = texts.base[place + 1] + row
    order = np.argsort(letter << 5 | size)
    start = texts.base[place - size + 1] + row
    return Words(*(x[order] for x in (letter, size, start, row, number[known], count[known])))


def _likely_words(texts: Texts, begin: int, end: int, may: Callable) -> Iterator[tuple[np.ndarray, ...]]:
    """(last letter, size, codes) of what may be words, by size."""
    last, place = np.arange(begin, end), texts.place[begin:end]
    low, high, power = texts.digits[begin:end], None, 1
    for size in range(1, MAX_WORD + 1):
        if size > 1:
            there = np.flatnonzero(place >= size - 1)
            if not len(there):
                return
            if len(there) < len(place):
                last, place, low, high = last[there], place[there], low[there], None if high is None else high[there]
            digit = texts.digits[last - (size - 1)]
            power = power * 37 if size != _HALF + 1 else 1
            if size <= _HALF:
                low = low + digit * power
            else:
                high = digit if high is None else high + digit * power
        some = np.flatnonzero(may(low, high))
        yield last[some], np.full(len(some), size, np.int8), low[some], np.zeros(len(some), np.int64) if high is None else high[some]


def _pairs(texts: Texts, words: Words, of_letter: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word, word before it, key) of known words, some at a time; ``of_letter`` says where the words of each letter begin."""
    low, wide = of_letter[words.start], of_letter[words.start + 1] - of_letter[words.start]
    sums = np.append(0, np.cumsum(wide))
    begin = 0
    while begin < len(wide):
        end = max(begin + 1, int(np.searchsorted(sums, sums[begin] + _PAIRS, "right")) - 1)
        word = np.repeat(np.arange(begin, end), wide[begin:end])
        before = np.arange(sums[end] - sums[begin]) - (sums[word] - sums[begin]) + low[word]
        # A word that only pairs know is no first word.
        first = np.flatnonzero(words.count[before] > 0)
        if len(first) < len(word):
            word, before = word[first], before[first]
        yield word, before, words.number[before] << 32 | words.number[word]
        begin = end


def _logs(counts: np.ndarray, total: float) -> np.ndarray:
    """Logarithms of shares, as ``math.log10`` gives them."""
    small = min(int(counts.max(initial=0)) + 1, _SMALL)
    out = np.array([0.0] + [log10(k / total) for k in range(1, small)])[np.minimum(counts, small - 1)]
    large = np.flatnonzero(counts >= _SMALL)
    if len(large):
        shares, which = np.unique(counts[large], return_inverse=True)
        out[large] = np.array([log10(k / total) for k in shares.tolist()])[which]
    return out


def _ranges(edges: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``which``, member) of the ranges that ``edges`` has for ``which``."""
    wide = edges[which + 1] - edges[which]
    own = np.repeat(np.arange(len(which)), wide)
    return own, np.arange(len(own)) + (edges[which] - np.cumsum(wide) + wide)[own]


def split(texts: Texts, words: Words, total: float, find_pairs: Callable | None) -> np.ndarray:
    """Whether a word of the best split begins at each letter of the texts as they came.

    Scores are those of ``segmentation.best_split``: known words by their share, unknown ones ever less likely with length, a word after
    another by the share of the pair, equal ones by the size of the last word.
    """
    if not len(texts.digits):
        return np.zeros(0, bool)
    search = _Search(texts, words, total, find_pairs)
    wide = np.diff(texts.base)[1:]
    together = int(np.searchsorted(-wide, -_NARROW))
    for step in range(together):
        search.take(step)
    for row in range(int(wide[together]) if together < len(wide) else 0):
        search.finish(row, together)
    return search.cuts()


class _Search:
    """The best scores of all texts up to a letter, a step further with each ``take``."""

    def __init__(self, texts: Texts, words: Words, total: float, find_pairs: Callable | None):
        self.texts, self.words = texts, words
        self.base = texts.base.tolist()
        letters = self.base[-1]
        self.unknown = np.array([1.0 - log10(total) - size for size in range(1, MAX_WORD + 1)])
        self.of_letter = np.append(0, np.cumsum(np.bincount(words.letter, minlength=letters)))
        known = words.count > 0
        self.alone = self.unknown[words.size - 1]
        self.alone[known] = _logs(words.count[known], total)
        none = np.zeros(0, np.int64)
        word, before, many = [none], [none], [none]
        for w, b, key in _pairs(texts, words, self.of_letter) if find_pairs is not None else ():
            n = find_pairs(key)
            hit = np.flatnonzero(n > 0)
            word.append(w[hit]), before.append(b[hit]), many.append(n[hit])
        # Pairs in texts, by their second word: the word before, and the score given it.
        self.hit_word, self.hit_before = np.concatenate(word), np.concatenate(before)
        self.given = _logs(np.concatenate(many), total) - self.alone[self.hit_before]
        self.hit_size = words.size[self.hit_before].astype(np.int8)
        self.of_word = np.append(0, np.cumsum(np.bincount(self.hit_word, minlength=len(words.size))))
        edges = self.of_letter[texts.base]
        self.word_at, self.hit_at = edges.tolist(), self.of_word[edges].tolist()
        # By letter: the best score, the size of its last word, and whether longer words come close.
        self.top, self.top_size, self.close = np.zeros(letters), np.zeros(letters, np.int8), np.zeros(letters, bool)
        self.any_close, self.paired = False, None
        # By known word: the best score that ends with it, and the size of the word before it.
        self.score, self.size_before = np.zeros(len(words.size)), np.zeros(len(words.size), np.int8)
        # The best scores up to the latest letters, the latest first, from ``self.now`` on.
        self.latest = np.zeros((MAX_WORD * 4, self.base[1]))
        self.now = len(self.latest) - 1

    def take(self, step: int) -> None:
        low, high = self.base[step + 1], self.base[step + 2]
        wide, deep = high - low, min(step + 1, MAX_WORD)
        cells = self.latest[self.now : self.now + deep, :wide] + self.unknown[:deep, None]
        a, b = self.word_at[step + 1], self.word_at[step + 2]
        if a < b:
            self._score_words(a, b, self.hit_at[step + 1], self.hit_at[step + 2])
            cells[self.words.size[a:b] - 1, self.words.row[a:b]] = self.score[a:b]
        most = cells.max(0)
        near = cells >= most - _CLOSE
        if np.count_nonzero(near) == wide:
            size = (near * _SIZES[:deep]).max(0)
        else:
            size = ((cells == most) * _SIZES[:deep]).max(0)
            close = (near * _SIZES[:deep]).max(0) > size
            self.close[low:high] = close
            self.any_close |= bool(close.any())
        self.top[low:high], self.top_size[low:high] = most, size
        if not self.now:
            self.now = len(self.latest) - MAX_WORD
            self.latest[self.now + 1 :] = self.latest[: MAX_WORD - 1]
        else:
            self.now -= 1
        self.latest[self.now, :wide] = most

    def _score_words(self, a: int, b: int, first: int, last: int) -> None:
        start = self.words.start[a:b]
        score, before = self.top[start] + self.alone[a:b], self.top_size[start]
        whole = np.zeros(0, np.int64)
        if first < last:
            word, size = self.hit_word[first:last], self.hit_size[first:last]
            scores = self.score[self.hit_before[first:last]] + self.given[first:last]
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            of = word[begin] - a
            most = np.maximum.reduceat(scores, begin)
            group = np.cumsum(np.append(False, word[1:] != word[:-1]))
            longest = np.maximum.reduceat(np.where(scores == most[group], size, 0), begin)
            # Whether the best word before is one of the pairs, whose score alone does not count.
            told = np.maximum.reduceat(size == before[of][group], begin)
            bound = score[of]
            won = most > bound + _CLOSE
            whole = of[~won & ((most >= bound - _CLOSE) | told | self.close[start[of]])] + a
            score[of[won]], before[of[won]] = most[won], longest[won]
        self.score[a:b], self.size_before[a:b] = score, before
        if self.any_close:
            # A word that has a pair somewhere in its text prefers the longest of the words before that come out equal.
            some = np.flatnonzero(self.close[start])
            if len(some):
                some = some + a
                some = some[self.of_word[some + 1] == self.of_word[some]]
                if self.paired is None:
                    self.paired = np.sort(self.words.row[self.hit_word] << 32 | self.words.number[self.hit_word])
                key = self.words.row[some] << 32 | self.words.number[some]
                if len(self.paired):
                    some = some[self.paired[np.minimum(np.searchsorted(self.paired, key), len(self.paired) - 1)] == key]
                    whole = np.concatenate([whole, some])
        if len(whole):
            self._score_whole(whole)

    def _score_whole(self, word: np.ndarray) -> None:
        """Scores of a few known words from all words before, known or not."""
        start, row = self.words.start[word], self.words.row[word]
        # The place after the word before.
        place = np.searchsorted(self.texts.base, start, "right") - 1
        behind = place[:, None] - _SIZES[:, 0]
        cells = np.where(behind >= 0, self.top[self.texts.base[np.maximum(behind, 0)] + row[:, None]] + self.unknown, -np.inf)
        own, before = _ranges(self.of_letter, start)
        cells[own, self.words.size[before] - 1] = self.score[before]
        cells += self.alone[word][:, None]
        own, hits = _ranges(self.of_word, word)
        cells[own, self.hit_size[hits] - 1] = self.score[self.hit_before[hits]] + self.given[hits]
        best = MAX_WORD - 1 - cells[:, ::-1].argmax(1)
        self.score[word], self.size_before[word] = cells[np.arange(len(word)), best], best + 1

    def finish(self, row: int, step: int) -> None:
        """The rest of one text, letter by letter."""
        end, unknown = int(self.texts.size[row]), self.unknown.tolist()
        letters = self.texts.base[1 : end + 1] + row
        word = _ranges(self.of_letter, letters)[1]
        edge = np.append(0, np.cumsum(self.of_letter[letters + 1] - self.of_letter[letters])).tolist()
        hits = _ranges(self.of_word, word)[1]
        hit_edge = np.append(0, np.cumsum(self.of_word[word + 1] - self.of_word[word])).tolist()
        hit_size, given = self.hit_size[hits].tolist(), self.given[hits].tolist()
        size, alone, number = (x[word].tolist() for x in (self.words.size, self.alone, self.words.number))
        score, size_before = self.score[word].tolist(), self.size_before[word]
        # A word that has a pair somewhere in the text is told apart by all words before it.
        paired = {number[i] for i in range(len(word)) if hit_edge[i] < hit_edge[i + 1]}
        before = np.append(row, letters[:step])
        tops, sizes = self.top[before].tolist(), self.top_size[before].tolist()
        cells: dict[int, list[float]] = {}
        for place in range(max(0, step - MAX_WORD), end):
            after = place + 1
            one = [a + b for a, b in zip(tops[max(0, after - MAX_WORD) : after][::-1], unknown)]
            for i in range(edge[place], edge[after]):
                if place >= step:
                    start, low, high = place - size[i], hit_edge[i], hit_edge[i + 1]
                    if start >= 0 and number[i] in paired:
                        told, own = dict(zip(hit_size[low:high], given[low:high])), alone[i]
                        score[i], size_before[i] = max((so_far + told.get(k, own), k) for k, so_far in enumerate(cells[start], 1))
                    else:
                        score[i], size_before[i] = tops[start + 1] + alone[i], sizes[start + 1]
                one[size[i] - 1] = score[i]
            cells[place] = one
            cells.pop(place - MAX_WORD, None)
            if place >= step:
                best = max(one)
                tops.append(best)
                sizes.append(len(one) - one[::-1].index(best))
        self.top_size[letters[step:]] = sizes[step + 1 :]
        self.size_before[word] = size_before

    def cuts(self) -> np.ndarray:
        """Whether a word begins at each letter, walked from the end of all texts."""
        texts, base = self.texts, self.texts.base
        key = self.words.letter << 5 | self.words.size
        row = np.flatnonzero(texts.size > 0)
        end = texts.size[row] - 1
        size = self.top_size[base[end + 1] + row].astype(np.int64)
        cut = np.zeros(base[-1], bool)
        while len(row):
            cut[base[end - size + 2] + row] = True
            asked = (base[end + 1] + row) << 5 | size
            at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
            known = key[at] == asked if len(key) else np.zeros(len(row), bool)
            end = end - size
            size = self.top_size[base[end + 1] + row].astype(np.int64)
            size[known] = self.size_before[at[known]]
            live = end >= 0
            row, end, size = row[live], end[live], size[live]
        return cut[base[texts.place + 1] + texts.row]


def spaced(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a blank before each word but the first, and where they begin."""
    cut = cut.copy()
    cut[offsets[:-1][np.diff(offsets) > 0]] = False
    moved = np.cumsum(cut)
    out = np.full(len(data) + int(moved[-1] if len(moved) else 0), ord(" "), np.uint8)
    out[np.arange(len(data)) + moved] = data
    ends = offsets[1:] + np.append(0, moved)[offsets[1:]]
    return out, np.append(0, ends)
