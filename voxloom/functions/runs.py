"""Words and runs of many texts at once, over their UTF-8 bytes.

``words`` finds what ``[a-z0-9]+`` finds in the lower-case texts, ``runs`` cuts as ``functions.text.space_scripts`` spaces; both give what the
expressions of Spark give, so the Han characters are those of the session's own class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import compute as pc

_BLANK = ord(" ")
# The lower-case letter or digit of a byte, or 0.
_LOWER = np.zeros(256, np.uint8)
_LOWER[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = np.frombuffer(
    b"0123456789abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz", np.uint8
)
# The only other characters whose lower case has a plain letter: the Kelvin sign, and the capital i with a dot, which keeps its dot.
_KELVIN, _DOTTED = "\u212a", "\u0130"


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def large_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes()))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, the text of each) of texts that may be null."""
    for char, lower in ((_KELVIN, "k"), (_DOTTED, "i\u0307")):
        texts = pc.replace_substring(texts, char, lower)
    data, offsets = _bytes(texts)
    low = _LOWER[data]
    inside = low > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offsets[:-1][np.diff(offsets) > 0]
    begins[edge] = inside[edge]
    begin = np.flatnonzero(begins)
    low = low[inside]
    # A word's first letter among the letters.
    of_letter = np.flatnonzero(begins[inside])
    return large_strings(low, np.append(of_letter, len(low))), np.searchsorted(offsets, begin, "right") - 1


@dataclass
class Runs:
    """The runs of texts: the text of each, its bytes, and of those that are split the number of the token, else -1. Tokens are distinct."""

    of_text: np.ndarray
    whole: pa.Array
    token: np.ndarray
    tokens: pa.Array


def _characters(data: np.ndarray, is_han: np.ndarray) -> np.ndarray:
    """Where Han characters begin; all of them have three or four bytes."""
    three = np.flatnonzero((data >= 0xE0) & (data < 0xF0))
    four = np.flatnonzero(data >= 0xF0)
    data = np.append(data, np.zeros(3, np.uint8))
    b = [data[three + k].astype(np.int32) & 0x3F for k in (1, 2)]
    code = (data[three].astype(np.int32) & 0x0F) << 12 | b[0] << 6 | b[1]
    found = three[is_han[code]]
    if len(four):
        b = [data[four + k].astype(np.int32) & 0x3F for k in (1, 2, 3)]
        code = (data[four].astype(np.int32) & 0x07) << 18 | b[0] << 12 | b[1] << 6 | b[2]
        found = np.sort(np.concatenate([found, four[is_han[code]]]))
    return found


def _tags(data: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which bytes belong to ``<p>`` or ``</p>``; ``text`` tells the texts of bytes."""
    out = np.zeros(len(data), bool)
    at = np.flatnonzero(data == ord("<"))
    for tag in (b"<p>", b"</p>"):
        some = at[at + len(tag) <= len(data)]
        for k, byte in enumerate(tag):
            some = some[data[some + k] == byte]
        some = some[text(some) == text(some + len(tag) - 1)]
        for k in range(len(tag)):
            out[some + k] = True
    return out


def runs(texts: pa.Array, is_han: np.ndarray) -> Runs:
    """Blanks out, a cut wherever Han text touches Latin letters or digits, ``<p>`` and ``</p>`` out; runs with a letter are tokens
    of their lower-case letters and digits. A text of one run has a token only if it begins with a lower-case letter. Null texts have no runs.
    """
    null = texts.is_null().to_numpy(zero_copy_only=False)
    data, offsets = _bytes(texts)
    stays = data != _BLANK
    data, offsets = data[stays], np.append(0, np.cumsum(stays))[offsets]

    def text(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(offsets, at, "right") - 1

    low = _LOWER[data]
    # A cut stands before a byte.
    cut = np.zeros(len(data) + 1, bool)
    han = _characters(data, is_han)
    if len(han):
        plain = np.append(low > 0, False)
        cut[han] = plain[han - 1] & (han > 0)
        # Java's expressions look back one of its characters only, so they find no Han character of four bytes before a letter.
        after = np.minimum(han[data[han] < 0xF0] + 3, len(data))
        cut[after] |= plain[after]
        cut[offsets] = False
    if (data == ord("<")).any():
        kept = ~_tags(data, text)
        moved = np.append(0, np.cumsum(kept))
        inner = moved[np.flatnonzero(cut)]
        cut = np.zeros(moved[-1] + 1, bool)
        cut[inner] = True
        data, low, offsets = data[kept], low[kept], moved[offsets]
    for char, letter in ((_KELVIN, b"k"), (_DOTTED, b"i")):
        code = char.encode()
        at = np.flatnonzero(data[: len(data) - len(code) + 1] == code[0])
        for k, byte in enumerate(code):
            at = at[data[at + k] == byte]
        low[at] = letter[0]
    inner = np.flatnonzero(cut)
    # An empty text is an empty run.
    start = np.sort(np.concatenate([offsets[:-1][~null], inner]))
    end = np.sort(np.concatenate([offsets[1:][~null], inner]))
    filled = np.flatnonzero(~null)
    # Runs come in the order of texts: one for each text, and one for each cut.
    of_text = np.repeat(filled, 1 + np.diff(np.searchsorted(inner, offsets))[filled]) if len(filled) else np.zeros(0, np.int64)
    many = np.bincount(of_text, minlength=len(null))
    begins = np.zeros(len(null), bool)
    some = np.flatnonzero(np.diff(offsets) > 0)
    begins[some] = (data[offsets[some]] >= ord("a")) & (data[offsets[some]] <= ord("z"))
    letters = np.append(0, np.cumsum(low >= ord("a")))
    is_token = ((many > 1) | begins)[of_text] & (letters[end] > letters[start])
    return Runs(of_text, large_strings(data, np.append(start, len(data))), *_tokens(low, start, end, is_token))


def _tokens(low: np.ndarray, start: np.ndarray, end: np.ndarray, is_token: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    before = np.append(0, np.cumsum(low > 0))
    size = before[end] - before[start]
    used = np.repeat(is_token, end - start) & (low > 0)
    coded = large_strings(low[used], np.append(0, np.cumsum(size[is_token]))).dictionary_encode()
    token = np.full(len(start), -1, np.int64)
    token[is_token] = coded.indices.to_numpy()
    return token, coded.dictionary
