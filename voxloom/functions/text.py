"""Text expressions: cleaning, normalising, spacing and tokenising mixed-script transcripts."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation dropped before scoring, the one letter folded, and the set that marks a
# transcript as unfit for training.
SCORING_PUNCTUATION = "。：,，！-\n"
SCORING_FOLDS = {"é": "e"}
MANIFEST_PUNCTUATION = " ,、"
SPECIAL_CHARACTERS = '"@#$^&*()·+’=“:<>/"{}[]~|≠–ºª•¶§∞™¡πøˆ¨†®´∑œæ¬˚∆˙©ƒ∂ßå÷≥≤《》µ˜∫√ç≈Ω`¦'
WIDE_BRACKET = "（"

# Blanks as Python's str.split sees them; Java's \s alone covers ASCII only.
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"
# Marks, symbols and punctuation, which the basic normaliser turns into blanks.
MARKS = r"[\p{M}\p{S}\p{P}]"


def char_class(chars: str) -> str:
    """A regular-expression class matching any of ``chars``."""
    seen = dict.fromkeys(chars)
    return "[" + "".join(ch if ch.isalnum() or not ch.isascii() else "\\" + ch for ch in seen) + "]"


def has_any_char(c: Column, chars: str = SPECIAL_CHARACTERS) -> Column:
    """True if the text holds one of the characters.

    Characters of the first 256 are one bitmap look-up per position; the others, tested one after another
    by the regular expression, are only looked for in texts that leave that range.
    """
    near = "".join(ch for ch in chars if ord(ch) < 256)
    far = "".join(ch for ch in chars if ord(ch) >= 256)
    tests = [c.rlike(char_class(near))] if near else []
    if far:
        tests.append(c.rlike(r"[^\x00-\xff]") & c.rlike(char_class(far)))
    return reduce(or_, tests)


def strip_punct(c: Column, drop: str = SCORING_PUNCTUATION, folds: dict[str, str] | None = None) -> Column:
    """Delete listed characters and fold listed letters in one pass over the text."""
    folds = SCORING_FOLDS if folds is None else folds
    return F.translate(c, "".join(folds) + drop, "".join(folds.values()))


def cut_at(c: Column, mark: str = WIDE_BRACKET) -> Column:
    return F.substring_index(c, mark, 1)


def space_scripts(c: Column) -> Column:
    """One blank wherever Han text touches Latin letters or digits."""
    edges = F.regexp_replace(c, r"(?<=\p{IsHan})(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])(?=\p{IsHan})", " ")
    spaced = F.when(c.rlike(r"\p{IsHan}"), edges).otherwise(c)
    return F.regexp_replace(spaced, "</?p>", "")


@lru_cache(maxsize=1)
def _compatibility_pairs() -> tuple[str, str]:
    """Characters whose compatibility form is one other character, and those forms."""
    source, target = [], []
    for code in range(0x80, 0x30000):
        ch = chr(code)
        folded = unicodedata.normalize("NFKC", ch)
        if folded != ch and len(folded) == 1:
            source.append(ch)
            target.append(folded)
    return "".join(source), "".join(target)


def fold_forms(c: Column) -> Column:
    """Full-width, half-width, circled and similar single-character forms to their plain form.

    Texts in plain letters skip the character loop.
    """
    source, target = _compatibility_pairs()
    plain = c.rlike(r"^[\x00-\x7fÀ-ž、-〭ぁ-ゖァ-ヺ一-鿿]*$")
    return F.when(plain, c).otherwise(F.translate(c, source, target))


@lru_cache(maxsize=1)
def _nfkc_udf():
    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        form = unicodedata.normalize
        return pa.array([None if t is None else form("NFKC", t) for t in texts.to_pylist()], pa.string())

    return fold


def nfkc(c: Column) -> Column:
    """Full compatibility composition, including forms that unfold to several characters."""
    return _nfkc_udf()(c)


def normalize_basic(c: Column, full_nfkc: bool = False) -> Column:
    """Lower-case, drop bracketed remarks, turn marks, symbols and punctuation into single blanks."""
    x = F.lower(c)
    x = F.regexp_replace(x, r"[<\[][^>\]]*[>\]]", "")
    x = F.regexp_replace(x, r"\(([^)]+?)\)", "")
    x = nfkc(x) if full_nfkc else fold_forms(x)
    x = F.lower(F.regexp_replace(x, MARKS, " "))
    return F.regexp_replace(x, BLANK + "+", " ")


# A token of mixed-script text: letters with the character after them, a character alone, or letters alone.
_TOKEN = r"([a-z]*[^a-z\s\p{Z}\x1c-\x1f\x85\p{M}\p{S}\p{P}]|[a-z]+)"


def tokenize_mixed(c: Column) -> Column:
    """Tokens of a mixed-script text: a Latin letter run with the character after it, else one character.

    A run keeps the non-letter that follows, so ``ok吗`` is one token: space the scripts first. Marks,
    symbols and punctuation separate tokens as blanks do.
    """
    return F.regexp_extract_all(F.lower(fold_forms(c)), F.lit(_TOKEN), F.lit(1))


def loan_tokens(tokens: Column) -> Column:
    """Tokens holding a Latin letter."""
    return F.filter(tokens, lambda t: t.rlike("[a-z]"))


def words(c: Column) -> Column:
    """Blank-separated words, as str.split gives them."""
    return F.filter(F.split(c, BLANK + "+"), lambda t: t != "")


def sentences(c: Column) -> Column:
    """Sentences with their end marks; a line end also closes one."""
    parts = F.regexp_extract_all(c, F.lit("([^.!?。！？\\n]+[.!?。！？]*)"), F.lit(1))
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s.rlike(r"[^\s.!?。！？]"))


@lru_cache(maxsize=1)
def _entities_udf():
    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        from html import unescape

        return pa.array([None if t is None else unescape(t) for t in texts.to_pylist()], pa.string())

    return decode


def decode_entities(c: Column) -> Column:
    """Named and numeric character references as their characters; a hard blank becomes a plain one.

    Texts without references that five built-in replacements do not know stay out of Python.
    """
    rare = c.rlike(r"&(?!(?:nbsp|lt|gt|quot|amp);)[#a-zA-Z]")
    plain = c
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(rare, F.translate(_entities_udf()(F.when(rare, c)), "\u00a0", " ")).otherwise(plain)


def strip_tags(c: Column) -> Column:
    """Text of a web page: scripts, styles, comments and tags out, character references decoded."""
    x = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    x = decode_entities(F.regexp_replace(x, r"<[^>]*>", " "))
    return F.trim(F.regexp_replace(x, r"[ \t\r\n]+", " "))
