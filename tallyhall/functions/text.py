"""Column expressions for text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

# The characters Python's str.split() and str.strip() treat as blank.
BLANKS = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
# The same characters as patterns. Those of ASCII stand one by one: the engine looks such up in a table, but asks ranges in turn.
_ASCII, _OTHER = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20", r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ASCII_BLANK, BLANK = f"[{_ASCII}]", f"[{_ASCII}{_OTHER}]"
ASCII_WORD, WORD = f"[^{_ASCII}]+", f"[^{_ASCII}{_OTHER}]+"
# Holds every blank that is not of ASCII, and more, in one range.
_NEAR_OTHER = r"[\x85\xa0\u1680-\u3000]"

# Texts that a pandas CSV reader takes as missing by default.
PANDAS_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def plain(text: Column) -> Column:
    """True only for text without other blanks than those of ASCII; most has none, and is split and counted in a fraction of the time."""
    return (F.octet_length(text) == F.length(text)) | ~F.rlike(text, F.lit(_NEAR_OTHER))


def word_count(text: Column) -> Column:
    """Number of blank-separated words."""
    return F.when(plain(text), F.regexp_count(text, F.lit(ASCII_WORD))).otherwise(F.regexp_count(text, F.lit(WORD)))


def tokens(text: Column) -> Column:
    """Runs of a-z after lower-casing."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def text_key(owner: Column, text: Column) -> Column:
    """A 256-bit key that is equal exactly when owner and text are equal.

    Lets duplicates meet in a shuffle that carries no text. The owner's length
    comes first so that owner and text cannot run into each other; a missing
    owner equals only another missing owner.
    """
    owner = owner.cast("string")
    head = F.coalesce(F.concat(F.length(owner).cast("string"), F.lit(":"), owner), F.lit("-"))
    return F.sha2(F.concat(head, text), 256)


def mentions_any(text: Column, keywords: Sequence[str]) -> Column:
    """True if the lower-cased text contains any keyword."""
    low = F.lower(text)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(low, F.lit(word.lower()))
    return hit


def blank_out(text: Column, na_tokens: Iterable[str]) -> Column:
    """Null in place of any of the given missing-value texts."""
    marks = list(na_tokens)
    return F.when(~text.isin(marks), text) if marks else text
