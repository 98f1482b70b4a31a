"""Text column functions: trimming, ASCII keys, success words, years in text."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column, functions as F

from riskloom.vocabulary import COUNTRY_ALIASES, SUCCESS_OUTCOMES

_SPACES = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())
_NON_ASCII = r"[^\x00-\x7F]"


def strip_text(value: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.trim(value.cast("string"), F.lit(_SPACES))


def literal_map(items: Mapping[str, str]) -> Column:
    """Constant map of texts, built from one literal so that the plan stays small; Spark folds it into a constant."""
    joined = "\x01".join(f"{k}\x02{v}" for k, v in items.items())
    return F.str_to_map(F.lit(joined), F.lit("\x01"), F.lit("\x02"))


def _any_of(chars: Iterable[str]) -> str:
    """Regular expression for one of ``chars``, written as ranges of code points."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


@cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition holds ASCII, split by how many ASCII characters it holds."""
    single, target, several = [], [], {}
    for point in range(128, sys.maxunicode + 1):
        char = chr(point)
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if c.isascii())
        if len(kept) == 1:
            single.append(char)
            target.append(kept)
        elif kept:
            several[char] = kept
    return "".join(single), "".join(target), several


def ascii_fold(value: Column) -> Column:
    """Compatibility-decompose and drop everything outside ASCII. Rows that are ASCII already take a short way."""
    single, target, several = _ascii_forms()
    folded = F.translate(value, single, target)
    pairs = literal_map(several)
    spelled = F.array_join(
        F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), ""
    )
    return F.when(
        value.rlike(_NON_ASCII),
        F.regexp_replace(F.when(folded.rlike(_any_of(several)), spelled).otherwise(folded), _NON_ASCII, ""),
    ).otherwise(value)


def clean_key(value: Column) -> Column:
    """Join key of a name: trimmed, lower case, ASCII only."""
    return ascii_fold(F.lower(strip_text(value)))


def alias_key(value: Column, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> Column:
    """Join key of a name after replacing the spellings listed in ``aliases``; a curly apostrophe counts as straight."""
    key = ascii_fold(F.replace(F.lower(strip_text(value)), F.lit("’"), F.lit("'")))
    return F.coalesce(F.try_element_at(literal_map(aliases), key), key)


def compare_text(key: Column) -> Column:
    """Form of a key that names are compared in: other characters than letters, digits and ``_`` become blanks."""
    return F.trim(F.lower(F.regexp_replace(key, r"[^\w]", " ")))


def year_in_text(value: Column) -> Column:
    """First run of four digits as a number."""
    return F.nullif(F.regexp_extract(value.cast("string"), r"([0-9]{4})", 1), F.lit("")).cast("int")


def is_success(outcome: Column) -> Column:
    """1 for an outcome that counts as success, 0 for any other, also for a missing one."""
    return F.coalesce(F.lower(strip_text(outcome)).isin(*SUCCESS_OUTCOMES), F.lit(False)).cast("int")
