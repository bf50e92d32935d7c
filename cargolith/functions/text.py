"""String columns: title case, name folding, trimmed identifiers."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_id(c: Column) -> Column:
    """Trimmed upper-case identifier."""
    return F.upper(F.trim(c.cast("string")))


def text_or(c: Column, default: str = "Unknown") -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def title_case(c: Column) -> Column:
    """Capital at the start of every letter run, also after ``-`` and ``'``
    (``initcap`` looks at blanks only)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    shaped = F.transform(
        runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))
    )
    return F.array_join(shaped, "")


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions (NFKD) of all code points with an ASCII remainder, found by rule.

    One-letter remainders go to a ``translate`` table; longer ones (ligatures, fractions,
    squared units) to a map.
    """
    source, target, longer = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        if not unicodedata.decomposition(char):
            continue
        ascii_part = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            source.append(char)
            target.append(ascii_part)
        elif ascii_part:
            longer[char] = ascii_part
    return "".join(source), "".join(target), longer


def ascii_fold(c: Column) -> Column:
    """Accents removed and other non-ASCII characters dropped, JVM-side."""
    source, target, longer = _fold_tables()
    # One literal, folded to a map; only texts that hold such a character are taken apart.
    table = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in longer.items())), F.lit("\x01"), F.lit("\x02"))
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    spelled = F.when(c.rlike(f"[{''.join(longer)}]"), spelled).otherwise(c)
    folded = F.regexp_replace(F.translate(spelled, source, target), r"[^\x00-\x7F]", "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)


def fold_name(c: Column) -> Column:
    """Join key for party names: ASCII, punctuation to blanks, single-spaced, lower."""
    spaced = F.regexp_replace(ascii_fold(F.trim(c)), r"[^\w\s]", " ")
    return F.trim(F.lower(F.regexp_replace(spaced, r"\s+", " ")))
