"""Character classes, word boundaries and the computed-replacement helper.

Java's own ``\\w`` and ``\\s`` are ASCII-only and ``\\b`` changed meaning between
JDK releases, so every pattern in this package spells its classes out. Look-behinds
are dear, so patterns test the next character first (``(?=[0-9])``), and steps
whose match needs a rare character ask for that character before anything else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"

STARTS_WORD = f"(?<![{WORD}])"
ENDS_WORD = f"(?![{WORD}])"
EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def replace_computed(
    col: Column, pattern: str, make: Callable[[Column], Column], group: int = 0
) -> Column:
    """``regexp_replace`` whose replacement is an expression of the match.

    The text between matches and the matches themselves are two arrays of one
    row; zipping them keeps the whole step inside the JVM and linear in the text.
    ``make`` gets capture ``group`` of each match. Rows without a match skip
    the array work.
    """
    between = F.split(col, pattern, -1)
    found = F.regexp_extract_all(col, F.lit(pattern), F.lit(group))
    woven = F.zip_with(  # one piece more than matches: the last has a null match
        between,
        found,
        lambda piece, hit: F.when(hit.isNull(), piece).otherwise(F.concat(piece, make(hit))),
    )
    return F.when(col.rlike(pattern), F.array_join(woven, "")).otherwise(col)


def has_beyond_ascii(col: Column) -> Column:
    """Two byte scans, far cheaper than any regular expression."""
    return F.octet_length(col) != F.length(col)


def lookup(mapping: dict[str, str]) -> Column:
    """A literal map column."""
    return F.create_map(*[F.lit(part) for item in mapping.items() for part in item])


def count_chars(col: Column, char_class: str) -> Column:
    """How many characters of ``col`` are in the class (no array is built)."""
    return F.length(F.regexp_replace(col, f"[^{char_class}]+", ""))


def count_char(col: Column, char: str) -> Column:
    """How often one ASCII character occurs, by bytes."""
    return F.octet_length(col) - F.octet_length(F.replace(col, F.lit(char), F.lit("")))
