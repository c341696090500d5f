"""String expressions. Each takes and returns a ``Column``.

Most patterns avoid look-around and back-references, so they mean the same in
Java and in RE2 engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python's str.strip()/str.split() treat as blank.
BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
NON_BLANK = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(text: Column) -> Column:
    """Runs of blanks become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{BLANK}+", " "))


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(NON_BLANK)


def norm_label(label: Column) -> Column:
    """Stripped lower-case label text; a missing label reads ``nan``."""
    return F.lower(strip(F.coalesce(label.cast("string"), F.lit("nan"))))


def default_text(text: Column, default: str) -> Column:
    """``default`` for a missing or empty value."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def first_truthy(*texts: Column) -> Column:
    """First text that is neither missing nor empty, else the last one as it is."""
    *head, last = texts
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in head], last)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{NON_BLANK}+")), F.lit(0))


def has_words(text: Column, n: int) -> Column:
    """At least ``n`` words; reads no further than the ``n``-th."""
    if n <= 0:
        return F.lit(True)
    pattern = f"^{BLANK}*+(?:{NON_BLANK}++{BLANK}++){{{n - 1}}}{NON_BLANK}"
    return F.coalesce(text.rlike(pattern), F.lit(False))


def words_lower(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cap(text: Column, chars: int) -> Column:
    return F.left(text, F.lit(chars))


def chunks(text: Column, size: int) -> Column:
    """Pieces of ``size`` characters in text order; an empty text has none. One pass over the text, however long it is."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{int(size)}}}"), F.lit(0))
    return F.coalesce(pieces, F.array().cast("array<string>"))


def rejoin(pieces: Column) -> Column:
    return F.array_join(pieces, " ")


def sorted_set(items: Column, separator: str = ", ") -> Column:
    """Distinct items in code-point order as one string."""
    return F.array_join(F.sort_array(F.array_distinct(items)), separator)


def percent(part: Column, total: Column) -> Column:
    return part.cast("double") / F.greatest(total, F.lit(1)).cast("double") * 100
