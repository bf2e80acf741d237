"""Text cleaning and article fields as native expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.columns import as_col

# Every character Python's str.strip()/split() treats as blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Every character str.splitlines() breaks on.
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85  "

# A run of the same blanks. The lookahead turns printable ASCII away on one range
# test; the class itself is checked for the few characters left.
_GAP = r"(?![!-~])[\t-\r\x1c-\x20\x85\xa0  -     　]+"

ARTICLE_LINES = ("headline", "category", "authors", "pub_date", "short_description", "link")
PREVIEW_CHARS = 500


def strip(c: Column | str) -> Column:
    """Trim all Unicode blanks at both ends (Spark's own trim removes spaces only)."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def decode_text(raw: Column | str) -> Column:
    """Bytes as UTF-8 where valid, else as Latin-1."""
    raw = as_col(raw)
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))


def skip_reason(text: Column | str) -> Column:
    return F.when(strip(text) == "", F.lit("empty_file"))


def clean_text(text: Column | str) -> Column:
    """Lower-case, unify line ends, strip lines, collapse blank runs; null for blank text."""
    text = as_col(text)
    t = F.regexp_replace(F.lower(text), "\r\n?", "\n")
    t = F.array_join(F.transform(F.split(t, "\n"), strip), "\n")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, "[ \t]+", " ")
    # Blankness is tested on the raw text: a filter on it stays cheap when pushed down.
    return F.when(strip(text) != "", F.concat(strip(t), F.lit("\n")))


def word_count(text: Column | str) -> Column:
    """Words between runs of blanks, as ``len(text.split())``."""
    body = strip(text)
    return F.when(body == "", F.lit(0)).otherwise(F.regexp_count(body, F.lit(_GAP)) + 1)


def split_lines(text: Column | str) -> Column:
    """``str.splitlines``: any line break, and no empty tail after a final break."""
    text = as_col(text)
    parts = F.split(text, f"\r\n|[{LINE_BREAKS}]")
    ends_open = F.element_at(parts, -1) != ""
    return F.when(ends_open, parts).otherwise(F.slice(parts, F.lit(1), F.size(parts) - 1))


def non_empty_lines(lines: Column) -> Column:
    return F.filter(F.transform(lines, strip), lambda line: line != "")


def format_article(record: Column | None = None) -> Column:
    """Six lines: headline, category, authors, date, short_description, link."""
    names = ("headline", "category", "authors", "date", "short_description", "link")
    field = (lambda n: F.col(n)) if record is None else (lambda n: record[n])
    lines = [F.concat(strip(F.coalesce(field(n).cast("string"), F.lit(""))), F.lit("\n")) for n in names]
    return F.concat(*lines)


def truncate_bytes(c: Column | str, limit: int) -> Column:
    """Longest prefix whose UTF-8 form fits ``limit`` bytes; null becomes empty."""
    s = F.coalesce(as_col(c), F.lit(""))
    raw = s.cast("binary")
    # A character has at most 4 bytes, so one of these four cuts is a boundary.
    cuts = [F.substring(raw, 1, limit - k).cast("string") for k in range(4) if limit - k >= 0]
    clipped = F.coalesce(*[F.when(F.is_valid_utf8(cut), cut) for cut in cuts])
    return F.when(F.octet_length(s) <= limit, s).otherwise(clipped)
