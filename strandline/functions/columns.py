"""Safe casts, date parsing, name normalisation and ordered rules as Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted date layouts, in matching order.
DATE_FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd")

# Fixed values: (pattern, borough) pairs, first match wins.
LOCATION_RULES = (
    ("(?i)harlem|upper_east|upper_west|manhattan", "MANHATTAN"),
    ("(?i)brooklyn", "BROOKLYN"),
    ("(?i)queens", "QUEENS"),
    ("(?i)bronx", "BRONX"),
    ("(?i)staten", "STATEN ISLAND"),
)
CAMERA_RULES = (
    ("^Nd", "MANHATTAN"),
    ("^NT2", "BROOKLYN"),
    ("^NT4", "QUEENS"),
    ("^SW", "STATEN ISLAND"),
)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_column_name(name: str) -> str:
    return re.sub(r"[^a-z0-9_]", "", name.strip().lower().replace(" ", "_"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake case; two headers may not collapse into one."""
    names = [normalize_column_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1 or not n})
    if clashes:
        raise ValueError(f"column names collide or vanish after normalisation: {clashes}")
    return df.toDF(*names)


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that parses wins; null when none does (never raises under ANSI)."""
    return F.coalesce(*[F.try_to_date(as_col(c), f) for f in formats])


def safe_double(c: Column | str, default: float | None = None) -> Column:
    value = as_col(c).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def _integer_part(c: Column | str) -> Column:
    # "12", " 12 " and "12.0" all mean 12; going through the text keeps every
    # digit of a 64-bit id, which a detour through double would not.
    return F.nullif(F.regexp_extract(F.trim(as_col(c)), r"^([+-]?\d+)(\.\d*)?$", 1), F.lit(""))


def safe_int(c: Column | str, default: int | None = 0) -> Column:
    value = _integer_part(c).try_cast("int")
    return value if default is None else F.coalesce(value, F.lit(default))


def safe_long(c: Column | str, default: int | None = 0) -> Column:
    value = _integer_part(c).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def normalize_name(c: Column | str) -> Column:
    return F.upper(F.trim(F.coalesce(as_col(c), F.lit(""))))


def rule_map(c: Column | str, rules: Iterable[tuple[str, str]], default: str = "UNKNOWN") -> Column:
    """Ordered regex rules to a label; a null input takes the default."""
    out = None
    for pattern, label in rules:
        hit = as_col(c).rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def first_int(c: Column | str, signed: bool = False, to: str = "int") -> Column:
    """First run of digits in the text; the sign is dropped unless ``signed``."""
    pattern = r"(-?\d+)" if signed else r"(\d+)"
    return F.nullif(F.regexp_extract(as_col(c), pattern, 1), F.lit("")).try_cast(to)


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Round a double to ``digits`` decimals on its exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text of the double, so it
    turns 2.675 (stored a little below) into 2.68. Here the double is compared
    with the tie ``(2n+1)/(2*10^digits)``; where it is the double nearest to the
    tie, the sign of the representation error decides (exact two-part product).
    """
    scale = float(10**digits)
    n = F.floor(c * scale).cast("double")
    odd = n * 2.0 + 1.0
    tie = odd / (2.0 * scale)
    split = tie * 134217729.0
    hi = split - (split - tie)
    lo = tie - hi
    error = (hi * (2.0 * scale) - odd) + lo * (2.0 * scale)
    up = (
        F.when(c > tie, True)
        .when(c < tie, False)
        .when(error > 0, True)
        .when(error < 0, False)
        .otherwise(F.pmod(n, F.lit(2.0)) == 1.0)
    )
    return F.when(up, (n + 1.0) / scale).otherwise(n / scale)


def in_unsigned_range(c: Column | str, bits: int) -> Column:
    """Whether a value fits an unsigned column of 16 or 32 bits (no silent wrap)."""
    return F.coalesce(as_col(c).between(F.lit(0), F.lit(2**bits - 1)), F.lit(False))
