"""Column expressions shared by the jobs. All are built-in Spark functions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the drift rules (must equal the reference's for equal
# decisions): PSI above 0.25 is drift, chi-square p below 0.01 is drift,
# ten PSI bins, shares clipped to [1e-6, 1].
PSI_THRESHOLD = 0.25
P_THRESHOLD = 0.01
N_BINS = 10
SHARE_FLOOR = 1e-6

# The text tokens pandas' CSV reader turns into a missing value
# by default, in its own order.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_share(count: Column, total: Column) -> Column:
    """count / max(total, 1), clipped to [SHARE_FLOOR, 1]."""
    share = count.cast("double") / F.greatest(total, F.lit(1)).cast("double")
    return F.least(F.greatest(share, F.lit(SHARE_FLOOR)), F.lit(1.0))


def psi_status(psi: Column) -> Column:
    """Strict comparison; a missing PSI means the data was insufficient."""
    return (F.when(psi.isNull() | F.isnan(psi), F.lit("insufficient_data"))
             .when(psi > F.lit(PSI_THRESHOLD), F.lit("drift"))
             .otherwise(F.lit("ok")))


def p_status(p: Column) -> Column:
    return (F.when(p.isNull(), F.lit("insufficient_data"))
             .when(p < F.lit(P_THRESHOLD), F.lit("drift"))
             .otherwise(F.lit("ok")))


def as_category(c: str | Column) -> Column:
    """Categorical value as text; a null is its own category 'nan'."""
    return F.coalesce(col_(c).cast("string"), F.lit("nan"))


def sum_plus(cols: Sequence[str], k: int = 1) -> Column:
    """Sum of columns plus a constant (family size = siblings + parents + 1)."""
    total = F.lit(k)
    for c in cols:
        total = total + F.col(c)
    return total


def family_size(a: str, b: str) -> Column:
    return sum_plus([a, b], 1)


def is_alone(a: str, b: str) -> Column:
    """1 when both counts sum to zero, else 0 (a null sum gives 0)."""
    return F.when((F.col(a) + F.col(b)) == 0, F.lit(1)).otherwise(F.lit(0))


def hash_bucket(key: str | Column, seed: int, modulus: int = 1000) -> Column:
    """Stable bucket in [0, modulus): the first 8 hex digits of ``md5(key:seed)``.

    Unlike ``randomSplit`` the result depends on the key only, not on the
    partitioning, so a split survives re-partitioning and task retries, and any
    SQL engine with md5 gives the same one.
    """
    digest = F.md5(F.concat(col_(key).cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(modulus)).cast("int")


def hash_split(key: str | Column, seed: int = 42, train_fraction: float = 0.8,
               modulus: int = 1000) -> Column:
    """True for the training side."""
    return hash_bucket(key, seed, modulus) < F.lit(int(round(train_fraction * modulus)))


# What a number looks like in text. Spark's own cast also takes a trailing D or F
# ("33D"), which is a product code and not a number.
WHOLE = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(inf|infinity)\s*$"


def parse_double(c: str | Column) -> Column:
    """Text to double by ``NUMBER``; null when it is none."""
    v = col_(c).cast("string")
    return F.when(F.lower(v).rlike(NUMBER), F.trim(v).try_cast("double"))


def tolerant_double(c: str | Column, default: float | None = 0.0) -> Column:
    """Parse text to double; unparsable text gives ``default`` (ANSI-safe)."""
    parsed = parse_double(c)
    return parsed if default is None else F.coalesce(parsed, F.lit(float(default)))


def tolerant_int(c: str | Column, default: int | None = 0) -> Column:
    parsed = parse_double(c).try_cast("int")
    return parsed if default is None else F.coalesce(parsed, F.lit(int(default)))


def na_to_null(c: str | Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Null for any of the NA tokens (Spark's CSV ``nullValue`` takes one)."""
    v = col_(c)
    return F.when(v.isin(list(tokens)), F.lit(None).cast("string")).otherwise(v)


def utc_iso_now() -> Column:
    """Current time in UTC as ``yyyy-MM-ddTHH:mm:ssZ``."""
    tz = F.current_timezone()
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), tz),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
