"""Column selection and null fills (the preprocessing and baseline jobs)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .drift import to_long
from .ranking import exact_quantiles


def keep_columns(df: DataFrame, allow: Sequence[str], order: str = "input") -> DataFrame:
    """Keep the allow-listed columns that exist.

    ``order="input"`` keeps the frame's order (preprocessing);
    ``order="list"`` follows the allow-list (baseline export).
    """
    allowed = set(allow)
    if order == "input":
        cols = [c for c in df.columns if c in allowed]
    elif order == "list":
        present = set(df.columns)
        cols = [c for c in allow if c in present]
    else:
        raise ValueError(f"order must be 'input' or 'list', not {order!r}")
    return df.select(*cols)


def fill_constants(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """One ``na.fill`` for all columns (also replaces NaN in numeric ones).

    Every named column must exist, as in the reference job; a missing one
    fails with Spark's unresolved-column error.
    """
    missing = [c for c in fills if c not in df.columns]
    if missing:
        # Same failure as selecting a column that does not exist.
        df.select(*missing)
    return df.na.fill(dict(fills)) if fills else df


def medians(df: DataFrame, cols: Sequence[str], relative_error: float = 0.01,
            exact: bool = False) -> dict:
    """Median per column, an actual element of the column (no averaging).

    ``exact=False``: one multi-column ``approxQuantile`` job (bounded sketch
    per column). ``exact=True``: distributed order statistics, the element
    at rank ceil(n / 2) - 1, which is what an exact ``approxQuantile``
    returns. All-null columns have no median and are skipped.
    """
    cols = list(cols)
    if not cols:
        return {}
    if exact:
        stats = exact_quantiles(to_long(df, cols), "column", "value", [0.5], "lower")
        return {c: stats[c]["quantiles"][0] for c in cols if c in stats}
    found = df.approxQuantile(cols, [0.5], relative_error)
    return {c: q[0] for c, q in zip(cols, found) if q}


def fill_median(df: DataFrame, cols: Sequence[str], relative_error: float = 0.01,
                exact: bool = False) -> DataFrame:
    """Fill numeric nulls with the column median; the fill is cast to the
    column's type by ``na.fill`` (2.5 into an int column gives 2)."""
    meds = medians(df, cols, relative_error, exact)
    return df.na.fill({c: float(v) for c, v in meds.items()}) if meds else df


def fill_unknown(df: DataFrame, cols: Sequence[str], token: str = "Unknown") -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.fill({c: token for c in present}) if present else df
