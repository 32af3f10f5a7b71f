"""Cleaning and projection.

All of these are plan-time column rewrites: Catalyst folds them into the scan's
projection, so they cost nothing beyond the expression evaluation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The words a spreadsheet/CSV reader treats as "missing" by
# default (the pandas default NA list), in its own order.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def null_token_expr(col: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def null_tokens(df: DataFrame, cols: Iterable[str] | None = None,
                tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """NA-like words become null (what a workbook reader does implicitly)."""
    cols = list(cols) if cols is not None else string_columns(df)
    toks = list(tokens)
    return df.withColumns({c: null_token_expr(c, toks).alias(c) for c in cols})


def fill_missing(df: DataFrame, value: str = "", cols: Iterable[str] | None = None) -> DataFrame:
    """Nulls in string columns become ``value`` (empty string = missing)."""
    cols = list(cols) if cols is not None else string_columns(df)
    return df.na.fill(value, subset=cols) if cols else df


def ensure_column(df: DataFrame, name: str, default: str = "") -> DataFrame:
    """Add ``name`` with ``default`` only when the frame lacks it."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast("string"))


def blank_column(df: DataFrame, name: str) -> DataFrame:
    """C4: overwrite (or add) ``name`` with the empty string."""
    return df.withColumn(name, F.lit("").cast("string"))


def rename(df: DataFrame, mapping: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rename columns; ``strict`` raises on a missing source column."""
    missing = [k for k in mapping if k not in df.columns]
    if strict and missing:
        raise KeyError(f"cannot rename missing columns: {missing}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def project(df: DataFrame, cols: Iterable[str], key: str | None = None) -> DataFrame:
    """Keep ``cols``, always carrying the key first."""
    cols = list(cols)
    if key is not None and key not in cols:
        cols = [key] + cols
    return df.select(*cols)


def require_columns(df: DataFrame, exact: Iterable[str], allow: Iterable[str] = ()) -> DataFrame:
    """Plan-time check that the frame has exactly ``exact`` (plus ``allow``)."""
    want = set(exact)
    have = set(df.columns)
    missing = sorted(want - have)
    extra = sorted(have - want - set(allow))
    if missing or extra:
        raise ValueError(f"column mismatch: missing={missing} extra={extra}")
    return df
