"""Table constraints that Parquet tables do not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_col(c: str | Column, collation: str | None, df: DataFrame | None = None) -> Column:
    """A key column, compared under ``collation`` when it is a string."""
    col = F.col(f"`{c}`") if isinstance(c, str) else c
    if not collation:
        return col
    if df is not None and isinstance(c, str) and df.schema[c].dataType.typeName() != "string":
        return col
    return F.collate(col, collation)


def normalized_key(c: str | Column) -> Column:
    """Binary-comparable form of a case/trailing-space-insensitive key."""
    col = F.col(f"`{c}`") if isinstance(c, str) else c
    return F.lower(F.rtrim(col.cast("string")))


def check_unique(df: DataFrame, keys: tuple[str, ...] | list[str],
                 collation: str | None = "UNICODE_CI_AI_RTRIM") -> DataFrame:
    """Key groups seen more than once (K06): keys (in one stored spelling),
    ``n`` and the number of distinct spellings. The partial aggregate
    collapses a hot key before the shuffle. As in a SQL unique key, a key with
    a NULL part equals no other."""
    grouped = [key_col(k, collation, df).alias(k) for k in keys]
    # distinct spellings are counted by Spark's two-level distinct
    # aggregation: no per-key set is ever held in one row
    spelling = F.struct(*[F.col(f"`{k}`").cast("string") for k in keys])
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    return (df.filter(whole).groupBy(*grouped)
              .agg(F.count(F.lit(1)).alias("n"), F.countDistinct(spelling).alias("n_spellings"))
              .filter(F.col("n") > 1))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows holding NULL in a NOT NULL column (K09), with the column names."""
    nulls = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in cols]))
    return df.withColumn("null_columns", nulls).filter(F.size("null_columns") > 0)
