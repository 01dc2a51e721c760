"""Named procedures run after a load (H02), and the two shipped read
procedures (P04, P05) plus keyed lookup (F01).

A procedure is a Python function ``fn(spark, table=..., **params) ->
DataFrame`` registered under a name. Parameters are passed by name; unknown
names are rejected before anything runs.
"""

from __future__ import annotations

import inspect
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constraints import key_col

PROCEDURES: dict[str, Callable[..., DataFrame]] = {}


def procedure(name: str):
    def register(fn):
        PROCEDURES[name] = fn
        return fn
    return register


def run_procedure(spark: SparkSession, name: str, **params) -> DataFrame:
    if name not in PROCEDURES:
        raise KeyError(f"unknown procedure {name!r}")
    fn = PROCEDURES[name]
    sig = inspect.signature(fn)
    accepted = set(list(sig.parameters)[1:])
    unknown = set(params) - accepted
    if unknown:
        raise TypeError(f"procedure {name} takes no parameter(s) {sorted(unknown)}")
    return fn(spark, **params)


def lookup(df: DataFrame, keys: dict[str, object], collation: str | None = None) -> DataFrame:
    """Keyed equality lookup (F01). Without a collation the predicate is a
    plain equality that reaches the Parquet scan as a pushed filter."""
    cond = F.lit(True)
    for k, v in keys.items():
        cond = cond & (key_col(k, collation) == (F.collate(F.lit(v), collation) if collation else F.lit(v)))
    return df.filter(cond)


# The column lists of the reference's two read procedures.
CLASS_FEE_COLUMNS = ("FundCode", "FundName", "Class", "Description", "Mer", "Trailer",
                     "PerformanceFee", "MinInvestmentInitial", "MinInvestmentSubsequent", "Currency")
HOLDING_COLUMNS = ("date", "fund_name", "sec_name", "sector", "currency", "units", "cost", "mv")


@procedure("usp_FundClassFee_Load")
def class_fees(spark: SparkSession, table: str = "FundClassFee", merge_type: str | None = None,
               target_table: str | None = None) -> DataFrame:
    """The class-fee projection. With ``merge_type`` (append | replace)
    and ``target_table`` it first merges the staged rows into the target by
    ``(FundCode, Class)`` under the case-insensitive collation (K07)."""
    staged = spark.table(table).select(*CLASS_FEE_COLUMNS)
    if merge_type:
        from .merge import merge_table
        if not target_table:
            raise ValueError("merge_type needs target_table")
        return merge_table(spark, target_table, staged, ("FundCode", "Class"), merge_type,
                           "UNICODE_CI_AI_RTRIM").select(*CLASS_FEE_COLUMNS)
    return staged


@procedure("usp_holdweb_process")
def holdings(spark: SparkSession, table: str = "holdweb", date: str | None = None) -> DataFrame:
    """The holdings projection, optionally for one statement date."""
    df = spark.table(table).select(*HOLDING_COLUMNS)
    if date is not None:
        df = df.filter(F.col("date") == F.lit(date).cast("date"))
    return df
