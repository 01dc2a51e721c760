"""The reference's entry points as plain functions over the library.

* ``import_web_classfees``: class-fee file -> ``FundClassFee`` (truncate by
  default), then its read procedure (optionally merging into a target).
* ``import_web_hold``: holdings file -> ``holdweb`` (append by default).
* ``extract_holdings``: statement text files -> holdings rows -> CSV with a
  header and no index column; returns the number of rows written, counted
  while writing (no second pass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.ingest import LoadResult, ingest
from .operators.statements import statement_holdings
from .sources.statements import read_statement_lines
from .spec import CLASS_FEES, HOLDINGS


def import_web_classfees(spark: SparkSession, path: str, mode: str = "replace", on_bad: str = "fail",
                         audit_table: str | None = None, merge_type: str | None = None,
                         target_table: str | None = None) -> LoadResult:
    params = {"merge_type": merge_type, "target_table": target_table} if merge_type else None
    return ingest(spark, CLASS_FEES, path, mode=mode, on_bad=on_bad, audit_table=audit_table,
                  procedure_params=params)


def import_web_hold(spark: SparkSession, path: str, mode: str = "append", on_bad: str = "fail",
                    audit_table: str | None = None) -> LoadResult:
    return ingest(spark, HOLDINGS, path, mode=mode, on_bad=on_bad, audit_table=audit_table)


def extract_holdings(spark: SparkSession, statements: str, codes: DataFrame, output_csv: str) -> int:
    """Record layout: date, fund_name, fund_code, issuer, issue, currency,
    units, cost, mv."""
    h = statement_holdings(read_statement_lines(spark, statements), codes)
    cols = ["date", "fund_name", "fund_code", "issuer", "issue", "currency", "units", "cost", "mv"]
    obs = Observation("extract_holdings")
    h.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .option("header", "true").csv(output_csv)
    return int(obs.get["rows"])
