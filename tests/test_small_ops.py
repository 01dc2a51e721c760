"""Procedures (H02), lookups (J01), CSV sink (K10, K11) and scalars (X-items)."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from fundlake.functions import scalars as X
from fundlake.operators.lookup import with_fund_code
from fundlake.operators.procedures import run_procedure
from fundlake.session import unique_name
from fundlake.sinks.tables import create_table, replace_table_data, write_csv


def test_procedure_rejects_unknown_parameters(spark):
    t = unique_name("hold")
    create_table(spark, t, "date DATE, fund_name STRING, sec_name STRING, sector STRING, currency STRING, "
                           "units DECIMAL(21,6), cost DECIMAL(21,6), mv DECIMAL(21,6)")
    rows = spark.createDataFrame([("2024-12-31", "F", "S", "X", "CAD", 1, 2, 3),
                                  ("2024-11-30", "F", "S", "X", "CAD", 1, 2, 3)],
                                 "d string, f string, s string, x string, c string, u int, k int, m int")
    replace_table_data(spark, t, rows.select(F.col("d").cast("date").alias("date"), F.col("f").alias("fund_name"),
                                             F.col("s").alias("sec_name"), F.col("x").alias("sector"),
                                             F.col("c").alias("currency"), F.col("u").alias("units"),
                                             F.col("k").alias("cost"), F.col("m").alias("mv")))
    assert run_procedure(spark, "usp_holdweb_process", table=t, date="2024-12-31").count() == 1
    with pytest.raises(TypeError):
        run_procedure(spark, "usp_holdweb_process", table=t, flag=False)
    with pytest.raises(KeyError):
        run_procedure(spark, "no_such_procedure")


def test_fund_code_default(spark):
    holders = spark.createDataFrame([("A Fund",), ("B Fund",)], "fund_name string")
    codes = spark.createDataFrame([("A Fund", "100")], "fund_name string, fund_code string")
    got = {r.fund_name: r.fund_code for r in with_fund_code(holders, codes).collect()}
    assert got == {"A Fund": "100", "B Fund": "###"}


def test_quoted_fixed_decimal_csv(spark, tmp_dir):
    df = spark.createDataFrame([("Known 1", 5939075.4, 0.06)], "holding_name string, market_value double, wt double")
    out = write_csv(df, os.path.join(tmp_dir, "out"), quote_all=True, scale=8)
    text = "".join(open(f).read() for f in glob.glob(os.path.join(out, "part-*.csv")))
    assert '"holding_name","market_value","wt"' in text
    assert '"Known 1","5939075.40000000","0.06000000"' in text


def test_scalars(spark):
    df = spark.createDataFrame([("(1,004,212)", " Canadian National Railway ", "a/b/c.csv")], "a string, d string, p string")
    issuer, issue = X.issuer_issue(F.col("d"))
    r = df.select(X.parse_amount(F.col("a")).alias("v"), issuer.alias("i"), issue.alias("s"),
                  X.file_name(F.col("p")).alias("f"), X.non_negative(F.lit(-3)).alias("z"),
                  X.parse_amount(F.lit("‑1,5")).alias("nb")).first()
    assert float(r.v) == -1004212 and (r.i, r.s, r.f, r.z) == ("Canadian", "Railway", "c.csv", 0)
    assert float(r.nb) == -15
