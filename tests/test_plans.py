"""Plan shapes the scale design depends on (checked with explain)."""

import contextlib
import io

from pyspark.sql import functions as F

from fundlake.operators import allocation as al


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _holdings(spark):
    return spark.range(0, 2000).select(
        (F.col("id") % 3).alias(al.PID), F.concat(F.lit("h"), F.col("id").cast("string")).alias("holding_name"),
        (F.col("id") % 4).cast("string").alias("asset_type"), (F.col("id") % 5).cast("string").alias("sector"),
        (F.col("id") % 2).cast("string").alias("currency"), (F.col("id") * 1.5).cast(al.MONEY).alias("market_value"))


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(al.top_positions(_holdings(spark), 10))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_subtotals_are_one_grouping_sets_pass(spark):
    plan = _plan(al.subtotals(_holdings(spark)))
    assert plan.count("Expand") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_statement_scan_windows_are_blocked(spark):
    import re
    from fundlake.operators.scan import ordered_scan
    df = spark.range(0, 100).select((F.col("id") % 2).cast("string").alias("doc_id"),
                                   (F.col("id") / 30).cast("int").alias("blk"),
                                   F.col("id").alias("line_no"), (F.col("id") % 7).alias("v"))
    plan = _plan(ordered_scan(df, ["doc_id"], ["blk"], ["line_no"], forward={"f": F.col("v")}))
    # windows over lines are partitioned by (document, block); only the
    # block summaries are windowed by document alone
    parts = re.findall(r"Window \[.*?windowspecdefinition\(([^,]+), ([^,]+),", plan)
    assert any(p[0].startswith("doc_id") and p[1].startswith("blk") for p in parts), parts


def test_unique_check_aggregates_before_the_shuffle(spark):
    from fundlake.operators.constraints import check_unique
    df = spark.range(0, 1000).select((F.col("id") % 3).cast("string").alias("k"))
    plan = _plan(check_unique(df, ["k"]))
    first_exchange = plan.index("Exchange")
    assert "partial_count" in plan[first_exchange:]  # printed below (= runs before) the exchange
