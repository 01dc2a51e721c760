"""Verification and file-stream queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import IngestError, ingest
from ..operators.merge import BUCKET, create_keyed_table, merge_buckets
from ..operators.verify import check_records, keyed_diff, multiset_diff, reconcile_counts
from ..session import unique_name, work_path
from ..spec import IngestSpec, TargetColumn as C
from ..streaming.file_stream import ingest_stream, loaded
from . import fixtures as fx
from .fixtures import DEFECT_PRICE, DEFECT_PRIORITY, DEFECT_RAGGED, DEFECT_STATUS
from .ingest_queries import CUSTOMER_SPEC, ORDERS_SPEC
from .registry import query

EVENTS_SPEC = IngestSpec(
    name="events", target_table="stg_events",
    columns=(C("event_id", "bigint", False), C("user_id", "bigint"), C("event_type", "varchar(16)", False),
             C("value", "double"), C("props", "string")),
    field_mappings=(("event_id", "event_id"), ("user_id", "user_id"), ("event_type", "event_type"),
                    ("value", "value"), ("props", "props")))


@query("file_stream_load", """
SELECT event_id, user_id, event_type, value, props FROM events
""", covers="S07 files arriving in a folder, each loaded once, processed files archived")
def file_stream_load(spark: SparkSession, sf: str) -> DataFrame:
    incoming = fx.events_arrivals(spark, sf)
    root = work_path(spark, "events-stream")
    q = ingest_stream(spark, EVENTS_SPEC, incoming, f"{root}/sink", f"{root}/checkpoint",
                      max_files_per_trigger=2, archive_dir=f"{root}/archive")
    q.awaitTermination()
    return loaded(spark, f"{root}/sink", EVENTS_SPEC)


@query("file_stream_keys", """
SELECT c_custkey AS custkey, c_name AS name, CAST(c_acctbal AS DECIMAL(15,2)) AS acctbal,
       count(*) OVER () AS max_id, CAST(2 AS BIGINT) AS batches_loaded, CAST(1 AS BIGINT) AS batches_refused,
       count(*) FILTER (c_nationkey = 3) OVER () AS keys_refused FROM customer
""", covers="S07 K06 K08 V07 arriving files with keyed state: ids go on, a key repeated over two files is refused, an audit row per batch")
def file_stream_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Four files of customers arrive, then one that spells known names another way."""
    root, audit = work_path(spark, "keyed-stream"), unique_name("stream_audit")
    spec = CUSTOMER_SPEC.with_options(unique_key=("name",), surrogate_id="id")
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")

    def arrive(rows: DataFrame, files: int) -> None:
        rows.repartition(files).write.mode("append").option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/incoming")

    def run() -> None:
        ingest_stream(spark, spec, f"{root}/incoming", f"{root}/sink", f"{root}/checkpoint", max_files_per_trigger=2,
                      audit_table=audit).awaitTermination()

    for part in range(4):
        arrive(c.where(F.col("c_custkey") % 4 == part), 1)
    run()
    again = c.where("c_nationkey = 3").withColumn("c_name", F.concat(F.upper("c_name"), F.lit("  ")))
    arrive(again, 1)
    try:
        run()
    except StreamingQueryException as e:
        if "unique key" not in str(e):
            raise
    told = spark.table(audit).agg(F.count_if(F.col("status") == "ok").alias("batches_loaded"), F.count_if(F.col("status") == "failed").alias("batches_refused"),
                                  F.sum(F.when(F.col("status") == "failed", F.col("rows_read"))).alias("keys_refused")).first()
    top = spark.read.parquet(f"{root}/sink").agg(F.max("id")).first()[0]
    return loaded(spark, f"{root}/sink", spec).select("custkey", "name", "acctbal", F.lit(top).cast("bigint").alias("max_id"),
                                                      *[F.lit(told[k]).cast("bigint").alias(k) for k in ("batches_loaded", "batches_refused", "keys_refused")])


@query("reconcile_counts", """
SELECT count(*) AS source_rows, count(*) AS loaded_rows, TRUE AS counts_match FROM orders
""", covers="V01 V02 V03 G01 G05 source rows vs rows loaded by two loads")
def reconcile_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    a, b = fx.orders_split(spark, sf)
    t = unique_name("stg_orders")
    ingest(spark, ORDERS_SPEC, a, mode="replace", table=t, on_bad="fail")
    ingest(spark, ORDERS_SPEC, b, mode="append", table=t, on_bad="fail")
    return reconcile_counts(fx.table(spark, sf, "orders"), spark.table(t))


_DIFF_A = """SELECT o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(15,2)) AS totalprice,
  o_orderpriority AS priority FROM orders"""
_DIFF_B = """SELECT CASE WHEN day(o_orderdate) = 4 THEN NULL ELSE o_orderstatus END AS status,
  CAST(CASE WHEN day(o_orderdate) = 3 THEN CAST(o_totalprice AS DECIMAL(15,2)) + 0.01
       ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS totalprice,
  CASE WHEN day(o_orderdate) = 2 AND o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS priority
  FROM orders"""


@query("column_multiset_diff", f"""
WITH a AS ({_DIFF_A}), b AS ({_DIFF_B}),
cells AS (
  SELECT 'a' AS side, 'status' AS column_name, coalesce(status, '') AS value FROM a
  UNION ALL SELECT 'a', 'totalprice', coalesce(CAST(totalprice AS VARCHAR), '') FROM a
  UNION ALL SELECT 'a', 'priority', coalesce(priority, '') FROM a
  UNION ALL SELECT 'b', 'status', coalesce(status, '') FROM b
  UNION ALL SELECT 'b', 'totalprice', coalesce(CAST(totalprice AS VARCHAR), '') FROM b
  UNION ALL SELECT 'b', 'priority', coalesce(priority, '') FROM b)
SELECT column_name, value, count(*) FILTER (WHERE side = 'a') AS n_a, count(*) FILTER (WHERE side = 'b') AS n_b
FROM cells GROUP BY 1, 2 HAVING count(*) FILTER (WHERE side = 'a') <> count(*) FILTER (WHERE side = 'b')
""", covers="V04 U02 X14 L01 per-column multiset equality, NULL as '', decimals compared at one scale")
def column_multiset_diff(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    day = F.dayofmonth("o_orderdate")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    a = o.select(F.col("o_orderstatus").alias("status"), price.alias("totalprice"),
                 F.col("o_orderpriority").alias("priority"))
    b = o.select(F.when(day == 4, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
                 F.when(day == 3, price + F.lit(Decimal("0.01"))).otherwise(price).cast("decimal(15,2)").alias("totalprice"),
                 F.when((day == 2) & (F.col("o_orderpriority") == "1-URGENT"), F.lit("2-HIGH"))
                  .otherwise(F.col("o_orderpriority")).alias("priority"))
    d = multiset_diff(a, b, ["status", "totalprice", "priority"], types={"totalprice": "decimal(15,2)"})
    return d.select(F.col("column").alias("column_name"), "value", "n_a", "n_b")


_EXP = """SELECT CASE WHEN c_nationkey = 11 AND c_mktsegment = 'BUILDING' THEN c_custkey + 1000000000
                      ELSE c_custkey END AS custkey,
  CAST(CASE WHEN c_nationkey = 7 AND c_mktsegment = 'AUTOMOBILE' THEN c_acctbal + 1 ELSE c_acctbal END
       AS DECIMAL(15,2)) AS acctbal,
  CASE WHEN c_nationkey = 9 THEN NULL WHEN c_nationkey = 13 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment
  FROM customer"""


@query("record_check", f"""
WITH e AS ({_EXP})
SELECT e.custkey, c.c_custkey IS NOT NULL AS found,
  CASE WHEN c.c_custkey IS NULL THEN ''
       ELSE concat_ws(',', CASE WHEN e.acctbal <> CAST(c.c_acctbal AS DECIMAL(15,2)) THEN 'acctbal' END,
                           CASE WHEN e.segment IS NOT NULL AND e.segment <> c.c_mktsegment THEN 'segment' END) END
    AS mismatched,
  c.c_custkey IS NOT NULL AND e.acctbal = CAST(c.c_acctbal AS DECIMAL(15,2))
    AND (e.segment IS NULL OR e.segment = c.c_mktsegment) AS ok
FROM e LEFT JOIN customer c ON e.custkey = c.c_custkey
""", covers="V05 F01 expected records looked up by key; NULL expectations not compared")
def record_check(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_customer")
    ingest(spark, CUSTOMER_SPEC, fx.customer_csv(spark, sf), table=t, on_bad="fail")
    c = fx.table(spark, sf, "customer")
    seg, nat = F.col("c_mktsegment"), F.col("c_nationkey")
    expected = c.select(
        F.when((nat == 11) & (seg == "BUILDING"), F.col("c_custkey") + F.lit(1_000_000_000))
         .otherwise(F.col("c_custkey")).alias("custkey"),
        F.when((nat == 7) & (seg == "AUTOMOBILE"), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
         .cast("decimal(15,2)").alias("acctbal"),
        F.when(nat == 9, F.lit(None)).when(nat == 13, F.lower(seg)).otherwise(seg).alias("segment"))
    r = check_records(spark.table(t), expected, ["custkey"], ["acctbal", "segment"])
    return r.select("custkey", "found", F.array_join("mismatched", ",").alias("mismatched"), "ok")


_GONE, _ADDED = "day(o_orderdate) = 2 AND o_orderstatus = 'P'", "day(o_orderdate) = 3 AND o_orderstatus = 'P'"
_PRICED, _BLANKED = "day(o_orderdate) = 4 AND o_orderstatus = 'P'", "day(o_orderdate) IN (4, 5) AND o_orderstatus = 'P'"


@query("keyed_compare", f"""
WITH a AS (SELECT o_orderkey AS orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS totalprice, o_orderpriority AS priority FROM orders),
b AS (SELECT o_orderkey AS orderkey, CAST(CASE WHEN {_PRICED} THEN CAST(o_totalprice AS DECIMAL(15,2)) + 1 ELSE o_totalprice END AS DECIMAL(15,2)) AS totalprice,
             CASE WHEN {_BLANKED} THEN NULL ELSE o_orderpriority END AS priority FROM orders WHERE NOT ({_GONE})
      UNION ALL SELECT -o_orderkey - 1, CAST(o_totalprice AS DECIMAL(15,2)), o_orderpriority FROM orders WHERE {_ADDED})
SELECT coalesce(a.orderkey, b.orderkey) AS orderkey, CAST(a.orderkey IS NOT NULL AS BIGINT) AS n_a, CAST(b.orderkey IS NOT NULL AS BIGINT) AS n_b,
  CASE WHEN b.orderkey IS NULL THEN 'only_a' WHEN a.orderkey IS NULL THEN 'only_b' ELSE 'values' END AS status,
  CASE WHEN a.orderkey IS NULL OR b.orderkey IS NULL THEN ''
       ELSE concat_ws(',', CASE WHEN a.totalprice <> b.totalprice THEN 'totalprice' END,
                           CASE WHEN a.priority IS DISTINCT FROM b.priority THEN 'priority' END) END AS mismatched
FROM a FULL JOIN b ON a.orderkey = b.orderkey
WHERE a.orderkey IS NULL OR b.orderkey IS NULL OR a.totalprice <> b.totalprice OR a.priority IS DISTINCT FROM b.priority
""", covers="V05 J06 two tables compared by key, both ways: sums of buckets first, then the rows of differing buckets")
def keyed_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Two keyed tables; level two reads the partitions of differing buckets."""
    o = fx.table(spark, sf, "orders").select("*", *[F.expr(e).alias(n) for n, e in (("gone", _GONE), ("added", _ADDED), ("priced", _PRICED), ("blanked", _BLANKED))])
    price = F.col("o_totalprice").cast("decimal(15,2)")
    key, priority = F.col("o_orderkey").alias("orderkey"), F.col("o_orderpriority").alias("priority")
    first = o.select(key, price.alias("totalprice"), priority)
    second = o.where("not gone").select(key, F.when(F.col("priced"), price + 1).otherwise(price).cast("decimal(15,2)").alias("totalprice"),
                                        F.when(~F.col("blanked"), F.col("o_orderpriority")).alias("priority")) \
        .unionByName(o.where("added").select((-F.col("o_orderkey") - 1).alias("orderkey"), price.alias("totalprice"), priority))
    names = []
    for rows in (first, second):
        names.append(unique_name("cmp_orders"))
        create_keyed_table(spark, names[-1], "orderkey BIGINT, totalprice DECIMAL(15,2), priority STRING", ["orderkey"], buckets=64)
        merge_buckets(spark, names[-1], rows)
    d = keyed_diff(spark.table(names[0]), spark.table(names[1]), ["orderkey"], ["totalprice", "priority"], bucket=BUCKET)
    return d.withColumn("mismatched", F.array_join("mismatched", ","))


@query("load_audit", f"""
SELECT 'customers' AS spec, 'replace' AS mode, count(*) AS rows_read, count(*) AS rows_loaded,
       CAST(0 AS BIGINT) AS rows_rejected, 'ok' AS status, CAST(NULL AS VARCHAR) AS message_head,
       'fixture-customer_csv' AS source_file, TRUE AS stamped FROM customer
UNION ALL
SELECT 'orders', 'replace', count(*), CAST(0 AS BIGINT),
       count(*) FILTER (WHERE ({DEFECT_RAGGED}) OR ({DEFECT_STATUS}) OR ({DEFECT_PRICE}) OR ({DEFECT_PRIORITY})),
       'failed', 'orders: IngestError', 'fixture-orders_defects', TRUE FROM orders
UNION ALL
SELECT 'orders', 'replace', count(*), count(*), CAST(0 AS BIGINT), 'ok', CAST(NULL AS VARCHAR), 'a', TRUE
FROM orders WHERE o_orderdate < TIMESTAMP '{fx.ORDERS_SPLIT_DATE}'
""", covers="V07 X04 X16 X17 one audit row per load, failures recorded and re-raised")
def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    audit = unique_name("load_audit")
    ingest(spark, CUSTOMER_SPEC, fx.customer_csv(spark, sf), table=unique_name("stg_customer"),
           audit_table=audit, on_bad="fail")
    try:
        ingest(spark, ORDERS_SPEC, fx.orders_defects(spark, sf), table=unique_name("stg_orders"),
               audit_table=audit, on_bad="fail")
    except IngestError:
        pass  # recorded in the audit table
    a, _ = fx.orders_split(spark, sf)
    ingest(spark, ORDERS_SPEC, a, table=unique_name("stg_orders"), audit_table=audit, on_bad="fail")
    return spark.table(audit).select("spec", "mode", "rows_read", "rows_loaded", "rows_rejected", "status",
                                     F.left("message", F.lit(19)).alias("message_head"),
                                     # a rendered folder's name ends in a random part
                                     F.regexp_replace("source_file", "-[0-9a-f]{10}$", "").alias("source_file"),
                                     (F.try_to_timestamp("run_stamp", F.lit("yyyyMMdd_HHmmss")) == F.date_trunc("second", "started_at")).alias("stamped"))
