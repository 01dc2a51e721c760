"""Ingestion, table and merge queries over the driver tables (S01-S08,
P01-P05, K01-K11, H01-H03, J01, F01)."""

from __future__ import annotations

from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import check_not_null, check_unique, normalized_key
from ..operators.ingest import IngestError, accepted, ingest, validate
from ..operators.lookup import with_fund_code
from ..operators.merge import BUCKET, create_keyed_table, merge_buckets, merge_table
from ..operators.procedures import lookup, run_procedure
from ..session import unique_name, work_path
from ..sinks.tables import create_table, replace_table_data, write_csv
from ..sources.delimited import read_delimited, read_headered
from ..spec import CLASS_FEES, HOLDINGS, IngestSpec, TargetColumn as C
from . import fixtures as fx
from .fixtures import DEFECT_PRICE, DEFECT_PRIORITY, DEFECT_RAGGED, DEFECT_STATUS, DUP_PADDED, DUP_UPPER
from .registry import query

CUSTOMER_SPEC = IngestSpec(
    name="customers", target_table="stg_customer",
    columns=(C("custkey", "bigint", False), C("name", "varchar(25)", False), C("nationkey", "int"),
             C("acctbal", "decimal(15,2)"), C("segment", "varchar(10)", False)),
    field_mappings=(("c_custkey", "custkey"), ("c_name", "name"), ("c_nationkey", "nationkey"),
                    ("c_acctbal", "acctbal"), ("c_mktsegment", "segment")),
    unique_key=("custkey",))

SUPPLIER_SPEC = IngestSpec(
    name="suppliers", target_table="stg_supplier",
    columns=(C("suppkey", "bigint", False), C("name", "varchar(25)", False), C("nationkey", "int"),
             C("acctbal", "decimal(15,2)")),
    field_mappings=(("s_suppkey", "suppkey"), ("s_name", "name"), ("s_nationkey", "nationkey"),
                    ("s_acctbal", "acctbal")),
    delimiter="|", quote_char="'", line_terminator=";")

NATION_SPEC = IngestSpec(
    name="nations", target_table="stg_nation",
    columns=(C("nationkey", "int", False), C("name", "varchar(25)", False), C("regionkey", "int")),
    field_mappings=(("k", "nationkey"), ("n", "name"), ("r", "regionkey")))

PART_SPEC = IngestSpec(
    name="parts", target_table="stg_part",
    columns=(C("partkey", "bigint", False), C("name", "varchar(55)"), C("brand", "varchar(10)"),
             C("type", "varchar(25)"), C("size", "int"), C("retailprice", "decimal(12,2)")),
    field_mappings=(("PartKey", "partkey"), ("Name", "name"), ("Brand", "brand"), ("Type", "type"),
                    ("Size", "size"), ("Price", "retailprice")),
    field_transformations=MappingProxyType({"Name": "UPPER(@Name)", "Type": "NULLIF(@Type, 'Closed')"}))

DOCUMENT_SPEC = IngestSpec(
    name="documents", target_table="stg_document",
    columns=(C("doc_id", "bigint", False), C("text", "string"), C("lang", "varchar(8)"),
             C("source", "string"), C("n_chars", "bigint")),
    field_mappings=(("doc_id", "doc_id"), ("text", "text"), ("lang", "lang"), ("source", "source"),
                    ("n_chars", "n_chars")),
    escape_char='"', multiline=True)

ORDERS_SPEC = IngestSpec(
    name="orders", target_table="stg_orders",
    columns=(C("orderkey", "bigint", False), C("custkey", "bigint", False), C("status", "varchar(1)", False),
             C("totalprice", "decimal(15,2)"), C("orderdate", "date", False), C("priority", "varchar(15)")),
    field_mappings=(("o_orderkey", "orderkey"), ("o_custkey", "custkey"), ("o_orderstatus", "status"),
                    ("o_totalprice", "totalprice"), ("o_orderdate", "orderdate"),
                    ("o_orderpriority", "priority")),
    unique_key=("orderkey",), surrogate_id="id")

# The shipped holdings spec, with NULLIF on the two text classifiers.
LINE_HOLDINGS_SPEC = HOLDINGS.with_options(
    target_table="stg_holdweb",
    field_transformations=MappingProxyType({"sector": "NULLIF(@sector, '')",
                                            "currency": "NULLIF(@currency, '')"}),
    columns=tuple(C(c.name, c.type, c.nullable if c.name not in ("sector",) else True)
                  for c in HOLDINGS.columns))

ORDER_COLS = ("orderkey", "custkey", "status", "totalprice", "orderdate", "priority")
ORDER_SQL = """SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS status,
  CAST(o_totalprice AS DECIMAL(15,2)) AS totalprice, CAST(o_orderdate AS DATE) AS orderdate,
  o_orderpriority AS priority FROM orders"""


@query("ingest_basic", """
SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey,
       CAST(c_acctbal AS DECIMAL(15,2)) AS acctbal, c_mktsegment AS segment FROM customer
""", covers="S01 S03 P01 P03 K01 K05")
def ingest_basic(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_customer")
    ingest(spark, CUSTOMER_SPEC, fx.customer_csv(spark, sf), mode="replace", table=t, on_bad="fail")
    return spark.table(t).select("custkey", "name", "nationkey", "acctbal", "segment")


@query("ingest_alt_delims", """
SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey,
       CAST(s_acctbal AS DECIMAL(15,2)) AS acctbal FROM supplier
""", covers="S01 (pipe delimiter, single-quote quoting, ';' line terminator)")
def ingest_alt_delims(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_supplier")
    ingest(spark, SUPPLIER_SPEC, fx.supplier_pipe(spark, sf), table=t, on_bad="fail")
    return spark.table(t).select("suppkey", "name", "nationkey", "acctbal")


@query("ingest_skip_lines", """
SELECT CAST(k AS INTEGER) AS skip_lines, n_nationkey AS nationkey, n_name AS name, n_regionkey AS regionkey
FROM nation, (VALUES (0), (1), (3)) s(k)
""", covers="S02 skip 0, 1 and 3 leading lines per file")
def ingest_skip_lines(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for k, path in fx.nation_skips(spark, sf).items():
        spec = NATION_SPEC.with_options(skip_lines=k)
        good = accepted(validate(read_delimited(spark, path, spec), spec), spec)
        parts.append(good.select(F.lit(k).cast("int").alias("skip_lines"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ingest_nullif", """
SELECT p_partkey AS partkey,
       upper(CASE WHEN p_size = 10 THEN NULL ELSE p_name END) AS name,
       CASE WHEN p_size <= 5 THEN '' ELSE p_brand END AS brand,
       NULLIF(CASE WHEN p_size >= 45 THEN 'Closed' ELSE p_type END, 'Closed') AS type,
       p_size AS size, CAST(p_retailprice AS DECIMAL(12,2)) AS retailprice
FROM part
""", covers="P02 H01 X01 X02 X03 S04 (empty field = '', \\N = NULL)")
def ingest_nullif(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_part")
    ingest(spark, PART_SPEC, fx.part_blanks(spark, sf), table=t, on_bad="fail")
    return spark.table(t)


@query("ingest_escapes", """
SELECT doc_id, text, lang, source, n_chars FROM documents
""", covers="S04 quotes, commas and line breaks inside quoted fields, whole texts")
def ingest_escapes(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_document")
    ingest(spark, DOCUMENT_SPEC, fx.documents_csv(spark, sf), table=t, on_bad="fail")
    return spark.table(t)


@query("ingest_backslash", """
SELECT doc_id, text, lang, source, n_chars FROM documents
""", covers="S04 backslash escapes of a bulk load: separators, quotes, tabs and line breaks, whole texts")
def ingest_backslash(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_document")
    spec = DOCUMENT_SPEC.with_options(escape_char="\\", multiline=False)
    ingest(spark, spec, fx.documents_escaped(spark, sf), table=t, on_bad="fail")
    return spark.table(t)


@query("ingest_multiline", """
SELECT doc_id, text, lang, source, n_chars FROM documents
""", covers="S01 S04 raw line breaks in quoted fields together with backslash escapes, read in splits")
def ingest_multiline(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_document")
    spec = DOCUMENT_SPEC.with_options(escape_char="\\", skip_lines=0)
    ingest(spark, spec, fx.documents_breaks(spark, sf), table=t, on_bad="fail")
    return spark.table(t)


@query("ingest_rejects", f"""
SELECT o_orderkey AS orderkey,
  CASE WHEN {DEFECT_RAGGED} THEN 'malformed record'
       ELSE concat_ws('; ',
         CASE WHEN {DEFECT_STATUS} THEN 'NULL in NOT NULL column status' END,
         CASE WHEN {DEFECT_PRICE} THEN 'bad value for totalprice' END,
         CASE WHEN {DEFECT_PRIORITY} THEN 'bad value for priority' END) END AS reason
FROM orders
WHERE ({DEFECT_RAGGED}) OR ({DEFECT_STATUS}) OR ({DEFECT_PRICE}) OR ({DEFECT_PRIORITY})
""", covers="S05 P03 K09 rejects kept with a reason (ragged, bad value, NULL, overlong)")
def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_orders")
    r = ingest(spark, ORDERS_SPEC, fx.orders_defects(spark, sf), table=t, on_bad="quarantine")
    return r.rejects.select(F.substring_index("_raw_record", ",", 1).try_cast("bigint").alias("orderkey"),
                            F.col("_reject_reason").alias("reason"))


@query("ingest_append", ORDER_SQL, covers="K02 append load after a replace load, surrogate ids K08")
def ingest_append(spark: SparkSession, sf: str) -> DataFrame:
    a, b = fx.orders_split(spark, sf)
    t = unique_name("stg_orders")
    ingest(spark, ORDERS_SPEC, a, mode="replace", table=t, on_bad="fail")
    ingest(spark, ORDERS_SPEC, b, mode="append", table=t, on_bad="fail")
    return spark.table(t).select(*ORDER_COLS)


@query("ingest_appends", f"""
SELECT o_orderkey AS orderkey, o_orderpriority AS priority, count(*) OVER () AS max_id, CAST(1 AS BIGINT) AS refused FROM orders
""", covers="K02 K06 K08 repeated appends: arriving keys against the bucketed key table, a stored key refused")
def ingest_appends(spark: SparkSession, sf: str) -> DataFrame:
    a, b = fx.orders_split(spark, sf)
    c, d = fx.orders_halves(spark, sf)
    t = unique_name("stg_orders")
    ingest(spark, ORDERS_SPEC, a, mode="replace", table=t, on_bad="fail")
    for part in (c, d):  # the first builds the key table, the second asks it
        ingest(spark, ORDERS_SPEC, part, mode="append", table=t, on_bad="fail")
    refused = 0
    try:
        ingest(spark, ORDERS_SPEC, b, mode="append", table=t, on_bad="fail")
    except IngestError:
        refused = 1
    top = spark.table(t).agg(F.max("id")).first()[0]
    return spark.table(t).select("orderkey", "priority", F.lit(top).cast("bigint").alias("max_id"), F.lit(refused).cast("bigint").alias("refused"))


@query("ingest_replace", ORDER_SQL + f" WHERE o_orderdate >= TIMESTAMP '{fx.ORDERS_SPLIT_DATE}'",
       covers="K01 K03 replace load swaps the table's contents")
def ingest_replace(spark: SparkSession, sf: str) -> DataFrame:
    a, b = fx.orders_split(spark, sf)
    t = unique_name("stg_orders")
    ingest(spark, ORDERS_SPEC, a, mode="replace", table=t, on_bad="fail")
    ingest(spark, ORDERS_SPEC, b, mode="replace", table=t, on_bad="fail")
    return spark.table(t).select(*ORDER_COLS)


@query("unique_violations", f"""
SELECT lower(rtrim(name)) AS name_key, count(*) AS n, count(DISTINCT name) AS n_spellings
FROM (SELECT c_name AS name FROM customer
      UNION ALL SELECT upper(c_name) FROM customer WHERE {DUP_UPPER}
      UNION ALL SELECT c_name || '  ' FROM customer WHERE {DUP_PADDED})
GROUP BY 1 HAVING count(*) > 1
""", covers="K06 unique key under a case- and trailing-space-insensitive collation")
def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    spec = CUSTOMER_SPEC.with_options(unique_key=("name",))
    good = accepted(validate(read_delimited(spark, fx.customer_dups(spark, sf), spec), spec), spec)
    v = check_unique(good, ("name",), "UNICODE_CI_AI_RTRIM")
    return v.select(normalized_key(F.col("name").cast("string")).alias("name_key"), "n",
                    F.col("n_spellings").cast("bigint").alias("n_spellings"))


@query("not_null_violations", """
SELECT o_orderkey AS orderkey, 'custkey' AS null_columns FROM orders
WHERE day(o_orderdate) = 5 AND o_orderstatus = 'O'
""", covers="K09 NOT NULL check on a table Parquet let NULLs into")
def not_null_violations(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    blanked = o.select(F.col("o_orderkey").alias("orderkey"),
                       F.when(F.expr("day(o_orderdate) = 5 AND o_orderstatus = 'O'"), F.lit(None))
                        .otherwise(F.col("o_custkey")).alias("custkey"),
                       F.col("o_orderstatus").alias("status"))
    t = unique_name("tbl_orders")
    create_table(spark, t, "orderkey BIGINT NOT NULL, custkey BIGINT NOT NULL, status STRING NOT NULL")
    replace_table_data(spark, t, blanked)
    v = check_not_null(spark.table(t), ["orderkey", "custkey", "status"])
    return v.select("orderkey", F.array_join("null_columns", ",").alias("null_columns"))


@query("surrogate_id", """
SELECT count(*) AS n, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id, count(*) AS n_distinct FROM part
""", covers="K08 dense auto-increment ids without a single-partition sort")
def surrogate_id(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_part")
    ingest(spark, PART_SPEC.with_options(surrogate_id="id"), fx.part_blanks(spark, sf), table=t, on_bad="fail")
    return spark.table(t).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"),
                              F.max("id").alias("max_id"), F.countDistinct("id").alias("n_distinct"))


def _supplier_base_and_update(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    s = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").cast("decimal(15,2)").alias("acctbal"))
    t = unique_name("tgt_supplier")
    create_table(spark, t, "suppkey BIGINT NOT NULL, name VARCHAR(25) NOT NULL, nationkey INT, acctbal DECIMAL(15,2)")
    replace_table_data(spark, t, s.filter("nationkey < 15"))
    update = (s.filter("nationkey >= 10")
               .select("suppkey", F.upper("name").alias("name"), "nationkey",
                       (F.col("acctbal") + F.lit(100)).cast("decimal(15,2)").alias("acctbal")))
    return t, update


_SUPP = "s_suppkey AS suppkey, {name} AS name, s_nationkey AS nationkey, {bal} AS acctbal"
_OLD = _SUPP.format(name="s_name", bal="CAST(s_acctbal AS DECIMAL(15,2))")
_NEW = _SUPP.format(name="upper(s_name)", bal="CAST(CAST(s_acctbal AS DECIMAL(15,2)) + 100 AS DECIMAL(15,2))")


@query("merge_append", f"""
SELECT {_OLD} FROM supplier WHERE s_nationkey < 15
UNION ALL SELECT {_NEW} FROM supplier WHERE s_nationkey >= 15
""", covers="K07 append merge: existing keys kept, new keys added")
def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    t, update = _supplier_base_and_update(spark, sf)
    return merge_table(spark, t, update, ["suppkey"], "append")


@query("merge_replace", f"""
SELECT {_OLD} FROM supplier WHERE s_nationkey < 10
UNION ALL SELECT {_NEW} FROM supplier WHERE s_nationkey >= 10
""", covers="K07 replace merge: matching keys overwritten")
def merge_replace(spark: SparkSession, sf: str) -> DataFrame:
    t, update = _supplier_base_and_update(spark, sf)
    return merge_table(spark, t, update, ["suppkey"], "replace")


_CUST = "c_custkey AS custkey, {name} AS name, CAST(c_acctbal AS DECIMAL(15,2)) {more} AS acctbal"
_RENAMED = "c_nationkey = 3 AND c_mktsegment = 'BUILDING'"


@query("merge_touched", f"""
SELECT {_CUST.format(name="c_name", more="")}, TRUE AS other_files_kept FROM customer WHERE NOT ({_RENAMED}) AND c_nationkey <> 4
UNION ALL SELECT custkey, name, CAST(acctbal AS DECIMAL(15,2)), TRUE FROM (SELECT {_CUST.format(name="lower(c_name)", more="+ 10")} FROM customer WHERE {_RENAMED})
UNION ALL SELECT {_CUST.format(name="c_name", more="")}, TRUE FROM customer WHERE c_nationkey = 4
""", covers="K07 merges into a table in buckets of its key: an append, then a replace that rewrites the touched buckets only")
def merge_touched(spark: SparkSession, sf: str) -> DataFrame:
    """Names are the key and compare under the collation."""
    c = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("decimal(15,2)").alias("acctbal"),
        "c_nationkey", F.expr(_RENAMED).alias("renamed"))
    t = unique_name("tgt_customer")
    create_keyed_table(spark, t, "custkey BIGINT NOT NULL, name VARCHAR(25) NOT NULL, acctbal DECIMAL(15,2)", ["name"], "UNICODE_CI_AI_RTRIM", 64)
    merge_buckets(spark, t, c.where("c_nationkey <> 4"), "append")
    merge_buckets(spark, t, c.where("c_nationkey in (3, 4)"), "append")  # those of nation 3 are known
    before = bucket_files(spark, t)
    update = c.where("renamed").select("custkey", F.lower("name").alias("name"), (F.col("acctbal") + 10).cast("decimal(15,2)").alias("acctbal"))
    touched = merge_buckets(spark, t, update, "replace")
    after = bucket_files(spark, t)
    kept = all(after.get(b) == files for b, files in before.items() if b not in touched)
    return spark.table(t).select("custkey", "name", "acctbal", F.lit(kept).alias("other_files_kept"))


def bucket_files(spark: SparkSession, table: str) -> dict[int, list[str]]:
    """The files of each bucket: names only, as many rows as the table has buckets."""
    files = spark.table(table).groupBy(BUCKET).agg(F.sort_array(F.collect_set(F.col("_metadata.file_path"))).alias("files"))
    return {r[BUCKET]: r["files"] for r in files.collect()}


def _merge_class_fees(spark: SparkSession, sf: str, kind: str) -> str:
    """Two class-fee loads, each merged into one target by the read procedure."""
    target = unique_name("fees")
    create_table(spark, target, CLASS_FEES.with_options(surrogate_id=None).ddl())
    for path in fx.class_fees_files(spark, sf):
        ingest(spark, CLASS_FEES, path, table=unique_name("stg_fees"), on_bad="fail",
               procedure_params={"merge_type": kind, "target_table": target})
    return target


_FEE = """SELECT {code} AS "FundCode", s_name AS "FundName", c AS "Class", '{note}' AS "Description",
  CAST(s_nationkey + {more} AS DECIMAL(5,2)) AS "Mer", CASE WHEN c = 'A' THEN CAST(1 AS DECIMAL(5,2)) END AS "Trailer",
  CAST(NULL AS VARCHAR) AS "PerformanceFee", '500' AS "MinInvestmentInitial",
  CAST(NULL AS VARCHAR) AS "MinInvestmentSubsequent", 'CAD' AS "Currency"
  FROM supplier, (VALUES ('A'), ('F')) v(c) WHERE s_nationkey"""
_FEE_CODE = "'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0')"
_FEE_A = _FEE.format(code=_FEE_CODE, note="first", more=0)
_FEE_B = _FEE.format(code=f"lower({_FEE_CODE})", note="second", more=1)


@query("class_fees_append", f"{_FEE_A} < 15 UNION ALL {_FEE_B} >= 15",
       covers="P04 K07 class-fee procedure: append merge under the keys' collation")
def class_fees_append(spark: SparkSession, sf: str) -> DataFrame:
    return run_procedure(spark, "usp_FundClassFee_Load", table=_merge_class_fees(spark, sf, "append"))


@query("class_fees_lookup", f"""SELECT * FROM ({_FEE_A} < 10 UNION ALL {_FEE_B} >= 10) WHERE "Class" = 'A'""",
       covers="P04 K07 F01 class-fee procedure: replace merge, then a lookup by class in another spelling")
def class_fees_lookup(spark: SparkSession, sf: str) -> DataFrame:
    fees = run_procedure(spark, "usp_FundClassFee_Load", table=_merge_class_fees(spark, sf, "replace"))
    return lookup(fees, {"Class": "a "}, CLASS_FEES.key_collation)


@query("csv_quote_all", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,8)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(18,8)) AS l_extendedprice,
       CAST(l_discount AS DECIMAL(18,8)) AS l_discount, l_returnflag FROM lineitem
""", covers="K10 K11 X13 S08 all-quoted 8-decimal CSV written, read back by header with inferred types")
def csv_quote_all(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_discount", "l_returnflag")
    path = write_csv(li, work_path(spark, "lineitem-quoted"), quote_all=True, scale=8)
    back = read_headered(spark, path)
    return back.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                       F.col("l_linenumber").cast("int").alias("l_linenumber"),
                       *[F.col(c).cast("decimal(18,8)").alias(c)
                         for c in ("l_quantity", "l_extendedprice", "l_discount")],
                       F.col("l_returnflag").cast("string").alias("l_returnflag"))


@query("headered_layouts", """
SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS acctbal, CASE WHEN c_nationkey % 3 <> 2 THEN c_nationkey END AS nationkey
FROM customer
""", covers="S08 files whose headers name the columns in other orders, bound by name; a file without a column")
def headered_layouts(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
                                               F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey"))
    root = work_path(spark, "headered")
    for k, names in enumerate((["custkey", "name", "acctbal", "nationkey"], ["nationkey", "acctbal", "custkey", "name"], ["name", "custkey", "acctbal"])):
        c.where(F.col("nationkey") % 3 == k).select(*names).write.mode("append").option("header", "true").csv(root)
    return read_headered(spark, root).select(F.col("custkey").cast("bigint").alias("custkey"), "name",
                                             F.col("acctbal").cast("double").alias("acctbal"), F.col("nationkey").cast("int").alias("nationkey"))


READ_DATE = "1996-03-15"


def load_line_holdings(spark: SparkSession, sf: str) -> str:
    t = unique_name("stg_holdweb")
    ingest(spark, LINE_HOLDINGS_SPEC, fx.lineitem_holdings(spark, sf), table=t, on_bad="fail")
    return t


_HOLD_SQL = """SELECT CAST(l_shipdate AS DATE) AS date, 'Fund ' || l_suppkey AS fund_name,
  'Part ' || l_partkey || ', lot ' || l_orderkey || '-' || l_linenumber AS sec_name,
  NULLIF(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END, '') AS sector,
  l_linestatus AS currency,
  CAST(CAST(l_quantity AS DECIMAL(15,2)) AS DECIMAL(21,6)) AS units,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DECIMAL(21,6)) AS cost,
  CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(21,6)) AS mv
FROM lineitem"""


@query("read_procedure", _HOLD_SQL + f" WHERE CAST(l_shipdate AS DATE) = DATE '{READ_DATE}'",
       covers="H02 P05 F01 named read procedure with a named parameter after a holdings load")
def read_procedure(spark: SparkSession, sf: str) -> DataFrame:
    t = load_line_holdings(spark, sf)
    return run_procedure(spark, "usp_holdweb_process", table=t, date=READ_DATE)


@query("lookup_code", """
SELECT c_custkey AS custkey, n_name AS fund_name,
       CASE WHEN n_regionkey <> 4 THEN lpad(CAST(n_nationkey AS VARCHAR), 4, '0') ELSE '###' END AS fund_code
FROM customer JOIN nation ON c_nationkey = n_nationkey
""", covers="J01 X15 fund-name lookup with default '###'")
def lookup_code(spark: SparkSession, sf: str) -> DataFrame:
    n = fx.table(spark, sf, "nation")
    codes = n.filter("n_regionkey <> 4").select(
        F.col("n_name").alias("fund_name"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("fund_code"))
    holders = (fx.table(spark, sf, "customer")
               .join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.col("c_custkey").alias("custkey"), F.col("n_name").alias("fund_name")))
    return with_fund_code(holders, codes)


# Holdings as they are filed, by month end, in a table with one partition per date.
MONTH_HOLDINGS_SPEC = LINE_HOLDINGS_SPEC.with_options(
    partition_by="date",
    field_transformations=MappingProxyType({**LINE_HOLDINGS_SPEC.field_transformations, "date": "last_day(to_date(@date))"}))
RESTATED, AS_FILED = "1996-03-31", "1996-04-30"
_MONTH = _HOLD_SQL.replace("CAST(l_shipdate AS DATE) AS date", "last_day(CAST(l_shipdate AS DATE)) AS date")


@query("holdings_by_date", f"""
SELECT * REPLACE (CAST(mv + 1 AS DECIMAL(21,6)) AS mv) FROM ({_MONTH}) WHERE date = DATE '{RESTATED}' AND currency = 'F'
UNION ALL SELECT * FROM ({_MONTH}) WHERE date = DATE '{AS_FILED}'
""", covers="K01 P05 H02 holdings in a partition per date: one date restated, others untouched, the read procedure prunes")
def holdings_by_date(spark: SparkSession, sf: str) -> DataFrame:
    t = unique_name("stg_holdweb")
    ingest(spark, MONTH_HOLDINGS_SPEC, fx.lineitem_holdings(spark, sf), table=t, on_bad="fail")
    ingest(spark, MONTH_HOLDINGS_SPEC, fx.restated_holdings(spark, sf, RESTATED), mode="replace_partitions", table=t, on_bad="fail")
    restated, filed = (run_procedure(spark, "usp_holdweb_process", table=t, date=d) for d in (RESTATED, AS_FILED))
    return restated.unionByName(filed)
