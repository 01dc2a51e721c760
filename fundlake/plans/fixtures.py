"""Stand-in inputs rendered from the driver tables.

Each renderer writes a driver table in the layout a job reads (a delimited
file with a given dialect, statement text, files arriving in a folder). It
only reshapes rows; the job's own work (parsing, typing, checking, merging,
fitting) happens in the library code the queries call. Renders are written
under the shared work folder once per session and input folder.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.statements import END_MARKER, SECTION_START
from ..session import plan_bytes, remove_path, shuffles_dropped, work_path

_CACHE: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cache_key(spark: SparkSession, sf_dir: str, key: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, key


def cached(spark: SparkSession, sf_dir: str, key: str, render) -> str:
    k = _cache_key(spark, sf_dir, key)
    if k not in _CACHE:
        _CACHE[k] = render(work_path(spark, f"fixture-{key}"))
    return _CACHE[k]


def _text(c: Column) -> Column:
    return c.cast("string")


def write_lines(df: DataFrame, path: str, header: str | None = None, line_sep: str = "\n") -> None:
    """Write a one-column frame of pre-built lines; ``header`` heads every
    output file (as a delimited file header does)."""
    w = (df.select(F.col("line").alias(header or "line")).write
         .option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .option("lineSep", line_sep).option("header", "true" if header else "false"))
    w.csv(path)


# --- customers: plain comma file, header line ---------------------------------
def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        c = table(spark, sf_dir, "customer")
        (c.select(_text(F.col("c_custkey")), "c_name", _text(F.col("c_nationkey")),
                  _text(F.col("c_acctbal")), "c_mktsegment")
          .write.option("header", "true").csv(path))
        return path
    return cached(spark, sf_dir, "customer_csv", render)


# --- suppliers: pipe-separated, single-quoted, ';'-terminated ----------------
def supplier_pipe(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        s = table(spark, sf_dir, "supplier")
        (s.select(_text(F.col("s_suppkey")), "s_name", _text(F.col("s_nationkey")), _text(F.col("s_acctbal")))
          .write.option("header", "true").option("sep", "|").option("quote", "'")
          .option("quoteAll", "true").option("lineSep", ";").csv(path))
        return path
    return cached(spark, sf_dir, "supplier_pipe", render)


# --- nations: three files with 0, 1 and 3 leading lines ----------------------
def nation_skips(spark: SparkSession, sf_dir: str) -> dict[int, str]:
    def render(path):
        n = table(spark, sf_dir, "nation")
        body = n.select(F.concat_ws(",", _text(F.col("n_nationkey")), "n_name",
                                    _text(F.col("n_regionkey"))).alias("line"))
        write_lines(body, f"{path}/skip0")
        write_lines(body, f"{path}/skip1", header="n_nationkey,n_name,n_regionkey")
        # two preamble lines plus the column header, then the rows
        pre = spark.createDataFrame([(-3, "Nation extract"), (-2, "generated for load test"),
                                     (-1, "n_nationkey,n_name,n_regionkey")], "_o long, line string")
        both = pre.unionByName(body.withColumn("_o", F.lit(0).cast("long")))
        write_lines(both.orderBy("_o").coalesce(1).select("line"), f"{path}/skip3")
        return path
    root = cached(spark, sf_dir, "nation_skips", render)
    return {0: f"{root}/skip0", 1: f"{root}/skip1", 3: f"{root}/skip3"}


# --- parts: blanks, 'Closed' and \N markers -----------------------------------
def part_blanks(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        p = table(spark, sf_dir, "part")
        size = F.col("p_size")
        (p.select(_text(F.col("p_partkey")).alias("p_partkey"),
                  F.when(size == 10, F.lit(None)).otherwise(F.col("p_name")).alias("p_name"),
                  F.when(size <= 5, F.lit("")).otherwise(F.col("p_brand")).alias("p_brand"),
                  F.when(size >= 45, F.lit("Closed")).otherwise(F.col("p_type")).alias("p_type"),
                  _text(size).alias("p_size"), _text(F.col("p_retailprice")).alias("p_retailprice"))
          .write.option("header", "true").option("nullValue", "\\N").option("emptyValue", "")
          .csv(path))
        return path
    return cached(spark, sf_dir, "part_blanks", render)


# --- class fees: two files of fee rows, the second with other spellings of its keys ---
def class_fees_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    def render(path):
        s = table(spark, sf_dir, "supplier")
        cls = s.select("*", F.explode(F.array(F.lit("A"), F.lit("F"))).alias("cls"))
        mer = F.col("s_nationkey").cast("decimal(5,2)")
        trailer = F.when(F.col("cls") == "A", F.lit("1.00")).otherwise(F.lit(""))
        code = F.concat(F.lit("S"), F.lpad(_text(F.col("s_suppkey")), 7, "0"))
        def write(df, sub, code, mer, note):
            (df.select(code.alias("fund_code"), F.col("s_name").alias("fund_name"), F.col("cls").alias("class"),
                       F.lit(note).alias("description"), _text(mer).alias("mer"), trailer.alias("trailer"),
                       F.lit("").alias("performance_fee"), F.lit("500").alias("min_initial"),
                       F.lit("").alias("min_subsequent"), F.lit("CAD").alias("currency"))
               .write.option("header", "true").option("emptyValue", "").csv(f"{path}/{sub}"))
        write(cls.filter("s_nationkey < 15"), "a", code, mer, "first")
        write(cls.filter("s_nationkey >= 10"), "b", F.lower(code), mer + 1, "second")
        return path
    root = cached(spark, sf_dir, "class_fees", render)
    return f"{root}/a", f"{root}/b"


# --- documents, backslash dialect: separators, quotes and line breaks escaped ---
def documents_escaped(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        d = table(spark, sf_dir, "documents")
        def esc(c):
            c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
            for char, code in (("\n", "n"), ("\r", "r"), ("\t", "t"), (",", ","), ('"', '"')):
                c = F.replace(c, F.lit(char), F.lit("\\" + code))
            return F.coalesce(c, F.lit("\\N"))
        cols = [_text(F.col("doc_id")), esc(F.col("text")), esc(F.col("lang")), esc(F.col("source")),
                F.coalesce(_text(F.col("n_chars")), F.lit("\\N"))]
        write_lines(d.select(F.concat_ws(",", *cols).alias("line")), path, header="doc_id;text;lang;source;n_chars")
        return path
    return cached(spark, sf_dir, "documents_escaped", render)


# --- documents: whole texts with quotes, commas and line breaks -------------
def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        d = table(spark, sf_dir, "documents")
        (d.select(_text(F.col("doc_id")).alias("doc_id"), "text", "lang", "source",
                  _text(F.col("n_chars")).alias("n_chars"))
          .write.option("header", "true").option("escape", '"').option("quoteAll", "true")
          .option("nullValue", "\\N")
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
          .csv(path))
        return path
    return cached(spark, sf_dir, "documents_csv", render)


# --- documents: raw line breaks inside quoted fields, backslash escapes ------
def documents_breaks(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        d = table(spark, sf_dir, "documents")
        def quoted(c):
            text = F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
            return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("\\N"))
        def number(c):
            return F.coalesce(_text(F.col(c)), F.lit("\\N"))
        d.select(F.concat_ws(",", number("doc_id"), quoted("text"), quoted("lang"), quoted("source"), number("n_chars"))).write.text(path)
        return path
    return cached(spark, sf_dir, "documents_breaks", render)


# --- orders: clean split files and a file with injected defects --------------
ORDERS_SPLIT_DATE = "1998-01-01"


def _order_fields(o: DataFrame) -> list[Column]:
    return [_text(F.col("o_orderkey")), _text(F.col("o_custkey")), F.col("o_orderstatus"),
            _text(F.col("o_totalprice")), _text(F.to_date("o_orderdate")), F.col("o_orderpriority")]


def orders_split(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    def render(path):
        o = table(spark, sf_dir, "orders")
        early = F.col("o_orderdate") < F.lit(ORDERS_SPLIT_DATE).cast("timestamp_ntz")
        fields = _order_fields(o)
        o.filter(early).select(*fields).write.option("header", "true").csv(f"{path}/a")
        o.filter(~early).select(*fields).write.option("header", "true").csv(f"{path}/b")
        return path
    root = cached(spark, sf_dir, "orders_split", render)
    return f"{root}/a", f"{root}/b"


def orders_halves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The later file of ``orders_split`` as two."""
    def render(path):
        o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit(ORDERS_SPLIT_DATE).cast("timestamp_ntz"))
        for k in (0, 1):
            o.filter(F.col("o_orderkey") % 2 == k).select(*_order_fields(o)).write.option("header", "true").csv(f"{path}/{k}")
        return path
    root = cached(spark, sf_dir, "orders_halves", render)
    return f"{root}/0", f"{root}/1"


# Fixed defect rules of the reject fixture, shared with its oracle SQL.
DEFECT_RAGGED = "day(o_orderdate) = 1 AND o_orderstatus = 'P'"
DEFECT_PRICE = "day(o_orderdate) = 13"
DEFECT_STATUS = "day(o_orderdate) = 21 AND o_orderpriority = '1-URGENT'"
DEFECT_PRIORITY = "day(o_orderdate) = 28 AND o_orderstatus = 'F'"


def orders_defects(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        o = table(spark, sf_dir, "orders")
        key, cust, status, price, odate, prio = _order_fields(o)
        status = F.when(F.expr(DEFECT_STATUS), F.lit("\\N")).otherwise(status)
        price = F.when(F.expr(DEFECT_PRICE), F.lit("n/a")).otherwise(price)
        prio = F.when(F.expr(DEFECT_PRIORITY), F.concat(prio, F.lit("-OVERDUE-RECHECK"))).otherwise(prio)
        full = F.concat_ws(",", key, cust, status, price, odate, prio)
        short = F.concat_ws(",", key, cust, status, price, odate)
        lines = o.select(F.when(F.expr(DEFECT_RAGGED), short).otherwise(full).alias("line"))
        write_lines(lines, path, header="o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority")
        return path
    return cached(spark, sf_dir, "orders_defects", render)


# --- customers plus case-changed / space-padded copies -----------------------
DUP_UPPER = "c_mktsegment = 'BUILDING' AND c_nationkey = 3"
DUP_PADDED = "c_mktsegment = 'MACHINERY' AND c_nationkey = 7"


def customer_dups(spark: SparkSession, sf_dir: str) -> str:
    def render(path):
        c = table(spark, sf_dir, "customer")
        def fields(name):
            return [_text(F.col("c_custkey")), name.alias("c_name"), _text(F.col("c_nationkey")),
                    _text(F.col("c_acctbal")), F.col("c_mktsegment")]
        base = c.select(*fields(F.col("c_name")))
        upper = c.filter(F.expr(DUP_UPPER)).select(*fields(F.upper("c_name")))
        padded = c.filter(F.expr(DUP_PADDED)).select(*fields(F.concat("c_name", F.lit("  "))))
        (base.unionByName(upper).unionByName(padded)
         .write.option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(path))
        return path
    return cached(spark, sf_dir, "customer_dups", render)


# --- lineitem as a holdings file ---------------------------------------------
def lineitem_holdings(spark: SparkSession, sf_dir: str) -> str:
    """date, fund_name, sec_name, sector, currency, units, cost, mv; text
    fields quoted, sector blank for return flag 'N'."""
    def render(path):
        return _holdings_file(table(spark, sf_dir, "lineitem"), path, 0)
    return cached(spark, sf_dir, "lineitem_holdings", render)


def restated_holdings(spark: SparkSession, sf_dir: str, month_end: str) -> str:
    """The holdings of one month filed again: those of line status 'F' only, each worth 1 more."""
    def render(path):
        month = table(spark, sf_dir, "lineitem").where((F.last_day(F.to_date("l_shipdate")) == F.lit(month_end).cast("date")) & (F.col("l_linestatus") == "F"))
        return _holdings_file(month, path, 1)
    return cached(spark, sf_dir, f"restated_holdings_{month_end}", render)


#: Rows of a holdings file: compressed files are read by one task each.
HOLDINGS_PER_FILE = 250_000


def _holdings_file(li: DataFrame, path: str, more: int) -> str:
    mv = (F.col("l_extendedprice").cast("decimal(15,2)") *
          (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    (li.select(_text(F.to_date("l_shipdate")).alias("date"),
               F.concat(F.lit("Fund "), _text(F.col("l_suppkey"))).alias("fund_name"),
               F.concat(F.lit("Part "), _text(F.col("l_partkey")), F.lit(", lot "),
                        _text(F.col("l_orderkey")), F.lit("-"), _text(F.col("l_linenumber"))).alias("sec_name"),
               F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag")).alias("sector"),
               F.col("l_linestatus").alias("currency"),
               _text(F.col("l_quantity").cast("decimal(15,2)")).alias("units"),
               _text(F.col("l_extendedprice").cast("decimal(15,2)")).alias("cost"),
               _text(F.round(mv, 2) + F.lit(more)).alias("mv"))
       .write.option("header", "true").option("quoteAll", "true").option("emptyValue", "")
       .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", HOLDINGS_PER_FILE)
       .csv(path))
    return path


# --- events arriving as several files ----------------------------------------
def events_arrivals(spark: SparkSession, sf_dir: str) -> str:
    """Events split by event type into separate files of a fresh incoming
    folder (not cached: a stream may archive the files it has loaded)."""
    path = work_path(spark, "incoming-events")
    e = table(spark, sf_dir, "events")
    (e.select(_text(F.col("event_id")).alias("event_id"), _text(F.col("user_id")).alias("user_id"),
              "event_type", _text(F.col("value")).alias("value"), "props")
      .repartition("event_type").write.option("header", "true").csv(path))
    return path


# --- statements: one per supplier, one page per return flag ----------------
def _fmt_amount(v: Column) -> Column:
    return F.when(v < 0, F.concat(F.lit("("), F.format_number(-v, 0), F.lit(")"))).otherwise(F.format_number(v, 0))


def _printed_items(li: DataFrame, p: DataFrame) -> DataFrame:
    """Line items with the printed fields of their holding line; ``doc`` is the supplier's key."""
    mv = F.round(F.col("l_extendedprice").cast("decimal(15,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 0)
    mv = F.when(F.col("l_linenumber") == 7, -mv).otherwise(mv).cast("long")
    due = F.date_format("l_shipdate", "yyyy/MM/dd")
    desc = F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit(", lot "),
                    F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                    F.lit(", "), F.lower("p_type"), F.lit(" grade, due "), due)
    own = li.select(F.col("l_suppkey").alias("doc"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                    "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", F.col("l_quantity").cast("long").alias("units"),
                    F.round(F.col("l_extendedprice").cast("decimal(15,2)"), 0).cast("long").alias("cost"), mv.alias("mv"),
                    *[c for c in li.columns if c not in LINE_COLUMNS])
    return (own.join(p, own["l_partkey"] == p["p_partkey"])
            .select(*[c for c in own.columns if c != "l_partkey"], desc.alias("desc"),
                    F.when(F.col("l_linenumber") % 2 == 1, "CAD").otherwise("USD").alias("ccy")))


def statement_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the printed fields of its holding line."""
    s = table(spark, sf_dir, "supplier")
    items = _printed_items(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), table(spark, sf_dir, "part"))
    return (items.join(s, items["doc"] == s["s_suppkey"])
            .select(F.col("s_suppkey").alias("doc"), F.col("s_name").alias("fund"), "flag", "status", "l_orderkey",
                    "l_linenumber", "l_shipdate", "desc", "ccy", "units", "cost", "mv"))


#: What a statement prints of a line item.
LINE_COLUMNS = ("l_suppkey", "l_returnflag", "l_linestatus", "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate",
                "l_quantity", "l_extendedprice", "l_discount")
#: The line that ends a statement in a file of several.
DOCUMENT_BREAK = "\u001d"
#: Bytes of line items whose statements are rendered at once: what is sorted for them is dropped before the next.
RENDER_BYTES = 256 << 20


def _item_groups(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The line items in groups of whole suppliers."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    n = -(-plan_bytes(li) // RENDER_BYTES) or 1
    return [li.where(F.pmod(F.hash("l_suppkey"), F.lit(n)) == g) for g in range(n)] if n > 1 else [li]


def _write_statements(spark: SparkSession, sf_dir: str, li: DataFrame, path: str) -> None:
    with shuffles_dropped(spark):
        (_statements(li, table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")).write.mode("append")
         .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def statements_text(spark: SparkSession, sf_dir: str) -> str:
    """One statement after the other, many to a file, so that the files do not grow
    in number with the funds; compressed, as each file is read by one task."""
    def render(path):
        for li in _item_groups(spark, sf_dir):
            _write_statements(spark, sf_dir, li, path)
        return path
    return cached(spark, sf_dir, "statements_text", render)


def statement_folders(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """The same statements in folders, each rendered when the one before has been read and
    removed; or the folder of ``statements_text`` where that has been written."""
    if done := _CACHE.get(_cache_key(spark, sf_dir, "statements_text")):
        yield done
        return
    for li in _item_groups(spark, sf_dir):
        path = work_path(spark, "fixture-statements")
        _write_statements(spark, sf_dir, li, path)
        yield path
        remove_path(spark, path)


def _statements(li: DataFrame, p: DataFrame, s: DataFrame) -> DataFrame:
    """The text of statements in order: of each item its own lines, before them those that
    its page and line status begin with, after them those that they end with."""
    # suppliers that share a key share a statement: each name heads its pages, each row has the items
    funds = (s.groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("m")).groupBy("s_suppkey")
             .agg(F.sum("m").cast("int").alias("times"), F.sort_array(F.collect_list(F.struct("s_name", "m"))).alias("funds")))
    # (order, line number) repeats in the driver data: a row id keeps items in order
    it = _printed_items(li.withColumn("id", F.monotonically_increasing_id()), p).repartition("doc")
    it = it.join(funds, F.col("doc") == F.col("s_suppkey"))
    by_status = Window.partitionBy("doc", "flag", "status").orderBy("id")
    by_flag = Window.partitionBy("doc", "flag").orderBy("status", "id")
    by_doc = Window.partitionBy("doc").orderBy("flag", "status", "id")  # all three by one sort
    upto = lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
    all_doc = by_doc.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = (lambda w: F.row_number().over(w) == 1), (lambda w: F.lead(F.lit(True)).over(w).isNull())
    it = it.select(
        "*", first(by_doc).alias("opens_doc"), first(by_status).alias("opens_status"), last(by_status).alias("ends_status"),
        last(by_flag).alias("ends_page"), last(by_doc).alias("ends_doc"), F.lead("flag").over(by_doc).alias("next_flag"),
        F.min("flag").over(all_doc).alias("first_flag"), F.max("l_shipdate").over(all_doc).alias("d"),
        *[upto(c, w).alias(f"{n}_{c}") for n, w in (("status", by_status), ("flag", by_flag), ("doc", by_doc)) for c in ("cost", "mv")],
        upto("units", by_doc).alias("doc_units"))
    names, times = F.col("funds.s_name"), F.col("times")
    each = lambda line: F.array_repeat(line, F.size("funds"))

    def head(flag):
        sched = F.when(flag == F.col("first_flag"), F.lit(SECTION_START)).otherwise(F.lit(f"{SECTION_START} (cont’d)"))
        fixed = (sched, F.date_format("d", "MMMM d, yyyy"), F.lit("Issue"), F.lit("currency"), F.lit("Number of units"),
                 F.lit("Cost"), F.lit("Fair value"), F.concat(F.lit("Flag "), flag, F.lit(" items:")))
        return F.concat_ws("\n", names, *[each(line) for line in fixed])

    amounts = F.concat_ws(" ", F.col("ccy"), F.format_number(F.col("units"), 0),
                          _fmt_amount(F.col("cost")), _fmt_amount(F.col("mv")))
    wrap = F.col("l_linenumber").isin(2, 5)
    name = F.concat(F.substring_index("desc", ", ", 2), F.lit(","))
    tail = F.expr("substring(desc, length(substring_index(desc, ', ', 2)) + 3)")
    own = F.when(wrap, F.concat_ws("\n", name, tail, amounts)).otherwise(F.concat_ws(" ", "desc", amounts))
    printed = lambda *c: [_fmt_amount(x) for x in c]
    subtotal = F.concat_ws(" ", *printed(F.col("status_cost") * times, F.col("status_mv") * times))
    total = F.concat_ws(" ", F.concat(F.lit("Total flag "), F.col("flag"), F.lit(" items")),
                        *printed(F.col("flag_cost") * times, F.col("flag_mv") * times))

    def of_funds(label, *sums):
        return F.array_sort(F.transform("funds", lambda f: F.concat_ws(" ", F.lit(label), *printed(*[x * f["m"] for x in sums]))))
    cost, mv, cash = F.col("doc_cost"), F.col("doc_mv"), F.col("doc_units")
    closing = F.concat_ws("\n", total, of_funds("Total investments", cost, mv), of_funds("Cash (Bank overdraft) (0.1%)", cash),
                          of_funds(f"{END_MARKER} units (100.0%)", mv + cash), F.lit(DOCUMENT_BREAK))
    turn = F.concat(total, F.lit("\f"), head(F.col("next_flag")))
    return it.select(F.concat_ws(
        "\n", F.when(F.col("opens_doc"), head(F.col("flag"))),
        F.when(F.col("opens_status"), F.concat(F.lit("Line status "), F.col("status"), F.lit(" (weights in %):"))),
        F.when(times == 1, own).otherwise(F.concat_ws("\n", F.array_repeat(own, times))),
        F.when(F.col("ends_status"), subtotal),
        F.when(F.col("ends_doc"), closing).when(F.col("ends_page"), turn)).alias("value"))


def statement_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted-table layout: one table per supplier page (return flag):
    a header row, one row per item (4 cells when the line number is 3, else
    5), a one-cell note row and a total row; plus a header-only table."""
    it = statement_items(spark, sf_dir)
    cells = F.when(F.col("l_linenumber") == 3,
                   F.array("desc", "ccy", F.col("units").cast("string"), F.col("cost").cast("string"))) \
             .otherwise(F.array("desc", "ccy", F.col("units").cast("string"), F.col("cost").cast("string"),
                                F.col("mv").cast("string")))
    rows = it.select("doc", "flag", F.struct(F.lit(1).alias("k"), F.col("l_orderkey").alias("o"),
                                             F.col("l_linenumber").alias("n"), cells.alias("cells")).alias("r"))
    t = rows.groupBy("doc", "flag").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    header = F.array(F.lit("Issue"), F.lit("Currency"), F.lit("Units"), F.lit("Cost"), F.lit("Fair value"))
    body = F.transform(F.col("rs"), lambda r: r["cells"])
    full = F.concat(F.array(header), body, F.array(F.array(F.lit("see notes"))),
                    F.array(F.array(F.concat(F.lit("Total flag "), F.col("flag")), F.lit(""), F.lit(""),
                                    F.lit("0"), F.lit("0"))))
    tables = t.select(F.col("doc").alias("doc_id"), F.lit(1).alias("page"),
                      F.col("flag").alias("table_no"), full.alias("rows"))
    lone = t.select(F.col("doc").alias("doc_id"), F.lit(1).alias("page"),
                    F.concat(F.col("flag"), F.lit("-empty")).alias("table_no"), F.array(header).alias("rows"))
    return tables.unionByName(lone)
