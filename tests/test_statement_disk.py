"""Statement queries on little disk: lines scanned as they pass, statements rendered
group by group, shuffle files dropped, fund names broadcast."""

import gzip
import os
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundlake.operators import lookup
from fundlake.operators import statements as S
from fundlake.operators.scan import scan_in_place
from fundlake.plans import fixtures as fx
from fundlake.plans import statement_queries as Q
from fundlake.session import shuffles_dropped
from fundlake.sources.statements import read_statement_lines

FUNDS = ("Example Bond Fund", "Harbour Fund")
BREAK = "\u001d"


def _document(fund, n):
    """Two pages, wrapped names, a text that nothing closes, amounts of either sign."""
    head = [fund, "Schedule of Investment Portfolio", "December 31, 2024", "Issue"]
    items = [x for i in range(n) for x in (f"Willow Lines {i}, Secured,", "2033/02/14", f"CAD {i} 200 (3{i})", f"Cedar {i} CAD 1 2,000 3")]
    return "\n".join([*head, "Bonds:", "Canada (5.0%):", *items, "300 90", "Total bonds (5.0%) 300 90", "left over"]) + "\f" + "\n".join(
        [*head, "Notes:", "Lake Trustco, Swap, closing", "2026/08/03", "0.91 EUR 1,500 CAD 2,000 (40)", "Cash (1.0%) 500",
         "Total investments (15.0%) 2,300 2,190", "Total net assets attributable to holders of redeemable units (100.0%) 2,650", "the end"])


def _codes(spark, folder):
    path = os.path.join(folder, "codes")
    spark.createDataFrame([(f, str(i)) for i, f in enumerate(FUNDS)], "fund_name string, fund_code string").write.parquet(path)
    return spark.read.parquet(path)


def _shared_file(path, opened=open):
    with opened(path, "wt", encoding="utf-8", newline="") as f:
        f.write("".join(_document(FUNDS[i % 3 % 2] if i % 4 else "No Fund", i) + f"\n{BREAK}\n" for i in range(7)))


def test_scan_in_place_matches_plain_window(spark):
    big = Decimal("98765432109876.543210")  # unscaled beyond 64 bits
    rows = [(d, i, (i * 7 + ord(d)) % 5 if (i * 3) % 4 == 0 else None, (i + ord(d)) % 3 > 0, (-1) ** i * (big + i) if i % 5 else None,
             f"t{i}" if i % 3 and i % 4 else None, i % 4 == 0, 1 if i > 4 else 0) for d in ("a", "b", "c", "d") for i in range(1, 12 + ord(d) % 3)]
    df = spark.createDataFrame(rows, "d string, i long, v int, counts boolean, m decimal(21,6), t string, closes boolean, open int").coalesce(1)
    w = Window.partitionBy("d").orderBy("i")
    up, above = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    ref = (df.withColumn("run", F.coalesce(F.sum(F.col("closes").cast("int")).over(above), F.lit(0)))
           .withColumn("f", F.last("v", True).over(up))
           .withColumn("n", F.count(F.when(F.col("counts"), 1)).over(above))
           .withColumn("s", F.coalesce(F.sum(F.when(F.col("counts"), F.col("m"))).over(above), F.lit(0)).cast("decimal(31,6)"))
           .withColumn("g", F.when(F.col("closes"), F.array_join(F.collect_list(F.when(F.col("open") == 1, F.col("t"))).over(
               Window.partitionBy("d", "run").orderBy("i")), " "))).drop("run"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "4", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = scan_in_place(df, "d", "i", forward={"f": F.col("v"), "_on": F.col("open")},
                                running={"n": (None, F.col("counts")), "s": ("m", F.col("counts"))},
                                gathered={"g": (F.col("t"), F.col("closes"), ["_on"])}).drop("_on")
            assert got.schema["s"].dataType == ref.schema["s"].dataType
            assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in ref.select(got.columns).collect())
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_scan_in_place_refuses_rows_out_of_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1)], "d string, i long").coalesce(1)
    with pytest.raises(Exception, match="not in order"):
        scan_in_place(df, "d", "i", forward={}, running={}, gathered={}).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_whole_documents_have_the_state_of_all_others(spark, tmp_dir, packed):
    files, codes = os.path.join(tmp_dir, "files"), _codes(spark, tmp_dir)
    os.makedirs(files)
    for name in "ab":
        _shared_file(os.path.join(files, f"{name}.txt{'.gz' if packed else ''}"), gzip.open if packed else open)
    cols = ["page", "line_no", "kind", "fund_name", "date_text", "sector", "in_section", "cost", "wrapped", "items_before", "cost_before", "mv_before"]

    def rows(df, cols):
        docs = {}
        for r in df.collect():
            docs.setdefault(r.doc_id, []).append(tuple(r[c] for c in cols))
        return sorted((sorted(d, key=lambda x: x[:2]) for d in docs.values()), key=repr)

    ref = S.statement_state(read_statement_lines(spark, files, document_break=BREAK), codes)
    want, held = rows(ref, cols), rows(S.statement_holdings(None, codes, state=ref), ["page", "line_no", "sec_name", "fund_code", "mv"])
    assert {len(d) for d in want} == {21 + 4 * i for i in range(7)} and any("Willow Lines 1, Secured, 2033/02/14" in r for d in held for r in d)
    seen = set()
    for size in ("128m",) if packed else ("128m", "400"):  # all documents whole, or some
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            lines = read_statement_lines(spark, files, block_lines=3, document_break=BREAK, whole=True)
            seen |= {r.whole for r in lines.select("whole").distinct().collect()}
            state = S.statement_state(lines, codes, block_lines=5)
            assert rows(state, cols) == want
            assert rows(S.statement_holdings(None, codes, state=state), ["page", "line_no", "sec_name", "fund_code", "mv"]) == held
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen == ({True} if packed else {True, False})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_holdings_and_names_shuffle_no_lines(spark, tmp_dir):
    """Only the few funds are dealt out anew, whatever the threshold for broadcasts."""
    files, codes = os.path.join(tmp_dir, "files"), _codes(spark, tmp_dir)
    os.makedirs(files)
    _shared_file(os.path.join(files, "a.txt.gz"), gzip.open)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = read_statement_lines(spark, files, document_break=BREAK, whole=True)
        S.statement_state(lines, codes).write.parquet(os.path.join(tmp_dir, "state"))
        held = S.statement_holdings(None, codes, state=spark.read.parquet(os.path.join(tmp_dir, "state")))
        assert "SortMergeJoin" not in _plan(held) and _plan(held).count("hashpartitioning") == 1  # of the codes' names
        assert "SortMergeJoin" not in _plan(S.classify(lines, codes)) and _plan(S.classify(lines, codes)).count("hashpartitioning") == 1
        before, lookup.BROADCAST_BYTES = lookup.BROADCAST_BYTES, 1  # a table of funds beyond it is joined as any other
        try:
            other = S.statement_holdings(lines, codes)
            assert "SortMergeJoin" in _plan(other)
            assert sorted(map(repr, other.drop("doc_id").collect())) == sorted(map(repr, held.drop("doc_id").collect()))
        finally:
            lookup.BROADCAST_BYTES = before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shuffle_files(spark):
    return [f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if f.endswith(".data")]


def test_shuffle_files_are_dropped_after_the_write(spark, tmp_dir):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = set(_shuffle_files(spark)), spark.conf.get(name)
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(os.path.join(tmp_dir, "dropped"))
    until = time.time() + 20
    while set(_shuffle_files(spark)) - before and time.time() < until:
        time.sleep(0.2)
    assert not set(_shuffle_files(spark)) - before
    assert spark.conf.get(name) == held
    assert spark.read.parquet(os.path.join(tmp_dir, "dropped")).count() == 1000


def _tables(spark, folder, lines, funds):
    day = datetime(1997, 5, 2)
    li = spark.createDataFrame(
        [(k, 7, s, n, 3.0, price, 0.0, flag, status, day) for k, (s, n, price, flag, status) in enumerate(lines)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    li.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(7, "oak peg", "Brand#1", "LARGE TIN")], "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame(funds, "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    return folder


def _texts(folder):
    texts, folder = [], folder.replace("file:", "")
    for f in os.listdir(folder):
        if f.startswith("part"):
            with gzip.open(os.path.join(folder, f), "rt", encoding="utf-8", newline="") as g:
                texts += g.read().split(f"\n{BREAK}\n")[:-1]
    return sorted(texts)


def test_statement_of_a_key_that_suppliers_share(spark, tmp_dir):
    sf = _tables(spark, f"{tmp_dir}/t", [(1, 1, 1000.0, "A", "F"), (1, 2, 20.0, "N", "O"), (1, 7, 5.0, None, "F")],
                 [(1, "Fund B", 1), (1, "Fund A", 1), (1, "Fund A", 2), (2, "Fund without items", 3)])
    head = lambda sched: ["Fund A", "Fund B", *[x for x in (sched, "May 2, 1997", "Issue", "currency", "Number of units", "Cost", "Fair value") for _ in "ab"]]
    item = lambda key, n, amounts: f"oak peg Brand#1, lot {key}-{n}, large tin grade, due 1997/05/02 {amounts}"
    cont = "Schedule of Investment Portfolio (cont’d)"
    none = [*head(cont), "Line status F (weights in %):", *[item(2, 7, "CAD 3 5 (5)")] * 3, "15 (15)", "15 (15)"]
    a = [*head("Schedule of Investment Portfolio"), *["Flag A items:"] * 2, "Line status F (weights in %):", *[item(0, 1, "CAD 3 1,000 1,000")] * 3,
         "3,000 3,000", "Total flag A items 3,000 3,000"]
    n = [*head(cont), *["Flag N items:"] * 2, "Line status O (weights in %):",
         *["oak peg Brand#1, lot 1-2,", "large tin grade, due 1997/05/02", "USD 3 20 20"] * 3, "60 60", "Total flag N items 60 60",
         "Total investments 1,025 1,015", "Total investments 2,050 2,030", "Cash (Bank overdraft) (0.1%) 18", "Cash (Bank overdraft) (0.1%) 9",
         "Total net assets attributable to holders of redeemable units (100.0%) 1,024",
         "Total net assets attributable to holders of redeemable units (100.0%) 2,048"]
    assert _texts(fx.statements_text(spark, sf)) == ["\f".join("\n".join(page) for page in (none, a, n))]


def test_statements_are_rendered_group_by_group(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, f"{tmp_dir}/t", [(s, 1 + (s + i) % 7, 10.0 * i + s, "AN"[i % 2], "FO"[i % 3 % 2]) for i in range(12) for s in range(9)],
                 [(s, f"Fund {s}", s % 3) for s in range(9)])
    monkeypatch.setattr(fx, "RENDER_BYTES", 1500)
    texts, folders = [], []
    for folder in fx.statement_folders(spark, sf):
        assert not any(map(os.path.exists, folders))
        folders.append(folder.replace("file:", ""))
        texts += _texts(folders[-1])
    assert len(folders) > 2 and not any(map(os.path.exists, folders))
    state = {q: sorted(map(repr, Q.__dict__[q](spark, sf).collect())) for q in ("statement_state", "statement_holdings", "statement_reconcile")}
    assert sorted(texts) == _texts(fx.statements_text(spark, sf)) and len(texts) == 9
    assert len(state["statement_holdings"]) == 108 and all("ok=True" in r for r in state["statement_reconcile"])
    monkeypatch.undo()
    again = f"{tmp_dir}/once"
    os.symlink(f"{tmp_dir}/t", again)  # another path: nothing kept by path is used again
    assert state == {q: sorted(map(repr, Q.__dict__[q](spark, again).collect())) for q in state}
