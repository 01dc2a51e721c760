"""Statement extraction (S09, W01-W03, F02-F08, X08, G03) on a small
statement in the published layout (made-up fund, re-typed line shapes)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundlake.operators import statements as S
from fundlake.operators.scan import ordered_scan

FUND = "Example Bond Fund"
TEXT = "\n".join([
    FUND,
    "Schedule of Investment Portfolio",
    "December 31, 2024",
    "Issue",
    "currency",
    "Fair value",
    "Mutual funds:",
    "Harbour Pooled Trust, Series K CAD 1,000 2,000 2,100",
    "Total mutual funds (10.0%) 2,000 2,100",
    "Corporate bonds:",
    "Canada (5.0%):",
    "Granite Paper Mills, Senior, 4.10%, 2031/05/09 CAD 100 110 120",
    "Willow Ferry Lines, Secured, 5.75%,",
    "2033/02/14",
    "CAD 200 190 (30)",
    "300 90",
    "Total corporate bonds (5.0%) 300 90",
]) + "\f" + "\n".join([
    FUND,
    "Schedule of Investment Portfolio (cont’d)",
    "December 31, 2024",
    "Derivative liabilities:",
    "Lakeside Trustco, Interest Swap, closing",
    "2026/08/03",
    "0.91 EUR 1,500 CAD 2,000 (40)",
    "Total derivative liabilities (‑0.4%) (40)",
    "Cash (Bank overdraft) (1.0%) 500",
    "Total investments (15.0%) 2,300 2,190",
    "Total net assets attributable to holders of redeemable units (100.0%) 2,650",
    "Notes to the statements",
])


@pytest.fixture(scope="module")
def parsed(spark):
    docs = spark.createDataFrame([("d1", TEXT)], "doc_id string, text string")
    codes = spark.createDataFrame([(FUND, "0042")], "fund_name string, fund_code string")
    return S.statement_lines(docs), codes


@pytest.mark.parametrize("block", [2, 4096])
def test_holdings(spark, parsed, block):
    lines, codes = parsed
    st = S.statement_state(lines, codes, block_lines=block)
    h = {(r.page, r.line_no): r for r in S.statement_holdings(lines, codes, state=st).collect()}
    assert sorted(h) == [(1, 8), (1, 12), (1, 15), (2, 7), (2, 9)]
    assert h[(2, 7)].sec_name == "Lakeside Trustco, Interest Swap, closing 2026/08/03"
    assert (float(h[(2, 7)].units), float(h[(2, 7)].cost), float(h[(2, 7)].mv)) == (1500, 2000, -40)
    wrapped = h[(1, 15)]
    assert wrapped.sec_name == "Willow Ferry Lines, Secured, 5.75%, 2033/02/14"
    assert (wrapped.issuer, wrapped.issue, wrapped.currency) == ("Willow", "2033/02/14", "CAD")
    assert float(wrapped.mv) == -30 and wrapped.sector == "Canada (5.0%)"
    assert str(wrapped.date) == "2024-12-31" and wrapped.fund_code == "0042"
    kinds = [r.kind for r in S.statement_holdings(lines, codes, state=st).orderBy("page", "line_no").collect()]
    assert kinds == ["holding", "holding", "holding", "derivative", "cash"]


def test_reconcile(spark, parsed):
    lines, codes = parsed
    r = S.statement_reconcile(lines, codes).orderBy("page", "line_no").collect()
    assert all(x.ok for x in r), [(x.label, x.item_mv, x.printed_mv) for x in r]
    assert [x.kind for x in r] == ["total", "subtotal", "total", "total", "total", "end"]
    assert r[-1].n_items == 5


def test_captions_and_notes_join_no_name(spark, parsed):
    _, codes = parsed
    text = "\n".join([FUND, "Schedule of Investment Portfolio", "December 31, 2024", "Issue", "currency",
                      "Number of units /", " Face value ($)", "Fair value", "Bonds:",
                      "Amber Rail, 2.00%, 2030/01/01 CAD 1 2 3"])
    more = "\n".join([FUND, "Schedule of Investment Portfolio (cont’d)", "December 31, 2024",
                      "The accompanying notes are an integral part of these financial statements. 9",
                      "Issue currency", "Cost ($)", "Birch Holdings, 3.10%,", "2031/02/02", "CAD 4 5 6",
                      "An odd footer", "Cedar Works, 3.10% CAD 7 8 9", "Contract", "rate Pay Receive",
                      "Unrealized gain", "(loss)", "Dune Bank, swap,", "2026/01/01 CAD 1 2 3"])
    docs = spark.createDataFrame([("d", text + "\f" + more)], "doc_id string, text string")
    h = S.statement_holdings(S.statement_lines(docs), codes).orderBy("page", "line_no").collect()
    assert [r.sec_name for r in h] == ["Amber Rail, 2.00%, 2030/01/01", "Birch Holdings, 3.10%, 2031/02/02",
                                       "Cedar Works, 3.10%", "Dune Bank, swap, 2026/01/01"]
    assert {r.sector for r in h} == {"Bonds"}


def test_unknown_fund_is_not_extracted(spark, parsed):
    lines, _ = parsed
    other = spark.createDataFrame([("Another Fund", "1")], "fund_name string, fund_code string")
    assert S.statement_holdings(lines, other).count() == 0


def test_blank_pages_dropped(spark):
    docs = spark.createDataFrame([("d", "a\nb\f\fc")], "doc_id string, text string")
    rows = [(r.page, r.line_no, r.line, r.prev_line) for r in S.statement_lines(docs).orderBy("page", "line_no").collect()]
    assert rows == [(1, 1, "a", None), (1, 2, "b", "a"), (3, 1, "c", None)]


def test_ordered_scan_matches_plain_window(spark):
    rows = [(d, p, i, (i * 7 + d) % 5 if (i * 3 + p) % 4 == 0 else None, (i + d) % 3)
            for d in range(3) for p in range(1, 4) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "d int, p int, i int, v int, w int")
    df = df.withColumn("blk", (F.col("i") / 6).cast("int"))
    out = ordered_scan(df, ["d"], ["p", "blk"], ["i"],
                       forward={"f": F.col("v")}, backward={"b": F.col("v")},
                       running={"r": F.col("w")}, previous={"q": F.col("w")})
    w = Window.partitionBy("d").orderBy("p", "i")
    ref = df.select("d", "p", "i",
                    F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("f"),
                    F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b"),
                    F.coalesce(F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("r"),
                    F.lag("w").over(w).alias("q"))
    got = sorted(tuple(r) for r in out.select("d", "p", "i", "f", "b", "r", "q").collect())
    assert got == sorted(tuple(r) for r in ref.collect())


def test_splittable_reader_matches_whole_text(spark, tmp_dir):
    import os
    from fundlake.sources.statements import read_statement_lines
    texts = {"a": "l1\nl2\fp2a\np2b\f\fp4\nx", "b": "\fstart\nsecond\n\nfourth", "c": TEXT,
             "d": "x\fy\f", "e": "p1\n\fp2\n line\f\n\fz"}
    for k, v in texts.items():
        with open(os.path.join(tmp_dir, k + ".txt"), "w", encoding="utf-8") as f:
            f.write(v)
    ref = sorted(tuple(r) for r in S.statement_lines(S.read_statements(spark, tmp_dir)).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # many splits per file
    try:
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() > len(texts)
        got = sorted(tuple(r) for r in read_statement_lines(spark, tmp_dir, block_lines=3).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == ref


def test_reader_is_the_same_at_any_split_size(spark, tmp_dir):
    import os
    from fundlake.sources.statements import read_statement_lines
    with open(os.path.join(tmp_dir, "a.txt"), "wb") as f:
        f.write(b"one\rtwo\r\nthr\xffee\n\x0cpage two\nend\n")
    rows = []
    for size in ("128m", "8"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows.append(sorted((r.page, r.line_no, r.line, r.prev_line) for r in read_statement_lines(spark, tmp_dir, block_lines=2).collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows[0] == rows[1]
    assert rows[0][:2] == [(1, 1, "one\rtwo", None), (1, 2, "thr\ufffdee", "one\rtwo")] and rows[0][-1][:3] == (2, 2, "end")


def test_positions_of_very_long_pages_stay_apart(spark):
    head = [FUND, "Schedule of Investment Portfolio", "December 31, 2024"]
    lines = [("d", 1, i + 1, x, None) for i, x in enumerate(head)]
    lines += [("d", 1, 1_000_005, "Granite Paper Mills CAD 1 2 3", None), ("d", 2, 5, "TotalWind SE EUR 4 5 6", None)]
    df = spark.createDataFrame(lines, "doc_id string, page int, line_no int, line string, prev_line string")
    df = df.withColumn("prev_line", F.when(F.col("line_no") == 3, F.lit("Schedule of Investment Portfolio")))
    codes = spark.createDataFrame([(FUND, "0042")], "fund_name string, fund_code string")
    got = S.statement_holdings(df, codes).orderBy("page").collect()
    assert [float(r.mv) for r in got] == [3, 6] and got[1].issuer == "TotalWind"


def _one_page(spark, *lines):
    text = "\n".join([FUND, "Schedule of Investment Portfolio", "December 31, 2024", *lines])
    docs = spark.createDataFrame([("d1", text)], "doc_id string, text string")
    return S.statement_lines(docs), spark.createDataFrame([(FUND, "0042")], "fund_name string, fund_code string")


def test_long_captions_join_no_name(spark):
    caption = "Issue currency number of units cost ($) fair value ($) " * 3 + "unrealized gain (loss)"
    lines, codes = _one_page(spark, "Mutual funds:", "Issue", caption, "harbour Trust CAD 10 20 30", "Total mutual funds (1.0%) 20 30")
    assert len(caption) > 100
    assert [r.sec_name for r in S.statement_holdings(lines, codes).collect()] == ["harbour Trust"]


def test_names_with_the_word_total_are_holdings(spark):
    lines, codes = _one_page(spark, "Mutual funds:", "Total Return Bond Trust CAD 10 20 30", "Northern Total Market Fund CAD 1 5 6",
                             "25 36", "Total mutual funds (1.0%) 25 36", "Total investments (1.0%) 25 36")
    assert sorted(r.sec_name for r in S.statement_holdings(lines, codes).collect()) == ["Northern Total Market Fund", "Total Return Bond Trust"]
    checks = S.statement_reconcile(lines, codes).collect()
    assert len(checks) == 3 and all(r.ok and r.n_items == 2 for r in checks)


def test_statements_sharing_a_file_read_as_their_own_files(spark, tmp_dir):
    import os
    from fundlake.sources.statements import read_statement_lines
    texts = ["l1\nl2\fp2a\np2b\f\fp4\nx", "\fstart\nsecond\n\nfourth", TEXT, "", "x\fy\f", "p1\n\fp2\n line\f\n\fz", "last\r\nline"]
    files = os.path.join(tmp_dir, "one-each"), os.path.join(tmp_dir, "shared")
    for f in files:
        os.makedirs(f)
    for k, v in enumerate(texts):
        with open(os.path.join(files[0], f"{k}.txt"), "w", encoding="utf-8", newline="") as f:
            f.write(v + "\n")
    for name, part in (("a", texts[:4]), ("b", texts[4:])):
        with open(os.path.join(files[1], f"{name}.txt"), "w", encoding="utf-8", newline="") as f:
            f.write("".join(v + "\n\u001d\n" for v in part))

    def documents(path, **how):
        docs = {}
        for r in read_statement_lines(spark, path, block_lines=2, **how).collect():
            docs.setdefault(r.doc_id, []).append((r.page, r.line_no, r.line, r.prev_line))
        return sorted((sorted(d, key=lambda x: x[:2]) for d in docs.values()), key=repr)

    want = documents(files[0])
    assert len(want) == 6
    for size in ("128m", "64", "8"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert documents(files[1], document_break="\u001d") == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rendered_statements_share_files(spark):
    from fundlake.plans import fixtures as fx
    sf = "/root/testdata/sf0.001"
    path = fx.statements_text(spark, sf)
    raw = spark.read.text(path)
    assert raw.where(F.col("value") == fx.DOCUMENT_BREAK).count() == fx.statement_items(spark, sf).select("doc").distinct().count()
    assert len(raw.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
