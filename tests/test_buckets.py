"""Merges and comparisons by bucket, partitions by date, skipped lines in one scan."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from fundlake.operators.ingest import ingest
from fundlake.operators.merge import BUCKET, create_keyed_table, merge_buckets
from fundlake.operators.procedures import run_procedure
from fundlake.operators.verify import keyed_diff
from fundlake.session import unique_name
from fundlake.sinks.tables import create_table, replace_partitions
from fundlake.sources.delimited import read_delimited
from fundlake.spec import HOLDINGS, IngestSpec, TargetColumn

from conftest import write
from test_plans import _plan

COLLATION = "UNICODE_CI_AI_RTRIM"


def _rows(spark, table, *cols):
    return sorted((tuple(r) for r in spark.table(table).select(*cols).collect()), key=repr)


def _files(spark, table):
    out = {}
    for r in spark.table(table).select(BUCKET, F.col("_metadata.file_path").alias("f")).distinct().collect():
        out.setdefault(r[0], set()).add(r[1])
    return out


def test_replace_rewrites_only_touched_buckets(spark):
    t = unique_name("keyed")
    create_keyed_table(spark, t, "code VARCHAR(10), class INT, v INT", ["code", "class"], COLLATION, 16)
    first = [(f"É{i}", i % 3, i) for i in range(200)] + [(None, 1, -1)]
    merge_buckets(spark, t, spark.createDataFrame(first, "code string, class int, v int"))
    before = _files(spark, t)
    update = [("e7 ", 1, 1000), ("e8", 0, 1001), ("new", 0, 1002), (None, 1, -2)]  # e8 is of class 2: a new key
    touched = merge_buckets(spark, t, spark.createDataFrame(update, "code string, class int, v int"))
    want = [r for r in first if r[0] != "É7"] + update
    assert _rows(spark, t, "code", "class", "v") == sorted(want, key=repr)
    after = _files(spark, t)
    assert 0 < len(touched) <= 4 and all(after[b] == f for b, f in before.items() if b not in touched)
    assert all(not (after[b] & before.get(b, set())) for b in touched)


def test_append_keeps_known_keys_and_old_files(spark):
    t = unique_name("keyed")
    create_keyed_table(spark, t, "k INT, v INT", ["k"], buckets=4)
    merge_buckets(spark, t, spark.range(50).selectExpr("int(id) k", "0 v"), "append")
    before = _files(spark, t)
    merge_buckets(spark, t, spark.range(40, 60).selectExpr("int(id) k", "1 v"), "append")
    assert _rows(spark, t, "k", "v") == sorted([(k, 0 if k < 50 else 1) for k in range(60)], key=repr)
    assert all(f <= _files(spark, t)[b] for b, f in before.items())
    assert merge_buckets(spark, t, spark.range(0).selectExpr("int(id) k", "1 v")) == []
    with pytest.raises(ValueError, match="repeat a key"):
        merge_buckets(spark, t, spark.createDataFrame([(1, 1), (1, 2)], "k int, v int"))


def _brute(a, b):
    out = {}
    for k in {r[0] for r in a + b}:
        x, y = ([r for r in side if r[0] == k] for side in (a, b))
        if sorted(x, key=repr) != sorted(y, key=repr):
            wrong = [c for i, c in ((1, "s"), (2, "n")) if sorted((r[i] for r in x), key=repr) != sorted((r[i] for r in y), key=repr)]
            status = "only_a" if not y else "only_b" if not x else "count" if len(x) != len(y) else "values"
            out[k] = (len(x), len(y), status, wrong if status == "values" else [])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_keyed_diff_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    a = [(rnd.choice([None, *range(60)]), rnd.choice([None, "", "x", "y"]), rnd.choice([None, 0, 1])) for _ in range(80)]
    b = [r if rnd.random() < 0.8 else (r[0], rnd.choice([None, "", "z"]), r[2]) for r in a if rnd.random() < 0.9] + [(99, "x", 1)]
    schema = "k int, s string, n int"
    d = keyed_diff(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], ["s", "n"], buckets=8)
    assert {r.k: (r.n_a, r.n_b, r.status, list(r.mismatched)) for r in d.collect()} == _brute(a, b)


def test_keyed_diff_reads_differing_buckets_only(spark):
    schema = "k int, v int"
    names = []
    for change in (0, 1):
        t = unique_name("cmp")
        create_keyed_table(spark, t, "k INT, v INT", ["k"], buckets=32)
        merge_buckets(spark, t, spark.createDataFrame([(k, k + (change if k == 5 else 0)) for k in range(500)], schema))
        names.append(spark.table(t))
    d = keyed_diff(*names, ["k"], ["v"], bucket=BUCKET)
    at = names[0].where("k = 5").first()[BUCKET]
    plan = _plan(d)
    assert plan.count(f"PartitionFilters: [isnotnull({BUCKET}") == 2 and f"= {at})" in plan
    assert [(r.k, r.status, r.mismatched) for r in d.collect()] == [(5, "values", ["v"])]
    assert keyed_diff(names[0], names[0], ["k"], ["v"], bucket=BUCKET).count() == 0


def test_keyed_diff_of_empty_tables(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert keyed_diff(none, none, ["k"], ["v"]).collect() == []
    assert [r.status for r in keyed_diff(none, spark.createDataFrame([(1, None)], "k int, v int"), ["k"], ["v"]).collect()] == ["only_b"]


def _holding(date, name, mv):
    return f'{date},F,{name},S,CAD,1,1,{mv}\n'


def test_one_date_is_replaced_and_pruned(spark, tmp_dir):
    head = ",".join(c.name for c in HOLDINGS.columns) + "\n"
    spec = HOLDINGS.with_options(partition_by="date", surrogate_id="id")
    t = unique_name("by_date")
    a = write(f"{tmp_dir}/a.csv", head + _holding("2024-12-31", "A", 1) + _holding("2024-12-31", "B", 2) + _holding("2025-03-31", "A", 3))
    b = write(f"{tmp_dir}/b.csv", head + _holding("2024-12-31", "A", 9) + _holding("2025-06-30", "A", 4))
    ingest(spark, spec, a, table=t)
    stays = {r[0] for r in spark.table(t).where("date = '2025-03-31'").select(F.col("_metadata.file_path")).collect()}
    ingest(spark, spec, b, mode="replace_partitions", table=t)
    assert _rows(spark, t, F.col("date").cast("string"), "sec_name", F.col("mv").cast("int")) == [
        ("2024-12-31", "A", 9), ("2025-03-31", "A", 3), ("2025-06-30", "A", 4)]
    assert spark.table(t).select("id").distinct().count() == 3
    assert {r[0] for r in spark.table(t).where("date = '2025-03-31'").select(F.col("_metadata.file_path")).collect()} == stays
    plan = _plan(run_procedure(spark, "usp_holdweb_process", table=t, date="2025-03-31"))
    assert re.search(r"PartitionFilters: \[[^]]*date#\d+ = 2025-03-31", plan)
    ingest(spark, spec, b, table=t)  # a whole replace drops the other dates
    assert [r[0] for r in _rows(spark, t, F.col("date").cast("string"))] == ["2024-12-31", "2025-06-30"]


def test_partition_modes_are_checked(spark, tmp_dir):
    with pytest.raises(ValueError, match="replace_partitions needs"):
        ingest(spark, HOLDINGS, f"{tmp_dir}/none.csv", mode="replace_partitions")
    with pytest.raises(ValueError, match="replace_partitions needs"):
        ingest(spark, HOLDINGS.with_options(partition_by="date", unique_key=("sec_name",)), f"{tmp_dir}/none.csv", mode="replace_partitions")
    t = unique_name("plain")
    create_table(spark, t, "a INT, d DATE", partition_by="d")
    with pytest.raises(Exception, match="NULL in partition column d"):
        replace_partitions(spark, t, spark.createDataFrame([(1, None)], "a int, d date"))
    assert replace_partitions(spark, t, spark.createDataFrame([], "a int, d date")) == []


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_skipped_lines_take_one_scan(spark, tmp_dir, split):
    spec = IngestSpec(name="s", target_table="s", columns=(TargetColumn("a", "string"),), field_mappings=(("a", "a"),), skip_lines=3)
    want = []
    for i, n in enumerate((0, 1, 2, 3, 4, 50, 7)):  # lines per file, the head included; head lines are short
        lines = [f"h{i}{j}" for j in range(min(n, 3))] + [f"{i}-{j}" for j in range(3, n)]
        write(f"{tmp_dir}/f{i}.csv", "\n\n".join(lines) + "\n")
        want += lines[3:]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        raw = read_delimited(spark, [os.path.join(tmp_dir, f) for f in sorted(os.listdir(tmp_dir))], spec)
        assert sorted(r["a"] for r in raw.select("a").collect()) == sorted(want)
        assert _plan(raw).count("FileScan") == 1 and "Exchange" not in _plan(raw)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
