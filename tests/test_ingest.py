"""Ingestion semantics (S01-S05, P01-P03, K01-K09) on small literal files."""

import os
from types import MappingProxyType

import pytest

from conftest import write
from fundlake.operators.ingest import IngestError, ingest, rewrite_transform, validate
from fundlake.session import unique_name
from fundlake.sources.delimited import read_delimited, source_exists
from fundlake.spec import CLASS_FEES, IngestSpec, TargetColumn as C

# Class-fee rows in the layout of the published fixture (codes and names made up; one
# 'Closed' row, and the last row ending "CAD " without a final newline).
CLASS_FEE_TEXT = (
    "fund_code,fund_name,class,description,mer,trailer,performance_fee,min_investment_initial,"
    "min_investment_subsequent,currency\n"
    "QRS 71,Quarry Ridge Income Fund,B,Load,3.05,0.40,,700,50,CAD\n"
    "QRS 72,Quarry Ridge Income Fund,K,No Load,0.88,,,700,50,CAD\n"
    "QRS 9,Tall Pine Growth Fund,B,Load,2.17,0.75,,Closed,Closed,CAD\n"
    "QRS 605,Tall Pine Income Fund,M,Advisory,1.93,,9% over 2%,40,4,CAD ")


def test_rewrite_transform_keeps_literals():
    assert rewrite_transform("NULLIF(@Trailer, '')") == "NULLIF(`Trailer`, '')"
    assert rewrite_transform("concat(@a, '@b')") == "concat(`a`, '@b')"


def test_class_fees_load(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "fees.csv"), CLASS_FEE_TEXT)
    t = unique_name("fees")
    r = ingest(spark, CLASS_FEES, path, table=t, on_bad="fail")
    assert (r.rows_read, r.rows_loaded, r.rows_rejected) == (4, 4, 0)
    rows = {(x.FundCode, x.Class): x for x in spark.table(t).collect()}
    a = rows[("QRS 71", "B")]
    assert str(a.Mer) == "3.05" and str(a.Trailer) == "0.40" and a.Currency == "CAD"
    f2 = rows[("QRS 72", "K")]
    assert str(f2.Mer) == "0.88" and f2.Trailer is None and f2.PerformanceFee is None
    assert rows[("QRS 9", "B")].MinInvestmentInitial == "Closed"  # kept: NULLIF only blanks
    last = rows[("QRS 605", "M")]
    assert last.Currency == "CAD"  # trailing space trimmed into VARCHAR(3)
    assert last.PerformanceFee == "9% over 2%"
    ids = sorted(x.id for x in rows.values())
    assert ids == [1, 2, 3, 4]
    proc = r.procedure_result
    assert proc.count() == 4 and "id" not in proc.columns


SPEC = IngestSpec(
    name="t", target_table="t",
    columns=(C("k", "bigint", False), C("name", "varchar(5)", False), C("amt", "decimal(5,2)"),
             C("note", "string")),
    field_mappings=(("K", "k"), ("N", "name"), ("A", "amt"), ("X", "note")),
    field_transformations=MappingProxyType({"A": "NULLIF(@A, '')"}))


def test_null_and_empty_rules(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "a.csv"),
                 'k,n,a,x\n1,ab,,\n2,cd,1.5,\\N\n3,ef,2,""\n')
    rows = {r.k: r for r in validate(read_delimited(spark, path, SPEC), SPEC).collect()}
    assert rows[1].amt is None and rows[1].note == ""       # empty -> '' ; NULLIF -> NULL
    assert rows[2].note is None and str(rows[2].amt) == "1.50"  # \N -> NULL
    assert rows[3].note == ""                               # quoted empty -> ''
    assert all(r._reject_reason is None for r in rows.values())


def test_rejects_have_reasons(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "b.csv"),
                 "k,n,a,x\n"
                 "1,toolongname,1,x\n"   # overlong varchar
                 "2,ok,123456,x\n"       # decimal overflow
                 "3,ok\n"                # too few fields
                 "4,ok,1,x,extra\n"      # too many fields
                 "5,\\N,1,x\n"           # NULL into NOT NULL
                 "6,ok,abc,x\n"          # bad number
                 "7,ok   ,1,x\n")        # trailing spaces trimmed to fit
    out = validate(read_delimited(spark, path, SPEC), SPEC).collect()
    by_key = {}
    for r in out:
        key = r.k if r.k is not None else int(r._raw_record.split(",")[0])
        by_key[key] = r
    assert by_key[1]._reject_reason == "bad value for name"
    assert by_key[2]._reject_reason == "bad value for amt"
    assert by_key[3]._reject_reason == "malformed record"
    assert by_key[4]._reject_reason == "malformed record"
    assert by_key[5]._reject_reason == "NULL in NOT NULL column name"
    assert by_key[6]._reject_reason == "bad value for amt"
    assert by_key[7]._reject_reason is None and by_key[7].name == "ok   "[:5]


def test_fail_mode_leaves_table_untouched(spark, tmp_dir):
    good = write(os.path.join(tmp_dir, "g.csv"), "k,n,a,x\n1,a,1,x\n")
    bad = write(os.path.join(tmp_dir, "bad.csv"), "k,n,a,x\n2,b,zz,x\n")
    t = unique_name("t")
    ingest(spark, SPEC, good, table=t, on_bad="fail")
    with pytest.raises(IngestError):
        ingest(spark, SPEC, bad, table=t, on_bad="fail")
    assert [r.k for r in spark.table(t).collect()] == [1]
    r = ingest(spark, SPEC, bad, table=t, on_bad="quarantine", mode="append")
    assert r.rows_rejected == 1 and spark.table(t).count() == 1


def test_unique_key_case_insensitive(spark, tmp_dir):
    spec = SPEC.with_options(unique_key=("name",))
    path = write(os.path.join(tmp_dir, "u.csv"), "k,n,a,x\n1,Abc,1,x\n2,aBC ,1,x\n")
    with pytest.raises(IngestError, match="unique key"):
        ingest(spark, spec, path, table=unique_name("t"), on_bad="fail")


def test_skip_lines_and_delimiters(spark, tmp_dir):
    spec = SPEC.with_options(skip_lines=3, delimiter="|", quote_char="'", line_terminator=";")
    write(os.path.join(tmp_dir, "s1.txt"), "title;note;k|n|a|x;1|'a|b'|1|x;2|c|2|y;")
    write(os.path.join(tmp_dir, "s2.txt"), "t;n;h;3|d|3|z")
    rows = validate(read_delimited(spark, tmp_dir, spec), spec).collect()
    assert sorted((r.k, r.name) for r in rows) == [(1, "a|b"), (2, "c"), (3, "d")]


def test_replace_then_append_ids(spark, tmp_dir):
    spec = SPEC.with_options(surrogate_id="id")
    a = write(os.path.join(tmp_dir, "a.csv"), "k,n,a,x\n1,a,1,x\n2,b,1,x\n")
    t = unique_name("t")
    ingest(spark, spec, a, table=t, mode="replace")
    ingest(spark, spec, a, table=t, mode="replace")
    assert spark.table(t).count() == 2
    ingest(spark, spec, a, table=t, mode="append")
    ids = sorted(r.id for r in spark.table(t).collect())
    assert ids == [1, 2, 3, 4]


def test_source_exists(spark, tmp_dir):
    write(os.path.join(tmp_dir, "x.csv"), "a\n")
    assert source_exists(spark, os.path.join(tmp_dir, "*.csv"))
    assert not source_exists(spark, os.path.join(tmp_dir, "nothing-*.csv"))


def test_skip_lines_over_many_splits(spark, tmp_dir):
    spec = SPEC.with_options(skip_lines=3)
    body = "".join(f"{i},n{i % 7},{i % 5},x\n" for i in range(200))
    write(os.path.join(tmp_dir, "big.csv"), "title\nsubtitle\nk,n,a,x\n" + body)
    write(os.path.join(tmp_dir, "small.csv"), "t\ns\nh\n900,z,1,x\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # the big file spans many splits
    try:
        assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 10
        keys = sorted(r.k for r in validate(read_delimited(spark, tmp_dir, spec), spec).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert keys == list(range(200)) + [900]


@pytest.mark.parametrize("skip", [0, 1, 3])
def test_backslash_escapes_blank_lines_encoding(spark, tmp_dir, skip):
    spec = SPEC.with_options(skip_lines=skip, encoding="ISO-8859-1",
                             columns=(C("k", "bigint", False), C("name", "string"), C("amt", "string"), C("note", "string")),
                             field_transformations=MappingProxyType({}))
    lines = ["1,x\\ty,s\\\\t,u\\,v", '2,"a""b","c\\"d,",caf\xe9', "", "3,\\N,\\\\N,a\\Nb", "4,\x1fb,\x01,\\q"]
    with open(os.path.join(tmp_dir, "e.csv"), "wb") as f:
        f.write("\n".join(["h"] * skip + lines).encode("latin-1"))
    rows = {r.k: (r.name, r.amt, r.note) for r in validate(read_delimited(spark, tmp_dir, spec), spec).collect()}
    assert rows == {1: ("x\ty", "s\\t", "u,v"), 2: ('a"b', 'c"d,', "caf\xe9"),
                    3: (None, "\\N", "aNb"), 4: ("\x1fb", "\x01", "q")}


def test_ragged_lines_come_back_as_written(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "r.csv"), "k,n,a,x\n1,a\\,b,1\n2,c,1,x,y\n3,d,1,z\n")
    raw = read_delimited(spark, path, SPEC)
    assert sorted(r[0] for r in raw.select("_corrupt_record").na.drop().collect()) == ["1,a\\,b,1", "2,c,1,x,y"]


def test_headered_files_bind_by_name(spark, tmp_dir):
    from fundlake.sources.delimited import read_headered
    write(os.path.join(tmp_dir, "1.csv"), "a,b\n1,x\n2,\n")
    write(os.path.join(tmp_dir, "2.csv"), "b,a\r\ny,2.5\r\n")
    write(os.path.join(tmp_dir, "3.csv"), "c,b\n7,8\n")
    write(os.path.join(tmp_dir, "4.csv"), "a,b\n3,z\n")
    write(os.path.join(tmp_dir, "5.csv"), "")
    got = read_headered(spark, tmp_dir)
    assert dict(got.dtypes) == {"a": "double", "b": "string", "c": "int"}
    assert sorted(map(tuple, got.select("a", "b", "c").collect()), key=repr) == sorted(
        [(1.0, "x", None), (2.0, None, None), (2.5, "y", None), (None, "8", 7), (3.0, "z", None)], key=repr)


def test_a_field_is_cast_once(spark, tmp_dir):
    path = write(os.path.join(tmp_dir, "a.csv"), "k,n,a,x\n1,ab,2.5,note\n")
    plan = validate(read_delimited(spark, path, SPEC), SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as decimal(5,2)") == 1 and plan.count("as bigint") == 1


def test_a_clean_replace_writes_its_rows_once(spark, tmp_dir):
    clean = write(os.path.join(tmp_dir, "clean.csv"), "k,n,a,x\n1,ab,2.5,p\n2,cd,,q\n")
    mixed = write(os.path.join(tmp_dir, "mixed.csv"), "k,n,a,x\n3,ef,1.5,r\n4,too long,1,s\n")
    more = write(os.path.join(tmp_dir, "more.csv"), "k,n,a,x\n5,gh,4.5,t\n")
    def files(t):
        return [f.rsplit("/", 1)[0].split(":")[-1].lstrip("/") for f in spark.table(t).inputFiles()]
    def rows(t):
        return sorted((r.k, r.name, r.amt and float(r.amt), r.note) for r in spark.table(t).collect())
    t = unique_name("once")
    r = ingest(spark, SPEC, clean, table=t, on_bad="fail")
    assert spark.table(t).columns == ["k", "name", "amt", "note"]
    assert set(files(t)) == {r.staged_path.split(":")[-1].lstrip("/")}
    ingest(spark, SPEC, more, mode="append", table=t, on_bad="fail")
    assert rows(t) == [(1, "ab", 2.5, "p"), (2, "cd", None, "q"), (5, "gh", 4.5, "t")] and r.rejects.count() == 0
    r = ingest(spark, SPEC, mixed, table=t)  # rejected rows do not reach the table
    assert rows(t) == [(3, "ef", 1.5, "r")] and r.rejects.count() == 1
    # a table of other types keeps its own
    other = unique_name("other")
    spark.sql(f"CREATE TABLE {other} (k INT, name STRING, amt DECIMAL(9,3), note STRING) USING parquet LOCATION '{tmp_dir}/{other}'")
    ingest(spark, SPEC, clean, table=other, on_bad="fail")
    assert [f.dataType.simpleString() for f in spark.table(other).schema] == ["int", "string", "decimal(9,3)", "string"]
    assert rows(other) == [(1, "ab", 2.5, "p"), (2, "cd", None, "q")]
