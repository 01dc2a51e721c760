"""Quoted fields with raw line breaks: every split size gives the whole-file result."""

import random

import pytest

from fundlake.operators.ingest import rejected, validate
from fundlake.sources.delimited import CORRUPT, csv_options, raw_schema, read_delimited
from fundlake.spec import IngestSpec, TargetColumn as C

SPEC = IngestSpec(name="notes", target_table="notes", columns=(C("id", "bigint", False), C("a", "string"), C("b", "string")),
                  field_mappings=(("id", "id"), ("a", "a"), ("b", "b")), escape_char='"', multiline=True, skip_lines=1)
SIZES = ("700", "5000", "128m")


@pytest.fixture()
def split_size(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    def use(size, least="0"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", least)
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def some(rng, n, pool):
    return [(str(i), *("".join(rng.choice(pool) for _ in range(rng.randrange(25))) for _ in range(2))) for i in range(n)]


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def got(df):
    return sorted(tuple(r)[:4] for r in df.collect())


POOL = ["x", "y z", '"', "\n", "\n\n", ",", "é", "\r", '""', "\\", ' "q", ']


def test_quote_dialect_at_any_split(spark, split_size, tmp_path):
    rng = random.Random(1)
    rows = some(rng, 400, POOL)
    rows[70] = ("70", "long\n" * 3000, "over many splits")
    def quoted(x):
        return '"' + x.replace('"', '""') + '"'
    path = put(tmp_path / "a.csv", "id,a,b\n" + "".join(",".join(map(quoted, r)) + "\n" for r in rows))
    other = put(tmp_path / "b.csv", 'id,a,b\n900,plain,"two\nlines"\n\n   \n901,"",\n')
    want = sorted([(*r, None) for r in rows] + [("900", "plain", "two\nlines", None), ("901", "", "", None)])
    for size in SIZES:
        split_size(size)
        df = read_delimited(spark, [path, other], SPEC)
        assert got(df) == want, size
        if size == "700":
            assert spark.read.text(path).rdd.getNumPartitions() > 20
    whole = spark.read.schema(raw_schema(SPEC)).options(**csv_options(SPEC), header="true").csv([path, other]).na.fill("")
    assert [r[:3] for r in got(whole) if r[0].strip()] == [r[:3] for r in want], "as the reader of whole files"


def test_backslash_dialect_at_any_split(spark, split_size, tmp_path):
    rng = random.Random(2)
    rows = some(rng, 300, POOL)
    def quoted(x):
        return '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'
    text = "".join(",".join(map(quoted, r)) + "\n" for r in rows) + '999,\\N,"a\\\nb\\tc"\n'
    spec = SPEC.with_options(escape_char="\\", skip_lines=0)
    for size in SIZES:
        split_size(size)
        assert got(read_delimited(spark, put(tmp_path / "c.csv", text), spec)) == sorted([(*r, None) for r in rows] + [("999", None, "a\nb\tc", None)], key=lambda r: tuple(x or "" for x in r)), size


def test_other_dialects(spark, split_size, tmp_path):
    split_size("128m", "4m")  # both skipped lines stand in the first split
    crlf = put(tmp_path / "d.csv", 'id,a,b\r\nignored too\r\n1,"x\r\ny",z\r\n2,"",w\r\n')
    assert got(read_delimited(spark, crlf, SPEC.with_options(skip_lines=2))) == [("1", "x\r\ny", "z", None), ("2", "", "w", None)]
    split_size("64")
    pipes = put(tmp_path / "e.csv", "1|'a;b'|'it''s;;'; 2|c|;")
    spec = SPEC.with_options(skip_lines=0, delimiter="|", quote_char="'", escape_char="'", line_terminator=";")
    assert got(read_delimited(spark, pipes, spec)) == [(" 2", "c", "", None), ("1", "a;b", "it's;;", None)]
    latin = tmp_path / "f.csv"
    latin.write_bytes('1,"é\nü",ß\n'.encode("latin-1"))
    assert got(read_delimited(spark, str(latin), SPEC.with_options(skip_lines=0, encoding="ISO-8859-1"))) == [("1", "é\nü", "ß", None)]
    empty = put(tmp_path / "g.csv", "")
    assert got(read_delimited(spark, empty, SPEC)) == []


def test_bad_records_are_kept_whole(spark, split_size, tmp_path):
    split_size("64")
    path = put(tmp_path / "h.csv", 'id,a,b\n1,"x\ny",z\n2,"only\ntwo"\nx,stray"quote,"q\n"\n4,"never\nclosed')
    checked = validate(read_delimited(spark, path, SPEC), SPEC)
    bad = {r._raw_record: r._reject_reason for r in rejected(checked).collect()}
    assert bad['2,"only\ntwo"'] == "malformed record" and bad['x,stray"quote,q\n'] == "bad value for id" and len(bad) == 3
    assert any(k.startswith('4,"never\nclosed') for k in bad)
    assert CORRUPT not in checked.columns and checked.count() == 4


def test_lines_are_shuffled_once(spark, tmp_path):
    """Windows and grouping share one exchange of the lines."""
    path = put(tmp_path / "i.csv", '1,"x\ny",z\n')
    plan = read_delimited(spark, path, SPEC)._jdf.queryExecution().executedPlan().toString()
    with_text = [x for x in plan.split("Exchange hashpartitioning(")[1:] if x.startswith("_file") and "_block" in x.split(",")[1]]
    assert with_text and "SinglePartition" not in plan and "Python" not in plan
