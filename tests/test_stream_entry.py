"""File-arrival stream (S07) and the driver contract."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write
from fundlake.session import unique_name
from fundlake.spec import IngestSpec, TargetColumn as C
from fundlake.streaming.file_stream import ingest_stream, loaded

SPEC = IngestSpec(name="ev", target_table="ev",
                  columns=(C("id", "bigint", False), C("kind", "varchar(8)")),
                  field_mappings=(("id", "id"), ("kind", "kind")))


def test_each_file_loaded_once(spark, tmp_dir):
    incoming = os.path.join(tmp_dir, "incoming")
    os.makedirs(incoming)
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    write(os.path.join(incoming, "a.csv"), "id,kind\n1,x\n2,y\n")
    write(os.path.join(incoming, "b.csv"), "id,kind\n3,z\nbad,toolongvalue\n")
    ingest_stream(spark, SPEC, incoming, sink, ckpt, max_files_per_trigger=1,
                  archive_dir=os.path.join(tmp_dir, "archive")).awaitTermination()
    assert sorted(r.id for r in loaded(spark, sink, SPEC).collect()) == [1, 2, 3]
    assert spark.read.parquet(sink + "__rejects").count() == 1
    # a second run over the same folder loads only the new file
    write(os.path.join(incoming, "c.csv"), "id,kind\n4,w\n")
    ingest_stream(spark, SPEC, incoming, sink, ckpt, max_files_per_trigger=1,
                  archive_dir=os.path.join(tmp_dir, "archive")).awaitTermination()
    assert sorted(r.id for r in loaded(spark, sink, SPEC).collect()) == [1, 2, 3, 4]
    archived = [f for _, _, fs in os.walk(os.path.join(tmp_dir, "archive")) for f in fs if f.endswith(".csv")]
    assert archived  # processed files leave the incoming folder (at least one batch behind)


def test_stream_checks_keys_across_files(spark, tmp_dir):
    spec = SPEC.with_options(unique_key=("kind",), surrogate_id="row_id")
    incoming = os.path.join(tmp_dir, "incoming")
    os.makedirs(incoming)
    sink, ckpt, audit = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"), unique_name("audit")

    def run():
        ingest_stream(spark, spec, incoming, sink, ckpt, max_files_per_trigger=1, audit_table=audit).awaitTermination()

    write(os.path.join(incoming, "a.csv"), "id,kind\n1,K\n2,y\n")
    run()
    write(os.path.join(incoming, "b.csv"), "id,kind\n3,z\n")
    run()
    assert sorted(r.row_id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]
    write(os.path.join(incoming, "c.csv"), "id,kind\n4,k \n")
    with pytest.raises(Exception, match="unique key"):
        run()
    assert spark.read.parquet(sink).count() == 3
    assert [(r.status, r.rows_loaded) for r in spark.table(audit).orderBy("started_at").collect()] == [
        ("ok", 2), ("ok", 1), ("failed", 0)]


KEYED = SPEC.with_options(unique_key=("kind",), surrogate_id="row_id")


def folders(tmp_dir):
    incoming = os.path.join(tmp_dir, "incoming")
    os.makedirs(incoming)
    return incoming, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")


def test_replayed_epoch_leaves_one_audit_row_and_the_same_ids(spark, tmp_dir):
    incoming, sink, ckpt = folders(tmp_dir)
    audit = unique_name("audit")

    def run():
        ingest_stream(spark, KEYED, incoming, sink, ckpt, max_files_per_trigger=1, audit_table=audit).awaitTermination()
        return sorted((r.row_id, r.kind) for r in spark.read.parquet(sink).collect())

    write(os.path.join(incoming, "a.csv"), "id,kind\n1,p\n2,q\n")
    run()
    write(os.path.join(incoming, "b.csv"), "id,kind\n3,r\n4,s\n")
    before = run()
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(ckpt, "commits", name))  # as if the driver had died after the batch was written
    assert run() == before and [i for i, _ in before] == [1, 2, 3, 4]
    assert sorted((r.status, r.rows_loaded) for r in spark.table(audit).collect()) == [("ok", 2), ("ok", 2)]
    write(os.path.join(incoming, "c.csv"), "id,kind\n5,t\n")
    assert run()[-1] == (5, "t")


@pytest.mark.parametrize("old, new, refused", [
    ("Café", "cafe  ", True), ("STRASSE", "straße", True), ("ab", "a\u0001b", True), ("x1", "x\u00b9", True), ("æon", "AEON", None), ("æon", "Æon", True),
    ("ab", "abc", False), ("a b", "ab", False), ("зима", "ЗИМА", True), ("", "", True)])
def test_state_keys_hold_the_collation(spark, tmp_dir, old, new, refused):
    """A key over two files is refused exactly when the table's collation calls it equal."""
    equal = spark.range(1).select((F.collate(F.lit(old), "UNICODE_CI_AI_RTRIM") == F.collate(F.lit(new), "UNICODE_CI_AI_RTRIM")).alias("e")).first().e
    assert refused is None or equal == refused
    incoming, sink, ckpt = folders(tmp_dir)
    for name, kind in (("a", old), ("b", new)):
        write(os.path.join(incoming, f"{name}.csv"), f'id,kind\n1,"{kind}"\n')
        try:
            ingest_stream(spark, KEYED, incoming, sink, ckpt).awaitTermination()
        except Exception as e:
            assert name == "b" and equal and "unique key" in str(e)
        else:
            assert name == "a" or not equal


def test_batches_do_not_read_earlier_batches(spark, tmp_dir):
    """Keys and ids come from the state and the ledger: the sink's earlier rows may be gone."""
    incoming, sink, ckpt = folders(tmp_dir)
    write(os.path.join(incoming, "a.csv"), "id,kind\n1,p\n2,q\n")
    ingest_stream(spark, KEYED, incoming, sink, ckpt).awaitTermination()
    os.rename(sink, sink + "-away")
    write(os.path.join(incoming, "b.csv"), "id,kind\n3,r\n,\n")
    ingest_stream(spark, KEYED, incoming, sink, ckpt).awaitTermination()
    assert [(r.row_id, r.kind) for r in spark.read.parquet(sink).collect()] == [(3, "r")]


def test_procedure_runs_on_each_batch(spark, tmp_dir):
    from fundlake.spec import HOLDINGS
    incoming, sink, ckpt = folders(tmp_dir)
    got = {}

    def run():
        ingest_stream(spark, HOLDINGS, incoming, sink, ckpt, procedure_params={"date": "2020-01-02"},
                      after=lambda rows, epoch: got.setdefault(epoch, sorted(r.sec_name for r in rows.collect()))).awaitTermination()

    head = "date,fund_name,sec_name,sector,currency,units,cost,mv\n"
    write(os.path.join(incoming, "a.csv"), head + "2020-01-02,F,one,S,CAD,1,2,3\n2020-01-03,F,two,S,CAD,1,2,3\n")
    run()
    write(os.path.join(incoming, "b.csv"), head + "2020-01-02,F,three,S,CAD,1,2,3\n")
    run()
    assert got == {0: ["one"], 1: ["three"]}


def test_driver_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 30
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["sector", "currency", "n", "mv", "wt"]
    assert abs(sum(float(r.wt) for r in rows) - 1.0) < 1e-6


def test_flows(spark, tmp_dir):
    from conftest import write as w
    from fundlake.flows import extract_holdings, import_web_classfees
    from test_ingest import CLASS_FEE_TEXT
    from test_statements import FUND, TEXT
    fees = w(os.path.join(tmp_dir, "fees.csv"), CLASS_FEE_TEXT)
    r = import_web_classfees(spark, fees)
    assert r.rows_loaded == 4 and r.procedure_result.count() == 4
    os.makedirs(os.path.join(tmp_dir, "stmts"))
    w(os.path.join(tmp_dir, "stmts", "s1.txt"), TEXT)
    codes = spark.createDataFrame([(FUND, "0042")], "fund_name string, fund_code string")
    n = extract_holdings(spark, os.path.join(tmp_dir, "stmts"), codes, os.path.join(tmp_dir, "out"))
    assert n == 5
    back = spark.read.option("header", "true").csv(os.path.join(tmp_dir, "out"))
    assert back.count() == 5 and back.columns[:3] == ["date", "fund_name", "fund_code"]
