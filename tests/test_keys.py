"""Unique keys over repeated appends (K06, K02): the bucketed key table."""

import os

import pytest

from conftest import write
from fundlake.operators import keys
from fundlake.operators.ingest import IngestError, ingest
from fundlake.session import unique_name
from fundlake.spec import IngestSpec, TargetColumn as C

SPEC = IngestSpec(name="k", target_table="k", columns=(C("code", "varchar(20)"), C("cls", "varchar(8)", False), C("n", "int")),
                  field_mappings=(("code", "code"), ("cls", "cls"), ("n", "n")), unique_key=("code", "cls"), surrogate_id="id")


def load(spark, tmp_dir, table, mode, *rows):
    path = write(os.path.join(tmp_dir, unique_name("in") + ".csv"), "code,cls,n\n" + "".join(f"{c},{k},1\n" for c, k in rows))
    ingest(spark, SPEC, path, mode=mode, table=table, on_bad="fail")


def test_appends_ask_the_key_table(spark, tmp_dir):
    t = unique_name("tbl")
    load(spark, tmp_dir, t, "replace", ("Café", "A"), ("x", "A"), ("æon", "A"))
    assert not keys._made_for(spark, t)
    load(spark, tmp_dir, t, "append", ("x", "B"))
    assert keys._made_for(spark, t) and spark.table(f"{t}__keys").count() == 4 and spark.table(f"{t}__hard_keys").count() == 1
    load(spark, tmp_dir, t, "append", ("y", "A"), ("\\N", "A"))
    load(spark, tmp_dir, t, "append", ("\\N", "A"), ("зима", "A"))
    assert keys._made_for(spark, t) and spark.table(t).count() == 8
    for again in (("CAFE ", "a"), ("X", "b"), ("Æon", "A"), ("ЗИМА", "A"), ("y", "A")):
        with pytest.raises(IngestError, match="unique key"):
            load(spark, tmp_dir, t, "append", ("new", "A"), again)
        assert spark.table(t).count() == 8
    with pytest.raises(IngestError, match="unique key"):
        load(spark, tmp_dir, t, "append", ("z", "A"), ("Z", "a"))
    load(spark, tmp_dir, t, "append", ("z", "A"))
    assert sorted(r.id for r in spark.table(t).collect()) == list(range(1, 10))


def test_a_changed_table_makes_the_key_table_invalid(spark, tmp_dir):
    t = unique_name("tbl")
    load(spark, tmp_dir, t, "replace", ("a", "A"))
    load(spark, tmp_dir, t, "append", ("b", "A"))
    spark.sql(f"INSERT INTO {t} VALUES (3, 'c', 'A', 1)")
    assert not keys._made_for(spark, t)
    with pytest.raises(IngestError, match="unique key"):
        load(spark, tmp_dir, t, "append", ("C", "A"))
    load(spark, tmp_dir, t, "append", ("d", "A"))
    assert keys._made_for(spark, t) and spark.table(f"{t}__keys").count() == 4
    load(spark, tmp_dir, t, "replace", ("a", "A"))
    assert not spark.catalog.tableExists(f"{t}__keys")


def test_stored_keys_are_not_shuffled(spark, tmp_dir):
    t = unique_name("tbl")
    load(spark, tmp_dir, t, "replace", *((f"k{i}", "A") for i in range(50)))
    load(spark, tmp_dir, t, "append", ("new", "A"))
    arriving = spark.range(1000).selectExpr("concat('2:k', id, '1:a') as _state_key")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.known_forms(spark, t, arriving)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    left = plan.split("SortMergeJoin")[1]
    scan = [x for x in left.split("\n") if "FileScan" in x]
    assert "LeftSemi" in plan and "Bucketed: true" in scan[0], plan
    assert plan.count("Exchange") == 1, "only the arriving keys move"
