"""Merge (K07), constraints (K06, K09) and verification."""

from decimal import Decimal

from fundlake.operators.constraints import check_not_null, check_unique
from fundlake.operators.merge import merge_frames, merge_table
from fundlake.operators.verify import check_records, multiset_diff, reconcile_counts
from fundlake.session import unique_name
from fundlake.sinks.tables import create_table, replace_table_data, with_surrogate_id


def test_merge_append_and_replace(spark):
    target = spark.createDataFrame([("EXF 1", "A", 1), ("EXF 2", "B", 2)], "code string, cls string, v int")
    source = spark.createDataFrame([("exf 1 ", "a", 10), ("EXF 3", "C", 30)], "code string, cls string, v int")
    app = merge_frames(target, source, ["code", "cls"], "append", "UNICODE_CI_AI_RTRIM")
    assert sorted(r.v for r in app.collect()) == [1, 2, 30]
    rep = merge_frames(target, source, ["code", "cls"], "replace", "UNICODE_CI_AI_RTRIM")
    assert sorted(r.v for r in rep.collect()) == [2, 10, 30]
    t = unique_name("tgt")
    create_table(spark, t, "code STRING, cls STRING, v INT")
    replace_table_data(spark, t, target)
    merged = merge_table(spark, t, source, ["code", "cls"], "replace", "UNICODE_CI_AI_RTRIM")
    assert merged.count() == 3 and spark.table(t).count() == 3


def test_constraints(spark):
    df = spark.createDataFrame([("Abc", 1), ("abc  ", 2), ("x", None)], "k string, v int")
    dups = check_unique(df, ["k"]).collect()
    assert len(dups) == 1 and dups[0].n == 2 and dups[0].n_spellings == 2
    nn = check_not_null(df, ["k", "v"]).collect()
    assert len(nn) == 1 and nn[0].null_columns == ["v"]


def test_surrogate_ids_dense_across_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7)
    ids = sorted(r.id for r in with_surrogate_id(df.withColumnRenamed("id", "x"), "id", 5).collect())
    assert ids == list(range(5, 1005))


def test_verification(spark):
    a = spark.createDataFrame([("F", Decimal("3.05")), ("F", None), ("O", Decimal("1.00"))], "s string, m decimal(10,4)")
    b = spark.createDataFrame([("F", Decimal("3.0500")), ("F", None), ("P", Decimal("1.00"))], "s string, m decimal(10,4)")
    d = {(r.column, r.value): (r.n_a, r.n_b) for r in multiset_diff(a, b, ["s", "m"], {"m": "decimal(5,2)"}).collect()}
    assert d == {("s", "O"): (1, 0), ("s", "P"): (0, 1)}
    rc = reconcile_counts(a, b.limit(2)).first()
    assert (rc.source_rows, rc.loaded_rows, rc.counts_match) == (3, 2, False)
    actual = spark.createDataFrame([("QRS 71", "B", Decimal("3.05"), Decimal("0.40"), "CAD"),
                                    ("QRS 72", "K", Decimal("0.88"), None, "CAD")],
                                   "fund string, cls string, mer decimal(5,2), trailer decimal(5,2), ccy string")
    expected = spark.createDataFrame([("QRS 71", "B", 3.05, 0.40, "CAD"), ("QRS 72", "K", 0.88, None, "CAD"),
                                      ("QRS 8", "B", 1.0, None, "CAD")],
                                     "fund string, cls string, mer double, trailer double, ccy string")
    res = {(r.fund, r.cls): r for r in check_records(actual, expected, ["fund", "cls"], ["mer", "trailer", "ccy"],
                                                     {"mer": "decimal(5,2)", "trailer": "decimal(5,2)"}).collect()}
    assert res[("QRS 71", "B")].ok and res[("QRS 72", "K")].ok
    assert not res[("QRS 8", "B")].found


def test_merge_needs_unique_source_keys_and_null_keys_are_distinct(spark):
    import pytest
    from fundlake.operators.constraints import check_unique
    from fundlake.operators.merge import merge_frames
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        merge_frames(t, spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string"), ["k"], "append")
    assert check_unique(spark.createDataFrame([("a", None), ("a", None)], "a string, b string"), ["a", "b"]).count() == 0
