"""Keyed staging -> target merge.

``append`` keeps existing target rows and adds source rows with new keys;
``replace`` lets source rows overwrite target rows with the same key. Both
are one anti join plus a union: Spark shuffles both sides on the key (or
broadcasts a side the optimizer measures as small); AQE splits skewed key
ranges. Keys may compare under a collation (case/accent/trailing-space
insensitive), as the reference's tables do.

Tables that are merged into again and again are better kept in buckets of their key
(``create_keyed_table``): ``merge_buckets`` reads and rewrites only the buckets in
which source rows fall.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .constraints import check_unique, key_col
from .keys import folded_columns

KINDS = ("append", "replace")
BUCKET = "_bucket"


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str] | tuple[str, ...],
                 kind: str = "replace", collation: str | None = None) -> DataFrame:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    if not check_unique(source, keys, collation).isEmpty():
        raise ValueError(f"source rows repeat a key of {list(keys)}")
    keep, new = (target, source) if kind == "append" else (source, target)
    return keep.unionByName(_missing(keep, new, keys, collation).select(*keep.columns))


def _missing(keep: DataFrame, new: DataFrame, keys, collation: str | None) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``keep``."""
    k = [f"__k{i}" for i in range(len(keys))]
    keep_keys = keep.select(*[key_col(c, collation, keep).alias(a) for c, a in zip(keys, k)])
    cond = reduce(lambda a, b: a & b,
                  [(key_col(new[c], collation) if new.schema[c].dataType.typeName() == "string" else new[c])
                   == keep_keys[a] for c, a in zip(keys, k)])
    return new.join(keep_keys, cond, "left_anti")


def merge_table(spark: SparkSession, target_table: str, source: DataFrame,
                keys: list[str] | tuple[str, ...], kind: str = "replace",
                collation: str | None = None) -> DataFrame:
    """Merge into a table. ``append`` writes the new rows beside the old ones;
    ``replace`` writes the result to a new folder and points the table at it (a
    table cannot be overwritten while read)."""
    from ..sinks.tables import append_table_data, replace_table_data
    if kind == "append":
        if not check_unique(source, keys, collation).isEmpty():
            raise ValueError(f"source rows repeat a key of {list(keys)}")
        # written once: the table is not read while it is appended to
        append_table_data(spark, target_table, materialize(_missing(spark.table(target_table), source, keys, collation), "merge-new"))
        return spark.table(target_table)
    merged = merge_frames(spark.table(target_table), source, keys, kind, collation)
    replace_table_data(spark, target_table, merged)
    return spark.table(target_table)


def create_keyed_table(spark: SparkSession, name: str, ddl: str, keys: list[str] | tuple[str, ...],
                       collation: str | None = None, buckets: int = 256) -> None:
    """An empty table in ``buckets`` partitions by a hash of its key. Keys that are equal
    under the collation fall into one bucket, and so do all keys with a NULL part."""
    from ..sinks.tables import create_table
    create_table(spark, name, f"{ddl}, {BUCKET} INT", partition_by=BUCKET)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('merge.keys'='{','.join(keys)}', "
              f"'merge.collation'='{collation or ''}', 'merge.buckets'='{buckets}')")


def keyed_by(spark: SparkSession, name: str) -> tuple[list[str], str | None, int]:
    """Keys, collation and number of buckets of a keyed table."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if "merge.keys" not in props:
        raise ValueError(f"{name} is not a keyed table")
    return props["merge.keys"].split(","), props["merge.collation"] or None, int(props["merge.buckets"])


def _bucket(df: DataFrame, keys: list[str], collation: str | None, buckets: int) -> Column:
    folded = folded_columns([(k, bool(collation) and df.schema[k].dataType.typeName() == "string") for k in keys])
    return F.coalesce(F.pmod(F.xxhash64(folded), F.lit(buckets)), F.lit(0)).cast("int")


def merge_buckets(spark: SparkSession, table: str, source: DataFrame, kind: str = "replace") -> list[int]:
    """Merge ``source`` into a keyed table (K07). Returns the buckets written to.

    ``replace`` writes the touched buckets anew and points the table at them; the files
    of other buckets are neither read nor written. A job that dies leaves each bucket
    as it was or merged, and running it again gives the whole result. ``append`` writes
    the rows with new keys beside the stored ones; of the stored ones it reads the touched
    buckets. As in ``merge_frames``, source rows must not repeat a key, and a key with a
    NULL part equals no other. An empty source changes nothing."""
    from ..sinks.tables import append_table_data, replace_partitions
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    keys, collation, buckets = keyed_by(spark, table)
    schema = spark.table(table).schema
    typed = source.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name != BUCKET])
    staged = materialize(typed.withColumn(BUCKET, _bucket(typed, keys, collation, buckets)), "merge-source")
    if not check_unique(staged, keys, collation).isEmpty():
        raise ValueError(f"source rows repeat a key of {keys}")
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())  # no more than there are buckets
    stored = spark.table(table).where(F.col(BUCKET).isin(touched))
    if kind == "append":
        new = materialize(_missing(stored, staged, [BUCKET, *keys], collation), "merge-new")
        append_table_data(spark, table, new.hint("rebalance", F.col(BUCKET)))
    else:
        replace_partitions(spark, table, staged.unionByName(_missing(staged, stored, [BUCKET, *keys], collation)))
    return touched
