"""Load verification.

Every check is one aggregation or one join; none brings rows to the driver
except the bounded audit row.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import comparable_text, error_text, file_name, stamp


def row_count(df: DataFrame) -> int:
    """V01/G01."""
    return df.count()


def reconcile_counts(source: DataFrame, loaded: DataFrame,
                     names: tuple[str, str] = ("source_rows", "loaded_rows")) -> DataFrame:
    """Both counts and whether they match, in one pass over a
    union of the two sides (no join)."""
    tagged = (source.select(F.lit(1).alias("_s"), F.lit(0).alias("_l"))
              .unionByName(loaded.select(F.lit(0).alias("_s"), F.lit(1).alias("_l"))))
    a, b = names
    return (tagged.agg(F.sum("_s").cast("long").alias(a), F.sum("_l").cast("long").alias(b))
            .select(F.coalesce(F.col(a), F.lit(0)).alias(a), F.coalesce(F.col(b), F.lit(0)).alias(b))
            .withColumn("counts_match", F.col(a) == F.col(b)))


def multiset_diff(a: DataFrame, b: DataFrame, cols: list[str],
                  types: dict[str, str] | None = None) -> DataFrame:
    """Per column, values whose multiplicity differs between ``a``
    and ``b``. NULL compares as '' (X14); ``types`` casts a column to one
    type first so 2.47 and 2.4700 agree. Both sides are unpivoted into
    (column, value) and counted in one aggregation; no sort, no join."""
    types = types or {}

    def side(df: DataFrame, tag: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("column"),
                                   comparable_text(F.col(f"`{c}`"), types.get(c)).alias("value"))
                          for c in cols])
        return df.select(F.inline(cells)).withColumn("_side", F.lit(tag))

    both = side(a, "a").unionByName(side(b, "b"))
    counted = both.groupBy("column", "value").agg(
        F.count(F.when(F.col("_side") == "a", 1)).alias("n_a"),
        F.count(F.when(F.col("_side") == "b", 1)).alias("n_b"))
    return counted.filter(F.col("n_a") != F.col("n_b"))


def check_records(actual: DataFrame, expected: DataFrame, keys: list[str],
                  compare: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Each expected record looked up by key (left join); lists the
    compared columns that differ. An expected NULL is not compared."""
    types = types or {}
    e = expected.select(*keys, *[F.col(c).alias(f"exp_{c}") for c in compare])
    a = actual.select(*keys, *[F.col(c).alias(f"act_{c}") for c in compare], F.lit(True).alias("_found"))
    j = e.join(a, keys, "left")

    def norm(c: str, prefix: str):
        v = F.col(f"{prefix}_{c}")
        return v.try_cast(types[c]) if c in types else v

    diffs = F.array_compact(F.array(*[
        F.when(F.col(f"exp_{c}").isNotNull() & ~norm(c, "exp").eqNullSafe(norm(c, "act")), F.lit(c))
        for c in compare]))
    found = F.coalesce(F.col("_found"), F.lit(False))
    return j.select(*keys, found.alias("found"),
                    F.when(found, diffs).otherwise(F.array().cast("array<string>")).alias("mismatched"),
                    (found & (F.size(diffs) == 0)).alias("ok"))


def _sums(cols: list[Column], sign: Column) -> list[Column]:
    """Signed sums of two 64-bit hashes of a row, by 32-bit halves so that they stay exact."""
    hashes = (F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols))
    return [F.sum(sign * half) for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]


def _told(c: str, types: dict[str, str]) -> list[Column]:
    """A column as text for hashing, and whether it is NULL (a hash passes over NULLs)."""
    v = F.col(f"`{c}`").try_cast(types[c]) if c in types else F.col(f"`{c}`")
    return [F.coalesce(v.cast("string"), F.lit("")), v.isNull()]


def keyed_diff(a: DataFrame, b: DataFrame, keys: list[str], compare: list[str], types: dict[str, str] | None = None,
               buckets: int = 1024, bucket: str | None = None) -> DataFrame:
    """V05/J06 both ways, for large tables: keys, n_a, n_b, status (``only_a``,
    ``only_b``, ``count``, ``values``) and mismatched (columns whose values differ, where
    both sides have equally many rows of the key).

    Level one sums hashes of the rows per bucket of the key; only the sums are shuffled.
    Level two reads the rows of the buckets whose sums differ and groups them by key, with
    partial sums before the shuffle, so a repeated key costs no more than another.
    ``bucket`` names a column that holds the bucket on both sides, as keyed tables do:
    then level two prunes their partitions. Equal tables are found equal always;
    differing rows stay unseen only where two 64-bit hashes agree by chance.

    NULL differs from ''; NULL keys meet each other; ``types`` casts a column first.
    Equal or empty tables give no rows."""
    types = types or {}
    where = F.col(f"`{bucket}`") if bucket else F.pmod(F.xxhash64(*[x for k in keys for x in _told(k, types)]), F.lit(buckets)).cast("int")

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(where.alias("_at"), *[F.col(f"`{c}`") for c in [*keys, *compare]], F.lit(sign).alias("_sign"))

    whole = [x for c in [*keys, *compare] for x in _told(c, types)]
    sums = (side(a, 1).unionByName(side(b, -1)).groupBy("_at")
            .agg(F.struct(F.sum("_sign"), *_sums(whole, F.col("_sign"))).alias("s")))
    equal = reduce(lambda x, y: x & y, [F.col(f"s.`{f.name}`") == 0 for f in sums.schema["s"].dataType])
    differing = [r[0] for r in sums.where(~equal).select("_at").collect()]  # no more than there are buckets
    rows = side(a.where(where.isin(differing)), 1).unionByName(side(b.where(where.isin(differing)), -1))
    per_key = [F.struct(*_sums(_told(c, types), F.col("_sign"))).alias(f"_d{i}") for i, c in enumerate(compare)]
    grouped = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count_if(F.col("_sign") == 1).alias("n_a"), F.count_if(F.col("_sign") == -1).alias("n_b"), *per_key)
    flags = []
    for i, c in enumerate(compare):
        halves = grouped.schema[f"_d{i}"].dataType
        flags.append(F.when(reduce(lambda x, y: x | y, [F.col(f"_d{i}.`{f.name}`") != 0 for f in halves]), F.lit(c)))
    differ = F.when(F.col("n_a") == F.col("n_b"), F.array_compact(F.array(*flags))).otherwise(F.array().cast("array<string>"))
    status = (F.when(F.col("n_b") == 0, "only_a").when(F.col("n_a") == 0, "only_b")
              .when(F.col("n_a") != F.col("n_b"), "count").otherwise("values"))
    return (grouped.select(*[F.col(f"`{k}`") for k in keys], "n_a", "n_b", status.alias("status"), differ.alias("mismatched"))
            .where((F.col("n_a") != F.col("n_b")) | (F.size("mismatched") > 0)))


AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("spec", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
])


def audit_frame(spark: SparkSession, **row) -> DataFrame:
    """One audit row per load: spec, source file name (X17), counts,
    status, message cut to 128 characters (X04), and a run stamp (X16).
    Credentials are never part of a spec or a row."""
    src = row["source"]
    src = src if isinstance(src, str) else ",".join(src)
    values = (row.get("run_id") or uuid.uuid4().hex, row["spec"], row["target_table"], src, row["mode"],
              int(row["rows_read"]), int(row["rows_loaded"]), int(row["rows_rejected"]),
              row["status"], row.get("message"), row["started_at"], row["ended_at"])
    df = spark.createDataFrame([values], AUDIT_SCHEMA)
    return df.select(
        "run_id", "spec", "target_table", file_name(F.col("source")).alias("source_file"), "mode",
        "rows_read", "rows_loaded", "rows_rejected", "status",
        F.when(F.col("message").isNotNull(), error_text(F.col("message"), F.col("spec"))).alias("message"),
        "started_at", "ended_at", stamp(F.col("started_at")).alias("run_stamp"))


def append_audit(spark: SparkSession, audit_table: str, *, spec, target_table: str, path,
                 mode: str, rows_read: int, rows_loaded: int, rows_rejected: int, status: str,
                 message: str | None, started: _dt.datetime, run_id: str | None = None) -> None:
    """One audit row. A row of the same ``run_id`` and status is not written twice."""
    from ..sinks.tables import append_table_data, ensure_table
    if run_id and spark.catalog.tableExists(audit_table) and spark.table(audit_table).where(
            (F.col("run_id") == run_id) & (F.col("status") == status)).limit(1).count():
        return
    row = audit_frame(spark, run_id=run_id, spec=spec.name, target_table=target_table, source=path,
                      mode=mode, rows_read=rows_read, rows_loaded=rows_loaded,
                      rows_rejected=rows_rejected, status=status, message=message,
                      started_at=started, ended_at=_dt.datetime.now(_dt.timezone.utc))
    ensure_table(spark, audit_table,
                 ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row.schema.fields))
    append_table_data(spark, audit_table, row)
