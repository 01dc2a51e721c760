"""Typed tables and file sinks.

Tables are external Parquet tables under the shared work folder. A replace
load writes the new data to a fresh folder and then points the table at it,
so a failed job never leaves a half-truncated table; an append is one job
commit into the table folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, work_path
from ..operators.ingest import _VARCHAR


def create_table(spark: SparkSession, name: str, ddl: str, location: str | None = None,
                 partition_by: str | None = None) -> str:
    """Drop if exists, then create a typed Parquet table (K05), in partitions of one
    date or integer column where ``partition_by`` names it. Returns its folder."""
    location = location or work_path(spark, f"table-{name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts} LOCATION '{location}'")
    return location


def ensure_table(spark: SparkSession, name: str, ddl: str, partition_by: str | None = None) -> None:
    if not spark.catalog.tableExists(name):
        create_table(spark, name, ddl, partition_by=partition_by)


def _conform(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Table column order and types; varchar lengths checked on write, as a
    table insert does."""
    out = []
    for f in spark.table(name).schema.fields:
        c = F.col(f"`{f.name}`")
        declared = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
        m = _VARCHAR.match(declared) if declared else None
        if m:
            n = int(m.group(2))
            c = F.when(F.length(c) > n, F.raise_error(
                F.lit(f"value too long for {f.name} {declared}"))).otherwise(c.cast("string"))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def append_table_data(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Append load (K02): one job commit into the table folder."""
    _conform(spark, name, df).write.insertInto(name, overwrite=False)


def replace_table_data(spark: SparkSession, name: str, df: DataFrame, written: str | None = None) -> str:
    """Truncate-then-load (K01/K03) as write-new-then-swap: the table points
    at its old folder until the new one is fully committed. ``written``: a committed
    folder whose rows are those of ``df`` in the table's types, which becomes the
    table's own; columns that the table does not have are not read."""
    new_location = written or work_path(spark, f"table-{name}")
    if not written:
        _conform(spark, name, df).write.parquet(new_location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_location}'")
    spark.sql(f"REFRESH TABLE {name}")
    return new_location


def partition_column(spark: SparkSession, name: str) -> str | None:
    return next((c.name for c in spark.catalog.listColumns(name) if c.isPartition), None)


def replace_partitions(spark: SparkSession, name: str, df: DataFrame, drop_others: bool = False) -> list[str]:
    """Replace the partitions that ``df`` has rows of and leave the others, or drop
    them (K01 for one date, say). The rows are written to a new folder, then each
    partition is pointed at its part of it: a failed job leaves the table as it was,
    and no file of another partition is read or written. Returns the partitions
    replaced; an empty ``df`` replaces none. A NULL partition value is refused."""
    col = partition_column(spark, name)
    if not col:
        raise ValueError(f"{name} has no partitions")
    kind = spark.table(name).schema[col].dataType.typeName()
    if kind not in ("date", "integer", "long"):
        raise ValueError(f"{name} is partitioned by a {kind} column")
    folder = work_path(spark, f"table-{name}")
    value = F.col(f"`{col}`")
    rows = _conform(spark, name, df).withColumn(col, F.when(value.isNull(), F.raise_error(
        F.lit(f"NULL in partition column {col}"))).otherwise(value).cast(kind))
    rows.hint("rebalance", F.col(f"`{col}`")).write.partitionBy(col).parquet(folder)
    # One row per partition of the table, as the catalog holds them.
    values = [] if not has_data(spark, folder) else sorted(
        r[0] for r in spark.read.schema(spark.table(name).schema).parquet(folder).select(value.cast("string")).distinct().collect())
    known = {p[0] for p in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    others = sorted(p for p in known if p.split("=", 1)[1] not in values) if drop_others else []
    if others:
        spark.sql(f"ALTER TABLE {name} DROP " + ", ".join(f"PARTITION ({col} = '{p.split('=', 1)[1]}')" for p in others))
    new = []
    for v in values:
        spec, at = f"PARTITION ({col} = '{v}')", f"'{folder}/{col}={v}'"
        if f"{col}={v}" in known:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {at}")
        else:
            new.append(f"{spec} LOCATION {at}")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(new)}")
    spark.sql(f"REFRESH TABLE {name}")
    return values


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether a written folder holds partitions."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(folder + "/*=*")
    return bool(glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob))


def with_surrogate_id(df: DataFrame, col: str = "id", start: int = 1) -> DataFrame:
    """Dense 1-based (from ``start``) ids without a single-partition sort.

    ``monotonically_increasing_id`` holds the partition in its upper bits and
    the row's index inside the partition in its lower 33 bits. A per-partition
    count (one row per partition) gives each partition its offset. Both numbers
    are written with the rows once, so both passes see the same partitions
    however a later scan is split.
    """
    base = materialize(df.withColumn("_pid", F.spark_partition_id())
                       .withColumn("_mono", F.monotonically_increasing_id()), "ids")
    counts = base.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = (base.join(offsets, "_pid")
               .withColumn(col, (F.lit(start) + F.col("_off") + local).cast("long")))
    return out.select(col, *df.columns)


def write_csv(df: DataFrame, path: str, header: bool = True, quote_all: bool = False,
              scale: int | None = None, mode: str = "overwrite", **options) -> str:
    """CSV with header and no index column (K10); ``quote_all`` and fixed
    decimals (``scale``) for floating columns give the all-quoted,
    8-decimal layout (K11)."""
    if scale is not None:
        df = df.select(*[
            F.format_string(f"%.{scale}f", F.col(f.name)).alias(f.name)
            if f.dataType.typeName() in ("double", "float", "decimal") else F.col(f.name)
            for f in df.schema.fields])
    (df.write.mode(mode).option("header", str(header).lower())
       .option("quoteAll", str(quote_all).lower()).options(**options).csv(path))
    return path
