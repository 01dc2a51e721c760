"""Unique keys of growing tables, checked without shuffling what is stored.

A table that is appended to again and again has a key table beside it: the folded
form of every stored key, bucketed and sorted by it. An append folds the arriving keys
and asks the key table in its buckets; only the arriving keys are shuffled (or
broadcast, where Spark finds them small). Keys that are equal under the collation
share a folded form, so an arriving key whose form is new is new. Where a form is
found, the exact comparison decides; keys with letters that have no ASCII base are
kept in a second small table and always compared exactly.

The key table is built with the first append after a replace, and counts as valid
only while the table still has the folder and the number of rows that it was made for.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from ..spec import IngestSpec
from .constraints import check_unique, key_col

KEY = "_state_key"
PROPERTY = "keys.of"
#: Folded forms with letters that have no ASCII base.
HARD = r"[^\x00-\x7f]"


def _folded(text: str) -> str:
    """One form for all texts that are equal up to case, accents, ignorable controls
    and trailing blanks."""
    out = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())
    return "".join(c for c in out if not unicodedata.combining(c) and (unicodedata.category(c) not in ("Cc", "Cf") or c in "\t\n\v\f\r")).rstrip(" ")


def folded_key(spec: IngestSpec) -> Column:
    """The unique key's folded form as one string, null where a part is null."""
    return folded_columns([(k, bool(spec.key_collation) and spec.column(k).type.lower().startswith(("varchar", "char", "string")))
                           for k in spec.unique_key])


def folded_columns(columns: list[tuple[str, bool]]) -> Column:
    """One string of (column, whether it compares under the collation), null where a
    part is null. Plain ASCII is folded by Spark, other text in an Arrow UDF."""
    @F.pandas_udf("string")
    def folded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: x if x is None else _folded(x))

    parts = []
    for k, collated in columns:
        text = F.col(f"`{k}`").cast("string")
        if collated:
            plain = text.rlike(r"^[\x20-\x7e]*\z")
            text = F.when(plain, F.lower(F.rtrim(text))).otherwise(folded(F.when(~plain, text)))
        parts.append(F.concat(F.length(text).cast("string"), F.lit(":"), text))
    return F.concat(*parts)


def repeated_keys(good: DataFrame, before: DataFrame, spec: IngestSpec, n: int = 5) -> list:
    """Some keys of ``good`` that ``before`` holds, under the key's collation."""
    cond = [key_col(c, spec.key_collation, good) == F.col(f"__k{i}") for i, c in enumerate(spec.unique_key)]
    old = before.select(*[key_col(c, spec.key_collation, before).alias(f"__k{i}") for i, c in enumerate(spec.unique_key)])
    return good.select(*spec.unique_key).join(old, cond, "left_semi").limit(n).collect()


def _names(table: str) -> tuple[str, str]:
    return f"{table}__keys", f"{table}__hard_keys"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def _made_for(spark: SparkSession, table: str) -> bool:
    """Whether the key table is that of the table's present rows."""
    keys, _ = _names(table)
    if not spark.catalog.tableExists(keys):
        return False
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {keys}").collect()}
    return props.get(PROPERTY) == f"{_location(spark, table)} {spark.table(table).count()}"


def drop_keys(spark: SparkSession, table: str) -> None:
    for name in _names(table):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def known_forms(spark: SparkSession, table: str, arriving: DataFrame) -> DataFrame:
    """The folded forms of ``arriving`` (column KEY) that the key table holds. The key
    table stays on the streamed side, in its buckets."""
    keys, _ = _names(table)
    return spark.table(keys).join(arriving.select(KEY), KEY, "left_semi")


def check_append(spark: SparkSession, table: str, good: DataFrame, spec: IngestSpec) -> list:
    """Keys by which ``good`` repeats itself or what ``table`` holds (some of them)."""
    dups = check_unique(good, spec.unique_key, spec.key_collation).limit(5).collect()
    if dups:
        return dups
    stored = spark.table(table)
    if not _made_for(spark, table):
        drop_keys(spark, table)
        return repeated_keys(good, stored, spec)
    forms = good.select(*spec.unique_key, folded_key(spec).alias(KEY)).where(F.col(KEY).isNotNull())
    if known_forms(spark, table, forms).limit(1).count():
        return repeated_keys(good, stored, spec)
    hard = forms.where(F.col(KEY).rlike(HARD))
    if hard.limit(1).count():
        dups = repeated_keys(hard, stored, spec)
    return dups or repeated_keys(good, spark.table(_names(table)[1]), spec)


def remember(spark: SparkSession, table: str, good: DataFrame, spec: IngestSpec) -> None:
    """Add the keys that an append has written to ``table``; builds the key table from
    all stored rows where there is none."""
    keys, hard = _names(table)
    new = not spark.catalog.tableExists(keys)
    rows = (spark.table(table) if new else good).select(*spec.unique_key, folded_key(spec).alias(KEY)).where(F.col(KEY).isNotNull())
    if new:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    else:
        buckets = int(spark.sql(f"DESCRIBE TABLE EXTENDED {keys}").where("col_name = 'Num Buckets'").first()["data_type"])

    def put(df: DataFrame, name: str, bucketed: bool) -> None:
        w = df.write.mode("append").format("parquet")
        if bucketed:
            w = w.bucketBy(buckets, KEY).sortBy(KEY)
        if not spark.catalog.tableExists(name):
            w = w.option("path", work_path(spark, f"table-{name}"))
        w.saveAsTable(name)

    put(rows.select(KEY).repartition(buckets, KEY), keys, True)
    put(rows.where(F.col(KEY).rlike(HARD)).select(*spec.unique_key), hard, False)
    told = f"{_location(spark, table)} {spark.table(table).count()}"
    spark.sql(f"ALTER TABLE {keys} SET TBLPROPERTIES ('{PROPERTY}' = '{told}')")
