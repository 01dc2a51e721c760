"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a share of the wanted words by weight, at most ``EPOCHS`` times
its size; what is over is shared again. A source also has a schedule, its weight
at points of training time between 0 and 1 with straight lines between. The
integral of the schedule, scaled to the source's target, is its cumulative
demand. Documents stand in a hashed order within their source; the word at
which a document begins is demanded at one time, the inverse of that integral.
Sorting all copies by this time gives the training order.

A text that the demand cuts is taken in part, so each source meets its target
to the word. Orders are range-partitioned, so one source may be any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import partitions_for, range_prefix, write_once

#: By source in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: By source likewise: (time, weight) points. Heavy sources come early, light ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))
SHARE_NUM, SHARE_DEN = 3, 2
EPOCHS = 2
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, rank, source_size, target): sources of ``sizes`` (source, size)
    in code point order, null last, and the words that each contributes."""
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = range_prefix(totals, [F.col("source").asc_nulls_last()], partitions_for(spark), "one", "rank", "mix-sources").drop("one")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * EPOCHS
    base = write_once(ranked.withColumn("w", weight).withColumn("cap", cap), "mix-weights")
    total = base.agg(F.sum("source_size")).first()[0] or 0
    # Raise the common level until no further source exceeds its cap: a few sums.
    held, level = -1, (0, 1)
    full = F.lit(False)
    while True:
        s = base.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("c"),
                     F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        level = (total * SHARE_NUM - (s["c"] or 0) * SHARE_DEN, s["w"] or 0)
        if s["n"] == held or not level[1]:
            break
        held = s["n"]
        full = F.col("cap").cast("decimal(20,0)") * F.lit(level[1] * SHARE_DEN).cast("decimal(18,0)") \
            < F.lit(level[0]).cast("decimal(20,0)") * F.col("w").cast("decimal(18,0)")
    share = F.lit(float(level[0])) * F.col("w") / F.lit(float(max(1, level[1] * SHARE_DEN)))
    return base.withColumn("target", F.when(full | F.lit(not level[1]), F.col("cap").cast("double")).otherwise(share)) \
        .select("source", "rank", "source_size", "target")


def demand_time(x: Column, target: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the cumulative demand of a schedule reaches ``x`` of ``target``."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    whole = sum(areas)
    y = x / target * F.lit(whole)
    out, before = None, 0.0
    for (t0, w0), (t1, w1), area in zip(schedule, schedule[1:], areas):
        slope = (w1 - w0) / (t1 - t0)
        z = F.greatest(y - F.lit(before), F.lit(0.0))
        at = F.lit(t0) + F.lit(2.0) * z / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * z, F.lit(0.0))))
        before += area
        out = F.when(y < F.lit(before), at) if out is None else out.when(y < F.lit(before), at)
    return out.otherwise(F.lit(schedule[-1][0]))


def row_key(doc_id: Column, text: Column, source: Column) -> Column:
    """Digest of a row's id, source and text; never null, so rows without an id spread."""
    source = source.cast("string")
    parts = (F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.coalesce(F.length(source).cast("string"), F.lit("")),
             F.coalesce(source, F.lit("")), F.coalesce(F.concat(F.lit("t"), text.cast("string")), F.lit("")))
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """The first copy (copy 0) of each row of ``docs`` and those further ones
    that are taken: row_key, doc_id, size, source_size, target, taken (words of
    all copies), copy, words (of this one), train_time (when its first word is
    due) and position (words of the mix before it; both null where no word is taken).

    Null texts have size 0; a null source is a source of its own, the last. A
    source of size 0 has target 0. Ties in the hashed order go by id, size, then
    row key; equal rows are interchangeable. An empty table gives no rows."""
    spark = docs.sparkSession
    rows = write_once(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                  words(F.col(text_col)).alias("size"),
                                  row_key(F.col(id_col), F.col(text_col), F.col(source_col)).alias("row_key")), "mix-sizes")
    want = targets(rows.select("source", "size"), weights).withColumnRenamed("source", "_source")
    keyed = rows.join(want, rows["source"].eqNullSafe(want["_source"])).drop("_source", "source") \
        .withColumn("okey", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    n = partitions_for(spark)
    order = [F.col(c) for c in ("rank", "okey", "doc_id", "size", "row_key")]
    c = range_prefix(keyed, order, n, "size", "c", "mix-order", by="rank")
    demand = F.floor(F.col("target") + F.lit(0.5))
    per_copy = [F.greatest(F.least(demand - F.col("c") - F.col("source_size") * k, F.col("size")), F.lit(0)) for k in range(EPOCHS)]
    c = c.withColumn("taken", reduce(lambda a, b: a + b, per_copy))

    def due(k: int) -> Column:
        x = (F.col("c") + F.col("source_size") * k).cast("double")
        kinds = [demand_time(x, F.col("target"), s) for s in schedules]
        out = F.when(F.col("rank") % len(schedules) == 0, kinds[0])
        for i, t in enumerate(kinds[1:], 1):
            out = out.when(F.col("rank") % len(schedules) == i, t)
        return F.when(per_copy[k] > 0, out)

    copies = c.withColumn("copy", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), per_copy[k].alias("words"), due(k).alias("time"))
                                                      for k in range(EPOCHS)]))) \
        .where("copy.k = 0 or copy.words > 0") \
        .select("row_key", "doc_id", "size", "source_size", "target", "taken", "rank", "okey", F.col("copy.k").alias("k"),
                F.col("copy.words").alias("words"), F.col("copy.time").alias("train_time"))
    order = [F.col("train_time").asc_nulls_last(), *[F.col(x) for x in ("rank", "okey", "doc_id", "size", "row_key", "k")]]
    placed = range_prefix(copies, order, n, "words", "position", "mix-positions")
    return placed.select(
        "row_key", "doc_id", "size", "source_size", "target", "taken", F.col("k").alias("copy"), "words", "train_time",
        F.when(F.col("words") > 0, F.col("position")).alias("position"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES) -> DataFrame:
    """One row per row of ``docs``, its first copy in ``mix_copies``: doc_id,
    size, source_size, target, taken, train_time, position, row_key."""
    return mix_copies(docs, id_col, text_col, source_col, weights, schedules).where("copy = 0").select(
        "doc_id", "size", "source_size", "target", "taken", "train_time", "position", "row_key")


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns doc_id, text, source) that the mix takes, as
    often as it takes each, at most ``EPOCHS`` times; a copy that is taken in
    part is cut after that word. ``mixed`` is what ``mix`` or ``mix_copies`` gave
    for these rows. Rows that share an id, or have none, are rows of their own.
    With ``mix_copies``, which places every copy, the rows come in training order."""
    placed = "copy" in mixed.columns
    if not placed:
        mixed = mixed.withColumn("copy", F.explode(F.array(*[F.lit(k) for k in range(EPOCHS)]))) \
            .withColumn("words", F.greatest(F.least(F.col("taken") - F.col("size") * F.col("copy"), F.col("size")), F.lit(0)))
    # Equal rows are numbered on both sides; the j-th of each copy goes to the j-th row.
    among = Window.partitionBy("row_key", "copy").orderBy(F.col("words").desc())
    copies = write_once(mixed.select("row_key", "copy", "size", "words", "position", F.row_number().over(among).alias("number")), "mix-copies")
    given = docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text"), F.col("source")).alias("key"))
    if (copies.agg(F.max("number")).first()[0] or 1) > 1:
        given = given.withColumn("j", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    else:
        given = given.withColumn("j", F.lit(1))
    taken = copies.where("words > 0")
    found = given.join(taken, (given["key"] == taken["row_key"]) & (given["j"] == taken["number"]))
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("row.text"))
    if placed:
        found = found.orderBy("position")
    return found.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
