"""Delimited records whose quoted fields hold raw line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it, back to the
start of the file. Each line is therefore a function on two states (outside or
inside a quoted field at its start): a regular expression says where each state
leads. Composed over a split, the functions give the split's own function; a
scan over the splits, one row each, picks the state every split starts in. A
second read then joins lines to records inside each split, and only the pieces
of records that cross a split's edge meet across splits.

Lines are cut at ``\\n`` alone; a ``\\r`` before a record's end goes, one inside a
field stays. A quote opens a field only at its start, as in the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..spec import IngestSpec

FILE, BLOCK, ROW, TEXT = "_file", "_block", "_row", "_text"


def _char(c: str) -> str:
    if len(c) != 1:
        raise ValueError(f"files with line breaks in fields need one-character separators and quotes, got {c!r}")
    return f"\\x{{{ord(c):x}}}"


def state_functions(line: Column, spec: IngestSpec) -> tuple[Column, Column]:
    """Whether a line that starts outside, and one that starts inside a quoted field,
    ends inside one. All repeats are possessive: no backtracking, no deep stack."""
    q, d = _char(spec.quote_char), _char(spec.delimiter)
    held = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    opened = f"(?:(?:{q}{held}{q}[^{d}]*+|[^{q}{d}][^{d}]*+)?+{d})*+{q}{held}"
    some = line.contains(spec.quote_char)
    return (some & line.rlike(f"^{opened}\\z")), (~some | line.rlike(f"^{held}(?:{q}[^{d}]*+{d}{opened})?+\\z"))


def _end_states(order, out: Column, inside: Column) -> tuple[Column, Column]:
    """States after each row of a window, for both states before its first: the last
    row that leads to one state whatever came before, and the swaps since."""
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.sum((out & ~inside).cast("int")).over(upto)
    fixed = F.last(F.when(out == inside, F.struct(out.cast("int").alias("state"), F.col("_swaps").alias("swaps"))), ignorenulls=True).over(upto)
    return swaps, fixed


def _with_end_states(rows: DataFrame, order, out: Column, inside: Column) -> DataFrame:
    """``rows`` with ``_end0`` and ``_end1``: the state after each row (1 inside), if the
    window started outside or inside."""
    swaps, fixed = _end_states(order, out, inside)
    rows = rows.withColumn("_swaps", swaps).withColumn("_fixed", fixed)
    since = F.col("_swaps") - F.coalesce(F.col("_fixed.swaps"), F.lit(0))
    return rows.select("*", *[F.pmod(F.coalesce(F.col("_fixed.state"), F.lit(s)) + since, F.lit(2)).alias(f"_end{s}") for s in (0, 1)]) \
        .drop("_swaps", "_fixed")


def _lines(spark: SparkSession, paths: list[str], spec: IngestSpec) -> DataFrame:
    lt = "\n" if spec.line_terminator in ("\n", "\r\n") else spec.line_terminator
    text = F.col("value")
    if spec.encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        text = F.decode(text.cast("binary"), spec.encoding)
    return spark.read.option("lineSep", lt).text(paths).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW), text.alias(TEXT))


def read_records(spark: SparkSession, paths: list[str], spec: IngestSpec, line: str, source_file: str, hide=None) -> DataFrame:
    """(``line``, ``source_file``): one row per record, line breaks kept. ``hide`` turns
    escapes of a line into text without separators and quotes; it only serves to find
    the records. The first ``spec.skip_lines`` lines of a file (all in its first
    split) and blank records go."""
    order = Window.partitionBy(FILE, BLOCK).orderBy(ROW)

    def marked() -> DataFrame:
        lines = _lines(spark, paths, spec)
        out, inside = state_functions(hide(F.col(TEXT), spec) if hide else F.col(TEXT), spec)
        lines = lines.select("*", out.alias("_out"), inside.alias("_in"))
        if spec.skip_lines:
            lines = lines.withColumn("_at", F.row_number().over(order)).where((F.col(BLOCK) > 0) | (F.col("_at") > spec.skip_lines)).drop("_at")
        return _with_end_states(lines, order, F.col("_out"), F.col("_in"))

    def before(s: Column, ends: str) -> Column:
        return F.coalesce(F.lag(ends).over(order), s)

    # One row per split: where it leads from either state, and the records it begins.
    ends = marked().select(FILE, BLOCK, ROW, "_end0", "_end1", *[before(F.lit(s), f"_end{s}").alias(f"_begin{s}") for s in (0, 1)])
    splits = ends.groupBy(FILE, BLOCK).agg(
        *[F.max_by(f"_end{s}", ROW).alias(f"_last{s}") for s in (0, 1)], *[F.sum(1 - F.col(f"_begin{s}")).alias(f"_starts{s}") for s in (0, 1)])
    along = Window.partitionBy(FILE).orderBy(BLOCK)
    scanned = _with_end_states(splits, along, F.col("_last0") == 1, F.col("_last1") == 1) \
        .withColumn("_start", F.coalesce(F.lag("_end0").over(along), F.lit(0)))
    scanned = scanned.select(FILE, BLOCK, "_start", F.col("_end0").alias("_open"), F.when(F.col("_start") == 0, F.col("_starts0")).otherwise(F.col("_starts1")).alias("_starts"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    scanned = scanned.withColumn("_owner", F.coalesce(F.last(F.when(F.col("_starts") > 0, F.col(BLOCK)), ignorenulls=True).over(earlier), F.lit(-1)))

    lines = marked().join(scanned, [FILE, BLOCK])
    begins = F.coalesce(F.lag(F.when(F.col("_start") == 0, F.col("_end0")).otherwise(F.col("_end1"))).over(order), F.col("_start"))
    lines = lines.withColumn("_record", F.sum(1 - begins).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def joined(at: str) -> Column:
        lt = "\n" if spec.line_terminator in ("\n", "\r\n") else spec.line_terminator
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at, TEXT))), lambda x: x[TEXT]), lt).alias(TEXT)

    # Grouped as the window is dealt: no further shuffle of the lines.
    pieces = lines.groupBy(FILE, BLOCK, "_record").agg(joined(ROW), F.first("_open").alias("_open"), F.first("_starts").alias("_starts"), F.first("_owner").alias("_owner"))
    crosses = (F.col("_record") == 0) | ((F.col("_record") == F.col("_starts")) & (F.col("_open") == 1))
    whole = pieces.where(~crosses).select(FILE, TEXT)
    owner = F.when(F.col("_record") == 0, F.col("_owner")).otherwise(F.col(BLOCK))
    across = pieces.where(crosses).withColumn("_owner", owner).groupBy(FILE, "_owner").agg(joined(BLOCK)).select(FILE, TEXT)
    records = whole.unionByName(across)
    if spec.line_terminator in ("\n", "\r\n"):
        records = records.withColumn(TEXT, F.regexp_replace(TEXT, r"\r\z", ""))
    return records.where(F.trim(TEXT) != "").select(F.col(TEXT).alias(line), F.col(FILE).alias(source_file))
