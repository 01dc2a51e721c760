"""Delimited-file sources.

``read_delimited`` turns one file, a folder or a glob of files into raw string
fields bound by position, plus ``_corrupt_record`` (ragged or unparsable
lines) and ``_source_file``. Files are read in parallel splits; nothing goes
through the driver but the file listing Spark makes anyway.

The rules follow a server-side bulk load without an ``ESCAPED BY`` clause: an
empty field is the empty string, ``\\N`` is NULL, and a backslash escapes the
next character. Spark's CSV parser yields NULL for empty fields, so raw fields
are mapped back: ``\\N`` -> NULL, NULL -> ''. Blank lines are dropped, whatever
the number of lines to skip.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import IngestSpec
from .multiline import read_records

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
LINE = "_line"
LINE_SEPARATOR = "\u0001"
MARK = "\u001f"
# The letters that stand for control characters after a backslash
# in a bulk load; any other character stands for itself.
CONTROL_ESCAPES = {"0": "\u0000", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\u001a"}


def raw_schema(spec: IngestSpec) -> T.StructType:
    fields = [T.StructField(s, T.StringType(), True) for s in spec.source_fields]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def csv_options(spec: IngestSpec) -> dict[str, str]:
    opts = {
        "sep": spec.delimiter,
        "quote": spec.quote_char,
        "escape": spec.escape_char,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        # Column pruning hides ragged rows from queries that touch only
        # some fields, so the ingest read always parses whole records.
        "columnPruning": "false",
        "encoding": spec.encoding,
        "multiLine": "true" if spec.multiline else "false",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    lt = spec.line_terminator
    if lt not in ("\n", "\r\n"):
        if len(lt) != 1:
            raise ValueError(f"line terminator must be one character or CRLF, got {lt!r}")
        opts["lineSep"] = lt
    return opts


def _null_rules(c: Column, null_marker: str) -> Column:
    return F.when(c == F.lit(null_marker), F.lit(None).cast("string")).otherwise(F.coalesce(c, F.lit("")))


def read_delimited(spark: SparkSession, path: str | list[str], spec: IngestSpec) -> DataFrame:
    """Raw string fields in file order + ``_corrupt_record`` + ``_source_file``."""
    paths = [path] if isinstance(path, str) else list(path)
    if spec.multiline:
        hide = hide_escapes if spec.escape_char == "\\" else None
        return parse_lines(read_records(spark, paths, spec, LINE, SOURCE_FILE, hide), spec)
    lines = line_reader(spark.read, spec).csv(paths)
    return parse_lines(_skip_head(lines, spec) if spec.skip_lines > 1 else numbered(lines), spec)


def line_reader(reader, spec: IngestSpec):
    """Options that make the CSV source a reader of whole lines, for batch and
    stream alike: no quoting, one column, and a separator that real lines do not
    hold (a line that does is ragged, and then comes whole as the corrupt
    record). The source decodes the file's encoding, drops blank lines and, for
    one header line, the first line of each file."""
    opts = {**csv_options(spec), "sep": LINE_SEPARATOR, "quote": "\u0000", "escape": "\u0000",
            "header": "true" if spec.skip_lines == 1 else "false", "enforceSchema": "true"}
    return reader.schema(f"{LINE} STRING, {CORRUPT} STRING").options(**opts)


def numbered(lines: DataFrame) -> DataFrame:
    return lines.select(F.coalesce(F.col(CORRUPT), F.col(LINE)).alias(LINE),
                        F.col("_metadata.file_path").alias(SOURCE_FILE))


def _skip_head(lines: DataFrame, spec: IngestSpec) -> DataFrame:
    """Skip the first N lines of every file, N > 1, keeping files splittable.
    Blank lines are not counted, as they are not for one header line.

    The head of a file lies in its first split (``file_block_start = 0``), which one
    task reads whole and in file order, so one pass that counts the lines of the file
    at hand drops it: one scan, no shuffle. Batches without a head line go through as
    they are.
    """
    skip = spec.skip_lines

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, seen = None, 0
        for batch in batches:
            starts = batch.column(2).to_numpy(zero_copy_only=False)
            keep = np.ones(len(starts), dtype=bool)
            at = 0
            while at < len(starts):
                if starts[at] != 0:  # up to the next first split
                    at += int(np.argmax(starts[at:] == 0)) if (starts[at:] == 0).any() else len(starts) - at
                    file = None
                    continue
                name = batch.column(1)[at].as_py()
                if name != file:
                    file, seen = name, 0
                end = at
                while end < len(starts) and starts[end] == 0 and seen < skip and batch.column(1)[end].as_py() == name:
                    keep[end] = False
                    end, seen = end + 1, seen + 1
                if end == at:  # the head is behind: on to the next file of this batch
                    names = batch.column(1).slice(at)
                    other = pc.not_equal(names, name).to_numpy(zero_copy_only=False) | (starts[at:] != 0)
                    end = at + (int(np.argmax(other)) if other.any() else len(other))
                at = end
            yield (batch if keep.all() else batch.filter(pa.array(keep))).select([0, 1])

    placed = lines.select(F.coalesce(F.col(CORRUPT), F.col(LINE)).alias(LINE), F.col("_metadata.file_path").alias(SOURCE_FILE),
                          F.col("_metadata.file_block_start").alias("_block"))
    return placed.mapInArrow(drop, f"{LINE} string, {SOURCE_FILE} string")


def parse_lines(lines: DataFrame, spec: IngestSpec) -> DataFrame:
    """Lines -> raw fields + ``_corrupt_record`` (the line as it stood) +
    ``_source_file``, with the null and escape rules applied."""
    escapes = spec.escape_char == "\\"
    text = hide_escapes(F.col(LINE), spec) if escapes else F.col(LINE)
    schema_ddl = ", ".join(f"`{s}` STRING" for s in spec.source_fields) + f", `{CORRUPT}` STRING"
    opts = {k: v for k, v in csv_options(spec).items() if k not in ("lineSep", "encoding", "columnPruning")}
    if escapes:
        opts["escape"] = spec.quote_char  # the hidden ones aside, a doubled quote is a quote
    r = lines.select(F.from_csv(text, schema_ddl, opts).alias("r"), LINE, SOURCE_FILE)
    r = r.select(*[F.col(f"r.`{s}`").alias(s) for s in spec.source_fields],
                 F.when(F.col(f"r.{CORRUPT}").isNotNull(), F.col(LINE)).alias(CORRUPT), SOURCE_FILE)
    return apply_null_rules(r, spec, show_escapes if escapes else None)


def hide_escapes(line: Column, spec: IngestSpec) -> Column:
    """Backslash escapes as marks that hold neither separator nor quote, so that
    the CSV parser does not see them. A mark is ``MARK`` and a letter; ``MARK``
    itself is one too, so that any text survives. A backslash that ends a line
    stays."""
    c = F.replace(line, F.lit(MARK), F.lit(MARK + "u"))
    for escaped, letter in (("\\", "b"), ("N", "N"), (spec.delimiter, "d"), (spec.quote_char, "q")):
        c = F.replace(c, F.lit("\\" + escaped), F.lit(MARK + letter))
    c = F.regexp_replace(c, r"(?s)\\(.)", MARK + "e$1")
    return F.when(line.contains("\\") | line.contains(MARK), c).otherwise(line)


def show_escapes(field: Column, spec: IngestSpec) -> Column:
    """What the marks of ``hide_escapes`` stand for."""
    c = field
    for letter, char in CONTROL_ESCAPES.items():
        c = F.replace(c, F.lit(MARK + "e" + letter), F.lit(char))
    c = F.regexp_replace(c, "(?s)" + MARK + "e(.)", "$1")
    for letter, char in (("d", spec.delimiter), ("q", spec.quote_char), ("N", "N"), ("b", "\\"), ("u", MARK)):
        c = F.replace(c, F.lit(MARK + letter), F.lit(char))
    return F.when(field.contains(MARK), c).otherwise(field)


def apply_null_rules(df: DataFrame, spec: IngestSpec, decode=None) -> DataFrame:
    """S04 on raw fields: ``\\N`` -> NULL, empty -> ''. Ragged rows keep
    their fields NULL; they are rejected as malformed. A field that reads ``\\N``
    only after decoding (an escaped backslash before an N) is text."""
    if decode is None:
        cols = [F.when(F.col(CORRUPT).isNull(), _null_rules(F.col(s), spec.null_marker)).alias(s)
                for s in spec.source_fields]
        return df.select(*cols, F.col(CORRUPT), F.col(SOURCE_FILE))
    marker = F.lit(MARK + "N" if spec.null_marker == "\\N" else spec.null_marker)
    # one array, so that the decoding is planned once and not once per use of a field
    fields = F.transform(F.array(*spec.source_fields), lambda raw: F.when(
        raw == marker, F.lit(None).cast("string")).otherwise(F.coalesce(decode(raw, spec), F.lit(""))))
    ruled = df.select(F.when(F.col(CORRUPT).isNull(), fields).alias("_fields"), CORRUPT, SOURCE_FILE)
    return ruled.select(*[F.get("_fields", F.lit(i)).alias(s) for i, s in enumerate(spec.source_fields)],
                        CORRUPT, SOURCE_FILE)


#: Inferred types from narrow to wide; other pairs meet in a string.
WIDER = ("int", "bigint", "double")


def _common_type(kinds: set[str]) -> str:
    kinds = kinds - {"void"}
    if len(kinds) == 1:
        return kinds.pop()
    return max(kinds, key=WIDER.index) if kinds and kinds <= set(WIDER) else "string"


def read_headered(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0, **options) -> DataFrame:
    """Header-named CSV with inferred types (S08). Columns bind by name: files are
    grouped by their header line, each group is read in its own order, and the groups
    are joined by name; a column that a file lacks is NULL in its rows. Types are
    inferred per group and widened to a common one.

    Inference costs an extra pass over the sampled fraction, and where there are
    several files one over their lines for the headers; production loads use a spec."""
    paths = [path] if isinstance(path, str) else list(path)
    opts = {"samplingRatio": str(sampling_ratio), **options, "header": "true"}

    def group(files: list[str], schema: str | None = None) -> DataFrame:
        reader = spark.read.options(**opts)
        return (reader.schema(schema).option("enforceSchema", "false") if schema else reader.option("inferSchema", "true")).csv(files)

    lines = spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    if len(lines.inputFiles()) < 2:
        return group(paths)
    heads = lines.where("block = 0 and trim(line) <> ''").groupBy("file").agg(F.min_by("line", "row").alias("head"))
    # One row per layout; the list of files is the one that Spark holds for the read anyway.
    layouts = [r.files for r in heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()]
    if len(layouts) < 2:
        return group(paths)
    found = [group(files).dtypes for files in layouts]
    kinds: dict[str, set[str]] = {}
    for dtypes in found:
        for name, kind in dtypes:
            kinds.setdefault(name, set()).add(kind)
    tick = "`"
    parts = [group(files, ", ".join(f"`{n.replace(tick, tick * 2)}` {_common_type(kinds[n])}" for n, _ in dtypes)) for files, dtypes in zip(layouts, found)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def source_exists(spark: SparkSession, path: str) -> bool:
    """True when the path or glob matches at least one file or folder (S06), by the
    file system that holds it. Plain reads need no check: ``spark.read`` raises
    ``PATH_NOT_FOUND``."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return bool(found)
