"""Typed ingestion: transforms, coercion, rejects, and the load flow.

``validate`` is pure DataFrame work on the raw fields of
``sources.delimited.read_delimited``: every target column is an expression
over raw fields (P01/P02), coerced with ``try_cast`` into the column type
(P03), and every row gets a reject reason or NULL. ``ingest`` runs a whole
load: one parse of the files into a staged Parquet folder (counts observed
during that same write), optional fail-fast, unique-key check, surrogate ids,
the table write, the named procedure and an audit row.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from ..sources.delimited import CORRUPT, SOURCE_FILE, read_delimited
from ..spec import IngestSpec

REASON = "_reject_reason"
RAW = "_raw_record"

_VARCHAR = re.compile(r"^\s*(var)?char\s*\(\s*(\d+)\s*\)\s*$", re.I)
_TOKEN = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|@([A-Za-z_][A-Za-z0-9_]*)")


class IngestError(RuntimeError):
    pass


def rewrite_transform(expr: str) -> str:
    """``NULLIF(@Trailer, '')`` -> ``NULLIF(`Trailer`, '')``; string literals untouched."""
    return _TOKEN.sub(lambda m: f"`{m.group(1)}`" if m.group(1) else m.group(0), expr)


def _source_expr(spec: IngestSpec, src: str) -> Column:
    t = spec.field_transformations.get(src)
    return F.expr(rewrite_transform(t)) if t else F.col(f"`{src}`")


def coerce(value: Column, type_text: str) -> tuple[Column, Callable[[Column], Column]]:
    """(typed value, failure flag from the typed value once it is a column). Varchar
    lengths follow table-insert rules: excess trailing spaces are trimmed, any other
    excess is a failure."""
    m = _VARCHAR.match(type_text)
    if m:
        n = int(m.group(2))
        s = value.cast("string")
        over = F.length(s) > n
        only_spaces = F.rtrim(F.substring(s, n + 1, 1 << 30)) == F.lit("")
        typed = F.when(over & only_spaces, F.substring(s, 1, n)).otherwise(s)
        return typed, lambda _: F.coalesce(over & ~only_spaces, F.lit(False))
    if type_text.strip().lower() == "string":
        return value.cast("string"), lambda _: F.lit(False)
    return value.try_cast(type_text), lambda typed: value.isNotNull() & typed.isNull()


def validate(raw: DataFrame, spec: IngestSpec) -> DataFrame:
    """Target columns (typed) + ``_reject_reason`` + ``_source_file`` + ``_raw_record``.
    One projection after the other, so that a field is transformed and cast once and
    not again for every reason that looks at it."""
    by_target = {t: s for s, t in spec.field_mappings}
    values, typed_cols, reasons = [], [], []
    for i, c in enumerate(spec.columns):
        src = by_target.get(c.name)
        value, typed = F.col(f"_v{i}"), F.col(f"_t{i}")
        values.append((_source_expr(spec, src) if src else F.lit(None)).alias(f"_v{i}"))
        cast, flag = coerce(value, c.type)
        typed_cols.append(cast.alias(f"_t{i}"))
        bad = flag(typed)
        reasons.append(F.when(bad, F.lit(f"bad value for {c.name}")))
        if not c.nullable:
            reasons.append(F.when(~bad & typed.isNull(), F.lit(f"NULL in NOT NULL column {c.name}")))
    corrupt = F.col(CORRUPT).isNotNull()
    reason = F.when(corrupt, F.lit("malformed record")).otherwise(
        F.nullif(F.concat_ws("; ", *reasons), F.lit("")))
    shown = [F.coalesce(F.col(f"`{s}`"), F.lit(spec.null_marker)) for s in spec.source_fields]
    raw_text = F.when(corrupt, F.col(CORRUPT)).otherwise(F.concat_ws(spec.delimiter, *shown))
    told = raw.select("*", *values).select("*", *typed_cols).select("*", reason.alias(REASON))
    return told.select(*[F.col(f"_t{i}").alias(c.name) for i, c in enumerate(spec.columns)], F.col(REASON), F.col(SOURCE_FILE),
                       F.when(F.col(REASON).isNotNull(), raw_text).alias(RAW))


def accepted(checked: DataFrame, spec: IngestSpec) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).select(*[c.name for c in spec.columns])


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull()).select(SOURCE_FILE, RAW, REASON)


def _as_declared(table: DataFrame, spec: IngestSpec) -> bool:
    """Whether the table's columns are those that the spec declares, so that staged rows are
    the table's rows as they stand."""
    declared = [(f.name, f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString())) for f in table.schema.fields]
    return declared == [(c.name, re.sub(r"\s", "", c.type.lower())) for c in spec.columns]


@dataclass
class LoadResult:
    table: str
    rows_read: int
    rows_loaded: int
    rows_rejected: int
    staged_path: str
    rejects: DataFrame
    procedure_result: DataFrame | None


def ingest(spark: SparkSession, spec: IngestSpec, path: str | list[str], mode: str = "replace",
           on_bad: str = "quarantine", table: str | None = None,
           quarantine_table: str | None = None, audit_table: str | None = None,
           procedure_params: dict | None = None) -> LoadResult:
    """Load files into ``table`` (default ``spec.target_table``).

    mode: ``replace`` (truncate + load, K01/K03), ``append`` (K02) or
    ``replace_partitions``: of a table in partitions (``spec.partition_by``) only
    those that the files have good rows of are replaced. A unique key must then hold
    the partition column, so that the rows that stay cannot break it.
    on_bad: ``fail`` raises before the table is touched if any row is
    rejected; ``quarantine`` loads the good rows and keeps the rejects.
    """
    from ..sinks.tables import append_table_data, ensure_table, replace_partitions, replace_table_data, with_surrogate_id
    from .constraints import check_unique
    from .keys import check_append, drop_keys, remember
    from .procedures import run_procedure
    from ..operators.verify import append_audit

    if mode not in ("replace", "append", "replace_partitions"):
        raise ValueError(f"mode must be replace, append or replace_partitions, got {mode!r}")
    if mode == "replace_partitions" and (not spec.partition_by or spec.unique_key and spec.partition_by not in spec.unique_key):
        raise ValueError("replace_partitions needs partition_by, as a part of the unique key where there is one")
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be fail or quarantine, got {on_bad!r}")
    table = table or spec.target_table
    started = _dt.datetime.now(_dt.timezone.utc)
    status, message = "failed", None
    rows_read = rows_rejected = rows_loaded = 0

    def audit() -> None:
        if audit_table:
            append_audit(spark, audit_table, spec=spec, target_table=table, path=path, mode=mode,
                         rows_read=rows_read, rows_loaded=rows_loaded if status == "ok" else 0,
                         rows_rejected=rows_rejected, status=status, message=message, started=started)

    try:
        ensure_table(spark, table, spec.ddl(), spec.partition_by)
        checked = validate(read_delimited(spark, path, spec), spec)
        obs = Observation(f"load_{table}")
        staged_path = work_path(spark, f"stage-{table}")
        (checked.observe(obs, F.count(F.lit(1)).alias("rows"),
                         F.count(F.col(REASON)).alias("rejected"))
         .write.parquet(staged_path))
        metrics = obs.get
        rows_read, rows_rejected = int(metrics["rows"]), int(metrics["rejected"])
        staged = spark.read.parquet(staged_path)
        rejects = rejected(staged)
        if on_bad == "fail" and rows_rejected:
            sample = [r[REASON] for r in rejects.limit(5).collect()]
            raise IngestError(f"{rows_rejected} rejected rows in {path}: {sample}")
        good = accepted(staged, spec)
        existing = spark.table(table)
        if spec.unique_key:
            if mode == "append":
                dups = check_append(spark, table, good, spec)
            else:
                dups = check_unique(good, spec.unique_key, spec.key_collation).limit(5).collect()
            if dups:
                raise IngestError(f"unique key {spec.unique_key} violated: {[tuple(d)[:len(spec.unique_key)] for d in dups]}")
        if spec.surrogate_id:
            start = 1
            if mode != "replace":
                start = (existing.agg(F.max(spec.surrogate_id)).first()[0] or 0) + 1
            good = with_surrogate_id(good, spec.surrogate_id, start)
        rows_loaded = rows_read - rows_rejected
        if mode != "append":
            if spec.partition_by:
                replace_partitions(spark, table, good, drop_others=mode == "replace")
            else:
                whole = not rows_rejected and not spec.surrogate_id and _as_declared(existing, spec)
                replace_table_data(spark, table, good, staged_path if whole else None)
            drop_keys(spark, table)
        else:
            append_table_data(spark, table, good)
            if spec.unique_key:
                remember(spark, table, good, spec)
        if quarantine_table and rows_rejected:
            ensure_table(spark, quarantine_table,
                         f"`{SOURCE_FILE}` STRING, `{RAW}` STRING, `{REASON}` STRING")
            append_table_data(spark, quarantine_table, rejects)
        proc = None
        if spec.procedure_name:
            params = dict(spec.procedure_params)
            params.update(procedure_params or {})
            proc = run_procedure(spark, spec.procedure_name, table=table, **params)
        status = "ok"
    except Exception as e:  # recorded, then re-raised: a failed load is an error
        message = f"{type(e).__name__}: {e}"
        try:
            audit()
        except Exception as told:  # never in place of the load's own error
            e.add_note(f"the audit row was not written: {told}")
        raise
    audit()
    return LoadResult(table, rows_read, rows_loaded, rows_rejected, staged_path, rejects, proc)
