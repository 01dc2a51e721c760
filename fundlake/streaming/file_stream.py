"""Files arriving in a folder, loaded once each.

A Structured Streaming file source watches the incoming folder; every
micro-batch runs the same validation, key check and surrogate ids as a batch
load (``foreachBatch``), and writes its accepted rows and its rejects into
``batch_id=<epoch>`` partitions with dynamic partition overwrite. A replayed
epoch after a failure rewrites its own partition instead of appending twice, so
the sink is exactly-once together with the checkpoint, which is the record of
the files already processed. ``archive_dir`` moves processed files out of the
incoming folder (Spark archives a file once a later batch has committed, so
the newest file can stay in place until the next run).

No batch reads what earlier ones wrote. The keys seen so far are keyed streaming
state (``dropDuplicates`` in a RocksDB state store, kept with the checkpoint): the
rows of a batch arrive beside the keys among them that are new, and where fewer
keys are new than rows came, a key repeats. The next free surrogate id stands in
a ledger of one row per epoch. An audit row is written once per checkpoint, epoch
and status.

State keys must compare by bytes, table keys under a collation do not. So the
state holds a coarse form (decomposed, without marks, case-folded): keys that are
equal under the collation share it. Where it repeats, the exact check decides.
Keys with letters that have no ASCII base are kept in a folder of their own and
always compared exactly.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.constraints import check_unique
from ..operators.ingest import REASON, IngestError, accepted, rejected, validate
from ..operators.keys import HARD, KEY, folded_key, repeated_keys
from ..operators.procedures import run_procedure
from ..operators.verify import append_audit
from ..session import materialize, unique_name
from ..sinks.tables import with_surrogate_id
from ..sources.delimited import line_reader, numbered, parse_lines, source_exists
from ..spec import IngestSpec

#: What a stream is started with: keys on disk, of each batch only its changes are uploaded.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
NEW = "_new_key"


def read_arrivals(spark: SparkSession, incoming: str, spec: IngestSpec,
                  max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming raw fields of files landing in ``incoming`` (header lines
    skipped per file as in a batch load; only 0 or 1 header line)."""
    if spec.skip_lines > 1:
        raise ValueError("streamed files may skip at most one header line")
    if spec.multiline:
        raise ValueError("streamed files may not hold line breaks in fields")
    r = line_reader(spark.readStream, spec)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return parse_lines(numbered(r.csv(incoming)), spec)


def _arriving(raw: DataFrame, spec: IngestSpec) -> DataFrame:
    """Validated rows, and beside them the keys among them that no row had before."""
    checked = validate(raw, spec)
    if not spec.unique_key:
        return checked
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in spec.unique_key])
    rows = checked.withColumn(KEY, F.when(F.col(REASON).isNull() & whole, folded_key(spec)))
    keys = rows.where(F.col(KEY).isNotNull()).select(KEY).dropDuplicates([KEY])
    return rows.withColumn(NEW, F.lit(False)).unionByName(keys.withColumn(NEW, F.lit(True)), allowMissingColumns=True)


def _check_keys(rows: DataFrame, good: DataFrame, sink: str, epoch: int, spec: IngestSpec) -> None:
    """Refuse repeated keys. Earlier rows are read only where the state has seen a
    key's coarse form before, or for keys with letters that have no ASCII base."""
    spark = rows.sparkSession

    def earlier(folder: str) -> DataFrame | None:
        if not source_exists(spark, folder):
            return None
        return spark.read.schema(_stored(good.select(*spec.unique_key))).parquet(folder).filter(F.col("batch_id") != epoch)

    hard = rows.where(~F.col(NEW) & F.col(KEY).rlike(HARD)).select(*spec.unique_key)
    had = rows.agg(F.count(F.when(~F.col(NEW), F.col(KEY))).alias("rows"), F.count(F.when(F.col(NEW), 1)).alias("new"),
                   F.count(F.when(~F.col(NEW) & F.col(KEY).rlike(HARD), 1)).alias("hard")).first()
    dups: list = []
    if had["rows"] != had["new"] or had["hard"]:
        dups = check_unique(good, spec.unique_key, spec.key_collation).limit(5).collect()
        before = earlier(sink)
        if not dups and before is not None:
            dups = repeated_keys(good if had["rows"] != had["new"] else hard, before, spec)
    kept = earlier(f"{sink.rstrip('/')}__hard_keys") if not dups else None
    if kept is not None:
        dups = repeated_keys(good, kept, spec)
    if dups:
        raise IngestError(f"unique key {spec.unique_key} violated: {[tuple(d)[:len(spec.unique_key)] for d in dups]}")
    if had["hard"]:
        _put(hard, f"{sink.rstrip('/')}__hard_keys", epoch)


def _stored(rows: DataFrame) -> T.StructType:
    """How rows stand in a folder with one partition per epoch."""
    return T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])


def _put(rows: DataFrame, folder: str, epoch: int) -> None:
    """Write one epoch's partition, over what an earlier try of it left."""
    (rows.withColumn("batch_id", F.lit(epoch).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(folder))


def _next_id(spark: SparkSession, sink: str, epoch: int, spec: IngestSpec) -> int:
    """The first free surrogate id: one past the last epoch's ledger row."""
    last = f"{sink.rstrip('/')}__ledger/batch_id={epoch - 1}"
    if source_exists(spark, last):
        return spark.read.parquet(last).first()["next_id"]
    if not epoch or not source_exists(spark, sink):
        return 1
    before = spark.read.parquet(sink).filter(F.col("batch_id") < epoch)  # a sink without a ledger
    return (before.agg(F.max(spec.surrogate_id)).first()[0] or 0) + 1


def _batch_writer(spec: IngestSpec, sink: str, rejects_sink: str, on_bad: str, audit_table: str | None, checkpoint: str,
                  procedure_params: dict | None, after: Callable[[DataFrame, int], None] | None):
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        started = _dt.datetime.now(_dt.timezone.utc)
        obs = Observation(f"batch_{epoch}")
        arrived = ~F.col(NEW) if spec.unique_key else F.lit(True)
        # one read of the micro-batch feeds the checks and both outputs
        rows = materialize(batch.observe(obs, F.count_if(arrived).alias("rows"), F.count(REASON).alias("rejected")), "batch")
        checked = rows.where(arrived)
        n, bad = int(obs.get["rows"]), int(obs.get["rejected"])

        def audit(loaded_rows: int, status: str, message: str | None) -> None:
            if audit_table:
                append_audit(spark, audit_table, spec=spec, target_table=sink, path=f"batch {epoch}", mode="append", rows_read=n,
                             rows_loaded=loaded_rows, rows_rejected=bad, status=status, message=message, started=started,
                             run_id=f"{run}-{epoch}")

        try:
            if on_bad == "fail" and bad:
                raise IngestError(f"{bad} rejected rows in batch {epoch}")
            good = accepted(checked, spec)
            if spec.unique_key:
                _check_keys(rows, good, sink, epoch, spec)
            if spec.surrogate_id:
                first = _next_id(spark, sink, epoch, spec)
                good = with_surrogate_id(good, spec.surrogate_id, first)
                _put(spark.range(1).select(F.lit(first + n - bad).alias("next_id")), f"{sink.rstrip('/')}__ledger", epoch)
            _put(good, sink, epoch)
            _put(rejected(checked), rejects_sink, epoch)
            if spec.procedure_name:
                staged = unique_name("batch")
                spark.read.schema(_stored(good)).parquet(sink).where(F.col("batch_id") == epoch).drop("batch_id").createOrReplaceTempView(staged)
                try:
                    result = run_procedure(spark, spec.procedure_name, table=staged, **{**dict(spec.procedure_params), **(procedure_params or {})})
                    if after:
                        after(result, epoch)
                finally:
                    spark.catalog.dropTempView(staged)
        except Exception as e:
            audit(0, "failed", f"{type(e).__name__}: {e}")
            raise
        audit(n - bad, "ok", None)
    return write


def ingest_stream(spark: SparkSession, spec: IngestSpec, incoming: str, sink: str, checkpoint: str,
                  rejects_sink: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                  on_bad: str = "quarantine", audit_table: str | None = None, procedure_params: dict | None = None,
                  after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start the load stream. ``available_now`` processes what has arrived
    and stops (a scheduled run); otherwise it keeps watching. A batch passes the
    checks of a batch load: with ``on_bad='fail'`` a rejected row, and always a
    repeated key, ends the stream before the batch is written.

    The spec's procedure runs after each batch over the rows that the batch loaded,
    with ``procedure_params``; ``after`` gets its result and the epoch. A replayed
    epoch runs both again, so both should be keyed merges or writes by epoch."""
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be fail or quarantine, got {on_bad!r}")
    rejects_sink = rejects_sink or f"{sink.rstrip('/')}__rejects"
    src = _arriving(read_arrivals(spark, incoming, spec, max_files_per_trigger, archive_dir), spec)
    w = (src.writeStream.foreachBatch(_batch_writer(spec, sink, rejects_sink, on_bad, audit_table, checkpoint, procedure_params, after))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():  # a stream keeps the settings that it starts with
        spark.conf.set(name, value)
    try:
        return w.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def loaded(spark: SparkSession, sink: str, spec: IngestSpec) -> DataFrame:
    """The rows a stream has loaded so far, without the batch partition."""
    return spark.read.parquet(sink).select(*[c.name for c in spec.columns])
