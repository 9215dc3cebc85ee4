"""Starting, draining and replaying streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import new_folder

ONCE: Mapping[str, Any] = {"availableNow": True}

BATCH = "batch_id"
KEPT_PROGRESS = 10_000

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    max_files: int | None = None,
    **options: Any,
) -> DataFrame:
    """A folder as a stream: files must share a format and appear whole; their order is not kept.

    `path` may also be one existing file, which is then streamed as the only file of its folder.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if _is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        reader, path = reader.option("pathGlobFilter", name), folder
    return reader.options(**options).load(path)


def run_stream(
    df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] = ONCE,
    name: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start a query. `sink` is a format (files, kafka, console, memory) or a function of (batch, id).

    Each query gets a checkpoint folder of its own unless one is named to resume from.
    Triggers: {"availableNow": True}, {"processingTime": "5 seconds"}, {"once": True},
    {"continuous": "1 second"}, or {} for back-to-back micro-batches.
    """
    checkpoint = checkpoint or new_folder(df.sparkSession, "checkpoint")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink).options(**options)
    return _start(df.sparkSession, writer)


def _start(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Start with settings fit for state, then put the session's own back.

    State may outgrow memory, so it is kept on disk unless the session names a state store itself.
    Stateful operators are not re-planned at run time and open a store per partition, as many as
    `spark.sql.shuffle.partitions` says when the query first starts.
    """
    wanted = {"spark.sql.streaming.numRecentProgressUpdates": str(KEPT_PROGRESS)}
    if not spark.conf.get(STATE_STORE, ""):
        wanted[STATE_STORE] = STATE_ON_DISK
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain(df: DataFrame, sink: str | Callable[[DataFrame, int], None], **settings: Any) -> StreamingQuery:
    """Run a query over everything its source holds now, then stop."""
    query = run_stream(df, sink, **settings)
    query.awaitTermination()
    return query


def stream_to_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    trigger: Mapping[str, Any] = ONCE,
    **options: Any,
) -> StreamingQuery:
    """Append-only file sink; each row is written exactly once, also after a restart."""
    return run_stream(df, fmt, "append", checkpoint, trigger, path=path, **options)


def replace_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Batch sink that owns one folder per batch id: repeating a batch replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Batch sink that only appends: a repeated batch is written again (at least once)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    return write


def claim_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Batch sink that notes progress before writing: a repeated batch is left out (at most once).

    The claim is a folder that must not be there yet. That holds for one writer at a time, as a
    stream with its checkpoint is; two writers need a store whose creation is atomic.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            spark.range(1).write.mode("error").parquet(f"{path}_claims/batch_id={batch_id}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            return
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    return write


DELIVERY = {"exactly_once": replace_batch, "at_least_once": append_batch, "at_most_once": claim_batch}


def merge_batches(
    path: str, keys: Sequence[str], order: Sequence[str] = (), compact_every: int = 8
) -> Callable[[DataFrame, int], None]:
    """Batch sink that keeps the newest row of each key: by `order`, then by batch.

    Each batch leaves a delta of its own; after every `compact_every` batches the table so far is written as a
    snapshot from the last snapshot and the deltas since. A repeated batch writes the same delta and, from
    the snapshot before it, the same snapshot. Rows of one batch, key and order are told apart by their values.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        newest(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), keys, order).write.mode("overwrite").parquet(
            _folder(path, "deltas", batch_id)
        )
        if (batch_id + 1) % compact_every == 0:
            _merged(path, keys, order, schema, spark, batch_id).write.mode("overwrite").parquet(
                _folder(path, "snapshots", batch_id)
            )

    return write


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`, then batch, then the other values; a partial aggregate first."""
    values = [c for c in rows.columns if c not in keys and c not in order and c != BATCH]
    last = F.max(F.struct(*order, BATCH, *values)).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*rows.columns)


def _merged(
    path: str, keys: Sequence[str], order: Sequence[str], schema: StructType, spark: SparkSession, upto: int
) -> DataFrame:
    """The table after batch `upto`: the snapshot before it and the deltas since."""
    done = [n for n in _written(spark, path, "snapshots") if n < upto]
    after = max(done, default=-1)
    parts = [_folder(path, "snapshots", after)] if done else []
    parts += [_folder(path, "deltas", n) for n in _written(spark, path, "deltas") if after < n <= upto]
    full = StructType(list(schema.fields)).add(BATCH, "long")
    rows = spark.read.schema(full).parquet(*parts) if parts else spark.createDataFrame([], full)
    return newest(rows, keys, order)


def merged_table(path: str, keys: Sequence[str], schema: StructType, spark: SparkSession, order: Sequence[str] = ()) -> DataFrame:
    """Current table of `merge_batches`: one snapshot and the deltas since are read, whatever was before."""
    last = max(_written(spark, path, "deltas"), default=-1)
    return _merged(path, keys, order, schema, spark, last).select(*schema.names)


def _folder(path: str, kind: str, number: int) -> str:
    # Not `name=number`, which a reader would take for a column.
    return f"{path}/{kind}/{number:09d}"


def _written(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete folders of a kind."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}/*/_SUCCESS")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def last_result(path: str, schema: StructType, spark: SparkSession) -> DataFrame:
    """Result of a complete-mode stream written by `replace_batch`: the rows of its last batch."""
    rows = batches(spark, path, schema)
    return rows.where(F.col("batch_id") == rows.agg(F.max("batch_id")).scalar()).select(*schema.names)


def result(
    df: DataFrame,
    mode: str = "append",
    keys: Sequence[str] = (),
    checkpoint: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Drain a stream into the shared folder and return the table it leaves, read from files.

    append: all rows; complete: the last full result; update: the newest row per `keys`, merged batch by batch.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, "result")
    if mode == "append":
        drain(df, "parquet", mode=mode, checkpoint=checkpoint, path=path)
        return spark.read.schema(df.schema).parquet(path)
    if mode == "complete":
        drain(df, replace_batch(path), mode=mode, checkpoint=checkpoint)
        return last_result(path, df.schema, spark)
    drain(df, merge_batches(path, keys), mode=mode, checkpoint=checkpoint)
    return merged_table(path, keys, df.schema, spark)


def progress_table(query: StreamingQuery) -> DataFrame:
    """`batch_id, input_rows, watermark, dropped, state_rows`: what each trigger of a query did.

    `dropped` counts the groups that came too late, `state_rows` what all stateful operators hold after it. One
    small row a trigger; the session remembers `KEPT_PROGRESS` triggers of a query.
    """
    rows = []
    for progress in query.recentProgress:
        operators = progress["stateOperators"]
        mark = (progress["eventTime"] or {}).get("watermark")
        rows.append(
            (
                progress["batchId"],
                progress["numInputRows"],
                mark,
                sum(o["numRowsDroppedByWatermark"] for o in operators),
                sum(o["numRowsTotal"] for o in operators),
            )
        )
    spark = SparkSession.active()
    made = spark.createDataFrame(rows, "batch_id BIGINT, input_rows BIGINT, watermark STRING, dropped BIGINT, state_rows BIGINT")
    return made.withColumn("watermark", F.col("watermark").cast("timestamp"))


def replay(
    waves: Iterable[DataFrame],
    build: Callable[[DataFrame], DataFrame],
    mode: str = "append",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Let tables arrive one after the other and restart the query from its checkpoint each time.

    Every wave is landed whole and drained before the next, so event time advances the same way
    however many files a wave has. Returns the table the query leaves.
    """
    table: DataFrame | None = None
    landing = checkpoint = path = ""
    for number, wave in enumerate(waves):
        spark = wave.sparkSession
        if not landing:
            landing, checkpoint, path = (new_folder(spark, k) for k in ("landing", "checkpoint", "result"))
        wave.write.parquet(f"{landing}/wave={number}")
        arriving = stream_files(spark, f"{landing}/*", schema=wave.schema)
        table = result(build(arriving), mode, keys, checkpoint, path)
    if table is None:
        raise ValueError("nothing to replay")
    return table


def batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows written by `replace_batch`, each with its `batch_id`."""
    return spark.read.schema(StructType(list(schema.fields)).add("batch_id", "long")).parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(where) and files.getFileStatus(where).isFile()
