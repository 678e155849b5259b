"""Incremental jobs on Structured Streaming (ST1-ST3).

File sources with checkpoints replace the original high-water-mark pulls:
progress is tracked by files, so rows are neither skipped nor processed
twice. Table writes happen in ``foreachBatch`` as insert-if-absent merges,
which makes a replayed batch (after a failure) a no-op. Checkpoints and
output tables live under the shared checkpoint location by default.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import buckets
from ..sources.io import scratch_path

#: Numbers of the key that a bucket of a sink's table holds.
SPAN = 1 << 20


def _file_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 4) -> DataFrame:
    """The table's files as a stream: a directory of part files, of which each
    micro-batch takes a few, or a single file."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    folder = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()
    reader = (spark.readStream.schema(spark.read.parquet(path).schema)
              .option("maxFilesPerTrigger", files_per_trigger))
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def split_into_files(spark: SparkSession, sf_dir: str, name: str, order: str, files: int = 8) -> str:
    """The table written as ``files`` part files, newest values of ``order``
    first, below a shared folder; returns the folder that holds the table. It
    lets a stream see several micro-batches, with late rows."""
    base = scratch_path(spark, f"{name}-files")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df.repartitionByRange(files, F.col(order).desc()).write.parquet(f"{base}/{name}.parquet")
    return base


def _merge_sink(table_path: str, key: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: D1 insert-if-absent into a table in buckets, so a
    batch replayed after a failure inserts nothing twice. Only the keys of the
    buckets that the batch's keys fall into are read for the comparison."""
    def write(batch: DataFrame, epoch: int) -> None:
        buckets.insert_absent(batch, table_path, key, [c for c in batch.columns if c != key])
    return write


def _open(like: DataFrame, table_path: str, key: str, span: int) -> None:
    """The sink's table, created empty where there is none: a bucket holds
    ``span`` numbers of the key, so new keys touch few buckets."""
    spark = like.sparkSession
    if buckets.current(spark, table_path) is None:
        buckets.create(spark.createDataFrame([], like.schema), table_path, f"{key} div {span}")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str = "append") -> None:
    """Process everything available now, then stop."""
    q = (stream.writeStream.foreachBatch(sink).outputMode(output_mode)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_questions(spark: SparkSession, sf_dir: str, table_path: str | None = None,
                     turns_dir: str | None = None, span: int = SPAN, asked: Column | None = None) -> DataFrame:
    """ST1: conversation turns arriving as files (below ``turns_dir``, where they
    are not with the other tables) -> messages -> loggable (J3), non-empty
    (F1) questions -> staging table (D1). ``asked`` says which messages (content,
    author_id) are questions; by default those of a user. Returns the table."""
    from ..operators.filters import non_empty
    from ..operators.joins import loggable_messages
    from ..sources import views as V
    table_path = table_path or scratch_path(spark, "staging")
    turns = _file_stream(spark, turns_dir or sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    role = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    msgs = turns.select((conv * 1000 + turn).alias("id"), (conv % 25).alias("channel_id"),
                        ((conv % 17) * 3 + role).alias("author_id"),
                        F.when((conv + turn) % 13 == 0, F.lit(None).cast("string"))
                         .when((conv + turn) % 11 == 0, F.lit("")).otherwise(F.col("text")).alias("content"))
    q = loggable_messages(non_empty(msgs), V.channels(spark, sf_dir))
    q = q.filter(F.col("author_id") % 3 == 0 if asked is None else asked).select(F.col("id").alias("message_id"),
                                                     F.lit(None).cast("int").alias("is_relevant"),
                                                     F.lit(0).alias("answered"))
    _open(q, table_path, "message_id", span)
    run_available(q, _merge_sink(table_path, "message_id"), table_path + "-ckpt")
    return buckets.read(spark, table_path)


def stream_import(spark: SparkSession, sf_dir: str, table_path: str | None = None,
                  span: int = SPAN) -> DataFrame:
    """ST2 + S10: event records arriving as files, in any order of time, merged
    exactly by key (D1): an id that is new is inserted however old it is. Times
    are rendered as ``yyyy-MM-dd HH:mm:ss``."""
    table_path = table_path or scratch_path(spark, "import")
    ev = _file_stream(spark, sf_dir, "events")
    ev = (ev.select(F.col("event_id").alias("message_id"), F.col("user_id").alias("author"),
                    F.col("event_type").alias("content"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_timestamp")))
    _open(ev, table_path, "message_id", span)
    run_available(ev, _merge_sink(table_path, "message_id"), table_path + "-ckpt")
    return buckets.read(spark, table_path)


def period_rollup_stream(spark: SparkSession, sf_dir: str, table_path: str | None = None,
                         interval: str = "1 day") -> DataFrame:
    """ST3: events per type and calendar period on a stream. Periods are
    wall-clock ``date_trunc`` buckets (time-zone independent for the NTZ
    event time).

    A micro-batch is aggregated by itself and kept as the partial result of its
    epoch (written again if the batch is replayed, so nothing counts twice);
    the rollup is the sum over the epochs. No state is held, late rows count,
    and a batch's cost follows its own rows."""
    table_path = table_path or scratch_path(spark, "rollup")
    ev = _file_stream(spark, sf_dir, "events")
    unit = interval.split()[-1].rstrip("s")

    def write(batch: DataFrame, epoch: int) -> None:
        (batch.groupBy(F.date_trunc(unit, F.col("ts")).alias("period"), "event_type")
              .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))
              .write.mode("overwrite").parquet(f"{table_path}/epoch={epoch}"))

    run_available(ev.select("ts", "event_type", "value"), write, table_path + "-ckpt")
    return (spark.read.parquet(table_path).groupBy("period", "event_type")
            .agg(F.sum("n_events").alias("n_events"), F.sum("total_value").alias("total_value")))
