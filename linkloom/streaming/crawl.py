"""Streams of pages and job logs.

Every function starts a query and returns it. ``available_now`` works off what
has arrived and stops; otherwise the query runs until it is stopped. Each batch
writes to a folder of its own number, so a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from linkloom.functions import urls as U
from linkloom.operators import pages as P
from linkloom.operators import sampler as S
from linkloom.schemas import PARSED_PAGE
from linkloom.session import delete, folders, materialize, scratch
from linkloom.sinks import pages as page_sink

STATE = "worker {worker}, start bigint, last bigint, acc bigint, idx bigint, n_dropped bigint, bucket int"
# Folders that the state of the streaming sampler is dealt into; fixed for the life of a stream.
STATE_BUCKETS = 64


def read_table(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1_000) -> DataFrame:
    """Stream of a Parquet table: a folder of part files, or a single file.

    A plain path has to be a folder, a pattern may match either, so the last letter
    is written as a pattern.
    """
    either = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(either)


def _read_out(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _read(spark, f"{path}/out", schema)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a stream has written; nothing yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _start(writer: DataStreamWriter, path: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", f"{path}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def parse_pages(
    pages: DataFrame, keep: list[str], path: str, rule: str = "http", available_now: bool = True
) -> StreamingQuery:
    """Parse pages as they arrive and add the pruned links."""
    parsed = P.parse(pages, keep).withColumn("pruned_links", U.prune(F.col("links"), rule))
    writer = parsed.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append")
    return _start(writer, path, available_now)


def read_parsed(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """Pages parsed so far; ``keep`` are the kept columns with their types."""
    parsed = [f"{f.name} {f.dataType.simpleString()}" for f in PARSED_PAGE.fields]
    return _read_out(spark, path, ", ".join([*keep, *parsed, "pruned_links array<string>"]))


def throughput(
    log: DataFrame, rate_seconds: int, lateness: str, path: str, available_now: bool = True
) -> StreamingQuery:
    """Jobs per worker in fixed intervals, while running.

    Each batch writes the windows it changed; the watermark bounds the state. How many jobs
    arrive is observed on the way in, so that those behind the watermark can be told.
    Read the results with ``read_throughput`` and ``read_late``.
    """
    untimed = F.count_if(F.col("processed_at").isNull()).alias("n_untimed")
    counted = (
        log.observe(_ARRIVED, F.count("*").alias("n_arrived"), untimed)
        .withWatermark("processed_at", lateness)
        .groupBy(F.window("processed_at", f"{rate_seconds} seconds").alias("w"), "worker")
        .agg(F.count("*").alias("jobs"))
        .select(F.col("w.start").alias("window_start"), "worker", "jobs")
    )
    running: list[StreamingQuery] = []

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        if running:  # what the batches before have observed
            note_arrivals(running[0], path)

    running.append(_start(counted.writeStream.outputMode("update").foreachBatch(store), path, available_now))
    return running[0]


_ARRIVED = "arrived"


def note_arrivals(query: StreamingQuery, path: str) -> None:
    """Save what the latest batches of a ``throughput`` stream observed. A running one
    does this itself, one batch behind; after the end it is called once."""
    spark = SparkSession.active()
    noted = {int(f.partition("=")[2]) for f in folders(spark, f"{path}/arrived") if f.startswith("batch_id=")}
    for progress in query.recentProgress:
        seen = progress["observedMetrics"].get(_ARRIVED)
        if seen is not None and progress["batchId"] not in noted:
            row = [(seen["n_arrived"], seen["n_untimed"])]
            rows = spark.createDataFrame(row, "n_arrived bigint, n_untimed bigint")
            rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/arrived/batch_id={progress['batchId']}")


def read_late(spark: SparkSession, path: str, worker: str = "string") -> DataFrame:
    """Per batch: jobs that arrived, had no time, were counted in a window, and came too late for theirs."""
    changes = _read_out(spark, path, f"window_start timestamp, worker {worker}, jobs bigint, batch_id int")
    # What a batch added to a window: its count less the one before. The windows of one worker are few rows each.
    key = F.struct(F.struct("worker"), "window_start")
    steps = Window.partitionBy(key).orderBy("batch_id")
    added = changes.withColumn("added", F.col("jobs") - F.coalesce(F.lag("jobs").over(steps), F.lit(0)))
    counted = added.groupBy("batch_id").agg(F.sum("added").alias("n_counted"))
    arrived = _read(spark, f"{path}/arrived", "n_arrived bigint, n_untimed bigint, batch_id int")
    n_counted = F.coalesce("n_counted", F.lit(0))
    late = F.col("n_arrived") - F.col("n_untimed") - n_counted
    return arrived.where("n_arrived > 0").join(counted, "batch_id", "left").select(
        F.col("batch_id").cast("long").alias("batch_id"), "n_arrived", "n_untimed", n_counted.alias("n_counted"), late.alias("n_late")
    )


def read_throughput(spark: SparkSession, path: str, worker: str = "string") -> DataFrame:
    """Latest count of every window and worker."""
    changes = _read_out(spark, path, f"window_start timestamp, worker {worker}, jobs bigint, batch_id int")
    return changes.groupBy("window_start", "worker").agg(F.max_by("jobs", "batch_id").alias("jobs"))


def _state_folders(spark: SparkSession, path: str, buckets: list[int], batch_id: int) -> list[str]:
    """The latest state before a batch of each bucket that has one; older ones are deleted, as no batch can be
    repeated that would need them."""
    latest = []
    for bucket in buckets:
        home = f"{path}/state/bucket={bucket}"
        batches = sorted(int(f.partition("=")[2]) for f in folders(spark, home) if f.startswith("batch_id="))
        before = [b for b in batches if b < batch_id]
        latest += [f"{home}/batch_id={b}" for b in before[-1:]]
        for b in before[:-1]:
            delete(spark, f"{home}/batch_id={b}")
    return latest


def sampler(
    log: DataFrame,
    rate_seconds: float,
    path: str,
    available_now: bool = True,
    fold_limit: int = S.FOLD_LIMIT,
    state_buckets: int = STATE_BUCKETS,
) -> StreamingQuery:
    """The elastic sampler with its state kept between batches.

    The state of a worker is (last, acc): put back as ``acc`` jobs at time
    ``last``, it continues the batch operator, with the same treatment of busy
    workers. Closed samples are written; jobs older than ``last`` can no longer be
    placed and are counted in ``n_dropped``. State is one row per worker, in folders by a hash of the worker: a
    batch reads and writes those of the workers it holds, and each keeps its last two versions, so that a
    repeated batch starts from where it did. Intermediate tables of a batch go with it.
    """
    worker_type = log.schema["worker"].dataType.simpleString()
    schema = STATE.format(worker=worker_type)
    bucket = F.pmod(F.xxhash64("worker"), F.lit(state_buckets)).cast("int").alias("bucket")

    def step(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            _sample(batch.sparkSession, batch, batch_id)

    def _sample(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        # Workers are structs, so that the NULL worker meets its own state.
        now = materialize(S.ticks(batch).select(F.struct("worker").alias("worker"), "t", "n", bucket), "ticks")
        touched = sorted(r.bucket for r in now.select("bucket").distinct().collect())  # at most state_buckets
        stored = _state_folders(spark, path, touched, batch_id)
        read = spark.read.schema(schema).option("basePath", f"{path}/state").parquet(*stored) if stored else spark.createDataFrame([], schema)
        old = read.select(*[c.name for c in read.schema if c.name != "batch_id"]).withColumn("worker", F.struct("worker"))
        workers = now.select("worker").distinct()
        past = old.join(workers, "worker", "left_semi")
        late = F.coalesce(F.col("t") < F.col("last"), F.lit(False)).alias("late")
        arrived = materialize(now.join(past.select("worker", "last"), "worker", "left").select("worker", "t", "n", late), "arrived")
        resumed = past.select("worker", F.col("last").alias("t"), F.col("acc").alias("n"))
        rows = S.samples(
            arrived.where(~F.col("late")).select("worker", "t", "n").unionByName(resumed), rate_seconds, fold_limit
        )
        before = past.select("worker", F.col("start").alias("_start"), F.col("idx").alias("_idx"), "n_dropped")
        dropped = arrived.where("late").groupBy("worker").agg(F.count("*").alias("_late"))
        continued = materialize(
            rows.join(before, "worker", "left").select(
                "worker",
                F.coalesce("_start", "start").alias("start"),
                (F.col("idx") + F.coalesce("_idx", F.lit(0))).alias("idx"),
                "jobs",
                "slots",
                "open",
                "since",
                F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
            ),
            "continued",
        )
        name = F.col("worker.worker").alias("worker")
        closed = continued.where(~F.col("open")).select(name, "start", "idx", "jobs", "slots", "since")
        closed.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        changed = continued.where("open").join(dropped, "worker", "left").select(
            "worker",
            "start",
            F.col("since").alias("last"),
            F.col("jobs").alias("acc"),
            "idx",
            (F.col("n_dropped") + F.coalesce("_late", F.lit(0))).alias("n_dropped"),
        )
        kept = old.join(workers, "worker", "left_anti").select(*changed.columns)
        state = changed.unionByName(kept).withColumn("worker", name).withColumn("bucket", bucket)
        state = state.withColumn("batch_id", F.lit(batch_id)).repartition("bucket")
        written = state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        written.partitionBy("bucket", "batch_id").parquet(f"{path}/state")

    return _start(log.writeStream.outputMode("append").foreachBatch(step), path, available_now)


def read_samples(spark: SparkSession, path: str, worker: str = "string") -> DataFrame:
    """Samples closed so far."""
    return _read_out(spark, path, f"worker {worker}, start bigint, idx bigint, jobs bigint, slots bigint, since bigint")


def store_pages(
    pages: DataFrame, order_by: list[str], path: str, available_now: bool = True
) -> StreamingQuery:
    """Store each page as it is processed; the first write of a url wins."""

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            page_sink.store_pages(batch, order_by, f"{path}/out", batch_id)

    return _start(pages.writeStream.outputMode("append").foreachBatch(store), path, available_now)


def totals(log: DataFrame, path: str, available_now: bool = True) -> StreamingQuery:
    """Running totals of jobs processed and links discovered."""
    running = log.groupBy().agg(
        F.count("*").alias("n_processed"), F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_discovered")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")

    return _start(running.writeStream.outputMode("complete").foreachBatch(store), path, available_now)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """Totals after the latest batch."""
    latest = F.max_by(F.struct("n_processed", "n_discovered"), "batch_id").alias("t")
    written = _read_out(spark, path, "n_processed bigint, n_discovered bigint, batch_id int")
    none = F.lit(0).cast("bigint")
    return written.agg(latest).select(*[F.coalesce(f"t.{c}", none).alias(c) for c in ("n_processed", "n_discovered")])
