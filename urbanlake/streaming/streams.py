"""Streaming jobs; each works on a batch DataFrame as well.

The route streams have no state. ``durations`` with a watermark, ``seen_max_stream``, ``poll_rounds``,
``late_requests`` and ``round_answers`` re-aim batch steps of the collectors as streams; their watermark of ten
minutes (two poll rounds) is ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, shape

COLUMNS = ("timestamp", "preset_route", "total_duration", "status", "polyline")


def route_stream_a(df: DataFrame) -> DataFrame:
    """Provider A: every segment brings its own polyline."""
    rows = shape.explode_steps(shape.flatten_message(df, shape.ROUTE_A), "tmcs")
    return rows.select("timestamp", "preset_route", "total_duration", "segment.status", "segment.polyline")


def route_stream_b(df: DataFrame) -> DataFrame:
    """Provider B: a step's path is cut over its segments."""
    rows = shape.flatten_message(df, shape.ROUTE_B).withColumn("step", F.explode("selected_path_steps"))
    rows = rows.withColumn("segment", F.explode(shape.cut_polyline(F.col("step.path"), F.col("step.traffic_condition"))))
    return rows.select("timestamp", "preset_route", "total_duration", "segment.status", "segment.polyline")


def durations(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Distinct (timestamp, preset_route, total_duration)."""
    keys = ["timestamp", "preset_route", "total_duration"]
    rows = df.select(*keys)
    return rows.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(keys) if df.isStreaming else rows.dropDuplicates(keys)


def message_durations(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """``durations`` of provider B's messages, as of ``route_stream_b``'s rows: a message with any segment has one key, so it is one row."""
    rows = shape.flatten_message(df, shape.ROUTE_B)
    return durations(rows.filter(F.exists("selected_path_steps", lambda step: F.size(step["traffic_condition"]) > 0)), delay)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under ``path``, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(at):
        return []
    found = [s.getPath() for s in store.listStatus(at) if s.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().partition("=")[2]) for p in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def merge_version(batch: DataFrame, path: str, epoch: int, keys: tuple[str, ...], kept: int = 2) -> None:
    """Write version ``epoch``: the maxima of ``n`` of the version below it and of ``batch``; older versions than the last ``kept`` go.

    An epoch that runs again reads the same version below it and overwrites its own, so nothing is counted twice;
    a version that was broken off has no ``_SUCCESS`` and is never read.
    """
    spark = batch.sparkSession
    below = [v for v in _versions(spark, path) if v < epoch]
    rows = batch.select(*keys, "n")
    if below:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/version={below[-1]}"))
    rows.groupBy(*keys).agg(F.max("n").alias("n")).write.mode("overwrite").parquet(f"{path}/version={epoch}")
    for old in [v for v in _versions(spark, path) if v <= epoch][:-kept]:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def seen_max_stream(df: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("center",)):
    """Running maximum of ``n`` per center, kept across runs: each batch merges the centers it touched into a new version.

    A version has a row per center, so reading costs as much as there are centers, however many runs there were.
    ``seen_max`` reads the maxima.
    """
    seen = df.groupBy(*keys).agg(F.max("n").alias("n"))
    return seen.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(lambda batch, epoch: merge_version(batch, path, epoch, keys)).trigger(availableNow=True).start()


def seen_max(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The maxima that ``seen_max_stream`` has kept under ``path``: its latest complete version (no rows before the first)."""
    versions = _versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/version={versions[-1]}") if versions else spark.createDataFrame([], schema)


def late_requests(requests: DataFrame, responses: DataFrame, seconds: int = 240, delay: str = "10 minutes") -> DataFrame:
    """Requests (key, start) that no response (key, ts) answers from their start to ``seconds`` later, both included.

    As streams, both sides have a watermark, and the join's time bounds let Spark drop a request once no answer can
    come in time any more; then it comes out, unanswered. State is the requests and answers of about ``delay`` plus
    ``seconds``, by key and bin of time, so a row meets the rows near it and not all of its key. An answer of which the watermark says that it is too late is not waited for. As batches it is the
    same join by bins of time.
    """
    if not requests.isStreaming:
        return joins.unanswered(requests, responses, seconds)
    return _answers(requests, responses, seconds, delay).filter("_ts is null").select("key", "start")


def _answers(requests: DataFrame, responses: DataFrame, seconds: int, delay: str) -> DataFrame:
    """The interval join as an equi-join on (key, bin), as Spark's join of streams compares a row with all kept rows of its join key.

    A bin is four intervals long. A request is in the bin of its start, an answer in those of all starts that it may
    answer: one, or two near a bin's start, so a pair meets in one bin only.
    """
    width = 4 * max(1, seconds) * 1_000_000
    bin_ = lambda c, back=0: F.floor((F.unix_micros(c) - back) / width).cast("bigint")
    ts = F.col("_ts").cast("timestamp")
    asked = requests.select("key", "start").withWatermark("start", delay).withColumn("_in", bin_(F.col("start").cast("timestamp")))
    seen = responses.select(F.col("key").alias("_key"), F.col("ts").alias("_ts")).withWatermark("_ts", delay)
    seen = seen.withColumn("_bin", F.explode(F.sequence(bin_(ts, max(0, seconds) * 1_000_000), bin_(ts))))
    in_time = (F.col("key") == F.col("_key")) & (F.col("_in") == F.col("_bin")) & (F.col("_ts") >= F.col("start")) & (F.col("_ts") <= F.col("start") + F.expr(f"interval {seconds} seconds"))
    return asked.join(seen, in_time, "left_outer")


def round_answers(requests: DataFrame, responses: DataFrame, minutes: int = 5, seconds: int = 240, delay: str = "10 minutes") -> DataFrame:
    """(start, expected, answered, missing) per poll round, of requests and responses that both are streams.

    The interval join's rows are counted per request first, as a request may have several answers, then per round;
    each count ends when the watermark passes it. Requests are told apart by key and start.
    """
    each = _answers(requests, responses, seconds, delay).select("start", "key", F.col("_ts").isNotNull().alias("ok")).groupBy("start", "key").agg(F.max("ok").alias("ok"))
    rounds = each.groupBy(F.window("start", f"{minutes} minutes")).agg(F.count(F.lit(1)).alias("expected"), F.count_if("ok").alias("answered"))
    return rounds.select(F.col("window.start").alias("start"), "expected", "answered", (F.col("expected") - F.col("answered")).alias("missing"))


def poll_rounds(df: DataFrame, minutes: int = 5, delay: str = "10 minutes", ts: str = "timestamp", expected: int | None = None) -> DataFrame:
    """(start, answered) per poll round, and with the number of requests of a round (expected, missing) too.

    As a stream a round comes out once the watermark has passed its end.
    """
    rows = df.withWatermark(ts, delay) if df.isStreaming else df
    out = rows.groupBy(F.window(ts, f"{minutes} minutes")).agg(F.count(F.lit(1)).alias("answered")).select(F.col("window.start").alias("start"), "answered")
    return out if expected is None else out.withColumns({"expected": F.lit(expected), "missing": F.greatest(F.lit(expected) - F.col("answered"), F.lit(0))})
