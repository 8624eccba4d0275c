"""Sources and sinks: message streams, response folders, lists, and dated outputs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

GRID = "OBJECTID int, x double, y double, ok0 int, max int, max_timestamp bigint"
MESSAGE = "value string, timestamp timestamp"


@cache
def _local() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: ``spark.checkpoint.dir``, or a local one where both are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_messages(spark: SparkSession, source: str, fmt: str = "kafka", **options) -> DataFrame:
    """A stream of (value, timestamp): a topic from its earliest offset, or a folder of files of that schema."""
    if fmt == "kafka":
        rows = spark.readStream.format("kafka").option("subscribe", source).option("startingOffsets", "earliest").options(**options).load()
    else:
        rows = spark.readStream.format(fmt).schema(MESSAGE).options(**options).load(source)
    return rows.select(F.col("value").cast("string").alias("value"), "timestamp")


def land_raw(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    """Append what has arrived to a table and stop; a second run continues from the checkpoint."""
    return df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()


stream_to_table = land_raw


def export_single(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One file (for small results): JSON lines, or CSV with a header."""
    df.coalesce(1).write.mode("overwrite").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_responses(df: DataFrame, path: str, name: str, content: str) -> None:
    """One file a row, named by a column: text in UTF-8, or bytes as they are. Tasks write; a task that runs again overwrites."""
    rows = df.select(F.url_encode(name).alias("name"), F.col(content).cast("binary").alias("content"))

    def save(part: Iterator) -> None:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        for i, row in enumerate(part):
            if not i:
                store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{row['name']}") as file:
                file.write(bytes(row["content"] or b""))

    rows.foreachPartition(save)


def _together(files: DataFrame, splits: int = 16) -> DataFrame:
    """Small files in fewer tasks: Spark counts each as 4 MB and puts 32 in a split, so a task reads ``splits`` such splits one after the other.

    There stay at least two tasks a core where there were as many; large files are splits of their own, as they were,
    and rows are passed on one by one or in Arrow batches, so a task holds no more.
    """
    n = files.rdd.getNumPartitions()
    return files.coalesce(max(-(-n // splits), min(n, 2 * files.sparkSession.sparkContext.defaultParallelism)))


def read_response_dir(spark: SparkSession, path: str, name_fields: list[str], schema: str, sep: str = "___") -> DataFrame:
    """A folder of JSON responses, one a file; the file's name carries fields. Bad JSON gives null fields."""
    rows = _together(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("_n"))).select("value", F.regexp_replace("_n", r"\.[a-z]+$", "").alias("_n"))
    parts = F.split(F.url_decode("_n"), sep)
    return rows.select(*(F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(name_fields)), F.from_json("value", schema).alias("_v")).select(*name_fields, "_v.*")


def read_html_dir(spark: SparkSession, path: str, charset: str = "gb2312") -> DataFrame:
    """(file, html) of a folder of pages; bytes that the charset lacks are skipped."""
    decode = F.pandas_udf(lambda s: pd.Series([bytes(b).decode(charset, "ignore") for b in s], dtype=object), "string")
    return _together(spark.read.format("binaryFile").load(path).select("path", "content")).select(F.element_at(F.split("path", "/"), -1).alias("file"), decode("content").alias("html"))


def read_grid_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(GRID).csv(path)


def read_point_list(df: DataFrame, c: str) -> DataFrame:
    """Texts "x,y;x,y;…" to rows (x, y); parts without exactly two fields are dropped."""
    rows = df.select(F.explode(F.split(c, ";")).alias("p")).select(F.split("p", ",").alias("a")).filter(F.size("a") == 2)
    return rows.select(F.trim(F.col("a")[0]).try_cast("double").alias("x"), F.trim(F.col("a")[1]).try_cast("double").alias("y"))


def read_categories(df: DataFrame, c: str) -> DataFrame:
    """Lines "level1:a、b" to (level1, level2); a line without exactly one colon fails the load."""
    parts = F.split(c, ":")
    bad = F.raise_error(F.concat(F.lit("not a category line: "), F.col(c))).cast("array<string>")
    return df.select(F.when(F.size(parts) == 2, parts).otherwise(bad).alias("p")).select(F.col("p")[0].alias("level1"), F.explode(F.split(F.col("p")[1], "、")).alias("level2"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of text files: line numbers from 0 as in the file, however Spark splits it.

    Lines of a split are counted first; a line's number is that of the lines before its split, plus its own place in
    it. Only the counts, a row for each split, are joined, so no line is sorted or shuffled.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"), "value")
    splits = lines.groupBy("file", "_at").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "_at", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_before"))
    return lines.join(splits, ["file", "_at"]).select("file", (F.col("_id") + F.col("_before")).alias("line_no"), "value")


def _put(rows: DataFrame, path: str, parts: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions that ``rows`` has, and no others."""
    options = {"header": True} if fmt == "csv" else {}
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).options(**options).format(fmt).save(path)


def write_daily(df: DataFrame, path: str, date: str, run: str | None = None) -> None:
    """Append the rows to the day's JSON lines and CSV; a named run that is repeated replaces its own rows instead."""
    rows = df.withColumn("dt", F.lit(date))
    for fmt in ("json", "csv"):
        if run is None:
            rows.write.mode("append").partitionBy("dt").options(**({"header": True} if fmt == "csv" else {})).format(fmt).save(f"{path}/{fmt}")
        else:
            _put(rows.withColumn("run", F.lit(run)), f"{path}/{fmt}", ("dt", "run"), fmt)


def write_daily_batch(batch: DataFrame, epoch: int, path: str, ts: str) -> None:
    """A stream's batch to the JSON lines and CSV of its rows' days; a batch that comes again replaces what it wrote before."""
    rows = batch.withColumns({"dt": F.date_format(ts, "yyyy-MM-dd"), "run": F.lit(f"batch-{epoch}")})
    rows.persist()
    try:
        for fmt in ("json", "csv"):
            _put(rows, f"{path}/{fmt}", ("dt", "run"), fmt)
    finally:
        rows.unpersist()


def daily_stream(df: DataFrame, path: str, checkpoint: str, ts: str):
    """Write what has arrived with ``write_daily_batch`` and stop; a second run continues from the checkpoint."""
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, epoch: write_daily_batch(batch, epoch, path, ts)).trigger(availableNow=True).start()


def read_daily(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    """The rows of all days and runs, with ``dt``."""
    return spark.read.schema(f"{schema}, dt string, run string").options(**({"header": True} if fmt == "csv" else {})).format(fmt).load(f"{path}/{fmt}").drop("run")


def write_records(df: DataFrame, path: str, ts: str = "ts", city: str = "city") -> None:
    """A table of records in folders by date and city; the days and cities of ``df`` are replaced.

    Rows are dealt by folder with Spark's rebalancing, which puts small folders together and splits large ones.
    """
    rows = df.withColumn("date", F.to_date(ts))
    _put(rows.hint("rebalance", "date", city), path, ("date", city))


def read_records(spark: SparkSession, path: str, schema: str, city: str = "city") -> DataFrame:
    return spark.read.schema(f"{schema}, date date, {city} string").parquet(path)


#: Folders of a grid's table; centers are dealt by hash, so each has about as many.
GRID_PARTS = 32


def grid_part(x: str = "x", y: str = "y"):
    return F.pmod(F.xxhash64(x, y), F.lit(GRID_PARTS)).cast("int")


def write_grid(grid: DataFrame, path: str) -> None:
    """The grid (x, y, ok0, max, max_timestamp) as a table in folders of centers."""
    _put(grid.withColumn("part", grid_part()).repartition("part"), path, ("part",))


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("x double, y double, ok0 int, max int, max_timestamp bigint, part int").parquet(path)


def update_grid(spark: SparkSession, path: str, checks: DataFrame, update) -> list[int]:
    """Apply ``update(grid, checks)`` to the folders whose centers the checks have seen, and replace those that changed.

    Folders are written new and take the place of the old ones when all tasks are done (Spark's dynamic partition
    overwrite). Folders without a change stay as they are, so the same checks a second time write nothing. Gives the
    folders replaced.
    """
    seen = checks.select(grid_part().alias("part")).distinct()
    touched = [r.part for r in seen.collect()]  # GRID_PARTS at most
    old = read_grid(spark, path).filter(F.col("part").isin(touched))
    new = update(old.drop("part"), checks).withColumn("part", grid_part())
    same = ["x", "y", "ok0", "max", "max_timestamp", "part"]
    changed = sorted(r.part for r in new.select(*same).exceptAll(old.select(*same)).select("part").distinct().collect())
    if changed:
        _put(new.select(*same).filter(F.col("part").isin(changed)).repartition("part"), path, ("part",))
    return changed


def split_and_count(df: DataFrame, good: Column, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Rows that hold ``good`` and the rest (null counts as not), and how many: {all, good, bad}.

    One pass writes both, in a folder each, and Spark observes the numbers on the way.
    """
    seen = Observation()
    rows = df.withColumn("_good", F.coalesce(good, F.lit(False)))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if("_good").alias("good"))
    rows.write.mode("overwrite").partitionBy("_good").parquet(path)
    back = df.sparkSession.read.schema(rows.schema).parquet(path)
    n = seen.get
    return back.filter("_good").drop("_good"), back.filter("not _good").drop("_good"), {"all": n["all"], "good": n["good"], "bad": n["all"] - n["good"]}


def messages(df: DataFrame, time_col: str | None = None) -> DataFrame:
    """Rows as (value, timestamp): the row as JSON, and its event time (null without one)."""
    return df.select(F.to_json(F.struct("*")).alias("value"), (F.col(time_col) if time_col else F.lit(None)).cast("timestamp").alias("timestamp"))


def publish_messages(df: DataFrame, topic: str, time_col: str | None = None, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Rows as JSON with their event time to a topic, or, with another format, appended to ``path`` in a folder per topic."""
    out = messages(df, time_col).withColumn("topic", F.lit(topic)).write.format(fmt).options(**options)
    out.save() if fmt == "kafka" else out.mode("append").partitionBy("topic").save(path)
