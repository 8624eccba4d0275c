"""Joins: what is missing, lookups, geocoding, and the state of a grid of request centers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import files


def dealt(df: DataFrame, *keys: str, rows: int = 250_000) -> DataFrame:
    """Rows dealt by keys over partitions of about ``rows`` each, so that what a task holds doesn't grow with the table.

    For rows that are collected or sorted by the keys next: Spark joins small partitions again up to a size in compressed
    bytes, of which a task may need twenty times as much in memory. Fewer rows stay as they are. Rows are counted, which
    reads no column of a Parquet table without a filter.
    """
    n = -(-df.count() // rows)
    return df if n < 2 else df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def missed_ids(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Wanted rows not done; repeated wanted rows stay; null keys are never done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def missed_and_done(wanted: DataFrame, done: DataFrame, key: str, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Wanted rows that are missed and those that are done, and how many (good: missed): one join and one pass, written under ``path``."""
    seen = done.select(key).distinct().withColumn("_done", F.lit(True))
    rows = wanted.join(seen, key, "left")
    missed, there, n = files.split_and_count(rows, F.col("_done").isNull(), path)
    return missed.drop("_done"), there.drop("_done"), n


def remaining_work(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def subtract_areas(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points of a city without those of its sub-areas (exact text keys), reset to an unseen state."""
    rest = points.filter("x is not null and y is not null").join(areas.select("x", "y").distinct(), ["x", "y"], "left_anti")
    return rest.select("x", "y", F.lit(0).alias("ok0"), F.lit(0).alias("max"), F.lit(14000).cast("bigint").alias("max_timestamp"))


def lookup_names(df: DataFrame, table: DataFrame, key: str, name: str, default: str | None = "") -> DataFrame:
    """Code to name by a table of (key, name), the least of several; missing gives the default, or the code itself with default None."""
    found = df.join(table.groupBy(key).agg(F.min(name).alias(name)), key, "left")
    return found.withColumn(name, F.coalesce(name, F.col(key).cast("string") if default is None else F.lit(default)))


def combine_by_id(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key, *(c for c in b.columns if c not in a.columns)), key)


def plan_requests(cities: DataFrame, categories: DataFrame, centers: DataFrame, done: DataFrame, edge: float = 2.0) -> DataFrame:
    """Every center of every city with every category and its bounds, without what is done.

    Categories are a short list read by people (a hundred names): the planner sees their size and
    broadcasts them only below Spark's own threshold.
    """
    wanted = centers.join(cities, "city").join(categories, F.lit(True))
    wanted = wanted.withColumn("bounds", geo.rounded_bounds(F.col("x"), F.col("y"), edge)).filter("bounds is not null")
    return remaining_work(wanted, done, ["city", "category", "bounds"])


def geocode_join(df: DataFrame, geocodes: DataFrame, city: str, tries: Sequence[str]) -> DataFrame:
    """Attach lng, lat and adcode of the first tried address that the table (city, address, lng, lat, adcode) has.

    Of several geocodes of an address the least is taken. Blank addresses skip the join, so they don't meet in one task.
    """
    table = geocodes.groupBy(F.col("city").alias("_c"), F.col("address").alias("_a")).agg(F.min(F.struct("lng", "lat", "adcode")).alias("_g"))
    for i, c in enumerate(tries):
        address = F.nullif(F.trim(c), F.lit(""))
        df = df.join(table.withColumnRenamed("_g", f"_g{i}"), (F.col(city) == F.col("_c")) & (address == F.col("_a")), "left").drop("_c", "_a")
    hit = F.coalesce(*(F.col(f"_g{i}") for i in range(len(tries))))
    return df.withColumns({n: hit[n] for n in ("lng", "lat", "adcode")}).drop(*(f"_g{i}" for i in range(len(tries))))


def _checked(checks: DataFrame) -> DataFrame:
    return checks.groupBy("x", "y").agg(F.max(F.struct("n", "ts")).alias("_m")).select("x", "y", F.col("_m.n").alias("_n"), F.col("_m.ts").alias("_t"))


def upsert_grid_max(grid: DataFrame, checks: DataFrame, threshold: int = 30) -> DataFrame:
    """Take today's largest count of a center only if it is larger than the known one; unseen centers stay."""
    joined = grid.join(_checked(checks), ["x", "y"], "left")
    more = F.coalesce(F.col("_n") > F.col("max"), F.lit(False))
    return joined.select("x", "y", F.when(more, (F.col("_n") >= threshold).cast("int")).otherwise(F.col("ok0")).alias("ok0"), F.when(more, F.col("_n")).otherwise(F.col("max")).alias("max"), F.when(more, F.col("_t")).otherwise(F.col("max_timestamp")).alias("max_timestamp"))


def zero_returns(grid: DataFrame, checks: DataFrame) -> DataFrame:
    """Centers whose largest count is 0."""
    return grid.join(_checked(checks).filter("_n = 0").select("x", "y"), ["x", "y"], "left_semi").select("x", "y")


def checked_centers(grid: DataFrame, checks: DataFrame, threshold: int = 30) -> DataFrame:
    """Every center of the grid that was checked, with the new values whether they are larger or not."""
    new = _checked(checks).select("x", "y", (F.col("_n") >= threshold).cast("int").alias("ok0"), F.col("_n").alias("max"), F.col("_t").alias("max_timestamp"))
    return new.join(grid.select("x", "y"), ["x", "y"], "left_semi")


def update_centers(grid: DataFrame, centers: DataFrame, threshold: int = 30) -> DataFrame:
    """Matched rows take the collector's values, ok0 rises over the threshold; other rows stay."""
    mine = centers.select("x", "y", F.col("max").alias("_m"), F.col("max_timestamp").alias("_t"))
    j = grid.join(mine, ["x", "y"], "left")
    return j.select("x", "y", F.when((F.col("ok0") == 0) & (F.col("_m") > threshold), 1).otherwise(F.col("ok0")).alias("ok0"), F.coalesce("_m", "max").alias("max"), F.coalesce("_t", "max_timestamp").alias("max_timestamp"))


def backfill_mapping(new: DataFrame, old: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Null or empty values of the new mapping come from the old one."""
    b = old.select(key, F.col(value).alias("_old"))
    j = new.join(b, key, "full_outer")
    return j.select(key, F.coalesce(F.nullif(F.col(value), F.lit("")), F.nullif(F.col("_old"), F.lit(""))).alias(value))


def all_pairs(rounds: DataFrame, expected: DataFrame, deal: int = 64) -> DataFrame:
    """Every row of ``rounds`` with every distinct row of ``expected``, as an equi-join.

    Expected rows are dealt by hash over ``deal`` parts, and each part gets a copy of the rounds, so the rows made
    (all are asked for) come from many tasks and no task holds all of one side twice.
    """
    dealt = expected.distinct()
    dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(*dealt.columns), F.lit(deal)).cast("int"))
    return rounds.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(deal - 1)))).join(dealt, "_part").drop("_part")


def unanswered(requests: DataFrame, responses: DataFrame, seconds: int, key: str = "key", start: str = "start", ts: str = "ts") -> DataFrame:
    """Requests (key, start, more) that no response (key, ts) has answered from their start to ``seconds`` later, both included.

    Time is cut into bins as long as the interval, so a request's answers are in its bin or the next one: responses are
    in two bins each and (key, bin) is an equi-join key, for any interval. A key with many rows is spread over its
    bins. Requests without a start or key stay; repeated requests stay repeated.
    """
    width = max(1, seconds)
    bin_ = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (width * 1_000_000)).cast("bigint")
    seen = responses.select(F.col(key).alias("_key"), F.col(ts).cast("timestamp").alias("_ts"), bin_(ts).alias("_bin")).filter("_key is not null and _ts is not null")
    seen = seen.withColumn("_bin", F.explode(F.array(F.col("_bin") - 1, F.col("_bin")))).distinct()
    asked = requests.withColumns({"_start": F.col(start).cast("timestamp"), "_in": bin_(start)})
    answered = (F.col(key) == F.col("_key")) & (F.col("_in") == F.col("_bin")) & (F.col("_ts") >= F.col("_start")) & (F.col("_ts") <= F.col("_start") + F.make_dt_interval(secs=F.lit(seconds)))
    return asked.join(seen, answered, "left_anti").drop("_start", "_in")


def late_responses(rounds: DataFrame, expected: DataFrame, responses: DataFrame, seconds: int = 240) -> DataFrame:
    """(round columns with start, key) without an answer within ``seconds`` of the round's start, which may be longer than a round."""
    return unanswered(all_pairs(rounds, expected.select("key")), responses, seconds)
