"""Aggregates, deduplication, sorts and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo


def grid_extent(df: DataFrame, x: str = "x", y: str = "y", edge: float = 0.0) -> DataFrame:
    """One row with the box of all centers and an optional margin."""
    lng, lat = F.round(x, 6), F.round(y, 5)
    dx, dy = geo.LNG_KM * edge, geo.LAT_KM * edge
    return df.agg((F.min(lng) - dx).alias("lng_min"), (F.max(lng) + dx).alias("lng_max"), (F.min(lat) - dy).alias("lat_min"), (F.max(lat) + dy).alias("lat_max"))


def extent_of_polygons(df: DataFrame, polygon: str = "polygon") -> DataFrame:
    p = df.select(F.explode(polygon).alias("p"))
    return p.agg(*(f(f"p.{c}").alias(f"{c}_{n}") for c in ("lng", "lat") for n, f in (("min", F.min), ("max", F.max))))


def _tile(part: Column) -> Column:
    """A number of a tile name; m marks a negative one."""
    return F.regexp_replace(part, "^m", "-").try_cast("int")


def tile_numbers(name: Column) -> Column:
    parts = F.split(F.regexp_replace(name, r"\.png$", ""), "_")
    return F.struct(*(_tile(F.get(parts, F.lit(i))).alias(c) for i, c in enumerate("xyz")))


def tile_extent(df: DataFrame, name: str) -> DataFrame:
    t = df.select(tile_numbers(F.col(name)).alias("t"))
    return t.agg(F.min("t.x").alias("x_min"), F.max("t.x").alias("x_max"), F.min("t.y").alias("y_min"), F.max("t.y").alias("y_max"))


def unique_counts(df: DataFrame, file: str, id: str) -> DataFrame:
    """Rows and distinct ids per file, and over all files (file null).

    Ids are made distinct per file first, so no count of distinct values runs in one task.
    """
    per = df.groupBy(file, id).agg(F.count(F.lit(1)).alias("n"))
    files = per.groupBy(file).agg(F.sum("n").alias("n_rows"), F.count(id).alias("n_ids"))
    ids = per.groupBy(id).agg(F.sum("n").alias("n")).agg(F.sum("n").alias("n_rows"), F.count(id).alias("n_ids"))
    return files.unionByName(ids.withColumn(file, F.lit(None).cast(df.schema[file].dataType)))


def id_sketches(df: DataFrame, file: str, id: str, log_size: int = 14) -> DataFrame:
    """(file, n_rows, sketch): rows and a HyperLogLog sketch of the ids of each file, of 2 ** ``log_size`` registers at most.

    Sketches can be kept and united later, without the rows. Their relative error is about 0.8 / 2 ** (log_size / 2):
    0.65 percent (one standard deviation) as it is. Ids are whole numbers or texts; nulls don't count.
    """
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(id, log_size).alias("sketch"))


def sketched_counts(sketches: DataFrame, file: str) -> DataFrame:
    """(file, n_rows, n_ids) from sketches, per file and over all files (file null); several rows of a file are united."""
    per = sketches.groupBy(file).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))
    both = per.unionByName(per.agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch")).withColumn(file, F.lit(None).cast(sketches.schema[file].dataType)))
    return both.select(file, "n_rows", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("n_ids"))


def log_type_counts(df: DataFrame, line: str, labels: Mapping[str, str]) -> DataFrame:
    """(label, n): lines that contain a label's text; one line counts for all its labels."""
    hits = F.filter(F.array(*(F.when(F.col(line).contains(text), name) for name, text in labels.items())), lambda x: x.isNotNull())
    return df.select(F.explode(hits).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def pages_per_list(df: DataFrame, first: str, page: str) -> tuple[DataFrame, DataFrame]:
    """Per first page (page null) the number of further pages; and further pages of unknown lists."""
    heads = df.filter(F.col(page).isNull()).select(first).distinct()
    more = df.filter(F.col(page).isNotNull()).groupBy(first).agg(F.count(F.lit(1)).alias("pages"))
    return heads.join(more, first, "left").withColumn("pages", F.coalesce("pages", F.lit(0))), more.join(heads, first, "left_anti")


def unanswered_pages(requested: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """Requested minus answered per key; keys that were never requested have a negative number."""
    a = requested.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    b = answered.groupBy(key).agg(F.count(F.lit(1)).alias("_a"))
    n = F.coalesce("_r", F.lit(0)) - F.coalesce("_a", F.lit(0))
    return a.join(b, key, "full_outer").select(key, n.alias("unanswered"), F.col("_r").isNull().alias("unknown"), F.col("_a").isNull().alias("silent"))


def max_per_center(df: DataFrame, keys: Sequence[str], n: str, ts: str) -> DataFrame:
    """Largest number per center and the latest time it was seen."""
    return df.groupBy(*keys).agg(F.max(F.struct(n, ts)).alias("_m")).select(*keys, F.col(f"_m.{n}").alias("max"), F.col(f"_m.{ts}").alias("max_timestamp"))


def progress(wanted: DataFrame, done: DataFrame) -> DataFrame:
    a, b = wanted.agg(F.count(F.lit(1)).alias("wanted")), done.agg(F.count(F.lit(1)).alias("done"))
    return a.join(b, F.lit(True)).withColumn("left", F.col("wanted") - F.col("done"))


def mapping_gaps(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(F.col(value), F.lit("")) == "").alias("gaps"), F.count(F.lit(1)).alias("total"))


def latest_snapshot(df: DataFrame, keys: Sequence[str], date: str, today, max_age: int) -> DataFrame:
    """Latest date per key, and whether it is older than ``max_age`` days on ``today``."""
    return df.groupBy(*keys).agg(F.max(date).alias("latest")).withColumn("stale", F.datediff(F.lit(today).cast("date"), F.col("latest").cast("date")) > max_age)


def tile_batches(df: DataFrame, name: str, size: int) -> DataFrame:
    """(bx, by, tiles): the tile names of each batch of ``size`` by ``size``, counted from the smallest tile, in order of name.

    A tile is struct(name, x, y); where there are negative numbers all are shifted up by the smallest.
    """
    tiles = df.select(F.col(name).alias("name")).distinct().select("name", tile_numbers(F.col("name")).alias("t")).select("name", "t.x", "t.y")
    low = tiles.agg(F.min("x").alias("x"), F.min("y").alias("y")).first()
    batch = {f"b{c}": F.floor((F.col(c) - low[c]) / size) for c in "xy"}
    shifted = {c: F.col(c) - min(0, low[c] or 0) for c in "xy"}
    return tiles.withColumns(batch).withColumns(shifted).groupBy("bx", "by").agg(F.sort_array(F.collect_list(F.struct("name", "x", "y"))).alias("tiles"))


def over_limit(df: DataFrame, keys: Sequence[str], total: str, cap: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(total).alias("total")).filter(F.col("total") >= cap)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by ``order``: a minimum that is combined before the shuffle."""
    others = [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *others)).alias("_f")).select(*keys, "_f.*").select(*df.columns)


def dedupe_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def new_per_file(df: DataFrame, file: str, link: str, min_new: int = 59) -> DataFrame:
    """Per file, in order: links, links not seen in earlier files, and whether those are too few.

    A link's first file is a partial minimum, so links on every page don't meet in one task.
    """
    first = df.groupBy(link).agg(F.min(file).alias(file)).groupBy(file).agg(F.count(F.lit(1)).alias("n_new"))
    total = df.groupBy(file).agg(F.count(F.lit(1)).alias("n_links"))
    return total.join(first, file, "left").withColumn("n_new", F.coalesce("n_new", F.lit(0))).withColumn("few", F.col("n_new") < min_new)


def running_offset(df: DataFrame, part: Sequence[str], pos: str, n: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(n).over(w), F.lit(0)))


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *others)).alias("_l")).select(*keys, "_l.*").select(*df.columns)


def sort_tiles(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("y"), F.asc("x"))


def shuffle_cells(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """A random order that repeats for a seed."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key)


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_sources(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
