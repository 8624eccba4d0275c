"""Projections, filters and flattening: raw messages and responses to typed rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo

# Field names of the messages of provider A and provider B, bulky keys of an air quality snapshot,
# and words that mark a row of headings or totals.
ROUTE_A = "preset_route string, duration string, selected_path_steps array<struct<duration:string, tmcs:array<struct<status:string, polyline:string>>>>, url string"
ROUTE_B = "preset_route string, duration string, selected_path_steps array<struct<duration:string, path:string, traffic_condition:array<struct<status:string, geo_cnt:string>>>>, url string"
SNAPSHOT_KEYS = ("localCityAir", "airDataTotal", "waterRealTimeList", "waterWeekList", "waterDataTotal")
TOTAL_WORDS = ("日期", "合计", "", "名称", "--")


def flatten_message(df: DataFrame, schema: str, value: str = "value", drop: Sequence[str] = ("url",), rename: Mapping[str, str] | None = None) -> DataFrame:
    """Parse a JSON column and promote its fields; ``duration`` becomes ``total_duration`` unless told otherwise."""
    rename = {"duration": "total_duration"} if rename is None else rename
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.from_json(value, schema).alias("_v")).select(*others, "_v.*").drop(*drop).withColumnsRenamed(dict(rename))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def flatten_content(df: DataFrame, content: str = "content") -> DataFrame:
    """Fields of the content struct before the housekeeping columns; rows without content are rejected."""
    return df.filter(F.col(content).isNotNull()).select(f"{content}.*", *(c for c in df.columns if c != content))


def unwrap_singletons(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Arrays of text: none gives "", one gives itself, more give the list as JSON."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.ArrayType):
            c = F.when(F.size(c) == 1, c[0]).when(F.size(c) > 1, F.to_json(c)).otherwise("").alias(f.name)
        out.append(c)
    return df.select(*out)


def stamp_rows(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def bbox_filter(df: DataFrame, lng: str, lat: str, box: Sequence[float]) -> DataFrame:
    """Strictly inside (lng_min, lat_min, lng_max, lat_max)."""
    x, y = F.col(lng), F.col(lat)
    return df.filter((x > box[0]) & (y > box[1]) & (x < box[2]) & (y < box[3]))


def rect_filter(df: DataFrame, lng: str, lat: str, rect: Sequence[float]) -> DataFrame:
    """Inside, borders included."""
    return df.filter(F.col(lng).between(rect[0], rect[2]) & F.col(lat).between(rect[1], rect[3]))


def valid_responses(df: DataFrame, rule: str) -> DataFrame:
    """Rows of a response table that succeeded, by provider: traffic, heat or poi."""
    rules = {
        "traffic": (F.col("status") == 1) & (F.col("infocode") == 10000) & (F.coalesce(F.length("body"), F.lit(0)) > 0),
        "heat": F.col("code") == 0,
        "poi": F.col("status") == 0,
    }
    return df.filter(rules[rule])


def reject_malformed(df: DataFrame, c: str, sep: str, n: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose text has n parts, and the rest (null texts too)."""
    good = F.coalesce(F.size(F.split(c, sep)) == n, F.lit(False)) & F.col(c).isNotNull()
    return df.filter(good), df.filter(~good)


def drop_total_rows(df: DataFrame, columns: Sequence[str], words: Sequence[str] = TOTAL_WORDS) -> DataFrame:
    for c in columns:
        df = df.filter(~F.coalesce(F.col(c), F.lit("")).isin(list(words)))
    return df


def normalize_poi(df: DataFrame, c: str) -> DataFrame:
    """Nine plain fields with missing as "", the detail as text, and its type and tag and the location lifted out."""
    plain = ("name", "address", "province", "city", "area", "telephone", "uid", "street_id", "detail")
    get = lambda p: F.get_json_object(c, f"$.{p}")
    text = lambda p: F.coalesce(get(p), F.lit(""))
    return df.withColumns({**{p: text(p) for p in plain}, "detail_info": text("detail_info"), "type": text("detail_info.type"), "tag": text("detail_info.tag"), "lat": get("location.lat").try_cast("double"), "lng": get("location.lng").try_cast("double")})


def pick_route(routes: Column, label: str, prefer_tagged: bool = True) -> Column:
    """First route whose strategy holds the label, else the first; without preference the first of several."""
    first = F.try_element_at(routes, F.lit(1))
    tagged = F.try_element_at(F.filter(routes, lambda r: F.coalesce(r["strategy"].contains(label), F.lit(False))), F.lit(1))
    return F.coalesce(tagged, first) if prefer_tagged else F.when(F.size(routes) > 1, first).otherwise(F.coalesce(tagged, first))


def explode_steps(df: DataFrame, segments: str) -> DataFrame:
    """One row per traffic segment of each step; messages without any vanish."""
    steps = df.withColumn("step", F.explode("selected_path_steps")).drop("selected_path_steps")
    return steps.withColumn("segment", F.explode(f"step.{segments}"))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where the use is inside a function over an array."""
    return F.transform(F.array(value), use)[0]


def cut_polyline(path: Column, conditions: Column) -> Column:
    """array<struct(status, polyline)>: segment i has geo_cnt + 1 points and shares its ends with its neighbours.

    The path is split once and only the numbers of the first points are summed along the segments.
    """
    counts = F.transform(conditions, lambda x: F.coalesce(x["geo_cnt"].try_cast("int"), F.lit(0)))
    starts = F.aggregate(counts, F.array(F.lit(0)), lambda s, n: F.array_append(s, F.element_at(s, -1) + n))

    def cut(points: Column, at: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            own = F.slice(points, F.get(at, i) + 1, F.get(at, i + 1) - F.get(at, i) + 1)
            return F.struct(x["status"].alias("status"), F.array_join(own, ";").alias("polyline"))

        return F.transform(conditions, piece)

    return _with(F.split(path, ";"), lambda points: _with(starts, lambda at: cut(points, at)))


def heat_points(df: DataFrame, box: Sequence[float] | None = None) -> DataFrame:
    """(count, lng, lat, others) in BD-09 from responses with max_data and data(count, grid_x, grid_y)."""
    others = [c for c in df.columns if c not in ("data", "max_data")]
    rows = df.select(*others, F.coalesce("max_data", F.lit(40.0)).alias("max_data"), F.explode("data").alias("d"))
    p = geo.gcj02_to_bd09((250 * F.col("d.grid_x") + 125) * 1e-6, (250 * F.col("d.grid_y") + 125) * 1e-6)
    out = rows.select(*others, (F.col("d.count") / (F.col("max_data") / 40)).alias("count"), p.alias("p")).select(*others, "count", "p.lng", "p.lat")
    return bbox_filter(out, "lng", "lat", box) if box else out


def drop_keys(m: Column, keys: Sequence[str] = SNAPSHOT_KEYS, response_time: Column | str | None = None) -> Column:
    """A map without some keys; with a time it also gets ``response_time``."""
    kept = F.map_filter(m, lambda k, v: ~k.isin(list(keys)) & (k != "response_time")) if response_time is not None else F.map_filter(m, lambda k, v: ~k.isin(list(keys)))
    if response_time is None:
        return kept
    return F.map_concat(kept, F.create_map(F.lit("response_time"), response_time if isinstance(response_time, Column) else F.lit(response_time)))


def time_range(df: DataFrame, city: str, start: str, end: str, ts: str = "ts", name: str = "city", date: str | None = None) -> DataFrame:
    """Records of one city from one hour to another, both included.

    The column stays bare and the ends are constants of its type, so the filter reaches the files; with ``date``, a
    column that the table's folders are named by, only the folders of those days are read.
    """
    kind = df.schema[ts].dataType
    hour = lambda text: F.date_trunc("hour", F.lit(text).cast("timestamp"))
    first = F.when(hour(start) == F.lit(start).cast("timestamp"), hour(start)).otherwise(hour(start) + F.expr("interval 1 hour"))
    rows = df.filter((F.col(name) == city) & (F.col(ts) >= first.cast(kind)) & (F.col(ts) < (hour(end) + F.expr("interval 1 hour")).cast(kind)))
    return rows if date is None else rows.filter(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def in_ranges(df: DataFrame, ranges: DataFrame, ts: str = "ts", name: str = "city", date: str = "date") -> DataFrame:
    """Records (of a table in folders by date and city) in any of the ranges (city, start, end), both ends included.

    The ranges become a row per city and day, so the join is on the folders' names, and Spark reads only the folders
    that the ranges name (dynamic partition pruning, where the ranges are few or filtered).
    """
    days = F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date")))
    wanted = ranges.filter("start <= end").select(F.col("city").alias("_city"), "start", "end", days.alias("_date"))
    inside = (F.col(name) == F.col("_city")) & (F.col(date) == F.col("_date")) & (F.col(ts) >= F.col("start")) & (F.col(ts) <= F.col("end"))
    return df.join(wanted, inside, "left_semi")


def drop_blank_rows(df: DataFrame, cells: str, n: int = 7) -> tuple[DataFrame, DataFrame]:
    """Rows of n cells of which one is not blank, and rows of other widths."""
    size = F.coalesce(F.size(cells), F.lit(-1))
    return df.filter((size == n) & F.exists(cells, lambda x: F.coalesce(F.trim(x), F.lit("")) != "")), df.filter(size != n)


def register_functions(spark) -> None:
    """``parse_path(path)`` for SQL texts of the session: "x,y;x,y" to an array of arrays of texts."""
    spark.sql("create or replace temporary function parse_path(path string) returns array<array<string>> return transform(split(path, ';'), p -> split(p, ','))")
