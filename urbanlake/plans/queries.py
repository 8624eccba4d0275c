"""Registered queries: each operator over whole driver tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import aggs, grids, joins, records, shape
from ..sources import files
from ..streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
HEAT_BOX = (113.1, 22.6, 113.9, 23.4)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def micro(c: Column) -> Column:
    return F.floor(c * 1e6 + 0.5).cast("bigint")


def m(sql: str) -> str:
    return f"cast(floor(({sql}) * 1e6 + 0.5) as bigint)"


def points(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    lng = 113 + F.pmod(F.col("event_id") * 7919, F.lit(100000)) / 100000.0
    lat = 22.5 + F.pmod(F.col("event_id") * 104729, F.lit(100000)) / 100000.0
    return e.select(F.col("event_id").alias("id"), lng.alias("lng"), lat.alias("lat"), F.col("value").alias("count"), "ts", "user_id", "event_type")


PTS = "pts as (select event_id as id, 113 + (event_id * 7919 % 100000) / 100000::double as lng, 22.5::double + (event_id * 104729 % 100000) / 100000::double as lat, value as cnt, ts, user_id, event_type from events)"


def centers(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select((113 + F.pmod(k * 7919, F.lit(1000)) / 1000.0).alias("x"), (22.5 + F.pmod(k * 104729, F.lit(1000)) / 1000.0).alias("y"), k.alias("k"), F.col("c_nationkey").alias("nation"), "c_mktsegment")


CEN = "cen as (select 113 + (c_custkey * 7919 % 1000) / 1000::double as x, 22.5::double + (c_custkey * 104729 % 1000) / 1000::double as y, c_custkey as k, c_nationkey as nation, c_mktsegment from customer)"


def grid(spark: SparkSession, d: str) -> DataFrame:
    return centers(spark, d).dropDuplicates(["x", "y"]).select("x", "y").withColumns({"ok0": (F.floor(F.col("x") * 1000 + 0.5) % 2).cast("int"), "max": (F.floor(F.col("y") * 1000 + 0.5) % 60).cast("int"), "max_timestamp": F.lit(14000).cast("bigint")})


GRID = f"{CEN}, grid as (select distinct x, y, (floor(x * 1000 + 0.5)::bigint % 2)::int as ok0, (floor(y * 1000 + 0.5)::bigint % 60)::int as max, 14000::bigint as max_timestamp from cen)"


def checks(spark: SparkSession, d: str) -> DataFrame:
    """All orders as checks of their customer's center; those of every third customer are of a center that no grid has."""
    o, k = t(spark, d, "orders"), F.col("o_custkey")
    x = 113 + F.pmod(k * 7919, F.lit(1000)) / 1000.0 + F.when(k % 3 == 0, 5.0).otherwise(0.0)
    return o.select(x.alias("x"), (22.5 + F.pmod(k * 104729, F.lit(1000)) / 1000.0).alias("y"), (F.col("o_orderkey") % 70).cast("int").alias("n"), F.col("o_orderkey").alias("ts"))


CHK = "chk as (select 113 + (o_custkey * 7919 % 1000) / 1000::double + (case when o_custkey % 3 = 0 then 5 else 0 end)::double as x, 22.5::double + (o_custkey * 104729 % 1000) / 1000::double as y, (o_orderkey % 70)::int as n, o_orderkey as ts from orders), best as (select x, y, max(n) as bn, max(ts) filter (n = mn) as bt from (select *, max(n) over (partition by x, y) as mn from chk) group by x, y)"


# -- the heat grid, end to end -------------------------------------------------------------------

_bd = lambda lng, lat: (f"(sqrt({lng}*{lng}+{lat}*{lat}) + 0.00002*sin({lat}*{geo.TURN!r}))", f"(atan2({lat}, {lng}) + 0.000003*cos({lng}*{geo.TURN!r}))")
BD_LNG, BD_LAT = (f"{_bd('lng', 'lat')[0]}*{f}({_bd('lng', 'lat')[1]}) + {o!r}" for f, o in (("cos", geo.BD_LNG), ("sin", geo.BD_LAT)))


@query(f"""with {PTS}, b as (select *, {m(BD_LNG)} as x, {m(BD_LAT)} as y from pts where lng > 113.1 and lng < 113.9 and lat > 22.6 and lat < 23.4),
f as (select *, row_number() over (partition by cnt, x, y order by ts, id) as rn from b),
k as (select cnt, unnest(case when x % 10000 = 0 then [x // 10000 - 1, x // 10000] else [x // 10000] end) as i, y from f where rn = 1),
k2 as (select cnt, i, unnest(case when y % 10000 = 0 then [y // 10000 - 1, y // 10000] else [y // 10000] end) as j from k)
select i, j, count(*) as n, sum(cast(round(cnt * 100) as bigint)) as total from k2 group by i, j""")
def heat_grid(spark, d):
    """Population heat: clip, convert, keep the first of equal points, sum per cell."""
    p = shape.bbox_filter(points(spark, d), "lng", "lat", HEAT_BOX)
    b = geo.gcj02_to_bd09(F.col("lng"), F.col("lat"))
    p = p.withColumn("b", b).select("id", "ts", "count", micro(F.col("b.lng")).alias("x"), micro(F.col("b.lat")).alias("y"))
    p = aggs.dedupe_keep_first(p, ["count", "x", "y"], ["ts", "id"])
    p = p.withColumns({"n": F.lit(1).cast("bigint"), "c": F.round(F.col("count") * 100).cast("bigint")})
    both = lambda c: F.when(F.pmod(F.col(c), F.lit(10000)) == 0, F.array(F.floor(F.col(c) / 10000) - 1, F.floor(F.col(c) / 10000))).otherwise(F.array(F.floor(F.col(c) / 10000)))
    rows = p.withColumn("i", F.explode(both("x"))).withColumn("j", F.explode(both("y")))
    return rows.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("c").alias("total"))


# -- sources and sinks ---------------------------------------------------------------------------

_ROUTE_SQL = """o as (select o_orderkey, 'r' || (o_custkey % 7) as preset_route, (o_orderkey % 3600)::varchar as total_duration from orders),
s as (select o.*, l_linenumber as ln, l_linenumber % 3 + 1 as g, l_returnflag as f1, l_linestatus as f2 from o join lineitem on l_orderkey = o_orderkey)"""


def _with_lines(spark: SparkSession, d: str, step: Column, orders: Column | None = None, lines: Column | None = None) -> DataFrame:
    """Orders (those that a condition holds for) with their lines' steps as ``selected_path_steps``.

    The lines are dealt by order first, so a task collects, sorts and joins a bounded number of them.
    """
    o, li = t(spark, d, "orders"), t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus")
    o, li = (o if orders is None else o.filter(orders)), (li if lines is None else li.filter(lines))
    steps = joins.dealt(li, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(step).alias("selected_path_steps"))
    return o.join(steps, F.col("o_orderkey") == F.col("l_orderkey"))


def messages_b(spark: SparkSession, d: str, orders: Column | None = None, lines: Column | None = None) -> DataFrame:
    """Provider B's messages: an order is a message, its lines are steps with a path of five points and two segments."""
    path = F.concat_ws(";", *(F.concat(F.lit(f"{i},"), F.col("l_linenumber").cast("string")) for i in range(5)))
    seg = lambda s, g: F.struct(F.col(s).alias("status"), g.cast("string").alias("geo_cnt"))
    step = F.struct(F.lit("1").alias("duration"), path.alias("path"), F.array(seg("l_returnflag", F.col("l_linenumber") % 3 + 1), seg("l_linestatus", F.lit(1))).alias("traffic_condition"))
    rows = _with_lines(spark, d, step, orders, lines)
    body = F.struct(F.concat(F.lit("r"), (F.col("o_custkey") % 7).cast("string")).alias("preset_route"), (F.col("o_orderkey") % 3600).cast("string").alias("duration"), "selected_path_steps", F.lit("u").alias("url"))
    return rows.select(F.to_json(body).alias("value"), F.timestamp_seconds(F.col("o_orderkey")).alias("timestamp"))


_SEGMENTS = f"""with {_ROUTE_SQL}, q as (
select o_orderkey, preset_route, total_duration, f1 as status, array_to_string(list_transform(range(0, g + 1), lambda i: i || ',' || ln), ';') as polyline from s
union all select o_orderkey, preset_route, total_duration, f2, array_to_string(list_transform(range(g, least(g + 2, 5)), lambda i: i || ',' || ln), ';') from s)
select o_orderkey as epoch, preset_route, total_duration, status, polyline from q"""


def _plain(df: DataFrame) -> DataFrame:
    return df.select(F.unix_timestamp("timestamp").alias("epoch"), *streams.COLUMNS[1:])


def _stream(spark: SparkSession, rows: DataFrame | list[DataFrame], job, name: str) -> DataFrame:
    """Land rows as files, run a job over them as a stream until they are read, and read its table.

    Of several DataFrames each is landed when the stream has read the one before; every run goes on from the checkpoint.
    """
    source, sink = files.work_path(spark, f"{name}-source"), files.work_path(spark, f"{name}-sink")
    for part in rows if isinstance(rows, list) else [rows]:
        part.write.mode("append").parquet(source)
        out = job(files.read_messages(spark, source, "parquet"))
        files.stream_to_table(out, f"{sink}/t", f"{sink}/c").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{sink}/t")


@query("select count(*) as n, count(distinct o_orderkey) as n_keys, min(o_orderkey) as low, max(o_orderkey) as high from orders where o_orderkey in (select l_orderkey from lineitem)")
def land_raw(spark, d):
    raw = _stream(spark, messages_b(spark, d), lambda s: s, "raw")
    return raw.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("timestamp").alias("n_keys"), F.min(F.unix_timestamp("timestamp")).alias("low"), F.max(F.unix_timestamp("timestamp")).alias("high"))


@query(_SEGMENTS)
def route_stream_b(spark, d):
    return _plain(_stream(spark, messages_b(spark, d), streams.route_stream_b, "routes-b"))


@query("select o_orderkey as epoch, 'r' || (o_custkey % 7) as preset_route, (o_orderkey % 3600)::varchar as duration from orders where o_orderkey in (select l_orderkey from lineitem)")
def read_messages(spark, d):
    """Messages landed as files, read as a stream from the first on and parsed without a schema of the steps."""
    raw = _stream(spark, messages_b(spark, d), lambda s: s, "messages")
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return raw.select(F.unix_timestamp("timestamp").alias("epoch"), field("preset_route"), field("duration"))


@query(f"select preset_route, status, count(*) as n, count(distinct epoch) as messages, count(distinct polyline) as lines from ({_SEGMENTS}) group by preset_route, status")
def stream_to_table(spark, d):
    """Clean rows appended to a table by a stream with a checkpoint, counted per route and status."""
    rows = _stream(spark, messages_b(spark, d), streams.route_stream_b, "table-b")
    return rows.groupBy("preset_route", "status").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("timestamp").alias("messages"), F.count_distinct("polyline").alias("lines"))


def messages_a(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.lit("0,"), F.col("l_linenumber").cast("string"), F.lit(";1,"), F.col("l_suppkey").cast("string"))
    step = F.struct(F.lit("1").alias("duration"), F.array(F.struct(F.col("l_returnflag").alias("status"), line.alias("polyline"))).alias("tmcs"))
    rows = _with_lines(spark, d, step)
    body = F.struct(F.concat(F.lit("r"), (F.col("o_custkey") % 7).cast("string")).alias("preset_route"), (F.col("o_orderkey") % 3600).cast("string").alias("duration"), "selected_path_steps", F.lit("u").alias("url"))
    return rows.select(F.to_json(body).alias("value"), F.timestamp_seconds(F.col("o_orderkey")).alias("timestamp"))


@query("select o_orderkey as epoch, 'r' || (o_custkey % 7) as preset_route, (o_orderkey % 3600)::varchar as total_duration, l_returnflag as status, '0,' || l_linenumber || ';1,' || l_suppkey as polyline from orders join lineitem on l_orderkey = o_orderkey")
def route_stream_a(spark, d):
    return _plain(_stream(spark, messages_a(spark, d), streams.route_stream_a, "routes-a"))


@query("select distinct o_orderkey as epoch, 'r' || (o_custkey % 7) as preset_route, (o_orderkey % 3600)::varchar as total_duration from orders join lineitem on l_orderkey = o_orderkey")
def durations(spark, d):
    """As a stream with a watermark over two landings, the later half of the messages after the earlier one.

    Times are moved by a day, as the first second of 1970 would be no later than a stream's first watermark.
    """
    middle = t(spark, d, "orders").agg((F.min("o_orderkey") + F.max("o_orderkey")) / 2).first()[0] or 0
    early, lines = F.col("o_orderkey") <= middle, F.col("l_orderkey") <= middle
    rows = [messages_b(spark, d, *half).withColumn("timestamp", F.timestamp_seconds(F.unix_timestamp("timestamp") + 86400)) for half in ((early, lines), (~early, ~lines))]
    out = _stream(spark, rows, streams.message_durations, "durations")
    return out.select((F.unix_timestamp("timestamp") - 86400).alias("epoch"), "preset_route", "total_duration")


@query("select user_id as center, max(event_id % 500) as n from events group by user_id")
def seen_max_stream(spark, d):
    """Three rounds of records land one after the other; maxima are kept across the stream's runs."""
    source, sink = files.work_path(spark, "seen-source"), files.work_path(spark, "seen")
    e = t(spark, d, "events").select(F.col("user_id").alias("center"), (F.col("event_id") % 500).alias("n"), (F.col("event_id") % 3).alias("k"))
    for k in range(3):
        e.filter(F.col("k") == k).select("center", "n").write.mode("append").parquet(source)
        rows = spark.readStream.schema("center bigint, n bigint").parquet(source)
        streams.seen_max_stream(rows, f"{sink}/t", f"{sink}/c").awaitTermination()
    return streams.seen_max(spark, f"{sink}/t", "center bigint, n bigint")


@query("select cast(epoch(time_bucket(interval '5 minutes', ts)) as bigint) as start, count(*) as answered, 3 as expected, greatest(3 - count(*), 0) as missing from events group by 1")
def poll_rounds(spark, d):
    return streams.poll_rounds(t(spark, d, "events"), ts="ts", expected=3).select(F.unix_timestamp("start").alias("start"), "answered", "expected", "missing")


@query("with r as (select time_bucket(interval '5 minutes', ts) as start, count(*) as answered from events group by 1) select cast(epoch(start) as bigint) as start, answered from r where start + interval '15 minutes' <= (select max(ts) from events)")
def poll_rounds_stream(spark, d):
    """Poll rounds of a stream over two landings: those whose end the watermark of ten minutes has passed."""
    e = t(spark, d, "events").select(F.to_json(F.struct("event_id")).alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))
    middle = t(spark, d, "events").agg(((F.min(F.unix_timestamp("ts")) + F.max(F.unix_timestamp("ts"))) / 2).cast("bigint")).first()[0] or 0
    early = F.unix_timestamp("timestamp") <= middle
    out = _stream(spark, [e.filter(early), e.filter(~early)], streams.poll_rounds, "rounds")
    return out.select(F.unix_timestamp("start").alias("start"), "answered")


@query("select c_custkey, c_name, c_nationkey from customer")
def export_single(spark, d):
    path = files.work_path(spark, "export")
    files.export_single(t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), path)
    return files.read_json_lines(spark, path, "c_custkey bigint, c_name string, c_nationkey int")


@query("select event_id, event_type, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def read_json_lines(spark, d):
    path = files.work_path(spark, "lines")
    t(spark, d, "events").select("event_id", "event_type", "props").write.json(path)
    rows = files.read_json_lines(spark, path, "event_id bigint, event_type string, props string")
    return rows.select("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("select s_suppkey::varchar as code, n_name as city, (1700000000 + s_suppkey)::varchar as epoch, case when s_suppkey % 7 <> 0 then s_nationkey end as area, case when s_suppkey % 7 <> 0 then s_name end as name from supplier join nation on n_nationkey = s_nationkey")
def read_response_dir(spark, d):
    """A response file per supplier, named city___code___epoch; every seventh holds broken JSON."""
    path, k = files.work_path(spark, "responses"), F.col("s_suppkey")
    rows = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    name = F.concat_ws("___", "n_name", k.cast("string"), F.concat((k + 1700000000).cast("string"), F.lit(".json")))
    body = F.when(k % 7 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("s_nationkey").alias("area"), F.col("s_name").alias("name"))))
    files.write_responses(rows.select(name.alias("file"), body.alias("body")), path, "file", "body")
    return files.read_response_dir(spark, path, ["city", "code", "epoch"], "area int, name string")


@query(f"with {GRID} select {m('x')} as x, {m('y')} as y, ok0, max as most from grid")
def read_grid_csv(spark, d):
    path = files.work_path(spark, "grid")
    g = grid(spark, d)
    g.select(F.lit(1).alias("OBJECTID"), "x", "y", "ok0", "max", "max_timestamp").write.option("header", True).csv(path)
    return files.read_grid_csv(spark, path).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", F.col("max").alias("most"))


@query("select o_custkey::double as x, o_orderkey::double as y from orders where o_orderkey % 10 <> 0")
def read_point_list(spark, d):
    part = F.when(F.col("o_orderkey") % 10 == 0, F.lit("1,2,3")).otherwise(F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")))
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(F.concat_ws(";", F.collect_list(part)).alias("line"))
    return files.read_point_list(rows, "line")


@query("select p_brand as level1, unnest(string_split(p_name, ' ')) as level2 from part")
def read_categories(spark, d):
    return files.read_categories(t(spark, d, "part").select(F.concat("p_brand", F.lit(":"), F.replace("p_name", F.lit(" "), F.lit("、"))).alias("line")), "line")


@query("select s_suppkey, s_name, dt, kind from supplier, (values ('2024-01-01'), ('2024-01-02')) a(dt), (values ('json'), ('csv')) b(kind)")
def write_daily(spark, d):
    path, rows = files.work_path(spark, "daily"), t(spark, d, "supplier").select("s_suppkey", "s_name")
    for day in ("2024-01-01", "2024-01-02"):
        files.write_daily(rows, path, day)
    read = spark.read.schema("s_suppkey bigint, s_name string, dt string")
    return read.json(f"{path}/json").withColumn("kind", F.lit("json")).unionByName(read.option("header", True).csv(f"{path}/csv").withColumn("kind", F.lit("csv")))


@query("select event_id, user_id, event_type, floor(epoch(ts))::bigint as epoch from events")
def publish_messages(spark, d):
    """Events published with their own time in JSON, and read back as a stream of the topic's folder."""
    path = files.work_path(spark, "topics")
    files.publish_messages(t(spark, d, "events").select("event_id", "user_id", "event_type", "ts"), "events", "ts", "parquet", path)
    back, sink = files.read_messages(spark, f"{path}/topic=events", "parquet"), files.work_path(spark, "published")
    files.land_raw(back, f"{sink}/t", f"{sink}/c").awaitTermination()
    raw = spark.read.schema(files.MESSAGE).parquet(f"{sink}/t")
    return raw.select(F.from_json("value", "event_id bigint, user_id bigint, event_type string").alias("v"), F.unix_timestamp("timestamp").alias("epoch")).select("v.*", "epoch")


@query("select c_custkey as k, 'a' || c_custkey as community, c_mktsegment as district, null::varchar as missing from customer where c_custkey % 5 <> 0")
def cells_to_table(spark, d):
    k = F.col("c_custkey")
    first = F.when(k % 5 == 0, "合计").otherwise(F.concat(F.lit("a"), k.cast("string")))
    rows = t(spark, d, "customer").select(k.alias("k"), F.array(first, "c_mktsegment").alias("cells"))
    return shape.drop_total_rows(records.cells_to_table(rows, "cells", ("community", "district", "missing")), ["community"])


# -- projections and filters ---------------------------------------------------------------------


@query(f"with {_ROUTE_SQL} select o_orderkey as epoch, preset_route, total_duration, count(*) as n_steps from s group by all")
def flatten_message(spark, d):
    rows = shape.flatten_message(messages_b(spark, d), shape.ROUTE_B)
    return rows.select(F.unix_timestamp("timestamp").alias("epoch"), "preset_route", "total_duration", F.size("selected_path_steps").cast("bigint").alias("n_steps"))


@query('select p_partkey as "编号", p_name as "名称", p_size from part')
def rename_columns(spark, d):
    return shape.rename_columns(t(spark, d, "part").select("p_partkey", "p_name", "p_size"), {"p_partkey": "编号", "p_name": "名称", "absent": "x"})


@query("select c_name, c_acctbal, c_custkey from customer where c_custkey % 4 <> 0")
def flatten_content(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.struct("c_name", "c_acctbal")).alias("content"))
    return shape.flatten_content(rows)


@query("select o_custkey as k, case when count(*) = 1 then min(o_orderkey::varchar) else '[' || string_agg('\"' || o_orderkey || '\"', ',' order by o_orderkey) || ']' end as ids from orders group by 1")
def unwrap_singletons(spark, d):
    rows = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("ids"))
    return shape.unwrap_singletons(rows.withColumn("secret", F.lit(1)), ["secret"])


@query("select s_suppkey, 'urbanlake' as project, '20240101_000000' as date from supplier")
def stamp_rows(spark, d):
    return shape.stamp_rows(t(spark, d, "supplier").select("s_suppkey"), project="urbanlake", date="20240101_000000")


@query(f"with {PTS} select id from pts where lng > 113.1 and lat > 22.6 and lng < 113.9 and lat < 23.4")
def bbox_filter(spark, d):
    return shape.bbox_filter(points(spark, d), "lng", "lat", HEAT_BOX).select("id")


@query(f"with {PTS} select id from pts where lng between 113.1 and 113.9 and lat between 22.6 and 23.4")
def rect_filter(spark, d):
    return shape.rect_filter(points(spark, d), "lng", "lat", HEAT_BOX).select("id")


@query("select event_id from events where event_id % 3 = 1 and event_id % 2 = 0 and length(props) > 0")
def valid_responses(spark, d):
    e = t(spark, d, "events").select("event_id", (F.col("event_id") % 3).alias("status"), (10000 + F.col("event_id") % 2).alias("infocode"), F.col("props").alias("body"))
    return shape.valid_responses(e, "traffic").select("event_id")


@query("select len(string_split(p_name, ' ')) = 2 as good, count(*) as n from part group by 1")
def reject_malformed(spark, d):
    good, bad = shape.reject_malformed(t(spark, d, "part"), "p_name", " ", 2)
    return good.select(F.lit(True).alias("good")).unionAll(bad.select(F.lit(False))).groupBy("good").agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey from part where p_size % 5 not in (0, 1)")
def drop_total_rows(spark, d):
    size = F.col("p_size") % 5
    rows = t(spark, d, "part").select("p_partkey", F.when(size == 0, "合计").when(size == 1, "").otherwise("x").alias("a"))
    return shape.drop_total_rows(rows, ["a"]).select("p_partkey")


@query("select event_id, event_type as name, '' as city, 'k' || coalesce(json_extract_string(props, '$.k'), '') as tag, event_id::double / 2 as lat from events")
def normalize_poi(spark, d):
    body = F.to_json(F.struct(F.col("event_type").alias("name"), F.struct((F.col("event_id") / 2).alias("lat")).alias("location"), F.struct(F.concat(F.lit("k"), F.coalesce(F.get_json_object("props", "$.k"), F.lit(""))).alias("tag")).alias("detail_info")))
    return shape.normalize_poi(t(spark, d, "events").select("event_id", body.alias("body")), "body").select("event_id", "name", "city", "tag", "lat")


_ROUTES = "with r as (select l_orderkey, arg_min(l_linenumber, l_linenumber) filter (l_returnflag = 'R') as tagged, min(l_linenumber) as first, count(*) as n from lineitem group by 1)"


def _routes(spark, d):
    one = F.struct("l_linenumber", F.col("l_returnflag").alias("strategy"))
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("routes"))


@query(f"{_ROUTES} select l_orderkey, coalesce(tagged, first) as tagged, case when n > 1 then first else coalesce(tagged, first) end as plain from r")
def pick_route(spark, d):
    r = F.col("routes")
    return _routes(spark, d).select("l_orderkey", shape.pick_route(r, "R")["l_linenumber"].alias("tagged"), shape.pick_route(r, "R", False)["l_linenumber"].alias("plain"))


@query("select o_orderkey as epoch, l_returnflag as status from orders join lineitem on l_orderkey = o_orderkey")
def explode_steps(spark, d):
    rows = shape.explode_steps(shape.flatten_message(messages_a(spark, d), shape.ROUTE_A), "tmcs")
    return rows.select(F.unix_timestamp("timestamp").alias("epoch"), "segment.status")


@query(_SEGMENTS)
def cut_polyline(spark, d):
    return _plain(streams.route_stream_b(messages_b(spark, d)))


def heat_responses(spark, d):
    e = t(spark, d, "events")
    cell = F.struct(F.col("value").alias("count"), (452000 + F.col("event_id") % 4000).alias("grid_x"), (90000 + F.col("event_id") % 3000).alias("grid_y"))
    return e.groupBy("user_id").agg(F.collect_list(cell).alias("data")).withColumn("max_data", F.when(F.col("user_id") % 2 == 0, F.lit(80.0)))


_H = "h as (select user_id, value / ((case when user_id % 2 = 0 then 80.0::double else 40.0::double end) / 40) as c, (250 * (452000 + event_id % 4000) + 125) * 1e-6 as lng, (250 * (90000 + event_id % 3000) + 125) * 1e-6 as lat from events)"


@query(f"with {_H} select user_id, cast(floor(c * 100 + 0.5) as bigint) as c, {m(BD_LNG)} as lng, {m(BD_LAT)} as lat from h")
def heat_points(spark, d):
    return shape.heat_points(heat_responses(spark, d)).select("user_id", F.floor(F.col("count") * 100 + 0.5).alias("c"), micro(F.col("lng")).alias("lng"), micro(F.col("lat")).alias("lat"))


@query("select c_custkey, 'city=' || c_mktsegment || ',name=' || c_name || ',response_time=20240101_120000' as kept from customer")
def drop_keys(spark, d):
    """Snapshots with the five bulky keys, an old time and two others."""
    bulky = [F.lit(k) for name in shape.SNAPSHOT_KEYS for k in (name, "much")]
    mp = F.create_map(*bulky, F.lit("city"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"), F.lit("response_time"), F.lit("old"))
    entries = F.array_sort(F.map_entries(shape.drop_keys(mp, response_time="20240101_120000")))
    return t(spark, d, "customer").select("c_custkey", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("kept"))


@query("select event_id from events where event_type = (select min(event_type) from events) and date_trunc('hour', ts) between (select date_trunc('hour', min(ts)) + interval 24 hours from events) and (select date_trunc('hour', min(ts)) + interval 240 hours from events)")
def time_range(spark, d):
    e = t(spark, d, "events")
    low = e.agg(F.min("event_type").alias("k"), F.date_format(F.min("ts") + F.expr("interval 24 hours"), "yyyy-MM-dd HH:00:00").alias("a"), F.date_format(F.min("ts") + F.expr("interval 240 hours"), "yyyy-MM-dd HH:00:00").alias("b")).first()
    return shape.time_range(e, low["k"], low["a"], low["b"], name="event_type").select("event_id")


@query("select p_partkey from part where p_size % 3 <> 0 and p_size % 2 = 0")
def drop_blank_rows(spark, d):
    s = F.col("p_size")
    cells = F.when(s % 2 == 0, F.array_repeat(F.when(s % 3 == 0, F.lit(" ")).otherwise(F.col("p_name")), 7)).otherwise(F.array_repeat(F.col("p_name"), 6))
    return shape.drop_blank_rows(t(spark, d, "part").select("p_partkey", cells.alias("cells")), "cells")[0].select("p_partkey")


# -- joins ---------------------------------------------------------------------------------------


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 16 = 0)")
def missed_ids(spark, d):
    return joins.missed_ids(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders").filter("o_orderkey % 16 = 0").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query(f"with {CEN}, {CHK} select k from cen where printf('%.6f___%.5f', x, y) not in (select printf('%.6f___%.5f', x, y) from chk)")
def remaining_work(spark, d):
    key = text.coordinate_key(F.col("x"), F.col("y")).alias("key")
    return joins.remaining_work(centers(spark, d).select("k", key), checks(spark, d).select(key), ["key"]).select("k")


@query(f"with {CEN}, a as (select x, y from cen where nation < 5) select {m('x')} as x, {m('y')} as y, 0 as ok0, 14000::bigint as max_timestamp from cen where not exists (select 1 from a where a.x = cen.x and a.y = cen.y)")
def subtract_areas(spark, d):
    c = centers(spark, d)
    return joins.subtract_areas(c, c.filter("nation < 5")).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", "max_timestamp")


@query("select c_custkey, coalesce(n_name, '') as n_name from customer left join (select * from nation where n_regionkey < 4) on n_nationkey = c_nationkey")
def lookup_names(spark, d):
    names = t(spark, d, "nation").filter("n_regionkey < 4").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.lookup_names(t(spark, d, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey", "n_name").select("c_custkey", "n_name")


@query("select s_suppkey, s_name, n_name from supplier join nation on n_nationkey = s_nationkey")
def combine_by_id(spark, d):
    a, b = t(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("k")), t(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    return joins.combine_by_id(a, b, "k").drop("k")


_DX, _DY = 0.5 * geo.LNG_KM * 2, 0.5 * geo.LAT_KM * 2


@query(f"with {CEN}, w as (select nation as city, r_name as category, printf('%.3f,%.3f,%.3f,%.3f', y - {_DY!r}, x - {_DX!r}, y + {_DY!r}, x + {_DX!r}) as bounds from cen cross join region where nation < 20), dn as (select nation as city, 'ASIA' as category, printf('%.3f,%.3f,%.3f,%.3f', y - {_DY!r}, x - {_DX!r}, y + {_DY!r}, x + {_DX!r}) as bounds from cen where k % 2 = 0) select city, category, bounds from w where not exists (select 1 from dn where dn.city = w.city and dn.category = w.category and dn.bounds = w.bounds)")
def plan_requests(spark, d):
    c = centers(spark, d).withColumn("city", F.col("nation"))
    cities = t(spark, d, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("city"))
    done = c.filter("k % 2 = 0").select("city", F.lit("ASIA").alias("category"), geo.rounded_bounds(F.col("x"), F.col("y"), 2.0).alias("bounds"))
    return joins.plan_requests(cities, t(spark, d, "region").select(F.col("r_name").alias("category")), c.select("city", "x", "y"), done).select("city", "category", "bounds")


@query("""with g as (select s_nationkey as city, s_name as address, max(s_suppkey) as lng from supplier group by all),
q as (select o_orderkey, (o_custkey % 25)::int as city, case when o_orderkey % 3 = 0 then '' else 'Supplier#' || lpad((o_orderkey % 1500)::varchar, 9, '0') end as a, 'Supplier#' || lpad((o_custkey % 1500)::varchar, 9, '0') as b from orders)
select o_orderkey, coalesce(x.lng, y.lng) as lng from q left join g x on x.city = q.city and x.address = nullif(trim(a), '') left join g y on y.city = q.city and y.address = nullif(trim(b), '')""")
def geocode_join(spark, d):
    g = t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("city"), F.col("s_name").alias("address")).agg(F.max("s_suppkey").alias("lng")).withColumns({"lat": F.col("lng"), "adcode": F.lit("1")})
    name = lambda c: F.concat(F.lit("Supplier#"), F.lpad((F.col(c) % 1500).cast("string"), 9, "0"))
    q = t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 25).cast("int").alias("city"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(name("o_orderkey")).alias("a"), name("o_custkey").alias("b"))
    return joins.geocode_join(q.withColumnRenamed("city", "home"), g, "home", ["a", "b"]).select("o_orderkey", "lng")


@query(f"with {GRID}, {CHK} select {m('x')} as x, {m('y')} as y, case when bn > max then (bn >= 30)::int else ok0 end as ok0, case when bn > max then bn else max end as most, case when bn > max then bt else max_timestamp end as max_timestamp from grid left join best using (x, y)")
def upsert_grid_max(spark, d):
    return joins.upsert_grid_max(grid(spark, d), checks(spark, d)).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", F.col("max").alias("most"), "max_timestamp")


@query(f"with {GRID}, {CHK} select {m('x')} as x, {m('y')} as y from grid join best using (x, y) where bn = 0 or floor(y * 1000 + 0.5)::bigint % 4 = 0")
def zero_returns(spark, d):
    none = F.floor(F.col("y") * 1000 + 0.5) % 4 == 0
    return joins.zero_returns(grid(spark, d), checks(spark, d).withColumn("n", F.when(none, 0).otherwise(F.col("n")))).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"))


@query(f"with {GRID}, {CHK} select {m('x')} as x, {m('y')} as y, case when ok0 = 0 and bn > 30 then 1 else ok0 end as ok0, coalesce(bn, max) as most, coalesce(bt, max_timestamp) as max_timestamp from grid left join best using (x, y)")
def update_centers(spark, d):
    seen = aggs.max_per_center(checks(spark, d), ["x", "y"], "n", "ts")
    return joins.update_centers(grid(spark, d), seen).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", F.col("max").alias("most"), "max_timestamp")


@query("with a as (select c_custkey as key, case when c_custkey % 3 = 0 then '' else c_name end as value from customer where c_custkey % 7 <> 0), b as (select c_custkey as key, c_mktsegment as value from customer where c_custkey % 5 <> 0) select coalesce(a.key, b.key) as key, coalesce(nullif(a.value, ''), nullif(b.value, '')) as value from a full join b on a.key = b.key")
def backfill_mapping(spark, d):
    c = t(spark, d, "customer").withColumnRenamed("c_custkey", "key")
    new = c.filter("key % 7 <> 0").select("key", F.when(F.col("key") % 3 == 0, "").otherwise(F.col("c_name")).alias("value"))
    return joins.backfill_mapping(new, c.filter("key % 5 <> 0").select("key", F.col("c_mktsegment").alias("value")))


@query("with e as (select *, floor(epoch(ts))::bigint as s from events), r as (select distinct s // 300 * 300 as start from e), k as (select distinct event_type as key from events) select start, key from r cross join k where not exists (select 1 from e where e.event_type = k.key and s // 300 * 300 = r.start and s - r.start <= 240)")
def late_responses(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("key"), F.date_trunc("second", "ts").alias("ts"))
    start = F.timestamp_seconds((F.floor(F.unix_timestamp("ts") / 300) * 300).cast("bigint"))
    return joins.late_responses(e.select(start.alias("start")).distinct(), e, e).select(F.unix_timestamp("start").alias("start"), "key")


#: Corners of a polygon with a reflex corner, from the place of its nation.
CORNERS = ((0.0, 0.0), (0.18, 0.0), (0.18, 0.18), (0.09, 0.054), (0.0, 0.18))
_EDGES = ", ".join(f"({a!r}::double, {b!r}::double, {c!r}::double, {e!r}::double)" for (a, b), (c, e) in zip(CORNERS, (*CORNERS[1:], CORNERS[0]), strict=True))
EDGE = f"edge as (select n_nationkey as pid, ox + a as px, oy + b as py, ox + c as qx, oy + e as qy from (select n_nationkey, 113::double + (n_nationkey * 7 % 25) * 0.035::double as ox, 22.5::double + (n_nationkey * 11 % 25) * 0.033::double as oy from nation), (values {_EDGES}) v(a, b, c, e))"
INSIDE = """bool_or(abs((qx - px) * (lat - py) - (lng - px) * (qy - py)) <= 2e-10 and lng between least(px, qx) - 2e-10 and greatest(px, qx) + 2e-10 and lat between least(py, qy) - 2e-10 and greatest(py, qy) + 2e-10)
or count(*) filter ((py > lat) <> (qy > lat) and lng < px + (lat - py) * (qx - px) / (qy - py)) % 2 = 1"""


def polygons(spark: SparkSession, d: str) -> DataFrame:
    """A polygon with a reflex corner per nation; neighbours overlap."""
    k = F.col("n_nationkey")
    x, y = F.lit(113.0) + (k * 7 % 25) * F.lit(0.035), F.lit(22.5) + (k * 11 % 25) * F.lit(0.033)
    return t(spark, d, "nation").select(k.cast("bigint").alias("polygon_id"), F.array(*(F.struct((x + a).alias("lng"), (y + b).alias("lat")) for a, b in CORNERS)).alias("polygon"))


@query(f"with {PTS}, {EDGE}, held as (select id, pid from pts cross join edge group by id, pid having {INSIDE}) select id, min(pid)::bigint as polygon_id from held group by id")
def points_in_polygons(spark, d):
    return grids.points_in_polygons(points(spark, d).select("id", "lng", "lat"), polygons(spark, d)).select("id", "polygon_id")


@query(f"""with {PTS}, {EDGE}, q as (select {m('lng')} as x, {m('lat')} as y, cast(round(cnt * 100) as bigint) as c from pts),
a as (select c, y, unnest(case when x % 10000 = 0 then [x // 10000 - 1, x // 10000] else [x // 10000] end) as i from q),
b as (select c, i, unnest(case when y % 10000 = 0 then [y // 10000 - 1, y // 10000] else [y // 10000] end) as j from a),
s as (select i, j, sum(c)::bigint as total from b group by i, j),
corner as (select distinct i + p as ci, j + q as cj, (i + p) * 10000 / 1000000::double as lng, (j + q) * 10000 / 1000000::double as lat from s, range(2) u(p), range(2) w(q)),
held as (select distinct ci, cj from (select ci, cj, pid from corner cross join edge group by ci, cj, pid, lng, lat having {INSIDE}))
select i, j, total, (total > 20000)::int + (total > 60000)::int as level from s where exists (select 1 from held where ci between i and i + 1 and cj between j and j + 1)""")
def count_in_cells(spark, d):
    p = points(spark, d).select(micro(F.col("lng")).alias("x"), micro(F.col("lat")).alias("y"), F.round(F.col("count") * 100).cast("bigint").alias("count"))
    return grids.count_in_cells(p, (10000, 10000), (20000, 60000), polygons(spark, d)).select("i", "j", "total", "level")


# -- aggregates ----------------------------------------------------------------------------------


@query(f"with {CEN} select {m('min(round(x, 6)) - 0.01167 * 2')} as a, {m('max(round(x, 6)) + 0.01167 * 2')} as b, {m('min(round(y, 5)) - 0.009009009 * 2')} as c, {m('max(round(y, 5)) + 0.009009009 * 2')} as d from cen")
def grid_extent(spark, d):
    e = aggs.grid_extent(centers(spark, d), edge=2.0)
    return e.select(*(micro(F.col(c)).alias(n) for c, n in zip(("lng_min", "lng_max", "lat_min", "lat_max"), "abcd", strict=True)))


@query(f"with {PTS} select {m('min(lng)')} as a, {m('max(lng)')} as b, {m('min(lat)')} as c, {m('max(lat)')} as d from pts")
def extent_of_polygons(spark, d):
    g = points(spark, d).groupBy("user_id").agg(F.collect_list(F.struct("lng", "lat")).alias("polygon"))
    e = aggs.extent_of_polygons(g)
    return e.select(*(micro(F.col(c)).alias(n) for c, n in zip(("lng_min", "lng_max", "lat_min", "lat_max"), "abcd", strict=True)))


def tile_names(spark, d):
    x, y = F.col("p_partkey") % 41 - 7, F.col("p_partkey") % 23 - 5
    mark = lambda c: F.when(c < 0, F.concat(F.lit("m"), F.abs(c).cast("string"))).otherwise(c.cast("string"))
    return t(spark, d, "part").select(F.concat(mark(x), F.lit("_"), mark(y), F.lit("_16.png")).alias("name"))


@query("select min(p_partkey % 41 - 7)::int as x_min, max(p_partkey % 41 - 7)::int as x_max, min(p_partkey % 23 - 5)::int as y_min, max(p_partkey % 23 - 5)::int as y_max from part")
def tile_extent(spark, d):
    return aggs.tile_extent(tile_names(spark, d), "name")


@query("select cast(ts as date)::varchar as file, count(*) as n_rows, count(distinct user_id) as n_ids from events group by 1 union all select null, count(*), count(distinct user_id) from events")
def unique_counts(spark, d):
    return aggs.unique_counts(t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("file"), "user_id"), "file", "user_id").select("file", "n_rows", "n_ids")


@query("select label, count(*) as n from (select unnest(list_filter([case when contains(url, '/en/') then 'english' end, case when contains(url, 'blog.') then 'blog' end, case when contains(url, '?') then 'query' end], lambda x: x is not null)) as label from pages) group by 1")
def log_type_counts(spark, d):
    return aggs.log_type_counts(t(spark, d, "pages"), "url", {"english": "/en/", "blog": "blog.", "query": "?"})


@query("select o_custkey as list, count(*) filter (o_orderkey % 4 <> 0) as pages from orders group by 1 having count(*) filter (o_orderkey % 4 = 0) > 0")
def pages_per_list(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("list"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey")).alias("page"))
    return aggs.pages_per_list(o, "list", "page")[0]


@query("with a as (select o_custkey as k, count(*) as r from orders where o_orderkey % 3 <> 0 group by 1), b as (select o_custkey as k, count(*) as n from orders where o_orderkey % 5 <> 0 group by 1) select coalesce(a.k, b.k) as k, coalesce(r, 0) - coalesce(n, 0) as unanswered, r is null as unknown, n is null as silent from a full join b on a.k = b.k")
def unanswered_pages(spark, d):
    o = t(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    return aggs.unanswered_pages(o.filter("o_orderkey % 3 <> 0"), o.filter("o_orderkey % 5 <> 0"), "k")


@query(f"with {CHK} select {m('x')} as x, {m('y')} as y, bn as most, bt as max_timestamp from best")
def max_per_center(spark, d):
    out = aggs.max_per_center(checks(spark, d), ["x", "y"], "n", "ts")
    return out.select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), F.col("max").alias("most"), "max_timestamp")


@query('select (select count(*) from customer) as wanted, (select count(distinct o_custkey) from orders) as done, (select count(*) from customer) - (select count(distinct o_custkey) from orders) as "left"')
def progress(spark, d):
    return aggs.progress(t(spark, d, "customer"), t(spark, d, "orders").select("o_custkey").distinct())


@query("select count(*) filter (p_size % 4 = 0 or p_size % 4 = 1) as gaps, count(*) as total from part")
def mapping_gaps(spark, d):
    s = F.col("p_size") % 4
    return aggs.mapping_gaps(t(spark, d, "part").select(F.when(s == 0, "").when(s == 1, None).otherwise("x").alias("v")), "v")


@query("select event_type, user_id, max(ts)::date::varchar as latest, date_diff('day', max(ts)::date, date '2024-02-01') > 7 as stale from events group by all")
def latest_snapshot(spark, d):
    e = t(spark, d, "events").withColumn("day", F.to_date("ts"))
    return aggs.latest_snapshot(e, ["event_type", "user_id"], "day", "2024-02-01", 7).withColumn("latest", F.col("latest").cast("string"))


@query("""with p as (select distinct (p_partkey % 41 - 7)::int as x, (p_partkey % 23 - 5)::int as y from part), e as (select min(x) as x0, min(y) as y0 from p),
n as (select *, case when x < 0 then 'm' || -x else x::varchar end || '_' || case when y < 0 then 'm' || -y else y::varchar end || '_16.png' as name from p, e)
select (x - x0) // 10 as bx, (y - y0) // 10 as by, string_agg(name || ':' || x - least(x0, 0) || ':' || y - least(y0, 0), ';' order by name) as tiles from n group by 1, 2""")
def tile_batches(spark, d):
    out = aggs.tile_batches(tile_names(spark, d), "name", 10)
    return out.select("bx", "by", F.array_join(F.transform("tiles", lambda x: F.concat_ws(":", x["name"], x["x"].cast("string"), x["y"].cast("string"))), ";").alias("tiles"))


@query("select o_custkey, max(o_orderkey % 500) as total from orders group by 1 having max(o_orderkey % 500) >= 400")
def over_limit(spark, d):
    return aggs.over_limit(t(spark, d, "orders").withColumn("n", F.col("o_orderkey") % 500), ["o_custkey"], "n", 400)


# -- windows, sets and sorts ---------------------------------------------------------------------


@query("select user_id, event_type, event_id from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as rn from events) where rn = 1")
def dedupe_keep_first(spark, d):
    return aggs.dedupe_keep_first(t(spark, d, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def dedupe_rows(spark, d):
    return aggs.dedupe_rows(t(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("with e as (select cast(ts as date)::varchar as file, user_id as link from events), f as (select link, min(file) as file from e group by 1), n as (select file, count(*) as n_new from f group by 1) select e.file, count(*) as n_links, coalesce(any_value(n_new), 0) as n_new, coalesce(any_value(n_new), 0) < 59 as few from e left join n using (file) group by 1")
def new_per_file(spark, d):
    return aggs.new_per_file(t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("file"), F.col("user_id").alias("link")), "file", "link")


@query('select l_orderkey, l_linenumber, coalesce(sum(cast(l_quantity as bigint)) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey rows between unbounded preceding and 1 preceding), 0)::bigint as "offset" from (select distinct on (l_orderkey, l_linenumber) * from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)')
def running_offset(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("n"))
    li = aggs.dedupe_keep_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "n"])
    return aggs.running_offset(li, ["l_orderkey"], "l_linenumber", "n").select("l_orderkey", "l_linenumber", "offset")


@query("select o_custkey, max(o_orderkey) as o_orderkey, arg_max(o_orderstatus, o_orderkey) as o_orderstatus from orders group by 1")
def last_by_key(spark, d):
    return aggs.last_by_key(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("select distinct (p_partkey % 41 - 7)::int as x, (p_partkey % 23 - 5)::int as y from part order by y desc, x")
def sort_tiles(spark, d):
    return aggs.sort_tiles(tile_names(spark, d).select(aggs.tile_numbers(F.col("name")).alias("t")).select("t.x", "t.y").distinct())


@query("select c_custkey from customer")
def shuffle_cells(spark, d):
    return aggs.shuffle_cells(t(spark, d, "customer").select("c_custkey"), "c_custkey", 7)


@query("select o_orderkey from orders order by o_totalprice desc, o_orderkey limit 20")
def first_n(spark, d):
    return aggs.first_n(t(spark, d, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderkey")


@query("select c_custkey as k, c_name as name, null::int as nation from customer union all select s_suppkey, s_name, s_nationkey from supplier")
def union_sources(spark, d):
    return aggs.union_sources(t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")))


@query("select l_partkey as k from lineitem where l_linenumber = 1 except select l_partkey from lineitem where l_linenumber = 2")
def set_difference(spark, d):
    li = t(spark, d, "lineitem")
    return aggs.set_difference(li.filter("l_linenumber = 1").select(F.col("l_partkey").alias("k")), li.filter("l_linenumber = 2").select("l_partkey"))


@query("select distinct p_brand, p_size from part")
def distinct_values(spark, d):
    return aggs.distinct_values(t(spark, d, "part"), ["p_brand", "p_size"])
