"""Registered queries on late answers, kept state and written tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import aggs, crawl_log, grids, joins, records, shape
from ..sources import files
from ..streaming import streams
from .queries import CEN, CHK, EDGE, GRID, INSIDE, PTS, centers, checks, grid, m, micro, points, polygons, query, t

# -- late answers --------------------------------------------------------------------------------


def rounds_and_answers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Requests (key, start): every event type in each 300-second round with an event; answers (key, ts): the events."""
    e = t(spark, d, "events").select(F.col("event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    start = F.timestamp_seconds((F.floor(F.unix_timestamp("ts") / 300) * 300).cast("bigint"))
    return joins.all_pairs(e.select(start.alias("start")).distinct(), e.select("key")), e


_ASKED = """e as (select event_type as key, ts, epoch_us(ts) as u from events),
q as (select start, key from (select distinct u // 300000000 * 300000000 as start from e) cross join (select distinct key from e))"""


@query(f"with {_ASKED} select start // 1000000 as start, key from q where not exists (select 1 from e where e.key = q.key and u between start and start + 400000000)")
def late_responses_long(spark, d):
    """Requests without an answer within 400 seconds, which is longer than the rounds of 300."""
    asked, answers = rounds_and_answers(spark, d)
    return joins.late_responses(asked.select("start").distinct(), answers, answers, 400).select(F.unix_timestamp("start").alias("start"), "key")


def _two_landings(spark: SparkSession, d: str, job, name: str) -> DataFrame:
    """Land the first half of requests and answers, run a job over both as streams until they are read, then the other half from the checkpoint."""
    asked, answers = rounds_and_answers(spark, d)
    path, out = files.work_path(spark, name), None
    ends = answers.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    middle = F.timestamp_seconds(F.lit(((ends[0] or 0) + (ends[1] or 0)) // 2))
    for early in (True, False):
        for rows, ts, at in ((asked, "start", "asked"), (answers, "ts", "answers")):
            rows.filter((F.col(ts) < middle) == F.lit(early)).select("key", ts).write.mode("append").parquet(f"{path}/{at}")
        both = (spark.readStream.schema(f"key string, {ts} timestamp").parquet(f"{path}/{at}") for ts, at in (("start", "asked"), ("ts", "answers")))
        out = job(*both)
        files.stream_to_table(out, f"{path}/t", f"{path}/c").awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/t")


#: Until when the watermark of ten minutes behind the slower of both streams has come.
_PAST = "(select least(max(start), (select max(u) from e)) - 600000000 from q)"


@query(f"with {_ASKED} select start // 1000000 as start, key from q where start + 240000000 < {_PAST} and not exists (select 1 from e where e.key = q.key and u between start and start + 240000000)")
def late_requests_stream(spark, d):
    """Requests without an answer in time, as two streams joined by key and time over two landings: those that the watermark has passed."""
    out = _two_landings(spark, d, streams.late_requests, "late")
    return out.select(F.unix_timestamp("start").alias("start"), "key")


@query(f"""with {_ASKED}, r as (select start, key, exists (select 1 from e where e.key = q.key and u between start and start + 240000000) as ok from q)
select start // 1000000 as start, count(*) as expected, count(*) filter (ok) as answered, count(*) filter (not ok) as missing from r group by start having start + 300000000 <= {_PAST} - 240000000""")
def round_answers_stream(spark, d):
    """Expected, answered and missing requests per round, of two streams over two landings: the rounds that the watermark has passed."""
    out = _two_landings(spark, d, streams.round_answers, "answers")
    return out.select(F.unix_timestamp("start").alias("start"), "expected", "answered", "missing")


# -- polygons of all sizes -----------------------------------------------------------------------

#: A triangle over the whole extent, with the largest id.
LARGE = ((112.9, 22.4), (114.4, 22.4), (112.9, 23.9))
_LARGE = ", ".join(f"(1000, {a!r}::double, {b!r}::double, {c!r}::double, {e!r}::double)" for (a, b), (c, e) in zip(LARGE, (*LARGE[1:], LARGE[0]), strict=True))


def _all_polygons(spark: SparkSession, d: str) -> DataFrame:
    large = F.array(*(F.struct(F.lit(a).alias("lng"), F.lit(b).alias("lat")) for a, b in LARGE))
    return polygons(spark, d).unionByName(spark.range(1000, 1001).select(F.col("id").alias("polygon_id"), large.alias("polygon")))


@query(f"with {PTS}, {EDGE}, every as (select * from edge union all values {_LARGE}), held as (select id, pid from pts cross join every group by id, pid having {INSIDE}) select id, min(pid)::bigint as polygon_id from held group by id")
def points_in_polygons_of_all_sizes(spark, d):
    """Small polygons that overlap, and one over the whole extent."""
    return grids.points_in_polygons(points(spark, d).select("id", "lng", "lat"), _all_polygons(spark, d)).select("id", "polygon_id")


# -- tables that are written and read again ------------------------------------------------------


@query("""with o as (select user_id, event_type, strftime(ts, '%Y-%m-%d') as day, event_id, row_number() over (partition by cast(ts as date) order by event_id) - 1 as line_no from events)
select user_id, event_type, min_by(event_id, (day, line_no)) as first_id, max_by(event_id, (day, line_no)) as last_id, min_by(line_no, (day, line_no)) as first_line from o group by user_id, event_type""")
def lines_in_file_order(spark, d):
    """Events as text files of a day each; of each user and type the first line and the last, in order of file and line."""
    path = files.work_path(spark, "days")
    line = F.concat_ws(",", "event_id", "user_id", "event_type")
    rows = t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", line.alias("value"))
    rows.repartition("day").sortWithinPartitions("day", "event_id").drop("event_id").write.partitionBy("day").text(path)
    cells = F.split("value", ",")
    lines = files.read_lines(spark, path).select("file", "line_no", cells[0].cast("bigint").alias("id"), cells[1].cast("bigint").alias("user_id"), cells[2].alias("event_type"))
    keys, order = ["user_id", "event_type"], ["file", "line_no"]
    first = aggs.dedupe_keep_first(lines, keys, order).select(*keys, F.col("id").alias("first_id"), F.col("line_no").alias("first_line"))
    return first.join(aggs.last_by_key(lines, keys, order).select(*keys, F.col("id").alias("last_id")), keys)


def dated_records(spark: SparkSession, d: str) -> DataFrame:
    """Events as records of cities, in folders by date and city."""
    path = files.work_path(spark, "records")
    e = t(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("city"))
    files.write_records(e, path)
    return files.read_records(spark, path, "event_id bigint, user_id bigint, ts timestamp")


@query("select event_id, user_id from events where event_type = 'view' and ts >= timestamp '2024-01-03 05:00:00' and ts < timestamp '2024-01-09 12:00:00'")
def time_range_of_folders(spark, d):
    """One city's records of six days, from a table in folders by date and city."""
    return shape.time_range(dated_records(spark, d), "view", "2024-01-03 05:00:00", "2024-01-09 11:00:00", date="date").select("event_id", "user_id")


@query("with r as (select min(event_type) as city, timestamp '2024-01-02 00:00:00' as a, timestamp '2024-01-04 06:00:00' as b from events union all select max(event_type), timestamp '2024-01-03 00:00:00', timestamp '2024-01-20 00:00:00' from events) select event_id from events where exists (select 1 from r where city = event_type and ts between a and b)")
def ranges_of_folders(spark, d):
    """Records in several ranges of city and time; only the folders that the ranges name are read."""
    ends = t(spark, d, "events").agg(F.min("event_type").alias("a"), F.max("event_type").alias("b"))
    at = lambda text: F.lit(text).cast("timestamp")
    ranges = ends.select(F.explode(F.array(F.struct(F.col("a").alias("city"), at("2024-01-02 00:00:00").alias("start"), at("2024-01-04 06:00:00").alias("end")), F.struct(F.col("b").alias("city"), at("2024-01-03 00:00:00").alias("start"), at("2024-01-20 00:00:00").alias("end")))).alias("r")).select("r.*")
    return shape.in_ranges(dated_records(spark, d), ranges).select("event_id")


@query(f"with {GRID}, {CHK} select {m('x')} as x, {m('y')} as y, case when bn > max then (bn >= 30)::int else ok0 end as ok0, case when bn > max then bn else max end as most, case when bn > max then bt else max_timestamp end as max_timestamp, true as again from grid left join best using (x, y)")
def grid_written_back(spark, d):
    """The grid as a table that a run of checks is merged into; the same run again replaces no folder."""
    path, seen = files.work_path(spark, "grid"), checks(spark, d)
    files.write_grid(grid(spark, d), path)
    files.update_grid(spark, path, seen, joins.upsert_grid_max)
    again = files.update_grid(spark, path, seen, joins.upsert_grid_max) == []
    return files.read_grid(spark, path).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", F.col("max").alias("most"), "max_timestamp", F.lit(again).alias("again"))


@query(f"with {GRID}, {CHK} select {m('x')} as x, {m('y')} as y, (bn >= 30)::int as ok0, bn as most, bt as max_timestamp from grid join best using (x, y)")
def checked_centers(spark, d):
    return joins.checked_centers(grid(spark, d), checks(spark, d)).select(micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"), "ok0", F.col("max").alias("most"), "max_timestamp")


@query("select cast(ts as date)::varchar as dt, event_type, count(*) as n, sum(event_id)::bigint as ids, kind from events, (values ('json'), ('csv')) k(kind) group by all")
def daily_stream(spark, d):
    """Events in two landings to daily JSON lines and CSV by a stream; its last batch is then written a second time."""
    source, path = files.work_path(spark, "daily-source"), files.work_path(spark, "daily-stream")
    e = t(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for k in (0, 1):
        e.filter(F.col("event_id") % 2 == k).write.mode("append").parquet(source)
        rows = spark.readStream.schema("event_id bigint, event_type string, ts timestamp").parquet(source)
        files.daily_stream(rows, path, f"{path}/checkpoint", "ts").awaitTermination()
    files.write_daily_batch(e.filter(F.col("event_id") % 2 == 1), 1, path, "ts")
    back = [files.read_daily(spark, path, "event_id bigint, event_type string, ts timestamp", fmt).withColumn("kind", F.lit(fmt)) for fmt in ("json", "csv")]
    return back[0].unionByName(back[1]).groupBy("dt", "event_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("""with w as (select c_custkey as id from customer), x as (select id, id not in (select o_custkey from orders where o_orderpriority = '1-URGENT') as missed from w)
select id, (select count(*) from x) as wanted, (select count(*) filter (not missed) from x) as done, (select count(*) filter (missed) from x) as missed from x where missed""")
def missed_and_counted(spark, d):
    """Customers without an urgent order, and how many are wanted, done and missed, from the one pass that tells them apart."""
    w, o = t(spark, d, "customer").select(F.col("c_custkey").alias("id")), t(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    missed, _, n = joins.missed_and_done(w, o, "id", files.work_path(spark, "missed"))
    return missed.withColumns({"wanted": F.lit(n["all"]).cast("bigint"), "done": F.lit(n["bad"]).cast("bigint"), "missed": F.lit(n["good"]).cast("bigint")})


@query("select p_partkey, case when p_size % 2 = 0 and p_size % 3 <> 0 then 'good' else 'bad' end as kind, (select count(*) filter (p_size % 2 = 0 and p_size % 3 <> 0) from part) as good, (select count(*) from part) as n from part")
def good_and_bad_rows(spark, d):
    """Parts as lists of six, seven blank or seven full cells: both sides of the test, written and counted in one pass."""
    s = F.col("p_size")
    cells = F.when(s % 2 == 0, F.array_repeat(F.when(s % 3 == 0, F.lit(" ")).otherwise(F.col("p_name")), 7)).otherwise(F.array_repeat(F.col("p_name"), 6))
    rows = t(spark, d, "part").select("p_partkey", cells.alias("cells"))
    full = (F.size("cells") == 7) & F.exists("cells", lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    good, bad, n = files.split_and_count(rows, full, files.work_path(spark, "rows"))
    both = good.withColumn("kind", F.lit("good")).unionByName(bad.withColumn("kind", F.lit("bad")))
    return both.select("p_partkey", "kind", F.lit(n["good"]).cast("bigint").alias("good"), F.lit(n["all"]).cast("bigint").alias("n"))


@query("select cast(ts as date)::varchar as file, count(*) as n_rows, true as close from events group by 1 union all select null, count(*), true from events")
def sketched_counts(spark, d):
    """Distinct users per day and over all days from united sketches; ``close``: within three percent of the exact numbers."""
    e = t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("file"), "user_id")
    path = files.work_path(spark, "sketches")
    aggs.id_sketches(e, "file", "user_id").write.parquet(path)
    near = aggs.sketched_counts(spark.read.schema("file string, n_rows bigint, sketch binary").parquet(path), "file")
    exact = aggs.unique_counts(e, "file", "user_id").select(F.col("file").alias("of"), F.col("n_ids").alias("exact"))
    joined = near.join(exact, F.col("file").eqNullSafe(F.col("of")))
    return joined.select("file", "n_rows", (F.abs(F.col("n_ids") - F.col("exact")) <= F.greatest(F.lit(1), 0.03 * F.col("exact"))).alias("close"))


@query("select l_orderkey, l_linenumber, l_partkey::varchar as x, l_suppkey::varchar as y, 2 as n from lineitem")
def parse_path(spark, d):
    """Paths of two points, taken apart by the SQL function in a text of SQL."""
    shape.register_functions(spark)
    path = F.concat_ws(";", F.concat_ws(",", F.lit("0"), "l_linenumber"), F.concat_ws(",", "l_partkey", "l_suppkey"))
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", path.alias("path"))
    return spark.sql("select l_orderkey, l_linenumber, parse_path(path)[1][0] as x, parse_path(path)[1][1] as y, size(parse_path(path)) as n from {rows}", rows=rows)


# -- a crawl's log, from its raw lines -----------------------------------------------------------

#: Texts of log lines and their kinds.
LABELS = {"INFO: list, requesting": crawl_log.FIRST, "INFO: detail, requesting": crawl_log.DETAIL, "ERROR": "errors"}
_HEAD = "https://lists.example/house-a"


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Log files of an order a line: list requests, further pages, details and pages without a number, some with an error; read back."""
    k, c = F.col("o_orderkey"), F.concat(F.lit(_HEAD), F.col("o_custkey").cast("string"))
    ask = F.when(k % 8 < 2, F.concat(F.lit("INFO: list, requesting "), c, F.lit("/")))
    ask = ask.when(k % 8 < 5, F.concat(F.lit("INFO: detail, requesting "), c, F.lit("/i3"), (k % 40).cast("string"))).when(k % 8 < 6, F.concat(F.lit("INFO: detail, requesting "), c, F.lit("/g299")))
    ask = ask.otherwise(F.concat(F.lit("INFO: detail, requesting "), c, F.lit("/"), k.cast("string"), F.lit(".htm")))
    line = F.concat(F.when(k % 7 == 0, "ERROR ").otherwise(""), F.col("o_orderdate").cast("string"), F.lit(" [log] "), ask)
    path = files.work_path(spark, "log")
    t(spark, d, "orders").select(line.alias("value")).write.text(path)
    return files.read_lines(spark, path)


_LOG = f"""ln as (select o_orderkey as k, o_custkey as c, (case when o_orderkey % 7 = 0 then 'ERROR ' else '' end) || o_orderdate::varchar || ' [log] ' || case
    when o_orderkey % 8 < 2 then 'INFO: list, requesting {_HEAD}' || o_custkey || '/' when o_orderkey % 8 < 5 then 'INFO: detail, requesting {_HEAD}' || o_custkey || '/i3' || (o_orderkey % 40)
    when o_orderkey % 8 < 6 then 'INFO: detail, requesting {_HEAD}' || o_custkey || '/g299' else 'INFO: detail, requesting {_HEAD}' || o_custkey || '/' || o_orderkey || '.htm' end as line from orders),
kd as (select line, rtrim(regexp_extract(line, 'https://.*'), '/') as url, unnest(list_filter([case when contains(line, 'INFO: list, requesting') then 'start_list_request' end, case when contains(line, 'INFO: detail, requesting') then 'start_detailed_request' end, case when contains(line, 'ERROR') then 'errors' end], lambda x: x is not null)) as kind from ln),
lp as (select url, kind, kind = 'start_detailed_request' and not contains(line, '.htm') as further, contains(regexp_extract(line, '[^/]*$'), 'i3') as numbered from kd),
firsts as (select distinct url as list from lp where kind = 'start_list_request'),
more as (select regexp_replace(url, '.i3.*$', '') as list, count(*) as n from lp where further and numbered group by 1)"""


@query(f"with {_LOG} select case when further then 'start_list_request' else kind end as kind, count(*) as n from lp group by 1")
def requests_by_kind(spark, d):
    return crawl_log.requests_by_kind(log_lines(spark, d), "value", LABELS)


@query(f"with {_LOG} select list, coalesce(n, 0) as pages, true as known from firsts left join more using (list) union all select list, n, false from more where list not in (select list from firsts)")
def requested_lists(spark, d):
    """Further pages of each list, and of lists whose first page was never requested."""
    lists, unknown = crawl_log.requested_lists(log_lines(spark, d), "value", LABELS)
    return lists.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


@query(f"""with {_LOG}, ans as (select rtrim(case when o_orderkey % 11 = 0 then 'https://other.example/x' || o_custkey when o_orderkey % 3 = 0 then '{_HEAD}' || o_custkey || '/' else '{_HEAD}' || o_custkey || '/i3' || (o_orderkey % 40) end, '/') as url from orders),
got as (select regexp_replace(url, '.i3.*$', '') as list, count(*) as n from ans where contains(url, 'i3') group by 1)
select f.list, coalesce(m.n, 0) - coalesce(g.n, 0) as n, case when f.list in (select url from ans) then 'answered' else 'silent' end as state from firsts f left join more m using (list) left join got g using (list)
union all select url, count(*), 'unknown' from ans where not contains(url, 'i3') and url not in (select list from firsts) group by url""")
def unanswered_lists(spark, d):
    """Further pages without an answer per list, lists whose first page had none, and answered urls that are unknown."""
    lists, _ = crawl_log.requested_lists(log_lines(spark, d), "value", LABELS)
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    url = F.when(k % 11 == 0, F.concat(F.lit("https://other.example/x"), c)).when(k % 3 == 0, F.concat(F.lit(_HEAD), c, F.lit("/"))).otherwise(F.concat(F.lit(_HEAD), c, F.lit("/i3"), (k % 40).cast("string")))
    out, unknown = crawl_log.unanswered_lists(lists, t(spark, d, "orders").select(url.alias("url")), "url")
    out = out.select("list", F.col("unanswered").alias("n"), F.when(F.col("silent"), "silent").otherwise("answered").alias("state"))
    return out.unionByName(unknown.select(F.col("url").alias("list"), "n", F.lit("unknown").alias("state")))


# -- operators whose other half no query held ----------------------------------------------------


@query("select p_partkey from part where p_size % 2 <> 0")
def rows_of_other_widths(spark, d):
    """Parts whose list has six cells instead of seven."""
    cells = F.array_repeat(F.col("p_name"), 6 + (F.col("p_size") % 2 == 0).cast("int"))
    return shape.drop_blank_rows(t(spark, d, "part").select("p_partkey", cells.alias("cells")), "cells")[1].select("p_partkey")


@query("""with o as (select c_custkey, o_orderkey, o_orderstatus from customer left join orders on o_custkey = c_custkey),
n as (select c_custkey, case when o_orderstatus = 'O' then o_orderkey end as k from o where o_orderkey is null or o_orderstatus = 'O' union all select c_custkey, null from o group by 1 having count(*) filter (o_orderstatus = 'O') = 0 and count(o_orderkey) > 0)
select c_custkey, 'buildings' as child, o_orderkey as k from o union all select c_custkey, 'permits', k from n union all select c_custkey, 'openings', null from customer""")
def estate_child_tables(spark, d):
    """All three child tables: orders, open orders, and nothing, each with a null row where a customer has none."""
    one = F.struct(F.col("o_orderkey").alias("k"))
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(one).alias("buildings"), F.collect_list(F.when(F.col("o_orderstatus") == "O", one)).alias("permits"))
    rows = t(spark, d, "customer").join(g, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("openings", F.lit(None).cast("array<struct<k: bigint>>"))
    names = ("buildings", "permits", "openings")
    found = [x.withColumn("child", F.lit(n)) for n, x in zip(names, records.estate_children(rows, "c_custkey", names), strict=True)]
    return aggs.union_sources(*found).select("c_custkey", "child", "k")


#: A line of four points; its segments go east, north and north-east.
LINE = ((113.0, 22.75), (113.25, 22.75), (113.25, 23.0), (113.75, 23.5))


@query(f"with {PTS} select id, (lat = 22.75 and lng between 113 and 113.25) or (lng = 113.25 and lat between 22.75 and 23) or (abs(0.5 * (lat - 23) - (lng - 113.25) * 0.5) < 2e-10 and lng between 113.25 and 113.75 and lat between 23 and 23.5) as \"on\" from (select event_id as id, 113 + (event_id % 8) / 8::double as lng, 22.5::double + (event_id // 8 % 8) / 8::double as lat from events) q")
def on_segments(spark, d):
    """Points of a grid of eighths of a degree, of which many lie on one of a line's three segments."""
    k = F.col("event_id")
    p = t(spark, d, "events").select(k.alias("id"), F.struct((113 + (k % 8) / F.lit(8.0)).alias("lng"), (F.lit(22.5) + F.floor(k / 8) % 8 / F.lit(8.0)).alias("lat")).alias("p"))
    return p.select("id", geo.on_polyline(F.col("p"), F.array(*(F.struct(F.lit(a).alias("lng"), F.lit(b).alias("lat")) for a, b in LINE))).alias("on"))


@query("select page_id || '.html' as file, md5(coalesce(html, '') || '城市') as digest from pages")
def read_html_dir_whole(spark, d):
    """A file per page with the whole html in UTF-8 and a byte that the charset lacks; read back as text."""
    path = files.work_path(spark, "html")
    content = F.concat(F.coalesce("html", F.lit("")).cast("binary"), F.unhex(F.lit("FF")), F.lit("城市").cast("binary"))
    files.write_responses(t(spark, d, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("file"), content.alias("content")), path, "file", "content")
    return files.read_html_dir(spark, path, "utf-8").select("file", F.md5(F.col("html").cast("binary")).alias("digest"))


@query(f"with {CEN} select k, count(*) over (partition by nation) as n, {m('(lead(x) over w - x) / (256 * 2 + 5) * 1000')} as dx, {m('(lead(y) over w - y) / (256 * 3 + 7) * 1000')} as dy from cen window w as (partition by nation order by k) qualify lead(k) over w is not null")
def calibrate_pairs(spark, d):
    """Calibrations from every two neighbouring known points of a nation, each two tiles east and three north of the one before."""
    w = Window.partitionBy("nation").orderBy("k")
    at = F.row_number().over(w)
    c = centers(spark, d).select("nation", F.col("k").alias("id"), (at * 2).alias("x"), (at * 3).alias("y"), (at * 5).alias("px"), (at * 7).alias("py"), F.col("x").alias("lng"), F.col("y").alias("lat"), F.count(F.lit(1)).over(Window.partitionBy("nation")).alias("n"))
    found = grids.calibrate_pairs(c, ["nation", "n"])
    return found.select(F.col("aid").alias("k"), "n", micro(F.col("dx") * 1000).alias("dx"), micro(F.col("dy") * 1000).alias("dy"))
