"""Interval joins, kept state, written tables and covers against brute force; and the plans that they should have."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from urbanlake.functions import geo
from urbanlake.operators import aggs, crawl_log, grids, joins, pages, shape
from urbanlake.plans import columns
from urbanlake.sources import files
from urbanlake.streaming import streams

R = random.Random(3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seconds", [0, 7, 240, 400, 1000])
def test_unanswered_requests_for_any_interval(spark, seconds):
    asked = [(R.choice("abc"), R.randrange(0, 5000)) for _ in range(150)] + [(None, 3), ("a", None)]
    asked += asked[:5]
    answers = [(R.choice("abcd"), R.randrange(-100, 7000) + R.choice((0.0, 0.5))) for _ in range(60)] + [(None, 5.0), ("b", None)]
    q = spark.createDataFrame(asked, "key string, s long").select("key", F.timestamp_seconds("s").alias("start"), "s")
    r = spark.createDataFrame(answers, "key string, s double").select("key", F.timestamp_seconds("s").alias("ts"))
    wanted = sorted(((k or "", s if s is not None else -1) for k, s in asked if not any(s is not None and k is not None and k == a and t is not None and s <= t <= s + seconds for a, t in answers)))
    found = joins.unanswered(q, r, seconds)
    assert sorted((x.key or "", x.s if x.s is not None else -1) for x in found.collect()) == wanted
    late = joins.late_responses(q.select("start").distinct(), q, r, 400)
    assert "NestedLoop" not in plan(late) and "Cartesian" not in plan(late)


def test_streams_of_requests_and_answers_over_three_runs(spark, tmp_path):
    """What comes out is what the batch join gives for the requests that the watermark has passed; no request twice."""
    asked = [(k, 1_700_000_000 + 60 * i) for i in range(200) for k in "ab" if R.random() < 0.8]
    answers = [(k, s + R.choice((10, 239, 240, 241, 900))) for k, s in asked if R.random() < 0.6]
    out = None
    for lo, hi in ((0, 1_700_004_000), (1_700_004_000, 1_700_009_000), (1_700_009_000, 1 << 40)):
        for rows, c, at in ((asked, "start", "q"), (answers, "ts", "r")):
            part = [(k, s) for k, s in rows if lo <= s < hi]
            spark.createDataFrame(part, "key string, s long").select("key", F.timestamp_seconds("s").alias(c)).write.mode("append").parquet(f"{tmp_path}/{at}")
        q, r = (spark.readStream.schema(f"key string, {c} timestamp").parquet(f"{tmp_path}/{at}") for c, at in (("start", "q"), ("ts", "r")))
        out = streams.late_requests(q, r)
        files.stream_to_table(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    found = sorted((x.key, x.s) for x in spark.read.schema(out.schema).parquet(f"{tmp_path}/t").select("key", F.unix_timestamp("start").alias("s")).collect())
    end = min(max(s for _, s in asked), max(s for _, s in answers)) - 600
    late = sorted((k, s) for k, s in asked if not any(a == k and s <= t <= s + 240 for a, t in answers))
    assert found == [x for x in late if x[1] + 240 < end] and len(found) > 20


@pytest.mark.parametrize("seconds", [1, 240])
def test_streams_of_answers_join_by_bins_of_time(spark, tmp_path, seconds):
    """Answers at and beside the ends of bins count once, as often as they did; the join of streams has the bin in its key."""
    edge = 4 * seconds
    asked = [("a", edge * 1_000 + d) for d in (0, 1, edge - seconds, edge - 1, edge, 9 * edge)] + [("b", edge * 1_000), ("b", edge * 4_000)]
    answers = [("a", edge * 1_000 + d) for d in (0, seconds, edge - 1, edge, edge + seconds, 2 * edge)] + [("b", edge * 1_000 + seconds + 1), ("c", edge * 4_000)]
    for rows, c, at in ((asked, "start", "q"), (answers, "ts", "r")):
        spark.createDataFrame(rows, "key string, s long").select("key", F.timestamp_seconds("s").alias(c)).write.parquet(f"{tmp_path}/{at}")
    q, r = (spark.readStream.schema(f"key string, {c} timestamp").parquet(f"{tmp_path}/{at}") for c, at in (("start", "q"), ("ts", "r")))
    out = streams._answers(q, r, seconds, "0 seconds").select("key", F.unix_timestamp("start").alias("s"), F.unix_timestamp("_ts").alias("t"))
    run = files.stream_to_table(out, f"{tmp_path}/t", f"{tmp_path}/c")
    run.awaitTermination()
    join = re.search(r"StreamingSymmetricHashJoin \[([^]]*)\], \[([^]]*)\]", run._jsq.explainInternal(False))
    assert join and "_in" in join[1] and "_bin" in join[2]
    found = [tuple(x) for x in spark.read.schema(out.schema).parquet(f"{tmp_path}/t").collect()]
    pairs = [(k, s, t) for k, s in asked for a, t in answers if a == k and s <= t <= s + seconds]
    assert sorted(x for x in found if x[2] is not None) == sorted(pairs) and len(pairs) > 4
    assert {x[:2] for x in found if x[2] is None} == {x for x in asked if x[1] + seconds < edge * 4_000} - {x[:2] for x in pairs}


def test_versions_of_maxima(spark, tmp_path):
    path = f"{tmp_path}/v"
    batch = lambda *rows: spark.createDataFrame(rows, "center long, n long")
    assert streams.seen_max(spark, path, "center long, n long").collect() == []
    for epoch, rows in enumerate(([(1, 5), (2, 1)], [(1, 3), (3, 9)], [(2, 8)])):
        streams.merge_version(batch(*rows), path, epoch, ("center",))
        streams.merge_version(batch(*rows), path, epoch, ("center",))  # a batch that runs again
    assert sorted(map(tuple, streams.seen_max(spark, path, "center long, n long").collect())) == [(1, 5), (2, 8), (3, 9)]
    assert streams._versions(spark, path) == [1, 2]
    spark.createDataFrame([(7, 7)], "center long, n long").write.parquet(f"{path}/version=3")
    (tmp_path / "v/version=3/_SUCCESS").unlink()  # broken off
    assert sorted(map(tuple, streams.seen_max(spark, path, "center long, n long").collect())) == [(1, 5), (2, 8), (3, 9)]


def test_lines_are_numbered_however_files_are_split(spark, tmp_path):
    text = {f"f{i}.txt": [f"{i} line {j} " + "x" * R.randrange(40) for j in range(R.choice((0, 1, 37, 400)))] for i in range(6)}
    for name, lines in text.items():
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = sorted((r.file.rpartition("/")[2], r.line_no, r.value) for r in files.read_lines(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted((name, i, x) for name, lines in text.items() for i, x in enumerate(lines))


def test_folders_are_pruned_and_replaced(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id long, ts timestamp"
    rows = spark.range(2000).select("id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600).alias("ts"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("city"))
    files.write_records(rows, path)
    files.write_records(rows.filter("date(ts) = '2024-01-02' and city = 'a'"), path)
    table = files.read_records(spark, path, schema)
    assert table.count() == 2000
    found = shape.time_range(table, "a", "2024-01-03 05:10:00", "2024-01-05 07:30:00", date="date")
    assert sorted(r.id for r in found.collect()) == [i for i in range(0, 2000, 3) if 2 * 144 + 36 <= i < 4 * 144 + 48]
    text = plan(found)
    assert "PartitionFilters: [isnotnull" in text and "2024" in text.partition("PushedFilters")[2].partition("]")[0]
    assert sum("city=a" in f for f in found.inputFiles()) >= 1 and len({f.rpartition("/")[0] for f in spark.read.parquet(path).filter("city = 'a'").inputFiles()}) > 3
    at = lambda s: F.lit(s).cast("timestamp")
    ranges = spark.createDataFrame([("a", 1), ("b", 0), ("a", 0)], "city string, kind int").filter("kind = 1").select("city", at("2024-01-02 12:00:00").alias("start"), at("2024-01-03 00:00:00").alias("end"))
    some = shape.in_ranges(table, ranges)
    assert "dynamicpruning" in plan(some)
    assert sorted(r.id for r in some.collect()) == [i for i in range(0, 2000, 3) if 216 <= i <= 288]


def test_grid_folders_change_only_where_checks_change_them(spark, tmp_path):
    path = f"{tmp_path}/grid"
    grid = spark.range(500).select((F.col("id") / 10.0).alias("x"), F.lit(1.0).alias("y"), F.lit(0).alias("ok0"), F.lit(10).alias("max"), F.lit(5).cast("bigint").alias("max_timestamp"))
    files.write_grid(grid, path)
    times = {p: p.stat().st_mtime_ns for p in tmp_path.glob("grid/part=*/*.parquet")}
    checks = spark.createDataFrame([(0.1, 1.0, 50, 9), (0.2, 1.0, 3, 9), (99.0, 9.0, 70, 9)], "x double, y double, n int, ts long")
    assert len(files.update_grid(spark, path, checks, joins.upsert_grid_max)) == 1
    kept = [p for p, t in times.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(kept) == len(times) - len({p.parent for p in times if not p.exists()}) and len({p.parent for p in times if not p.exists()}) == 1
    assert files.update_grid(spark, path, checks, joins.upsert_grid_max) == []
    rows = {r.x: (r.ok0, r.max, r.max_timestamp) for r in files.read_grid(spark, path).collect()}
    assert len(rows) == 500 and rows[0.1] == (1, 50, 9) and rows[0.2] == (0, 10, 5)


def test_daily_batches_and_named_runs_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", 1704067200), (2, 'a,"b', 1704160000)], "id long, name string, s long").select("id", "name", F.timestamp_seconds("s").alias("ts"))
    for epoch in (0, 0, 1, 1):
        files.write_daily_batch(rows, epoch, f"{tmp_path}/s", "ts")
    for run in ("a", "a", "b"):
        files.write_daily(rows.drop("ts"), f"{tmp_path}/d", "2024-01-05", run)
    for fmt in ("json", "csv"):
        found = sorted((r.dt, r.id, r.name) for r in files.read_daily(spark, f"{tmp_path}/s", "id long, name string, ts timestamp", fmt).collect())
        assert found == sorted([("2024-01-01", 1, "x"), ("2024-01-02", 2, 'a,"b')] * 2)
        assert files.read_daily(spark, f"{tmp_path}/d", "id long, name string", fmt).count() == 4


def test_one_pass_splits_and_counts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a;b"), (2, "a"), (3, None)], "id int, v string")
    good, bad, n = files.split_and_count(rows, F.size(F.split("v", ";")) == 2, f"{tmp_path}/s")
    assert [r.id for r in good.collect()] == [1] and sorted(r.id for r in bad.collect()) == [2, 3] and n == {"all": 3, "good": 1, "bad": 2}
    missed, done, n = joins.missed_and_done(spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int"), spark.createDataFrame([(2,), (2,), (None,)], "id int"), "id", f"{tmp_path}/m")
    assert sorted(str(r.id) for r in missed.collect()) == ["1", "1", "None"] and [r.id for r in done.collect()] == [2] and n["all"] == 4


def test_sketches_are_united_within_their_error(spark):
    rows = spark.range(60000).select((F.col("id") % 3).cast("string").alias("file"), (F.col("id") % 20011).alias("id"))
    parts = aggs.id_sketches(rows.filter("id < 9000"), "file", "id").unionByName(aggs.id_sketches(rows.filter("id >= 9000"), "file", "id"))
    found = {r.file: (r.n_rows, r.n_ids) for r in aggs.sketched_counts(parts, "file").collect()}
    exact = {r.file: (r.n_rows, r.n_ids) for r in aggs.unique_counts(rows, "file", "id").collect()}
    assert set(found) == {None, "0", "1", "2"}
    for file, (n, ids) in exact.items():
        assert found[file][0] == n and abs(found[file][1] - ids) <= 0.03 * ids


def inside(x, y, polygon):
    odd = False
    for (px, py), (qx, qy) in zip(polygon, polygon[1:] + polygon[:1]):
        cross = (qx - px) * (y - py) - (x - px) * (qy - py)
        if abs(cross) <= 2e-10 and min(px, qx) - 2e-10 <= x <= max(px, qx) + 2e-10 and min(py, qy) - 2e-10 <= y <= max(py, qy) + 2e-10:
            return True
        if (py > y) != (qy > y) and x < px + (y - py) * (qx - px) / (qy - py):
            odd = not odd
    return odd


def test_cover_equals_rays_for_polygons_of_all_sizes(spark):
    shapes = [[(0.0, 0.0), (1.0, 1.0)]]
    for _ in range(40):
        x, y, r = R.uniform(110, 112), R.uniform(22, 24), R.choice((1e-6, 0.01, 0.3, 2.0))
        turns = sorted(R.uniform(0, 2 * math.pi) for _ in range(R.randrange(3, 9)))
        shapes.append([(x + r * R.uniform(0.2, 1) * math.cos(a), y + r * R.uniform(0.2, 1) * math.sin(a)) for a in turns])
    shapes.append([(111.0, 23.0), (111.5, 23.5), (111.5, 23.0), (111.0, 23.5)])  # crosses itself
    shapes.append([(100.0, 20.0), (120.0, 20.0), (120.0, 35.0), (101.0, 34.0)])
    large = len(shapes) - 1
    polygons = spark.createDataFrame([(i, [{"lng": a, "lat": b} for a, b in s]) for i, s in enumerate(shapes)], "polygon_id long, polygon array<struct<lng:double,lat:double>>")
    at = [(R.uniform(109, 113), R.uniform(21, 25)) for _ in range(1500)] + [p for s in shapes for p in s] + [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for s in shapes for a, b in zip(s, s[1:])]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(at)] + [(-1, None, 1.0)], "id long, lng double, lat double")
    found = {r.id: r.polygon_id for r in grids.points_in_polygons(points, polygons, refine=3).collect()}
    wanted = {}
    for i, p in enumerate(at):
        hits = [k for k, s in enumerate(shapes) if len(s) >= 3 and inside(*p, s)]
        if hits:
            wanted[i] = hits[0]
    assert found == wanted and len({*found.values()}) > 10
    sizes = {r.polygon_id: r["count"] for r in grids.cell_cover(polygons).groupBy("polygon_id").count().collect()}
    assert max(sizes.values()) < 700 and 0 not in sizes
    assert grids.cell_cover(polygons).filter(f"edges is null and polygon_id = {large}").count() > 0


def test_areas_and_lines(spark):
    quarter = [(0.0, 0.0), (90.0, 0.0), (0.0, 90.0)]
    rows = spark.createDataFrame([(1, [{"lng": a, "lat": b} for a, b in quarter]), (2, None), (3, [{"lng": 1.0, "lat": 1.0}] * 2)], "k int, p array<struct<lng:double,lat:double>>")
    found = {r.k: r.a for r in rows.select("k", geo.polygon_area_m2(F.col("p")).alias("a")).collect()}
    assert found[1] == pytest.approx(4 * math.pi * geo.EARTH_M**2 / 8) and found[2] == found[3] == 0.0


def test_sql_function_of_paths(spark):
    shape.register_functions(spark)
    assert spark.sql("select parse_path('1,2;3') as p").first().p == [["1", "2"], ["3"]]


def test_log_of_a_crawl(spark):
    log = """x INFO: list, requesting https://h/house-a084/
x INFO: list, requesting https://h/house-a084-b01/
x INFO: detail, requesting https://h/house-a084-b01/i32
x INFO: detail, requesting https://h/house-a084-b01/i33/
x INFO: detail, requesting https://h/house-a084-b01/i33
x INFO: detail, requesting https://h/house-a99/i32
x INFO: detail, requesting https://h/house-a084/g299
ERROR INFO: detail, requesting https://h/3_1.htm
nothing""".split("\n")
    labels = {"list, requesting": crawl_log.FIRST, "detail, requesting": crawl_log.DETAIL, "ERROR": "errors"}
    lines = spark.createDataFrame([(x,) for x in log], "line string")
    assert {r.kind: r.n for r in crawl_log.requests_by_kind(lines, "line", labels).collect()} == {crawl_log.FIRST: 7, crawl_log.DETAIL: 1, "errors": 1}
    assert crawl_log.log_requests(lines, "line", labels).filter("error").count() == 2  # no i3 in the last part: g299, and the slash at the end
    lists, unknown = crawl_log.requested_lists(lines, "line", labels)
    assert {r.list: r.pages for r in lists.collect()} == {"https://h/house-a084": 0, "https://h/house-a084-b01": 2}
    assert [(r.list, r.pages) for r in unknown.collect()] == [("https://h/house-a99", 1)]
    answered = spark.createDataFrame([("https://h/house-a084/",), ("https://h/house-a084-b01/i32",), ("https://h/other",)], "url string")
    out, bad = crawl_log.unanswered_lists(lists, answered, "url")
    assert {r.list: (r.unanswered, r.silent) for r in out.collect()} == {"https://h/house-a084": (0, False), "https://h/house-a084-b01": (1, True)}
    assert [(r.url, r.n) for r in bad.collect()] == [("https://h/other", 1)]


def test_deep_pages_and_orders(spark):
    deep = "<div>" * 3000 + "<h1>Title</h1>" + "</p>" * 3000 + "</div>" * 3000 + "<h1>after</h1>"
    assert [n.text() for n in pages.tree(deep).all(("h1", None, None))] == ["Title", "after"]
    cells = spark.range(50)
    first, again, other = ([r.id for r in aggs.shuffle_cells(cells, "id", seed).collect()] for seed in (7, 7, 8))
    assert first == again != other and sorted(first) == sorted(other) == list(range(50)) != first


def test_dealt_rows_grow_in_parts_not_in_size(spark):
    """More rows give more parts of the same size, together by key; collecting them needs no second exchange, small tables no deal."""
    rows = spark.range(10_000).select((F.col("id") % 1_000).alias("k"), "id")
    for limit, parts in ((1_000, 10), (500, 20)):
        found = joins.dealt(rows, "k", rows=limit)
        assert found.rdd.getNumPartitions() == parts
        assert found.select("k", F.spark_partition_id()).distinct().count() == 1_000
        assert plan(found.groupBy("k").agg(F.collect_list("id"))).count("Exchange") == 1
    assert joins.dealt(rows, "k", rows=10_000) is rows and joins.dealt(rows.limit(0), "k").count() == 0


def test_durations_of_messages_are_those_of_their_segments(spark, tmp_path):
    """One row a message enters the state; messages without a segment have none."""
    seg, step = '{"status": "1", "geo_cnt": "1"}', '{"path": %s, "traffic_condition": %s}'
    steps = ["null", "[]", f"[{step % ('null', f'[{seg}, {seg}]')}]", f"[{step % ('"0,0;1,1"', '[]')}, {step % ('"0,0"', f'[{seg}]')}]", f"[{step % ('""', 'null')}]", "[null]", "[{}]"]
    values = [(f'{{"preset_route": "r{i}", "duration": "{i}", "selected_path_steps": {x}}}', i) for i, x in enumerate(steps)] * 2 + [("no json", 99), (None, 100)]
    rows = spark.createDataFrame(values, "value string, s long").select("value", F.timestamp_seconds(F.col("s") + 86400).alias("timestamp"))
    wanted = sorted(map(tuple, streams.durations(streams.route_stream_b(rows)).collect()))
    assert sorted(map(tuple, streams.message_durations(rows).collect())) == wanted and [x[1] for x in wanted] == ["r2", "r3"]
    rows.write.parquet(f"{tmp_path}/in")
    out = streams.message_durations(files.read_messages(spark, f"{tmp_path}/in", "parquet"))
    files.stream_to_table(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert sorted(map(tuple, spark.read.schema(out.schema).parquet(f"{tmp_path}/t").collect())) == wanted


def test_areas_of_one_file_are_many_tasks(spark, tmp_path):
    """A file of many centers is a few bytes; their areas come from several tasks."""
    k = F.col("id")
    spark.range(0, 50_000, 1, 1).select(k.alias("c_custkey"), (k % 25).cast("int").alias("c_nationkey"), F.lit("m").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    found = columns.polygon_area_m2(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 2
    assert found.agg(F.count_distinct("k"), F.min("km2") > 0).first() == (50_000, True)


def test_plain_markup_is_read_as_the_parser_reads_it(monkeypatch):
    """Pages of plain markup skip the parser and give its nodes; all other pages go through it."""
    def flat(n):
        return n if isinstance(n, str) else (n.tag, n.attrs, [flat(x) for x in n.parts])

    def parsed(html):
        p = pages._Tree()
        p.feed(html)
        p.close()
        return p.top

    bits = ["<p>", "<P class=a>", '<div class="x y" id=t>', "</div>", "</p>", "<br>", "<li>", "</LI >", "<td>", "<b hidden>", "</b>", '<i a="" A="2">', "a &amp; b", "&lt", " x\n", "城", "&", "\xa0", '<a href="u?a=1&amp;b">', "<br/>", "< ", "<!-- <p> -->", "<script>", "</script>", "<title>", "</title>", "</p x>", "<x:y>", "<p =a>", "<i\xa0b>", "<a b=c/>", "<p", ">", "</>", "<![CDATA[x]]>", "<?x>", "\0"]
    fast = 0
    for i in range(3_000):
        html = "".join(R.choice(bits[: 18 if i % 2 else None]) for _ in range(R.randrange(12)))
        assert flat(pages.tree(html)) == flat(parsed(html)), html
        fast += pages._plain(html) is not None
    assert 1_500 <= fast < 3_000
    monkeypatch.setattr(pages, "_Tree", None)  # a plain page needs no parser
    assert [n.text() for n in pages.tree('<div class="card x"><h3>7</h3><b class=st>O</b></div>').all(("b", "class", "st"))] == ["O"]


def test_many_small_files_are_few_tasks(spark, tmp_path):
    """Tasks don't grow with every 32 files, and every file is read whole, once, under its own name."""
    rows = spark.range(0, 2_000, 1, 4).select(F.concat(F.col("id").cast("string"), F.lit("___a b.html")).alias("file"), F.concat(F.lit('{"v": '), F.col("id").cast("string"), F.lit("}\n")).alias("content"))
    files.write_responses(rows, f"file://{tmp_path}/t", "file", "content")
    html = files.read_html_dir(spark, f"file://{tmp_path}/t", "utf-8")
    assert 4 <= html.rdd.getNumPartitions() <= 16
    assert html.count() == 2_000 and html.filter(F.regexp_extract("file", "^[0-9]+", 0) == F.regexp_extract("html", "[0-9]+", 0)).select("file").distinct().count() == 2_000
    found = files.read_response_dir(spark, f"file://{tmp_path}/t", ["k", "name"], "v bigint")
    assert found.rdd.getNumPartitions() <= 16
    assert found.filter("k = cast(v as string) and name = 'a b'").select("k").distinct().count() == 2_000
