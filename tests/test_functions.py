import math

import pytest
from pyspark.sql import functions as F

from urbanlake.functions import geo, text, urls
from urbanlake.operators import aggs, grids, pages, shape
from urbanlake.sources import files


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "strategy", "want"), [("12af79aalf045", "match_all_digits", 1279045), ("12af79aalf045", "only_first_part", 12), ("12af", "strict", None), ("12", "strict", 12), ("", "match_all_digits", 0), ("9" * 30, "match_all_digits", 0)])
def test_to_int(spark, raw, strategy, want):
    assert one(spark, text.to_int(F.lit(raw), strategy)) == want


def test_text_cases(spark):
    assert one(spark, text.find_digits(F.lit("123abc389"), all=True)) == ["123", "389"]
    assert one(spark, text.clean_string(F.lit(None).cast("string"))) == ""
    assert one(spark, text.clean_string(F.lit('"a b\n"'))) == "ab"
    assert one(spark, text.clean_address(F.lit("*road(1)*"))) == "road"
    assert one(spark, text.parse_geocode(F.lit("{bad"))).lng is None
    assert one(spark, text.build_date(F.lit(2023), F.lit(2), F.lit(30))) is None
    assert one(spark, text.unpack_pairs(F.lit("a___key2value___1___basic___b")))["a"] == "1"
    assert one(spark, text.level2_code(F.lit("g110r7p2"))).asDict() == {"level2": "g110", "district": "r7"}


def test_urls(spark):
    assert one(spark, urls.query_params(F.lit("http://a/b?x=1,2&y="))) == {"x": "1_2", "y": ""}
    assert one(spark, urls.base_page_url(F.lit("http://a/house/i32/"))) == "http://a/house/"
    assert one(spark, urls.listing_id(F.lit("http://a/"))) is None


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://fs.58.com/shangpucz/", (1, "", "")),
        ("https://gz.58.com/tianhe/shangpucz/pn3/?area=20_50", (3, "tianhe", "20_50")),
        ("https://fs.58.com/foshan/shangpucz/pn2/", (2, "foshan", "")),
        ("https://fs.58.com/shangpu/38143746902823x.shtml", (0, "", "")),
        ("https://gz.58.com", (1, "", "")),
    ],
)
def test_shop_urls(spark, url, want):
    assert tuple(one(spark, urls.shop_url_parts(F.lit(url)))) == want


@pytest.mark.parametrize(
    ("log", "want"),
    [
        ("z_2_33120284640267_38420286183181_1_2_sortid:613502485@postdate:1560301497000", "38420286183181"),
        ("gz_2_55687810204183_36683482092955_sortid:599933703@postdate:1560268805000@ses:busitime^desc@pubid:76309565", "36683482092955"),
        ("z_2_33120284640267", None),
        ("sortid:1", None),
        (None, None),
    ],
)
def test_log_ids(spark, log, want):
    assert one(spark, urls.listing_id(F.lit("http://x/"), F.lit(log).cast("string"))) == want


def test_points_in_reflex_polygons(spark):
    corners = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    shape_ = F.array(*(F.struct(F.lit(float(x)).alias("lng"), F.lit(float(y)).alias("lat")) for x, y in corners))
    polygons = spark.createDataFrame([(7,), (3,)], "polygon_id bigint").withColumn("polygon", shape_)
    cases = {(1, 1): True, (2, 2): False, (2, 1): True, (2, 0.5): True, (3, 2.5): True, (3, 2.6): False, (0, 0): True, (4, 2): True, (4.1, 2): False, (1, 2.5): True, (1, 2.6): False, (2, 4): False, (-1, 0): False, (1.5, 2.2): False}
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(cases)], "id bigint, lng double, lat double")
    got = {r.id: r.polygon_id for r in grids.points_in_polygons(points, polygons, cell=1.0).collect()}
    assert got == {i: 3 for i, inside in enumerate(cases.values()) if inside}


def test_links_are_joined(spark):
    html = """<a href='/a'>1</a><div class="x list"><a href="b">2</a><a href=../c>3</a><a href='//h2/d'>4</a><a name=n>5</a><a href="?q=1&amp;r=2">6</a><a href="https://o/e#f">7</a></div>"""
    df = spark.createDataFrame([(1, "https://h/x/y", html), (2, None, None)], "k int, url string, html string")
    links = lambda rule: [r.link for r in pages.page_links(df, "html", "url", rule).collect()]
    inside = ["https://h/x/b", "https://h/c", "https://h2/d", "https://h/x/y?q=1&r=2", "https://o/e#f"]
    assert links(("div", "class", "list")) == inside and links(None) == ["https://h/a", *inside]


def test_tile_batches_of_negative_tiles(spark):
    df = spark.createDataFrame([("m5_3_16.png",), ("m4_13_16.png",), ("6_3_16.png",), ("m5_3_16.png",)], "name string")
    got = {(r.bx, r.by): [tuple(x) for x in r.tiles] for r in aggs.tile_batches(df, "name", 10).collect()}
    assert got == {(0, 0): [("m5_3_16.png", 0, 3)], (0, 1): [("m4_13_16.png", 1, 13)], (1, 0): [("6_3_16.png", 11, 3)]}
    assert aggs.tile_batches(df.limit(0), "name", 10).count() == 0


def test_coordinates_round_trip(spark):
    back = lambda f, g: one(spark, g(*(f(F.lit(114.1), F.lit(22.6))[k] for k in ("lng", "lat"))))
    p = back(geo.gcj02_to_bd09, geo.bd09_to_gcj02)
    assert abs(p.lng - 114.1) < 1e-5 and abs(p.lat - 22.6) < 1e-5
    p = back(geo.wgs84_to_gcj02, geo.gcj02_to_wgs84)
    assert abs(p.lng - 114.1) < 1e-4 and abs(p.lat - 22.6) < 1e-4
    p = one(spark, geo.bd09_to_gcj02(F.lit(113.383874), F.lit(22.969690)))
    assert abs(p.lng - 113.377385114027) < 1e-6 and abs(p.lat - 22.963558712658) < 1e-6
    assert one(spark, geo.wgs84_to_gcj02(F.lit(128.543), F.lit(60.0))).lat == 60.0


def test_geometry(spark):
    pt = lambda x, y: F.struct(F.lit(float(x)).alias("lng"), F.lit(float(y)).alias("lat"))
    assert one(spark, geo.distance_m(pt(1, 2), pt(1, 2))) == 0
    assert one(spark, geo.polyline_length_m(F.array(pt(1, 2)))) == 0
    area = one(spark, geo.polygon_area_m2(F.array(pt(0, 0), pt(1, 0), pt(1, 1), pt(0, 1))))
    side = geo.EARTH_M * math.pi / 180
    assert abs(area / side**2 - 1) < 1e-3


def test_cut_polyline_of_long_paths(spark):
    """Paths of thousands of segments, null paths and conditions, counts that are no numbers: against brute force."""
    n = 4000
    rows = [(";".join(f"{i}.5,{i}.25" for i in range(2 * n)), [("s", str(i % 4)) for i in range(n)]), (None, [("a", "1")]), ("1,2", None), ("1,2;3,4;5,6", [("a", "x"), ("b", None), ("c", "2")]), ("", [])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, path string, tc array<struct<status:string, geo_cnt:string>>")

    def cut(path, conditions):
        at, out = 0, []
        for status, count in conditions:
            k = int(count) if (count or "").isdigit() else 0
            out.append((status, None if path is None else ";".join(path.split(";")[at : at + k + 1])))
            at += k
        return out

    got = {r.id: r.x for r in df.select("id", shape.cut_polyline(F.col("path"), F.col("tc")).alias("x")).collect()}
    assert got[2] is None
    assert all([tuple(s) for s in got[i]] == cut(*rows[i]) for i in (0, 1, 3, 4))


def test_cut_polyline_overruns(spark):
    row = "path string, tc array<struct<status:string, geo_cnt:string>>"
    df = spark.createDataFrame([("a;b;c", [("1", "1"), ("2", "5")]), ("a", []), ("a;b", [("1", None)])], row)
    got = [[(s.status, s.polyline) for s in r.x] for r in df.select(shape.cut_polyline(F.col("path"), F.col("tc")).alias("x")).collect()]
    assert got == [[("1", "a;b"), ("2", "b;c")], [], [("1", "a")]]


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 2, "a"), (2, 1, "c")], "k int, o int, v string")
    once = aggs.dedupe_keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == [(1, 2, "a"), (2, 1, "c")] == sorted(map(tuple, aggs.dedupe_keep_first(once, ["k"], ["o"]).collect()))


def test_category_lines_fail(spark):
    df = spark.createDataFrame([("a:b、c",), ("broken",)], "line string")
    with pytest.raises(Exception, match="not a category line"):
        files.read_categories(df, "line").collect()
