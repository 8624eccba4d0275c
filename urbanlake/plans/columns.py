"""Registered queries of the column functions, the grids and the page parsers."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import geo, text, urls
from ..operators import grids, joins, pages, records
from ..sources import files
from .queries import BD_LAT, BD_LNG, CEN, PTS, centers, m, micro, points, query, t

# -- text, numbers, dates ------------------------------------------------------------------------


@query(r"select p_partkey, coalesce(try_cast(nullif(regexp_replace(p_brand || p_name || p_size, '\D', '', 'g'), '') as bigint), 0) as a, coalesce(try_cast(nullif(regexp_extract(p_brand || p_size, '\d+'), '') as bigint), 0) as b, p_size::bigint as c from part")
def to_int(spark, d):
    mixed = F.concat("p_brand", "p_name", F.col("p_size").cast("string"))
    return t(spark, d, "part").select("p_partkey", text.to_int(mixed).alias("a"), text.to_int(F.concat("p_brand", F.col("p_size").cast("string")), "only_first_part").alias("b"), text.to_int(F.col("p_size").cast("string"), "strict").alias("c"))


@query(r"select c_custkey, regexp_extract(c_name, '\d+') as a, array_to_string(regexp_extract_all(c_name || '-' || c_custkey, '\d+'), ',') as b from customer")
def find_digits(spark, d):
    return t(spark, d, "customer").select("c_custkey", text.find_digits(F.col("c_name")).alias("a"), F.array_join(text.find_digits(F.concat("c_name", F.lit("-"), F.col("c_custkey").cast("string")), all=True), ",").alias("b"))


@query("select doc_id, md5(coalesce(trim(translate(text, chr(13) || chr(10) || chr(9) || ' ', ''), '\"'), '')) as h from documents")
def clean_string(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.clean_string(F.col("text")).cast("binary")).alias("h"))


@query(r"select doc_id, md5(regexp_replace(text, '[\r\n\t]', '___break___', 'g')) as h from documents")
def replace_chars(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.replace_chars(F.col("text")).cast("binary")).alias("h"))


@query("select p_partkey, p_size % 3 = 0 as only from part")
def only_this_char(spark, d):
    c = F.when(F.col("p_size") % 3 == 0, F.repeat(F.lit("a"), F.col("p_size") % 5 + 1)).otherwise(F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", text.only_this_char(c, "a").alias("only"))


@query(r"""select doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(translate(x, chr(13) || chr(9) || ' ', ''), '"')), lambda x: x <> ''), '; ')) as h from documents""")
def clean_lines(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.clean_lines(F.col("text")).cast("binary")).alias("h"))


@query("select conv_id, turn, len(list_filter(string_split(text, ' '), lambda x: length(x) > 0)) as n from conversations")
def remove_empty(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.size(text.remove_empty(F.split("text", " "))).cast("bigint").alias("n"))


@query("select c_custkey, case c_custkey % 3 when 0 then c_name when 1 then c_mktsegment else '' end as a from customer")
def clean_address(spark, d):
    k = F.col("c_custkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("**"), "c_name", F.lit("（x）"))).when(k == 1, F.concat("c_mktsegment", F.lit("(x)*y"))).otherwise("*")
    return t(spark, d, "customer").select("c_custkey", text.clean_address(raw).alias("a"))


@query("select c_custkey, case when c_custkey % 2 = 0 then c_name else c_mktsegment end as a from customer")
def community_name(spark, d):
    place = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit("\r\nmore"))).otherwise("")
    return t(spark, d, "customer").select("c_custkey", text.community_name(place, F.concat("c_mktsegment", F.lit("小区信息"))).alias("a"))


@query(f"with {CEN} select k, (k % 3 <> 0)::int as count, case when k % 3 <> 0 then {m('x')} end as lng, case when k % 3 <> 0 then {m('y')} end as lat, case when k % 3 <> 0 then 'a' || nation end as adcode from cen")
def parse_geocode(spark, d):
    place = F.when(F.col("k") % 3 == 0, "none").otherwise(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string")))
    one = F.struct(F.concat(F.lit("a"), F.col("nation").cast("string")).alias("adcode"), place.alias("location"))
    body = F.when(F.col("k") % 6 == 3, "broken {").otherwise(F.to_json(F.struct(F.lit("1").alias("count"), F.array(one).alias("geocodes"))))
    g = centers(spark, d).select("k", text.parse_geocode(body).alias("g"))
    return g.select("k", "g.count", micro(F.col("g.lng")).alias("lng"), micro(F.col("g.lat")).alias("lat"), "g.adcode")


@query("select p_partkey, p_size as pages, ceil(p_partkey / 20)::bigint - 1 as last from part")
def page_count(spark, d):
    c = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("共"), F.col("p_size").cast("string"), F.lit("页"))).otherwise(F.concat(F.lit("第1/共"), F.col("p_size").cast("string"), F.lit("页")))
    return t(spark, d, "part").select("p_partkey", text.page_count(c).alias("pages"), text.last_page(F.col("p_partkey"), 20).alias("last"))


@query("select event_id, case when event_id % 5 <> 0 then (event_id % 30)::int end as hi, case when event_id % 5 <> 0 then (event_id % 7)::int end as lo, case when event_id % 5 <> 0 then -(event_id % 7)::int end as signed from events")
def temperature_range(spark, d):
    k = F.col("event_id")
    raw = lambda sign: F.when(k % 5 == 0, "cold").otherwise(F.concat((k % 30).cast("string"), F.lit("~" + sign), (k % 7).cast("string"), F.lit("℃")))
    a, b = text.temperature_range(raw("")), text.temperature_range(raw("-"), signed=True)
    return t(spark, d, "events").select("event_id", a["first"].alias("hi"), a["second"].alias("lo"), b["second"].alias("signed"))


@query("select o_orderkey, strftime(o_orderdate, '%Y%m%d') as good, case when d <= 28 or d = 29 and (y % 4 = 0 and y % 100 <> 0 or y % 400 = 0) then y || '02' || strftime(o_orderdate, '%d') end as feb from (select *, extract(day from o_orderdate) as d, extract(year from o_orderdate) as y from orders)")
def build_date(spark, d):
    o = t(spark, d, "orders")
    y, mo, dy = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    return o.select("o_orderkey", text.build_date(y, mo, dy).alias("good"), text.build_date(y, F.lit(2), dy).alias("feb"))


@query("select event_id, strftime(make_timestamp(event_id * 7919 * 1000000), '%Y%m%d_%H%M%S') as a from events")
def epoch_text(spark, d):
    return t(spark, d, "events").select("event_id", text.epoch_text(F.col("event_id") * 7919).alias("a"))


@query(f"with {PTS} select id, printf('%.6f___%.5f', lng, lat) as key from pts")
def coordinate_key(spark, d):
    return points(spark, d).select("id", text.coordinate_key(F.col("lng"), F.col("lat")).alias("key"))


@query("select c_custkey, 'name___key2value___' || c_name || '___basic___segment___key2value___' || c_mktsegment as packed, c_mktsegment as back from customer")
def pack_pairs(spark, d):
    packed = text.pack_pairs(F.create_map(F.lit("segment"), "c_mktsegment", F.lit("name"), "c_name"))
    return t(spark, d, "customer").select("c_custkey", packed.alias("packed"), text.unpack_pairs(packed)["segment"].alias("back"))


@query("select c_custkey, c_name as name, case when c_custkey % 2 = 0 then c_mktsegment end as segment, (1 + (c_custkey % 2 = 0)::int)::int as n from customer")
def unpack_pairs(spark, d):
    pair = lambda k, c: F.concat(F.lit(f"{k}___key2value___"), c)
    packed = F.concat_ws("___basic___", pair("name", F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, pair("segment", F.col("c_mktsegment"))))
    m = t(spark, d, "customer").select("c_custkey", text.unpack_pairs(packed).alias("m"))
    return m.select("c_custkey", F.try_element_at("m", F.lit("name")).alias("name"), F.try_element_at("m", F.lit("segment")).alias("segment"), F.size("m").alias("n"))


@query("select o_custkey as route, o_orderstatus as direction, o_orderkey as seq, 's' || o_orderkey as stop from orders")
def bus_stops(spark, d):
    o = t(spark, d, "orders")
    g = o.groupBy("o_custkey", "o_orderstatus").agg(F.array_sort(F.collect_list("o_orderkey")).alias("seqs"))
    g = g.withColumn("d", F.struct(F.transform("seqs", lambda x: F.concat(F.lit("s"), x.cast("string"))).alias("names"), "seqs"))
    routes = g.groupBy(F.col("o_custkey").alias("route")).agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "d"))).alias("directions"))
    return records.bus_stops(routes)


@query("select c_custkey, o_orderkey as time, (o_orderkey % 97)::double as price from customer join orders on o_custkey = c_custkey")
def price_series(spark, d):
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(F.concat_ws(",", F.collect_list(F.format_string("[%d,%d]", "o_orderkey", F.col("o_orderkey") % 97))).alias("s"))
    c = t(spark, d, "customer").join(rows, F.col("o_custkey") == F.col("c_custkey"), "left")
    page = F.concat(F.lit('<p>"house","data":['), F.coalesce("s", F.lit("")), F.lit("]</p>"))
    return records.price_series(c.select("c_custkey", page.alias("page")), "page")


@query("select c_custkey, o_orderkey, o_orderstatus from customer left join orders on o_custkey = c_custkey")
def estate_children(spark, d):
    g = t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("buildings"))
    rows = t(spark, d, "customer").join(g, F.col("o_custkey") == F.col("c_custkey"), "left")
    return records.estate_children(rows, "c_custkey", ["buildings"])[0]


@query("select p_partkey, p_size || 'm2' as area, p_brand || ',' || p_name as parts from part")
def area_with_unit(spark, d):
    return t(spark, d, "part").select("p_partkey", text.area_with_unit(F.concat(F.lit(" "), F.col("p_size").cast("string")), F.lit("m2 ")).alias("area"), text.joined(F.array(F.concat(F.lit(" "), "p_brand"), "p_name")).alias("parts"))


@query("select p_partkey, 'g' || p_size as level2, case p_partkey % 3 when 0 then 'r' || p_partkey when 1 then 'c' || p_partkey end as district from part")
def level2_code(spark, d):
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, F.concat(F.lit("r"), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("c"), k.cast("string"))).otherwise("")
    code = F.concat(F.lit("g"), F.col("p_size").cast("string"), tail, F.lit("p12"))
    return t(spark, d, "part").select("p_partkey", text.level2_code(code).alias("x")).select("p_partkey", "x.*")


@query("select s_suppkey, 'guangzhou' as city, 'ch' || s_nationkey as channel, s_name as level2 from supplier")
def category_link(spark, d):
    link = F.concat(F.lit("http://host/guangzhou/ch"), F.col("s_nationkey").cast("string"), F.lit("/"), "s_name")
    return t(spark, d, "supplier").select("s_suppkey", text.category_link(link).alias("x")).select("s_suppkey", "x.*")


@query("select event_id, (event_id % 40)::int as temperature, event_type as weather, (event_id % 100)::int as humidity, null::int as visibility from events")
def hour_readings(spark, d):
    k = F.col("event_id")
    cells = F.array(F.concat((k % 40).cast("string"), F.lit(" C")), F.concat("event_type", F.lit(".")), F.lit("none"), F.concat((k % 100).cast("string"), F.lit("%")), F.lit("1000 mbar"))
    return t(spark, d, "events").select("event_id", text.hour_readings(cells).alias("x")).select("event_id", "x.temperature", "x.weather", "x.humidity", "x.visibility")


# -- urls ----------------------------------------------------------------------------------------


@query(r"select page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') as ref from pages")
def query_params(spark, d):
    q = urls.query_params(F.col("url"), ["page", "ref"])
    return t(spark, d, "pages").select("page_id", F.try_element_at(q, F.lit("page")).alias("page"), F.try_element_at(q, F.lit("ref")).alias("ref"))


@query(r"select page_id, case when len(string_split(h, '.')) = 4 and h like '%.example.com' then string_split(h, '.')[1] else '' end as city from (select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as h from pages)")
def url_city(spark, d):
    return t(spark, d, "pages").select("page_id", urls.url_city(F.col("url"), ".example.com").alias("city"))


@query("select o_orderkey, (o_orderkey % 90)::int as page, 'd' || o_custkey as district_area, case when o_orderkey % 2 = 0 then 3 end as bedrooms, 'http://esf.x.com/house-d' || o_custkey || '/' || case when o_orderkey % 2 = 0 then 'g23/' else '' end as base from orders")
def listing_url_parts(spark, d):
    base = F.concat(F.lit("http://esf.x.com/house-d"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "/g23").otherwise("/"))
    sep = F.when(F.col("o_orderkey") % 2 == 0, "-").otherwise("")
    o = t(spark, d, "orders").withColumn("url", F.concat(base, sep, F.lit("i3"), (F.col("o_orderkey") % 90).cast("string"), F.lit("/")))
    return o.select("o_orderkey", urls.listing_url_parts(F.col("url")).alias("x"), urls.base_page_url(F.col("url")).alias("base")).select("o_orderkey", "x.*", "base")


@query("select o_orderkey, 'http://esf.x.com/house-d' || o_custkey || '/' as base, 'http://esf.x.com/house-d' || o_custkey || '/i3' || o_orderkey % 90 || '/' as page from orders")
def base_page_url(spark, d):
    k = F.col("o_orderkey")
    tail = F.when(k % 3 == 0, "").when(k % 3 == 1, "/").otherwise(F.concat(F.lit("/i3"), (k % 50).cast("string"), F.lit("/")))
    url = F.concat(F.lit("http://esf.x.com/house-d"), F.col("o_custkey").cast("string"), tail)
    return t(spark, d, "orders").select("o_orderkey", urls.base_page_url(url).alias("base"), urls.page_url(url, k % 90).alias("page"))


@query("""select o_orderkey, case o_orderkey % 5 when 0 then o_orderkey % 90 when 1 then 1 when 2 then o_orderkey % 70 + 1 when 3 then 1 else 0 end::int as page,
case o_orderkey % 5 when 0 then 'd' || o_custkey when 3 then 'd' || o_custkey else '' end as district, case when o_orderkey % 5 = 0 then '20_50' else '' end as area from orders""")
def shop_url_parts(spark, d):
    """Lists of a district's page, of a city, of a city's page, of a district, and pages of one shop."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    tails = [F.concat(F.lit("d"), c, F.lit("/shangpucz/pn"), (k % 90).cast("string"), F.lit("/?area=20_50&x=1")), F.lit("shangpu/"), F.concat(F.lit("shangpucz/pn"), (k % 70 + 1).cast("string"), F.lit("/")), F.concat(F.lit("d"), c, F.lit("/shangpu/")), F.concat(F.lit("shangpu/"), k.cast("string"), F.lit("x.shtml"))]
    url = F.concat(F.lit("https://gz.58.com/"), F.element_at(F.array(*tails), (k % 5 + 1).cast("int")))
    return t(spark, d, "orders").select("o_orderkey", urls.shop_url_parts(url).alias("x")).select("o_orderkey", "x.*")


@query("select o_orderkey, case o_orderkey % 5 when 0 then o_orderkey::varchar when 1 then 'e' || o_orderkey when 2 then lpad(o_orderkey::varchar, 14, '3') end as id from orders")
def listing_id(spark, d):
    """Ids of listing urls, of shop urls, of log attributes with parts of 14 characters, of logs without a sort id, and none."""
    n, k = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    url = F.when(n % 5 == 0, F.concat(F.lit("http://x.com/chushou/3_"), k, F.lit(".htm"))).when(n % 5 == 1, F.concat(F.lit("http://x.com/a?q=1&entinfo=e"), k, F.lit("_0"))).otherwise("http://x.com/")
    part = F.lpad(k, 14, "3")
    log = F.when(n % 5 == 2, F.concat(F.lit("z_2_33120284640267_"), part, F.lit("_1_2_sortid:613502485@postdate:1560301497000_12345678901234"))).when(n % 5 == 3, F.concat(F.lit("z_2_"), part))
    return t(spark, d, "orders").select("o_orderkey", urls.listing_id(url, log).alias("id"))


@query("select s_suppkey, p as page, 'http://x.com/' || s_suppkey || '/i3' || p || '/' as page_url from (select s_suppkey, unnest(range(2, s_suppkey % 6 + 1)) as p from supplier)")
def expand_pages(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("http://x.com/"), F.col("s_suppkey").cast("string")).alias("url"), (F.col("s_suppkey") % 6).alias("n"))
    return records.expand_pages(s, "url", "n").select("s_suppkey", "page", "page_url")


@query(f"with {CEN} select k, case when k % 3 < 2 then {m('x')} end as lng, case when k % 3 < 2 then {m('y')} end as lat from cen")
def url_coordinates(spark, d):
    x, y = F.col("x").cast("string"), F.col("y").cast("string")
    raw = F.when(F.col("k") % 3 == 0, F.concat(F.lit("http://a?pointx="), x, F.lit("&pointy="), y)).when(F.col("k") % 3 == 1, F.concat(F.lit("bd_x = "), x, F.lit("; bd_y = "), y, F.lit(";"))).otherwise("http://a")
    c = centers(spark, d).select("k", urls.url_coordinates(raw).alias("p"))
    return c.select("k", micro(F.col("p.lng")).alias("lng"), micro(F.col("p.lat")).alias("lat"))


# -- geography -----------------------------------------------------------------------------------


def _converted(name):
    def run(spark, d):
        p = points(spark, d).withColumn("p", getattr(geo, name)(F.col("lng"), F.col("lat")))
        return p.select("id", micro(F.col("p.lng")).alias("x"), micro(F.col("p.lat")).alias("y"))

    run.__name__ = name
    return run


def _gcj(lng: str, lat: str) -> tuple[str, str]:
    x, y, t_ = f"({lng} - {geo.BD_LNG!r})", f"({lat} - {geo.BD_LAT!r})", repr(geo.TURN)
    z, a = f"(sqrt({x}*{x}+{y}*{y}) - 0.00002*sin({y}*{t_}))", f"(atan2({y}, {x}) - 0.000003*cos({x}*{t_}))"
    return f"{z}*cos({a})", f"{z}*sin({a})"


def _shift(lng: str, lat: str) -> tuple[str, str]:
    x, y, pi = f"({lng} - 105.0)", f"({lat} - 35.0)", repr(math.pi)
    fast = f"(20*sin(6*{x}*{pi}) + 20*sin(2*{x}*{pi}))*2/3"
    north = f"(-100 + 2*{x} + 3*{y} + 0.2*{y}*{y} + 0.1*{x}*{y} + 0.2*sqrt(abs({x})) + {fast} + (20*sin({y}*{pi}) + 40*sin({y}/3*{pi}))*2/3 + (160*sin({y}/12*{pi}) + 320*sin({y}*{pi}/30))*2/3)"
    east = f"(300 + {x} + 2*{y} + 0.1*{x}*{x} + 0.1*{x}*{y} + 0.1*sqrt(abs({x})) + {fast} + (20*sin({x}*{pi}) + 40*sin({x}/3*{pi}))*2/3 + (150*sin({x}/12*{pi}) + 300*sin({x}/30*{pi}))*2/3)"
    r = f"({lat}/180*{pi})"
    b = f"(1 - {geo.FLATNESS!r}*sin({r})*sin({r}))"
    return f"{east}*180/({geo.AXIS!r}/sqrt({b})*cos({r})*{pi})", f"{north}*180/({geo.AXIS!r}*(1 - {geo.FLATNESS!r})/({b}*sqrt({b}))*{pi})"


_E, _N = _shift("lng", "lat")
_PAIRS = {
    "gcj02_to_bd09": f"with {PTS} select id, {m(BD_LNG)} as x, {m(BD_LAT)} as y from pts",
    "bd09_to_gcj02": f"with {PTS} select id, {m(_gcj('lng', 'lat')[0])} as x, {m(_gcj('lng', 'lat')[1])} as y from pts",
    "wgs84_to_gcj02": f"with {PTS} select id, {m(f'lng + {_E}')} as x, {m(f'lat + {_N}')} as y from pts",
    "gcj02_to_wgs84": f"with {PTS} select id, {m(f'lng - {_E}')} as x, {m(f'lat - {_N}')} as y from pts",
    "bd09_to_wgs84": f"with {PTS}, g as (select id, {_gcj('lng', 'lat')[0]} as lng, {_gcj('lng', 'lat')[1]} as lat from pts) select id, {m(f'lng - {_E}')} as x, {m(f'lat - {_N}')} as y from g",
    "wgs84_to_bd09": f"with {PTS}, g as (select id, lng + {_E} as lng, lat + {_N} as lat from pts) select id, {m(BD_LNG)} as x, {m(BD_LAT)} as y from g",
}
for _name, _sql in _PAIRS.items():
    query(_sql)(_converted(_name))


@query("select event_id as id, not (x > 73.66 and x < 135.05 and y > 3.86 and y < 53.55) as outside from (select event_id, 60::double + event_id % 90 as x, event_id % 70 as y from events)")
def outside_china(spark, d):
    k = F.col("event_id")
    return t(spark, d, "events").select(k.alias("id"), geo.outside_china(F.lit(60.0) + k % 90, (k % 70).cast("double")).alias("outside"))


@query(f"with {CEN} select k, {m('x - 0.5 * 0.01167 * 3')} as a, {m('y + 0.5 * 0.009009009 * 3')} as b, {m('x + 0.0292768')} as c, {m('y - 0.027027027')} as d from cen")
def square_around(spark, d):
    x, y = F.col("x"), F.col("y")
    c = centers(spark, d).select("k", geo.square_around(x, y, 3.0).alias("s"), geo.traffic_square(x, y).alias("f"))
    return c.select("k", micro(F.col("s.lng_min")).alias("a"), micro(F.col("s.lat_max")).alias("b"), micro(F.col("f.lng_max")).alias("c"), micro(F.col("f.lat_min")).alias("d"))


@query(f"with {CEN} select k, printf('%.3f,%.3f,%.3f,%.3f', y - 0.5 * 0.009009009 * 3, x - 0.5 * 0.01167 * 3, y + 0.5 * 0.009009009 * 3, x + 0.5 * 0.01167 * 3) as bounds from cen")
def rounded_bounds(spark, d):
    return centers(spark, d).select("k", geo.rounded_bounds(F.col("x"), F.col("y"), 3.0).alias("bounds"))


_DIST = lambda a, b, c, d: f"({geo.EARTH_M!r} * acos(least(greatest(sin(radians({b}))*sin(radians({d})) + cos(radians({b}))*cos(radians({d}))*cos(radians({c} - {a})), -1.0), 1.0)))"


@query(f"with {PTS} select id, cast(floor({_DIST('lng', 'lat', '113.5', '23.0')} + 0.5) as bigint) as metres, {_DIST('lng', 'lat', '113.5', '23.0')} <= 20000 as near from pts")
def distance_m(spark, d):
    p, c = F.struct("lng", "lat"), F.struct(F.lit(113.5).alias("lng"), F.lit(23.0).alias("lat"))
    return points(spark, d).select("id", F.floor(geo.distance_m(p, c) + 0.5).alias("metres"), geo.in_circle(p, c, F.lit(20000.0)).alias("near"))


@query(f"with {PTS} select floor(lng * 10)::bigint as i, count(*) as n, count(*) filter ({_DIST('lng', 'lat', '113.5', '23.0')} <= 30000) as inside from pts group by 1")
def in_circle(spark, d):
    p, c = F.struct("lng", "lat"), F.struct(F.lit(113.5).alias("lng"), F.lit(23.0).alias("lat"))
    near = geo.in_circle(p, c, F.lit(30000.0))
    return points(spark, d).groupBy(F.floor(F.col("lng") * 10).alias("i")).agg(F.count(F.lit(1)).alias("n"), F.count_if(near).alias("inside"))


@query(f"with {PTS}, w as (select user_id, lng, lat, lead(lng) over (partition by user_id order by id) as lng2, lead(lat) over (partition by user_id order by id) as lat2 from pts) select user_id, cast(floor(coalesce(sum({_DIST('lng', 'lat', 'lng2', 'lat2')}) filter (lng2 is not null), 0) / 10 + 0.5) as bigint) as decametres from w group by 1")
def polyline_length_m(spark, d):
    g = points(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("id", "lng", "lat"))).alias("points"))
    return g.select("user_id", F.floor(geo.polyline_length_m(F.col("points")) / 10 + 0.5).alias("decametres"))


def _corner(v: str, w: str) -> dict[str, str]:
    return {"x": f"cos(radians({w})) * cos(radians({v}))", "y": f"cos(radians({w})) * sin(radians({v}))", "z": f"sin(radians({w}))"}


def _cross(a: str, b: str) -> dict[str, str]:
    return {"x": f"({a}y * {b}z - {a}z * {b}y)", "y": f"({a}z * {b}x - {a}x * {b}z)", "z": f"({a}x * {b}y - {a}y * {b}x)"}


_BOX = {"west": f"(x - {geo.LNG_KM!r} * 150)", "east": f"(x + {geo.LNG_KM!r} * 150)", "south": f"(y - {geo.LAT_KM!r} * 150)", "north": f"(y + {geo.LAT_KM!r} * 150)"}
_TURNS = [(("west", "south"), "p"), (("east", "south"), "q"), (("east", "north"), "r"), (("west", "north"), "s")]
_VECTORS = ", ".join(f"{sql} as {n}{axis}" for (v, w), n in _TURNS for axis, sql in _corner(_BOX[v], _BOX[w]).items())
_PLANES = ", ".join(f"{sql} as {p}{q}{axis}" for p, q in ("pq", "qr", "rs", "sp") for axis, sql in _cross(p, q).items())
_DOT = lambda p, q: f"({p}x * {q}x + {p}y * {q}y + {p}z * {q}z)"
_SIZE = lambda p: f"sqrt({_DOT(p, p)})"
_ANGLES = " + ".join(f"acos(-{_DOT(p, q)} / ({_SIZE(p)} * {_SIZE(q)}))" for p, q in (("sp", "pq"), ("pq", "qr"), ("qr", "rs"), ("rs", "sp")))


@query(f"with {CEN}, v as (select k, {_VECTORS} from cen), n as (select k, {_PLANES} from v) select k, cast(floor(({_ANGLES} - 2 * pi()) * {geo.EARTH_M!r} * {geo.EARTH_M!r} / 1000000 + 0.5) as bigint) as km2 from n")
def polygon_area_m2(spark, d):
    """Areas of boxes of 300 km around all centers, in square kilometres; in SQL by the angles between the sides' planes.

    Centers are few bytes and much work each, so they are dealt by number: a file of many would be one task.
    """
    s = joins.dealt(centers(spark, d), "k", rows=20_000).select("k", geo.square_around(F.col("x"), F.col("y"), 300.0).alias("s"))
    corner = lambda a, b: F.struct(F.col(f"s.lng_{a}").alias("lng"), F.col(f"s.lat_{b}").alias("lat"))
    shape_ = F.array(corner("min", "min"), corner("max", "min"), corner("max", "max"), corner("min", "max"))
    return s.select("k", F.floor(geo.polygon_area_m2(shape_) / 1e6 + 0.5).cast("bigint").alias("km2"))


@query(f"with {PTS} select id, abs(0.9 * (lat - 22.5) - (lng - 113) * 0.9) < 2e-10 and lng between 113 and 113.9 and lat between 22.5 and 23.4 as \"on\" from pts")
def on_polyline(spark, d):
    corner = lambda x, y: F.struct(F.lit(x).alias("lng"), F.lit(y).alias("lat"))
    line = F.array(corner(113.0, 22.5), corner(113.9, 23.4))
    return points(spark, d).select("id", geo.on_polyline(F.struct("lng", "lat"), line).alias("on"))


@query(f"with {CEN} select k, {m('x + (i - 1.5) * 0.01167 * 2 / 4')} as x, {m('y + (j - 1.5) * 0.009009009 * 2 / 4')} as y from cen, range(4) a(i), range(4) b(j)")
def subdivide_4x4(spark, d):
    return grids.subdivide_4x4(centers(spark, d), 2.0).select("k", micro(F.col("sub_x")).alias("x"), micro(F.col("sub_y")).alias("y"))


@query(f"with {CEN} select k, {m('x + i * 0.001')} as x, {m('y + j * 0.001')} as y from cen, range(3) a(i), range(2) b(j)")
def subdivide_step(spark, d):
    c = centers(spark, d).select("k", F.col("x").alias("lng_min"), F.col("y").alias("lat_min"), (F.col("x") + 0.0034).alias("lng_max"), (F.col("y") + 0.0026).alias("lat_max"))
    return grids.subdivide_step(c).select("k", micro(F.col("x")).alias("x"), micro(F.col("y")).alias("y"))


_SX, _SY = 0.01167 * 2 / 4, 0.009009009 * 2 / 4
_SIDE = lambda c, s, sign: f"round({c} {sign} {0.6 * s!r}, 3)"


@query(f"""with {CEN}, a as (select x, y, floor(x * 1000 + 0.5)::bigint % 900 as total from cen),
b as (select *, floor(x * 1000 + 0.5)::bigint % 900 as total from (select x + (i - 1.5) * {_SX!r} as x, y + (j - 1.5) * {_SY!r} as y from a, range(4) p(i), range(4) q(j) where total >= 400)),
s as (select {_SIDE('x', _SX, '-')} as x0, {_SIDE('x', _SX, '+')} as x1, {_SIDE('y', _SY, '-')} as y0, {_SIDE('y', _SY, '+')} as y1 from b where total >= 400),
c as (select *, floor(x * 1000 + 0.5)::bigint % 900 as total from (select x0 + i * 0.001::double as x, y0 + j * 0.001::double as y from (select x0, y0, unnest(range(floor(round((x1 - x0) / 0.001::double, 6))::bigint)) as i, floor(round((y1 - y0) / 0.001::double, 6))::bigint as ny from s), lateral (select unnest(range(ny)) as j))),
u as (select 1 as round, * from a where total < 400 union all select 2, * from b where total < 400 union all select 3, * from c)
select round, count(*) as n, count(*) filter (total >= 400) as n_over, sum(floor(x * 1e5 + 0.5)::bigint)::bigint as sum_x, sum(floor(y * 1e5 + 0.5)::bigint)::bigint as sum_y from u group by round""")
def adaptive_plan(spark, d):
    """All centers: over the cap into 16, then by steps of 0.001 degrees; the third round is accepted."""
    totals = lambda df: df.withColumn("total", F.floor(F.col("x") * 1000 + 0.5) % 900)
    out = grids.adaptive_plan(centers(spark, d), totals)
    return out.groupBy("round").agg(F.count(F.lit(1)).alias("n"), F.count_if("over").alias("n_over"), *(F.sum(F.floor(F.col(c) * 1e5 + 0.5)).alias(f"sum_{c}") for c in "xy"))


_LISTS = "o as (select c_nationkey::varchar as a, c_nationkey || '_' || c_mktsegment as b, c_nationkey || '_' || c_mktsegment || '_' || o_orderstatus as c from orders join customer on c_custkey = o_custkey), na as (select a, count(*) as n from o group by a), nb as (select a, b, count(*) as n from o group by a, b), nc as (select b, c, count(*) as n from o group by b, c)"


@query(f"with {_LISTS} select a as list, n as pages, 0 as level, false as over from na where n <= 99 union all select nb.b, nb.n, 1, false from nb join na using (a) where na.n > 99 and nb.n <= 99 union all select nc.c, nc.n, 2, nc.n > 99 from nc join nb using (b) join na using (a) where nb.n > 99 and na.n > 99")
def escalate_lists(spark, d):
    """Lists of orders by nation, by nation and segment where those are over 99, and then by status too."""
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    keys = [F.concat_ws("_", *cols) for cols in (["c_nationkey"], ["c_nationkey", "c_mktsegment"], ["c_nationkey", "c_mktsegment", "o_orderstatus"])]
    count = lambda *cols: o.groupBy(*cols).agg(F.count(F.lit(1)).alias("pages"))
    below = [count(keys[k - 1].alias("parent"), keys[k].alias("list")) for k in (1, 2)]
    return grids.escalate_lists(count(keys[0].alias("list")), below)


@query(f"""with {PTS}, e as (select {m('min(lng)')} as x1, {m('max(lng)')} as x2, {m('min(lat)')} as y1, {m('max(lat)')} as y2 from pts),
a as (select unnest(range(trunc((x1 - 113264000) / 5000)::bigint - 1, trunc((x2 - 113264000) / 5000)::bigint + 2)) as i, y1, y2 from e),
b as (select i, unnest(range(trunc((y1 - 23129000) / 4500)::bigint - 1, trunc((y2 - 23129000) / 4500)::bigint + 2)) as j from a)
select 113264000 + i * 5000 as x0, 23129000 + j * 4500 as y0 from b""")
def make_grid(spark, d):
    e = points(spark, d).agg(*(micro(f(c)).alias(f"{n}_{k}") for c, n in (("lng", "x"), ("lat", "y")) for k, f in (("min", F.min), ("max", F.max))))
    return grids.make_grid(e, (113264000, 23129000), (5000, 4500)).select("x0", "y0")


@query("select s_suppkey, x, y from (select s_suppkey, unnest(range(least(s_nationkey, (s_suppkey % 9)::int), greatest(s_nationkey, (s_suppkey % 9)::int) + 1)) as x from supplier) a cross join range(3, 6) b(y)")
def tiles_in_range(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("x1"), (F.col("s_suppkey") % 9).cast("int").alias("x2"), F.lit(5).alias("y1"), F.lit(3).alias("y2"))
    return grids.tiles_in_range(s).select("s_suppkey", "x", "y")


@query(f"with {CEN} select k, {m('0.0256 / (256 * (k % 5 + 1)) * 1000')} as dx, {m('0.0512 / (256 * (k % 7 + 1)) * 1000')} as dy, {m('x - 0.0256 / (k % 5 + 1) * 3')} as lng0, {m('y - 0.0512 / (k % 7 + 1) * 2')} as lat0 from cen")
def calibrate_tiles(spark, d):
    """Two known points per center: one at the corner of tile (3, 2), the other some tiles to the north-east."""
    k, zero = F.col("k"), F.lit(0)
    ref = {"ax": F.lit(3), "ay": F.lit(2), "apx": zero, "apy": zero, "alng": F.col("x"), "alat": F.col("y"), "bx": 4 + k % 5, "by": 3 + k % 7, "bpx": zero, "bpy": zero, "blng": F.col("x") + 0.0256, "blat": F.col("y") + 0.0512}
    c = grids.calibrate_tiles(centers(spark, d).withColumns(ref))
    return c.select("k", micro(F.col("dx") * 1000).alias("dx"), micro(F.col("dy") * 1000).alias("dy"), micro(F.col("lng0")).alias("lng0"), micro(F.col("lat0")).alias("lat0"))


@query(f"with {CEN} select k, floor(floor((x + 1e-7 - 113) / 0.00001) / 256)::bigint as x, floor(floor((y + 1e-7 - 22.5) / 0.00001) / 256)::bigint as y from cen")
def point_to_tile(spark, d):
    ref = centers(spark, d).withColumns({"ax": F.lit(0), "ay": F.lit(0), "apx": F.lit(0), "apy": F.lit(0), "alng": F.lit(113.0), "alat": F.lit(22.5), "bx": F.lit(10), "by": F.lit(10), "bpx": F.lit(0), "bpy": F.lit(0), "blng": F.lit(113.0) + 0.0256, "blat": F.lit(22.5) + 0.0256})
    c = grids.calibrate_tiles(ref).withColumn("t", grids.point_to_tile(F.col("x") + 1e-7, F.col("y") + 1e-7, *(F.round(c, 9) for c in ("dx", "dy")), *(F.round(c, 6) for c in ("lng0", "lat0"))))
    return c.select("k", F.col("t.x").alias("x"), F.col("t.y").alias("y"))


# -- pages ---------------------------------------------------------------------------------------


def linked_pages(spark, d):
    """All pages; links of their menus become relative ones, links without a scheme, or stay, by their first letter."""
    p = t(spark, d, "pages").select("page_id", "url", "html")
    for first, new in (("a-f", "href='../$1'"), ("g-m", "href='$1'"), ("A-M", 'href="//cdn.x.org/$1"')):
        p = p.withColumn("html", F.regexp_replace("html", f'href="/([{first}][a-z]*)"', new))
    return p


@query(r"""with a as (select page_id, url, regexp_extract(url, '^([a-z]+):', 1) as scheme, regexp_extract(url, '^[a-z]+://[^/?#]+', 0) as site, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '[^/]*$', '') as dir,
unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), 'href="/([^"]*)"', 1)) as t from pages)
select page_id, case when regexp_matches(t, '^[a-f][a-z]*$') then site || coalesce(nullif(regexp_replace(dir, '[^/]+/$', ''), ''), '/') || t
when regexp_matches(t, '^[g-m][a-z]*$') then site || coalesce(nullif(dir, ''), '/') || t
when regexp_matches(t, '^[A-M][a-z]*$') then scheme || '://cdn.x.org/' || t else site || '/' || t end as link from a""")
def page_links(spark, d):
    return pages.page_links(linked_pages(spark, d), "html", "url", ("nav", None, None)).select("page_id", "link")


def listing_pages(spark, d):
    """A listing page per customer with its orders as cards and rows; some cards lack a field, some pages a layout."""
    o = joins.dealt(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_custkey", rows=100_000)
    card = F.concat(F.lit('<div class="card x"><h3>'), F.col("o_orderkey").cast("string"), F.lit("</h3>"), F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("<b class=st>"), "o_orderstatus", F.lit("</b>"))).otherwise(""), F.lit("</div>"))
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("<td> "), "o_orderstatus", F.lit("</tr>"))
    g = o.groupBy(F.col("o_custkey").alias("k")).agg(F.concat_ws("", F.collect_list(card)).alias("cards"), F.concat_ws("", F.collect_list(row)).alias("rows"))
    title = F.when(F.col("k") % 2 == 0, F.concat(F.lit('<h1 id="t">T'), F.col("k").cast("string"), F.lit("</h1>"))).otherwise(F.concat(F.lit('<p class="alt">A'), F.col("k").cast("string")))
    return g.select("k", F.concat(F.lit("<html><body>"), title, F.lit("<dl><li><i>Label: </i><em>V &amp; "), F.col("k").cast("string"), F.lit('</em></dl><div data-hid="'), F.col("k").cast("string"), F.lit('">'), "cards", F.lit("<table><tr><th>a<th>b</tr>"), "rows", F.lit("</table></body>")).alias("html"))


@query("select o_custkey as k, case when o_custkey % 2 = 0 then 'T' || o_custkey else 'A' || o_custkey end as title from orders group by 1")
def page_fallback(spark, d):
    rows = pages.page_fallback(listing_pages(spark, d), "html", {"title": ("h1", "id", "t")}, {"title": ("p", "class", "alt")})
    return rows.select("k", F.regexp_extract("title", r"^[AT]\d+", 0).alias("title"))  # the second layout's paragraph is not closed


@query("select o_custkey as k, case when o_custkey % 2 = 0 then 'T' || o_custkey else '' end as title, '' as absent from orders group by 1")
def page_fields(spark, d):
    return pages.page_fields(listing_pages(spark, d), "html", {"title": ("h1", "id", "t"), "absent": ("h4", None, None)})


@query("select o_custkey as k, 'V & ' || o_custkey as label from orders group by 1")
def page_pairs(spark, d):
    rows = pages.page_pairs(listing_pages(spark, d), "html", ("li", None, None), ("i", None, None), ("em", None, None))
    return rows.select("k", F.try_element_at("pairs", F.lit("Label")).alias("label"))


@query("select o_custkey as k, o_orderkey::varchar as id, o_orderstatus as status from orders where o_orderkey % 5 <> 0")
def page_cards(spark, d):
    return pages.page_cards(listing_pages(spark, d), "html", ("div", "class", "card"), {"id": ("h3", None, None), "status": ("b", "class", "st")})


@query("select o_custkey as k, o_orderkey::varchar as id, o_orderstatus as status from orders")
def page_tables(spark, d):
    rows = pages.page_tables(listing_pages(spark, d), "html", width=2)
    return rows.select("k", F.col("cells")[0].alias("id"), F.col("cells")[1].alias("status"))


@query("select o_custkey as k, o_custkey::varchar as hid from orders group by 1")
def embedded_ids(spark, d):
    return pages.embedded_ids(listing_pages(spark, d), "html", "data-hid")


@query(r"select page_id || '.html' as file, length(regexp_replace(coalesce(html, ''), '[^\x01-\x7F]', '', 'g')) + 2 as n, md5(regexp_replace(coalesce(html, ''), '[^\x01-\x7F]', '', 'g') || '城市') as digest from pages")
def read_html_dir(spark, d):
    """A file per page in GB 2312, with a byte that the charset lacks; read back as text."""
    path = files.work_path(spark, "html")
    plain = F.regexp_replace(F.coalesce("html", F.lit("")), r"[^\x01-\x7F]", "").cast("binary")
    rows = t(spark, d, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("file"), F.concat(plain, F.unhex(F.lit("FF" + "城市".encode("gb2312").hex()))).alias("content"))
    files.write_responses(rows, path, "file", "content")
    return files.read_html_dir(spark, path).select("file", F.length("html").cast("bigint").alias("n"), F.md5(F.col("html").cast("binary")).alias("digest"))
