"""Column functions on urls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def query_params(c: Column, keys: Sequence[str] | None = None) -> Column:
    """Query string as a map; commas become underscores; optionally some keys only."""
    pairs = F.filter(F.split(F.regexp_extract(c, r"\?([^#]*)", 1), "&"), lambda x: x.contains("="))
    names = F.array_distinct(F.transform(pairs, lambda x: F.substring_index(x, "=", 1)))
    if keys is not None:
        names = F.array_intersect(names, F.array(*map(F.lit, keys)))
    value = lambda k: F.translate(F.regexp_replace(F.element_at(F.filter(pairs, lambda x: F.substring_index(x, "=", 1) == k), 1), "^[^=]*=", ""), ",", "_")
    return F.map_from_entries(F.transform(names, lambda k: F.struct(k, value(k))))


def url_host(c: Column) -> Column:
    return F.regexp_extract(c, r"^[a-z]+://([^/?#:]+)", 1)


def url_city(c: Column, suffix: str, labels: int = 4) -> Column:
    """First label of a host with the suffix and that many labels, else ""."""
    host = url_host(c)
    parts = F.split(host, r"\.")
    return F.when(host.endswith(suffix) & (F.size(parts) == labels), parts[0]).otherwise("")


def listing_url_parts(c: Column) -> Column:
    """Path to struct(page, district_area, bedrooms): iN part, first plain part, gN part."""
    path = F.regexp_extract(c, r"^[a-z]+://[^/?#]+(/[^?#]*)?", 1)
    return F.struct(
        _some(F.regexp_extract(path, r"(?:/|-)i3(\d+)", 1)).try_cast("int").alias("page"),
        F.regexp_extract(path, r"^/(?:house-?)?([a-z0-9_-]*?)/", 1).alias("district_area"),
        _some(F.regexp_extract(path, r"(?:/|-)g2(\d+)", 1)).try_cast("int").alias("bedrooms"),
    )


def shop_url_parts(c: Column) -> Column:
    """Shop list url to struct(page, district, area): the pnN part (1 without one), the only other part, the query's area.

    A page of one shop (.shtml) has page 0 and no district.
    """
    parts = F.filter(F.split(F.regexp_extract(c, r"^[a-z]+://[^/?#]+(/[^?#]*)?", 1), "/"), lambda x: x != "")
    other = F.filter(parts, lambda x: ~x.contains("shangpu") & ~x.contains("pn"))
    number = F.regexp_extract(F.try_element_at(F.filter(parts, lambda x: x.contains("pn")), F.lit(-1)), r"(\d+)", 1).try_cast("int")
    detail = F.exists(parts, lambda x: x.contains(".shtml"))
    return F.struct(
        F.when(detail, 0).otherwise(F.coalesce(number, F.lit(1))).alias("page"),
        F.when(~detail & (F.size(other) == 1), F.get(other, F.lit(0))).otherwise("").alias("district"),
        F.regexp_extract(c, r"[?&]area=([^&#]*)", 1).alias("area"),
    )


def base_page_url(c: Column) -> Column:
    """Without the page part, with one closing slash."""
    return F.concat(F.rtrim(F.regexp_replace(c, r"-?i3\d+/?$", ""), F.lit("/")), F.lit("/"))


def page_url(c: Column, n: Column) -> Column:
    return F.concat(base_page_url(c), F.lit("i3"), n.cast("string"), F.lit("/"))


def listing_id(c: Column, log: Column | None = None) -> Column:
    """Digits after _ before .htm; else the part of the query's entinfo before _; else, with a log attribute, its last
    part of 14 characters before (or at) its last part that begins with sortid; else null."""
    found = [_some(F.regexp_extract(c, r"_(\d+)\.htm", 1)), _some(F.regexp_extract(c, r"[?&]entinfo=([^_&#]+)", 1))]
    if log is not None:
        parts = F.split(log, "_")
        back = F.array_position(F.reverse(F.transform(parts, lambda x: x.startswith("sortid"))), True)
        seen = F.when(back > 0, F.slice(parts, F.lit(1), F.size(parts) - back.cast("int") + 1))
        found.append(F.try_element_at(F.filter(seen, lambda x: F.length(x) == 14), F.lit(-1)))
    return F.coalesce(*found)


def url_coordinates(c: Column) -> Column:
    """struct(lng, lat) from pointx/pointy, longitude/latitude or bd_x/bd_y."""
    n = r"\s*=\s*(-?\d+(?:\.\d+)?)"
    pick = lambda names: F.coalesce(*(_some(F.regexp_extract(c, rf"\b{x}{n}", 1)).try_cast("double") for x in names))
    return F.struct(pick(("pointx", "longitude", "bd_x")).alias("lng"), pick(("pointy", "latitude", "bd_y")).alias("lat"))
