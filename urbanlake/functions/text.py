"""Column functions on text, numbers and dates. Malformed input gives null (or the stated default), never an error."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ADDRESS_END = "（(*"
KV, SEP = "___key2value___", "___basic___"


def _class(chars: str) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def to_int(c: Column, strategy: str = "match_all_digits") -> Column:
    """Text to bigint: all digits joined, the first run of digits (0 without any), or pure digits only (else null)."""
    if strategy == "match_all_digits":
        return F.when(c.isNotNull(), F.coalesce(F.nullif(F.regexp_replace(c, r"\D", ""), F.lit("")).try_cast("bigint"), F.lit(0)))
    if strategy == "only_first_part":
        return F.when(c.isNotNull(), F.coalesce(F.nullif(F.regexp_extract(c, r"\d+", 0), F.lit("")).try_cast("bigint"), F.lit(0)))
    if strategy == "strict":
        return F.when(c.rlike(r"^\d+$"), c.try_cast("bigint"))
    raise ValueError(strategy)


def find_digits(c: Column, all: bool = False) -> Column:
    """First run of digits ("" if none), or the array of all runs."""
    return F.regexp_extract_all(c, F.lit(r"(\d+)"), 1) if all else F.regexp_extract(c, r"\d+", 0)


def clean_string(c: Column, chars: str = "\r\n\t ") -> Column:
    """Remove the characters everywhere and double quotes at both ends; null gives ""."""
    return F.coalesce(F.btrim(F.translate(c, chars, ""), F.lit('"')), F.lit(""))


def replace_chars(c: Column, chars: str = "\r\n\t", token: str = "___break___") -> Column:
    return F.regexp_replace(c, _class(chars), token)


def only_this_char(c: Column, ch: str) -> Column:
    """Whether a text is not empty and made of one character alone."""
    return (F.length(c) > 0) & (F.length(F.replace(c, F.lit(ch), F.lit(""))) == 0)


def clean_lines(c: Column, chars: str = "\r\t ") -> Column:
    """Lines cleaned, empty ones dropped, joined by "; "."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), lambda x: clean_string(x, chars)), lambda x: x != ""), "; ")


def remove_empty(c: Column) -> Column:
    return F.filter(c, lambda x: F.length(x) > 0)


def clean_address(c: Column) -> Column:
    """Trim stars, then cut at the first bracket or star."""
    return F.regexp_extract(F.btrim(c, F.lit("*")), f"^[^{ADDRESS_END}]*", 0)


def community_name(location: Column, title: Column) -> Column:
    """The location's name up to a carriage return, else the title without its suffix."""
    return F.coalesce(F.nullif(F.substring_index(location, "\r", 1), F.lit("")), F.replace(title, F.lit("小区信息"), F.lit("")))


def parse_geocode(c: Column) -> Column:
    """Response text to struct(count, lng, lat, adcode, district) of its first geocode."""
    row = F.from_json(c, "count string, geocodes array<struct<adcode string, district string, location string>>")
    first = F.try_element_at(row["geocodes"], F.lit(1))
    parts = F.split(first["location"], ",")
    good = F.coalesce(F.size(parts) == 2, F.lit(False))
    number = lambda i: F.when(good, F.get(parts, F.lit(i)).try_cast("double"))
    return F.struct(F.when(good, 1).otherwise(0).alias("count"), number(0).alias("lng"), number(1).alias("lat"), F.when(good, first["adcode"]).alias("adcode"), F.when(good, first["district"]).alias("district"))


def page_count(c: Column) -> Column:
    """Pages from a text like 共N页 or 共a/共N页."""
    return F.nullif(F.regexp_extract(c, r"共(\d+)页", 1), F.lit("")).try_cast("int")


def last_page(total: Column, page_size: int) -> Column:
    """Zero-based number of the last page."""
    return (F.ceil(total / page_size) - 1).cast("bigint")


def temperature_range(c: Column, signed: bool = False) -> Column:
    """"a~b" to struct(max, min) in text order; nulls without both."""
    n = r"(-?\d+)" if signed else r"(\d+)"
    pick = lambda i: F.nullif(F.regexp_extract(c, f"{n}~{n}", i), F.lit("")).try_cast("int")
    return F.struct(pick(1).alias("first"), pick(2).alias("second"))


def build_date(year: Column, month: Column, day: Column) -> Column:
    """yyyyMMdd, or null if there is no such day."""
    text = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.date_format(F.try_to_timestamp(text, F.lit("yyyyMMdd")), "yyyyMMdd")


def epoch_text(c: Column, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    """Epoch seconds as text in the session's time zone."""
    return F.date_format(F.timestamp_seconds(c), fmt)


def coordinate_key(x: Column, y: Column, dx: int = 6, dy: int = 5, sep: str = "___") -> Column:
    return F.format_string(f"%.{dx}f{sep}%.{dy}f", x.cast("double"), y.cast("double"))


def pack_pairs(m: Column, kv: str = KV, sep: str = SEP) -> Column:
    """A map as text, in key order."""
    rows = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(rows, lambda r: F.concat(r["key"], F.lit(kv), r["value"])), sep)


def unpack_pairs(c: Column, kv: str = KV, sep: str = SEP) -> Column:
    """The inverse of pack_pairs; pairs without a value are dropped, of a repeated key the last stays."""
    parts = F.filter(F.transform(F.split(c, re.escape(sep)), lambda x: F.split(x, re.escape(kv))), lambda a: F.size(a) == 2)
    keys = F.array_distinct(F.transform(parts, lambda a: a[0]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(parts, lambda a: a[0] == k), -1)[1])))


def area_with_unit(number: Column, unit: Column) -> Column:
    return F.concat(F.trim(number), F.trim(unit))


def joined(c: Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(c, lambda x: F.trim(x)), sep)


def level2_code(c: Column) -> Column:
    """Category code to struct(level2, district): a trailing page is cut, then it splits at r, else at c."""
    base = F.regexp_replace(c, r"p\d+$", "")
    letter = F.when(base.contains("r"), "r").when(base.contains("c"), "c")
    parts = F.split(base, F.coalesce(letter, F.lit("\x00")))
    return F.struct(parts[0].alias("level2"), F.when(letter.isNotNull(), F.concat(letter, F.get(parts, F.lit(1)))).alias("district"))


def category_link(c: Column) -> Column:
    """The last three parts of a path: struct(city, channel, level2)."""
    parts = F.split(c, "/")
    return F.struct(*(F.try_element_at(parts, F.lit(i)).alias(n) for i, n in ((-3, "city"), (-2, "channel"), (-1, "level2"))))


def hour_readings(cells: Column) -> Column:
    """A row of cells: temperature, weather, comfort, humidity, pressure, visibility."""
    at = lambda i: F.try_element_at(cells, F.lit(i))
    digits = lambda i: F.nullif(F.regexp_extract(at(i), r"\d+", 0), F.lit("")).try_cast("int")
    return F.struct(digits(1).alias("temperature"), F.replace(at(2), F.lit("."), F.lit("")).alias("weather"), digits(3).alias("comfort"), digits(4).alias("humidity"), digits(5).alias("pressure"), digits(6).alias("visibility"))
