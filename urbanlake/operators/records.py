"""Child tables of nested listing records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def expand_pages(df: DataFrame, url: str, n: str, first: int = 2, out: str = "page_url") -> DataFrame:
    """One row per page url from ``first`` to the number of pages."""
    rows = df.withColumn("page", F.explode(F.when(F.col(n) >= first, F.sequence(F.lit(first), F.col(n).cast("int")))))
    return rows.withColumn(out, urls.page_url(F.col(url), F.col("page")))


def bus_stops(df: DataFrame, directions: str = "directions") -> DataFrame:
    """(others, direction, seq, stop) from a map direction to struct(names, seqs); none if their lengths differ."""
    others = [c for c in df.columns if c != directions]
    rows = df.select(*others, F.explode(directions).alias("direction", "d")).filter(F.size("d.names") == F.size("d.seqs"))
    rows = rows.select(*others, "direction", F.explode(F.arrays_zip(F.col("d.names").alias("names"), F.col("d.seqs").alias("seqs"))).alias("z"))
    return rows.select(*others, "direction", F.col("z.seqs").alias("seq"), F.col("z.names").alias("stop"))


def price_series(df: DataFrame, c: str) -> DataFrame:
    """(others, time, price) of the first "data":[[t,v],…] in a text; texts without one give no rows."""
    text = F.regexp_extract(c, r'"data":\s*(\[\[.*?\]\])', 1)
    rows = df.withColumn("_p", F.explode(F.from_json(text, "array<array<double>>"))).drop(c)
    return rows.withColumns({"time": F.col("_p")[0].cast("bigint"), "price": F.col("_p")[1]}).drop("_p")


def estate_children(df: DataFrame, key: str, children: Sequence[str] = ("buildings", "permits", "openings")) -> tuple[DataFrame, ...]:
    """A table per child array of structs, with the record's key; records without a child keep one null row."""
    return tuple(df.select(key, F.explode_outer(c).alias("_c")).select(key, "_c.*") for c in children)


def cells_to_table(df: DataFrame, cells: str, names: Sequence[str]) -> DataFrame:
    """Cell arrays to named columns; missing cells are null."""
    return df.select(*(c for c in df.columns if c != cells), *(F.try_element_at(cells, F.lit(i + 1)).alias(n) for i, n in enumerate(names)))


def packed_tags(c: Column) -> Column:
    return F.array_join(c, "___tags___")
