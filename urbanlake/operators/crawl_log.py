"""Reports on a crawl from its raw log lines: requests by kind, further pages of each list, and what was never answered."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import aggs

#: Kinds that the rules below tell apart; a log's labels map texts of its lines to these or other names.
FIRST, DETAIL = "start_list_request", "start_detailed_request"


def line_url(line: Column) -> Column:
    """What follows the first https:// of a line, that included, without slashes at the end ("" without one)."""
    at = F.locate("https://", line)
    return F.when(at > 0, F.rtrim(F.substr(line, at), F.lit("/"))).otherwise("")


def first_page(url: Column) -> Column:
    """A further page's url cut before its ``i3`` and the sign before that; other urls stay."""
    at = F.locate("i3", url)
    return F.when(at > 0, F.substr(url, F.lit(1), F.greatest(at - 2, F.lit(0)))).otherwise(url)


def log_requests(lines: DataFrame, line: str, labels: Mapping[str, str]) -> DataFrame:
    """(kind, url, list, page, error): a row for each label that a line contains.

    ``labels`` maps a text to its kind. A detail request without ``.htm`` is a list request: a further page if its
    last part has ``i3`` (``page`` is that url, ``list`` its first page), else an error. First pages have no page.
    """
    hits = F.filter(F.array(*(F.when(F.col(line).contains(text), F.lit(kind)) for text, kind in labels.items())), lambda x: x.isNotNull())
    rows = lines.select(F.col(line).alias("_line"), F.explode(hits).alias("_kind")).withColumn("url", line_url(F.col("_line")))
    further = (F.col("_kind") == DETAIL) & ~F.col("_line").contains(".htm")
    numbered = further & F.element_at(F.split("_line", "/"), -1).contains("i3")
    return rows.select(
        F.when(further, FIRST).otherwise(F.col("_kind")).alias("kind"), "url",
        F.when(numbered, first_page(F.col("url"))).when(F.col("_kind") == FIRST, F.col("url")).alias("list"),
        F.when(numbered, F.col("url")).alias("page"), (further & ~numbered).alias("error"),
    )


def requests_by_kind(lines: DataFrame, line: str, labels: Mapping[str, str]) -> DataFrame:
    """(kind, n): a line counts once for each of its labels."""
    return log_requests(lines, line, labels).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def requested_lists(lines: DataFrame, line: str, labels: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Per first page the number of further pages requested (list, pages); and further pages of unknown lists, counted in the same way."""
    rows = log_requests(lines, line, labels).filter(F.col("list").isNotNull())
    return aggs.pages_per_list(rows, "list", "page")


def unanswered_lists(lists: DataFrame, answered: DataFrame, url: str) -> tuple[DataFrame, DataFrame]:
    """From (list, pages) and the urls that were answered: (list, unanswered, silent), and (url, n) of unknown urls.

    ``unanswered`` is requested minus answered further pages, ``silent`` a first page without an answer. A url with
    ``i3`` is a further page; those of a list that isn't known are no errors in the log's own check, and count
    for nothing, while a url without it is unknown unless it is a first page.
    """
    urls = answered.select(F.rtrim(F.col(url), F.lit("/")).alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    firsts = lists.select(F.col("list").alias("url"))
    further = urls.filter(F.col("url").contains("i3")).join(firsts, "url", "left_anti")
    more = further.groupBy(first_page(F.col("url")).alias("list")).agg(F.sum("n").alias("_n"))
    heads = urls.select(F.col("url").alias("list"), F.lit(True).alias("_seen"))
    out = lists.join(more, "list", "left").join(heads, "list", "left")
    out = out.select("list", (F.col("pages") - F.coalesce("_n", F.lit(0))).alias("unanswered"), F.col("_seen").isNull().alias("silent"))
    return out, urls.filter(~F.col("url").contains("i3")).join(firsts, "url", "left_anti")
