"""URL filtering against dated lists, by a temporal join.

List entries come as dated events (added, removed). They become validity
intervals, and every capture is judged by the entries that were active when it
was fetched. A URL is looked up by its host and all parent domains, by host and
path prefix, and as a whole.

Captures are reduced to distinct (key, date) pairs before the join, so a host
with very many captures costs one row a day, and each pair meets only the
intervals of its own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

_AUTHORITY = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), _AUTHORITY, 1), r"\.$", "")


def validity_intervals(events: DataFrame) -> DataFrame:
    """``list_name, pattern, valid_from, valid_to`` from ``list_name, pattern,
    event_date, action`` (``add`` or ``remove``).

    An entry is valid from the day it is added, and no longer on the day it is
    removed; on a day with both, the removal counts. Further additions while it is
    valid change nothing; without a removal ``valid_to`` is null."""
    days = events.where(F.col("event_date").isNotNull() & F.col("pattern").isNotNull()
                        & F.col("action").isin("add", "remove")) \
        .groupBy("list_name", "pattern", "event_date") \
        .agg(F.max((F.col("action") == "remove").cast("int")).alias("gone"))
    order = Window.partitionBy("list_name", "pattern").orderBy("event_date")
    turns = days.withColumn("was", F.lag("gone").over(order)) \
        .where((F.coalesce("was", F.lit(1)) != F.col("gone"))) \
        .withColumn("valid_to", F.lead("event_date").over(order))
    return turns.where("gone = 0").select("list_name", "pattern", F.col("event_date").alias("valid_from"), "valid_to")


def url_keys(url: Column) -> Column:
    """All patterns that can match a URL: ``host:`` for the host and its parents,
    ``path:`` for host and path prefixes, ``url:`` for the URL without fragment."""
    host = url_host(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parents = F.transform(labels, lambda _, i: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))
    steps = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda x: x != "")
    prefixes = F.transform(steps, lambda _, i: F.concat(
        F.lit("path:"), host, F.lit("/"), F.array_join(F.slice(steps, 1, i + 1), "/")))
    whole = F.array(F.concat(F.lit("url:"), F.regexp_replace(url, "#.*$", "")))
    return F.array_distinct(F.concat(parents, prefixes, whole))


def filter_urls(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``page_id, host, fetch_date, verdict, n_lists, list_name, pattern, valid_from``
    for every row of ``captures`` (``page_id, url, fetch_date``).

    ``verdict`` is ``blocked`` when an entry was active on the fetch date, else
    ``allowed``; the entry shown is the first by list, pattern and start. A capture
    without URL or date matches nothing and is allowed. Entries without a list name are
    one list, shown only where no named list hits. Repeated rows are kept; an
    empty list blocks nothing; other columns are ignored."""
    rows = captures.select(F.col("page_id").cast("long").alias("page_id"), "url", "fetch_date")
    urls = rows.where("url IS NOT NULL AND fetch_date IS NOT NULL").select("url", "fetch_date").distinct()
    keyed = stored(urls.select("url", "fetch_date", F.explode(url_keys(F.col("url"))).alias("pattern")), "url-keys")
    intervals = stored(validity_intervals(events), "url-intervals")
    asked = keyed.select("pattern", "fetch_date").distinct()
    active = stored(asked.join(intervals, "pattern").where(
        (F.col("valid_from") <= F.col("fetch_date"))
        & (F.col("valid_to").isNull() | (F.col("fetch_date") < F.col("valid_to"))))
        .select("pattern", "fetch_date", "list_name", "valid_from"), "url-active")
    found = stored(keyed.join(active, ["pattern", "fetch_date"]).groupBy("url", "fetch_date").agg(
        (F.count_distinct("list_name") + F.max(F.col("list_name").isNull().cast("long"))).alias("n_lists"),
        F.min(F.struct(F.col("list_name").isNull().alias("unnamed"), "list_name", "pattern", "valid_from"))
        .alias("hit")), "url-found")
    return rows.join(found, ["url", "fetch_date"], "left").select(
        "page_id", url_host(F.coalesce("url", F.lit(""))).alias("host"), "fetch_date",
        F.when(F.col("hit").isNotNull(), "blocked").otherwise("allowed").alias("verdict"),
        F.coalesce("n_lists", F.lit(0)).cast("long").alias("n_lists"),
        F.col("hit.list_name").alias("list_name"), F.col("hit.pattern").alias("pattern"),
        F.col("hit.valid_from").alias("valid_from"))


def _number(text: Column, salt: str) -> Column:
    """A whole number that follows from a text, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 7), 16, 10).cast("int")


def derived_captures(pages: DataFrame) -> DataFrame:
    """The pages table has no fetch dates: a day of 2024 that follows from the URL."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"),
                                                     _number(F.col("url"), "f") % 366).alias("fetch_date"))


def derived_events(pages: DataFrame) -> DataFrame:
    """Dated list entries for a share of the hosts of the pages: added, most of
    them removed, some added again; and a path of some hosts on a second list."""
    hosts = pages.where("url IS NOT NULL").select(url_host(F.col("url")).alias("host")).distinct() \
        .where("host <> ''")
    first = F.date_add(F.lit("2024-01-01").cast("date"), _number(F.col("host"), "a") % 200)
    chosen = hosts.where(_number(F.col("host"), "c") % 3 == 0).withColumn("first", first)
    entry = lambda days, action: F.struct(
        F.lit("hosts").alias("list_name"), F.concat(F.lit("host:"), "host").alias("pattern"),
        F.date_add("first", days).alias("event_date"), F.lit(action).alias("action"))
    own = chosen.select(F.explode(F.array(entry(0, "add"), entry(60, "remove"), entry(120, "add"))).alias("e")) \
        .select("e.*")
    parents = hosts.where(_number(F.col("host"), "p") % 10 == 0).select(
        F.lit("paths").alias("list_name"), F.concat(F.lit("path:"), "host", F.lit("/en")).alias("pattern"),
        F.date_add(F.lit("2024-01-01").cast("date"), _number(F.col("host"), "q") % 300).alias("event_date"),
        F.lit("add").alias("action"))
    return own.unionByName(parents)
