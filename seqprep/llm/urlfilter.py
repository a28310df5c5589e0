"""URL filters as a temporal list join.

A filter list is a history of dated entries: a key (a domain, a path below a
host, or one URL) is added or removed at a time. Per key, consecutive entries
become validity intervals; a capture is evaluated against the intervals that
hold its fetch time, by an equality join on the keys its URL can match and a
range condition on time.

Native throughout: DataFrame and SQL functions only. Captures are narrow rows
(place, time, key) in the join; its list side is broadcast when its counted
rows fit, and otherwise both sides are shuffled and AQE splits a hot host. A
key's own history is one window (as long as its list has distinct dates).

Defined results: a URL that is null or has no host matches nothing, neither
does a null fetch time; entries without key, time or known action are ignored;
repeated entries count once; at equal times a removal follows an addition;
repeated captures are judged each; an empty table or list blocks nothing; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqprep.llm.common import as_scan, small_side, with_locator, written

SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
ENTRY_BYTES = 256


def host_of(url: Column) -> Column:
    """Host in lower case, without user or port; empty where there is none."""
    return F.lower(F.regexp_extract(url, SCHEME + r"(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    """Path without query and fragment; ``/`` where it is empty."""
    path = F.regexp_extract(url, SCHEME + r"[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def rest_of(url: Column) -> Column:
    """Path and query, without fragment."""
    return F.regexp_extract(url, SCHEME + r"[^/?#]*([^#]*)", 1)


def domain_key(host: Column) -> Column:
    return F.concat(F.lit("d:"), F.lower(host))


def path_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("p:"), F.lower(host), path)


def url_key(url: Column) -> Column:
    return F.concat(F.lit("u:"), host_of(url), rest_of(url))


def match_keys(url: Column) -> Column:
    """All keys a URL can match: its host and every parent domain of two labels
    or more, every folder of its path and the path itself, the URL."""
    host, path = host_of(url), path_of(url)
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    upto = F.greatest(F.size(labels) - 1, F.lit(1))
    domains = F.transform(F.sequence(F.lit(1), upto), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    folders = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.concat(F.lit("p:"), host, F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
    )
    keys = F.array_distinct(F.concat(domains, folders, F.array(path_key(host, path), url_key(url))))
    return F.when(host != "", keys).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``key, since, until`` (exclusive; null: open) from dated entries
    (``key, at, action``: add or remove)."""
    known = entries.filter(F.col("action").isin("add", "remove") & F.col("key").isNotNull() & F.col("at").isNotNull())
    history = Window.partitionBy("key").orderBy("at", "action")
    dated = known.select("key", "at", "action").distinct().withColumn("until", F.lead("at").over(history))
    return dated.filter("action = 'add' and (until is null or until > at)").select("key", F.col("at").alias("since"), "until")


def judge_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched"
) -> DataFrame:
    """One row per capture: ``id, fetched, blocked, rule`` (the first matching
    key in order) and ``since`` (when that entry became valid)."""
    rows = with_locator(as_scan(captures), [
        F.col(id_col).alias("id"), F.col(time_col).alias("fetched"), F.col(url_col).cast("string").alias("url"),
    ])
    active = written(intervals(entries), "intervals")
    keyed = rows.filter("fetched is not null").select("_file", "_row", "fetched", F.explode(match_keys(F.col("url"))).alias("key"))
    hits = keyed.join(small_side(active, active.count(), ENTRY_BYTES), "key").filter("fetched >= since and (until is null or fetched < until)")
    rules = written(hits.groupBy("_file", "_row").agg(F.min(F.struct("key", "since")).alias("hit")), "rules")
    return rows.join(small_side(rules, rules.count(), 2 * ENTRY_BYTES), ["_file", "_row"], "left").select(
        "id", "fetched", F.col("hit").isNotNull().alias("blocked"), F.col("hit.key").alias("rule"), F.col("hit.since").alias("since")
    )
