"""URL filters whose lists change over time: every capture is judged by the entries active when it was fetched.

A list is a history of dated entries that add or remove a pattern: a host with all hosts below it, or a host with a
path prefix. The history of a pattern becomes validity intervals, each from one entry to the next. A capture asks with
every key it could be listed under: its host and the domains above it, its whole path, and the prefixes of its path that
are as deep as some listed pattern; an as-of join finds the interval of each key that holds at fetch time.

The join is an equality on the key and on a bucket of time. An interval is in every bucket that it touches and that lies
in the captures' time; a capture is in one. So a key with a long history is split by time, a frequent host is split by
time and, where that is not enough, by adaptive execution, and no task sorts all captures of a host. Keys that were
never listed are dropped by the join alone; nothing is broadcast by assumption.

Defined results: a null or malformed URL has no key and is not blocked, a null fetch time is matched by nothing, an
entry without pattern or date is ignored, of entries for a pattern at one time the removal wins, captures that
repeat are judged each for itself, an empty list blocks nothing and an empty table gives none. Hosts are compared in
lower case, without port, user or trailing dot; paths keep their case, in patterns as in URLs; queries and fragments play
no part. A URL of any length is read whole, in time proportional to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot

#: Width of a bucket, and into how many the captures' time is cut at most.
BUCKET_SECONDS, BUCKETS = 30 * 86400, 1000
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), r"\.$", "")


def keys(url: Column, depths: Column) -> Column:
    """All patterns that could list a URL: its host and the domains above (at least two labels), the host with its whole
    path, and with each prefix of the path that ends at a slash and has as many slashes as some listed pattern. ``depths``
    is an array of these numbers, so a path costs its length for each of them and not its length for each of its parts."""
    name = host(url)
    labels = F.split(name, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat_ws(".", F.slice(labels, i, n)))
    path = F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)
    slashes = F.length(path) - F.length(F.translate(path, "/", ""))
    listed = F.filter(depths, lambda d: (d >= 2) & (d <= slashes))
    prefixes = F.transform(listed, lambda d: F.concat(name, F.call_function("substring_index", path, F.lit("/"), d), F.lit("/")))
    every = F.when(path == "", domains).otherwise(F.concat(domains, prefixes, F.array(F.concat(name, path))))
    return F.when(name == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def _depths(entries: DataFrame) -> Column:
    """The different numbers of slashes in the listed patterns; k of them take patterns of k * k / 2 characters."""
    slashes = F.length("pattern") - F.length(F.translate("pattern", "/", ""))
    found = entries.filter("pattern IS NOT NULL").select(slashes.alias("depth")).distinct().collect()
    return F.array(*[F.lit(r.depth) for r in found]).cast("array<int>")


def validity(entries: DataFrame) -> DataFrame:
    """Intervals of (list, pattern, action, at) entries: list, key, since, until (open where null). ``action`` is add or
    remove; ``at`` is in seconds."""
    dated = entries.filter("pattern IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    key = F.concat(F.lower(F.substring_index("pattern", "/", 1)), F.regexp_extract("pattern", "(?s)/.*", 0))
    state = dated.groupBy("list", key.alias("key"), "at").agg(F.bool_and(F.col("action") == "add").alias("added"))
    history = Window.partitionBy("list", "key").orderBy("at")
    changed = state.withColumn("before", F.lag("added", 1, False).over(history)).filter("added <> before")
    return changed.withColumn("until", F.lead("at").over(history)).filter("added").select("list", "key", F.col("at").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", bucket: int = BUCKET_SECONDS) -> DataFrame:
    """The rows of ``captures`` with blocked, n_entries (active entries that match) and entry, the first of them by
    list and pattern as ``list:pattern``; columns of the captures with these names are replaced."""
    whole = captures.select(F.struct("*").alias("capture"), F.col(url).alias("url"), F.col(fetched).cast("long").alias("fetched"), F.monotonically_increasing_id().alias("row"))
    whole = snapshot(whole, "captures")
    span = whole.agg(F.min("fetched").alias("first"), F.max("fetched").alias("last")).first()
    if span["first"] is not None:
        bucket = max(bucket, -(-(span["last"] - span["first"]) // BUCKETS))
    depths = _depths(entries)
    asked = whole.select("row", "fetched", F.explode(keys(F.col("url"), depths)).alias("asked"))
    asked = asked.withColumn("at_bucket", F.floor(F.col("fetched") / bucket))
    first, last = (0, -1) if span["first"] is None else (span["first"] // bucket, span["last"] // bucket)
    from_, to = F.greatest(F.floor(F.col("since") / bucket), F.lit(first)), F.least(F.coalesce(F.floor(F.col("until") / bucket), F.lit(last)), F.lit(last))
    held = validity(entries).withColumn("lo", from_).withColumn("hi", to).filter("lo <= hi").withColumn("bucket", F.explode(F.sequence("lo", "hi")))
    held = snapshot(held.select("list", "key", "since", "until", "bucket"), "intervals")
    active = (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    met = asked.join(held, (F.col("asked") == F.col("key")) & (F.col("at_bucket") == F.col("bucket")) & active)
    found = met.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min(F.concat_ws(":", "list", "key")).alias("entry"))
    results = [F.col("n").isNotNull().alias("blocked"), F.coalesce("n", F.lit(0).cast("long")).alias("n_entries"), F.col("entry")]
    own = [F.col("capture")[c].alias(c) for c in captures.columns if c.lower() not in ("blocked", "n_entries", "entry")]
    return whole.join(found, "row", "left").select(*own, *results)


# -- the registered query: lists and fetch times derived from the pages ---------------------------------------------------

_DAY, _START = 86400, 1_600_000_000


def _captures(spark, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    return pages.withColumn("fetched_at", _START + F.pmod(F.col("page_id") * 7919, F.lit(1000)) * _DAY)


def _entries(captures: DataFrame) -> DataFrame:
    """Dated entries from what was fetched: hosts are listed and delisted by the ids of their pages, and folders by theirs."""
    path = F.regexp_extract("url", _PATH, 1)
    day = lambda k: _START + F.pmod(F.col("page_id") * k, F.lit(1000)) * _DAY
    hosts = captures.filter("page_id % 7 = 0").select(
        F.lit("hosts").alias("list"), host(F.col("url")).alias("pattern"), F.when(F.col("page_id") % 14 == 0, "add").otherwise("remove").alias("action"), day(31).alias("at")
    ).filter("pattern <> ''")
    folder = F.regexp_extract(path, "^(/[^/]*/)", 1)
    folders = captures.filter("page_id % 11 = 0").select(
        F.lit("folders").alias("list"), F.concat(host(F.col("url")), folder).alias("pattern"), F.when(F.col("page_id") % 3 > 0, "add").otherwise("remove").alias("action"), day(17).alias("at")
    ).filter(folder != "")
    return hosts.union(folders)


def op1_temporal_list(spark, d: str) -> DataFrame:
    captures = _captures(spark, d)
    return judge(captures, _entries(captures)).select("page_id", "fetched_at", "blocked", "n_entries", "entry")


QUERIES = {"op1_temporal_list": op1_temporal_list}
ORACLES = {
    "op1_temporal_list": r"""
WITH p AS (SELECT page_id, url, 1600000000 + (page_id * 7919) % 1000 * 86400 AS fetched_at,
    rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
e AS (SELECT 'hosts' AS list, host AS key, page_id % 14 = 0 AS added, 1600000000 + (page_id * 31) % 1000 * 86400 AS ts FROM p WHERE page_id % 7 = 0 AND host <> ''
  UNION ALL SELECT 'folders', lower(host || regexp_extract(path, '^(/[^/]*/)', 1)), page_id % 3 > 0, 1600000000 + (page_id * 17) % 1000 * 86400 AS ts FROM p
  WHERE page_id % 11 = 0 AND regexp_extract(path, '^(/[^/]*/)', 1) <> ''),
s AS (SELECT list, key, ts, bool_and(added) AS added FROM e GROUP BY ALL),
v AS (SELECT list, key, ts AS since, LEAD(ts) OVER (PARTITION BY list, key ORDER BY ts) AS until, added FROM s),
k AS (SELECT page_id, fetched_at, host AS key FROM p
  UNION SELECT page_id, fetched_at, array_to_string(string_split(host, '.')[i:], '.') FROM (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS i FROM p)
  UNION SELECT page_id, fetched_at, host || regexp_extract(path, '^(/[^/]*/)', 1) FROM p WHERE regexp_extract(path, '^(/[^/]*/)', 1) <> ''),
m AS (SELECT page_id, COUNT(*) AS n, MIN(list || ':' || k.key) AS entry FROM k JOIN v ON k.key = v.key AND added AND fetched_at >= since AND (until IS NULL OR fetched_at < until) GROUP BY page_id)
SELECT p.page_id, fetched_at, n IS NOT NULL AS blocked, COALESCE(n, 0) AS n_entries, entry FROM p LEFT JOIN m USING (page_id)"""
}
