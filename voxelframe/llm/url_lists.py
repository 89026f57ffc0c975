"""URL filters by a temporal list join, in DataFrame operations only.

A dated list says when a pattern (a host, with all hosts below it, or a host
and path prefix) was added to or removed from a category.  The events of a
pattern become validity intervals; each capture is then evaluated against the
entries that were active at its fetch time.  The as-of join is an equi-join on
(pattern, period): an interval is entered in every period it covers, so a
capture meets only the intervals of its own period, and a long history of one
pattern or a hot host is spread over the periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

FOREVER = "9999-12-31"
PERIOD_DAYS = 32


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(F.regexp_replace(host, r"\.+$", "")), F.lit(""))


def url_path(url: Column) -> Column:
    """Path without query and fragment, '/' if empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_patterns(url: Column, labels_most: int, segments_most: int) -> Column:
    """The patterns an entry may use to match a URL: the host and each parent
    domain of two or more labels, and the host with each path prefix that
    ends at a slash.  Parents of more than ``labels_most`` labels and prefixes
    of more than ``segments_most`` slashes are left out; ``pattern_depths``
    says how deep a list goes."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    # from position i on: at least two labels, or the whole host
    cut = F.sequence(F.greatest(F.lit(1), n - (labels_most - 1)), F.greatest(F.lit(1), n - 1))
    parents = F.transform(cut, lambda i: F.array_join(F.slice(labels, i, n), "."))
    domains = F.array_distinct(F.concat(F.array(host), parents))
    # the part after the last slash is no directory
    segments = F.slice(F.split(path, "/"), 1, segments_most + 1)
    # 'a/b/c' -> 'a/', 'a/b/'
    depth = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(segments) - 1))
    prefixes = F.transform(depth, lambda i: F.concat(host, F.array_join(F.slice(segments, 1, i), "/"), F.lit("/")))
    return F.when(host.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(domains, prefixes)))


def pattern_depths(events: DataFrame) -> tuple[int, int]:
    """The most labels (2 at least) and the most slashes (1 at least) of a
    pattern of the list: no deeper part of a URL can match."""
    pattern = F.col("pattern")
    most = events.agg(F.max(F.size(F.split(F.substring_index(pattern, "/", 1), r"\."))),
                      F.max(F.length(pattern) - F.length(F.replace(pattern, F.lit("/"), F.lit(""))))).first()
    return max(2, most[0] or 0), max(1, most[1] or 0)


def intervals(events: DataFrame) -> DataFrame:
    """(pattern, category, action, at) -> (pattern, category, since, until).

    action 'add' starts an interval that ends with the pattern's next
    'remove'; a repeated action changes nothing.  Of actions at the same time
    the removal counts last.  Rows with a null in any column are ignored."""
    ev = (events.select("pattern", "category", F.lower("action").alias("action"), F.col("at").cast("timestamp").alias("at"))
          .na.drop().filter("action in ('add', 'remove')").distinct())
    # one state per instant, then the instants at which it changes
    state = ev.groupBy("pattern", "category", "at").agg((~F.max(F.col("action") == "remove")).alias("on"))
    line = W.partitionBy("pattern", "category").orderBy("at")
    turns = state.withColumn("was", F.lag("on").over(line)).filter(F.col("on") != F.coalesce("was", F.lit(False)))
    return (turns.withColumn("until", F.lead("at", 1).over(line)).filter("on")
            .select("pattern", "category", F.col("at").alias("since"),
                    F.coalesce("until", F.lit(FOREVER).cast("timestamp")).alias("until")))


def _period(at: Column) -> Column:
    return F.floor(F.datediff(at, F.lit("1970-01-01")) / PERIOD_DAYS).cast("int")


def filter_captures(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    at_col: str = "fetched") -> DataFrame:
    """One row per capture: page_id, fetched, host, n_hits, categories, blocked.

    n_hits counts the entries (pattern, category) active at fetch time
    (since <= fetched < until) that match the URL, categories lists the
    distinct categories in order (comma-joined, empty if none), and blocked
    tells whether there is any.  Null URLs, URLs without a host and null fetch
    times match nothing.  Repeated rows are evaluated each; null ids stay.
    Other columns are not read."""
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(at_col).cast("timestamp").alias("fetched"),
                           F.col(url_col).alias("url"))
    # copies of a capture are evaluated once
    asked = rows.filter("url is not null and fetched is not null").groupBy("url", "fetched").agg(F.lit(1).alias("one"))
    keyed = asked.select("url", "fetched", _period(F.col("fetched")).alias("period"),
                         F.explode(url_patterns(F.col("url"), *pattern_depths(events))).alias("pattern"))
    # a period is entered only up to the last fetch there is (one value)
    last = rows.agg(F.max(_period(F.col("fetched")))).first()[0] or 0
    start = _period(F.col("since"))
    spans = intervals(events).filter(start <= last).withColumn("period", F.explode(F.sequence(
        start, F.least(_period(F.col("until")), F.lit(last)))))
    hits = (keyed.join(spans, ["pattern", "period"]).filter("since <= fetched and fetched < until")
            .groupBy("url", "fetched").agg(F.count("*").alias("n"), F.collect_set("category").alias("cats")))
    return (rows.join(hits, ["url", "fetched"], "left")
            .select("page_id", "fetched", url_host(F.col("url")).alias("host"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_hits"),
                    F.coalesce(F.array_join(F.array_sort("cats"), ","), F.lit("")).alias("categories"),
                    (F.coalesce("n", F.lit(0)) > 0).alias("blocked")))
