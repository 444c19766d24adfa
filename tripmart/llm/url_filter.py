"""URL filtering by dated lists, as of each capture's fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Day of an interval that is still open.
OPEN = "9999-12-31"
#: More labels than a host has: no list names a domain.
MOST_LABELS = 1 << 30


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; null if the URL has none."""
    authority = F.regexp_extract(F.trim(url), r"^(?i:[a-z][a-z0-9+.-]*):/{2}([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(authority), r"^.*@", ""), r"(:[0-9]*)?$", "")
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a URL, without query and fragment."""
    return F.regexp_extract(F.trim(url), r"^(?i:[a-z][a-z0-9+.-]*):/{2}[^/?#\\]*([^?#]*)", 1)


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, pattern, allow, valid_from, valid_to), both days included, of dated entries.

    entries: list, pattern, day (date), active (boolean), allow (boolean).
    An entry holds from its day to the day before the next one of the same
    list, pattern and allow; of several on one day an active one wins.  Days
    are aggregated first, so that a pattern has at most one row a day.
    Entries without pattern or day are ignored; a null active or allow is false.
    """
    by = ["list", "pattern", "allow"]
    days = entries.where("pattern is not null and day is not null").groupBy("list", F.lower("pattern").alias("pattern"), F.coalesce("allow", F.lit(False)).alias("allow"), "day")
    days = days.agg(F.max(F.coalesce("active", F.lit(False))).alias("active"))
    following = F.lead("day").over(Window.partitionBy(*by).orderBy("day"))
    spans = days.withColumn("valid_to", F.coalesce(F.date_sub(following, 1), F.lit(OPEN).cast("date")))
    return spans.where("active").select(*by, F.col("day").alias("valid_from"), "valid_to")


def candidates(url: Column, depth: int, labels_from: int = 1) -> Column:
    """All patterns that can match a URL: its host and parent domains of at least labels_from labels, and its host with up to depth path segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - labels_from + 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    domains = F.when(n >= labels_from, parents).otherwise(F.array().cast("array<string>"))
    if not depth:
        return domains
    segments = F.slice(F.split(F.regexp_replace(path_of(url), "^/", ""), "/"), 1, depth)
    # The last piece is a segment of its own only if a slash ends it.
    whole = F.least(F.size(segments), F.size(F.split(F.regexp_replace(path_of(url), "^/", ""), "/")) - 1)
    paths = F.when(whole > 0, F.transform(F.sequence(F.lit(1), whole), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"), F.lit("/"))))
    return F.concat(domains, F.coalesce(paths, F.array().cast("array<string>")))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row per capture: id, url, fetched, blocked, list, pattern, valid_from.

    A pattern is a domain ("example.org", which also matches its subdomains)
    or a host with a path prefix ("example.org/ads/", whole segments).  Of the
    entries active on the capture's day the longest pattern decides, an
    allowing one before a blocking one of the same pattern, then the list
    first by name.  A capture without URL, host or time matches nothing and
    is not blocked; repeated captures give repeated rows; an empty list
    blocks nothing.  The temporal join is an equi-join on (pattern, year) of
    distinct (url, day) with intervals cut at year ends, so that a pattern
    has at most 183 intervals a key and an open interval a row a year;
    a hot host is spread over its years and split by adaptive skew joins.
    Domains with fewer labels than any listed one, such as the top-level
    domain that most captures share, are no keys.
    """
    day = F.col(time_col).cast("date")
    caps = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched"), day.alias("day"))
    spans = validity(entries)
    domain_labels = F.when(~F.contains("pattern", F.lit("/")), F.size(F.split("pattern", r"\.")))
    depth, fewest = entries.agg(F.max(F.size(F.split("pattern", "/"))), F.min(domain_labels)).first()
    last = caps.agg(F.max(F.year("day")).alias("y")).first()["y"]
    end = F.least(F.year("valid_to"), F.lit(last if last is not None else 0))
    cut = spans.where(F.year("valid_from") <= end).select("*", F.explode(F.sequence(F.year("valid_from"), end)).alias("year"))
    keys = caps.where("url is not null and day is not null").select("url", "day").distinct()
    keys = keys.withColumn("pattern", F.explode(candidates(F.col("url"), max(0, (depth or 1) - 2), fewest or MOST_LABELS))).withColumn("year", F.year("day"))
    hits = keys.join(cut, ["pattern", "year"]).where("day between valid_from and valid_to")
    first = F.min_by(F.struct("allow", "list", "pattern", "valid_from"), F.struct(-F.length("pattern"), ~F.col("allow"), "list"))
    best = hits.groupBy("url", "day").agg(first.alias("best"))
    out = caps.join(best, ["url", "day"], "left")
    return out.select(F.col("id").alias(id_col), "url", "fetched", F.coalesce(~F.col("best.allow"), F.lit(False)).alias("blocked"), "best.list", "best.pattern", "best.valid_from")
