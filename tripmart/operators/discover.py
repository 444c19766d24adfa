"""Source discovery and incremental selection.

Links are pulled out of HTML with regular expressions inside Spark (one row
per anchor, duplicates kept); periods and zone keys are string functions;
"what is new" and "what is still to do" are anti joins on parsed
(year, month) — never substring tests on a joined key list.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import (key_folder, key_month, key_partition_value,
                               key_period, key_year, partition_key, url_period)
from ..schema import PERIOD_PATTERN, SOURCE_LINK_PATTERN

# One step of a tag's inside: blanks and slashes, or a whole attribute.  Repeated
# possessively, so that neither the stack nor the time of a match grows with more
# than the length of the tag; a quote that is never closed ends it without '>'.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_NAME = r"[^\s/>][^\s/>=]*+"
_ATTRIBUTE = rf"{_NAME}(?:\s*+=\s*+{_VALUE}|(?!\s*+=))"
_INSIDE = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_RAW_TEXT = "script|style|title|textarea|xmp|iframe|noembed|noframes"
# Everything that begins with '<' in page order, each to its own end, and to the end
# of the page if that never comes: group 1 is the inside of a whole anchor tag.
_MARKUP = (rf"(?i)<(?:a(?=[\s/>])({_INSIDE})>"
           rf"|!--(?:-?>|[\s\S]*?(?:--!?>|\z))"
           rf"|({_RAW_TEXT})(?=[\s/>]){_INSIDE}(?:>[\s\S]*?(?:</\2(?=[\s/>])|\z)|[\s\S]*+)"
           rf"|/?[a-z][^\s/>]*+{_INSIDE}(?:>|[\s\S]*+)"
           rf"|[!?/][^>]*+>?)")
# The first attribute named href, with its value if it has one.
_HREF = rf"(?i)^(?:[\s/]++|(?!href(?=[\s/>=]|\z)){_ATTRIBUTE})*+(href(?:\s*+=\s*+{_VALUE})?+)"
_REFERENCE = r"^(#[0-9]++|#[xX][0-9a-fA-F]++|[a-zA-Z][a-zA-Z0-9]*+)"
# Names that need no semicolon, where neither '=' nor a letter or digit follows.
_OPEN_NAMES = sorted(n for n in html5 if not n.endswith(";"))


def decode_entities(s: Column) -> Column:
    """Character references as in an attribute: numeric ones, with or without a
    semicolon, and named ones of HTML 4, `&apos;` and the old capitals; without
    a semicolon only the old names, and not before `=`.  Each once, so that a
    decoded `&` starts no new one.  Others stay, also numbers of no character."""
    common = ("amp", "quot", "lt", "gt", "apos", "nbsp")  # looked up first
    names = {**{n: html5[f"{n};"] for n in common}, **{n: chr(c) for n, c in sorted(name2codepoint.items())},
             **{n: html5[n] for n in _OPEN_NAMES}}
    named = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))

    def decoded(part: Column) -> Column:
        ref = F.regexp_extract(part, _REFERENCE, 1)
        rest = F.substring(part, F.length(ref) + 1, F.length(part))
        closed = rest.startswith(";")
        digits = F.regexp_replace(ref, "^#[xX]?0*(?=.)", "")
        short = F.substring(digits, F.lit(1), F.lit(8))
        code = F.when(ref.rlike("^#[xX]"), F.conv(short, 16, 10)).when(ref.startswith("#"), short).cast("long")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF) & (F.length(digits) <= 8)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        open_name = ref.isin(_OPEN_NAMES) & ~rest.startswith("=")
        text = F.coalesce(char, F.when(closed | open_name, F.try_element_at(named, ref)))
        return F.when(text.isNotNull(), F.concat(text, F.when(closed, F.substring(rest, F.lit(2), F.length(rest))).otherwise(rest))) \
            .otherwise(F.concat(F.lit("&"), part))

    parts = F.split(s, "&", -1)
    rest = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    return F.when(s.contains("&"), F.concat(parts[0], F.array_join(rest, ""))).otherwise(s)


def _unquote(v: Column) -> Column:
    quoted = v.startswith('"') | v.startswith("'")
    return F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)


def links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, href): one row per <a> tag with an href, in page order.

    The page is read once from end to end the way browsers split it: comments,
    scripts and other raw text, quoted values that hold '<' or '>', and
    attributes with double-, single- or un-quoted values; of several href the
    first counts.  A tag whose '>' or closing quote never comes is none, and
    takes the rest of the page with it.  An href that is empty, or has no value,
    gives an empty string; an anchor without one gives no row.  Time grows with
    the length of the page, and the stack with nothing."""
    inside = F.regexp_extract_all(F.col(html_col), F.lit(_MARKUP), F.lit(1))
    x = pages.select(F.col(id_col), F.explode(F.filter(inside, lambda t: t != "")).alias("_tag"))
    x = x.select(F.col(id_col), F.regexp_extract("_tag", _HREF, 1).alias("_v")).where(F.col("_v") != "")
    value = F.regexp_replace("_v", r"^[^=\s]++\s*+=?+\s*+", "")
    return x.select(F.col(id_col), decode_entities(_unquote(value)).alias("href"))


def filter_links(df: DataFrame, pattern: str = SOURCE_LINK_PATTERN, col: str = "href") -> DataFrame:
    """Keep links where the pattern is found anywhere (search semantics)."""
    return df.where(F.col(col).rlike(pattern))


def source_listing(orders: DataFrame, base: str = "https://data.example/trip-data/yellow_tripdata_"
                   ) -> DataFrame:
    """Driver stand-in for the published file list: one URL per order month.

    The URL is built from an aggregate output (the month's first order
    date), not from the grouping keys, so filters on the URL stay above the
    aggregate: string work runs once per month, not once per order."""
    d = F.col("o_orderdate")
    months = orders.groupBy(F.year(d).alias("_y"), F.month(d).alias("_m")) \
        .agg(F.min(d).alias("_first"))
    period = F.format_string("%04d-%02d", F.year("_first"), F.month("_first"))
    return months.select(F.concat(F.lit(base), period, F.lit(".parquet")).alias("url"))


def with_period(df: DataFrame, url_col: str = "url", pattern: str = PERIOD_PATTERN,
                on_missing: str = "null") -> DataFrame:
    """Add `period` (first `yyyy-mm`-like match).  on_missing: "null" keeps
    the row with NULL, "error" fails the job, "drop" removes the row (use
    `quarantine` to get those rows instead)."""
    p = url_period(F.col(url_col), pattern)
    if on_missing == "error":
        p = F.coalesce(p, F.raise_error(F.concat(F.lit("no period in "), F.col(url_col))))
    out = df.withColumn("period", p)
    if on_missing == "drop":
        out = out.where(F.col("period").isNotNull())
    return out


def quarantine(df: DataFrame, url_col: str = "url", pattern: str = PERIOD_PATTERN) -> DataFrame:
    return df.where(url_period(F.col(url_col), pattern).isNull())


def with_partition_key(df: DataFrame, period_col: str = "period") -> DataFrame:
    return df.withColumn("key", partition_key(F.col(period_col)))


def zone_manifest(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """(key, folder, year, month) of zone keys, parsed from `name=value`
    segments; root-level keys (no folder) have NULL year/month."""
    k = F.col(key_col)
    return keys.select(k.alias("key"), key_folder(k).alias("folder"),
                       key_partition_value(k, "year").alias("year"),
                       key_partition_value(k, "month").alias("month"))


def keys_by_offset(keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Year/month read at fixed offsets, as the source miner does."""
    k = F.col(key_col)
    return keys.select(k.alias("key"), key_year(k).alias("year"), key_month(k).alias("month"),
                       key_period(k).alias("period"))


def new_sources(listing: DataFrame, existing_keys: DataFrame, on_missing: str = "error") -> DataFrame:
    """Listed URLs whose period has no file in the raw zone yet.  A URL
    without a period fails the job; with on_missing="drop" it is left out
    (`quarantine` lists those)."""
    have = keys_by_offset(existing_keys).select("period").distinct()
    return with_period(listing, on_missing=on_missing).join(have, "period", "left_anti")


def _partition_value(c: str) -> Column:
    """Numeric partition values compare as numbers ('01' = '1': writers
    differ in zero padding); others as text."""
    v = F.col(c)
    return F.coalesce(v.try_cast("bigint").cast("string"), v)


def unprocessed(source_keys: DataFrame, target_keys: DataFrame) -> DataFrame:
    """Source keys whose (year, month) partition has no file in the target
    zone.  Exact match on the parsed partition values."""
    src = zone_manifest(source_keys).where(F.col("year").isNotNull() & F.col("month").isNotNull())
    src = src.withColumns({"_y": _partition_value("year"), "_m": _partition_value("month")})
    done = (zone_manifest(target_keys).where(F.col("year").isNotNull())
            .select(_partition_value("year").alias("_y"), _partition_value("month").alias("_m"))
            .distinct())
    return src.join(done, ["_y", "_m"], "left_anti").select("key", "year", "month")


def audit(results: DataFrame) -> DataFrame:
    """Outcome report: per status, the sorted partition keys and totals.
    `results` has (key, status, rows) — one row per partition of a run, so
    the collected lists are bounded by the partitions of one run."""
    return (results.groupBy("status")
            .agg(F.sort_array(F.collect_list("key")).alias("partitions"),
                 F.count(F.lit(1)).alias("n_partitions"),
                 F.sum("rows").alias("rows")))
