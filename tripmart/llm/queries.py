"""Registered queries of the corpus operators, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import chat_format, conversation_repair, decontaminate, fingerprints, html_extract, lm, mixing, secrets, simhash, token_counts, toxicity, url_filter, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once a session: they may not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(path))


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = shipped
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), power=0.5, seed=17)


ORACLE["op8_source_mixing"] = """
WITH RECURSIVE docs AS (
  SELECT *, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS id FROM documents
), counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
totals AS (SELECT sum(n) AS all_n, sum(sqrt(n)) AS all_w FROM counts),
rates AS (SELECT source, sqrt(n) / all_w * CAST(all_n AS DOUBLE) / n AS rate FROM counts, totals),
parts AS (SELECT source, rate, greatest(1, CAST(ceil(rate / 100.0) AS INTEGER)) AS m FROM rates),
cdf AS (
  SELECT source, rate / m AS mean, m, 0 AS k, exp(-rate / m) AS p, exp(-rate / m) AS c FROM parts
  UNION ALL
  SELECT source, mean, m, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean) + 30)
), draws AS (
  SELECT d.*, i, (CAST('0x' || substr(md5('17|draw|' || d.id || '|' || i), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM docs d JOIN parts USING (source), LATERAL (SELECT unnest(generate_series(1, m)) AS i)
), counted AS (
  SELECT r.doc_id, r.id, r.i, r.source, count(*) FILTER (WHERE c.c < r.u) AS x
  FROM draws r JOIN cdf c ON r.source IS NOT DISTINCT FROM c.source GROUP BY ALL
), copies AS (SELECT id, source, CAST(sum(x) AS INTEGER) AS copies FROM counted GROUP BY id, source)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, k.copies, CAST(t.copy AS INTEGER) AS copy, md5('17|order|' || d.id || '|' || t.copy) AS shuffle_key
FROM docs d JOIN copies k ON d.id = k.id AND d.source IS NOT DISTINCT FROM k.source, LATERAL (SELECT unnest(generate_series(1, k.copies)) AS copy) t
"""


def hashed(name: str, *cols: str) -> Column:
    """A number of 0 to 65535 fixed by a name and columns."""
    parts = [F.lit(name), *(F.col(c).cast("string") for c in cols)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 4), 16, 10).cast("int")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with a fetch time within four years, fixed by the page id, as the table has none."""
    fetched = F.timestamp_seconds(F.lit(1577836800) + hashed("day", "page_id") % 1461 * 86400 + hashed("second", "page_id")).cast("timestamp_ntz")
    return table(spark, sf_dir, "pages").select("page_id", "url", fetched.alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries about every host, parent domain and section of pages, with days fixed by the pattern.

    Each pattern is listed, delisted and listed again; parent domains are
    listed briefly, sections (host and first path segment) are allowed.
    """
    host = url_filter.host_of(F.col("url"))
    section = F.regexp_extract(url_filter.path_of(F.col("url")), r"^/([^/]+/)", 1)
    kinds = F.array(
        F.struct(F.lit("hosts").alias("list"), host.alias("pattern"), F.lit(False).alias("allow"), F.lit(400).alias("span")),
        F.struct(F.lit("domains").alias("list"), F.substring_index(host, ".", -2).alias("pattern"), F.lit(False).alias("allow"), F.lit(40).alias("span")),
        F.struct(F.lit("sections").alias("list"), F.when(section != "", F.concat(host, F.lit("/"), section)).alias("pattern"), F.lit(True).alias("allow"), F.lit(600).alias("span")),
    )
    patterns = pages.select(F.explode(kinds).alias("k")).select("k.*").where("pattern is not null").distinct()
    first = hashed("first", "list", "pattern") % 1000
    second = first + 1 + hashed("second", "list", "pattern") % F.col("span")
    third = second + 1 + hashed("third", "list", "pattern") % F.col("span")
    steps = F.array(*(F.struct(F.date_add(F.lit("2019-10-01").cast("date"), n).alias("day"), F.lit(on).alias("active")) for n, on in ((first, True), (second, False), (third, True))))
    return patterns.select("list", "pattern", "allow", F.explode(steps).alias("s")).select("list", "pattern", "allow", "s.*").where(~((F.col("list") == "domains") & F.col("active") & (F.col("day") > "2021-06-30")))


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = captures(spark, sf_dir)
    return url_filter.filter_urls(caps, list_entries(caps))


ORACLE["op1_url_filters"] = r"""
WITH pages0 AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^(?i:[a-z][a-z0-9+.-]*):/{2}([^/?#\\]*)', 1)), '^.*@', ''), '(:[0-9]*)?$', ''), '\.+$', ''), '') AS host,
    regexp_extract(trim(url), '^(?i:[a-z][a-z0-9+.-]*):/{2}[^/?#\\]*([^?#]*)', 1) AS path FROM pages
), caps AS (
  SELECT *, CAST(TIMESTAMP '2020-01-01' + to_seconds(CAST('0x' || substr(md5('day|' || page_id), 1, 4) AS INTEGER) % 1461 * 86400 + CAST('0x' || substr(md5('second|' || page_id), 1, 4) AS INTEGER)) AS TIMESTAMP) AS fetched FROM pages0
), patterns AS (
  SELECT 'hosts' AS list, host AS pattern, false AS allow, 400 AS span FROM pages0 WHERE host IS NOT NULL
  UNION SELECT 'domains', array_to_string(string_split(host, '.')[-2:], '.'), false, 40 FROM pages0 WHERE host IS NOT NULL
  UNION SELECT 'sections', host || '/' || regexp_extract(path, '^/([^/]+/)', 1), true, 600 FROM pages0 WHERE host IS NOT NULL AND regexp_extract(path, '^/([^/]+/)', 1) <> ''
), days AS (
  SELECT *, CAST('0x' || substr(md5('first|' || list || '|' || pattern), 1, 4) AS INTEGER) % 1000 AS a,
    1 + CAST('0x' || substr(md5('second|' || list || '|' || pattern), 1, 4) AS INTEGER) % span AS b,
    1 + CAST('0x' || substr(md5('third|' || list || '|' || pattern), 1, 4) AS INTEGER) % span AS c FROM patterns
), entries AS (
  SELECT list, pattern, allow, CAST(DATE '2019-10-01' + a AS DATE) AS day, true AS active FROM days
  UNION ALL SELECT list, pattern, allow, CAST(DATE '2019-10-01' + a + b AS DATE), false FROM days
  UNION ALL SELECT list, pattern, allow, CAST(DATE '2019-10-01' + a + b + c AS DATE), true FROM days
), kept AS (SELECT * FROM entries WHERE NOT (list = 'domains' AND active AND day > DATE '2021-06-30')),
matched AS (
  SELECT page_id, fetched, list, pattern, allow, max(day) AS day, arg_max(active, day) AS active
  FROM caps JOIN kept ON day <= CAST(fetched AS DATE) AND CASE
    WHEN contains(pattern, '/') THEN starts_with(host || path, pattern)
    ELSE host = pattern OR ends_with(host, '.' || pattern) END
  GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, fetched ORDER BY length(pattern) DESC, allow DESC, list) AS rank FROM matched WHERE active
)
SELECT c.page_id, c.url, c.fetched, coalesce(NOT r.allow, false) AS blocked, r.list, r.pattern, r.day AS valid_from
FROM caps c LEFT JOIN ranked r ON c.page_id = r.page_id AND c.fetched = r.fetched AND rank = 1
"""


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8, width=5)


ORACLE["op2_benchmark_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x20!-/:-@\[-`{-\x7f]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS row, item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x20!-/:-@\[-`{-\x7f]+') AS w FROM benchmark),
item AS (SELECT DISTINCT row, item_id, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM b, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i) WHERE len(w) > 0),
sizes AS (SELECT row, count(*) AS n FROM item GROUP BY row),
doc AS (SELECT DISTINCT row, doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM d, (SELECT DISTINCT k FROM item), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i))
SELECT doc.doc_id, item.item_id, count(*) AS n_shared, any_value(n) AS n_shingles, count(*) / CAST(any_value(n) AS DOUBLE) AS containment
FROM doc JOIN item USING (k, s) JOIN sizes ON sizes.row = item.row
GROUP BY doc.row, doc.doc_id, item.row, item.item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-9
"""


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), rule="start", vocabulary=token_counts.VOCABULARY)


@query
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), max_training=toxicity.MAX_TRAINING)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"), vocabulary=lm.VOCABULARY)


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """conversations and one more, -1, whose texts hold control strings."""
    said = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(said)


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.chat_windows(with_control_strings(table(spark, sf_dir, "conversations"))))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digests(conversation_repair.repair(rows))
