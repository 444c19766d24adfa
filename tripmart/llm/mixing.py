"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.graph import cut_lineage

#: A Poisson draw of a larger mean is the sum of several draws of at most this mean (exp(-mean) stays exact).
PART = 100.0
#: Rates are broadcast up to this many sources (a CDF has under 300 entries, so 25 MB); beyond, they are joined by key.
MAX_BROADCAST_SOURCES = 10_000
#: Uniform draws have 52 random bits, so no draw exceeds a CDF that goes on until it reaches 1 - 2**-53.
BITS = 52


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) fixed by the parts, from the first 52 bits of their MD5."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << BITS))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... as an array, for a mean of at most PART, beyond the reach of any draw."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), zero.alias("c"), F.array(zero).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["all"])


def rates(docs: DataFrame, weights: dict[str, float] | None, power: float, size: int | None, source_col: str) -> DataFrame:
    """(source, rate): how often a document of the source is to occur in the mixture on average."""
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(power))))
    else:
        named = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)) if weights else F.lit(None).cast("map<string,double>")
        counts = counts.withColumn("weight", F.coalesce(F.try_element_at(named, "source"), F.lit(0.0)))
    totals = cut_lineage(counts)
    n, weight = totals.agg(F.sum("n"), F.sum("weight")).first()
    total = float(size if size is not None else n or 0)
    return totals.select("source", (F.col("weight") / F.lit(weight or 1.0) * F.lit(total) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: int | None = None, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The columns of docs, each row repeated by a Poisson draw, in a globally shuffled order.

    weights: target share of each source (sources not named: 0); None: shares
    in proportion to the number of rows to the given power.  size: rows
    aimed at, by default as many as docs has.  A row occurs Poisson(rate)
    times, where rate = share * size / rows of its source; the draw inverts
    the distribution at a number hashed from the seed and the id (a null id:
    the text), so that reruns and lost executors give the same rows, and
    repeated rows of an id the same count.  A null source is a source of its
    own, with no weight unless by power.  Added columns, replacing any of
    these names: copies (int), copy (1 to copies), shuffle_key (hash by which
    rows are dealt to partitions and sorted in them).  An empty table gives an
    empty result.  Every step is a DataFrame operation; a hot source costs
    nothing, as rates are aggregated before and joined by broadcast.
    """
    found = rates(docs, weights, power, size, source_col)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART))).cast("int")
    table = found.select(F.col("source").alias("_source"), parts.alias("_parts"), F.when(F.col("rate") > 0, poisson_cdf(F.col("rate") / parts)).alias("_cdf"))
    if found.count() <= MAX_BROADCAST_SOURCES:
        table = F.broadcast(table)
    identity = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    rows = docs.drop("copies", "copy", "shuffle_key").withColumn("_id", identity)
    rows = rows.join(table, F.col(source_col).cast("string").eqNullSafe(F.col("_source")))

    def draw(i: Column) -> Column:
        u = uniform(F.lit(str(seed)), F.lit("draw"), F.col("_id"), i.cast("string"))
        return F.size(F.filter("_cdf", lambda c: c < u))

    one = draw(F.lit(1))
    many = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda acc, i: acc + draw(i))
    rows = rows.where("_cdf is not null").withColumn("copies", F.when(F.col("_parts") == 1, one).otherwise(many)).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), "_id", F.col("copy").cast("string")).cast("binary"))
    rows = rows.withColumn("shuffle_key", key).drop("_id", "_source", "_parts", "_cdf")
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key", id_col)
