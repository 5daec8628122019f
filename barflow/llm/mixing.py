"""Mixing sources to target weights: repetition rates, whole copies, and one hash-seeded Bernoulli copy.

Words are summed by source. Every source has a weight and a cap, some multiple of its own words; the
mix's words are shared by weight, and what lies above a cap is shared again among the others. The end
of that is known without the rounds: with sources in the order of cap over weight, those up to some
place stay at their cap and the others get one common number of words per unit of weight, which
running sums of caps and weights give. A source's rate is its target over its words, and each of its
documents is emitted floor(rate) times plus once more with the probability of the fraction.

That last draw compares a hash of document and seed with the fraction. A source tries ``SEEDS`` seeds
in one pass and keeps the one whose words come nearest to its target, the smallest of equal ones.

Everything is DataFrame functions. Documents are read twice, once for sizes and once to be emitted;
between the two, sources are short rows. A source with a large share of all documents is one partial
sum in each task, and documents find their source's rate by broadcast, or, with more sources than
``BROADCAST_SOURCES``, by a join in which every source is split by salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import stored
from barflow.operators.numbering import numbered, running

#: What a word is, the weights of sources in turn, the mix's share of all words in
#: hundredths, and how often a source's words are repeated at most.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, PERCENT, MOST_TIMES = (3, 1, 2), 150, 2
#: Seeds that a source tries for its last copies.
SEEDS = 32
#: Up to so many sources (a row of some numbers and a name each) are broadcast.
BROADCAST_SOURCES = 100_000
#: Parts of each source in a join without broadcast.
SALT = 16


def words(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def document_draw() -> Column:
    """What a document's draws start from. Rows equal in doc_id and text draw alike."""
    return F.xxhash64("doc_id", "text")


def uniform(draw: Column, seed: Column | int) -> Column:
    """A number from 0 up to 1 of a document and a seed."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.shiftrightunsigned(F.xxhash64(draw, seed), 11) / F.lit(float(1 << 53))


def targets(sources: DataFrame, weights: Sequence[int], percent: int, most_times: int) -> DataFrame:
    """``sources`` (source, source_size) with the words that the mix takes of each: ``target``.

    Sources take their weights in turn, in the order of their names by code point, NULL last.
    """
    named = sources.withColumn("nameless", F.col("source").isNull())
    ranked = numbered(named, ["nameless", "source"], "n", first=0)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumns({"weight": turn.cast("long"), "cap": F.col("source_size") * most_times}).withColumn(
        "per_weight", F.col("cap") / F.col("weight"))
    summed = stored(running(weighed, ["per_weight", "n"], {"caps": "cap", "weights": "weight"}), "caps")
    total, weight = summed.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return summed.withColumn("target", F.lit(0.0))
    whole = F.lit(total * percent / 100)
    # What one unit of weight gets if all sources before this one, and no other, are at their cap.
    level = (whole - (F.col("caps") - F.col("cap"))) / (F.lit(weight) - F.col("weights") + F.col("weight"))
    first = F.min(F.struct("per_weight", "n", level.alias("level")))
    common = summed.filter(F.col("per_weight") >= level).agg(first.alias("first")).select("first.level").first()[0]
    if common is None:  # all are at their caps
        return summed.withColumn("target", F.col("cap").cast("double"))
    return summed.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(common) * F.col("weight")))


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Each row with the rate of its source, however many rows that source has."""
    same = F.col("source").eqNullSafe(F.col("rated_source"))
    rates = rates.withColumnRenamed("source", "rated_source")
    if rates.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(rates), same).drop("rated_source")
    parts = rates.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = rows.withColumn("own_part", F.pmod(F.col("draw"), F.lit(SALT)).cast("int"))
    return salted.join(parts, same & (F.col("own_part") == F.col("part"))).drop("rated_source", "part", "own_part")


def rates_of(sizes: DataFrame, weights: Sequence[int], percent: int, most_times: int) -> DataFrame:
    """(source, source_size, target, rate, seed) from rows of (source, size, draw)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = stored(targets(sources, weights, percent, most_times).select(
        "source", "source_size", "target", rate.alias("rate")), "rates")
    drawn = _with_rates(sizes, rated)
    fraction = F.col("rate") - F.floor("rate")
    tries = [F.sum(F.when(uniform(F.col("draw"), seed) < fraction, F.col("size")).otherwise(0)).alias(f"t{seed}")
             for seed in range(SEEDS)]
    aimed = F.any_value("target") - F.any_value(F.floor("rate")) * F.any_value("source_size")
    found = drawn.groupBy("source").agg(aimed.alias("aimed"), *tries)
    nearest = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"t{seed}") - F.col("aimed")).alias("off"), F.lit(seed).alias("seed"))
        for seed in range(SEEDS)]))
    seeds = found.select(F.col("source").alias("seeded"), nearest["seed"].alias("seed"))
    return stored(rated.join(seeds, F.col("source").eqNullSafe(F.col("seeded"))).drop("seeded"), "seeded")


def copies() -> Column:
    """How often a row with draw, rate and seed is emitted."""
    whole = F.floor("rate")
    more = (uniform(F.col("draw"), F.col("seed")) < F.col("rate") - whole).cast("long")
    return whole + more


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most_times: int = MOST_TIMES
) -> DataFrame:
    """``documents``, each row as often as the mix takes it, with the copy's number from 1 in ``copy``.

    A NULL text has no words; a NULL source is a source of its own, the last one. Documents without
    words follow the rate of their source; a source without any word is left out. Repeated rows are
    documents of their own, but rows equal in doc_id and text draw alike. Runs on the same rows agree.
    An empty table gives no rows. A column named ``copy`` is replaced; other columns stay.
    """
    rates = rates_of(_sizes(documents), weights, percent, most_times)
    inner = documents.select(
        "source", document_draw().alias("draw"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document"))
    times = _with_rates(inner, rates).withColumn("times", copies()).filter("times > 0")
    return times.select(
        *[F.col(f"document.`{c}`") for c in documents.columns if c != "copy"],
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))


def _sizes(documents: DataFrame) -> DataFrame:
    return stored(documents.select(
        "doc_id", "source", words(F.col("text")).alias("size"), document_draw().alias("draw")), "sizes")


def shares(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most_times: int = MOST_TIMES
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: what ``mix`` emits, a row for each document."""
    sizes = _sizes(documents)
    return _with_rates(sizes, rates_of(sizes, weights, percent, most_times)).withColumn("copies", copies()).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
