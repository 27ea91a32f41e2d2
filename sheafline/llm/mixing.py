"""Mixing sources to target weights, in DataFrame operations only.

Sources get weights in proportion to their token shares raised to an exponent between 0
(all alike) and 1 (as they are). The exponent is bisected to the largest one whose entropy
meets a target, but not so far down that a source would repeat more often than a limit.
Each source's part of the token budget is then realised as passes over its documents: all
whole passes that fit, and of one more pass the documents that a pseudo-random permutation
puts first, as long as they fit.

Every emitted document has a slot between 0 and 1, in which each source is spread evenly
over the whole mix: any block of slots holds the sources in their target weights, in a
permuted order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sheafline.llm.common import small_or_shuffled
from sheafline.session import stored

#: Share of the largest possible entropy that the weights should reach.
ENTROPY_SHARE = 0.92
#: Most passes over a source.
REPETITIONS = 4.0
BLOCKS = 64
#: Parts of a permutation whose tokens are summed before any of it is ordered.
BUCKETS = 1024
#: Exponents tried in one job, and jobs: a resolution of 16^-7.
SECTIONS, STEPS = 16, 7
#: Decimals of the exponent that count.
DIGITS = 6


def token_count(text: Column | str) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x09-\x0D\x20]+")), F.lit(0)).cast("long")


def _bisected(sources: DataFrame, total: int, below: Callable[[Row], bool]) -> float:
    """Where ``below``, which is true for exponents from some point on, begins to be true; 1
    if nowhere, 0 if always. It gets, for the sources' powers p of one exponent, their sum
    ``every``, the sum ``logs`` of p log p and the maximum ``most`` of p / tokens. Each job
    tries SECTIONS - 1 exponents between the bounds and joins nothing: a broadcast takes a
    page of an executor's memory, however small it is."""
    low, high = 0.0, 1.0
    for step in range(STEPS):
        tried = [low + (high - low) * i / SECTIONS for i in range(0 if step == 0 else 1, SECTIONS)]
        power = sources.select("tokens", F.explode(F.array(*map(F.lit, tried))).alias("a")).select(
            "tokens", "a", F.pow(F.col("tokens") / F.lit(float(total)), F.col("a")).alias("power"))
        found = power.groupBy("a").agg(
            F.sum("power").alias("every"), F.sum(F.col("power") * F.log("power")).alias("logs"),
            F.max(F.col("power") / F.col("tokens")).alias("most"))
        reached = [r["a"] for r in found.collect() if below(r)]
        if 0.0 in reached:
            return 0.0
        high = min(reached, default=high)
        low = max(a for a in [low, *tried] if a < high)
    return high


def exponent(sources: DataFrame, total: int, budget: int, entropy_share: float,
             repetitions: float) -> float:
    """The exponent for ``sources (source, tokens)``, to DIGITS decimals: the largest whose
    weights reach the entropy, or the smallest within the repetition limit if that is
    larger."""
    n = sources.count()
    if n < 2:
        return 1.0
    # Of the weights p / every: the entropy, and the most passes over a source.
    by_entropy = _bisected(sources, total, lambda r: math.log(r["every"]) - r["logs"] / r["every"]
                           < entropy_share * math.log(n))
    by_limit = _bisected(sources, total, lambda r: budget * (r["most"] / r["every"]) <= repetitions)
    return round(max(by_entropy, by_limit), DIGITS)


def _chance(source: Column, turn: Column, doc_id: Column) -> Column:
    """A number in 0..1 from the leading 52 bits of an MD5 digest."""
    text = F.concat_ws("|", source, turn.cast("string"),
                       F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(docs: DataFrame, keep: list[str], budget: int | None = None,
        entropy_share: float = ENTROPY_SHARE, repetitions: float = REPETITIONS) -> DataFrame:
    """The columns ``keep`` of ``docs (doc_id, text, source, …)``, one row for each time
    that a document is drawn, with pass (from 0), slot (0 to 1, the order of the mix),
    block (of slots, 0 to BLOCKS - 1) and n_tokens. ``budget`` is in tokens; the default
    is what there is.

    A null source counts as the empty string. Documents without words are never drawn.
    Rows that repeat a doc_id are drawn each, with equal slots; a null doc_id is an empty
    string to the permutation. A budget beyond ``repetitions`` passes over everything is
    cut to that. No rows give no rows. Columns in ``keep`` are replaced if they are named
    like the new ones.
    """
    source = F.coalesce("source", F.lit(""))
    # Words are counted once; later passes read what they need of the stored rows.
    counted = stored(docs.select(F.struct(*keep).alias("row"), source.alias("source"), "doc_id",
                                 token_count("text").alias("n_tokens")).where("n_tokens > 0"), "mix_counted")
    sources = stored(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = min(total if budget is None else budget, int(repetitions * total))
    power = exponent(sources, total, budget, entropy_share, repetitions)
    share = F.pow(F.col("tokens") / F.lit(float(max(1, total))), F.lit(power))
    every = sources.agg(F.sum(share)).first()[0] or 1.0
    quota = F.floor(F.lit(float(budget)) * share / F.lit(every) + F.lit(1e-6))
    plan = stored(sources.select("source", "tokens", quota.alias("quota")).select(
        "source", "tokens", "quota", F.floor(F.col("quota") / F.col("tokens")).alias("passes"),
        (F.col("quota") % F.col("tokens")).alias("rest")), "mix_plan")
    planned = counted.join(small_or_shuffled(plan, 100), "source").withColumn(
        "u", _chance(F.col("source"), F.col("passes"), F.col("doc_id"))).withColumn(
        "bucket", F.floor(F.col("u") * BUCKETS).cast("int"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = planned.groupBy("source", "bucket", "rest").agg(F.sum("n_tokens").alias("within"))
    buckets = stored(sums.withColumn("before", F.coalesce(F.sum("within").over(ahead), F.lit(0)))
                     .where("before < rest").select(
        "source", "bucket", "before", (F.col("before") + F.col("within") <= F.col("rest"))
        .alias("whole")), "mix_buckets")
    last = planned.join(small_or_shuffled(buckets, 60), ["source", "bucket"])
    inside = Window.partitionBy("source", "bucket").orderBy("u", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = last.where("not whole").withColumn(
        "sum", F.col("before") + F.sum("n_tokens").over(inside)).where("sum <= rest").drop("sum")
    partial = last.where("whole").unionByName(cut).select(
        "row", "source", "n_tokens", "quota", "tokens", F.col("passes").alias("pass"), "u")
    passes = planned.where("passes > 0").select(
        "row", "source", "doc_id", "n_tokens", "quota", "tokens", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).alias("pass"))
    whole = passes.select("row", "source", "n_tokens", "quota", "tokens", "pass",
                          _chance(F.col("source"), F.col("pass"), F.col("doc_id")).alias("u"))
    slot = (F.col("pass") + F.col("u")) * F.col("tokens") / F.col("quota")
    slot = F.least(slot, F.lit(1.0))
    new = {"pass": F.col("pass").cast("int"), "slot": F.round(slot, 9),
           "block": F.least(F.floor(slot * BLOCKS), F.lit(BLOCKS - 1)).cast("int"),
           "n_tokens": F.col("n_tokens")}
    return whole.unionByName(partial).select(
        *(F.col("row")[c].alias(c) for c in keep if c not in new),
        *(v.alias(c) for c, v in new.items()))
