"""Source divergence audit: how far the term shares of a source are from other sources of
its language, and by which terms they leave the language's own.

1. Workers count terms per (lang, source) and hand on partial counts; one shuffle by
   (lang, term) completes them, so a hot source is added up before it travels.
2. The kept terms of a language are dealt over blocks of about BLOCK_TERMS by a hash and
   numbered inside their block. A group's share of a block is one pair of arrays, sorted
   term ids and counts.
3. A pair task holds the arrays of up to two tiles of TILE_SOURCES groups for one block and
   merges every unordered pair once: the smaller array is looked up in the larger one,
   and terms of both, of one and of neither are priced in both directions. No group is ever
   whole in one task, and arrays travel once for every TILE_SOURCES sources of a language.
4. Spark adds up the blocks.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.llm.common import small_or_shuffled
from sheafline.session import stored

BLOCK_TERMS = 1 << 14
TILE_SOURCES = 32
#: Partial counts that a worker holds before it hands them on.
HELD_TERMS = 200_000
SCALE = 1_000_000_000
_OTHER = bytes(b for b in range(128) if not chr(b).isalpha())
_LOWER = bytes.maketrans(_OTHER, b" " * len(_OTHER))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in _LOWER)

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
                     ("n", pa.int64()), ("documents", pa.int64())])


def _counts(batches):
    """Occurrences of each term and documents with it, per language and source."""
    held = defaultdict(lambda: (Counter(), Counter()))

    def rows():
        for (lang, source), (n, documents) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                    pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()),
                    pa.array([documents[t] for t in n], pa.int64())], schema=_COUNTS)
        held.clear()

    for batch in batches:
        size = 0
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      batch.column(2).cast(pa.binary())):
            n, documents = held[lang, source]
            terms = text.as_buffer().to_pybytes().translate(_LOWER).split()
            n.update(terms)
            documents.update(set(terms))
            size += len(terms)
            if size > HELD_TERMS:
                if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                    yield from rows()
                size = 0
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from rows()
    yield from rows()


def price(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact for totals up to 2^48; a count is
    below the total. The scale is applied in two steps so that products fit 64 bits."""
    high, rest = np.divmod((np.asarray(counts, np.int64) + 1) * 32_000, total)
    return 1 + high * 31_250 + rest * 31_250 // total


def _price(count: Column, total: Column) -> Column:
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return 1 + F.call_function("div", scaled, total.cast("decimal(19,0)"))


def _apart(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) ** 2 // q).sum())


def merge_pair(a: tuple, b: tuple, terms: int) -> tuple[int, int]:
    """Divergence of a from b and of b from a over one block of ``terms`` terms. a and b are
    (sorted ids, prices, price of an absent term)."""
    ids, prices, absent = a
    other_ids, other_prices, other_absent = b
    if len(ids) > len(other_ids):
        return merge_pair(b, a, terms)[::-1]
    at = np.searchsorted(other_ids, ids)
    shared = at < len(other_ids)
    shared[shared] = other_ids[at[shared]] == ids[shared]
    met = np.zeros(len(other_ids), bool)
    met[at[shared]] = True
    p = np.concatenate([prices[shared], prices[~shared],
                        np.full((~met).sum(), absent, np.int64)])
    q = np.concatenate([other_prices[met], np.full((~shared).sum(), other_absent, np.int64),
                        other_prices[~met]])
    neither = terms - len(p)
    none = np.array([absent]), np.array([other_absent])
    return (_apart(p, q) + neither * _apart(*none), _apart(q, p) + neither * _apart(*none[::-1]))


_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
                    ("ab", pa.int64()), ("ba", pa.int64())])


def _pair_task(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    lang, _, low, high = (k.as_py() for k in key)
    rows = rows.combine_chunks()
    names = ("nth", "total", "v", "terms", "ids", "counts")
    nth, total, v, terms = (rows.column(n).to_pylist() for n in names[:4])
    of: dict[int, tuple] = {}
    block_terms = max((t for t in terms if t is not None), default=0)
    none = np.empty(0, np.int64)
    for i, group in enumerate(nth):
        all_terms = total[i] + v[i]
        absent = int(price(np.array([0]), all_terms)[0]) if all_terms else 1
        if terms[i] is not None:
            of.setdefault(group, (none, none, absent))
        else:
            ids = rows.column("ids")[i].values.to_numpy(zero_copy_only=False)
            counts = rows.column("counts")[i].values.to_numpy(zero_copy_only=False)
            of[group] = (ids, price(counts, all_terms), absent)
    out = {n: [] for n in _PAIRS.names}
    for a in (g for g in of if g // TILE_SOURCES == low):
        for b in (g for g in of if g // TILE_SOURCES == high):
            if a < b:
                ab, ba = merge_pair(of[a], of[b], block_terms)
                for name, value in zip(out, (lang, a, b, ab, ba)):
                    out[name].append(value)
    return pa.Table.from_pydict(out, _PAIRS)


def source_divergence(docs: DataFrame, least_documents: int = 3, top: int = 200) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every occurring (lang, source) of
    ``docs (text, lang, source, …)``; null text, lang and source are ''.

    Terms are runs of A-Z, a-z and characters above ASCII, with A-Z lower-cased. A language
    keeps the terms that ``least_documents`` of its rows hold (equal rows count each). A
    group, and the language as a whole, price a kept term at 1 + floor(10^9 * (count + 1) /
    (N + V)), V being the number of kept terms and N the sum of their counts there. Part
    ``pair`` has each other source of the language with the sum over kept terms of
    floor((p - q)^2 / q), q the other's price; 0 if the language keeps no term. Part ``term``
    has the ``top`` kept terms of the group with p > q, q the language's price. Ranks go by
    falling value, equal values by item in UTF-8 order. Other columns are ignored.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = docs.mapInArrow(
        _counts, "lang string, source string, term binary, n long, documents long")
    # Both groupings keep the one exchange by (lang, term).
    kept = stored(
        partial.repartition("lang", "term").groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
        .groupBy("lang", "term").agg(
            F.sum("documents").alias("documents"), F.sum("n").alias("in_lang"),
            F.collect_list(F.struct("source", "n")).alias("held"))
        .where(F.col("documents") >= least_documents)
        .select("lang", F.col("term").cast("string").alias("term"), "in_lang", "held"), "kept")
    each = kept.select("lang", "term", "in_lang", F.inline("held"))
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total"))
    zero = {"total": 0, "v": 0, "lang_total": 0}
    groups = stored(
        docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left").fillna(zero)
        .withColumn("blocks", F.greatest(F.ceil(F.col("v") / BLOCK_TERMS), F.lit(1)))
        .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("sources", F.count("*").over(Window.partitionBy("lang"))), "groups")
    of_lang = small_or_shuffled(
        stored(groups.select("lang", "v", "lang_total", "blocks").distinct(), "langs"), 64)
    small = small_or_shuffled(groups, 120)

    numbered = kept.join(of_lang, "lang").withColumn(
        "block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    ids = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    arrays = (
        numbered.withColumn("id", ids.cast("long"))
        .select("lang", "block", "id", F.inline("held"))
        .groupBy("lang", "block", "source")
        .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("sparse")))
    held = arrays.join(small, ["lang", "source"]).select(
        "lang", "block", "nth", "sources", "total", "v", F.lit(None).cast("long").alias("terms"),
        F.col("sparse.id").alias("ids"), F.col("sparse.n").alias("counts"))
    # One row per group and block says how many terms a block has, also where it has none.
    none = F.array().cast("array<long>")
    frame = groups.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).join(
        numbered.groupBy("lang", "block").agg(F.count("*").alias("terms")), ["lang", "block"], "left"
    ).select("lang", "block", "nth", "sources", "total", "v",
             F.coalesce("terms", F.lit(0).cast("long")).alias("terms"),
             none.alias("ids"), none.alias("counts"))
    tile = F.floor(F.col("nth") / TILE_SOURCES)
    last = F.floor((F.col("sources") - 1) / TILE_SOURCES)
    pairs = (
        held.unionByName(frame).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("low", F.least("other", tile)).withColumn("high", F.greatest("other", tile))
        .drop("other", "sources").groupBy("lang", "block", "low", "high")
        .applyInArrow(_pair_task, "lang string, a int, b int, ab long, ba long")
        .groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba")))
    both = pairs.select("lang", F.inline(F.array(
        F.struct(F.col("a").alias("nth"), F.col("b").alias("other"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("nth"), F.col("a").alias("other"), F.col("ba").alias("value")))))
    name = small_or_shuffled(groups, 120).select("lang", "nth", "source")
    by_pair = both.join(name, ["lang", "nth"]).join(
        name.select("lang", F.col("nth").alias("other"), F.col("source").alias("item")),
        ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = _price(F.col("n"), F.col("total") + F.col("v")), _price(
        F.col("in_lang"), F.col("lang_total") + F.col("v"))
    by_term = (
        each.join(small.select("lang", "source", "total", "v", "lang_total"), ["lang", "source"])
        .select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                F.expr("(p - q) * (p - q) div q").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return by_pair.withColumn("rank", F.row_number().over(order)).unionByName(
        by_term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
