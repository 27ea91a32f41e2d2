"""Benchmark decontamination: a prefix-filtered set join in DataFrame operations.

An item is cut into windows of consecutive words, a window into shingles. A window lies in
a document only if all of its shingles do, so with shingles ordered by rarity in the whole
corpus the necessary prefix is the rarest one: only that shingle is joined with the
shingles of the documents. Where it meets a document, its offset fixes where the window
would start; the start has to lie within the document's words (positional and length
bound), and the words there must equal the window's.

Documents are cut into runs of SEGMENT words that carry the few words around them, so a
word meets the join with a bounded neighbourhood and not with its whole text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import small_or_shuffled
from sheafline.session import stored

SEGMENT = 64
SHINGLE = 3
_KEY = ["doc_id", "text_hash"]


def benchmark_words(text: Column | str) -> Column:
    """Words of a text: A-Z in lower case, cut at every other ASCII character that is no
    letter or digit; null has none. `lower` is exact for ASCII only, so texts with other
    characters are lowered word by word."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    ascii_only = lambda x: F.octet_length(x) == F.char_length(x)
    cuts = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    by_word = F.transform(F.split(text, cuts), lambda w: F.when(ascii_only(w), F.lower(w))
                          .otherwise(F.translate(w, string.ascii_uppercase,
                                                 string.ascii_lowercase)))
    return F.array_remove(F.when(ascii_only(text), F.split(F.lower(text), cuts))
                          .otherwise(by_word), "")


def _shingles(words: Column, first: Column, count: Column, width: int) -> Column:
    """Hashes of ``count`` shingles from word number ``first`` on."""
    return F.when(count > 0, F.transform(
        F.sequence(first, first + count - 1),
        lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(width))))
    ).otherwise(F.array().cast("array<bigint>"))


def _segments(docs: DataFrame, window: int) -> DataFrame:
    """Runs of words: number of the first word carried, words carried, and which of them
    the run owns."""
    words, n = F.col("words"), F.size("words")
    cut = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1, F.lit(SEGMENT)),
        lambda s: F.struct(
            F.greatest(s - window + 1, F.lit(0)).alias("start"),
            F.slice(words, F.greatest(s - window + 1, F.lit(0)) + 1,
                    F.lit(SEGMENT + 2 * window)).alias("near"),
            F.least(s, F.lit(window - 1)).alias("own"),
            F.least(n - s, F.lit(SEGMENT)).alias("owned"))))
    return docs.select(*_KEY, benchmark_words("text").alias("words")).select(
        *_KEY, F.inline(cut))


def _probes(segments: DataFrame, widths: list[int]) -> DataFrame:
    """One row per word that a segment owns and shingle width: the shingle's hash."""
    hashes = F.concat(*(F.transform(
        _shingles(F.col("near"), F.col("own"), F.col("owned"), w),
        lambda h, i: F.struct((F.col("own") + i).alias("at"), h.alias("shingle")))
        for w in widths))
    return segments.select(*_KEY, "start", "near", F.inline(hashes))


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, words) of every window; an item of fewer words is one window."""
    n, words = F.size("words"), F.col("words")
    cut = F.when(n > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))),
        lambda i: F.slice(words, i, F.lit(window))))
    return benchmark.select("item_id", benchmark_words("text").alias("words")).select(
        "item_id", F.explode(cut).alias("window"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs (doc_id, text, …)``: doc_id, n_words, n_hit (words inside
    an occurrence of a window of an item of ``benchmark (item_id, text, …)``), n_items
    (items with such a window), items_sha256 (their ids, sorted as strings and joined by
    commas), contaminated and the columns ``keep`` of docs.

    A text that is null, empty or has no word has no words and no hit; an item like that
    has no window. An item without id makes words hit but is not among the items. Rows
    that repeat a doc_id are judged each by its own text; repeated items count once. Other
    columns are ignored.
    """
    keep = keep or []
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text",
                       F.struct(*keep).alias("row") if keep else F.lit(None).alias("row"))
    cut = stored(_windows(benchmark, window).distinct(), "windows")
    whole = cut.select("window").distinct()
    widths = [r[0] for r in cut.select(
        F.least(F.size("window"), F.lit(SHINGLE))).distinct().collect()]
    size = F.size("window")
    shingles = F.lit(None).cast("array<bigint>")
    for w in widths:
        shingles = F.when(F.least(size, F.lit(SHINGLE)) == w,
                          _shingles(F.col("window"), F.lit(0), size - w + 1, w)
                          ).otherwise(shingles)
    tokens = stored(whole.select("window", F.posexplode(shingles).alias("offset", "shingle")),
                    "tokens")
    segments = _segments(docs, window)
    frequency = _probes(segments, widths or [SHINGLE]).select("shingle").join(
        small_or_shuffled(stored(tokens.select("shingle").distinct(), "shingles"), 16), "shingle"
    ).groupBy("shingle").agg(F.count("*").alias("n"))
    prefix = stored(tokens.join(frequency, "shingle").groupBy("window").agg(
        F.min(F.struct("n", "offset", "shingle")).alias("rarest")).select(
        "window", "rarest.offset", "rarest.shingle"), "prefixes")
    sent = small_or_shuffled(prefix, 40 * window)
    if sent is prefix:
        # Too many windows to send: first find the segments that hold a prefix at all.
        hot = _probes(segments, widths or [SHINGLE]).select(*_KEY, "start", "shingle").join(
            prefix.select("shingle").distinct(), "shingle", "left_semi")
        at = [*_KEY, "start"]
        hot = hot.select(*(F.col(c).alias(f"hot_{c}") for c in at)).distinct()
        segments = segments.join(hot, [F.col(c).eqNullSafe(F.col(f"hot_{c}")) for c in at],
                                 "left_semi")
    first = F.col("at") - F.col("offset")
    hits = stored(
        _probes(segments, widths or [SHINGLE]).join(sent, "shingle")
        .where((first >= 0) & (first + size <= F.size("near")))
        .where(F.slice("near", first + 1, size) == F.col("window"))
        .select(*_KEY, (F.col("start") + first).alias("first"),
                (F.col("start") + first + size).alias("last"), "window"), "hits")
    spans = F.array_sort(F.collect_set(F.struct("first", "last")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda seen, x: F.struct(
            F.greatest(seen["to"], x["last"]).alias("to"),
            (seen["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(seen["to"], x["first"])))
            .alias("n")))["n"]
    words_hit = hits.groupBy(*_KEY).agg(spans.alias("spans")).select(
        *_KEY, covered.alias("n_hit"))
    items = (hits.select(*_KEY, "window").distinct().join(cut, "window")
             .groupBy(*_KEY).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                                 .alias("items")))
    found = words_hit.join(items.withColumnsRenamed({c: f"of_{c}" for c in _KEY}), [
        F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in _KEY], "left").select(
        *(F.col(c).alias(f"hit_{c}") for c in _KEY), "n_hit", "items")
    counted = docs.select(*_KEY, "row", F.size(benchmark_words("text")).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counted.join(found, [F.col(c).eqNullSafe(F.col(f"hit_{c}")) for c in _KEY],
                        "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        *(F.col("row")[c].alias(c) for c in keep))
