"""Substring dedup: words inside a window of 35 words that occurs elsewhere are removed.

1. Each text is cut by winnowing: a window chooses the smallest hash among its 6-word
   grams, and windows in a row that choose the same gram form a piece. Every window start
   lies in one piece, and equal windows choose equal grams wherever they occur, so
   windows have to be compared only between pieces of the same gram. About one word in
   fifteen starts a piece.
2. Pieces whose gram occurs once are done. Of the others, equal pieces become one with a
   count before anything else is shuffled.
3. The distinct pieces of one gram are a reference shard. The task that holds a shard
   builds its suffix automaton, with the number of occurrences of every substring, and
   streams the pieces through it: where the matching statistic reaches 35 words and the
   matched substring occurs twice, the window is a repeat. Shards are bounded: a gram with
   more pieces is cut into single windows, which Spark counts by a 128-bit digest of their
   words, so that copies of a window are added up before they travel.
4. Each document gets its repeated windows back and drops the words that they cover.

A single set of automata sent to all executors would grow with the corpus, and streaming
every document past every shard would be quadratic; so shards and the pieces that can
match them travel to the same task instead of being broadcast. The automata compare
words, not hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import by_key, small_or_shuffled
from sheafline.llm.words import WordHashes, byte_texts, gram_hashes
from sheafline.session import stored

GRAM = 6
#: Distinct pieces that one suffix automaton is built over.
SHARD_PIECES = 2000


class SuffixAutomaton:
    """Of several word sequences, each with a number of times that it occurs."""

    def __init__(self) -> None:
        self.length, self.link, self.next, self.count = [0], [-1], [{}], [0]

    def _state(self, length: int, link: int, after: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(after)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The state that ``word`` leads to from ``p``, cut off from ``q`` if that one
        also stands for longer substrings."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes], times: int) -> None:
        state = 0
        for word in words:
            if word in self.next[state]:
                state = self._split(state, word, self.next[state][word])
            else:
                new = self._state(self.length[state] + 1, 0, {})
                p = state
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word, self.next[p][word])
                state = new
            self.count[state] += times

    def finish(self) -> None:
        """Every occurrence of a substring is one of its suffixes too."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__,
                            reverse=True):
            self.count[self.link[state]] += self.count[state]

    def repeated(self, words: list[bytes], window: int) -> list[bool]:
        """For each window of ``words``, whether it occurs at least twice."""
        state = matched = 0
        found = []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            if i >= window - 1:
                found.append(matched >= window and self.count[state] > 1)
        return found


def _pieces(window: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            grams, bodies, docs, places = [], [], [], []
            for row, text in enumerate(byte_texts(batch.column(2))):
                words = text.split() if text else ()
                if len(words) < window:
                    continue
                codes = hashes.of(words)
                gram = gram_hashes(codes, GRAM)
                chosen = np.lib.stride_tricks.sliding_window_view(
                    gram, window - GRAM + 1).argmin(axis=1)
                chosen = chosen + np.arange(len(chosen))
                first = np.flatnonzero(np.diff(chosen, prepend=-1))
                many = np.diff(first, append=len(chosen))
                raw = codes.tobytes()
                bodies += [xxhash.xxh3_64_intdigest(raw[8 * s:8 * (s + n + window - 1)])
                           for s, n in zip(first.tolist(), many.tolist())]
                grams.append(gram[chosen[first]])
                places.append(first * 64 + many)
                docs += [row] * len(first)
            none = [np.empty(0, np.uint64)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(none + grams).view(np.int64)),
                pa.array(np.array(bodies, np.uint64).view(np.int64)),
                batch.column(0).take(pa.array(docs, pa.int32())),
                batch.column(1).take(pa.array(docs, pa.int32())),
                pa.array(np.concatenate([np.empty(0, np.int64), *places]))],
                names=["gram", "body", "doc_id", "text_hash", "place"])
    return run


def _contents(window: int):
    """Words of the pieces of each document."""
    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("gram", "body", "times", "words")}
            for text, pieces in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                words = text.split()
                for p in pieces:
                    for name, value in (
                            ("gram", p["gram"]), ("body", p["body"]), ("times", p["times"]),
                            ("words", b" ".join(
                                words[p["start"]:p["start"] + p["n"] + window - 1]))):
                        rows[name].append(value)
                if len(rows["gram"]) >= 4096:
                    yield _batch(rows, words=pa.binary())
                    rows = {k: [] for k in rows}
            yield _batch(rows, words=pa.binary())
    return run


def _windows(window: int):
    """Digests of the single windows of the pieces of each document."""
    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("gram", "body", "times", "at", "digest")}
            for text, pieces in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                words = text.split()
                for p in pieces:
                    for i in range(p["n"]):
                        first = p["start"] + i
                        for name, value in (
                                ("gram", p["gram"]), ("body", p["body"]), ("times", p["times"]),
                                ("at", i), ("digest", xxhash.xxh3_128_digest(
                                    b" ".join(words[first:first + window])))):
                            rows[name].append(value)
                if len(rows["gram"]) >= 4096:
                    yield _batch(rows, at=pa.int32(), digest=pa.binary())
                    rows = {k: [] for k in rows}
            yield _batch(rows, at=pa.int32(), digest=pa.binary())
    return run


def _batch(rows: dict, **more: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(rows, pa.schema([
        ("gram", pa.int64()), ("body", pa.int64()), ("times", pa.int64()), *more.items()]))


def _shard_repeats(window: int):
    def run(key, rows):
        automaton = SuffixAutomaton()
        pieces = [x.split() for x in rows["words"]]
        for words, times in zip(pieces, rows["times"]):
            automaton.add(words, times)
        automaton.finish()
        masks = [sum(r << i for i, r in enumerate(automaton.repeated(words, window)))
                 for words in pieces]
        return {"gram": rows["gram"], "body": rows["body"], "mask": masks}
    return run


def _kept(window: int):
    def run(batches):
        bits = np.arange(window)
        for batch in batches:
            total, removed, digests, texts = [], [], [], []
            for text, spans in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split() if text else []
                total.append(len(words))
                if spans:
                    starts = np.array([s["start"] for s in spans])
                    masks = np.array([s["mask"] for s in spans])
                    starts = (starts[:, None] + bits)[(masks[:, None] >> bits) & 1 == 1]
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + window, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                removed.append(total[-1] - len(words))
                texts.append(b" ".join(words))
                digests.append(hashlib.sha256(texts[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per row of ``docs (doc_id, text, …)``: doc_id, n_words, n_removed,
    kept_sha256 and kept_text (the words left, joined by single spaces).

    Words are cut at ASCII white space and compared as they are. A word goes if a window
    of ``window`` consecutive words over it also starts anywhere else, in the same text
    too; all copies go. Texts shorter than a window, empty and null ones lose nothing.
    Repeated rows are further occurrences of all they hold, whatever their doc_id; a null
    doc_id is kept as it is. Other columns are ignored.
    """
    if not GRAM <= window <= GRAM + 57:
        raise ValueError("a window has 6 to 63 words")
    key = ["doc_id", "text_hash"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), "text")
    # The place of a piece is its first word times 64 plus its number of windows.
    anchors = stored(docs.mapInArrow(
        _pieces(window), "gram long, body long, doc_id long, text_hash long, place long"),
        "pieces")
    # Stored sides are plain scans, so that adaptive execution can split a hot gram.
    often = stored(anchors.groupBy("gram").agg(F.count("*").alias("times"))
                   .where("times > 1").select("gram"), "often")
    repeated = stored(anchors.join(often, "gram"), "repeated")
    classes = stored(repeated.groupBy("gram", "body").agg(
        F.count("*").alias("times"),
        F.min(F.struct(*key, "place")).alias("at")), "classes")
    mixed = (classes.groupBy("gram").agg(F.count("*").alias("pieces")).where("pieces > 1")
             .select("gram", (F.col("pieces") > SHARD_PIECES).alias("hot")))
    wanted = stored(classes.join(mixed, "gram").groupBy(
        "hot", F.col("at.doc_id").alias("in_doc"), F.col("at.text_hash").alias("in_text")).agg(
        F.collect_list(F.struct("gram", "body", "times",
                                F.shiftright("at.place", 6).alias("start"),
                                F.col("at.place").bitwiseAND(F.lit(63)).alias("n"))).alias("pieces")), "wanted")
    in_doc = [F.col("doc_id").eqNullSafe(F.col("in_doc")), F.col("text_hash") == F.col("in_text")]

    def held(pieces: DataFrame) -> DataFrame:
        # Rows that repeat a document hold the same pieces once.
        holders = docs.join(small_or_shuffled(pieces.select("in_doc", "in_text"), 24), in_doc,
                            "left_semi").dropDuplicates(key)
        return holders.join(pieces, in_doc).select("text", "pieces")

    masks = by_key(held(wanted.where("not hot")).mapInArrow(
        _contents(window), "gram long, body long, times long, words binary"),
        ["gram"], _shard_repeats(window), "gram long, body long, mask long")
    hot = wanted.where("hot")
    if not hot.isEmpty():
        single = stored(held(hot).mapInArrow(
            _windows(window), "gram long, body long, times long, at int, digest binary"), "windows")
        twice = stored(single.groupBy("gram", "digest").agg(F.sum("times").alias("n"))
                       .where("n > 1").select("gram", "digest"), "twice")
        # A piece without a repeated window needs its mask of 0 too.
        masks = masks.unionByName(
            single.join(twice.withColumn("found", F.lit(1).cast("long")), ["gram", "digest"], "left")
            .groupBy("gram", "body").agg(F.bit_or(F.expr(
                "shiftleft(coalesce(found, 0L), at)")).alias("mask")))
    all_ones = F.expr("shiftleft(1L, int(place & 63)) - 1")
    whole = classes.join(masks, ["gram", "body"], "left").select(
        "gram", "body", F.when(F.col("mask").isNull(), F.lit(-1)).otherwise(F.col("mask"))
        .alias("mask")).where("mask <> 0")
    spans = (repeated.join(whole, ["gram", "body"]).groupBy(
        F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_text")).agg(
        F.collect_set(F.struct(F.shiftright("place", 6).alias("start"),
                               F.col("mask").bitwiseAND(all_ones).alias("mask")))
        .alias("spans")))
    return docs.join(spans, in_doc, "left").select("doc_id", "text", "spans").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, "
        "kept_text string")
