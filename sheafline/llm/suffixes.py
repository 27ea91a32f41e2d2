"""Suffix-array dedup: bytes inside a 200-byte string that also starts elsewhere go.

1. Winnowing: every window of 200 bytes chooses the smallest hash among its 48-byte grams.
   Windows in a row with the same gram form a segment. Equal windows choose equal grams
   wherever they start, so a window has to be compared with windows of its own gram only.
2. Segments whose gram occurs once are done. Of the others, Spark counts equal ones by
   gram, digest and bytes, so copies add up before they travel. Distinct segments are
   sorted by gram over partitions and cut into runs of whole grams of about RUN_BYTES.
3. A run is cut into shards of SHARD_BYTES. Each shard gets its suffix array (the order
   behind its Burrows-Wheeler transform) with the length at which neighbours part. The
   shards are merged by refining one interleave of their orders: at first by 8 bytes, then
   a suffix is told from others of its block by the block of the suffix that its LF mapping,
   applied h times, came from. A round doubles the length that is settled. Blocks that hold
   suffixes of one shard are never sorted again: their inner borders are the shard's own.
   One symbol a round, as the method is written, needs 200 passes over all suffixes instead
   of five over the undecided.
4. After 200 bytes the blocks are the intervals of equal windows. One that starts twice or
   more, copies counted, is repeated.
5. Texts get the intervals of their segments back and lose the bytes that these cover.

A gram with more than RUN_BYTES of distinct segments (one passage in very many different
texts) is not one run: its windows are counted by a 128-bit cryptographic digest instead,
with copies added up before the shuffle, so no task holds the gram.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import BROADCAST_BYTES
from sheafline.llm.words import mixed
from sheafline.session import stored

#: Bytes of distinct segments that are merged at a time, and those of one shard.
RUN_BYTES = 1 << 20
SHARD_BYTES = 1 << 18
#: Windows of one segment at most, and window starts of a text that are hashed at a time.
SEGMENT_WINDOWS = 512
BLOCK = 1 << 22
_BASE = 0x9E3779B97F4A7C15
_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_PLACE_BITS = np.uint64(24)


def _gram_hashes(text: np.ndarray, width: int) -> np.ndarray:
    """A polynomial hash modulo 2^64 of every ``width`` bytes in a row, scrambled."""
    power = lambda e: np.uint64(pow(_BASE, e, 1 << 64))
    level, size, out, done = _CODES[text], 1, None, 0
    while True:
        if width & size:
            if out is None:
                out, done = level, size
            else:
                n = len(text) - done - size + 1
                out = out[:n] * power(size) + level[done:done + n]
                done += size
        if done == width:
            return mixed(out[:len(text) - width + 1])
        level = level[:-size] * power(size) + level[size:]
        size *= 2


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments(text: np.ndarray, window: int, width: int):
    """First window, number of windows, gram and least number of places of the gram, of
    every segment of ``text``. Long texts are hashed BLOCK window starts at a time."""
    found = []
    for first in range(0, len(text) - window + 1, BLOCK):
        hashes = _gram_hashes(text[first:first + BLOCK + window - 1], width)
        places = np.arange(len(hashes), dtype=np.uint64)
        packed = (hashes >> _PLACE_BITS << _PLACE_BITS) | places
        chosen = (_smallest(packed, window - width + 1)
                  & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        start = np.flatnonzero(np.diff(chosen, prepend=-1))
        gram = hashes[chosen[start]]
        # Places in a row with the same gram, as in periodic texts, are one segment.
        head = np.flatnonzero(np.diff(gram, prepend=~gram[:1]))
        times = np.minimum(np.diff(head, append=len(start)), 2)
        start, gram = start[head], gram[head]
        many = np.diff(start, append=len(chosen))
        parts = -(-many // SEGMENT_WINDOWS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(start, parts) + nth * SEGMENT_WINDOWS
        found.append((begin + first,
                      np.minimum(np.repeat(start + many, parts) - begin, SEGMENT_WINDOWS),
                      np.repeat(gram, parts), np.repeat(times, parts)))
    return tuple(map(np.concatenate, zip(*found)))


def _anchors(window: int, width: int):
    def run(batches):
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                text = text.as_buffer()
                if text is not None and text.size >= window:
                    found.append(segments(np.frombuffer(text, np.uint8), window, width))
                    rows.append(np.full(len(found[-1][0]), row, np.int32))
                if sum(map(len, rows)) >= 1 << 17:
                    yield _anchor_batch(batch, rows, found)
                    rows, found = [], []
            if rows:
                yield _anchor_batch(batch, rows, found)
    return run


def _anchor_batch(batch, rows, found) -> pa.RecordBatch:
    begin, many, gram, times = map(np.concatenate, zip(*found))
    return pa.RecordBatch.from_arrays([
        pa.array(gram.view(np.int64)), batch.column(0).take(pa.array(np.concatenate(rows))),
        pa.array(begin), pa.array(many.astype(np.int32)), pa.array(times.astype(np.int32))],
        names=["gram", "text_id", "start", "n", "places"])


_PIECES = pa.schema([("gram", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()),
                     ("copies", pa.int64()), ("text_id", pa.binary()), ("start", pa.int64())])


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _bodies(window: int):
    """Bytes of the segments of each text; batches of a few MB."""
    def run(batches):
        held, size = {n: [] for n in _PIECES.names}, 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].cast(pa.binary()).as_buffer().to_pybytes()
                own, copies = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                for s in batch.column(3)[i].as_py():
                    body = text[s["start"]:s["start"] + s["n"] + window - 1]
                    for name, value in zip(held, (s["gram"], _digest(body), body, copies, own,
                                                  s["start"])):
                        held[name].append(value)
                    size += len(body)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pydict(held, _PIECES)
                        held, size = {n: [] for n in _PIECES.names}, 0
        if size:
            yield pa.RecordBatch.from_pydict(held, _PIECES)
    return run


def _steps(window: int) -> list[tuple[int, int]]:
    """Rounds of refinement: (length settled before, jump)."""
    out, h = [], 8
    while h < window:
        jump = min(h, window - h)
        out.append((h, jump))
        h += jump
    return out


def _first_eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that sorts like them; zeros follow
    the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    level = padded << np.uint64(8)
    level[:-1] |= padded[1:]
    for size in (2, 4):
        more = level << np.uint64(8 * size)
        more[:-size] |= level[size:]
        level = more
    return level[:len(text)]


class Shard:
    """A suffix array by the first ``window`` bytes. ``parted[r]`` is the round in which
    suffix r of the order parted from the one before: 0 within eight bytes, then the number
    of the doubling, and one more than the last if their first ``window`` bytes are equal."""

    def __init__(self, text: np.ndarray, window: int) -> None:
        self.text, n = text, len(text)
        self.keys = _first_eight(text)
        order = np.argsort(self.keys, kind="stable")
        parted = np.full(n, len(_steps(window)) + 1, np.uint8)
        parted[np.diff(self.keys[order], prepend=~self.keys[order[:1]]) != 0] = 0
        rank = np.empty(n + window, np.int64)
        rank[n:] = -1
        for number, (_, jump) in enumerate(_steps(window), 1):
            border = parted < number
            rank[order] = np.cumsum(border)
            together = ~border
            together[:-1] |= together[1:]
            at = np.flatnonzero(together)
            if not len(at):
                break
            some = order[at]
            key = rank[some] << 32 | (rank[some + jump] + 1)
            by = np.argsort(key, kind="stable")
            order[at], key = some[by], key[by]
            new = at[1:][np.diff(key) != 0]
            parted[new[parted[new] > number]] = number
        self.order, self.parted = order, parted


def merged(shards: list[Shard], window: int) -> tuple[np.ndarray, np.ndarray]:
    """One interleave of the orders of ``shards`` by the first ``window`` bytes: places in
    the concatenated texts, and which of them begin a block of equal windows."""
    sizes = [len(s.text) for s in shards]
    first = np.cumsum([0, *sizes])
    n, rounds = int(first[-1]), _steps(window)
    order = np.concatenate([s.order + f for s, f in zip(shards, first)])
    owner = np.repeat(np.arange(len(shards), dtype=np.int16), sizes)
    keys = np.concatenate([s.keys[s.order] for s in shards])
    by = np.argsort(keys, kind="stable")
    order, keys = order[by], keys[by]
    border = np.diff(keys, prepend=~keys[:1]) != 0
    if len(shards) == 1:
        return order, shards[0].parted <= len(rounds)
    parted = np.empty(n, np.uint8)
    for s, f in zip(shards, first):
        parted[s.order + f] = s.parted
    rank = np.empty(n + window, np.int64)
    rank[n:] = -1
    # A suffix that runs over the end of its shard reads on in the next one, unlike in the
    # shard's own order. Such suffixes start no window; they only have to stay put.
    for number, (_, jump) in enumerate(rounds, 1):
        block = np.cumsum(border)
        rank[order] = block
        start = np.flatnonzero(border)
        own = owner[order]
        blended = (np.maximum.reduceat(own, start) != np.minimum.reduceat(own, start))[block - 1]
        at = np.flatnonzero(blended)
        border |= ~blended & (parted[order] == number)
        if len(at):
            some = order[at]
            ahead = some + jump
            over = ahead >= first[owner[some] + 1]
            key = block[at] << 32 | np.where(over, 0, rank[ahead])
            by = np.argsort(key, kind="stable")
            order[at], key = some[by], key[by]
            border[at[1:][np.diff(key) != 0]] = True
    return order, border


def repeated_windows(bodies: list[bytes], times: list[int], window: int) -> list[list[int]]:
    """For each body the bounds (from, to, from, to, …) of its windows that start twice or
    more among all ``bodies``, a body counting ``times``."""
    texts, size = [], 0
    shards, held = [], []
    for body in bodies:
        held.append(body)
        size += len(body)
        if size >= SHARD_BYTES:
            shards.append(Shard(np.frombuffer(b"".join(held), np.uint8), window))
            held, size = [], 0
    if held:
        shards.append(Shard(np.frombuffer(b"".join(held), np.uint8), window))
    lengths = np.array([len(b) for b in bodies])
    order, border = merged(shards, window)
    del texts, shards
    begin = np.cumsum(lengths) - lengths
    last = begin + lengths - window
    # Places behind the last window of a body start no window: they weigh nothing.
    change = np.zeros(int(lengths.sum()) + 1, np.int64)
    np.add.at(change, begin, np.array(times))
    np.add.at(change, last + 1, -np.array(times))
    weight = np.cumsum(change[:-1])
    start = np.flatnonzero(border)
    total = np.add.reduceat(weight[order], start)
    found = np.zeros(len(weight) + 1, bool)
    found[order] = np.repeat(total > 1, np.diff(start, append=len(order)))
    found[:-1] &= weight > 0
    edge = np.diff(found[:-1].astype(np.int8), prepend=0, append=0)
    # Bodies follow each other; a run of windows ends with its body.
    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    body = np.searchsorted(begin, low, "right") - 1
    out: list[list[int]] = [[] for _ in bodies]
    for b, lo, hi in zip(body.tolist(), low.tolist(), high.tolist()):
        out[b] += [int(lo - begin[b]), int(hi - begin[b])]
    return out


_BOUNDS = pa.schema([("gram", pa.int64()), ("digest", pa.binary()),
                     ("bounds", pa.list_(pa.int32()))])


def _merge_runs(window: int):
    """Rows come sorted by gram; a run ends where a gram does."""
    def verdicts(grams, digests, bodies, times):
        return pa.RecordBatch.from_pydict(
            {"gram": grams, "digest": digests,
             "bounds": repeated_windows(bodies, times, window)}, _BOUNDS)

    def run(batches):
        grams, digests, bodies, times, size = [], [], [], [], 0
        for batch in batches:
            for gram, digest, body, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= RUN_BYTES and gram != grams[-1]:
                    yield verdicts(grams, digests, bodies, times)
                    grams, digests, bodies, times, size = [], [], [], [], 0
                grams.append(gram)
                digests.append(digest)
                bodies.append(body)
                times.append(n)
                size += len(body)
        if grams:
            yield verdicts(grams, digests, bodies, times)
    return run


def _single_windows(window: int):
    schema = pa.schema([("gram", pa.int64()), ("digest", pa.binary()), ("at", pa.int32()),
                        ("times", pa.int64()), ("seen", pa.binary())])

    def run(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                held = {n: [] for n in schema.names}
                some = batch.slice(row, 64)
                for gram, digest, body, n in zip(*(some.column(i).to_pylist() for i in range(4))):
                    for at in range(len(body) - window + 1):
                        for name, value in zip(held, (gram, digest, at, n,
                                                      _digest(body[at:at + window]))):
                            held[name].append(value)
                yield pa.RecordBatch.from_pydict(held, schema)
    return run


def _kept(window: int):
    def run(batches):
        for batch in batches:
            total, gone, spans, digests, left = [], [], [], [], []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].cast(pa.binary()).as_buffer()
                text = text.to_pybytes() if text is not None else b""
                parts = batch.column(2)[i].as_py() or ()
                runs: list[list[int]] = []
                for low, high in sorted((p["start"] + lo, p["start"] + hi - 1 + window)
                                        for p in parts for lo, hi in zip(p["bounds"][::2],
                                                                         p["bounds"][1::2])):
                    if runs and low <= runs[-1][1]:
                        runs[-1][1] = max(high, runs[-1][1])
                    else:
                        runs.append([low, high])
                at, kept = 0, []
                for low, high in runs:
                    kept.append(text[at:low])
                    at = high
                kept = b"".join([*kept, text[at:]])
                total.append(len(text))
                gone.append(len(text) - len(kept))
                spans.append(len(runs))
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
                pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def _small_or_shuffled(df: DataFrame, size) -> DataFrame:
    """Mark a stored table for broadcast if the summed ``size`` of its rows is small."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def without_repeated_bytes(docs: DataFrame, window: int = 200) -> DataFrame:
    """One row per row of ``docs (doc_id, text, …)``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and kept (the bytes left, as binary; a character may be cut).

    Texts are UTF-8 bytes and matches never cross texts. A byte goes if ``window`` bytes in
    a row over it also start anywhere else, in the same text too; all copies go, and strings
    are judged on the input. n_spans counts the maximal runs of removed bytes. Null texts
    are empty; texts shorter than a window lose nothing. Repeated rows are further
    occurrences of all they hold, whatever their doc_id; a null doc_id is kept as it is.
    Other columns, whatever their names, are ignored.
    """
    if not 16 <= window <= 4096:
        raise ValueError("a window has 16 to 4096 bytes")
    width = max(8, min(48, window // 4))
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("text_id"))
    anchors = stored(docs.where(F.octet_length("text") >= window).select("text_id", "text")
                     .mapInArrow(_anchors(window, width),
                                 "gram long, text_id binary, start long, n int, places int"),
                     "anchors")
    often = stored(anchors.groupBy("gram").agg(F.sum("places").alias("places"))
                   .where("places > 1").select("gram"), "often")
    wanted = stored(
        anchors.join(_small_or_shuffled(often, F.lit(16)), "gram").groupBy("text_id").agg(
            F.collect_set(F.struct("gram", "start", "n")).alias("segments")), "wanted")
    few = _small_or_shuffled(wanted.select("text_id"), F.lit(32))
    holders = (docs.where(F.octet_length("text") >= window).join(few, "text_id", "left_semi")
               .groupBy("text_id").agg(F.first("text").alias("text"), F.count("*").alias("copies")))
    pieces = stored(
        holders.join(wanted, "text_id").select("text_id", "text", "copies", "segments")
        .mapInArrow(_bodies(window), "gram long, digest binary, body binary, copies long, "
                                     "text_id binary, start long"), "segments")
    distinct = stored(pieces.groupBy("gram", "digest", "body").agg(
        F.sum("copies").alias("times")).select("gram", "digest", "body", "times"), "distinct")
    sizes = stored(distinct.groupBy("gram").agg(F.sum(F.octet_length("body")).alias("size"))
                   .where(F.col("size") > RUN_BYTES).select("gram"), "hot")
    cool, hot = distinct, None
    if not sizes.isEmpty():
        few = _small_or_shuffled(sizes, F.lit(16))
        cool = distinct.join(few, "gram", "left_anti")
        hot = distinct.join(few, "gram", "left_semi")
    bounds = (cool.repartition("gram").sortWithinPartitions("gram", "digest").mapInArrow(
        _merge_runs(window), "gram long, digest binary, bounds array<int>")
        .where(F.size("bounds") > 0))
    if hot is not None:
        single = stored(hot.mapInArrow(
            _single_windows(window),
            "gram long, digest binary, at int, times long, seen binary"), "windows")
        twice = stored(single.groupBy("seen").agg(F.sum("times").alias("n")).where("n > 1")
                       .select("seen"), "twice")
        bounds = bounds.unionByName(
            single.join(_small_or_shuffled(twice, F.lit(32)), "seen").groupBy("gram", "digest")
            .agg(F.expr("flatten(transform(collect_set(at), x -> array(x, x + 1)))")
                 .alias("bounds")))
    bounds = stored(bounds, "bounds")
    spans = stored(
        pieces.select("gram", "digest", "text_id", "start")
        .join(_small_or_shuffled(bounds, 40 + 4 * F.size("bounds")), ["gram", "digest"])
        .groupBy("text_id").agg(F.collect_list(F.struct("start", "bounds")).alias("spans")),
        "spans")
    weight = F.expr("aggregate(spans, 64, (s, x) -> s + 40 + 4 * size(x.bounds))")
    return (docs.join(_small_or_shuffled(spans, weight), "text_id", "left")
            .select("doc_id", "text", "spans").mapInArrow(
                _kept(window), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                "kept_sha256 string, kept binary"))
