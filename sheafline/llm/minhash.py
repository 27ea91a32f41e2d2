"""Near-duplicate documents by b-bit MinHash with exact confirmation.

1. Every text becomes its set of distinct word shingles. Documents with equal sets are
   one class, represented by the smallest doc_id, before anything is compared.
2. Each class gets 288 minima: 48 band keys of 6 minima, and the low 4 bits of each
   minimum packed into a signature of 144 bytes.
3. Classes that share a band key are chained to the smallest one of the bucket: a bucket
   of n classes gives n - 1 rows, not n * n. Connected chains are candidate groups; every
   two classes that share a band lie in one group.
4. A group is compared inside tasks, in blocks of bounded size: pairs that share a band,
   pass the size bound and whose signatures agree on enough lanes are confirmed on the
   full sets. Pairs already connected are skipped, and a task returns only a spanning
   forest of its links.
5. The components of those links are the result.

A pair at a similarity of exactly 0.8 shares no band with probability (1 - 0.8^6)^48 =
5e-7, and its estimate falls six standard deviations low with less than 1e-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import by_key, components, small_or_shuffled
from sheafline.llm.words import WordHashes, byte_texts, mixed, shingle_set
from sheafline.session import stored

BANDS, ROWS, LOW_BITS = 48, 6, 4
MINIMA = BANDS * ROWS
#: Shingles of one block of a candidate group; 16 MB.
BLOCK_SHINGLES = 2_000_000
_SEED = 20_240_229


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    draw = lambda: rng.integers(0, 1 << 32, (MINIMA, 1), dtype=np.uint32)
    return draw() | np.uint32(1), draw()


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each permutation over a set that is not empty, in short runs so
    that very long texts need no more memory."""
    a, b = _PERMUTATIONS
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, (a * x[None, i:i + 2048] + b).min(axis=1), out=low)
    return low


_PERMUTATIONS = _permutations()


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, distinct for different bands."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 16 to a 64-bit word."""
    lanes = mixed(low.astype(np.uint64)).reshape(-1, 64 // LOW_BITS) & np.uint64(2**LOW_BITS - 1)
    shifts = np.arange(0, 64, LOW_BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(lanes << shifts, axis=1)


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities estimated from packed signatures, corrected for lanes that agree by
    chance: (agreement - C) / (1 - C) with C = 2^-bits."""
    x = one ^ others
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1)
    chance = 2.0 ** -LOW_BITS
    return (1 - differ / MINIMA - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    """Six standard deviations below ``similarity``."""
    chance = 2.0 ** -LOW_BITS
    agree = similarity * (1 - chance) + chance
    return similarity - 6 * (agree * (1 - agree) / MINIMA) ** 0.5 / (1 - chance)


def _signatures(width: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            ids, sizes, first, second, bands = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                found = shingle_set(hashes.of(text.lower().split()), width) if text else ()
                ids.append(doc_id)
                sizes.append(len(found))
                if len(found):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                    first.append(int(digest[0]))
                    second.append(int(digest[1]))
                    bands.append(band_keys(minima(found)).view(np.int64))
                else:
                    first.append(None)
                    second.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return run


def _sets(width: int):
    """The sets of documents that are members of candidate groups; rows without words,
    which may repeat a member's doc_id, have none."""
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(hashes.of((t or b"").lower().split()), width).tobytes() or None
                     for t in byte_texts(batch.column(1))]
            sets = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sets, *batch.columns[2:]],
                names=["doc_id", "shingles", *batch.schema.names[2:]]).filter(sets.is_valid())
    return run


def linked_pairs(ids: list[int], sets: list[np.ndarray], sides: list[int],
                 percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between members: sets that share a band and whose
    intersection has at least ``percent`` % of their union. With two sides only pairs
    across them are compared."""
    sizes = np.array([len(s) for s in sets])
    lows = [minima(s) for s in sets]
    signs = np.stack([packed(x) for x in lows])
    two = len(set(sides)) > 1
    side = np.array(sides)
    label = np.arange(len(ids))
    seen: dict[int, list[int]] = {}
    least = least_estimate(percent / 100)
    links = []
    for i, low in enumerate(lows):
        near = set()
        for key in band_keys(low).tolist():
            bucket = seen.setdefault(key, [])
            near.update(bucket)
            bucket.append(i)
        if not near:
            continue
        near = np.fromiter(near, np.int64, len(near))
        near = near[label[near] != label[i]]
        if two:
            near = near[side[near] != side[i]]
        near = near[100 * np.minimum(sizes[near], sizes[i])
                    >= percent * np.maximum(sizes[near], sizes[i])]
        guess = estimates(signs[i], signs[near])
        near = near[guess >= least][np.argsort(-guess[guess >= least], kind="stable")]
        while len(near):
            j, near = near[0], near[1:]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                links.append((ids[i], ids[j]))
                label[label == label[j]] = label[i]
                near = near[label[near] != label[i]]
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs (doc_id, text, …)``: doc_id, n_shingles, component_id
    (smallest doc_id it is linked with, over any number of links) and kept (doc_id is
    that one).

    Words are cut at ASCII white space after lower-casing A-Z; a text of fewer than
    ``width`` words is one shingle. Null, empty and blank texts have no shingles and are
    linked with nothing. Rows that repeat a doc_id count as one document: each gets a
    row, and what any of them is linked with they all are. A row without doc_id takes no
    part: component_id is null and kept is true. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(_signatures(width), "doc_id long, n_shingles long, "
                                    "set_a long, set_b long, bands array<long>"), "signatures")
    able = signed.where("n_shingles > 0 and doc_id is not null")
    classes = able.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"),
                                                 F.count("*").alias("copies"))
    # Stored, so that adaptive execution can split a hot class in the join.
    copies = stored(classes.where("copies > 1").drop("copies"), "copies")
    members = stored(able.join(copies, ["set_a", "set_b"], "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "members")
    reps = members.where("doc_id = rep").select("doc_id").distinct()
    keys = able.join(reps, "doc_id", "left_semi").select(
        "doc_id", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    chains = (keys.join(buckets.where("low < high").select("band", "low"), "band")
              .where("doc_id > low").select(F.col("doc_id").alias("a"), F.col("low").alias("b")))
    groups = stored(components(chains), "groups")
    sized = members.where("doc_id = rep").join(groups, F.col("doc_id") == F.col("node")).select(
        "doc_id", "component", "n_shingles")
    blocks = (sized.groupBy("component").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks")))
    placed = stored(sized.join(blocks, "component").select(
        "doc_id", F.col("component").alias("grp"), "blocks",
        F.pmod(F.xxhash64("doc_id"), "blocks").alias("block")), "placed").distinct()
    sets = (docs.join(small_or_shuffled(placed, 40), "doc_id")
            .mapInArrow(_sets(width), "doc_id long, shingles binary, grp long, blocks long, "
                        "block long"))
    mine = F.col("block")
    spread = sets.select("doc_id", "shingles", "grp", "block", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j"))
    )).alias("at")).select("grp", "at.i", "at.j", "doc_id", "block", "shingles")

    def compare(key, rows):
        found = linked_pairs(rows["doc_id"],
                             [np.frombuffer(x, np.uint64) for x in rows["shingles"]],
                             rows["block"], percent)
        return {"a": [x for x, _ in found], "b": [x for _, x in found]}

    links = by_key(spread, ["grp", "i", "j"], compare, "a long, b long")
    shared = (members.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("high"))
              .where("b < high").select("doc_id", "b"))
    same_id = members.join(shared, "doc_id").select(F.col("rep").alias("a"), "b")
    found = stored(components(links.union(same_id)), "components")
    labels = members.join(found, F.col("rep") == F.col("node"), "left").groupBy("doc_id").agg(
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    return signed.select("doc_id", "n_shingles").join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"),
                   F.lit(True)).alias("kept"))
