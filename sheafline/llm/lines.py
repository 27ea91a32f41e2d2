"""Line dedup: lines within a small edit distance of an earlier line are removed.

A segment-partition join over distinct lines. A line that may differ by k edits is cut
into k + 1 segments; a line within k edits of it holds one of them unchanged, at a place
that its length and the segment's number confine to a few positions. Each line is indexed
under its segments, with length and segment number, and probes the substrings that could
match the segments of lines as long or up to k characters shorter.

Lines that meet under a key form a bucket. A bucket is compared in blocks inside tasks, by
banded bit-parallel edit distance, and returns only a spanning forest of its links, so a
common segment gives neither a row for every pair nor a task without bound.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import by_key, components, small_or_shuffled
from sheafline.llm.words import byte_texts
from sheafline.session import stored

#: Characters that a line must have for each edit it may differ by, and most edits.
CHARACTERS_PER_EDIT = 24
MOST_EDITS = 2
#: Lines of one block of a bucket.
BLOCK_LINES = 500
#: Line ids that a task remembers so as not to emit the keys of a common line again.
REMEMBERED_LINES = 200_000
_MASK = (1 << 64) - 1


def edits_allowed(length: int) -> int:
    return min(MOST_EDITS, length // CHARACTERS_PER_EDIT)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and end of ``edits + 1`` nearly equal segments; the last ones are longer."""
    parts = edits + 1
    base, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        out.append((at, at + size))
        at += size
    return out


def index_keys(line: str) -> list[int]:
    edits = edits_allowed(len(line))
    return [_key(len(line), i, line[a:b]) for i, (a, b) in enumerate(
        segments(len(line), edits))] if edits else []


def probe_keys(line: str) -> set[int]:
    """Keys under which a line within its allowed edits, and not longer, may be indexed.

    Segment i (from 0) of the shorter line starts at p there. If the pieces left of it
    differ by at most i edits, it starts within i of p here; if those right of it differ
    by at most the rest, it starts within that of p plus the difference in length.
    """
    found = set()
    for length in range(max(CHARACTERS_PER_EDIT, len(line) - MOST_EDITS), len(line) + 1):
        edits, longer = edits_allowed(length), len(line) - length
        if longer > edits:
            continue
        for i, (a, b) in enumerate(segments(length, edits)):
            low = max(0, a - i, a + longer - (edits - i))
            high = min(len(line) - (b - a), a + i, a + longer + (edits - i))
            found.update(_key(length, i, line[s:s + b - a]) for s in range(low, high + 1))
    return found


def _key(length: int, part: int, text: str) -> int:
    key = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), length * 8 + part)
    return key - (1 << 64) if key >> 63 else key


def within(a: str, b: str, edits: int) -> bool:
    """Whether two strings are at most ``edits`` apart, for fewer than 32 edits.

    Common ends are cut off. What is left goes through a band of 64 diagonal bits: one
    word of the bit-parallel recurrence that slides down the longer string, and stops as
    soon as the distance cannot come back below the threshold.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    start = 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    tail = 0
    while tail < len(b) - start and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[start:len(a) - tail], b[start:len(b) - tail]
    if not b or len(a) <= edits:
        return len(a) <= edits
    # Column j looks at rows j - edits .. j + edits of the longer string.
    width = 2 * edits + 1
    top = 1 << (width - 1)
    full = (1 << width) - 1
    positive, negative = full & ~((1 << edits) - 1), 0
    distance = edits  # at the lower edge of the band
    row, n = edits, len(a)
    side = top
    for j, char in enumerate(b):
        match = 0
        for d in range(width):
            i = j - edits + d
            if 0 <= i < n and a[i] == char:
                match |= 1 << d
        zero = ((((match & positive) + positive) ^ positive) | match | negative) & full
        plus = (negative | ~(zero | positive)) & full
        minus = zero & positive
        if row < n:
            distance += not zero & top
            row += 1
        else:
            side >>= 1
            distance += bool(plus & side) - bool(minus & side)
        if distance > 2 * edits + 1:
            return False
        positive = (minus | ~((zero >> 1) | plus)) & full
        negative = (zero >> 1) & plus
    return distance <= edits


def linked_lines(ids: list[int], lines: list[str], sides: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links within a bucket; with two sides, across them."""
    label = list(range(len(ids)))

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    two = len(set(sides)) > 1
    order = sorted(range(len(ids)), key=lambda i: (len(lines[i]), lines[i]))
    links, low = [], 0
    for at, i in enumerate(order):
        while len(lines[order[low]]) < len(lines[i]) - MOST_EDITS:
            low += 1
        for j in reversed(order[low:at]):
            if (two and sides[i] == sides[j]) or root(i) == root(j):
                continue
            if within(lines[i], lines[j], edits_allowed(len(lines[j]))):
                links.append((ids[i], ids[j]))
                label[root(i)] = root(j)
    return links


def _emit(keys):
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            out, owners = [], []
            for line_id, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if line_id in seen:
                    continue
                if len(seen) >= REMEMBERED_LINES:
                    seen.clear()
                seen.add(line_id)
                found = keys(line)
                out += found
                owners += [line_id] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int64()), pa.array(owners, pa.int64())], names=["key", "id"])
    return run


def similar_lines(lines: DataFrame) -> DataFrame:
    """Classes of lines connected by allowed edits: (node, component) of every id of
    ``lines (id, line)`` that has a partner, component being its smallest id. Equal lines
    must have equal ids."""
    # Shorter lines than this allow no edit.
    able = lines.where(F.char_length("line") >= CHARACTERS_PER_EDIT).select("id", "line")
    schema = "key long, id long"
    index = able.mapInArrow(_emit(index_keys), schema).groupBy("key").agg(F.min("id").alias("low"))
    met = stored(able.mapInArrow(_emit(probe_keys), schema).join(index, "key")
                 .where("id <> low"), "met")
    members = stored(met.select("key", "id").union(
        met.select("key", F.col("low").alias("id"))).distinct(), "bucketed")
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_LINES).alias("blocks"))
    wanted = stored(members.select("id").distinct(), "wanted")
    texts = able.join(small_or_shuffled(wanted, 16), "id", "left_semi").dropDuplicates(["id"])
    mine = F.col("block")
    spread = (members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
              .join(texts, "id").select("key", "id", "line", "block", F.explode(F.transform(
                  F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                  lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j"))
              )).alias("at")).select("key", "at.i", "at.j", "id", "block", "line"))

    def compare(key, rows):
        found = linked_lines(rows["id"], rows["line"], rows["block"])
        return {"a": [x for x, _ in found], "b": [y for _, y in found]}

    return components(by_key(spread, ["key", "i", "j"], compare, "a long, b long"))


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def _without(batches):
    for batch in batches:
        total, removed, digests, texts = [], [], [], []
        for text, drop in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist()):
            if text is None:
                for column, value in ((total, 0), (removed, 0), (digests, None), (texts, None)):
                    column.append(value)
                continue
            lines = text.split(b"\n")
            gone = set(drop or ())
            total.append(len(lines))
            removed.append(len(gone))
            texts.append(b"\n".join(x for i, x in enumerate(lines) if i not in gone)
                         if gone else text)
            digests.append(hashlib.sha256(texts[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
            *batch.columns[3:]],
            names=["doc_id", "n_lines", "n_removed", "kept_sha256", "kept_text",
                   *batch.schema.names[3:]])


def without_repeated_lines(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs (doc_id, text, …)``: doc_id, n_lines, n_removed,
    kept_sha256 and kept_text (the lines left), then the columns ``keep`` of docs.

    Of lines that are connected by edits the first stays, by doc_id and then by place; a
    line may differ by one edit for every 24 characters of the shorter one, two at most,
    and shorter lines must be equal. Blank lines always stay. A null text has no lines and
    stays null; an empty one is a blank line. Rows with equal doc_id and text count as one
    document and lose the same lines; rows without doc_id come last in the order.
    """
    keep = keep or []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"), F.struct(*keep).alias("row")
                       if keep else F.lit(None).cast("int").alias("row"))
    where = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash",
                     "line_no").alias("at")
    lines = docs.select("doc_id", "text_hash", F.posexplode(_lines("text"))
                        .alias("line_no", "line")).where(F.trim("line") != "").select(
        F.xxhash64("line").alias("id"), "line", where)
    classes = stored(similar_lines(lines), "line_classes")
    placed = stored(lines.select("id", "at").join(
        small_or_shuffled(classes.withColumnRenamed("node", "id"), 24), "id", "left").select(
        F.coalesce("component", "id").alias("class"), "at"), "placed_lines")
    # Stored, so that adaptive execution can split a hot class in the join.
    first = stored(placed.groupBy("class").agg(F.min("at").alias("first"), F.max("at").alias("final"))
                   .where("first < final").select("class", "first"), "first_lines")
    drops = (placed.join(first, "class").where(F.col("at") != F.col("first"))
             .groupBy(F.col("at.doc_id").alias("in_doc"), F.col("at.text_hash").alias("in_text"))
             .agg(F.collect_set("at.line_no").alias("drop")))
    found = docs.join(drops, [F.col("doc_id").eqNullSafe(F.col("in_doc")),
                              F.col("text_hash") == F.col("in_text")], "left")
    result = found.select("doc_id", "text", "drop", "row")
    schema = "doc_id long, n_lines long, n_removed long, kept_sha256 string, kept_text string"
    out = result.mapInArrow(_without, f"{schema}, row {result.schema['row'].dataType.simpleString()}")
    return out.select("doc_id", "n_lines", "n_removed", "kept_sha256", "kept_text",
                      *(F.col("row")[c].alias(c) for c in keep))
