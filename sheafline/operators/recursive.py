"""Character chunks cut at the best boundary available.

A text is broken into pieces at blank lines; pieces that are still too long are
broken at newlines, then at spaces, and a word that is still too long is cut into
overlapping slices. Separators stay at the start of their piece. Pieces are then
packed left to right into chunks of at most ``size`` characters; a new chunk starts
with the longest run of whole pieces within ``overlap`` characters of the previous
one. Packing never crosses a piece that had to be broken further ("run").

All of it is one Catalyst expression over the row: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import strip_left, strip_right

# The boundaries in order of preference.
BLANK_LINE, LINE, SPACE = "\n\n", "\n", " "

SEGMENT = 512


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _piece(text: Column, length: Column, fresh: Column) -> Column:
    return F.struct(text.alias("t"), length.alias("n"), fresh.alias("fresh"))


def _number(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _slices(word: Column, size: Column, overlap: Column) -> Column:
    """Windows over a word without any boundary; each is a run of its own."""
    step = size - overlap
    count = F.ceil((F.char_length(word) - overlap) / step).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: _let(F.substring(word, i * step + 1, size),
                       lambda t: _piece(t, F.char_length(t), F.lit(True))),
    )


def _break(text: Column, sep: str, size: Column, deeper) -> Column:
    """Pieces of ``text`` cut before every ``sep``; longer ones go to ``deeper``.

    Splitting at a plain separator and putting it back costs less than a look-ahead
    pattern. A piece is ``fresh`` if it begins a run: it is the first of its parent or
    follows a part that was broken further.
    """
    none = F.array().cast("array<struct<t:string,n:int,fresh:boolean>>")

    def pieces(parts: Column) -> Column:
        def length(part, i):
            return F.char_length(part) + F.when(i > 0, F.lit(len(sep))).otherwise(F.lit(0))

        def one(part, i):
            whole = F.when(i > 0, F.concat(F.lit(sep), part)).otherwise(part)
            before = F.get(parts, i - 1)
            fresh = (i == 0) | (length(before, i - 1) > size) | ((i == 1) & (before == ""))
            return (F.when((i == 0) & (part == ""), none)
                    .when(length(part, i) <= size, F.array(_piece(whole, length(part, i), fresh)))
                    .otherwise(deeper(whole)))
        return F.flatten(F.transform(parts, one))

    return _let(F.split(text, sep), pieces)


def text_pieces(text: Column, size: Column | int, overlap: Column | int) -> Column:
    """``array<struct<t, n, fresh>>`` of pieces no longer than ``size``."""
    size, overlap = _number(size), _number(overlap)

    def by_word(part):
        return _break(part, SPACE, size, lambda word: _slices(word, size, overlap))

    def by_line(part):
        return _break(part, LINE, size, by_word)

    return _break(text, BLANK_LINE, size, by_line)


def _spans(pieces: Column, size: Column | int, overlap: Column | int) -> Column:
    """Pack pieces; returns ``array<struct<a, b>>``, piece positions [a, b).

    Spark copies the state of a fold at every step, so the spans found are not kept in
    it for long: an inner fold over SEGMENT pieces collects its own few spans, and an
    outer fold over the segments appends them. Long texts stay close to linear.
    """
    none = F.array().cast("array<struct<a:int,b:int>>")
    never = isinstance(overlap, int) and overlap == 0
    size, overlap = _number(size), _number(overlap)

    def span(state):
        return F.struct(state["first"].alias("a"), state["i"].alias("b"))

    def kept_tail(state, piece):
        """Count and width of the trailing pieces that the next chunk repeats."""
        room = F.least(overlap, size - piece["n"])
        reach = F.least(overlap, state["i"] - state["first"])
        tail = F.reverse(F.slice(pieces, state["i"] - reach + 1, reach))
        zero = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("count"), F.lit(0).alias("width"))

        def widen(t, p):
            seen = t["seen"] + p["n"]
            return F.struct(
                seen.alias("seen"),
                F.when(seen <= room, t["count"] + 1).otherwise(t["count"]).alias("count"),
                F.when(seen <= room, seen).otherwise(t["width"]).alias("width"),
            )
        return F.aggregate(tail, zero, widen)

    def state_of(done, first, width, i):
        return F.struct(done.alias("done"), first.alias("first"), width.alias("width"), i.alias("i"))

    def add(state, piece):
        following = state["i"] + 1
        fits = state_of(state["done"], state["first"], state["width"] + piece["n"], following)
        done = F.when(state["i"] == 0, state["done"]).otherwise(F.concat(state["done"], F.array(span(state))))
        fresh = state_of(done, state["i"], piece["n"], following)
        if never:
            overflow = fresh
        else:
            overflow = _let(kept_tail(state, piece), lambda tail: state_of(
                done, state["i"] - tail["count"], tail["width"] + piece["n"], following))
        return (F.when(piece["fresh"], fresh)
                .when(state["width"] + piece["n"] <= size, fits)
                .otherwise(overflow))

    def close(state):
        return F.when(state["i"] == 0, state["done"]).otherwise(F.concat(state["done"], F.array(span(state))))

    def add_segment(state, number):
        part = F.slice(pieces, number * SEGMENT + 1, F.lit(SEGMENT))
        packed = F.aggregate(part, state_of(none, state["first"], state["width"], state["i"]), add)
        return _let(packed, lambda s: state_of(
            F.concat(state["done"], s["done"]), s["first"], s["width"], s["i"]))

    zero = F.lit(0)
    last = F.greatest(F.floor((F.array_size(pieces) - 1) / F.lit(SEGMENT)).cast("int"), zero)
    return F.aggregate(F.sequence(zero, last), state_of(none, zero, zero, zero), add_segment, close)


def _check(size: Column | int, overlap: Column | int) -> None:
    if isinstance(size, Column) or isinstance(overlap, Column):
        return
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("need size >= 1 and 0 <= overlap < size")


def _chunk_array(df: DataFrame, text_col: str, size: Column | int, overlap: Column | int, when: Column | None,
                 trim: bool) -> tuple[DataFrame, Column]:
    """Rows with their pieces and spans, and the expression of their chunks."""
    _check(size, overlap)
    cut = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    # Separate projections, so that pieces and spans are computed once per row.
    pieces = df.withColumn("__pieces", F.when(cut, text_pieces(F.col(text_col), size, overlap)))
    spans = pieces.withColumn("__spans", _spans(F.col("__pieces"), size, overlap))
    joined = F.transform("__spans", lambda s: F.array_join(
        F.slice("__pieces", s["a"] + 1, s["b"] - s["a"])["t"], ""))
    if trim:
        joined = F.array_remove(F.transform(F.transform(joined, strip_left), strip_right), "")
    return spans, F.when(cut, joined).otherwise(F.array(F.col(text_col)))


def with_recursive_chunks(df: DataFrame, text_col: str, size: Column | int, overlap: Column | int,
                          out_col: str = "chunks", when: Column | None = None,
                          trim: bool = True) -> DataFrame:
    """Add the array of chunks of ``text_col``.

    Chunks are trimmed and empty ones dropped unless ``trim`` is off. Rows where
    ``when`` does not hold keep their text as the only chunk, untouched.
    """
    spans, chunks = _chunk_array(df, text_col, size, overlap, when, trim)
    return spans.select(*df.columns, chunks.alias(out_col))


def recursive_chunks(df: DataFrame, text_col: str = "section_text", size: Column | int = 512,
                     overlap: Column | int = 51,
                     chunk_col: str = "text", number_col: str = "chunk_number",
                     when: Column | None = None) -> DataFrame:
    """One row per chunk, numbered from 1.

    The expression goes into the generator itself: exploding a finished column would
    make Spark push a size filter below the projections and compute the chunks again.
    """
    spans, chunks = _chunk_array(df, text_col, size, overlap, when, True)
    kept = [c for c in df.columns if c != text_col]
    return spans.select(*kept, F.posexplode(chunks).alias("__pos", "__chunk")).select(
        *kept, (F.col("__pos") + 1).alias(number_col), F.col("__chunk").alias(chunk_col))


def split_sections(planned: DataFrame, size: int | None = None, overlap: int | None = None,
                   ids: tuple[str, ...] = ("year", "section_number"),
                   text_col: str = "section_text") -> DataFrame:
    """Chunks of planned sections: ids, ``chunk_number`` from 1 and ``text``.

    ``planned`` carries ``requires_chunking``, ``suggested_chunk_size`` and ``overlap``
    from the chunk plan; a section that is not flagged, or has no plan row, passes through
    as chunk 1. A ``size`` given here counts for all sections instead, with a tenth of it
    as overlap.
    """
    if size is None:
        size = F.col("suggested_chunk_size")
        overlap = F.col("overlap") if overlap is None else overlap
    elif overlap is None:
        overlap = int(size * 0.1)
    return recursive_chunks(planned, text_col, size, overlap, when=F.col("requires_chunking")).select(
        *ids, "chunk_number", "text")


def chunk_records(chunks: DataFrame) -> DataFrame:
    """Each chunk as text plus one metadata struct."""
    return chunks.select(
        "text", F.struct("year", "section_number", "chunk_number").alias("metadata"))
