"""Removal of multi-line passages that repeat across a corpus, by content-defined chunks of lines.

A chunk ends after a line where a rolling hash over the last lines' hashes falls on a boundary value, so boundaries
follow the content and shift with it. Chunks of several lines with equal digests are compared byte by byte with the
first of them, by (doc_id, place), and later ones are removed. ``line_dedup`` stops there, so only what lies whole inside
a shared passage is found. ``line_runs`` lets each chunk reach to the first line of the next, so all neighbours are in one
chunk, and looks into the chunks that are distinct: their pairs of neighbouring lines are compared in the same way. A
run of lines is shared exactly if each of its pairs is, so short passages and the edges of long ones are found as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm import common as C

U64 = np.uint64
#: Lines under the rolling hash; one in DIVISOR lines ends a chunk; chunks of fewer lines than LINES are left alone.
WINDOW, DIVISOR, LINES = 2, 3, 2


def chunks_of(lines: list[bytes], window: int = WINDOW, divisor: int = DIVISOR) -> list[tuple[int, int]]:
    """(first line, end line) of each chunk."""
    if not lines:
        return []
    h = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=8).digest() for x in lines), U64)
    cuts = []
    if len(h) >= window:
        roll = np.zeros(len(h) - window + 1, U64)
        for k in range(window):
            roll = roll * C.PRIME + h[k : k + len(roll)]
        cuts = (np.flatnonzero(C.mix(roll) % U64(divisor) == 0) + window).tolist()
    ends = sorted({*cuts, len(lines)})
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n") if text else []


def linked_chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end line) of each chunk with the first line of the next one, so that all neighbours are in exactly one."""
    return [(x, min(y + 1, len(lines))) for x, y in chunks_of(lines) if x + 1 < len(lines)]


def line_dedup(documents: DataFrame, min_lines: int = LINES) -> DataFrame:
    """doc_id, n_lines, n_removed, kept: each text without the chunks of at least ``min_lines`` lines that an earlier place has.

    Lines end at \\n and are compared exactly. Places are ordered by doc_id, then a hash of the text, then position; the
    first one keeps its chunk. Null and empty texts have no lines and stay as they are. Rows without a doc_id keep all and
    protect nothing; rows that repeat a doc_id and text count as one place. Extra columns are ignored.
    """
    return _without(documents, chunks_of, min_lines)


def line_runs(documents: DataFrame, carry: str | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed, kept: each text without the lines in a run of two or more that earlier places have.

    A line goes if it and a neighbour also follow each other at an earlier place; of a longer run every line does. Repeated
    content-defined chunks are told whole, and what is inside of the distinct ones by pairs of neighbours. Lines,
    blank ones too, places, nulls and repeated rows count as in ``line_dedup``. The column named by ``carry`` is passed on.
    """
    return _without(documents, linked_chunks, 2, carry, inner=True)


def _digest(lines: list[bytes]) -> bytes:
    return hashlib.blake2b(b"\n".join(lines), digest_size=16).digest()


def _repeated(spans: DataFrame) -> DataFrame:
    """The spans whose digest is at several places, and whether theirs is the first."""
    place = F.struct("doc_id", "th", "place")
    first = spans.groupBy("digest").agg(F.min(place).alias("f"), F.max(place).alias("l")).where("f <> l").select("digest", "f")
    return spans.join(first, "digest").select("doc_id", "th", "place", "n", "digest", (place == F.col("f")).alias("is_first"))


def _without(documents: DataFrame, spans_of: Callable[[list[bytes]], list[tuple[int, int]]], min_lines: int, carry: str | None = None, inner: bool = False) -> DataFrame:
    """Each text without the spans of at least ``min_lines`` lines that an earlier place has; spans may overlap.

    With ``inner``, also without the neighbours in such spans that an earlier place has. Only the first span of each digest
    is looked into: what a later one holds is at an earlier place whole, and none of it can be first.
    """
    docs = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")

    def cut(batches):
        for b in C.units(batches):
            rows = []
            for d, th, t in zip(*[b.column(c).to_pylist() for c in ("doc_id", "th", "text")], strict=True):
                lines = _lines(t)
                for x, y in spans_of(lines):
                    if y - x >= min_lines:
                        rows.append((d, th, x, y - x, _digest(lines[x:y]), [_digest(lines[k : k + 2]) for k in range(x, y - 1)] if inner else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary())], strict=True)], names=["doc_id", "th", "place", "n", "digest", "pairs"])

    # rows that repeat a doc_id and text give equal places, of which none is later than the other
    chunks = C.written(docs.mapInArrow(cut, "doc_id long, th long, place int, n int, digest binary, pairs array<binary>"), "chunks")
    repeated = _repeated(chunks.drop("pairs"))
    if inner:
        distinct = C.written(chunks.groupBy("digest").agg(F.min(F.struct("doc_id", "th", "place", "pairs")).alias("f")).select("f.*"), "distinct")
        pairs = distinct.select("doc_id", "th", "place", F.posexplode("pairs").alias("k", "digest")).select("doc_id", "th", (F.col("place") + F.col("k")).alias("place"), F.lit(2).alias("n"), "digest")
        repeated = repeated.unionByName(_repeated(pairs))
    wanted = C.written(repeated, "repeated").groupBy("doc_id", "th").agg(F.collect_set(F.struct("place", "n", "digest", "is_first")).alias("want"))

    def fetch(batches):
        for b in C.units(batches):
            rows = []
            for d, th, t, want in zip(*[b.column(c).to_pylist() for c in ("doc_id", "th", "text", "want")], strict=True):
                lines = _lines(t)
                rows += [(d, th, w["place"], w["n"], w["digest"], w["is_first"], b"\n".join(lines[w["place"] : w["place"] + w["n"]])) for w in want if w["place"] + w["n"] <= len(lines)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.binary()], strict=True)], names=["doc_id", "th", "place", "n", "digest", "is_first", "raw"])

    # the text side is always shuffled, so the plan at any size is the plan at large sizes
    texts = C.written(docs.hint("merge").join(wanted, ["doc_id", "th"]).mapInArrow(fetch, "doc_id long, th long, place int, n int, digest binary, is_first boolean, raw binary"), "bytes")
    one = texts.where("is_first").groupBy("digest").agg(F.min("raw").alias("first_raw"))
    later = texts.where("not is_first").join(one, "digest").where(F.col("raw") == F.col("first_raw"))
    gone = later.groupBy("doc_id", "th").agg(F.collect_set(F.struct("place", "n")).alias("gone"))

    def finish(batches):
        for b in C.units(batches):
            rows = []
            for d, t, places in zip(*[b.column(c).to_pylist() for c in ("doc_id", "text", "gone")], strict=True):
                lines = _lines(t)
                if not places:
                    rows.append((d, len(lines), 0, t))
                    continue
                drop = {k for p in places for k in range(p["place"], p["place"] + p["n"])}
                kept = [x for k, x in enumerate(lines) if k not in drop]
                rows.append((d, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True)], names=["doc_id", "n_lines", "n_removed", "kept"])

    def carried(batches):
        for b in C.units(batches):
            for out in finish(iter([b])):
                yield pa.RecordBatch.from_arrays([*out.columns, b.column("__row")], names=[*out.schema.names, carry])

    own = [F.col(carry).alias("__row")] if carry else []
    all_rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text", *own)
    joined = all_rows.hint("merge").join(C.written(gone, "gone"), ["doc_id", "th"], "left").select("doc_id", "text", "gone", *["__row"][: len(own)])
    schema = "doc_id long, n_lines long, n_removed long, kept string"
    if carry:
        return joined.mapInArrow(carried, T.StructType.fromDDL(schema).add(carry, documents.schema[carry].dataType))
    return joined.mapInArrow(finish, schema)
