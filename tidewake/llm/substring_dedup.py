"""Level-wise doubling: windows of words repeated at one length alone are extended to twice that length."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C
from tidewake.llm import windows as W

U64 = np.uint64
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def levels_of(n: int) -> list[int]:
    """Lengths that double up to n: the first is n halved twice, rounded up (13: 4, 8, 13)."""
    out = [max(1, -(-n // 4))]
    while out[-1] < n:
        out.append(min(2 * out[-1], n))
    return out


def repeated_windows(docs: DataFrame, copies: DataFrame, n: int, lower: bool = False) -> DataFrame:
    """(doc_id, places): ranges of starts of n-word windows whose words also begin somewhere in a document with a smaller id.

    Levels, by ``levels_of``: the first looks up seeds sampled so that each n-word window holds one; each later level
    extends what repeated in another text, and that alone, to twice the length around the same seed. The last level is
    the n words themselves (longer windows would cover nothing more). A level without survivors ends the search. Words
    and windows are hashed under seeds drawn on the driver; the last level compares 96 bits from two families.
    """
    spark = docs.sparkSession
    buckets, seed = C.partitions(spark), C.secret()
    lengths = levels_of(n)
    k = lengths[0]
    live, before = docs, None
    for length in lengths[:-1]:
        found = C.written(W.gathered(W.repeated_anchors(live, "words", n, k, lower, length, before, seed)), "level")
        C.release(spark)
        if found.isEmpty():
            return found
        level = found.join(copies.select("doc_id"), "doc_id", "left_anti")
        # the text side is always shuffled, so the plan at any size is the plan at large sizes
        live, before = docs.hint("merge").join(level, "doc_id"), length

    def entries(batches):
        for b in C.units(batches):
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            el = W.Elements(b.column("text"), "words", lower, seed)
            if before:
                w, at = el.inner(n, k, before)
                w = w[el.marked(b.column("places").to_pylist())[at]]
            else:
                w, _ = el.inner(n, k, k)
            d = el.doc[w]
            yield C.windows_of(el.e, n, seed)[w], (C.windows_of(el.e, n, seed + 1)[w] >> U64(32)).astype(np.uint32), ids[d], (w - el.first[d]).astype(np.uint32)

    def ask(batches):
        found = []
        for h, g, d, pos in W.gather(entries(batches)):
            h, g, d, pos, later = _judged(h, g, d, pos)
            found.append(W.to_ranges(d[later], pos[later]))
            h, g, d, pos = h[~later], g[~later], d[~later], pos[~later]
            yield W.as_batch(list(W._blocks((h % U64(buckets)).astype(np.int64), W.ASK, lambda r, h=h, g=g, d=d, pos=pos: W.pack(h[r], g[r], d[r], pos[r]))), W.BLOCK_ARROW)
        yield W.as_batch(list(W.result_blocks(found, buckets, asking=True)), W.BLOCK_ARROW)

    def settle(batches):
        got, found = [], []
        for what, payload in W.blocks_of(batches):
            if what == W.KNOWN:
                found.append(W.unpack(payload, np.int64, np.uint32, np.uint32))
            else:
                got.append(W.unpack(payload, U64, np.uint32, np.int64, np.uint32))
        if got:
            h, g, i, p = (np.concatenate(x) for x in zip(*got, strict=True))
            del got
            for r in W.parts_by_hash(h):
                _, _, d, pos, later = _judged(h[r], g[r], i[r], p[r])
                found.append(W.to_ranges(d[later], pos[later]))
        yield W.as_batch(list(W.result_blocks(found, buckets)), W.BLOCK_ARROW)

    return W.ranges_gathered(W.exchange(live.mapInArrow(ask, W.BLOCK), settle, W.BLOCK))


def _judged(h: np.ndarray, g: np.ndarray, d: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """The entries by hash and document, and which of them have an entry of a smaller document."""
    o = np.lexsort((d, g, h))
    h, g, d, pos = h[o], g[o], d[o], pos[o]
    if not len(o):
        return h, g, d, pos, np.zeros(0, bool)
    st = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))))
    return h, g, d, pos, d > d[st][C.group_ids(st, len(h))]


def substring_dedup(documents: DataFrame, n: int = 13) -> DataFrame:
    """Removes each word covered by an n-word window that also starts in a document with a smaller doc_id.

    Words are runs without ASCII white space. Returns one row per
    input row: doc_id, n_words, n_removed, kept_sha256, kept (the kept words joined by a space). A null or empty
    text has no words; a document shorter than a window, or without an id, loses nothing; rows that repeat a
    doc_id are not earlier than each other. Other columns are ignored.
    """
    docs = W.prepared(documents)
    copies = C.written(W.exact_copies(docs), "copies")
    found = C.written(repeated_windows(docs, copies, n), "repeats")
    C.release(documents.sparkSession)
    copies = copies.withColumn("copy", F.lit(True))
    marked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").join(found, "doc_id", "left").join(copies, ["doc_id", "th"], "left")

    def finish(batches):
        for b in C.units(batches):
            el = W.Elements(b.column("text"), "words")
            raw = el.buf.tobytes()
            rows = []
            for i, (d, cell, copy) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("places").to_pylist(), b.column("copy").to_pylist(), strict=True)):
                a, z = el.first[i], el.first[i + 1]
                if copy:
                    gone = np.full(z - a, z - a >= n)
                else:
                    gone = W.covered(z - a, cell, n)
                keep = np.flatnonzero(~gone) + a
                kept = b" ".join([raw[s:e] for s, e in zip(el.starts[keep].tolist(), el.ends[keep].tolist(), strict=True)])
                rows.append((d, int(z - a), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield W.as_batch(rows, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]))

    return marked.select("doc_id", "text", "places", "copy").mapInArrow(finish, OUT)
