"""Repeated windows of words or bytes over a corpus, in packed exchanges.

A window is n consecutive elements. Each window names an anchor: the seed (k consecutive elements) in it
with the least hash. Equal windows have equal anchors, so a window can repeat only where its anchor does.
Round one therefore asks about anchors only, a few per cent of the positions; later rounds ask about windows
whose anchor repeats in another text. A map task sends, per partition of the next stage, one binary block of
columns; what a task knows by itself is settled there, so a passage that a third of all documents share costs
two entries per FLUSH entries, not one per document. Blocks grow with the square of the input (tasks times partitions),
so results, which are small, are held until a task ends and come back to fewer partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C

U64 = np.uint64
ASK, KNOWN = 0, 1
#: Positions hashed at once, so that the arrays between stay in a core's cache.
STRIP = 1 << 14
_INDEX_BITS = U64(32)
#: Entries that a task gathers before it sends blocks, so that blocks stay large where partitions are many.
FLUSH = 1 << 20
#: Partitions that are asked for each partition that results come back to, and the least number of these: with 200 and less Spark's writer opens a file for each.
FEWER, LEAST_BACK = 4, 256
BLOCK = "bucket int, kind int, payload binary"
FOUND = "doc_id long, payload binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Columns as one block: its size, then the compressed lengths and values."""
    head = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    raw = b"".join([head, *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(block: bytes, *dtypes) -> list[np.ndarray]:
    size = int(np.frombuffer(block, np.int64, 1)[0])
    raw = pa.decompress(pa.py_buffer(block)[8:], decompressed_size=size, codec="zstd", asbytes=True)
    out, at = [], 8 * len(dtypes)
    for n, d in zip(np.frombuffer(raw, np.int64, len(dtypes)), dtypes, strict=True):
        out.append(np.frombuffer(raw, d, int(n) // np.dtype(d).itemsize, at))
        at += int(n)
    return out


class Elements:
    """Elements of a unit: hashes or bytes, the document of each, and the place of a document's first one."""

    def __init__(self, col: pa.Array, kind: str, lower: bool = False, seed: int = 0):
        self.buf, self.off, self.seed = *C.text_buffer(col), seed
        if kind == "words":
            self.e, self.starts, self.ends, self.first = C.words(self.buf, self.off, lower, seed=seed)
        else:
            self.e, self.first = self.buf, self.off
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def seeds(self, k: int) -> np.ndarray:
        if self.e.dtype != np.uint8:
            return C.windows_of(self.e, k, self.seed)
        n = len(self.e) - k + 1
        if n <= 0:
            return np.zeros(0, U64)
        out = np.empty(n, U64)
        for a in range(0, n, STRIP):
            b = min(a + STRIP, n)
            x = self.e[a : b + k - 1].astype(U64)
            p2 = x[:-1] | x[1:] << U64(8)
            p4 = p2[:-2] | p2[2:] << U64(16)
            p8 = p4[:-4] | p4[4:] << U64(32)
            h = np.zeros(b - a, U64)
            for at in [*range(0, k - 7, 8), *([k - 8] if k % 8 else [])]:  # the last eight may overlap
                h = C.mix(h * C.PRIME + p8[at : at + b - a])
            out[a:b] = h
        return out

    def anchors(self, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window starts, anchor of each window, seed hashes); ties go to the leftmost seed of the window."""
        s = self.seeds(k)
        if len(self.e) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), s
        at = np.empty(len(self.e) - n + 1, np.int64)
        for a in range(0, len(at), STRIP):
            part = s[a : a + STRIP + n - k]
            key = part & ~U64(0xFFFFFFFF) | np.arange(a, a + len(part), dtype=U64)
            at[a : a + STRIP] = C.sliding_min(key, n - k + 1) & U64(0xFFFFFFFF)
        ok = self.doc[: len(at)] == self.doc[n - 1 : n - 1 + len(at)]
        w = np.flatnonzero(ok)
        return w, at[w], s

    def marked(self, places: list) -> np.ndarray:
        """Which elements are among the places of their document."""
        out = np.zeros(len(self.e) + 1, bool)
        for d, cell in enumerate(places):
            p = places_of(cell) + self.first[d]
            out[p[p < self.first[d + 1]]] = True
        return out

    def inner(self, n: int, k: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window starts, start of the ``length`` elements around the anchor of each window): equal windows have equal ones."""
        w, at, _ = self.anchors(n, k)
        return w, np.minimum(at, w + n - length)


def _blocks(order_key: np.ndarray, kind: int, columns: Callable[[np.ndarray], bytes]) -> Iterator[tuple[int, int, bytes]]:
    """One block per bucket; rows keep their order inside."""
    o = np.argsort(order_key, kind="stable")
    st = C.runs(order_key[o])
    for i, rows in zip(st, np.split(o, st[1:]), strict=True) if len(o) else ():
        yield int(order_key[o[i]]), kind, columns(rows)


def back(buckets: int) -> int:
    """How many partitions results come back to, where ``buckets`` are asked."""
    return max(-(-buckets // FEWER), min(buckets, LEAST_BACK))


def result_blocks(parts: list[tuple[np.ndarray, ...]], buckets: int, asking: bool = False) -> Iterator[tuple[int, int, bytes]]:
    """Settled columns (document first), one block per partition that they come back to; a task that asks sends them by way of the partitions it asks."""
    if parts:
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        key = (C.mix(columns[0].astype(U64)) % U64(back(buckets))).astype(np.int64)
        yield from _blocks(key * (buckets // back(buckets)) if asking else key, KNOWN, lambda r: pack(columns[0][r], *(c[r].astype(np.uint32) for c in columns[1:])))


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


BLOCK_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("payload", pa.binary())])


def gather(parts: Iterator[tuple[np.ndarray, ...] | None], flush: int = FLUSH) -> Iterator[list[np.ndarray]]:
    """Entries of several units (tuples of columns) until there are ``flush`` of them."""
    held: list = []
    n = 0
    for part in parts:
        if len(part[0]):
            held.append(part)
            n += len(part[0])
        if n >= flush:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held, n = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """(kind, payload) of all blocks of a partition."""
    for b in batches:
        yield from zip(b.column("kind").to_pylist(), b.column("payload").to_pylist(), strict=True)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Blocks of one bucket at a time, from batches sorted by bucket."""
    now, held = None, []
    for b in batches:
        for bucket, kind, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append((kind, payload))
    if held:
        yield now, held


def exchange(blocks: DataFrame, reduce: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str = FOUND, n: int | None = None) -> DataFrame:
    """Brings the blocks of each of ``n`` partitions (all unless given) together; their bucket is the partition's number."""
    return blocks.repartitionById(n or C.partitions(blocks.sparkSession), "bucket").mapInArrow(reduce, schema)


def parts_by_hash(h: np.ndarray, limit: int = FLUSH) -> Iterator[np.ndarray]:
    """Indices of entries, all entries of one hash together, about ``limit`` at once."""
    n = -(-len(h) // limit)
    if n <= 1:
        yield np.arange(len(h))
        return
    which = ((C.mix(h.astype(U64)) >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)
    o = np.argsort(which, kind="stable")
    yield from np.split(o, C.runs(which[o])[1:])


def repeated_anchors(docs: DataFrame, kind: str, n: int, k: int, lower: bool = False, length: int | None = None, before: int | None = None, seed: int = 0) -> DataFrame:
    """Blocks of (document, place), dealt by document: places of anchors that also occur in a different text.

    docs: doc_id, th (a hash of the text), text. An anchor is taken with ``length`` elements (k unless given). With
    ``before``, docs have the places of the anchors of that length that repeated, and only their windows are looked at.
    Only part of an anchor's hash is compared, so a few places may be reported that do not repeat; none that does is missed.
    """
    buckets, length = C.partitions(docs.sparkSession), length or k

    def entries(batches):
        for b in C.units(batches):
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            th = b.column("th").to_numpy(zero_copy_only=False)
            el = Elements(b.column("text"), kind, lower, seed)
            w, at = el.inner(n, k, length)
            if before:
                keep = el.marked(b.column("places").to_pylist())[el.inner(n, k, before)[1]]
                at = at[keep]
            at = at[C.runs(at)]
            h = (el.seeds(k) if length == k else C.windows_of(el.e, length, seed))[at] if len(at) else np.zeros(0, U64)
            d = el.doc[at]
            yield ids[d], th[d], h, (at - el.first[d]).astype(np.uint32)

    def ask(batches):
        found = []
        for ids, ts, h, pos in gather(entries(batches)):
            o = np.argsort(h, kind="stable")
            st = C.runs(h[o])
            g = C.group_ids(st, len(o))
            # the first entry of a second text, per hash that the task knows to repeat
            other = np.flatnonzero(ts[o] != ts[o[st]][g])
            other = other[C.runs(g[other])]
            several = np.zeros(len(st), bool)
            several[g[other]] = True
            known = np.zeros(len(h), bool)
            known[o] = several[g]
            found.append((ids[known], pos[known]))
            # such a hash still tells others, by entries of two different texts: one may be the only text of another task
            tell = ~known
            tell[o[st[several]]] = tell[o[other]] = True
            ids, ts, h, pos = ids[tell], ts[tell], h[tell], pos[tell]

            def columns(r, ids=ids, ts=ts, h=h, pos=pos):
                st = C.runs(ids[r])
                return pack(ids[r][st], ts[r][st], np.diff(np.concatenate((st, [len(r)]))).astype(np.uint32), (h[r] >> U64(32)).astype(np.uint32), pos[r])

            yield as_batch(list(_blocks(((h & U64(0xFFFFFFFF)) % U64(buckets)).astype(np.int64), ASK, columns)), BLOCK_ARROW)
        yield as_batch(list(result_blocks(found, buckets, asking=True)), BLOCK_ARROW)

    def settle(batches):
        got, found = [], []
        for what, payload in blocks_of(batches):
            if what == KNOWN:
                found.append(unpack(payload, np.int64, np.uint32))
            else:
                i, t, c, h, p = unpack(payload, np.int64, np.int64, np.uint32, np.uint32, np.uint32)
                got.append((np.repeat(i, c), np.repeat(t, c), h, p))
        if got:
            i, t, h, p = (np.concatenate(x) for x in zip(*got, strict=True))
            del got
            for r in parts_by_hash(h):
                o = r[np.argsort(h[r], kind="stable")]
                st = C.runs(h[o])
                several = (np.minimum.reduceat(t[o], st) != np.maximum.reduceat(t[o], st))[C.group_ids(st, len(o))]
                found.append((i[o][several], p[o][several]))
        yield as_batch(list(result_blocks(found, buckets)), BLOCK_ARROW)

    return exchange(docs.mapInArrow(ask, BLOCK), settle, BLOCK)


def _whole(batches: Iterator[pa.RecordBatch], *dtypes) -> list[np.ndarray]:
    """The columns of all blocks of a partition, by document (their first column)."""
    got = [unpack(payload, *dtypes) for _, payload in blocks_of(batches)]
    columns = [np.concatenate(x) for x in zip(*got, strict=True)] if got else [np.zeros(0, d) for d in dtypes]
    o = np.argsort(columns[0], kind="stable")
    return [x[o] for x in columns]


def _rows(docs: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    st = C.runs(docs)
    ends = np.concatenate((st[1:], [len(docs)])) if len(st) else st
    for at in range(0, len(st), 5000):
        yield as_batch([(int(docs[x]), values[x:y].tobytes()) for x, y in zip(st[at : at + 5000], ends[at : at + 5000], strict=True)], FOUND_ARROW)


def gathered(found: DataFrame) -> DataFrame:
    """(doc_id, places): one row per document with its places."""

    def run(batches):
        yield from _rows(*_whole(batches, np.int64, np.uint32))

    return exchange(found, run, n=back(C.partitions(found.sparkSession))).withColumnRenamed("payload", "places")


def ranges_gathered(found: DataFrame) -> DataFrame:
    """(doc_id, places): one row per document with its pairs of start and length."""

    def run(batches):
        docs, start, length = _whole(batches, np.int64, np.uint32, np.uint32)
        yield from _rows(docs, np.stack((start, length), 1))

    return exchange(found, run, n=back(C.partitions(found.sparkSession))).withColumnRenamed("payload", "places")


def places_of(cell: bytes | None) -> np.ndarray:
    """All places of a document."""
    return np.frombuffer(cell or b"", np.uint32).astype(np.int64)


def to_ranges(docs: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the runs of consecutive places."""
    o = np.lexsort((pos, docs))
    docs, pos = docs[o], pos[o].astype(np.int64)
    if not len(o):
        return docs, pos, pos
    st = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (np.diff(pos) > 1))))
    last = np.concatenate((st[1:], [len(o)])) - 1
    return docs[st], pos[st], pos[last] - pos[st] + 1


def covered(n_elements: int, cell: bytes | None, n: int) -> np.ndarray:
    """Elements inside an n-window that begins in one of the ranges."""
    d = np.zeros(n_elements + 1, np.int64)
    r = np.frombuffer(cell or b"", np.uint32).reshape(-1, 2).astype(np.int64)
    r = r[r.sum(1) + n - 1 <= n_elements]
    np.add.at(d, r[:, 0], 1)
    np.add.at(d, r.sum(1) + n - 1, -1)
    return np.cumsum(d[:-1]) > 0


def exact_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, th) of documents whose whole text also is in a document with a smaller id.

    The min per text combines on the map side, so a text with very many copies is no single task.
    """
    hashed = docs.where("text is not null").select("doc_id", "th", F.md5("text").alias("m"), F.length("text").alias("l"))
    first = hashed.groupBy("m", "th", "l").agg(F.min("doc_id").alias("first"))
    return hashed.join(first, ["m", "th", "l"]).where("doc_id > first").select("doc_id", "th").distinct()


def prepared(documents: DataFrame) -> DataFrame:
    """doc_id, th, text of the documents that have an id."""
    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
