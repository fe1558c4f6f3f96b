"""Shared folders, lineage cuts, vectorised words, packed exchanges and connected components."""

from __future__ import annotations

import gc
import hashlib
import os
import secrets
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
M1, M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
PRIME = U64(0x9E3779B97F4A7C15)
#: Bytes of text that a Python worker handles at once.
UNIT = 2 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under spark.checkpoint.dir, which all executors share; a local one only where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"file://{tempfile.gettempdir()}/tidewake-{os.getuid()}"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet to a shared folder and reads it back, so a lost executor repeats no earlier stage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that nothing refers to any more, as after a lineage cut.

    Its cleaner acts only after a collection on the driver, which else may come when a later job has filled the disks too;
    Python's own handles are in cycles and go first.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)  # the cleaner works beside the driver; the next job would write before it has deleted


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * M1
    x = (x ^ (x >> U64(27))) * M2
    return x ^ (x >> U64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1]
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def units(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = UNIT) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows with about ``size`` bytes of text; a longer text is a unit of its own."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, off = text_buffer(b.column(text))
        first = 0
        while first < b.num_rows:
            last = max(first + 1, int(np.searchsorted(off, off[first] + size, "right")) - 1)
            yield b.slice(first, min(last, b.num_rows) - first)
            first = last


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x80:] = _LETTER[65:91] = _LETTER[97:123] = True
_ALNUM = _LETTER.copy()
_ALNUM[48:58] = True
#: Bytes of which words are made.
INSIDE = {"words": ~_SPACE, "letters": _LETTER, "alnum": _ALNUM}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first bytes of a little-endian word.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], U64)
#: Words of more bytes are hashed one by one, by a digest.
_LONG = 64


def secret() -> int:
    """A seed for hashes that decide results, drawn on the driver: no text can be written so that two of its words collide."""
    return secrets.randbits(63)


def keys_of(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers that follow from a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + mix(np.array([seed], U64))) * PRIME) | U64(1)


def words(buf: np.ndarray, off: np.ndarray, lower: bool = False, kind: str = "words", seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of each text: 64-bit hashes, byte starts and ends, and first word of each text (with the total last).

    Every text is handled in numpy at once; lower folds A-Z only. kind chooses other runs of bytes: letters or alnum,
    where all bytes beyond ASCII count as letters. Hashes take eight bytes at a time, each step a bijective finaliser.
    """
    inside = INSIDE[kind][buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True  # a word never spans two texts
    before = np.empty(len(buf), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(buf), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    bounds = np.searchsorted(starts, off)
    if not len(starts):
        return np.zeros(0, U64), starts, ends, bounds
    return hashed(buf, starts, ends - starts, lower, seed), starts, ends, bounds


def hashed(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte strings inside buf."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = _LOWER[buf] if lower else buf
    eight = np.ndarray(len(buf), "<u8", padded.data, strides=(1,))
    h = mix(lens.astype(U64) + mix(np.array([seed], U64)))
    live = np.flatnonzero(lens <= _LONG)
    at, left = starts[live], lens[live]
    state = h[live]
    while len(live):
        state = mix(state * PRIME + (eight[at] & _FIRST[np.minimum(left, 8)]))
        more = left > 8
        done = ~more
        h[live[done]] = state[done]
        live, at, left, state = live[more], at[more] + 8, left[more] - 8, state[more]
    for i in np.flatnonzero(lens > _LONG).tolist():
        raw = padded[starts[i] : starts[i] + lens[i]].tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(raw, digest_size=8, key=seed.to_bytes(8, "little")).digest(), U64)[0]
    return h


def windows_of(e: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all k consecutive elements: each place has a multiplier of its own."""
    n = len(e) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.zeros(n, U64)
    for j, key in enumerate(keys_of(seed, k)):
        h += e[j : j + n] * key
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Min of each w consecutive values, by doubling."""
    width, m = 1, x
    while width * 2 <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return m if width == w else np.minimum(m[: len(x) - w + 1], m[w - width :][: len(x) - w + 1])


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def group_ids(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [n]))))


ROW = "__row_id"


def with_row_ids(docs: DataFrame) -> DataFrame:
    """docs with a long ROW: doc_id where all rows that have it agree in text, else 2 ** 62 and more by a hash of doc_id and text.

    So rows without a doc_id, or that share one but not the text, come after all others; equal rows get the same.
    """
    th = F.xxhash64("text")
    split = written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(th).alias("a"), F.max(th).alias("b")).where("a <> b").select("doc_id", F.lit(True).alias("__split")), "split")
    other = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    return docs.join(split, "doc_id", "left").withColumn(ROW, F.when(F.col("doc_id").isNull() | F.col("__split"), other).otherwise(F.col("doc_id").cast("long"))).select(*docs.columns, ROW)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges, for all nodes with an edge.

    Alternating large-star and small-star rounds in DataFrame operations only: each round links a node's
    neighbours to its least neighbour, which halves path lengths. The least neighbour comes from a min that
    combines on the map side and a join that AQE can split, so a node with very many edges is no single task.
    Edges are written between rounds; only their count and checksum reach the driver. Nulls are ignored.
    """
    e = edges.select(F.least(src, dst).alias("v"), F.greatest(src, dst).alias("u")).where("u is not null and v is not null and u <> v").distinct()
    nodes = edges.select(F.col(src).alias("node")).union(edges.select(F.col(dst).alias("node"))).where("node is not null").distinct()
    e = written(e, "edges")
    nodes = written(nodes, "nodes")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = written(small, "edges")
    root = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
