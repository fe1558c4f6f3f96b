"""Epsilon grid order join of vectors under a cosine threshold."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C

AXES = 4
BLOCK = 512
LEAF = 64
#: Rows that the axes are fitted on. The axes only order and skip, so they cannot change a result.
SAMPLE = 2000
BLOCKS = "block long, label string, dim int, lo array<double>, hi array<double>, payload binary"
_BLOCKS_ARROW = pa.schema([("block", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("payload", pa.binary())])


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times the power of two that brings the largest component near 1; cosines stay as they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1, without overflow or underflow of the norms of finite vectors."""
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def leading_axes(distinct: DataFrame, axes: int = AXES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Per dimension of vectors, the leading principal axes of a bounded sample (the first rows by hash)."""
    rows = distinct.select("embedding").orderBy(F.xxhash64("key")).limit(sample).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r.embedding), []).append(r.embedding)
    out = {}
    for d, x in by.items():
        x = unit(np.array(x, np.float64))
        x -= x.mean(0)
        out[d] = np.linalg.svd(x, full_matrices=False)[2][:axes] if len(x) > 1 else np.eye(min(axes, d), d)
    return out


def _axes_for(axes: dict[int, np.ndarray], d: int) -> np.ndarray:
    a = axes.get(d)
    a = np.eye(min(AXES, d), d) if a is None else a
    return np.vstack((a, np.zeros((AXES - len(a), d)))) if len(a) < AXES else a


def _matrix(col: pa.Array) -> np.ndarray:
    return np.array(col.to_pylist(), np.float64)


def joined(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, na: np.ndarray, nb: np.ndarray, same: bool, eps: float, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with cosine at least the threshold, by recursion on sequence intervals; i < j if both sides are the same sequence."""
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        if same and m <= i:
            continue  # its mirror image is done
        gap = np.maximum(0, np.maximum(pa_[i:j].min(0) - pb[k:m].max(0), pb[k:m].min(0) - pa_[i:j].max(0)))
        if gap @ gap > eps * eps:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine * np.outer(na[i:j], nb[k:m]))
            x, y = x + i, y + k
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield x, y
        else:
            u, v = [(i, j)] if j - i <= LEAF else [(i, (i + j) // 2), ((i + j) // 2, j)], [(k, m)] if m - k <= LEAF else [(k, (k + m) // 2), ((k + m) // 2, m)]
            stack += [(*p, *q) for p in u for q in v]


def local_roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least reachable index of each of n nodes over edges (x, y)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def embedding_join(embeddings: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors with equal labels linked by cosine >= threshold, in double precision.

    Null, empty or zero vectors, ones with a null or non-finite component, and rows without a label or id link with
    nothing; vectors of different lengths do not link. Identical vectors with a label are collapsed first and counted,
    so a vector with very many copies is joined once. Vectors are scaled by a power of two before they are multiplied, so
    very large and very small components neither overflow nor vanish. A link counts rows, so a repeated row is another vector.
    Extra columns are ignored.
    """
    spark = embeddings.sparkSession
    eps = math.sqrt(2 * (1 - cosine)) + 1e-9
    e = F.col("embedding")
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    keyed = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(good, F.md5(F.array_join(F.transform(e, lambda v: (v + 0.0).cast("string")), ","))).alias("key"), "embedding")
    reps = C.written(keyed.where("key is not null").groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min(F.transform("embedding", lambda v: v.cast("double"))).alias("embedding")), "vectors")
    axes = leading_axes(reps)

    def placed(batches):
        for b in batches:
            lens = pa.compute.list_value_length(b.column("embedding")).to_numpy(zero_copy_only=False)
            for d in np.unique(lens):
                rows = np.flatnonzero(lens == d)
                t = b.take(pa.array(rows))
                x = _matrix(t.column("embedding"))
                p = unit(x) @ _axes_for(axes, int(d)).T
                cells = np.floor(p / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([t.column("label"), pa.array(np.full(len(rows), d, np.int32)), *[pa.array(cells[:, c]) for c in range(AXES)], t.column("rep"), t.column("weight"), t.column("embedding")], names=["label", "dim", *[f"c{c}" for c in range(AXES)], "rep", "weight", "embedding"])

    order = ["label", "dim", *[f"c{c}" for c in range(AXES)], "rep"]
    cells = reps.select("label", "rep", "weight", "embedding").mapInArrow(placed, "label string, dim int, " + ", ".join(f"c{c} int" for c in range(AXES)) + ", rep long, weight long, embedding array<double>")
    cells = C.written(cells, "cells")

    def blocked(batches):
        made, held, key = 0, [], None

        def flush():
            nonlocal made
            x = scaled(np.array([r[2] for r in held], np.float64))
            p = unit(x) @ _axes_for(axes, key[1]).T
            made += 1
            payload = np.array([r[0] for r in held], np.int64).tobytes() + np.array([r[1] for r in held], np.int64).tobytes() + x.tobytes()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip([[TaskContext.get().partitionId() << 32 | made], [key[0]], [key[1]], [p.min(0).tolist()], [p.max(0).tolist()], [payload]], _BLOCKS_ARROW, strict=True)], schema=_BLOCKS_ARROW)

        for b in batches:
            for label, dim, rep, weight, v in zip(*[b.column(c).to_pylist() for c in ("label", "dim", "rep", "weight", "embedding")], strict=True):
                if held and ((label, dim) != key or len(held) >= BLOCK):
                    yield flush()
                    held = []
                key = (label, dim)
                held.append((rep, weight, v))
        if held:
            yield flush()

    blocks = C.written(cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocked, BLOCKS), "blocks")
    # pairs of blocks that may hold a link: neighbouring cells on the first two axes, then the distance of their boxes
    cells_of = lambda c: F.explode(F.sequence(F.floor(F.col("lo")[c] / eps), F.floor(F.col("hi")[c] / eps) + 1))
    several = blocks.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min("block").alias("block"))
    boxes = blocks.select("block", "label", "dim", "lo", "hi").join(several.where("n > 1").select("label", "dim"), ["label", "dim"])
    near = boxes.withColumn("cell", cells_of(0)).withColumn("cell2", cells_of(1))
    side = lambda s: near.select(F.col("block").alias(s), "label", "dim", "cell", "cell2", F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}"))
    gap = sum((F.greatest(F.lit(0.0), F.col("lo_a")[c] - F.col("hi_b")[c], F.col("lo_b")[c] - F.col("hi_a")[c]) ** 2 for c in range(AXES)), F.lit(0.0))
    pairs = side("a").join(side("b"), ["label", "dim", "cell", "cell2"]).where((F.col("a") <= F.col("b")) & (gap <= eps * eps)).select("a", "b").distinct()
    pairs = pairs.union(several.where("n = 1").select(F.col("block").alias("a"), F.col("block").alias("b")))
    held = blocks.select("block", "dim", "payload")
    both = pairs.join(held.select(F.col("block").alias("a"), F.col("dim").alias("dim"), F.col("payload").alias("pa")), "a").join(held.select(F.col("block").alias("b"), F.col("payload").alias("pb")), "b")

    def linked(batches):
        for batch in batches:
            for i, j, d, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "dim", "pa", "pb")], strict=True):
                yield _linked(i, j, d, x, y)

    def _linked(i, j, d, x, y):
        def read(raw):
            n = len(raw) // (16 + 8 * d)
            ids = np.frombuffer(raw, np.int64, 2 * n)
            v = np.frombuffer(raw, np.float64, n * d, 16 * n).reshape(n, d)
            norm = np.linalg.norm(v, axis=1)
            return ids[:n], ids[n:], v, norm, (v / norm[:, None]) @ _axes_for(axes, d).T

        ra, wa, va, na, p = read(x)
        rb, wb, vb, nb, q = read(y)
        same = i == j
        shift = 0 if same else len(ra)
        ids = ra if same else np.concatenate((ra, rb))
        got = list(joined(va, vb, p, q, na, nb, same, eps, cosine))
        us = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.int64)
        vs = (np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.int64)) + shift
        w = wa if same else np.concatenate((wa, wb))
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, us, w[vs])
        np.add.at(links, vs, w[us])
        o = np.argsort(ids)  # so that a root is the least id
        back = np.argsort(o)
        root = ids[o][local_roots(len(ids), back[us], back[vs])][back]
        k = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[k]), pa.array(links[k]), pa.array(root[k])], names=["rep", "links", "root"])

    found = C.written(both.repartition(C.partitions(spark), "a", "b").mapInArrow(linked, "rep long, links long, root long"), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = C.connected_components(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    summary = reps.select("label", "key", "rep", "weight").join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    summary = summary.select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = keyed.select("vec_id", "label", "key").join(summary, ["label", "key"], "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
