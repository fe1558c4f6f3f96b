"""Grouped prefix join of documents by the Jaccard similarity of their word shingles.

Documents with the same shingle set are one class. Shingles are ordered from rare to frequent; two sets that are
similar enough share a shingle among the first few of each (the prefix). Classes with the same prefix and size
are one group, so the prefixes of many near copies are joined once. Group pairs are filtered by size, expanded to
their members and verified on the whole sets. Where a shingle joins many groups, only a star around one of them is
verified first; what that connects needs no further test, and every pair still unconnected is verified after.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C
from tidewake.llm import windows as W

U64 = np.uint64
#: Slots of the frequency sketch that orders shingles. Any common order gives exact results, so its size only affects speed.
SLOTS, SLICES = 1 << 21, 64
#: A shingle that joins more groups than this is joined as a star first.
STAR = 6
#: Least and most bits of a set's parity map, which has about two per shingle.
PARITY = (512, 1 << 17)


class Shingles:
    """Distinct shingle hashes of each text of a unit, sorted inside each text."""

    def __init__(self, col: pa.Array, size: int, seed: int):
        buf, off = C.text_buffer(col)
        e, _, _, first = C.words(buf, off, lower=True, seed=seed)
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(counts)), counts)
        h = C.windows_of(e, size, seed)
        ok = doc[: len(h)] == doc[size - 1 : size - 1 + len(h)] if len(h) else np.zeros(0, bool)
        h, d = h[ok], doc[: len(ok)][ok]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):  # the whole sequence is one shingle
            own = []
            for i in short:
                x = np.array([counts[i]], U64)
                for w in e[first[i] : first[i + 1]]:
                    x = C.mix(x * C.PRIME ^ w)
                own.append(x)
            h, d = np.concatenate((h, *own)), np.concatenate((d, short))
        o = np.lexsort((h, d))
        h, d = h[o], d[o]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.h, self.d = h[new], d[new]
        self.n = np.bincount(self.d, minlength=len(counts))
        self.first = np.concatenate(([0], np.cumsum(self.n)))

    def parity(self, i: int) -> bytes:
        """Per bit, how often a shingle of set i falls on it, modulo two. Folding halves gives the map of half the size."""
        bits = min(max(1 << int(2 * self.n[i] - 1).bit_length(), PARITY[0]), PARITY[1])
        at = (C.mix(self.h[self.first[i] : self.first[i + 1]] ^ C.M2) & U64(bits - 1)).astype(np.int64)
        return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()

    def signatures(self) -> list[bytes]:
        """128 bits of each set."""
        a, b = np.zeros(len(self.n), U64), np.zeros(len(self.n), U64)
        has = np.flatnonzero(self.n)
        if len(has):
            a[has] = np.add.reduceat(C.mix(self.h), self.first[has])
            b[has] = np.add.reduceat(C.mix(self.h ^ C.M1), self.first[has])
        return [x.tobytes() for x in np.stack((a, b), 1)]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> U64(40)).astype(np.int64) % SLOTS


def _sketched(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """Rows of two kinds: (doc_id, n, sig) of each document with words, and slices of document counts per shingle slot."""

    def run(batches):
        count = np.zeros(SLOTS, np.uint32)
        for b in C.units(batches):
            s = Shingles(b.column("text"), size, seed)
            slots, times = np.unique(_slot(s.h), return_counts=True)
            count[slots] += times.astype(np.uint32)
            has = np.flatnonzero(s.n)
            sig = s.signatures()
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(has)), pa.array(s.n[has]), pa.array([sig[i] for i in has], pa.binary()), pa.array(np.full(len(has), -1, np.int32))], names=["doc_id", "n", "sig", "slice"])
        yield pa.RecordBatch.from_arrays([pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()), pa.array([W.pack(x) for x in np.split(count, SLICES)], pa.binary()), pa.array(np.arange(SLICES, dtype=np.int32))], names=["doc_id", "n", "sig", "slice"])

    return C.written(docs.mapInArrow(run, "doc_id long, n long, sig binary, slice int"), "sketch")


def _frequencies(sketched: DataFrame) -> np.ndarray:
    """The summed sketch: SLOTS counters, whatever the input's size."""

    def add(batches):
        for i, held in W.by_bucket(pa.RecordBatch.from_arrays([b.column(0), b.column(0), b.column(1)], names=["bucket", "kind", "payload"]) for b in batches):
            total = sum(W.unpack(p, np.uint32)[0].astype(np.int64) for _, p in held)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([W.pack(np.minimum(total, 2**32 - 1).astype(np.uint32))], pa.binary())], names=["slice", "sig"])

    parts = sketched.where("slice >= 0").select("slice", "sig").repartition("slice").sortWithinPartitions("slice").mapInArrow(add, "slice int, sig binary").collect()
    out = np.zeros((SLICES, SLOTS // SLICES), np.uint32)
    for r in parts:
        out[r.slice] = W.unpack(r.sig, np.uint32)[0]
    return out.ravel()


def _prefixes(docs: DataFrame, size: int, percent: int, counts, seed: int) -> DataFrame:
    """(doc_id, n, sig, prefix, bits): the rarest n - ceil(percent * n / 100) + 1 shingles of each set, and its parity map."""

    def run(batches):
        freq = counts.value
        for b in C.units(batches):
            s = Shingles(b.column("text"), size, seed)
            o = np.lexsort((s.h, freq[_slot(s.h)], s.d))
            h = s.h[o]
            keep = s.n - (percent * s.n + 99) // 100 + 1
            ids, sig, rows = b.column("doc_id").to_pylist(), s.signatures(), []
            for i in np.flatnonzero(s.n).tolist():
                p = h[s.first[i] : s.first[i] + keep[i]]
                rows.append((ids[i], int(s.n[i]), sig[i], p.tobytes(), s.parity(i)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], strict=True)], names=["doc_id", "n", "sig", "prefix", "bits"])

    return docs.mapInArrow(run, "doc_id long, n long, sig binary, prefix binary, bits binary")


def _group_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Rows (run, a, b): pairs of groups that share a prefix shingle and fit in size, or, with b null, the members a of a run too long for all its pairs.

    groups: gid, n, prefix; one row per group, so a block of a bucket holds each group once per unit.
    """
    buckets = C.partitions(groups.sparkSession)

    def entries(batches):
        for b in batches:
            gid, n = b.column("gid").to_numpy(), b.column("n").to_numpy()
            p = [np.frombuffer(x, U64) for x in b.column("prefix").to_pylist()]
            g = np.repeat(np.arange(len(p)), [len(x) for x in p])
            yield np.concatenate(p) if p else np.zeros(0, U64), gid[g], n[g]

    def ask(batches):
        for h, gid, n in W.gather(entries(batches)):

            def columns(r, h=h, gid=gid, n=n):
                st = C.runs(gid[r])
                return W.pack(gid[r][st], n[r][st].astype(np.int64), np.diff(np.concatenate((st, [len(r)]))).astype(np.uint32), (h[r] >> U64(32)).astype(np.uint32))

            yield W.as_batch(list(W._blocks(((h & U64(0xFFFFFFFF)) % U64(buckets)).astype(np.int64), W.ASK, columns)), W.BLOCK_ARROW)

    def settle(batches):
        got = [W.unpack(p, np.int64, np.int64, np.uint32, np.uint32) for _, p in W.blocks_of(batches)]
        if not got:
            return
        all_g, all_n = (np.concatenate([np.repeat(x[i], x[2]) for x in got]) for i in (0, 1))
        all_h = np.concatenate([x[3] for x in got])
        del got
        bucket, made = TaskContext.get().partitionId(), 0
        for r in W.parts_by_hash(all_h):
            g, n, h = all_g[r], all_n[r], all_h[r]
            o = np.lexsort((g, n, h))
            g, n, h = g[o], n[o], h[o]
            st = C.runs(h)
            size = np.diff(np.concatenate((st, [len(h)])))
            a, b = [], []
            for k in range(2, STAR + 1):  # all pairs of short runs
                at = st[size == k]
                for i in range(k):
                    for j in range(i + 1, k):
                        a.append(at + i), b.append(at + j)
            long = size > STAR
            if long.any():
                first, m = np.repeat(st[long], size[long]), size[long]
                member = first + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
                # a star around the middle member, which is nearest in size to both ends, and a chain
                middle = np.repeat(st[long] + m // 2, m)
                a += [np.minimum(middle, member), member[:-1]]
                b += [np.maximum(middle, member), member[1:]]
                whose = np.repeat(np.flatnonzero(long), m)
                a[-1], b[-1] = a[-1][whose[1:] == whose[:-1]], b[-1][whose[1:] == whose[:-1]]
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
            fit = (a != b) & (100 * n[a] >= percent * n[b])
            x, y = np.minimum(g[a[fit]], g[b[fit]]), np.maximum(g[a[fit]], g[b[fit]])
            pairs = np.unique(np.stack((x, y), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["run", "a", "b"])
            if long.any():
                runs = (np.int64(bucket) << 32) + made + whose
                made += len(st)
                yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array(g[member]), pa.nulls(len(member), pa.int64())], names=["run", "a", "b"])

    return W.exchange(groups.mapInArrow(ask, W.BLOCK), settle, "run long, a long, b long")


def _folded(m: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(m, U64)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _may_link(apart, n, percent: int):
    """False only where parity maps differ in more bits (apart) than sets of n shingles together can, if they link.

    Two maps differ in no more bits than the sets in shingles.
    """
    return apart * (100 + percent) <= (100 - percent) * n


def _pruned(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and parity maps allow."""

    def run(batches):
        for b in batches:
            apart = []
            for x, y in zip(b.column("xa").to_pylist(), b.column("xb").to_pylist(), strict=True):
                size = min(len(x), len(y)) // 8
                apart.append(int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()))
            ok = _may_link(np.array(apart, np.int64), b.column("na").to_numpy() + b.column("nb").to_numpy(), percent)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    side = lambda s: own.select(F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"x{s}"))
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").where(near).select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def _unconnected_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs within a run of different components that sizes and parity maps allow.

    rest: run, rep, c, n, bits. A run's maps are compared in blocks; only pairs that may link become rows.
    """

    def settle(batches):
        for held in _whole_runs(batches):
            rep, c, n = (held.column(x).to_numpy() for x in ("rep", "c", "n"))
            o = np.argsort(n, kind="stable")
            rep, c, n = rep[o], c[o], n[o]
            maps = held.column("bits").to_pylist()
            maps = [maps[k] for k in o]
            j = 0
            while j < len(n):
                i = j  # a block of sets of nearly the same size
                j = min(i + 64, int(np.searchsorted(n, n[i] * 1.2, "right")))
                last = int(np.searchsorted(n, n[j - 1] * 100 // percent, "right"))
                x = np.stack([_folded(m, len(maps[i]) // 8) for m in maps[i:last]])
                own, other = np.arange(i, j)[:, None], np.arange(i, last)[None]
                apart = np.zeros((j - i, last - i), np.int64)
                for k in range(x.shape[1]):
                    apart += np.bitwise_count(x[: j - i, k, None] ^ x[None, :, k])
                ok = _may_link(apart, n[i:j, None] + n[None, i:last], percent) & (own < other) & (c[i:j, None] != c[None, i:last])
                u, v = np.nonzero(ok)
                u, v = rep[i + u], rep[i + v]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    return rest.repartition("run").sortWithinPartitions("run").mapInArrow(settle, "a long, b long")


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by run, as one table per run."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        run = b.column("run").to_numpy()
        st = C.runs(run)
        for i, s in enumerate(st):
            part = b.slice(int(s), int(st[i + 1] if i + 1 < len(st) else len(run)) - int(s))
            if held and held[0].column("run")[0] != part.column("run")[0]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _sets(docs: DataFrame, size: int, seed: int) -> DataFrame:
    def run(batches):
        for b in C.units(batches):
            s = Shingles(b.column("text"), size, seed)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.h[x:y].tobytes() for x, y in zip(s.first[:-1], s.first[1:], strict=True)], pa.binary())], names=["doc_id", "set"])

    return docs.mapInArrow(run, "doc_id long, set binary")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """The pairs (a, b) of documents that link, tested on their whole sets."""
    pairs = C.written(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = C.written(_sets(docs.join(ids, "doc_id", "left_semi"), size, seed), "sets")

    def test(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                both = np.concatenate((np.frombuffer(x, U64), np.frombuffer(y, U64)))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa")).hint("merge"), "a")
    two = one.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb")).hint("merge"), "b")
    return two.select("a", "b", "sa", "sb").mapInArrow(test, "a long, b long")


def ngram_join(documents: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id: connected documents with Jaccard similarity >= percent / 100.

    Words are runs without ASCII white space, A-Z folded; a set holds the distinct ``size``-word shingles as 64-bit hashes under a
    seed drawn on the driver, or the whole sequence for fewer words. Null or empty texts have no set and link with nothing. component_id is the
    least doc_id reachable by links, class_id the least with the same set. Rows without an id get nulls; rows that repeat
    a doc_id count as one document if their texts agree (else each is joined under that id). Extra columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seed = C.secret()
    sketched = _sketched(docs, size, seed)
    counts = spark.sparkContext.broadcast(_frequencies(sketched))
    rows = sketched.where("slice < 0").select("doc_id", "n", "sig")
    classes = C.written(rows.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # one row per class, then one per group of classes with the same prefix and size
    own = _prefixes(docs, size, percent, counts, seed).groupBy("sig").agg(F.min(F.struct("doc_id", "n", "prefix", "bits")).alias("r")).select(F.col("r.doc_id").alias("rep"), "r.n", "r.prefix", "r.bits")
    own = C.written(own, "prefixes")
    members = own.select("rep", F.md5(F.concat(F.col("prefix"), F.encode(F.col("n").cast("string"), "UTF-8"))).alias("g"))
    leaders = members.groupBy("g").agg(F.min("rep").alias("gid"), F.count("*").alias("size"))
    members = C.written(members.join(leaders, "g").select("gid", "rep", "size"), "members")
    groups = own.hint("merge").join(members.where("gid = rep").select(F.col("gid").alias("rep")), "rep", "left_semi").select(F.col("rep").alias("gid"), "n", "prefix")
    found = C.written(_group_pairs(groups, percent), "found")
    pairs = found.where("b is not null").select("a", "b").distinct()
    inner = members.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    first = C.written(_verified(_pruned(pairs.union(inner).distinct(), own, percent), docs, size, percent, seed), "links")
    parts = C.written(C.connected_components(first, "a", "b"), "parts")
    # second round: pairs of members that share a run or a group and are not connected yet
    labelled = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("gid", "rep", F.coalesce("component", "rep").alias("c"))
    sizes = own.select("rep", "n")
    labelled = labelled.join(sizes.hint("merge"), "rep")
    long = found.where("b is null").select("run", F.col("a").alias("gid")).distinct()
    crowd = F.col("gid") * 0 - 1 - F.col("gid")  # a group is a run of its own
    within = labelled.join(members.where("size > 1").select("rep"), "rep", "left_semi").select(crowd.alias("run"), "gid", "rep", "c", "n")
    placed = long.join(labelled, "gid").select("run", "gid", "rep", "c", "n").unionByName(within)
    # pairs of groups tested by their leaders alone, with members still to expand
    open_pairs = pairs.withColumn("run", F.xxhash64("a", "b")).select("run", F.explode(F.array("a", "b")).alias("gid")).join(members.where("size > 1").select("gid").distinct().withColumn("many", F.lit(1)), "gid", "left")
    crowded = open_pairs.groupBy("run").agg(F.max("many").alias("m")).where("m = 1").select("run")
    placed = placed.unionByName(open_pairs.join(crowded, "run", "left_semi").select("run", "gid").join(labelled, "gid").select("run", "gid", "rep", "c", "n"))
    placed = C.written(placed, "placed")
    split = placed.groupBy("run").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("run")
    rest = placed.join(split, "run", "left_semi").select("run", "rep", "c", "n").join(own.select("rep", "bits").hint("merge"), "rep")
    more = _unconnected_pairs(rest, percent).distinct().join(pairs.union(inner), ["a", "b"], "left_anti")
    second = _verified(more, docs, size, percent, seed)
    links = first.union(second)
    parts = C.connected_components(C.written(links, "links"), "a", "b").withColumnRenamed("node", "rep")
    of = rows.join(classes, "sig").join(parts, "rep", "left").groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("rep").alias("class_id"), F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = documents.select(F.col("doc_id").cast("long").alias("doc_id")).join(of, "doc_id", "left")
    return out.select("doc_id", F.coalesce("n_shingles", F.when(F.col("doc_id").isNotNull(), F.lit(0).cast("long"))).alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))
