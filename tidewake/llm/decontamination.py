"""Benchmark passages in training texts: n-gram seeds find candidates, Smith-Waterman alignment scores them.

Every seed of an item is looked up, however common: a passage leaked into very many documents makes its own seeds common.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C

U64 = np.uint64
#: Words of a seed.
SEED = 3
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Items searched in one pass over the texts, which bounds what is broadcast.
ITEMS = 20_000
_BITS = 22


class Texts:
    """Hashes of the words (letters and digits, A-Z folded) of some texts."""

    def __init__(self, col: pa.Array):
        buf, off = C.text_buffer(col)
        self.h, _, _, self.first = C.words(buf, off, lower=True, kind="alnum")
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.first))

    def seeds(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, places) of all seeds inside one text."""
        h = C.windows_of(self.h, k)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1 : k - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
        return h[at], at


class Seeds:
    """Sorted seed hashes with a bit table before them."""

    def __init__(self, hashes: np.ndarray):
        self.h = np.unique(hashes)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[(self.h >> U64(64 - _BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices into h, indices into the seeds) of the hashes that are seeds."""
        at = np.flatnonzero(self.table[(h >> U64(64 - _BITS)).astype(np.int64)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
        ok = self.h[k] == h[at]
        return at[ok], k[ok]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(best local score, first place in text, end) under linear gaps; a row of the table is computed at once."""
    best, end = 0, 0
    j = np.arange(len(text)) * -GAP
    row = np.zeros(len(text) + 1, np.int64)
    for w in item:
        t = np.maximum(np.maximum(row[:-1] + np.where(text == w, MATCH, MISMATCH), row[1:] + GAP), 0)
        t = np.maximum.accumulate(t + j) - j
        row = np.concatenate(([0], t))
        k = int(t.argmax())
        if t[k] > best:
            best, end = int(t[k]), k + 1
    if not best:
        return 0, 0, 0
    # the same alignment backwards from its end gives its first place
    row, first = np.zeros(end + 1, np.int64), end
    back, top = text[:end][::-1], 0
    j = j[:end]
    for w in item[::-1]:
        t = np.maximum(np.maximum(row[:-1] + np.where(back == w, MATCH, MISMATCH), row[1:] + GAP), 0)
        t = np.maximum.accumulate(t + j) - j
        row = np.concatenate(([0], t))
        k = int(t.argmax())
        if t[k] > top:
            top, first = int(t[k]), end - k - 1
    return best, first, end


def decontaminate(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, k: int = SEED) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word: documents that hold a passage aligned with a benchmark item.

    score is the best local alignment over words, divided by that of an exact copy; pairs at ``threshold`` or above are
    returned with the place of the best one. A pair is looked at if any ``k`` words in a row are equal. Items of fewer
    than ``k`` words, null or empty texts and rows without a doc_id give no pairs; repeated rows or items give one pair
    each time. A benchmark of any size is searched in blocks of about ITEMS items. Extra columns are ignored.
    """
    docs = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = max(1, -(-items.count() // ITEMS))
    out = None
    for b in range(blocks):
        part = _searched(docs, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect(), threshold, k)
        out = part if out is None else out.unionByName(part)
    return out


def _searched(docs: DataFrame, items: list, threshold: float, k: int) -> DataFrame:
    t = Texts(pa.array([r.text for r in items], pa.string()))
    h, at = t.seeds(k)
    seeds = Seeds(h)
    # (seed, item, place in item)
    which, item = np.searchsorted(seeds.h, h), t.doc[at]
    place = at - t.first[item]
    o = np.argsort(which, kind="stable")
    which, item, place = which[o], item[o], place[o]
    begin = C.runs(which)
    size = np.diff(np.concatenate((begin, [len(which)])))
    shared = docs.sparkSession.sparkContext.broadcast((seeds, begin, size, item, place, t.h, t.first, [r.item_id for r in items]))

    def run(batches):
        seeds, begin, size, item, place, words, first, ids = shared.value
        for b in C.units(batches):
            x = Texts(b.column("text"))
            h, at = x.seeds(k)
            i, s = seeds.find(h)
            rows = []
            if len(i):
                # every hit once per item that has the seed
                n = size[s]
                inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                e = np.repeat(begin[s], n) + inner
                pos, it, pl = np.repeat(at[i], n), item[e], place[e]
                d = x.doc[pos]
                lens = (first[1:] - first[:-1])[it]
                o = np.lexsort((pos, it, d))
                d, it, pos, pl, lens = d[o], it[o], pos[o], pl[o], lens[o]
                new = np.ones(len(o), bool)
                # foreign words in an alignment of n item words cost GAP each, so at the threshold there are ``room`` at most
                room = np.floor(MATCH * (1 - threshold) * lens / -GAP).astype(np.int64)
                new[1:] = (d[1:] != d[:-1]) | (it[1:] != it[:-1]) | (np.diff(pos) > 2 * (lens + room)[1:])
                st = np.flatnonzero(new)
                lo = np.minimum.reduceat(pos - pl - room, st)
                hi = np.maximum.reduceat(pos - pl + lens + room, st)
                docs_ids = b.column("doc_id").to_pylist()
                best: dict[tuple[int, int], tuple] = {}
                aligned: dict[tuple[int, bytes], tuple[int, int, int]] = {}
                for q, z, y in zip(st.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    dd, ii = int(d[q]), int(it[q])
                    z, y = max(z, int(x.first[dd])), min(y, int(x.first[dd + 1]))
                    own, text = words[first[ii] : first[ii + 1]], x.h[z:y]
                    if np.isin(own, text).sum() < threshold * len(own):
                        continue  # no alignment can reach the threshold
                    same = ii, text.tobytes()  # copies of a text are aligned once
                    if same not in aligned:
                        aligned[same] = smith_waterman(own, text)
                    score, f, end = aligned[same]
                    got = (score / (MATCH * len(own)), f + z - int(x.first[dd]), end + z - int(x.first[dd]))
                    if got[0] >= threshold and got[0] > best.get((dd, ii), (0,))[0]:
                        best[dd, ii] = got
                rows = [(docs_ids[dd], ids[ii], *got) for (dd, ii), got in best.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [[]] * 5, [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()], strict=True)], names=["doc_id", "item_id", "score", "first_word", "end_word"])

    return docs.mapInArrow(run, "doc_id long, item_id long, score double, first_word long, end_word long")
