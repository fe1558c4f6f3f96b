"""A linear-chain conditional random field that tags toxic words.

States are clean and toxic. A word's features are its hashed letters and its prefixes. Word labels for training are
derived from labelled documents: a feature found in many toxic documents of the sample and (almost) no clean one marks
the words of toxic documents that have it. The field learns feature weights and transitions from them by the gradient
of the log-likelihood; forward-backward marginals of each word then give a document's offending offsets and score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewake.llm import common as C

U64 = np.uint64
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
PREFIXES = (5, 6, 7, 8)
#: Words handled in step; a longer document is several segments of one chain, joined by their transfer matrices.
SEGMENT = 64
#: Sampled training documents that are clean and toxic, and the longest text (in characters) that is sampled.
SAMPLE, LONGEST = (2000, 1000), 8_000
THRESHOLD = 0.7
#: A feature marks words if it is in this many toxic documents, or this share of them, and so many times likelier there.
_EPOCHS, _MIN_DOCS, _MIN_SHARE, _ODDS = 30, 4, 0.015, 20.0


@dataclass
class Field:
    weights: np.ndarray  # of feature slots, for the toxic state
    start: np.ndarray  # log potentials of the first state
    step: np.ndarray  # log potentials of transitions
    document: np.ndarray  # bias, weight of the highest marginal, weight of the log of their sum


class Words:
    """Words of letters of a unit's texts, with their feature slots (-1: no such feature)."""

    def __init__(self, col: pa.Array):
        self.buf, self.off = C.text_buffer(col)
        h, self.starts, self.ends, self.first = C.words(self.buf, self.off, lower=True, kind="letters")
        lens = self.ends - self.starts
        slots = np.full((len(h), 1 + len(PREFIXES)), -1, np.int32)
        slots[:, 0] = (h >> U64(64 - SLOT_BITS)).astype(np.int32)
        for i, k in enumerate(PREFIXES):
            has = np.flatnonzero(lens >= k)
            slots[has, 1 + i] = (C.hashed(self.buf, self.starts[has], np.full(len(has), k), True, 1000 + k) >> U64(64 - SLOT_BITS)).astype(np.int32)
        self.slots = slots
        self.doc = np.repeat(np.arange(len(self.off) - 1), np.diff(self.first))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.append(weights, np.float32(0))[self.slots].sum(1, dtype=np.float64)


def marginals(score: np.ndarray, doc: np.ndarray, f: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(P(toxic) of each word, expected transitions, expected starts, log of the partition) by forward-backward; a document's words are one chain.

    doc: the document of each word, in order. Segments of SEGMENT words run in step: first the transfer matrix of each,
    then messages from segment to segment of a document, then the words inside.
    """
    if not len(score):
        return np.zeros(0), np.zeros((2, 2)), np.zeros(2), 0.0
    begin = C.runs(doc)
    inner = np.arange(len(doc)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(doc)]))))
    place = inner % SEGMENT
    head = np.flatnonzero(place == 0)
    seg = np.cumsum(place == 0) - 1
    n, order = len(head), inner[head] // SEGMENT  # order: which segment of its document
    last = np.append(order[1:] == 0, True)
    steps = int(place.max()) + 1
    x = np.ones((steps, n))
    x[place, seg] = np.exp(np.clip(score, -30, 30))
    live = np.zeros((steps, n), bool)
    live[place, seg] = True
    a = np.exp(f.step)
    start = np.exp(f.start)
    # into[s]: what reaches the first word of segment s; out[s]: what comes back to its last word
    into, out = np.repeat(start[:, None], n, 1), np.ones((2, n))
    if n > len(begin):
        m = np.zeros((2, 2, n))  # from a state of the first word to a state of the last
        m[0, 0], m[1, 1] = 1.0, x[0]
        for t in range(1, steps):
            on = live[t]
            step = np.stack((m[:, 0] * a[0, 0] + m[:, 1] * a[1, 0], (m[:, 0] * a[0, 1] + m[:, 1] * a[1, 1]) * x[t]), 1)
            m = np.where(on, step / step.sum((0, 1)), m)
        by = np.argsort(order, kind="stable")
        levels = np.split(by, C.runs(order[by])[1:])
        for level in levels[1:]:
            v = (into[:, None, level - 1] * m[:, :, level - 1]).sum(0)
            v /= v.sum(0)
            into[:, level] = v[0] * a[0][:, None] + v[1] * a[1][:, None]
        for level in reversed(levels[1:]):
            v = (m[:, :, level] * out[None, :, level]).sum(1)
            back = a[:, 0][:, None] * v[0] + a[:, 1][:, None] * v[1]
            out[:, level - 1] = back / back.sum(0)
    alpha, scale = np.zeros((steps, 2, n)), np.ones((steps, n))
    now = np.stack((into[0], into[1] * x[0]))
    for t in range(steps):
        if t:
            now = np.where(live[t], np.stack((p[0] * a[0, 0] + p[1] * a[1, 0], (p[0] * a[0, 1] + p[1] * a[1, 1]) * x[t])), p)
        scale[t] = now.sum(0)
        p = now / scale[t]
        alpha[t] = p
    beta = out / (p * out).sum(0)
    toxic, pairs = np.zeros((steps, n)), np.zeros((2, 2))
    for t in range(steps - 1, -1, -1):
        toxic[t] = alpha[t, 1] * beta[1]
        on = live[t]
        ahead = np.stack((beta[0], beta[1] * x[t])) / scale[t]
        if t:
            for i in (0, 1):
                for j in (0, 1):
                    pairs[i, j] += (alpha[t - 1, i] * a[i, j] * ahead[j])[on].sum()
            beta = np.where(on, np.stack((a[0, 0] * ahead[0] + a[0, 1] * ahead[1], a[1, 0] * ahead[0] + a[1, 1] * ahead[1])), beta)
    later = np.flatnonzero(order > 0)  # transitions from segment to segment
    if len(later):
        w = p[:, None, later - 1] * a[:, :, None] * ahead[None, :, later]
        pairs += (w / w.sum((0, 1))).sum(2)
    first = toxic[0][order == 0]
    return toxic[place, seg], pairs, np.array([(1 - first).sum(), first.sum()]), float(np.log(scale)[live].sum())


def _document_features(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    top, total = np.zeros(n), np.zeros(n)
    np.maximum.at(top, doc, p)
    np.add.at(total, doc, np.where(p >= 0.2, p, 0.0))
    return np.stack((np.ones(n), top, np.log1p(total)), 1)


def distinct_texts(texts: list[str], bottom: int = 16, same: int = 8) -> list[int]:
    """Indices of texts that are no near copy of an earlier one: fewer than ``same`` of their least shingle hashes agree.

    Words that only a copied document has would else look like words that many documents have.
    """
    w = Words(pa.array(texts, pa.string()))
    h = C.windows_of(w.slots[:, 0].astype(U64), 4)
    seen: dict[int, list[int]] = {}
    keep = []
    for i in range(len(texts)):
        least = np.unique(h[w.first[i] : max(w.first[i], w.first[i + 1] - 3)])[:bottom].tolist()
        shared: dict[int, int] = {}
        for x in least:
            for j in seen.get(x, ()):
                shared[j] = shared.get(j, 0) + 1
        if max(shared.values(), default=0) < min(same, max(1, len(least))):
            keep.append(i)
            for x in least:
                seen.setdefault(x, []).append(i)
    return keep


def fit(texts: list[str], toxic: np.ndarray) -> Field:
    """Learns the field from whole texts and their labels; without both classes nothing is toxic."""
    keep = distinct_texts(texts)
    texts, toxic = [texts[i] for i in keep], np.asarray(toxic)[keep]
    f = Field(np.zeros(SLOTS, np.float32), np.zeros(2), np.zeros((2, 2)), np.array([-3.0, 0.0, 0.0]))
    if not len(texts) or toxic.min() == toxic.max():
        return f
    w = Words(pa.array(texts, pa.string()))
    flat, docs = w.slots.ravel(), np.repeat(w.doc.astype(np.int32), w.slots.shape[1])
    pair = np.unique((docs[flat >= 0].astype(np.int64) << 32) | flat[flat >= 0])
    bad = toxic[pair >> 32] == 1
    in_toxic, in_clean = (np.bincount((pair & 0xFFFFFFFF)[k], minlength=SLOTS) for k in (bad, ~bad))
    del pair, docs
    n1, n0 = max(1, int((toxic == 1).sum())), max(1, int((toxic == 0).sum()))
    marks = (in_toxic >= max(_MIN_DOCS, _MIN_SHARE * n1)) & (in_toxic / n1 >= _ODDS * (in_clean + 0.1) / n0)
    y = np.append(marks, False)[w.slots].any(1) & (toxic[w.doc] == 1)
    there = flat >= 0
    seen_pairs = np.zeros((2, 2))
    at = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    np.add.at(seen_pairs, (y[at].astype(int), y[at + 1].astype(int)), 1)
    heads = y[C.runs(w.doc)]
    seen_first = np.array([(~heads).sum(), heads.sum()])
    g2 = [np.full(SLOTS, 1e-3, np.float32), np.full(2, 1e-3), np.full((2, 2), 1e-3)]
    f.start, f.step = np.array([0.0, -2.0]), np.array([[0.0, -2.0], [0.0, -2.0]])
    for _ in range(_EPOCHS):
        p, pairs, first, _ = marginals(w.scores(f.weights), w.doc, f)
        err = np.repeat(y - p, w.slots.shape[1])
        grad = (np.bincount(flat[there], err[there], SLOTS) - 0.02 * f.weights).astype(np.float32)
        for k, (value, g) in enumerate(((f.weights, grad), (f.start, seen_first - first), (f.step, seen_pairs - pairs))):
            g2[k] += g * g
            value += 0.7 * g / np.sqrt(g2[k])
    p, _, _, _ = marginals(w.scores(f.weights), w.doc, f)
    x = _document_features(p, w.doc, len(texts))
    b = np.zeros(3)
    for _ in range(25):  # ridge logistic regression of the document's label
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + np.diag([0.05, 0.05, 0.05])
        b += np.linalg.solve(h, x.T @ (toxic - q) - 0.05 * b)
    f.document = b
    return f


def held_out(doc_id) -> F.Column:
    """True for documents that labels may never be learnt from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def training_sample(documents: DataFrame, labels: DataFrame, size: tuple[int, int] = SAMPLE) -> DataFrame:
    """doc_id, text, toxic: at most ``size`` whole texts of the clean and the toxic class, the first by a hash of doc_id, among rows that are not held out and no longer than LONGEST.

    A doc_id gives one text, whatever the rows that have it, so the sample is bounded.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= LONGEST)
    usable = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    ids = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size[c]) for c in (0, 1)]
    # the limits bound what is broadcast
    return texts.join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))


def _learn(batches):
    """The field of a whole sample, as its slots with a weight, these weights and the other numbers."""
    rows = sorted((toxic, doc_id, text) for b in batches for toxic, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("toxic", "doc_id", "text")), strict=True))
    f = fit([r[2] for r in rows], np.array([r[0] for r in rows], np.int64))
    slots = np.flatnonzero(f.weights)
    parts = (slots.astype("<i4"), f.weights[slots].astype("<f4"), np.concatenate((f.start, f.step.ravel(), f.document)).astype("<f8"))
    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["slots", "weights", "rest"])


def learnt(documents: DataFrame, labels: DataFrame) -> Field:
    """The field of the training sample, learnt by one task: the driver gets neither the texts nor what learning holds, only the weights."""
    got = training_sample(documents, labels).coalesce(1).mapInArrow(_learn, "slots binary, weights binary, rest binary").collect()
    if not got:  # no partition at all
        return fit([], np.zeros(0, np.int64))
    weights, rest = np.zeros(SLOTS, np.float32), np.frombuffer(got[0].rest, "<f8")
    weights[np.frombuffer(got[0].slots, "<i4")] = np.frombuffer(got[0].weights, "<f4")
    return Field(weights, rest[:2], rest[2:6].reshape(2, 2), rest[6:])


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, field: Field | None = None, carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_words, spans: every whole text scored; spans are byte offsets of toxic words in its UTF-8 form.

    Null and empty texts have no words and get the score of a text without toxic words. Rows without a doc_id are scored
    and not held out; repeated rows get the same score; without labels of both classes nothing is toxic. Extra columns are ignored, unless ``carry`` asks for each whole
    input row in a struct ``row``.
    """
    f = field or learnt(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(f)  # SLOTS weights, whatever the input

    def run(batches):
        field = shared.value
        for b in C.units(batches):
            w = Words(b.column("text"))
            n = b.num_rows
            p = marginals(w.scores(field.weights), w.doc, field)[0]
            score = 1 / (1 + np.exp(-np.clip(_document_features(p, w.doc, n) @ field.document, -30, 30)))
            hit = np.flatnonzero(p >= 0.5)
            base = w.off[w.doc[hit]]
            each = np.bincount(w.doc[hit], minlength=n)
            flat = pa.StructArray.from_arrays([pa.array((w.starts[hit] - base).astype(np.int32)), pa.array((w.ends[hit] - base).astype(np.int32))], ["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))).astype(np.int32)), flat)
            whole = [b.column("row")] if carry else []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array(each.astype(np.int64)), spans, *whole], names=["doc_id", "held_out", "score", "n_toxic_words", "spans", *["row"][: len(whole)]])

    row = [F.struct(*documents.columns).alias("row")] if carry else []
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text", *row)
    schema = "doc_id long, held_out boolean, score double, n_toxic_words long, spans array<struct<start:int,end:int>>"
    out = d.mapInArrow(run, T.StructType([*T.StructType.fromDDL(schema).fields, *d.schema.fields[3:]]))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).select("doc_id", "held_out", "score", "predicted", "n_toxic_words", "spans", *["row"][: len(row)])
