"""Token ids as range-coded blocks under an adaptive mix of order-0, order-1 and order-2 predictions.

Words of several ids that a chunk has OFTEN are symbols of their own, whose ids stand in the chunk's head; other ids are
their own symbols. Below, id means such a symbol. A block holds up to BLOCK of them, is coded from a reset model and
carries a checksum of the ids proper, so any block of a chunk decodes alone. Order 2 and order 1 predict the id that last followed the last two ids or the last id, each with a count
of how often it was right. Order 0 predicts from frequencies: a chunk's ids are sorted by their counts and cut into
CLASSES classes of about equal weight; how likely a class is adapts within the block, the counts of the chunk (in its
head) tell its ids apart. So each id is one of SYMBOLS outcomes (right by order 2, right by order 1, or its class), and
the probabilities of outcomes are mixed, by a weight that adapts, from two adaptive distributions: one under the
confidence and agreement of the two orders, one under the last id's class and the last outcome. All blocks of a chunk
are coded in step, one numpy lane each; integers only, so coder and decoder agree bit by bit.

A chunk is one row of the Parquet files: whole documents, their ids and counts, the id frequencies, block sizes,
checksums and words. Ids are any unsigned 32-bit integers.
"""

from __future__ import annotations

import zlib
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C
from tidewake.llm import tokens
from tidewake.llm.windows import pack, unpack

U64 = np.uint64
BLOCK = 2048
CHUNK = 6 << 20
#: Most blocks that are coded in step; a chunk has about as many, more where its last document is long.
LANES = 2048
MAGIC = b"TWCM0004"
CLASSES, SYMBOLS = 13, 15
#: A word of several ids is a symbol of its own if a chunk has it so often, and this many ids at most.
OFTEN, LONGEST = 3, 255
#: Slots of order 1 and order 2 in a block.
_T1, _T2 = 512, 1024
#: Probabilities of outcomes are parts of 2 ** _BITS (the last part is not used, so that weighted bounds fit 16 bits); a distribution moves by a part of 2 ** _FAST or 2 ** _SLOW.
_BITS, _FAST, _SLOW = 12, 5, 4
_ALL = (1 << _BITS) - 1
_LOW32, _TOP = U64(0xFFFFFFFF), U64(1) << U64(32)
ENCODED = "shard int, chunk int, start long, n_tokens long, payload binary"

_BOUND = np.arange(SYMBOLS + 1, dtype=np.int16)
_ROW = SYMBOLS + 1
_START = (_BOUND.astype(np.int64) * _ALL // SYMBOLS).astype(np.int16)
#: Where each outcome pulls the bounds: every gap stays 1 or more.
_PULL = np.stack([np.where(_BOUND <= s, _BOUND, _ALL - SYMBOLS + _BOUND) for s in range(SYMBOLS)]).astype(np.int16)
#: By 4 * right + confidence: whether a slot keeps its rank, and what its confidence gains.
_KEEPS = np.array([False, False, True, True, True, True, True, True])
_GAIN = np.array([0, 0, -1, -1, 1, 1, 1, 0], np.int32)


class Frequencies:
    """Order 0 of a chunk: its distinct ids from frequent to rare, their classes and their parts of a class."""

    def __init__(self, ids: np.ndarray, weight: np.ndarray):
        """ids and a positive weight of each, frequent ids first."""
        self.ids, self.weight = ids.astype(np.uint32), weight.astype(np.uint32)
        n = len(ids)
        w = self.weight.astype(np.int64)
        total = np.cumsum(w)
        whole = int(total[-1]) if n else 1
        self.cls = np.minimum((total - w) * CLASSES // whole, CLASSES - 1)
        sizes = np.bincount(self.cls, minlength=CLASSES)
        self.bits = max(16, int(sizes.max(initial=1)).bit_length() + 1)
        mass = np.maximum(np.bincount(self.cls, w, CLASSES).astype(np.int64), 1)
        spare = (1 << self.bits) - sizes
        part = 1 + w * spare[self.cls] // mass[self.cls]  # of each class at most 2 ** bits
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ends = np.cumsum(part)
        low = ends - part
        self.low, self.part = low - low[np.minimum(first, max(n - 1, 0))][self.cls] if n else low, part
        self.edge = (self.cls.astype(np.int64) << self.bits) + self.low
        self.table = None

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Frequencies, np.ndarray]:
        """The frequencies of a chunk and the rank of each of its ids."""
        if len(ids) and int(ids.max()) < 1 << 22:
            count = np.bincount(ids)
            values = np.flatnonzero(count)
            count = count[values]
            where = np.zeros(int(values[-1]) + 1, np.int32)
            inverse = None
        else:
            values, inverse, count = np.unique(ids, return_inverse=True, return_counts=True)
        # weights keep four significant bits, which shortens the head
        shift = np.maximum(np.frexp(count.astype(np.float64))[1] - 4, 0)
        weight = np.maximum(count >> shift, 1) << shift
        o = np.lexsort((values, -weight))
        rank = np.empty(len(o), np.int32)
        rank[o] = np.arange(len(o), dtype=np.int32)
        f = cls(values[o], weight[o])
        if inverse is not None:
            return f, rank[inverse]
        if len(ids):
            where[values] = rank
            return f, where[ids]
        return f, np.zeros(0, np.int32)

    def tobytes(self) -> bytes:
        """Runs of equal weight, and the steps between the ids of a run."""
        st = C.runs(self.weight)
        step = np.diff(self.ids.astype(np.int64), prepend=0)
        step[st] = self.ids[st]
        wide = np.flatnonzero(step >= 255)
        return pack(self.weight[st], np.diff(np.concatenate((st, [len(self.ids)]))).astype(np.uint32), np.minimum(step, 255).astype(np.uint8), step[wide].astype(np.uint32))

    @classmethod
    def frombytes(cls, raw: bytes) -> Frequencies:
        weight, length, step, wide = unpack(raw, np.uint32, np.uint32, np.uint8, np.uint32)
        step = step.astype(np.int64)
        step[step == 255] = wide
        st = (np.cumsum(length.astype(np.int64)) - length).astype(np.int64)
        total = np.cumsum(step)
        if len(step):
            total = total - np.repeat(total[st] - step[st], length)
        return cls(total, np.repeat(weight, length))

    def find(self, cls: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Ranks of the ids of class ``cls`` whose part holds ``value``."""
        at = (cls << self.bits) + value
        if self.bits > 18:
            return np.searchsorted(self.edge, at, "right") - 1
        if self.table is None:
            mark = np.zeros(CLASSES << self.bits, np.int32)
            mark[self.edge[1:]] = 1
            self.table = np.cumsum(mark, dtype=np.int32)
        return self.table.take(at, mode="clip")


class _Model:
    """Predicted ranks and mixed distributions of all lanes. A slot holds a rank and, in its low two bits, its confidence."""

    def __init__(self, lanes: int, freq: Frequencies):
        i = np.arange(lanes, dtype=np.int64)
        self.t1, self.t2 = np.full(lanes * _T1, -4, np.int32), np.full(lanes * _T2, -4, np.int32)
        self.o1, self.o2, self.row = i * _T1, i * _T2, i * _ROW
        self.a = np.tile(_START, (lanes * 32, 1))
        self.b = np.tile(_START, (lanes * 256, 1))
        self.oa, self.ob = i * 32, i * 256
        self.w = np.full(lanes, 8, np.int16)
        self.p1, self.near, self.far = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.context = np.zeros(lanes, np.int64)
        self.cls = freq.cls

    def shrink(self, n: int) -> None:
        """Only the first n lanes go on."""
        for k in ("o1", "o2", "oa", "ob", "row", "w", "p1", "near", "far", "context"):
            setattr(self, k, getattr(self, k)[:n])

    def predict(self) -> np.ndarray:
        """Bounds of the outcomes per lane; sets the ranks predicted by both orders (-1: none)."""
        self.i1 = (self.near >> 11 & (_T1 - 1)) + self.o1
        self.i2 = (self.near + self.far >> 9 & (_T2 - 1)) + self.o2
        self.s1, self.s2 = self.t1.take(self.i1, mode="clip"), self.t2.take(self.i2, mode="clip")
        self.c1, self.c2, self.q1, self.q2 = self.s1 & 3, self.s2 & 3, self.s1 >> 2, self.s2 >> 2
        self.ia = self.oa + ((self.c2 << 3) + (self.c1 << 1) + (self.q1 == self.q2))
        self.ib = self.ob + self.context
        self.ca, self.cb = self.a.take(self.ia, axis=0, mode="clip"), self.b.take(self.ib, axis=0, mode="clip")
        w = self.w.view(np.uint16)[:, None]
        return self.ca.view(np.uint16) * w + self.cb.view(np.uint16) * (np.uint16(16) - w) >> np.uint16(4)

    def update(self, rank: np.ndarray, out: np.ndarray, at: np.ndarray) -> None:
        """at: where the lower bound of each lane's outcome is."""
        pull = _PULL.take(out, axis=0, mode="clip")
        self.a[self.ia] = self.ca + (pull - self.ca >> _FAST)
        self.b[self.ib] = self.cb + (pull - self.cb >> _SLOW)
        ca, cb = self.ca.ravel(), self.cb.ravel()
        gain = ca.take(at + 1, mode="clip") - ca.take(at, mode="clip") - cb.take(at + 1, mode="clip") + cb.take(at, mode="clip")
        self.w = np.minimum(np.maximum(self.w + np.sign(gain), 1), 15)
        new = rank << 2
        for table, i, s, q, c in ((self.t1, self.i1, self.s1, self.q1, self.c1), (self.t2, self.i2, self.s2, self.q2, self.c2)):
            case = ((q == rank).view(np.int8) << 2) + c
            table[i] = np.where(_KEEPS.take(case, mode="clip"), s + _GAIN.take(case, mode="clip"), new)
        self.context = (self.cls.take(rank, mode="clip") << 4) + out
        self.far = self.p1 * 0x3D4D51
        self.p1 = rank.astype(np.int64)
        self.near = self.p1 * 0x9E3779B1


def _lanes(n: int) -> np.ndarray:
    """Sizes of the blocks of n ids: all full but perhaps the last."""
    return np.full(-(-n // BLOCK), BLOCK) if n % BLOCK == 0 else np.concatenate((np.full(n // BLOCK, BLOCK), [n % BLOCK]))


def _groups(n: int) -> list[tuple[int, int]]:
    """Ranges of blocks that are coded in step, so that memory does not grow with a chunk."""
    return [(x, min(x + LANES, n)) for x in range(0, n, LANES)]


def _laid(numbers: np.ndarray, flat: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The entries off[i] to off[i + 1] of flat, for each i of numbers in a row; a part at a time, which bounds what is held besides."""
    parts = [flat[:0]]
    for x in range(0, len(numbers), 1 << 17):
        i = numbers[x : x + (1 << 17)]
        n = off[i + 1] - off[i]
        at = np.arange(int(n.sum()))
        at += np.repeat(off[i] - (np.cumsum(n) - n), n)
        parts.append(flat[at])
    return np.concatenate(parts)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def encode_blocks(ids: np.ndarray, words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(head, words per block, checksum per block, all 32-bit words).

    ``words`` may tell of which words the ids are made: their numbers in a row, the ids of all numbers and where those of
    each number begin. Words that are frequent here become symbols.
    """
    ids = ids.astype(np.uint32)
    symbols, sizes, phrases, base = ids, None, np.zeros(0, np.int64), 0
    if words is not None and len(ids):
        numbers, flat, off = words
        size = off[1:] - off[:-1]
        count = np.bincount(numbers, minlength=len(size))
        phrases = np.flatnonzero((count >= OFTEN) & (size > 1) & (size <= LONGEST))
        phrases = phrases[np.argsort(-count[phrases], kind="stable")]
        base = int(ids.max()) + 1
        if base + len(phrases) > 2**32:
            phrases = phrases[:0]
    if len(phrases):
        own = size.copy()
        own[phrases] = 1
        own_off = _offsets(own)
        keep = np.ones(len(size), bool)
        keep[phrases] = False
        own_flat = np.empty(int(own_off[-1]), np.uint32)
        own_flat[np.repeat(keep, own)] = flat[np.repeat(keep, size)]
        own_flat[own_off[phrases]] = np.arange(base, base + len(phrases), dtype=np.int64)
        symbols = _laid(numbers, own_flat, own_off)
        sizes = np.concatenate((np.ones(1, np.int64), size[phrases]))[np.maximum(symbols.astype(np.int64) - (base - 1), 0)]
    lanes = _lanes(len(symbols))
    ends = np.cumsum(lanes)
    at = _offsets(lanes) if sizes is None else _offsets(sizes)[np.concatenate(([0], ends))]
    freq, rank = Frequencies.of(symbols)
    parts = [_encode(rank[x * BLOCK : y * BLOCK], lanes[x:y], freq) for x, y in _groups(len(lanes))]
    used, coded = zip(*parts, strict=True) if parts else ([], [])
    head = freq.tobytes()
    told = pack(size[phrases].astype(np.uint8), _laid(phrases, flat, off).astype(np.uint32)) if len(phrases) else b""
    head = np.array([len(symbols), base, len(head)], "<i8").tobytes() + head + told
    return head, np.concatenate([np.zeros(0, np.uint32), *used]), _sums(ids, at), np.concatenate([np.zeros(0, np.uint32), *coded])


def _sums(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Checksums of the ids between the places ``at``."""
    raw = memoryview(ids.astype("<u4").tobytes())
    return np.array([zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.uint32)


def _encode(rank: np.ndarray, sizes: np.ndarray, freq: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """(words per block, all words) of the blocks of one group."""
    lanes = len(sizes)
    steps_n = int(sizes[0])
    grid = np.zeros((lanes, steps_n), np.int32)
    grid.ravel()[: len(rank)] = rank
    steps = np.ascontiguousarray(grid.T)
    m = _Model(lanes, freq)
    lo, rg = np.zeros(lanes, U64), np.full(lanes, 2**64 - 1, U64)
    low = np.zeros(lanes, U64)
    width = steps_n // 2 + 16
    words, used = np.zeros((lanes, width), np.uint32), np.zeros(lanes, np.int64)
    flat, row = words.ravel(), np.arange(lanes) * width
    n = lanes
    inner_low, inner_part, bits = freq.low.astype(U64), freq.part.astype(U64), U64(freq.bits)
    whole = U64(1 << freq.bits)
    for t in range(steps_n):
        if t == sizes[-1] and lanes > 1:  # the short last block has ended
            n = lanes - 1
            low[n] = lo[n]
            lo, rg = lo[:n], rg[:n]
            m.shrink(n)
        x = steps[t, :n]
        c = m.predict()
        out = m.cls.take(x, mode="clip") + 2
        out[x == m.q1] = 1
        out[x == m.q2] = 0
        at = m.row + out
        flat_c = c.ravel()
        under = flat_c.take(at, mode="clip").astype(U64)
        r = rg >> U64(_BITS)
        lo = lo + under * r
        rg = (flat_c.take(at + 1, mode="clip") - under) * r
        plain = out < 2
        r = rg >> bits
        lo += np.where(plain, U64(0), inner_low.take(x, mode="clip")) * r
        rg = np.where(plain, whole, inner_part.take(x, mode="clip")) * r
        m.update(x, out, at)
        k = np.flatnonzero(rg < _TOP)
        while len(k):
            a, g = lo.take(k, mode="clip"), rg.take(k, mode="clip")
            top = a >> U64(32)
            split = top != (a + (g - U64(1))) >> U64(32)
            if split.any():
                g = np.where(split, _TOP - (a & _LOW32), g)
            place = used.take(k, mode="clip")
            flat[row.take(k, mode="clip") + place] = top
            used[k] = place + 1
            g = g << U64(32)
            lo[k], rg[k] = a << U64(32), g
            if int(place.max()) + 6 > width:
                words = np.concatenate((words, np.zeros((lanes, BLOCK // 4), np.uint32)), 1)
                width = words.shape[1]
                flat, row = words.ravel(), np.arange(lanes) * width
            k = k[g < _TOP]
    low[:n] = lo
    lane = np.arange(lanes)
    words[lane, used] = (low >> U64(32)).astype(np.uint32)
    words[lane, used + 1] = (low & _LOW32).astype(np.uint32)
    used += 2
    return used.astype(np.uint32), words[np.arange(width) < used[:, None]]


def decode_blocks(n: int, head: bytes, used: np.ndarray, crc: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ids; ValueError if a block's checksum does not hold."""
    m, base, h = np.frombuffer(head, "<i8", 3).tolist()
    sizes = _lanes(m)
    freq = Frequencies.frombytes(head[24 : 24 + h])
    at = _offsets(used)
    parts = [_decode(sizes[x:y], at[x:y] - at[x], words[at[x] : at[y]], freq) for x, y in _groups(len(sizes))]
    rank = np.concatenate([np.zeros(0, np.int32), *parts])
    edges = _offsets(sizes)
    if len(head) > 24 + h:
        length, told = unpack(head[24 + h :], np.uint8, np.uint32)
        one = freq.ids < base
        phrase = np.where(one, 0, freq.ids.astype(np.int64) - base)
        size = np.where(one, 1, length.astype(np.int64)[phrase])
        off = _offsets(size)
        flat = np.empty(int(off[-1]), np.uint32)
        flat[off[:-1][one]] = freq.ids[one]
        flat[np.repeat(~one, size)] = _laid(phrase[~one], told, _offsets(length))
        edges = _offsets(size[rank])[edges]
        ids = _laid(rank, flat, off)
    else:
        ids = freq.ids.take(rank, mode="clip") if m else np.zeros(0, np.uint32)
    bad = np.flatnonzero(_sums(ids, edges) != crc)
    if len(bad) or len(ids) != n:
        raise ValueError(f"block {bad[0] if len(bad) else 0}: checksum does not hold")
    return ids


def _decode(sizes: np.ndarray, at: np.ndarray, words: np.ndarray, freq: Frequencies) -> np.ndarray:
    """The ranks of the blocks of one group, whose words begin at ``at``."""
    lanes = len(sizes)
    words = np.concatenate((words, np.zeros(4, np.uint32))).astype(U64)
    m = _Model(lanes, freq)
    cd, rg = words.take(at, mode="clip") << U64(32) | words.take(at + 1, mode="clip"), np.full(lanes, 2**64 - 1, U64)
    lo = np.zeros(lanes, U64)
    at = at + 2
    steps = np.zeros((int(sizes[0]), lanes), np.int32)
    k = lanes
    inner_low, inner_part, bits = freq.low.astype(U64), freq.part.astype(U64), U64(freq.bits)
    whole = U64(1 << freq.bits)
    last = np.int64((1 << freq.bits) - 1)
    for t in range(int(sizes[0])):
        if t == sizes[-1] and lanes > 1:
            k = lanes - 1
            m.shrink(k)
            lo, cd, rg = lo[:k], cd[:k], rg[:k]
        c = m.predict()
        r = rg >> U64(_BITS)
        d = np.minimum((cd - lo) // r, U64(_ALL - 1)).astype(np.uint16)
        out = np.bitwise_count((c <= d[:, None]).view(U64)).sum(1).astype(np.int64) - 1
        where = m.row + out
        flat_c = c.ravel()
        under = flat_c.take(where, mode="clip").astype(U64)
        lo = lo + under * r
        rg = (flat_c.take(where + 1, mode="clip") - under) * r
        r = rg >> bits
        plain = out < 2
        value = np.minimum(((cd - lo) // r).astype(np.int64), last)
        x = freq.find(np.maximum(out - 2, 0), value).astype(np.int32)
        x = np.where(plain, np.where(out == 0, m.q2, m.q1), x)
        x = np.minimum(np.maximum(x, 0), len(freq.ids) - 1)  # only in damaged blocks
        lo += np.where(plain, U64(0), inner_low.take(x, mode="clip")) * r
        rg = np.where(plain, whole, inner_part.take(x, mode="clip")) * r
        steps[t, :k] = x
        m.update(x, out, where)
        j = np.flatnonzero(rg < _TOP)
        while len(j):
            a, g = lo.take(j, mode="clip"), rg.take(j, mode="clip")
            split = a >> U64(32) != (a + (g - U64(1))) >> U64(32)
            if split.any():
                g = np.where(split, _TOP - (a & _LOW32), g)
            place = at.take(j, mode="clip")
            cd[j] = cd.take(j, mode="clip") << U64(32) | words.take(place, mode="clip")
            at[j] = place + 1
            g = g << U64(32)
            lo[j], rg[j] = a << U64(32), g
            j = j[g < _TOP]
    flat = np.ascontiguousarray(steps.T)
    return flat.ravel()[: int(sizes.sum())]


def encode_chunk(docs: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray, made_of: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> bytes:
    """A chunk of whole documents; ``known`` is false for documents without an id, ``made_of`` tells the words of the ids."""
    freq, used, crc, words = encode_blocks(ids, made_of)
    head = np.array([len(docs), len(ids), len(used), len(freq)], "<i8").tobytes()
    return MAGIC + head + docs.astype("<i8").tobytes() + known.astype(np.uint8).tobytes() + counts.astype("<i8").tobytes() + freq + used.astype("<u4").tobytes() + crc.astype("<u4").tobytes() + words.astype("<u4").tobytes()


def decode_chunk(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(documents, known, counts, ids)."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token chunk")
    d, n, b, h = np.frombuffer(raw, "<i8", 4, 8).tolist()
    at, out = 40, []
    for kind, m in (("<i8", d), ("u1", d), ("<i8", d), ("S1", h), ("<u4", b), ("<u4", b)):
        out.append(raw[at : at + m] if kind == "S1" else np.frombuffer(raw, kind, m, at))
        at += m * np.dtype(kind).itemsize
    docs, known, counts, freq, used, crc = out
    return docs, known.astype(bool), counts, decode_blocks(n, freq, used, crc, np.frombuffer(raw, "<u4", -1, at))


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int, shards: int) -> DataFrame:
    """Chunks of all documents in ascending doc_id order: shard by range of ids, chunks in order inside."""

    def run(batches):
        shard, made, start, total = TaskContext.get().partitionId(), 0, 0, 0
        docs: list = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        enc = tokens.word_encoder(tokenizer)
        if len(enc.coded) > enc.limit:  # of earlier tasks
            enc.forget(np.zeros(0, bool))
        length = np.zeros(0, np.int64)  # ids of each word

        def flush():
            nonlocal made, start, total, docs, held, sizes, length
            numbers, words = np.concatenate(held), np.concatenate(sizes)
            flat, off = np.frombuffer(b"".join(enc.coded), "<u4"), _offsets(length)
            counts = np.add.reduceat(length[numbers], _offsets(words)[:-1])
            ids = _laid(numbers, flat, off)
            raw = encode_chunk(np.array([0 if d is None else d for d in docs], np.int64), np.array([d is not None for d in docs]), counts, ids, (numbers, flat, off))
            row = pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([made], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([raw], pa.binary())], names=["shard", "chunk", "start", "n_tokens", "payload"])
            made, start, total, docs, held, sizes = made + 1, start + len(ids), 0, [], [], []
            if len(enc.coded) > enc.limit:
                enc.forget(np.bincount(numbers, minlength=len(enc.coded)) > 1)
                length = np.zeros(0, np.int64)
            return row

        for b in C.units(batches):
            numbers, words = enc.numbers([t or "" for t in b.column("text").to_pylist()], end_id)
            length = np.concatenate((length, np.fromiter(map(len, islice(enc.coded, len(length), None)), np.int64) // 4))
            docs += b.column("doc_id").to_pylist()
            held.append(numbers)
            sizes.append(words)
            total += int(length[numbers].sum())
            if total >= CHUNK:
                yield flush()
        if docs:
            yield flush()

    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, ENCODED)


def read_documents(chunks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document, from encoded chunks.

    Only one total per shard (as many as the writing job had partitions) reaches the driver.
    """
    spark = chunks.sparkSession
    totals = sorted((r.shard, r.n) for r in chunks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, at = [], 0
    for shard, n in totals:
        before.append((shard, at))
        at += n
    bases = spark.createDataFrame(before, "shard int, base long")

    def run(batches):
        for b in batches:
            for shard, start, raw in zip(b.column("shard").to_pylist(), b.column("first").to_pylist(), b.column("payload"), strict=True):
                docs, known, counts, ids = decode_chunk(raw.as_py())
                ends = np.cumsum(counts)
                flat = ids.astype("<u4").tobytes()
                for at in range(0, len(docs), 2000):
                    cut = range(at, min(at + 2000, len(docs)))
                    own = [flat[4 * int(ends[i] - counts[i]) : 4 * int(ends[i])] for i in cut]
                    yield pa.RecordBatch.from_arrays([pa.array([int(docs[i]) if known[i] else None for i in cut], pa.int64()), pa.array([start + int(ends[i] - counts[i]) for i in cut], pa.int64()), pa.array(counts[cut.start : cut.stop]), pa.array([zlib.crc32(x) for x in own], pa.int64()), pa.array(own, pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    placed = chunks.join(F.broadcast(bases), "shard").select("shard", (F.col("start") + F.col("base")).alias("first"), "payload")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_codec(documents: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes the ids of every whole text, each with ``end_id`` appended, as coded chunks and reads them back.

    A null or empty text is the end id alone. Strings of special tokens in a text count as such, as in a plain call of
    the library. Rows without a doc_id come first; repeated rows are each written. Ids may be any unsigned 32-bit
    integers. Extra columns are ignored; an empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return read_documents(C.written(encode_documents(documents, path, end_id, C.partitions(documents.sparkSession)), "tokens"))
