"""Packing documents into sequences by a grouping genetic algorithm on islands.

Pieces are dealt at random to cells of bounded size. In each cell several islands evolve packings that begin as best
fits in random orders: crossover injects whole well-filled bins of one parent into the other, removes the bins that hold
the same pieces again and best-fits the pieces displaced by that. Between epochs each island's elite moves to the next
island. Bins that waste too much, and some others, are dissolved and their pieces dealt anew to fewer cells, so what is
wasted does not grow with the cells; the least possible number of sequences for the total length is the aim.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C
from tidewake.llm import tokens

CAPACITY = 2048
CELL, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 10_000, 2, 2, 4, 8
#: Rounds of dealing; in the last round of one cell more generations are allowed.
ROUNDS, LAST_GENERATIONS = 4, 40
#: Besides half of the room that the least number of sequences leaves, full bins may waste this part of all tokens; one in SAND of them is dissolved too.
WASTE, SAND = 1e-5, 20
PIECES = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long"


class Bins:
    """A packing under construction: best fit by a bit set of the gaps that occur."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.gap, self.at, self.bits = capacity, [], [], {}, 0

    def _place(self, b: int) -> None:
        g = self.gap[b]
        self.at.setdefault(g, []).append(b)
        self.bits |= 1 << g

    def add_bin(self, items: list[int], fill: int) -> None:
        self.items.append(items)
        self.gap.append(self.capacity - fill)
        self._place(len(self.items) - 1)

    def best_fit(self, item: int, size: int) -> None:
        up = self.bits >> size
        if not up:
            self.add_bin([item], size)
            return
        g = size + (up & -up).bit_length() - 1
        b = self.at[g].pop()
        if not self.at[g]:
            self.bits ^= 1 << g
        self.items[b].append(item)
        self.gap[b] = g - size
        self._place(b)

    def fitness(self) -> tuple[int, int]:
        """Fewer bins first, then fuller ones."""
        return len(self.items), -sum((self.capacity - g) ** 2 for g in self.gap)


def packed(order: list[int], sizes: list[int], capacity: int) -> Bins:
    out = Bins(capacity)
    for i in order:
        out.best_fit(i, sizes[i])
    return out


def crossover(a: Bins, b: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Injects a run of b's fullest bins into a."""
    order = sorted(range(len(b.items)), key=lambda i: (b.gap[i], rng.random()))
    share = max(1, int(len(order) * rng.uniform(0.2, 0.8)))
    injected = order[:share]
    taken = {i for k in injected for i in b.items[k]}
    out = Bins(a.capacity)
    for k in injected:
        out.add_bin(list(b.items[k]), b.capacity - b.gap[k])
    displaced = []
    for items, gap in zip(a.items, a.gap, strict=True):
        if taken.isdisjoint(items):
            out.add_bin(list(items), a.capacity - gap)
        else:
            displaced += [i for i in items if i not in taken]
    return _refit(out, displaced, sizes)


def mutated(a: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Dissolves the worst bins and a few others."""
    n = len(a.items)
    worst = sorted(range(n), key=lambda i: -a.gap[i])
    gone = set(worst[: max(1, n // 50)]) | {rng.randrange(n) for _ in range(max(2, n // 50))}
    out = Bins(a.capacity)
    for k in range(n):
        if k not in gone:
            out.add_bin(list(a.items[k]), a.capacity - a.gap[k])
    return _refit(out, [i for k in gone for i in a.items[k]], sizes)


def _refit(out: Bins, displaced: list[int], sizes: list[int]) -> Bins:
    for i in sorted(displaced, key=lambda i: (-sizes[i], i)):
        out.best_fit(i, sizes[i])
    return out


def founder(sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Best fit of the pieces in a random order: bins of all kinds, and more of them than needed."""
    order = list(range(len(sizes)))
    rng.shuffle(order)
    return packed(order, sizes, capacity)


def evolve(sizes: list[int], founders: list[Bins], capacity: int, seed: int, population: int = POPULATION, generations: int = GENERATIONS) -> tuple[Bins, int]:
    """(best packing, generations that it took): founders in random orders unless given, then children by crossover.

    It ends at the least number of bins that the total size allows, or after ``generations`` generations.
    """
    rng = random.Random(seed)
    pool = list(founders)
    least = -(-sum(sizes) // capacity)
    while len(pool) < population:
        pool.append(founder(sizes, capacity, rng))
    pool.sort(key=Bins.fitness)
    made = 0
    while made < generations and len(pool[0].items) > least:
        made += 1
        children = []
        for _ in range(population):
            a, b = rng.sample(pool, 2) if len(pool) > 1 else (pool[0], pool[0])
            child = crossover(a, b, sizes, rng)
            children.append(mutated(child, sizes, rng) if rng.random() < 0.5 else child)
        pool = sorted([*pool, *children], key=Bins.fitness)[:population]
    return pool[0], made


def _founders(pdf: pd.DataFrame, column: str, capacity: int) -> Bins:
    out = Bins(capacity)
    sizes = pdf["length"].to_numpy()
    for _, rows in pd.Series(range(len(pdf))).groupby(pdf[column].to_numpy()):
        out.add_bin(rows.tolist(), int(sizes[rows].sum()))
    return out


def _round(items: DataFrame, cells: int, number: int, capacity: int, generations: int) -> DataFrame:
    """pid, length, sequence_id, offset, fill, generations of items (pid, length) packed cell by cell."""
    dealt = items.withColumn("cell", F.pmod(F.xxhash64("pid", F.lit(number)), F.lit(cells)).cast("int"))
    schema = "cell int, island int, pid long, length long, bin int, generations int"

    def epoch(e: int):
        def run(key, pdf):
            cell, island = (int(k) for k in key)
            guests = pdf["guest"].to_numpy()
            own = pdf[guests == 0].sort_values("pid").reset_index(drop=True)
            founders = []
            if e:
                founders = [_founders(own, "bin", capacity)]
                for g in sorted(set(guests) - {0}):
                    founders.append(_founders(pdf[guests == g].sort_values("pid").reset_index(drop=True), "bin", capacity))
            best, made = evolve(own["length"].tolist(), founders, capacity, seed=((number * 31 + cell) * 31 + island) * 31 + e, generations=generations)
            where = np.zeros(len(own), np.int32)
            for b, i in enumerate(best.items):
                where[i] = b
            return pd.DataFrame({"cell": np.int32(cell), "island": np.int32(island), "pid": own["pid"], "length": own["length"], "bin": where, "generations": own["generations"] + np.int32(made)})

        return run

    state = dealt.select("cell", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "pid", "length", F.lit(0).alias("bin"), F.lit(0).alias("generations"), F.lit(0).alias("guest"))
    for e in range(EPOCHS):
        evolved = state.groupBy("cell", "island").applyInPandas(epoch(e), schema)
        # the elite of each island also founds the next island's population
        state = evolved.select("cell", F.explode(F.array(F.struct("island", F.lit(0).alias("guest")), F.struct(((F.col("island") + 1) % ISLANDS).alias("island"), F.lit(1).alias("guest")))).alias("to"), "pid", "length", "bin", "generations").select("cell", "to.island", "pid", "length", "bin", "generations", "to.guest")

    def choose(key, pdf):
        (cell,) = key
        best = None
        for island, own in pdf.groupby("island"):
            fill = own.groupby("bin")["length"].sum()
            rank = (len(fill), -int((fill.astype("int64") ** 2).sum()), island)
            if best is None or rank < best[0]:
                best = rank, own
        own = best[1].sort_values(["bin", "pid"])
        by = own.groupby("bin")["length"]
        return pd.DataFrame({"pid": own["pid"], "length": own["length"], "sequence_id": (number << 56) + (int(cell) << 24) + own["bin"].astype("int64"), "offset": by.cumsum() - own["length"], "fill": by.transform("sum"), "generations": own["generations"]})

    return evolved.groupBy("cell").applyInPandas(choose, "pid long, length long, sequence_id long, offset long, fill long, generations int")


def pieces_of(documents: DataFrame, ranks: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece: ids of the whole text and the end id; only longer documents are cut, the first piece being the shorter one."""

    def run(batches):
        enc = tokens.rank_encoder(ranks)
        made = TaskContext.get().partitionId() << 36
        for b in C.units(batches):
            rows = []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = np.array([*enc.encode(t or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                at = 0
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    rows.append((made, d, piece, at, end - at, zlib.crc32(ids[at:end].tobytes())))
                    made, at = made + 1, end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names=["pid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def packing(documents: DataFrame, ranks: str | None = None, end_id: int = 0, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, generations: every piece of every document and its place.

    generations counts those that the piece's cell took for its packing (null: the piece fills a sequence). A null or
    empty text is the end id alone; strings of special tokens in a text count as such. Each input row is packed, also
    repeated ones and those without a doc_id; an empty table gives an empty result. Extra columns are ignored.
    """
    pieces = C.written(pieces_of(documents, ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), end_id, capacity), "pieces")
    nothing = F.lit(None).cast("int").alias("generations")
    places = pieces.where(F.col("length") == capacity).select("pid", (F.lit(1 << 62) + F.col("pid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), nothing)
    todo = pieces.where(F.col("length") < capacity).select("pid", "length")
    n, total = todo.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    least, spare, made = -(-total // capacity), -total % capacity, 0
    for number in range(1, ROUNDS + 1):
        cells = max(1, -(-n // cell))
        last = number == ROUNDS or cells == 1
        packed = C.written(_round(todo, cells, number, capacity, LAST_GENERATIONS if cells == 1 else GENERATIONS), "packed")
        # as many rows as there are gaps, whatever the input
        bins = sorted((capacity - r.fill, r.n) for r in packed.where("offset = 0").groupBy("fill").agg(F.count("*").alias("n")).collect())
        count = sum(b for _, b in bins)
        limit, waste = capacity, 0
        if not last and made + count > least:
            budget, limit = max(spare, 0) / 2 + total * WASTE, 0
            for gap, b in bins:
                waste += gap * b
                if waste > budget:
                    break
                limit = gap
        kept = F.lit(True) if limit == capacity else (F.col("fill") >= capacity - limit) & (F.pmod(F.xxhash64("sequence_id"), F.lit(SAND)) != 0)
        places = places.unionByName(packed.where(kept).select("pid", "sequence_id", "offset", "generations"))
        if limit == capacity:
            break
        full = packed.where(kept & (F.col("offset") == 0)).agg(F.count("*"), F.coalesce(F.sum(F.lit(capacity) - F.col("fill")), F.lit(0))).first()
        made, spare = made + full[0], spare - full[1]
        todo = packed.where(~kept).select("pid", "length")
        n = todo.count()
    return pieces.join(places, "pid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "generations")
