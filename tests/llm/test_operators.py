"""The corpus operators against brute force on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewake.llm import common, decontamination, line_dedup, ngram_join, packing, queries, suffix_dedup, token_codec, toxicity, url_filter, windows
from tidewake.llm.embedding_join import embedding_join
from tidewake.llm.substring_dedup import substring_dedup
from tidewake.llm.tokens import rank_encoder, word_encoder

DOC = "doc_id long, text string, lang string, source string, n_chars long, th string, places int, copy string, n int, set string"


def sentence(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(1, 7))) for _ in range(n))


def texts() -> list[tuple]:
    base, shared = sentence(1, 120), sentence(2, 60)
    edited = base.split()
    edited[60] = "changed"
    long = " ".join(sentence(i, 200) for i in range(100, 160))
    out = {
        0: base, 1: base, 2: " ".join(edited), 3: f"{sentence(3, 30)} {shared} {sentence(4, 25)}", 4: f"{sentence(5, 10)}\t{shared}\n{sentence(6, 12)}",
        5: None, 6: "", 7: " \n\t ", 8: "one two three", 9: "ONE two Three", 10: "x y " * 60, 11: "y x " * 50, 12: long, 13: long[: len(long) // 2],
        14: " é\x1f b  c\r\nd", 15: "a" * 500, 16: "b" + "a" * 300,
    }
    rows = [(k, v, "en", "s", len(v or ""), "clash", 1, "clash", 2, "clash") for k, v in out.items()]
    return [*rows, rows[0], (None, base, "en", "s", 1, "x", 1, "x", 2, "x"), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), DOC).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def known() -> dict[int, str | None]:
    return {r[0]: r[1] for r in texts() if r[0] is not None}


def split(text) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def removed(seq_of: dict, n: int) -> dict[int, list[bool]]:
    first: dict = {}
    for d in sorted(seq_of):
        s = seq_of[d]
        for i in range(len(s) - n + 1):
            first.setdefault(tuple(s[i : i + n]), d)
    out = {}
    for d, s in seq_of.items():
        gone = [False] * len(s)
        for i in range(len(s) - n + 1):
            if first[tuple(s[i : i + n])] < d:
                gone[i : i + n] = [True] * n
        out[d] = gone
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 13])
def test_substring_dedup(docs, n):
    words = {d: split(t) for d, t in known().items()}
    want = {d: (len(words[d]), sum(g), " ".join(w for w, x in zip(words[d], g) if not x)) for d, g in removed(words, n).items()}
    rows = substring_dedup(docs, n).collect()
    assert len(rows) == len(texts())
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id]
            assert r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()


@pytest.mark.parametrize("n", [30, 50])
def test_suffix_dedup(docs, n):
    raw = {d: (t or "").encode() for d, t in known().items()}
    want = {}
    for d, g in removed(raw, n).items():
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        want[d] = len(raw[d]), sum(g), spans, bytes(b for b, x in zip(raw[d], g) if not x)
    rows = suffix_dedup.suffix_dedup(docs, n).collect()
    assert len(rows) == len(texts())
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id]


@pytest.mark.parametrize("run", [substring_dedup, suffix_dedup.suffix_dedup])
def test_passage_first_in_a_text_whose_copy_is_beside_the_sharer(spark, run):
    passage = sentence(201, 40)
    first, sharer = f"{sentence(202, 30)} {passage}", f"{sentence(203, 20)} {passage}"
    df = spark.createDataFrame(spark.sparkContext.parallelize([(1, first), (100, first), (101, sharer)], 2), "doc_id long, text string")
    assert [len(p) for p in df.rdd.glom().collect()] == [1, 2]
    kept = {r.doc_id: bytes(r.kept).decode() if isinstance(r.kept, (bytes, bytearray)) else r.kept for r in run(df).collect()}
    assert kept[1] == first and kept[100] == "" and kept[101].strip() == sentence(203, 20)


@pytest.mark.parametrize(("run", "n", "cut"), [(substring_dedup, 13, split), (suffix_dedup.suffix_dedup, 50, str.encode)])
def test_blocks_that_come_back_do_not_grow_with_the_tasks_that_ask(spark, monkeypatch, run, n, cut):
    passage = sentence(210, 40)
    rows = [(10 * i + k, f"{sentence(1000 + 10 * i + k, 8)} {passage}") for i in range(24) for k in range(10)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 24), "doc_id long, text string")
    frames, whole = [], windows.exchange
    monkeypatch.setattr(windows, "exchange", lambda *a, **k: frames.append(whole(*a, **k)) or frames[-1])
    want = {d: sum(g) for d, g in removed({d: cut(t) for d, t in rows}, n).items()}
    assert {r.doc_id: r.n_removed for r in run(df).collect()} == want and all(want[d] > 0 for d in want if d)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    settled = [f.count() for f in frames if f.columns == ["bucket", "kind", "payload"]]
    assert settled and max(settled) <= buckets * buckets


def test_results_come_back_to_partitions_that_exist():
    rng = np.random.default_rng(7)
    docs = rng.integers(-(2**63), 2**63 - 1, 5000)
    for buckets in (1, 2, 51, 211, 256, 257, 600, 1023, 1024, 1025, 3000):
        least, kept = windows.back(buckets), {}
        for asking in (False, True):
            for bucket, kind, payload in windows.result_blocks([(docs[:3000], np.arange(3000)), (docs[3000:], np.arange(3000, 5000))], buckets, asking):
                assert kind == windows.KNOWN and 0 <= bucket < (buckets if asking else least)
                d, pos = windows.unpack(payload, np.int64, np.uint32)
                assert (docs[pos] == d).all()
                kept.setdefault(asking, []).extend(pos.tolist())
        assert sorted(kept[False]) == sorted(kept[True]) == list(range(5000))


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
@pytest.mark.parametrize("depth", [3, 8, 13])
def test_merged_transforms_give_the_suffix_order(kind, depth):
    rng = np.random.default_rng(0)
    pieces = [bytes(rng.integers(0, 2, rng.integers(1, 40), dtype=np.uint8)) for _ in range(60)]
    text = np.concatenate([np.concatenate((np.frombuffer(p, np.uint8) + 1, [0])) for p in pieces]).astype(kind)
    for shard in (20, 100, 10_000):
        place, block, lcp = suffix_dedup.repeated_intervals(text, depth, shard)
        assert sorted(place.tolist()) == list(range(len(text)))
        tail = [bytes(text[p : p + depth].astype(np.uint8).tolist()).split(b"\0")[0] for p in place]
        assert tail == sorted(tail)
        for i in range(1, len(place)):
            same = tail[i] == tail[i - 1] and len(tail[i]) == depth
            assert same == (block[i] == block[i - 1])
            common = next((k for k, (x, y) in enumerate(zip(tail[i], tail[i - 1])) if x != y), min(len(tail[i]), len(tail[i - 1])))
            assert lcp[i] == common


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (2, 50), (5, 80)])
def test_ngram_join(docs, size, percent):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in known().items():
        w = split((t or "").translate(fold))
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    for _ in sets:
        for a, b in itertools.combinations(sorted(sets), 2):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[a] = root[b] = min(root[a], root[b])
    rows = ngram_join.ngram_join(docs, size, percent).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert r.doc_id is None or (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])


def test_ngram_join_of_a_large_group(spark):
    """Many near copies whose links form chains: the star round alone cannot connect them."""
    base = sentence(7, 80).split()
    rows = []
    for i in range(40):
        w = list(base)
        for k in range(i, i + 3):
            w[k * 2 % 80] = f"edit{i}x{k}"
        rows.append((i, " ".join(w)))
    sets = {d: {tuple(t.split()[i : i + 4]) for i in range(77)} for d, t in rows}
    root = {d: d for d in sets}
    for _ in range(5):
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 60 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 60).collect()}
    assert got == root


def test_embedding_join(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        v = rng.normal(size=8) if i % 3 else np.array([1.0] * 8) + rng.normal(size=8) * rng.choice([0.02, 0.3])
        rows.append((i, [float(x) for x in v], i % 2))
    rows += [(300 + i, rows[0][1], 0) for i in range(20)]
    rows += [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] * 8, 0), (403, [1.0, None], 0), (404, [float("inf")] * 8, 0), (405, rows[0][1], None), (406, [], 0), (407, [2.0] * 9, 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, key string")
    ok = [(r[0], np.array(r[1], np.float32).astype(float), r[2]) for r in rows if r[0] < 400 or r[0] == 407]
    root, links = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}
    pairs = [(a, b) for (a, x, p), (b, y, q) in itertools.combinations(ok, 2) if p == q and len(x) == len(y) and x @ y >= 0.98 * np.linalg.norm(x) * np.linalg.norm(y)]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    for _ in range(10):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert len(pairs) > 100
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join(df).collect()}
    assert got == {v: (links[v], root[v], root[v] == v) for v in root}


def test_embedding_join_of_extreme_and_repeated_vectors(spark):
    rng = np.random.default_rng(4)
    base = [rng.normal(size=6) for _ in range(40)]
    rows = [(i * 4 + k, (v * m * (1 + (k == 3) * rng.normal(size=6) * 0.01)).tolist(), i % 3) for i, v in enumerate(base) for k, m in enumerate((1.0, 1e200, 1e-200, 1e300))]
    rows += [(500, [5e-324, 0.0, 0.0, 0.0, 0.0, 0.0], 0), (501, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0), (502, [1.7e308] * 6, 0), (503, [1.0] * 6, 0)]
    unit = {i: np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) for i, v, _ in rows}
    links, root, label = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}, {r[0]: r[2] for r in rows}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(unit), 2) if label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
    for a, b in pairs:
        links[a], links[b] = links[a] + 1, links[b] + 1
    for _ in range(4):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join(df).collect()}
    assert got == {v: (links[v], root[v]) for v in unit} and len(pairs) >= 240


def test_token_codec(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = token_codec.token_codec(docs).collect()
    assert len(rows) == len(texts())
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        if r.doc_id is not None:
            want = [*t.encode(known()[r.doc_id] or "", add_special_tokens=False).ids, 2]
            assert np.frombuffer(r.ids, "<u4").tolist() == want
            assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order)


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 20_000])
@pytest.mark.parametrize("kind", ["random", "same", "skewed", "wide"])
def test_codec_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"random": rng.integers(0, 65536, n), "same": np.full(n, 7), "skewed": (rng.zipf(1.3, n) * 977) % 49408, "wide": rng.integers(0, 2**32, n)}[kind].astype(np.uint32)
    head, used, crc, words = token_codec.encode_blocks(ids)
    assert np.array_equal(token_codec.decode_blocks(n, head, used, crc, words), ids)
    if kind == "same" and n == 20_000:
        assert words.nbytes < n // 16
    if n > 1:
        with pytest.raises(ValueError, match="checksum"):
            token_codec.decode_blocks(n, head, used, crc ^ np.uint32(1), words)


def test_codec_needs_fewer_bits_than_the_frequencies_of_the_ids(spark):
    enc = word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    ids = np.frombuffer(b"".join(enc.encode(texts)), "<u4")
    p = np.bincount(ids) / len(ids)
    p = p[p > 0]
    head, used, _, words = token_codec.encode_blocks(ids)
    assert 8 * (len(head) + 8 * len(used) + words.nbytes) < -(p * np.log2(p)).sum() * len(ids)


def test_frequent_words_are_coded_as_one_symbol():
    rng = np.random.default_rng(3)
    for top in (60_000, 2**32 - 1):
        sizes = np.array([0, 1, 2, 3, 7, 255, 256, *rng.integers(1, 6, 500)])
        off = np.concatenate(([0], np.cumsum(sizes)))
        flat = rng.integers(0, top, off[-1], endpoint=True).astype(np.uint32)
        flat[0] = top
        numbers = np.concatenate((np.arange(len(sizes)), np.minimum(rng.zipf(1.2, 20_000), len(sizes) - 1))).astype(np.int32)
        ids = np.concatenate([flat[off[i] : off[i + 1]] for i in numbers])
        head, used, crc, words = token_codec.encode_blocks(ids, (numbers, flat, off))
        assert np.array_equal(token_codec.decode_blocks(len(ids), head, used, crc, words), ids)
        if top == 60_000:
            assert len(used) < len(token_codec.encode_blocks(ids)[1]) / 1.5
            with pytest.raises(ValueError, match="checksum"):
                token_codec.decode_blocks(len(ids), head, used, crc, words ^ np.uint32(1 << 30))


def test_new_words_are_made_of_known_pieces_and_forgotten_words_come_back():
    from tidewake.llm.tokens import WordEncoder

    enc = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), limit=20)
    whole = enc.tokenizer
    enc.encode(["tree house 's ,"])

    class Refuse:
        def encode_batch_fast(self, *_, **__):
            raise AssertionError("known pieces")

    enc.tokenizer = Refuse()
    assert np.frombuffer(enc.encode(["Tree, HOUSE,tree's"])[0], "<u4").tolist() == whole.encode("Tree, HOUSE,tree's", add_special_tokens=False).ids
    enc.tokenizer = whole
    for i in range(30):
        x = " ".join(f"w{i}{j} x{j}, Ñandú{j} \u00a0y{j}" for j in range(9))
        assert np.frombuffer(enc.encode([x])[0], "<u4").tolist() == whole.encode(x, add_special_tokens=False).ids
    assert len(enc.coded) < 100 and len(enc.coded) == len(enc.number)


def test_rank_file_gives_the_ids_of_the_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = rank_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for x in [*(v or "" for v in known().values()), "it's <|endoftext|>  ok\n\n 　x", "日本語 text 12345", "\x00\x85\x1c a", "é \U0001f600!"]:
        assert enc.encode(x) == t.encode(x, add_special_tokens=False).ids


def test_word_cache_gives_the_ids_of_whole_texts():
    enc = word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    for x in ["It's  a b\tC\r\nd", "İ ΣΣ straße", "<|endoftext|> x1y22", "e ́x", ""]:
        assert np.frombuffer(enc.encode([x])[0], "<u4").tolist() == enc.tokenizer.encode(x, add_special_tokens=False).ids


def test_packing(docs):
    rows = packing.packing(docs, capacity=256).toPandas()
    enc = rank_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for d, own in rows[rows.doc_id.notna()].groupby("doc_id"):
        ids = [*enc.encode(known()[int(d)] or ""), 0]
        own = own.sort_values("piece").drop_duplicates("piece")
        assert own.length.sum() == len(ids) and (own.length[1:] == 256).all() and own.piece.tolist() == list(range(len(own)))
        for p in own.itertuples():
            assert zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
    total = rows.groupby("sequence_id").length.sum()
    assert total.max() <= 256 and len(total) <= -(-rows.length.sum() // 256) + 2
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]


def test_crossover_keeps_every_item_once():
    import random

    rng = random.Random(5)
    sizes = [rng.randint(1, 100) for _ in range(200)]
    a = packing.packed(sorted(range(200), key=lambda i: -sizes[i]), sizes, 100)
    b = packing.packed(list(range(200)), sizes, 100)
    for child in (packing.crossover(a, b, sizes, rng), packing.mutated(b, sizes, rng)):
        assert sorted(i for x in child.items for i in x) == list(range(200))
        assert all(sum(sizes[i] for i in x) == 100 - g for x, g in zip(child.items, child.gap))


def test_generations_save_bins():
    """Pieces of full bins: the founders and best-fit decreasing need more bins than crossover leaves."""
    import random

    for seed in range(6):
        rng, sizes = random.Random(seed), []
        for _ in range(30):
            a, b = rng.randint(200, 480), rng.randint(200, 480)
            while not 200 <= 1000 - a - b <= 580:
                a, b = rng.randint(200, 480), rng.randint(200, 480)
            sizes += [a, b, 1000 - a - b]
        rng.shuffle(sizes)
        decreasing = len(packing.packed(sorted(range(90), key=lambda i: -sizes[i]), sizes, 1000).items)
        first = min(len(packing.founder(sizes, 1000, random.Random(k)).items) for k in range(packing.POPULATION))
        best, made = packing.evolve(sizes, [], 1000, seed, generations=60)
        assert sorted(i for x in best.items for i in x) == list(range(90)) and made > 0
        assert 30 <= len(best.items) < min(first, decreasing)


def test_packing_needs_the_fewest_sequences(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    r = packing.packing(documents).agg(F.countDistinct("sequence_id").alias("n"), F.sum("length").alias("t"), F.max("generations").alias("g")).first()
    assert r.n == -(-r.t // 2048) and r.g > 0


def test_packing_of_many_cells(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = packing.packing(documents, cell=150).groupBy("sequence_id").agg(F.sum("length").alias("t")).agg(F.count("*").alias("n"), F.sum("t").alias("t"), F.max("t").alias("m")).first()
    assert r.m <= 2048 and r.n <= -(-r.t // 2048) + 2


def test_line_dedup(spark):
    lines = [sentence(i, 6) for i in range(40)]
    rows = [(0, "\n".join(lines[:30])), (1, "\n".join(["first", *lines[5:30], "last"])), (2, "\n".join(lines[30:])), (3, None), (4, ""), (5, "one line"), (6, "\n".join(lines[:30])), (None, "\n".join(lines[:30]))]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, digest int, place int")
    seen, want = set(), {}
    for d, t in rows[:-1]:
        ls = (t or "").encode().split(b"\n") if t else []
        spans = line_dedup.chunks_of(ls)
        kept = []
        for x, y in spans:
            raw = tuple(ls[x:y])
            if y - x >= 2 and raw in seen:
                continue
            seen.add(raw)
            kept += raw
        want[d] = t if not ls else b"\n".join(kept).decode()
    got = {r.doc_id: (r.kept, r.n_removed) for r in line_dedup.line_dedup(df).collect()}
    assert {d: got[d][0] for d in want} == want
    assert got[6][1] > 10 and got[1][1] > 10 and got[2][1] == 0 and got[None][1] == 0


def test_line_runs(spark):
    rng = np.random.default_rng(31)
    # short passages of common lines in different surroundings, one document twice, lines that repeat in place
    rows = [(d, "\n".join(str(x) for x in rng.integers(0, 25, rng.integers(1, 30)))) for d in range(60)]
    shared = ["shared one", "shared two"]
    rows += [(60, "\n".join(["a", *shared, "b"])), (61, "\n".join(["c", *shared, "d"])), (62, "\n".join(["e", shared[0], "f"])), (63, "g\n" * 5), (64, None), (65, ""), rows[3]]
    seen, want = set(), {}
    for d, t in rows[:-1]:
        ls = t.split("\n") if t else []
        gone = [False] * len(ls)
        for i in range(len(ls) - 1):
            if (ls[i], ls[i + 1]) in seen:
                gone[i] = gone[i + 1] = True
            seen.add((ls[i], ls[i + 1]))
        want[d] = len(ls), sum(gone), "\n".join(x for x, g in zip(ls, gone) if not g) if ls else t
    assert want[61] == (4, 2, "c\nd") and want[62][1] == 0
    df = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    got = line_dedup.line_runs(df).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r.n_lines, r.n_removed, r.kept) == (want[r.doc_id] if r.doc_id is not None else (want[0][0], 0, rows[0][1]))


def test_line_runs_tells_repeated_chunks_whole(spark, monkeypatch):
    lines = [sentence(3000 + i, 4) for i in range(60)]
    rows = [(d, "\n".join([f"only {d}", *lines[d % 5 :], f"last {d}"])) for d in range(20)]
    # boundaries follow the content, and all neighbours are in exactly one chunk
    spans = {d: line_dedup.linked_chunks(t.encode().split(b"\n")) for d, t in rows}
    assert all([k for x, y in s for k in range(x, y - 1)] == list(range(len(rows[d][1].split("\n")) - 1)) for d, s in spans.items())
    inside = {d: {"\n".join(t.split("\n")[x:y]) for x, y in spans[d]} for d, t in rows}
    assert min(len(inside[0] & inside[d]) for d in inside) >= 10
    frames, whole = {}, common.written
    monkeypatch.setattr(common, "written", lambda df, name: frames.setdefault(name, whole(df, name)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept) for r in line_dedup.line_runs(df).collect()}
    assert got == {d: (0, rows[0][1]) if d == 0 else (60 - d % 5, f"only {d}\nlast {d}") for d in got} and len(got) == 20
    assert frames["chunks"].count() == sum(map(len, spans.values())) and frames["distinct"].count() == len(set().union(*inside.values()))


def test_decontaminate(spark):
    item = sentence(50, 40)
    words = item.split()
    edited = [w if i % 6 else "zz" for i, w in enumerate(words)]
    rows = [(1, f"{sentence(51, 50)} {item} {sentence(52, 50)}"), (2, f"{sentence(53, 30)} {' '.join(edited)}"), (3, sentence(54, 300)), (4, None), (5, ""), (6, item.upper() if item.isascii() else item), (None, item)]
    df = spark.createDataFrame([(d, t, 0.5, 9) for d, t in rows], "doc_id long, text string, score double, item_id int")
    bench = spark.createDataFrame([(10, item), (11, sentence(60, 30)), (12, None), (13, ""), (14, "a b")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.decontaminate(df, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (6, 10)}
    assert got[1, 10].score == 1.0 and (got[1, 10].first_word, got[1, 10].end_word) == (50, 90) and 0.5 <= got[2, 10].score < 1


def full_alignment(a: list, b: list) -> int:
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, *new)
    return best


def test_decontaminate_against_full_alignment(spark):
    """Every pair that shares three words in a row, by the full table: edits of all kinds, ties, repeats and a very long text."""
    rng = np.random.default_rng(77)
    items = {i: sentence(600 + i, int(rng.integers(5, 45))).split() for i in range(8)}
    items[8] = list(items[0])  # two items with one text
    docs = {}
    for i in range(90):
        words, out = items[i % 9], []
        for j, w in enumerate(words):
            kind = rng.random()
            out += [] if kind < 0.08 else ["zz"] if kind < 0.2 else [w] if kind < 0.75 else ["yy"] * int(rng.integers(1, 4)) + [w]
        docs[i] = sentence(700 + i, int(rng.integers(0, 30))).split() + out + sentence(800 + i, int(rng.integers(0, 30))).split()
    first = items[1]
    docs[90] = first[:3] + [x for k, w in enumerate(first[3:]) for x in (["foreign", "words"] if k % 2 else []) + [w]]
    docs[91] = sentence(950, 3000).split() + items[2] + sentence(951, 9000).split() + items[2] + items[3]
    rows = [(d, " ".join(w)) for d, w in docs.items()] + [(90, " ".join(docs[90]))]
    bench = [(i, " ".join(w)) for i, w in items.items()]
    want = {}
    for d, w in docs.items():
        for i, own in items.items():
            seeds = {tuple(own[k : k + 3]) for k in range(len(own) - 2)}
            if any(tuple(w[k : k + 3]) in seeds for k in range(len(w) - 2)):
                score = full_alignment(own, w) / (2 * len(own))
                if score >= 0.5:
                    want[d, i] = score
    got = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == pytest.approx(want) and (90, 1) in want and len(want) > 60
    assert len(got) == len(want) + sum(d == 90 for d, _ in want)


def test_edited_copy_leaked_into_many_documents(spark):
    words = sentence(301, 60).split()
    # spread edits break the item's own seeds; what is left is in every document
    edited = " ".join("edited" if i in (8, 20, 32, 44, 55) else w for i, w in enumerate(words))
    df = spark.createDataFrame([(d, f"{sentence(1000 + d, 20)} {edited} {sentence(2000 + d, 20)}") for d in range(200)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = decontamination.decontaminate(df, bench).collect()
    assert sorted(r.doc_id for r in got) == list(range(200)) and all(r.score > 0.8 for r in got)


def test_smith_waterman_against_the_full_table():
    rng = np.random.default_rng(9)
    for _ in range(50):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontamination.smith_waterman(a, b)[0] == h.max()


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_field_marginals_against_enumeration(segment, monkeypatch):
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    f = toxicity.Field(np.zeros(4), np.array([0.1, -0.4]), np.array([[0.3, -0.8], [-0.2, 0.5]]), np.zeros(3))
    rng = np.random.default_rng(2)
    lens = [7, 1, 4, 8]
    score = rng.normal(size=sum(lens)) * 2
    got = toxicity.marginals(score, np.repeat([0, 2, 3, 9], lens), f)
    want, pairs, first, log_z, at = [], np.zeros((2, 2)), np.zeros(2), 0.0, 0
    for n in lens:
        own = score[at : at + n]
        at += n
        total, p, q, r = 0.0, np.zeros(n), np.zeros((2, 2)), np.zeros(2)
        for y in itertools.product((0, 1), repeat=n):
            e = np.exp(f.start[y[0]] + sum(f.step[y[i], y[i + 1]] for i in range(n - 1)) + sum(s for s, t in zip(own, y) if t))
            total += e
            p += e * np.array(y)
            r[y[0]] += e
            for i in range(n - 1):
                q[y[i], y[i + 1]] += e
        want += (p / total).tolist()
        pairs, first, log_z = pairs + q / total, first + r / total, log_z + np.log(total)
    assert np.allclose(got[0], want) and np.allclose(got[1], pairs) and np.allclose(got[2], first) and np.isclose(got[3], log_z)


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.toxicity(documents, labels).join(labels, "doc_id").where("held_out")
    hit = {(r.toxic, r.predicted): r.n for r in got.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert hit.get((0, 1), 0) <= 0.01 * hit[0, 0] and hit[1, 1] >= 0.9 * (hit[1, 1] + hit.get((1, 0), 0)), hit


def test_toxicity_is_not_learnt_on_the_driver(spark, monkeypatch):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    sample = sorted((r.toxic, r.doc_id, r.text) for r in toxicity.training_sample(documents, labels).collect())
    want = toxicity.fit([r[2] for r in sample], np.array([r[0] for r in sample]))

    def refuse(*_):
        raise AssertionError("learnt on the driver")

    monkeypatch.setattr(toxicity, "fit", refuse)
    got = toxicity.learnt(documents, labels)
    assert all(np.array_equal(getattr(got, k), getattr(want, k)) for k in ("weights", "start", "step", "document"))
    assert toxicity.toxicity(documents, labels).count() == documents.count()


def test_pipeline_reads_a_store_that_only_spark_reaches(spark):
    import corpus_pipeline

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", "file:///root/testdata/sf0.001")
    docs = spark.read.parquet("viewfs://store/in/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, "viewfs://store/in").count() == corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.001").count()


def test_toxicity_of_odd_rows(docs, empty, spark):
    labels = spark.createDataFrame([(0, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 and r.predicted == 0 for r in rows)
    assert {r.doc_id: r.held_out for r in rows if r.doc_id is not None} == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in known()}
    assert toxicity.toxicity(empty, labels).count() == 0


def test_url_filter_rules_and_aliases(spark):
    link = '<link rel="canonical" href="%s">'
    rows = [
        (1, "http://A.Example.COM/en/7x", ""), (2, "http://example.com/en/8", ""), (3, "x.org/es/", ""), (4, None, ""), (5, "https://b.net/de/1?q", None),
        (6, "http://q.info/a", link % "http://x.com/en/bad"), (7, "http://q.info/b", '<META http-equiv=refresh content="0; url=/a">'),
        (8, "http://q.info/c", link % "http://example.com/en/7"), (9, "http://q.info/c2", link % "http://q.info/c#f"), (10, "http://q.info/d", link % "http://q.info/d"),
        (11, "http://q.info/e", link % "http://q.info/c"), (12, "http://mycom/en/", ""), (13, "http://example.net/de/8", ""), (6, "http://q.info/a", link % "http://x.com/en/bad"),
        (15, "http://q.info/dir/a?x", link % "bad.html"), (16, "http://q.info/dir/g", link % "http://y.com/en/w"), (17, "http://q.info/dir/bad.html", link % "../dir/./g"),
        (18, "http://q.info/p", link % "?p=2"), (19, "http://q.info/p?p=2", link % "http://z.com/en/w"), (20, "http://q.info", link % "p?p=2#f"), (21, "http://q.info/dir/x", link % "mailto:a@b"),
        (22, "http://q.info/dir/y", link % "#top"), (23, "http://q.info/r;1", '<meta http-equiv=refresh content="0; url=r;2">'), (24, "http://q.info/r;2", link % "//y.com/en/w"), (25, "http://q.info/a/b/c/d", link % "../../../../../p"),
        (14, "http://q.info/f", link % "http://example.com/en/7" + '<meta http-equiv="refresh" content="1;URL=\'http://x.com/en/z\'">'),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: r for r in url_filter.url_filter(df).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/en/7x", "example.com/en/7", "allow")
    assert [got[i].verdict for i in range(2, 15)] == ["block", "allow", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow", "allow", "block", "allow"]
    assert [got[i].verdict for i in range(15, 26)] == ["block", "block", "block", "block", "block", "block", "allow", "allow", "block", "block", "block"]
    assert got[4].host == "" and got[4].path == "" and got[3].host == "" and got[12].rule is None
    assert url_filter.url_filter(df).count() == len(rows) and url_filter.url_filter(df.limit(0)).count() == 0
    con = duckdb.connect()
    pages = pd.DataFrame({"page_id": [r[0] for r in rows], "url": [r[1] for r in rows], "html": [r[2] for r in rows]})  # noqa: F841, read by name
    want = con.execute(queries.ORACLE["op3_url_filter"]).fetchall()
    assert {r[0]: r[1:] for r in want} == {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()}


def test_rule_table_agrees_with_the_rule_list(spark):
    urls = [(i, h, p) for i, (h, p) in enumerate(itertools.product(["com", "a.example.com", "example.com", "net", "x.net", "org", "", "b.org"], ["/en/", "/en/71", "/de/8", "/es/x", ""]))]
    df = spark.createDataFrame(urls, "key long, host string, path string")
    table = url_filter.matched_by_table(df, spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string"))
    both = table.withColumn("w", url_filter.matched(F.col("host"), F.col("path"), url_filter.RULES))
    assert both.where("not (m.rule <=> w.rule and m.verdict <=> w.verdict)").count() == 0


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 130), (130, 120), (120, 100), (7, 7), (200, 200), (None, 3), (5, None)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 120: 100, 130: 100, 200: 200}


@pytest.mark.parametrize("run", [substring_dedup, suffix_dedup.suffix_dedup, ngram_join.ngram_join, line_dedup.line_dedup, packing.packing, token_codec.token_codec])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_empty_embeddings_and_benchmark(spark, docs):
    assert embedding_join(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert decontamination.decontaminate(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_blocks_in_several_groups(monkeypatch):
    from tidewake.llm import token_codec as tc

    rng = np.random.default_rng(5)
    for n in (0, 1, tc.BLOCK, 3 * tc.BLOCK, 7 * tc.BLOCK + 5):
        ids = np.where(rng.random(n) < 0.5, rng.integers(0, 50, n), rng.integers(0, 1 << 16, n)).astype(np.uint32)
        whole = tc.encode_blocks(ids)
        monkeypatch.setattr(tc, "LANES", 3)
        cut = tc.encode_blocks(ids)
        assert whole[0] == cut[0] and all(np.array_equal(a, b) for a, b in zip(whole[1:], cut[1:], strict=True))
        assert np.array_equal(tc.decode_blocks(n, *cut), ids)
        monkeypatch.undo()


def thue_morse(n: int) -> str:
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_that_a_polynomial_hash_confuses(spark):
    a = thue_morse(1024)
    b = a.translate(str.maketrans("ab", "ba"))
    rest = sentence(90, 12)
    df = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, a), (4, b), (5, a)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup(df).collect()} == dict.fromkeys(range(1, 6), 0)
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_join(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


def test_hashes_of_words_of_all_lengths():
    import pyarrow as pa

    words = ["x" * i for i in range(1, 200)] + ["x" * i + "y" for i in range(200)] + ["é" * i for i in range(1, 90)]
    buf, off = common.text_buffer(pa.array([" ".join(words), None, " ".join(reversed(words))], pa.string()))
    h, _, _, first = common.words(buf, off, seed=5)
    assert len(set(h.tolist())) == len(set(words)) and np.array_equal(h[: first[1]], h[first[2] :][::-1])
    assert not np.isin(common.words(buf, off, seed=6)[0], h).any()
    assert np.array_equal(common.words(*common.text_buffer(pa.array(["ABC Dé"], pa.string())), lower=True)[0], common.words(*common.text_buffer(pa.array(["abc dé"], pa.string())))[0])


def test_levels_double_and_large_partitions_are_settled_in_parts(spark, docs, monkeypatch):
    from tidewake.llm import windows

    assert substring_dedup.__module__ and __import__("tidewake.llm.substring_dedup", fromlist=["x"]).levels_of(13) == [4, 8, 13]
    h = np.random.default_rng(0).integers(0, 500, 10_000)
    parts = list(windows.parts_by_hash(h, 300))
    assert len(parts) > 5 and sorted(np.concatenate(parts).tolist()) == list(range(10_000))
    assert sum(len(np.unique(h[p])) for p in parts) == len(np.unique(h))
