import itertools
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from tidewake.llm.toxicity import THRESHOLD, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, at = {r.doc_id: r.text for r in docs.collect()}, docs
    for name, stage in P.STAGES[:-1]:
        out = P.written(stage(spark, at, SF), name)
        assert out.columns == docs.columns
        rows = {r.doc_id: r.text for r in out.collect()}
        assert set(rows) <= set(before) and len(rows) == out.count()
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where(f"score >= {THRESHOLD}").collect()}
            assert set(before) - set(rows) == bad
        if name == "ngram_join":
            sets = {}
            for d, t in rows.items():
                w = (t or "").lower().split()
                sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
            some = [d for d in sets if len(sets[d]) > 20][:150]
            assert not [(a, b) for a, b in itertools.combinations(some, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        before, at = rows, out
    packed = P.pack(spark, at, SF).toPandas()
    assert set(packed.doc_id) == set(before) and packed.groupby("sequence_id").length.sum().max() <= 2048


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, ids that rows share, repeated rows, copies, shared lines and a leaked item."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    a, b, passage = prose(1, 60), prose(2, 60), [prose(30 + i, 8) for i in range(3)]
    texts = [
        (7, "A " + a), (7, "B " + b), (1, a), (1, a), (2, a + " x"), (None, a), (None, prose(3, 50)), (3, None), (4, ""), (None, None), (None, None), (5, " \n"),
        (10, "\n".join([prose(40, 9), *passage, prose(41, 9)])), (11, "\n".join([prose(42, 9), *passage, prose(43, 9)])), (11, "\n".join([prose(44, 9), *passage, prose(45, 9)])),
        (12, "\n".join(passage)), (None, "\n".join([prose(46, 9), *passage])), (20, f"{prose(47, 20)} {item}"), (None, f"{prose(48, 20)} {item}"), (21, prose(49, 40)), (21, f"{item} {prose(50, 20)}"),
        (30, "long " * 30_000),
    ]
    df = spark.createDataFrame([(d, t, "en", "s", -1, "x") for d, t in texts], "doc_id long, text string, lang string, source string, n_chars int, row_id string")
    return df, texts, item, passage


def result(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_line_stage_on_odd_rows(spark, odd):
    df, texts, _, passage = odd
    got = P.drop_repeated_lines(spark, df, SF)
    assert got.schema.names == df.schema.names
    want = Counter()
    for d, t in texts:
        lines = (t or "").split("\n")
        if d == 12:
            continue  # all its lines are in document 10
        if set(passage) <= set(lines) and d != 10:
            t = "\n".join(x for x in lines if x not in passage)
        want[d, t] += 1
    assert result(got) == want
    assert {r.doc_id: r.n_chars for r in got.where("doc_id in (10, 30) or n_chars > 0").collect() if r.doc_id in (10, 30)} == {10: -1, 30: -1}


def test_group_stage_on_odd_rows(spark, odd):
    df, texts, _, _ = odd
    got = P.one_of_each_group(spark, df, SF)
    assert got.schema.names == df.schema.names
    sets = {}
    for d, t in set(texts):
        w = (t or "").lower().split()
        sets[d, t] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    count = Counter(d for d, _ in sets)
    group = {k: {k} for k in sets}
    for x, y in itertools.combinations(sets, 2):
        if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]) and group[x] is not group[y]:
            group[x] |= group[y]
            for k in group[y]:
                group[k] = group[x]
    rows = list(result(got).items())
    assert all(n == 1 for _, n in rows) and Counter(id(group[k]) for k, _ in rows) == Counter({id(g): 1 for g in group.values()})
    for k, _ in rows:  # the least doc_id that one row has, else any
        plain = [d for d, _ in group[k] if d is not None and count[d] == 1]
        assert k[0] == min(plain) if plain else True
    assert {(7, "A " + prose(1, 60)), (7, "B " + prose(2, 60))} & {k for k, _ in rows} == {(7, "B " + prose(2, 60))}


def test_leak_stage_on_odd_rows(spark, odd):
    df, texts, item, _ = odd
    assert result(P.drop_leaked(spark, df, SF)) == Counter(x for x in texts if item not in (x[1] or ""))


def test_toxic_stage_judges_every_row_by_its_text(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity(docs, labels).select("doc_id", "predicted").join(docs, "doc_id")
    bad, good = (scored.where(f"predicted = {k}").orderBy("doc_id").first().text for k in (1, 0))
    rows = [(0, good), (0, bad), (None, good), (None, bad), (1, None), (2, ""), (1, None), (3, good), (3, good)]
    df = docs.unionByName(spark.createDataFrame([(d if d is None else 10**9 + d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars int"), allowMissingColumns=True).select(docs.columns)
    got = P.drop_toxic(spark, df, SF).where("doc_id is null or doc_id >= 1000000000")
    assert got.columns == docs.columns
    assert result(got) == Counter((d if d is None else 10**9 + d, t) for d, t in rows if t != bad)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_stages_on_an_empty_table(spark, stage):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, empty, SF).count() == 0
