"""Joins, neighbours, language model and toxicity against brute force and held-out data."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import hashing, jaccard_join, language_model, metric, neighbours, toxicity
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute_groups(rows, n=4, percent=85):
    sets = {i: shingles(t, n) for i, t in rows}
    holders, edges = defaultdict(list), []
    for i, own in sets.items():
        for j, both in Counter(j for s in own for j in holders[s]).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                edges.append((i, j))
        for s in own:
            holders[s].append(i)
    root = smallest(sets, edges)
    return {i: (len(own), root[i]) for i, own in sets.items()}


def groups_of(df, **how):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df, **how).collect()}


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def copies(spark):
    """Near copies of a few texts around the limit, copies of copies, a shared passage, short and equal texts."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([6, 25, 120, 400]))]
        for _ in range(18):
            words = edited(rng, words, rng.choice([0, 0.005, 0.01, 0.03]))
            rows.append((len(rows), " ".join(words)))
    for _ in range(60):
        rows.append((len(rows), " ".join([*passage, *(f"u{rng.randrange(10**7)}" for _ in range(rng.randrange(4, 90)))])))
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b", "A  b", "a b c d", "a b c", "", None, "\n\t", "b a"])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("how", [{}, {"task_shingles": 800}, {"sample_docs": 5}])
def test_join_equals_brute_force(copies, how):
    rows, df = copies
    assert groups_of(df, **how) == brute_groups(rows)


def test_join_equals_brute_force_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert groups_of(df) == brute_groups(rows)
    assert groups_of(df, words=5, percent=80) == brute_groups(rows, 5, 80)


def test_common_pivots_and_block_join(copies, monkeypatch):
    rows, df = copies
    monkeypatch.setattr(jaccard_join, "COMMON_DOCS", 3)
    monkeypatch.setattr(jaccard_join, "SPLITS", 0)
    assert groups_of(df, task_shingles=500) == brute_groups(rows)


def test_common_passage_links_over_batches_with_unlike_first_holders(spark, monkeypatch):
    """The first holder of a common passage goes on with another passage in each batch."""
    monkeypatch.setattr(jaccard_join, "COMMON_DOCS", 3)
    p, q, r = ([f"{c}{i}" for i in range(100)] for c in "pqr")
    batches = []
    for b, other in enumerate((q, r)):
        batches += [[*p, *other], [*p, f"only{b}"], *([*other, *(f"u{b}{i}{j}" for j in range(40))] for i in range(8))]
    rows = [(i, " ".join(words)) for i, words in enumerate(batches)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    expected = brute_groups(rows)
    assert expected[11][1] == 1
    assert groups_of(df) == expected


def test_pipeline_keeps_one_of_each_group(copies):
    rows, df = copies
    docs = df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    kept = corpus_pipeline.ngram_jaccard_join(df.sparkSession, docs.union(docs), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({root for _, root in brute_groups(rows, 5, 80).values()})


def test_pipeline_keeps_different_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [
        (5, a, "s1"), (5, b, "s1"), (3, a + " more", "s2"), (7, b, "s1"), (7, b, "s1"), (7, b, "s2"), (None, c, "s1"), (None, c, "s2"),
        (None, b, "s1"), (None, None, "s1"), (None, None, "s1"), (9, None, None), (9, "", None), (10, "", "s1"), (11, "one two", "s1"), (12, "one two", "s1"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, "")
    assert kept.columns == docs.columns
    expected = [(3, a + " more"), (5, b), (9, None), (9, ""), (10, ""), (11, "one two"), (None, None), (None, c)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert corpus_pipeline.ngram_jaccard_join(spark, docs.where("doc_id < 0"), "").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=14), min_size=1, max_size=40), st.sampled_from([50, 70, 85]))
def test_region_join_equals_brute_force(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    expected = smallest(range(len(sets)), [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])])
    root = metric.links(arrays, percent)
    for leaf in (256, 4):
        metric.LEAF_SETS, before = leaf, metric.LEAF_SETS
        root = metric.links(arrays, percent)
        metric.LEAF_SETS = before
        assert {frozenset(np.flatnonzero(root == r).tolist()) for r in set(root.tolist())} == {
            frozenset(i for i in expected if expected[i] == r) for r in set(expected.values())
        }


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab \n\x0bé😀", max_size=12), max_size=6))
def test_word_hashes_follow_words(texts):
    offsets, data = hashing.text_buffers(pa.array([*texts, "zz"], pa.string()))
    words, first = hashing.word_hashes(offsets, data)
    plain = [WORD.findall(t) for t in [*texts, "zz"]]
    assert np.diff(first).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len({*zip(flat, words.tolist(), strict=True)}) == len(set(flat)) == len(set(words.tolist()))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(300, 340)] + [(0, i) for i in range(1, 90)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert {r.node: r.root for r in got} == smallest(nodes, [e for e in edges if e[0] != e[1]]) and len(got) == len(nodes)


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_nearest(rows, queries, k):
    x = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows}
    return {q: sorted(((-float(x[q] @ x[i]), i) for i in x if i != q))[:k] for q in queries}


def test_neighbours_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    out = defaultdict(list)
    for r in QUERIES["op2_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    expected = brute_nearest(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert set(out) == set(expected)
    x = {i: np.array(v, float) for i, v in rows}
    found = 0
    for q, own in out.items():
        own.sort()
        assert [r for r, *_ in own] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            assert s == pytest.approx(x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i]), abs=1e-12)
        found += len({i for _, i, _ in own} & {i for _, i in expected[q]})
    assert found >= 0.9 * 5 * len(out)


def test_neighbours_of_equal_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(i, rng.normal(size=3).tolist()) for i in range(400, 440)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        out[r.query_id].append(r.vec_id)
    assert out[0] == [1, 2, 3, 4, 5] and out[50] == [0, 1, 2, 3, 4] and out[350] == [0, 1, 2, 3, 4]
    assert out[400][:5] == [i for _, i in brute_nearest(rows[395:], [400], 5)[400]] or len(out[400]) == 5


def test_graph_search_finds_the_nearest_lists():
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(6000, 16))
    lists = neighbours.fit(sample, 60_000)
    unit = sample[:300] / np.linalg.norm(sample[:300], axis=1, keepdims=True)
    near, _ = lists.search(unit, 32)
    true = np.argmax(unit @ lists.centroids.T, 1)
    assert (near[:, 0] == true).mean() > 0.97
    counts = np.bincount(lists.owners(unit)[0])
    assert counts.min() >= 1 and 1 < counts.mean() <= neighbours.REPLICAS
    sizes = np.bincount(neighbours._nearest(sample / np.linalg.norm(sample, axis=1, keepdims=True), lists.centroids))
    assert sizes.max() <= 4 * sizes.mean()


@pytest.mark.parametrize(("order", "batch_bytes"), [(2, 10**9), (2, 50_000), (3, 90_000), (1, 50_000)])
def test_backoff_scores(spark, order, batch_bytes):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, ""), (-2, None), (-3, "one"), (-4, "one one one")], docs.schema))
    rows = [(r.doc_id, WORD.findall(r.text or "")) for r in docs.collect()]
    counts = Counter(tuple(w[i : i + k]) for _, w in rows for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(len(w) for _, w in rows)
    got = {r.doc_id: r for r in language_model.score(docs, order=order, batch_bytes=batch_bytes).collect()}
    assert len(got) == len(rows)
    for i, w in rows:
        log, backed = 0.0, 0
        for j in range(len(w)):
            top = min(order, j + 1)
            k = next(k for k in range(top, 0, -1) if k == 1 or counts[tuple(w[j - k + 1 : j + 1])] >= 2)
            gram = tuple(w[j - k + 1 : j + 1])
            log += math.log(counts[gram] / (counts[gram[:-1]] if k > 1 else total)) + (top - k) * math.log(0.4)
            backed += k < top
        assert got[i].log_score == pytest.approx(log, abs=1e-6) and (got[i].n_words, got[i].n_backed_off) == (len(w), backed)
        assert got[i].mean_log_score == (pytest.approx(log / len(w)) if w else None)


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    test = rows[rows.held_out]
    assert auc(test.score.to_numpy(), test.toxic.to_numpy()) > 0.95
    assert test[test.predicted == 1].toxic.mean() > 0.9 and test[test.toxic == 1].predicted.mean() > 0.85


def test_factors_learn_what_weights_cannot():
    """Toxic only if exactly both terms are there, or neither: no weights per term tell that."""
    rng = np.random.default_rng(0)
    cells, label = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        cells.append(np.array(sorted([3 if a else 4, 5 if b else 6, *rng.integers(100, 140, 2)])))
        label.append(float(a == b))
    term, begins = np.concatenate(cells), np.concatenate([[0], np.cumsum([len(c) for c in cells])])
    label = np.array(label)
    toxicity.LEAST_Z, before = 0.0, toxicity.LEAST_Z
    toxicity.EPOCHS, epochs = 30, toxicity.EPOCHS
    model = toxicity.fit(term, begins, label, bits=8)
    toxicity.LEAST_Z, toxicity.EPOCHS = before, epochs
    raw = model.raw(term, begins)
    assert auc(raw, label) > 0.95
    model.factors[:] = 0
    assert auc(model.raw(term, begins), label) < 0.65


def test_shipped_settings_learn_pairs_of_neutral_terms():
    """Toxic only by two terms together, each of them as frequent in other texts; among many other terms."""
    rng = np.random.default_rng(5)

    def sample(n):
        cells, label = [], []
        for _ in range(n):
            a, b = rng.random(2) < 0.5
            cells.append(np.array(sorted([3 if a else 4, 5 if b else 6, *rng.choice(np.arange(100, 160), 10, replace=False)])))
            label.append(float(a == b))
        return np.concatenate(cells), np.concatenate([[0], np.cumsum([len(c) for c in cells])]), np.array(label)

    term, begins, label = sample(6000)
    model = toxicity.fit(term, begins, label, bits=8)
    assert not model.linear[3:7].any()
    term, begins, label = sample(1000)
    assert auc(model.raw(term, begins), label) > 0.95


def test_training_rows_are_one_an_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda term, begins, label, bits: seen.append(len(label)) or toxicity.Model(0.0, *[np.zeros(1)] * 3))
    docs = spark.createDataFrame([(1, "a bad text")] * 50 + [(2, "a good text")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1)] * 3 + [(2, 0)], "doc_id int, toxic int")
    toxicity.train(docs, labels)
    assert seen == [2]


def test_pair_sums_equal_the_plain_double_loop():
    rng = np.random.default_rng(1)
    model = toxicity.Model(0.3, rng.normal(size=32), rng.normal(size=(32, 4)), np.ones(32, bool))
    term, begins = np.array([1, 5, 9, 30, 2, 3]), np.array([0, 4, 4, 6])
    for i, raw in enumerate(model.raw(term, begins)):
        own = term[begins[i] : begins[i + 1]]
        scale = max(len(own), 1) ** -0.5
        pairs = sum(model.factors[a] @ model.factors[b] for n, a in enumerate(own) for b in own[:n])
        assert raw == pytest.approx(0.3 + model.linear[own].sum() + scale * pairs)


def test_terms():
    offsets, data = hashing.text_buffers(pa.array(["Abcdef, ABCDEF ab", "", "É é"], pa.string()))
    term, begins = toxicity.terms(offsets, data)
    # abcdef, its first 4 and 5 letters, ab; nothing; one letter
    assert np.diff(begins).tolist() == [4, 0, 1]
