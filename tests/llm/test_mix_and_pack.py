"""Mixing and packing against plain Python; token ids against the tokenizer over whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import mixing, packing, tokens
from tidemark.llm.tokens import WordTokenizer

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdefghiABC  \n\t\x1c 0123.,;!?'\"<|>endoftext áéÀßœŒΣσİıſﬁ漢字̈é\xa0\x85 —’…😀\x01\x02\x7f½ªµ×÷"


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(VOCABULARY)


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(VOCABULARY)


def same_ids(words, whole, texts):
    ids, at = words.encode(texts)
    for i, e in enumerate(whole.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == [*e.ids, 0], texts[i]


def test_ids_of_documents(spark, words, whole):
    same_ids(words, whole, [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()])


def test_ids_of_odd_texts(words, whole):
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|endoftext|>b don't I'll <|startoftext|>", "", " ", "\n", "can't's 'tis", "x" * 5000]
    same_ids(words, whole, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_ids_of_any_text(words, whole, texts):
    same_ids(words, whole, texts)


def test_forgetting_words_changes_nothing(whole, monkeypatch):
    monkeypatch.setattr("tidemark.llm.tokens.MEMORY_WORDS", 3)
    small = WordTokenizer(VOCABULARY)
    for text in ("one two three four", "two five", "six one"):
        same_ids(small, whole, [text])


def check_packed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_documents(spark, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = packing.pack(docs, VOCABULARY, with_ids=True).cache()
    rows = packed.collect()
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    assert sorted((r.doc_id, r.piece) for r in rows) == sorted((i, p) for i, x in ids.items() for p in range(-(-len(x) // 2048)))
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + 2048]
        assert (r.start, r.length, r.ids) == (2048 * r.piece, len(own), own)
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    used = check_packed(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1
    for r in packing.sequences(packed).collect():
        parts = sorted((x.offset, x.ids) for x in rows if x.sequence_id == r.sequence_id)
        assert r.ids == [i for _, own in parts for i in own]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 400)), min_size=1, max_size=40))
def test_plan_uses_up_any_histogram(counts):
    histogram = np.zeros(61, np.int64)
    for n, c in counts:
        histogram[n] += c
    used = np.zeros(61, np.int64)
    n_sequences = 0
    for runs, times in packing.plan(histogram, 60):
        assert times > 0 and sum(n * m for n, m in runs) <= 60
        n_sequences += times
        for n, m in runs:
            used[n] += m * times
    assert (used == histogram).all()
    total = int((histogram * np.arange(61)).sum())
    assert -(-total // 60) <= n_sequences <= max(2 * total / 60 + 1, int(histogram[31:].sum()))


def test_patterns_fill_sequences_and_fit_finds_an_exact_mix():
    rows = packing.patterns(np.array([10, 20, 30, 40, 60]), 60)
    assert (rows.sum(1) == 60).all() and {tuple(r) for r in rows.tolist()} == {(0, 0, 60), (0, 20, 40), (0, 30, 30), (10, 10, 40), (10, 20, 30), (20, 20, 20)}
    histogram = np.zeros(61)
    histogram[[10, 20, 30, 60]] = 500, 500, 500, 70
    x = packing.fit(rows, histogram, 4000)
    used = sum(np.bincount(rows[:, i], x, 61) for i in range(3))[1:]
    assert abs(used - histogram[1:]).max() < 2


def test_place_with_one_hot_length(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") < 2000, 700).otherwise(F.col("id") % 97 + 1).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    out = packing.place(rows).collect()
    assert len({r.doc_id for r in out}) == 3000
    assert check_packed(out, 2048) == 1000


def plain_targets(sizes, weights, most):
    """Water filling by rounds: share, hold what is above its limit, share the rest again."""
    target, open_ = {}, dict(zip(sizes, weights, strict=True))
    left = float(sum(sizes.values()))
    while open_:
        unit = left / sum(open_.values())
        over = [s for s, w in open_.items() if unit * w > most * sizes[s]]
        if not over:
            return target | {s: unit * w for s, w in open_.items()}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            del open_[s]
    return target


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets(spark, sizes):
    own = {f"s{i}": n for i, n in enumerate(sizes)}
    got = mixing.source_targets(spark.createDataFrame(list(own.items()), "source string, source_size long")).collect()
    expected = plain_targets(own, [1 + i % 3 for i in range(len(own))], 3)
    assert {r.source: pytest.approx(r.target, abs=1e-6) for r in got} == expected


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mix_comes_near_its_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r.size == len(corpus_words(r.text)) and r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))
    for s in target:
        assert abs(taken[s] - target[s]) <= max(0.03 * target[s], largest[s] if sf == "sf0.001" else 0)


def corpus_words(text):
    return [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]


def test_size_classes_grow_with_the_size(spark):
    got = [r[0] for r in spark.range(1, 5000).select(mixing.size_class(F.col("id"))).collect()]
    assert got == sorted(got) and max(got) < 16 * 14


def test_pipeline_packs_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, SF))
    expected = defaultdict(int)
    for r in docs.collect():
        expected[r.doc_id] += 1
    rows = corpus_pipeline.run(spark, SF).collect()
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id] += r.piece == 0
    assert got == expected
    check_packed(rows, 2048)


def test_sizes_counted_before_give_the_same_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    narrow = mixing.mix(mixing.sized(docs), size=F.col("size")).select(columns)
    assert "text" not in narrow._jdf.queryExecution().executedPlan().toString()
    assert sorted(narrow.collect()) == sorted(mixing.mix(docs).select(columns).collect())


def test_sizes_of_nulls_and_an_empty_table(spark):
    docs = spark.createDataFrame([(None, None, None), (1, "a b", "s"), (1, "a b", "s")], "doc_id long, text string, source string")
    got = [tuple(r) for r in mixing.sized(docs).collect()]
    assert sorted(got, key=str) == [(1, "s", 2), (1, "s", 2), (None, None, 0)]
    empty = mixing.sized(docs.where("doc_id > 5"))
    assert mixing.mix(empty, size=F.col("size")).count() == 0


def test_words_learnt_before_do_not_change_ids(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    fresh, shared = tokens.WordTokenizer(path, 0), tokens.word_tokenizer(path, 0)
    assert tokens.word_tokenizer(path, 0) is shared
    texts = ["Some words, some more words.", "ünïcödé 😀 déjà vu", "", "it's <|odd|> x" * 3]
    shared.encode(["other words first, and some 123", *texts[::-1]])
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 3)  # more are known: the memory is started anew
    for _ in range(2):
        for got, want in zip(shared.encode(texts), fresh.encode(texts), strict=True):
            assert got.tolist() == want.tolist()
