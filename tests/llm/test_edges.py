"""What every operator does with nulls, empty and long texts, repeats, empty tables and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    alignment, byte_bpe, jaccard_join, language_model, licenses, mixing, neighbours, packing, periodic, pii, quality, secrets, toxicity,
)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 700} and{i}" for i in range(30_000))
ROWS = [
    (1, "a plain sentence of some words. " * 20, "en", "s1", 640),
    (2, None, "en", None, None),
    (3, "", None, "s1", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "s2", 7),
    (5, LONG, "en", "s2", len(LONG)),
    (6, "one two", "en", "s1", 7),
    (6, "one two", "en", "s1", 7),
    (7, "ünïcödé 😀 déjà vu\x00\x1c ends", None, None, 3),
    (None, "a text without an id. " * 30, "en", "s1", 5),
    (8, "x", "", "", 1),
]
# Names that operators use inside, or give to what they add.
CLASHES = [
    "row", "words", "lines", "kept", "n_words", "size", "class", "h", "slot", "target", "copies", "found", "spans", "masked",
    "sid", "bucket", "score", "pii", "batch", "piece", "offset", "_h", "_copy", "a", "b", "t", "path", "component_id",
]


def clash(df):
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def docs(spark):
    return clash(spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long"))


def model_of(docs):
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).when(F.col("doc_id") < 9, 0).alias("toxic"))
    return toxicity.train(docs, labels, train_docs=100)


OPERATORS = {
    "quality": (quality.assess, len(ROWS)),
    "keep_good": (quality.keep_good, None),
    "mixing": (mixing.mix, len(ROWS)),
    "take": (mixing.take, None),
    "secrets": (secrets.find_secrets, len(ROWS)),
    "packing": (lambda d: packing.pack(d, VOCABULARY, with_ids=True), None),
    "jaccard": (jaccard_join.near_duplicates, len(ROWS)),
    "language_model": (language_model.score, len(ROWS)),
    "licenses": (lambda d: licenses.scan(d, "source"), len(ROWS)),
    "pii": (lambda d: pii.pseudonymise(d, b"key"), len(ROWS)),
    "byte_bpe": (lambda d: byte_bpe.encode(d, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), len(ROWS)),
    "alignment": (lambda d: alignment.link_counts(d, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), len(ROWS)),
    "periodic": (periodic.find_runs, len(ROWS)),
    "toxicity": (lambda d: toxicity.score(d, model_of(d)), len(ROWS)),
} | {f"stage_{n}": (lambda d, f=f: f(d.sparkSession, d, ""), None) for n, f in corpus_pipeline.STAGES}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(docs, name):
    operator, rows = OPERATORS[name]
    out = operator(docs).collect()
    assert rows is None or len(out) == rows


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    out = OPERATORS[name][0](docs.where("doc_id < 0"))
    assert out.count() == 0
    assert out.columns == OPERATORS[name][0](docs).columns


@pytest.mark.parametrize("name", ["keep_good", "take"])
def test_filters_keep_the_columns_and_values_of_the_caller(docs, name):
    out = OPERATORS[name][0](docs)
    assert out.columns == docs.columns
    assert {r["kept"] for r in out.collect()} == {"own"}


def test_stages_but_the_last_return_the_columns_of_documents(docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(docs.sparkSession, docs, "").columns == docs.columns, name


VECTORS = [
    (1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
    (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (9, []), (None, [1.0, 1.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (11, [0.0, 1.0]),
]


def test_awkward_vectors(spark):
    df = clash(spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>"))
    out = neighbours.nearest(df, F.col("vec_id").isin(1, 3, 5, 11), k=5).collect()
    found = {q: [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in out}}
    assert found == {1: [2, 10, 11], 11: [10, 2, 1]}
    assert neighbours.nearest(df.where("vec_id < 0"), F.lit(True)).count() == 0
