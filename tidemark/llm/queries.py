"""The operators over the supplied tables, as the driver runs them, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, byte_bpe, jaccard_join, language_model, licenses, mixing, neighbours, packing, periodic, pii, quality, secrets, toxicity
from tidemark.llm.rows import words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sized(table(spark, sf_dir, "documents"))
    return mixing.mix(sizes, size=F.col("size")).select("doc_id", "size", "source_size", "target", "copies", "taken")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"
    )


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# The key of the supplied tables' pseudonyms. A real one comes from a secret store, never from code.
PSEUDONYM_KEY = b"key of the test tables"


@query
def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    spans = F.transform("pii", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return done.select("doc_id", F.size("pii").cast("long").alias("n_found"), F.array_join(spans, ",").alias("spans"), "text")


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The tables have no paths: a document lies in the directory of its source and language.
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    found = licenses.scan(table(spark, sf_dir, "documents").select(path.alias("path"), "text"))
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "licence", F.round("cosine", 6).alias("cosine"), "how", "stated_in")


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_counts(table(spark, sf_dir, "documents"), a, b)


def echoing(docs: DataFrame) -> DataFrame:
    """Every tenth document (by the hash of its id) repeats its words from one of them on, with a period; a row without an id stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = docs.withColumn("words", F.when(h % 10 == 0, words_of(F.col("text").cast("string"))))
    n = F.size("words").cast("long")
    a = F.col("g") % F.col("n")
    p = F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1
    chosen = chosen.withColumns({"g": g, "n": n}).withColumn("a", a).withColumn("p", p)
    a, p, n = (F.col(c).cast("int") for c in ("a", "p", "n"))
    period = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    echo = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, echo).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(echoing(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", periodic.longest())
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
