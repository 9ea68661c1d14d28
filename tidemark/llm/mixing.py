"""Mixing sources to target weights by systematic sampling.

Documents of a source are put in one order (by size class, then by hash). Every document
adds its expected number of copies to a prefix sum that starts at a random offset and is
taken once for each integer the sum passes. The order is cut into cells of limited size, so that no
task ranks a whole source; only one row per cell meets its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import apart, settle, together, words_of

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix-1"
# Slots of a size class of a source: a cell holds about rows / SLOTS rows of the class.
SLOT_BITS = 6
# A cell is large if its documents have more than 1 / LARGE of their source's words each, on average.
LARGE = 150


def _number(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 15), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Sixteen classes for each doubling of the size; growing with it."""
    bits = F.length(F.bin(size)) - 1
    return F.when(size < 32, size.cast("int")).otherwise(
        bits * 16 + F.floor(size / F.pow(F.lit(2.0), bits - 4)).cast("int") % 16
    )


def _passed(place: Column, before: Column) -> Column:
    """Integers that the prefix sum passes between two places."""
    return F.floor(place * F.col("rate") + F.col("offset")) - F.floor(before * F.col("rate") + F.col("offset"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Weights go round in the order of the sources (by code point, null last). Targets share
    the total by weight, none above `max_copies` times its source's size. With the
    sources ordered by size per weight, the share of one unit of weight is the largest
    that comes out when those before any one source are held at their limit.
    The windows see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*[F.lit(w) for w in weights]),
            (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1,
        ),
    )
    before = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    limit = max_copies * F.col("source_size")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = ranked.withColumn("unit", left / weight_left)
    unit = F.max("unit").over(everything)
    return shared.select(
        "source", "source_size", F.least(limit.cast("double"), unit * F.col("weight")).alias("target")
    )


def n_words(text: Column) -> Column:
    return F.size(words_of(text.cast("string"))).cast("long")


def sized(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """(id, source, size) of every document, stored: each text is read and counted once, and none is moved."""
    return settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size")))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_col: str = "doc_id",
    *,
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Add size, source_size, target, copies and taken to every document.

    size is the number of words (null and empty texts: 0), taken = copies * size. Where the sizes are known, as in
    `sized`, `size` gives them and no text is read. The rows are sorted and joined as they are: narrow ones cost little. The
    expected number of copies is target / source_size; only the small documents of a source
    share another one, which makes up for what its largest documents (fewer than LARGE) took too
    much or too little by rounding. Each document gets its number rounded down or up. Neighbours
    in the order are of about one size, so the words taken come near the target. Null is a source of its own. Everything follows
    from hashes of the id and the source, so reruns agree; rows alike in id, size and source
    may swap their copies. Input columns of the same names are replaced. An empty table gives an empty result.
    """
    columns = docs.columns
    words = n_words(F.col(text)) if size is None else size
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = apart(docs, source=F.col(source).cast("string"), key=key, size=words)
    rows = rows.withColumn("class", size_class(F.col("size"))).withColumn("h", _number(F.lit(seed), F.col("key")))
    rows = rows.withColumn("slot", F.shiftright("h", 60 - SLOT_BITS).cast("int"))

    cells = rows.groupBy("source", "class", "slot").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    totals = source_targets(
        cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies
    ).withColumnRenamed("source", "of")
    earlier = Window.partitionBy("source").orderBy("class", "slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    placed = (
        cells.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(totals, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("offset", _number(F.lit(seed), F.lit("offset"), F.coalesce("source", F.lit("\x00"))) / float(1 << 60))
        .withColumn("large", F.col("words") * LARGE > F.col("source_size") * F.col("n"))
    )
    # What the large documents take too much or too little, the others make up for.
    in_large = F.when(F.col("large"), (_passed(F.col("before") + F.col("n"), F.col("before")) * F.col("words") / F.col("n")).cast("long"))
    taken = F.coalesce(F.sum(in_large).over(whole), F.lit(0))
    rest = F.sum(F.when(~F.col("large"), F.col("words"))).over(whole)
    others = F.least(F.greatest((F.col("target") - taken) / rest, F.lit(0.0)), F.lit(float(max_copies)))
    placed = placed.withColumn("rate", F.when(F.col("large") | (F.coalesce(rest, F.lit(0)) == 0), F.col("rate")).otherwise(others))
    placed = placed.select(
        F.col("source").alias("of"), F.col("class").alias("c"), F.col("slot").alias("s"), "before", "source_size", "target", "rate", "offset"
    )

    in_cell = Window.partitionBy("source", "class", "slot").orderBy("h", "key", "size")
    ranked = rows.withColumn("rank", F.row_number().over(in_cell)).join(
        placed,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("c")) & (F.col("slot") == F.col("s")),
    )
    place = F.col("before") + F.col("rank")
    passed = _passed(place, place - 1)
    ranked = ranked.withColumn("copies", F.least(passed, F.lit(max_copies)).cast("int"))
    return together(
        ranked,
        columns,
        size=F.col("size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=F.col("copies"),
        taken=F.col("copies") * F.col("size"),
    )


def take(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", **how) -> DataFrame:
    """The mix itself: every document as often as `mix` takes it, with its own columns."""
    columns = docs.columns
    own = apart(docs, text=F.col(text), source=F.col(source), id=F.col(id_col))
    mixed = mix(own, "text", "source", "id", **how)
    return together(mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))), columns)
