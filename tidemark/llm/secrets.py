"""Secret scans: three kinds by pattern, and strings of high entropy.

Built-in functions only. Where a pattern matches follows from the lengths of the pieces
between its matches (`split`) and of the matches themselves (`regexp_extract_all`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import apart, together

# Kinds in their order, and what they match.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
MIN_VALUE = 8

# Candidates of the entropy rule: long strings that hold a digit.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Least bits per character of some window, by the characters of the whole candidate.
CLASSES = (("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.7), ("", 3.9))
# Never secrets: no digit or no letter, UUIDs, dashed or slashed words, counting and filler strings.
ALLOWED = (
    r"^[^0-9]*$|^[^A-Za-z]*$"
    r"|^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    r"|^/?(?:[A-Za-z]*+[0-9]{0,4}[-_/=+])*+[A-Za-z]*+[0-9]{0,4}$"
    r"|0123456789|123456789|(?i:abcdefgh|example|xxxx|placeholder|your_)"
)
MASK = "[secret]"

SPAN = "struct<start:int,kind:int,end:int>"
# A stretch of text that stays, and how many characters behind it go.
PIECE = "struct<from:int,to:int,gone:int>"
# Arrays grow in blocks of so many elements, and texts are cut into blocks of so many characters, so that
# neither is copied or searched from its start once for each match.
GROWTH = 64
BLOCK = 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _walk(items: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]], kind: str) -> Column:
    """Walk over an array with a position that starts at 0: a struct of the last position `at` and all that was put `out`.

    `step` of position and element gives the next position, whether to put something out, and what.
    """

    def one(acc: Column, x: Column) -> Column:
        at, keep, out = step(acc["at"], x)
        return F.struct(at.alias("at"), F.when(keep, F.concat(acc["out"], F.array(out))).otherwise(acc["out"]).alias("out"))

    def empty(of: str) -> Column:
        return F.array().cast(f"array<{of}>").alias("out")

    def whole(items: Column) -> Column:
        def block(acc: Column, k: Column) -> Column:
            part = F.slice(items, k * GROWTH + 1, F.lit(GROWTH))
            done = F.aggregate(part, F.struct(acc["at"].alias("at"), empty(kind)), one)
            return _let(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / GROWTH).cast("int"))
        zero = F.struct(F.lit(0).alias("at"), empty(f"array<{kind}>"))
        return F.aggregate(blocks, zero, block, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))

    return _let(items, whole)


def _spans(text: Column, pattern: str, kind: int, value: int | None = None, texts: bool = False) -> Column:
    """The spans of all matches, as an array of (start, kind, end) in code points; with `texts`, also what matched.

    With `value`, only those whose group of that number has MIN_VALUE characters or more.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else hits
    matches = F.filter(
        F.zip_with(
            gaps,
            F.zip_with(hits, values, lambda m, v: F.struct(m.alias("m"), F.length(v).alias("v"))),
            lambda g, m: F.struct(F.length(g).alias("g"), m["m"].alias("m"), m["v"].alias("v")),
        ),
        lambda x: x["m"].isNotNull(),
    )

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start, end = at + x["g"], at + x["g"] + F.length(x["m"])
        span = [start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")]
        return end, x["v"] >= (MIN_VALUE if value else 0), F.struct(*span, *([x["m"].alias("s")] if texts else []))

    shape = SPAN.replace(">", ",s:string>") if texts else SPAN
    none = F.array().cast(f"array<{shape}>")
    return F.when(text.rlike(pattern), _walk(matches, step, shape)["out"]).otherwise(none)


def _written_over(text: Column, spans: Column, put: Callable[[Column], Column], each: bool) -> Column:
    """The text with `put` of a number of characters in place of those that the ordered spans cover.

    With `each`, a span that begins inside an earlier one belongs to it, however far it goes on; without, what it covers
    beyond is put for itself. The text is cut into blocks once, and each piece that stays is taken from its blocks.
    """

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        to = F.greatest(at, x["start"])
        piece = F.struct(at.alias("from"), to.alias("to"), (x["end"] - to).alias("gone"))
        return F.greatest(at, x["end"]), x["start"] >= at if each else x["end"] > at, piece

    def pieces(blocks: Column, start: Column, end: Column) -> Column:
        def cut(k: Column) -> Column:
            first = F.greatest(start - k * BLOCK, F.lit(0))
            return F.substring(F.get(blocks, k), first + 1, F.least(end - k * BLOCK, F.lit(BLOCK)) - first)

        numbers = F.sequence(F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int"))
        return F.when(end > start, F.transform(numbers, cut)).otherwise(F.array().cast("array<string>"))

    def joined(blocks: Column) -> Column:
        def parts(walked: Column) -> Column:
            kept = F.transform(walked["out"], lambda p: F.concat(pieces(blocks, p["from"], p["to"]), F.array(put(p["gone"]))))
            return F.array_join(F.concat(F.flatten(kept), pieces(blocks, walked["at"], F.length(text))), "")

        return _let(_walk(spans, step, PIECE), parts)

    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), joined)


def window_bits(string: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of any `window` characters.

    One pass: a character that enters or leaves changes its count, and with it the sum of
    count * log2(count), from which the entropy follows. Counts are an array with a place for each
    different character. Null if the string is shorter.
    """

    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(0.0)

    def counted(counts: Column, place: Column, n: Column) -> Column:
        return F.concat(F.slice(counts, F.lit(1), place - 1), F.array(n), F.slice(counts, place + 1, F.size(counts)))

    def enter(acc: Column, x: Column) -> Column:
        n = F.get(acc["counts"], x["enters"] - 1)
        return F.struct(
            counted(acc["counts"], x["enters"], n + 1).alias("counts"),
            (acc["sum"] + weight(n + 1) - weight(n)).alias("sum"),
            acc["least"].alias("least"),
            (acc["n"] + 1).alias("n"),
        )

    def leave(acc: Column, x: Column) -> Column:
        n = F.get(acc["counts"], x["leaves"] - 1)
        return F.struct(
            counted(acc["counts"], x["leaves"], n - 1).alias("counts"),
            (acc["sum"] - weight(n) + weight(n - 1)).alias("sum"),
            acc["least"].alias("least"),
            acc["n"].alias("n"),
        )

    def judge(acc: Column) -> Column:
        full = acc["n"] >= window
        return F.struct(
            acc["counts"].alias("counts"),
            acc["sum"].alias("sum"),
            F.when(full, F.least(acc["least"], acc["sum"])).otherwise(acc["least"]).alias("least"),
            acc["n"].alias("n"),
        )

    def slide(acc: Column, x: Column) -> Column:
        left = F.when(x["leaves"].isNull(), acc).otherwise(leave(acc, x))
        return _let(_let(left, lambda a: enter(a, x)), judge)

    def over(codes: Column) -> Column:
        # What leaves when a character enters: the one `window` places before it.
        leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), window), codes)
        steps = F.filter(
            F.zip_with(codes, leaving, lambda e, v: F.struct(e.alias("enters"), v.alias("leaves"))), lambda x: x["enters"].isNotNull()
        )
        zero = F.struct(
            F.array_repeat(F.lit(0), F.greatest(F.array_max(codes), F.lit(1))).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(None).cast("double").alias("least"),
            F.lit(0).alias("n"),
        )
        bits = F.aggregate(steps, zero, slide, lambda acc: F.log2(F.lit(float(window))) - acc["least"] / window)
        return F.round(bits, 6)

    def coded(chars: Column) -> Column:
        return _let(F.array_distinct(chars), lambda a: F.transform(chars, lambda c: F.array_position(a, c).cast("int")))

    return _let(_let(F.split(string, "", -1), coded), over)


def looks_random(string: Column) -> Column:
    """Whether a candidate has a window of high entropy for its characters and is not allowed."""
    limit = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        limit = F.when(string.rlike(pattern), F.lit(bits)).otherwise(limit)
    return F.when(string.rlike(ALLOWED), F.lit(False)).otherwise(window_bits(string) >= limit)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_assign, n_access, n_hex, n_entropy, base_sha256, spans, found and masked.

    found is an array of (start, kind, end) in code points, ordered by start, then by
    kind (the place in KINDS); spans says the same as text, kind:start:end with commas.
    base_sha256 is the hash of that text for the three pattern kinds. Matches of one kind
    do not overlap; those of different kinds may, but an entropy span never overlaps another one: candidates
    are what base spans leave of a string, if that is long enough.
    masked is the text with MASK in place of each run of overlapping spans. Null and empty
    texts hold nothing (masked: as they are). Columns of these names are replaced.
    """
    columns = docs.columns
    step = apart(docs, given=F.col(text).cast("string"))
    step = step.withColumn("text", F.coalesce("given", F.lit("")))
    step = step.withColumn("assign", _spans(F.col("text"), ASSIGN, 0, 1))
    step = step.withColumn("access", _spans(F.col("text"), ACCESS, 1))
    step = step.withColumn("hex", _spans(F.col("text"), HEX, 2))
    step = step.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    # Candidates are looked for in what the base spans leave.
    rest = _written_over(F.col("text"), F.col("base"), lambda n: F.repeat(F.lit(" "), n), each=False)
    step = step.withColumn("rest", F.when(F.size("base") > 0, rest).otherwise(F.col("text")))
    step = step.withColumn("candidates", _spans(F.col("rest"), CANDIDATE, 3, texts=True))
    likely = F.filter("candidates", lambda x: F.coalesce(looks_random(x["s"]), F.lit(False)))
    step = step.withColumn("entropy", F.transform(likely, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    step = step.withColumn("found", F.array_sort(F.concat("base", "entropy")))

    def written(spans: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ","
        )

    masked = _written_over(F.col("text"), F.col("found"), lambda n: F.lit(MASK), each=True)
    return together(
        step,
        columns,
        n_assign=F.size("assign").cast("long"),
        n_access=F.size("access").cast("long"),
        n_hex=F.size("hex").cast("long"),
        n_entropy=F.size("entropy").cast("long"),
        base_sha256=F.sha2(written(F.col("base")), 256),
        spans=written(F.col("found")),
        found=F.col("found"),
        masked=F.when(F.size("found") > 0, masked).otherwise(F.col("given")),
    )
