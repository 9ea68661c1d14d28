"""Byte-level BPE, alignment and periodic runs against the tokenizers themselves and plain Python."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, byte_bpe, periodic
from tidemark.llm.blocks import blocks_of, packed, stretches, unpacked
from tidemark.llm.hashing import text_buffers, word_hashes
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DDL = "doc_id long, text string"
ALPHABET = "abcXY  \n\t\r\x1c\x1f 0123.,;!?'\"<|>endoftext áéÀßœŒσİ漢字̈\xa0\x85\u2003\u3000▁ —’…😀\x00\x01\x7f½"
ODD = [
    None, "", " ", "  ", "   ", "\n", " \n ", "\n  \n a", "a  b", "a   b", "x ", "x  ", "x\n  y", "x \ny", "x\u2003 y", "x\x85 \x85 y", "<s> </s> <unk> <0x41>",
    "<|endoftext|> a<|endoftext|>b", "it's I'll we'VE 's", "▁a ▁", "ﬁ Ａ", "x" * 5000, "ab" * 3000 + " c", " " * 3000, "\r\n);\r ;\r\n", "\x00\x1c\x1f z", "😀" * 50,
]


def odd_texts(n=400):
    rng = random.Random(11)
    return ODD + ["".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(n)]


def frame(spark, texts, ddl=DDL):
    return spark.createDataFrame(list(enumerate(texts)), ddl)


def sha(value) -> str:
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


# ---- blocks


def test_blocks_hold_all_rows_in_order():
    texts = ["a" * (i % 7) for i in range(100)] + [None, "b" * 500, ""]
    batches = pa.table({"i": list(range(len(texts))), "t": texts}).to_batches(9)
    found = list(blocks_of(batches, 40))
    assert [i for ids, _ in found for i in ids.to_pylist()] == list(range(len(texts)))
    assert [t for _, own in found for t in own.to_pylist()] == [t or "" for t in texts]
    assert all(len(ids) == 1 or sum(map(len, own.to_pylist())) <= 40 for ids, own in found)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=20), max_size=6))
def test_stretches_begin_at_spaces_behind_other_characters(texts):
    distinct, at, first = stretches(pa.array(texts, pa.large_string()))
    strings = distinct.to_pylist()
    own = [[strings[c] for c in at[a:b]] for a, b in zip(first[:-1], first[1:])]
    white = "\\s\x1c-\x1f"
    assert own == [[s for s in re.split(rf"(?<=[^{white}])(?= )", t) if s] for t in texts]


def test_packed_numbers_come_back():
    for top in (1, 200, 70_000, 1 << 31):
        numbers = np.random.default_rng(1).integers(0, top, 1000)
        assert (unpacked(packed(numbers), 1000) == numbers).all()
    assert len(unpacked(packed(np.zeros(0, np.int64)), 0)) == 0


# ---- byte-level BPE


def bpe(df, **how):
    return byte_bpe.decode(byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, **how), RANKS)


def test_ids_and_bytes_of_odd_texts(spark):
    texts = odd_texts()
    own = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for size in (1 << 25, 300):
        got = {r.doc_id: r for r in bpe(frame(spark, texts).repartition(3), block_bytes=size).collect()}
        assert len(got) == len(texts)
        for i, text in enumerate(texts):
            assert got[i].ids == own.encode_ordinary(text or ""), text
            assert bytes(got[i].decoded) == (text or "").encode()


def test_words_of_every_character_are_those_of_the_tokenizer():
    """The patterns of two libraries agree on all assigned characters, between letters and at a space."""
    own, match = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN), byte_bpe.word_pattern(public_tokenizers.PATTERN)
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    wrong = []
    for i in range(0, len(chars), 1000):
        text = "".join(f"a{c}b {c}{c} 1{c}  " for c in chars[i : i + 1000])
        if own.encode_ordinary(text) != [x for w in match.findall(text) for x in own.encode_ordinary(w)]:
            wrong += [c for c in chars[i : i + 1000] for t in [f"a{c}b {c}{c} 1{c}  "] if own.encode_ordinary(t) != [x for w in match.findall(t) for x in own.encode_ordinary(w)]]
    assert [hex(ord(c)) for c in wrong] == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_words_make_up_the_texts(texts):
    found = byte_bpe.Words(pa.array(texts, pa.large_string()), byte_bpe.word_pattern(public_tokenizers.PATTERN))
    codes, ends = found.codes(), np.concatenate([[0], np.cumsum(found.counts)]).astype(int)
    assert ["".join(found.words[c] for c in codes[a:b]) for a, b in zip(ends[:-1], ends[1:])] == texts
    assert len(set(found.words)) == len(found.words)
    assert (np.diff(np.bincount(codes)) <= 0).all()


def test_each_distinct_word_is_encoded_once(spark):
    plan = byte_bpe.encode(frame(spark, ["a"]), RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[word#\d+ ASC", plan) and re.search(r"hashpartitioning\(word#\d+", plan)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, "one two", "x"), (2, None, "x"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string").withColumns({c: F.lit(1) for c in ("block", "word", "code", "decoded")})
    got = sorted((r.doc_id or 0, bytes(r.decoded)) for r in bpe(df).collect())
    assert got == [(0, b"one two"), (1, b"one two"), (1, b"one two"), (2, b""), (2, b"")]
    assert bpe(df.where("doc_id > 5")).collect() == []


def test_decode_passes_on_other_columns_and_null_ids(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, [], "l"), (3, [0, 5, 300], "m")], "a int, ids array<int>, b string")
    table = byte_bpe.token_bytes(RANKS)
    got = byte_bpe.decode(df, RANKS).collect()
    assert [(r.a, r.b, r.decoded) for r in got] == [
        (1, "k", None), (2, "l", b""), (3, "m", b"".join(table[i].as_py() for i in (0, 5, 300))),
    ]
    with pytest.raises(Exception, match="not in the token-byte table|out of bounds"):
        byte_bpe.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), RANKS).collect()


def test_one_unbroken_string_and_one_very_long_text(spark):
    texts = ["".join(f"q{i}Z" for i in range(200_000)), "ab" * 20_000, " ".join(f"w{i}" for i in range(200_000))]
    own = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r.ids for r in byte_bpe.encode(frame(spark, texts), RANKS, public_tokenizers.PATTERN).collect()}
    assert [got[i] for i in range(3)] == [own.encode_ordinary(t) for t in texts]


# ---- alignment


class Plain:
    """The same by whole texts and Python loops."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.chars = {c: b for c, b in alignment._byte_of_char().items()}

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        in_a = [bytes(self.chars[c] for c in self.a.id_to_token(i)) for i in a]
        names = [self.b.id_to_piece(i) for i in b]
        in_b = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x..>", n) else n.replace("▁", " ").encode() for n in names]
        if not text or not b"".join(in_a) == b"".join(in_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(t) for t in in_a]), np.cumsum([len(t) for t in in_b])
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            to_a, to_b = x, y
            while to_a < len(a) and ends_a[to_a] <= end:
                to_a += 1
            while to_b < len(b) and ends_b[to_b] <= end:
                to_b += 1
            groups.append((a[x:to_a], b[y:to_b]))
            x, y = to_a, to_b
        return groups

    def table(self, texts):
        groups = [self.tokens(t or "") for t in texts]
        links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
        counts = Counter(p for own in links for p in set(own))
        best = defaultdict(int)
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        for g, own in zip(groups, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            yield (
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
                sum(counts[p] == best[p[0]] for p in own), sum(counts[p] for p in own), sha(text) if g else "",
            ), text


COUNTED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def odd_alignment():
    texts = [t for t in odd_texts(200) if t is None or len(t) < 4000]
    return texts, list(Plain().table(texts))


@pytest.mark.parametrize("block_bytes, batch_bytes, wide", [(1 << 24, 1 << 21, 4096), (500, 100, 2)])
def test_links_of_odd_texts(spark, odd_alignment, monkeypatch, block_bytes, batch_bytes, wide):
    texts, want = odd_alignment
    monkeypatch.setattr(alignment, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(alignment.links_of, "__defaults__", (wide,))
    ids = pa.array(range(len(texts)))
    sides = alignment.ByteLevel(A_PATH), alignment.Pieces(B_PATH)
    numbers, groups, *_ = alignment._aligned(ids, pa.array([t or "" for t in texts], pa.large_string()), *sides, alignment._labels(51_000), True)
    assert [g.decode() for g in groups] == [text for _, text in want]
    assert numbers[:, :4].tolist() == [list(w[:4]) for w, _ in want]
    got = {r.doc_id: r for r in alignment.link_counts(frame(spark, texts).repartition(3), A_PATH, B_PATH, block_bytes=block_bytes).collect()}
    assert [tuple(got[i][c] for c in COUNTED) for i in range(len(texts))] == [w for w, _ in want]
    written = {r.doc_id: r.groups for r in alignment.align(frame(spark, texts), A_PATH, B_PATH, block_bytes=block_bytes).collect()}
    assert [written[i] for i in range(len(texts))] == [text for _, text in want]


def test_a_text_one_side_does_not_give_back_has_no_tokens(spark):
    got = {r.doc_id: r for r in alignment.link_counts(frame(spark, ["a ▁ b", "a b", None, ""]), A_PATH, B_PATH).collect()}
    for i in (0, 2, 3):
        assert [got[i][c] for c in COUNTED] == [0, 0, 0, 0, 0, 0, ""]
    assert got[1].n_groups == 2 and got[1].n_links == 2 and got[1].n_overlaps == 2 and got[1].count_sum == 2


def test_links_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    got = [tuple(r[c] for c in COUNTED) for r in QUERIES["op12_alignment"](spark, SF).orderBy("doc_id").collect()]
    assert got == [w for w, _ in Plain().table(texts)]


def test_alignment_of_awkward_tables(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (None, None)]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit(1) for c in ("block", "pair", "code", "n_a", "groups")})
    got = alignment.link_counts(df, A_PATH, B_PATH).collect()
    # Every row counts as a document.
    assert Counter((r.doc_id, r.n_links, r.count_sum, r.n_best) for r in got) == {(1, 2, 6, 2): 2, (None, 2, 6, 2): 1, (None, 0, 0, 0): 1}
    assert alignment.link_counts(df.where("doc_id > 9"), A_PATH, B_PATH).collect() == []
    assert alignment.align(df.where("doc_id > 9"), A_PATH, B_PATH).collect() == []


def test_wide_groups_are_paired_by_distinct_ids():
    rng = np.random.default_rng(3)
    group_a, group_b = np.sort(np.append(rng.integers(0, 5, 60), range(5))), np.sort(np.append(rng.integers(0, 5, 70), range(5)))
    a, b = rng.integers(0, 4, 65), rng.integers(0, 4, 75)
    want = Counter((g, x, y) for g, x in zip(group_a.tolist(), a.tolist()) for h, y in zip(group_b.tolist(), b.tolist()) if g == h)
    for wide in (0, 100, 10**6):
        got = Counter()
        for g, x, y, n in zip(*(v.tolist() for v in alignment.links_of(group_a, a, group_b, b, wide))):
            got[g, x, y] += n
        assert got == want


# ---- periodic runs


def plain_runs(words, least_words=6, least_periods=4):
    """All runs by comparing the words at every distance."""
    found = {}
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_periods * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def found_runs(texts):
    hashes, first = word_hashes(*text_buffers(pa.array(texts, pa.string())))
    out = [[] for _ in texts]
    for t, *run in periodic.find(hashes, first).tolist():
        out[t].append(tuple(run))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abc"), max_size=90), max_size=4))
def test_runs_of_few_letters(texts):
    assert found_runs([" ".join(t) for t in texts]) == [plain_runs(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_nested_and_neighbouring_runs(data):
    def repeated(depth):
        unit = data.draw(st.lists(st.sampled_from("abcd"), min_size=1, max_size=4))
        if depth:
            unit = unit + repeated(depth - 1)
        return unit * data.draw(st.integers(1, 6)) + data.draw(st.lists(st.sampled_from("abcd"), max_size=3))

    words = repeated(2) + repeated(1)
    assert found_runs([" ".join(words)]) == [plain_runs(words)]


def test_runs_and_collapsed_texts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "a a a a a", "a\na\ta a a  a", "x a b a b a b a b y", "a b a b a b a", "A a A a a a a a a a"]
    texts += [" ".join(rng.choices("ab", k=rng.randrange(200))) for _ in range(20)] + ["é \x1c é \x1c é \x1c é \x1c", "漢 " * 8, "z" * 100_000]
    got = {r.doc_id: r for r in periodic.find_runs(frame(spark, texts).repartition(3)).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^ \t-\r]+", text or "")
        runs = plain_runs(words)
        assert [tuple(r) for r in got[i].runs] == runs, text
        assert got[i].n_words == len(words) and got[i].collapsed == collapse(words, runs)


def test_a_text_of_one_word_and_a_long_text_take_little_time(spark):
    n = 400_000
    texts = ["w " * n, " ".join(f"{i % 997}" for i in range(n)), " ".join(f"{i}" for i in range(n))]
    got = {r.doc_id: r for r in periodic.find_runs(frame(spark, texts)).collect()}
    assert [[tuple(r) for r in got[i].runs] for i in range(3)] == [[(0, n, 1)], [(0, n, 997)], []]
    assert got[0].collapsed == "w"


def test_runs_of_awkward_tables(spark):
    rows = [(1, "a " * 9), (1, "a " * 9), (None, "a " * 9), (2, None)]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit(1) for c in ("runs", "collapsed", "n_words")})
    assert Counter((r.doc_id, len(r.runs), r.collapsed) for r in periodic.find_runs(df).collect()) == {
        (1, 1, "a"): 2, (None, 1, "a"): 1, (2, 0, ""): 1,
    }
    assert periodic.find_runs(df.where("doc_id > 9")).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(df, least_periods=3)


def test_query_of_runs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    n_runs = 0
    for r in docs:
        words = re.findall(r"[^ \t-\r]+", r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2500:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        exponent = 1000 * best[1] // best[2] if runs else None
        want = (r.doc_id, len(runs), *best, exponent, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapse(words, runs)))
        assert tuple(got[r.doc_id]) == want
        n_runs += len(runs)
    assert n_runs > 0
