"""Runs of words that repeat with a period, by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, ... words. For each length the factors get
names (equal names for equal factors of one text), a factor of twice the length being the pair of the
names of its halves. The next occurrence of a factor that begins within its own length, so that both
lie within twice that length, proposes their distance as a period; an arithmetic progression of such
occurrences, at neighbouring places, is a stretch that keeps the period. A run of period q shows
itself in the factors of q to 2 q - 1 words, and again in longer ones; equal finds are taken once. Factors that
occur once in their text can't be part of a longer repeated one and are left out from then on.

Words are told apart by 64-bit hashes (`hashing.py`) and compared as they are in every run found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import mix, pieces, text_buffers, word_hashes

# A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUNS = "array<struct<start:long,length:long,period:long>>"


def find(names: np.ndarray, first: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (text, start, length, period) of the runs in texts given as names of their words, ordered.

    Text i has the words first[i] to first[i + 1]. `least_periods` must be 4 or more: then a run has three
    occurrences of a factor that is as long as its period or longer.
    """
    n = np.diff(first)
    of = np.repeat(np.arange(len(n)), n)
    end = first[1:][of]
    place = np.arange(first[0], first[-1])
    base = int(first[0])
    # A word has a name of its own in every text.
    key = mix(names ^ mix(of.astype(np.uint64) + np.uint64(1)))
    found, m = [], 1
    while len(place):
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        gap = np.zeros(len(place), np.int64)
        gap[order[:-1][same]] = (place[order[1:]] - place[order[:-1]])[same]
        gap[gap > m] = 0

        # Neighbouring places of one text with one gap: two or more occurrences in a row, each a period further.
        cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(gap) != 0) | (np.diff(of[place - base]) != 0)) + 1
        begin, stop = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]])
        period = gap[begin]
        start, length = place[begin], stop - begin - 1 + period + m
        good = (period > 0) & (length >= np.maximum(least_words, least_periods * period))
        found.append(np.stack([of[start[good] - base], start[good], length[good], period[good]], 1))

        # Names of the factors that occur again, then those of twice the length.
        repeated = np.zeros(len(place), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        name = np.empty(len(place), np.int64)
        name[order] = np.concatenate([[0], np.cumsum(~same)])
        named = np.full(len(names) + 1, -1, np.int64)
        named[place[repeated] - base] = name[repeated]
        place = place[repeated]
        place = place[place + 2 * m <= end[place - base]]
        second = named[place + m - base]
        place, second = place[second >= 0], second[second >= 0]
        key = (named[place - base] * (len(names) + 1) + second).astype(np.uint64)
        m *= 2
    runs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)
    runs[:, 1] -= first[runs[:, 0]]
    return runs


def _true(runs: np.ndarray, words: list[bytes]) -> bool:
    """Whether the words themselves, not only their hashes, repeat as the runs say."""
    return all(words[s : s + n - q] == words[s + q : s + n] for _, s, n, q in runs.tolist())


def find_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", *, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document.

    Words are the runs of other characters than blanks. `runs` holds every stretch of words (start, length,
    period), numbered from 0, whose smallest period is `period`, that has `least_words` words and `least_periods` periods or more and
    that no neighbouring word extends; ordered by start, then period. `collapsed` is the text's words, joined by one space, without
    those that some run holds after its first period.

    Null, empty and blank texts have no words, no runs and an empty `collapsed`; texts without runs keep all words. Repeated
    rows and rows without an id come back as they are; an empty table gives an empty result; other columns are
    not read. Whole texts are searched, each on its own; the time is n log n in the words of a text, whatever they are.
    """
    if least_periods < 4:
        raise ValueError("least_periods must be 4 or more")
    kind = docs.schema[id_col].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for begin, end in pieces(offsets):
                hashes, first = word_hashes(offsets[begin : end + 1], data)
                runs = find(hashes, first, least_words, least_periods)
                owner = np.searchsorted(runs[:, 0], np.arange(end - begin + 1))
                collapsed = []
                for i in range(end - begin):
                    words = data[offsets[begin + i] : offsets[begin + i + 1]].tobytes().split()
                    own = runs[owner[i] : owner[i + 1]]
                    if len(own):
                        if not _true(own, words):
                            raise RuntimeError("two words share a hash")
                        drop = np.zeros(len(words) + 1, np.int64)
                        np.add.at(drop, own[:, 1] + own[:, 3], 1)
                        np.add.at(drop, own[:, 1] + own[:, 2], -1)
                        words = [words[j] for j in np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()]
                    collapsed.append(b" ".join(words))
                fields = [pa.array(np.ascontiguousarray(runs[:, c])) for c in (1, 2, 3)]
                columns = [
                    batch.column(0).slice(begin, end - begin),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(owner, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                    pa.array(collapsed, pa.binary()).cast(pa.string(), safe=False),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col), F.col(text).cast("string"))
    return rows.mapInArrow(search, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def longest(runs: str = "runs") -> Column:
    """The run with the most words, the first of them, with the smaller period; null if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(
        best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))
    )
