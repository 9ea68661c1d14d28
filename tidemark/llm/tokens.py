"""Token ids of many texts with a lower-casing word BPE, each distinct word encoded once.

The vocabulary drops white space and ends every piece of a word with a mark, so the ids of a text are
those of its words in a row. Words of plain letters, digits and marks are encoded together
with the vocabulary as byte ranks; all others by the tokenizer itself. A test holds
both against the tokenizer over whole texts.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Words kept with their ids; the memory is started anew when there are more.
MEMORY_WORDS = 500_000

_LETTERS = "a-zà-öø-ÿ"
# Words that need the tokenizer itself: other characters, apostrophes, or what may open a special token.
_OTHER = re.compile(rf"[^\x02!-~{_LETTERS}]|'|<\|")
_PIECES = re.compile(rf"([{_LETTERS}]+|[0-9]|[^\x02{_LETTERS}0-9]+)")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SPACE = re.compile("[ \t-\r]+")
_PIECE_END, _WORD_END = "\x01", "\x02"


class WordTokenizer:
    def __init__(self, path: str, end_id: int = 0):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model["end_of_word_suffix"]
        as_byte = _byte_of_char()
        ranks = {}
        for token, rank in model["vocab"].items():
            ended = token.endswith(suffix) and token != suffix
            chars = token[: -len(suffix)] if ended else token
            if all(c in as_byte for c in chars):
                ranks[bytes(as_byte[c] for c in chars) + _PIECE_END.encode() * ended] = rank
        self.ranks = tiktoken.Encoding("words", pat_str=r"[^\x01\x02]+\x01|\x02", mergeable_ranks=ranks, special_tokens={})
        self.word_end = ranks[_WORD_END.encode()]
        self.end_id = end_id
        self._forget()

    def _forget(self):
        # The empty word stands for the end of a text.
        self.codes: dict[str, int] = {"": 0}
        self.ids, self.starts, self.lengths = array("I", [self.end_id]), array("q", [0]), array("q", [1])

    def _add(self, word: str, ids) -> None:
        self.codes[word] = len(self.starts)
        self.starts.append(len(self.ids))
        self.lengths.append(len(ids))
        self.ids.extend(ids)

    def _learn(self, words: list[str]) -> None:
        joined = _WORD_END.join(words).lower()
        plain, lowered = words, joined.split(_WORD_END)
        others, at = set(), -1
        for m in _OTHER.finditer(joined):
            if m.start() >= at:
                at = joined.find(_WORD_END, m.end())
                at = len(joined) if at < 0 else at
                others.add(joined[joined.rfind(_WORD_END, 0, m.start()) + 1 : at])
        if others or len(lowered) != len(words):
            if len(lowered) != len(words):
                lowered, others = words, set(words)
            for word, low in zip(words, lowered, strict=True):
                if low in others:
                    self._add(word, self.slow.encode(word, add_special_tokens=False).ids)
            plain = [word for word, low in zip(words, lowered, strict=True) if low not in others]
            joined = _WORD_END.join(plain).lower()
        if not plain:
            return
        ids = np.array(self.ranks.encode_ordinary(_PIECES.sub(r"\1" + _PIECE_END, joined) + _WORD_END), np.uint32)
        ends = np.flatnonzero(ids == self.word_end)
        at, first = len(self.starts), len(self.ids)
        begins = np.concatenate([[0], ends[:-1] + 1])
        lengths = ends - begins
        self.ids.frombytes(ids[ids != self.word_end].tobytes())
        self.starts.frombytes((first + np.concatenate([[0], np.cumsum(lengths)[:-1]])).astype(np.int64).tobytes())
        self.lengths.frombytes(lengths.astype(np.int64).tobytes())
        self.codes.update(zip(plain, range(at, at + len(plain)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with the end id behind it; where each text begins, and the end)."""
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = [w for w in _SPACE.split(text) if w] if _ODD_SPACE.search(text) else text.split()
            words += own
            words.append("")
            counts[i] = len(own) + 1
        if len(self.codes) > MEMORY_WORDS:
            self._forget()
        code = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(code < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys([words[i] for i in unknown])))
            code[unknown] = [self.codes[words[i]] for i in unknown]
        length = np.frombuffer(self.lengths, np.int64)[code]
        start = np.frombuffer(self.starts, np.int64)[code]
        ends = np.cumsum(length)
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends[np.cumsum(counts) - 1]]).astype(np.int64)


@lru_cache(maxsize=1)
def word_tokenizer(path: str, end_id: int = 0) -> WordTokenizer:
    """The tokenizer of this Python process: tasks that run in it one after another share the words they have learnt.

    What it gives does not depend on them. A process whose task failed is not used again.
    """
    return WordTokenizer(path, end_id)


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
