"""Token ids of whole texts by a tokenizer file whose pre-tokenizer drops white space.

Such a tokenizer treats what lies between white space on its own, and letters apart from
marks, so a plain word (letters, marks, or letters and then marks) is taken as its letters,
A-Z lower-cased, and its marks. Each distinct unit of a slice is encoded once by the
library and its ids are put in place for every occurrence. Plain units go to the library
in lines: the ids that end a pre-token show where a unit's ids end. Other words stay whole
and go in lines with a mark between them, and those that hold the mark's character alone.
A worker keeps the ids of the first CACHED distinct units it meets.
"""

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from martwright.llm.common import DistinctIds, Words, gather, release_memory, text_list

MARK = "\x7f"
CACHED = 300_000
_LINE_WORDS = 2000
# Letters that lower-casing and composition leave letters; marks the tokenizer keeps together.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,;:!?|#$%&*()\-]*)").fullmatch

# The same by UTF-8 bytes: letters, where those of À to ÿ are C3 and a byte from 80 on.
_LETTER, _MARK, _SPACE, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:0xC0] = _KIND[0xC3] = _LETTER
_KIND[list(b".,;:!?|#$%&*()-")] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class _Units(Words):
    """Words, of which plain ones with letters and marks are two units."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts)
        if not len(self):
            return
        kind, data = _KIND[self.data], self.data
        mark, other = kind == _MARK, kind == _OTHER
        # A letter after a mark; and the bytes of × and ÷, which are no letters.
        other[1:] |= mark[:-1] & (kind[1:] == _LETTER)
        other[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        # Neither is white space, so each lies in the word that begins last before it.
        plain = np.ones(len(self), dtype=bool)
        plain[np.searchsorted(self.starts, np.flatnonzero(other), "right") - 1] = False
        marked = np.searchsorted(self.starts, np.flatnonzero(mark), "right") - 1
        marks = np.bincount(marked, minlength=len(self))
        cut = self.ends - marks
        both = plain & (marks > 0) & (cut > self.starts)
        self.data = _LOWER[data]
        odd = np.flatnonzero(~plain)
        places = np.arange(len(data), dtype=np.int32 if len(data) < 2**31 else np.int64)
        at = gather(places, self.starts[odd], (self.ends - self.starts)[odd])
        self.data[at] = data[at]
        place = np.arange(len(self)) + np.cumsum(both) - both
        total = len(self) + int(both.sum())
        starts, ends = np.empty((2, total), np.int64)
        starts[place], ends[place] = self.starts, np.where(both, cut, self.ends)
        second = place[both] + 1
        starts[second], ends[second] = cut[both], self.ends[both]
        self.starts, self.ends = starts, ends
        self.first = np.append(place, total)[self.first]
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.counts)


class _Tokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        mark = self.one(MARK)
        apart = self.one(f"a {MARK} a\n{MARK}")
        if len(mark) != 1 or apart.count(mark[0]) != 2:
            raise ValueError(f"{path} does not drop white space or splits the mark")
        self.mark = mark[0]
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.distinct = DistinctIds(self.encode, CACHED)

    def one(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def lines(self, words: list[str], between: str) -> np.ndarray:
        lines = [
            between.join([*words[i : i + _LINE_WORDS], ""])
            for i in range(0, len(words), _LINE_WORDS)
        ]
        encoded = self.library.encode_batch_fast(lines, add_special_tokens=False)
        parts = [np.array(line.ids, dtype=np.uint32) for line in encoded]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words and the number of each word's ids."""
        plain, parts, other = [], [], []
        for i, word in enumerate(words):
            match = _PLAIN(word)
            if match:
                plain.append(i)
                parts.append((match[1] != "") + (match[2] != ""))
            else:
                other.append(i)
        flat = self.lines([words[i] for i in plain], " ")
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        last = np.concatenate([[0], ends])[np.cumsum(parts, dtype=np.int64)]
        counts = np.zeros(len(words), np.int64)
        counts[plain] = np.diff(last, prepend=0)
        marked = [i for i in other if MARK not in words[i]]
        more = self.lines([words[i] for i in marked], f" {MARK} ")
        at = np.flatnonzero(more == self.mark)
        counts[marked] = np.diff(at, prepend=-1) - 1
        alone = [i for i in other if MARK in words[i]]
        single = [np.array(self.one(words[i]), dtype=np.uint32) for i in alone]
        counts[alone] = [len(ids) for ids in single]
        order = np.array([*plain, *marked, *alone], dtype=np.int64)
        flat = np.concatenate([flat, np.delete(more, at), *single])
        lengths = counts[order]
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(lengths) - lengths
        return gather(flat, starts, counts), counts


@lru_cache(maxsize=4)
def load(path: str) -> _Tokenizer:
    return _Tokenizer(path)


def forget() -> None:
    """Drop what a worker holds of tokenizers, before work that needs none."""
    load.cache_clear()
    release_memory()


def token_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, one after the other, and the number of ids of each text."""
    units = _Units(texts)
    index, distinct = units.encoded()
    flat, starts, counts = load(path).distinct(text_list(distinct))
    lengths = counts[index]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    per_text = ends[units.first[1:]] - ends[units.first[:-1]]
    return gather(flat, starts[index], lengths), per_text
