"""SentencePiece encoding by a table of prefixes, for merge-type (BPE) models.

A sequence of pieces is what merging ends with if, and only if, each piece is what merging
its own characters gives and no two neighbours would have been merged across their border.
So every prefix of a text has exactly one possible last piece: among the pieces that end
there, the one that is compatible with the last piece of the prefix before it. All pieces
at all places are found by stepping a trie automaton from every character at once; the
table is filled from short prefixes to long ones; ids are read backwards from its end.

Two neighbours are tested by undoing their merges from the latest on: at each moment both
have a piece at the border, and if merging those two would have come before the next merge
on either side (equal merges go from left to right), the border would not be there.

Where no piece of the model runs from other characters on into a space mark, a text falls
apart before every run of space marks, and each distinct such unit of a slice is encoded
once. Characters without a piece stand for their UTF-8 bytes. Arrays hold all units of a
slice side by side; a worker remembers the ids of the first CACHED units it meets.

Defined cases: a null text is an empty one, which is its begin and end ids; repeated rows
and null doc_ids are returned as given; a very long text is encoded whole, as a slice of its
own, in memory that grows with it; an empty table gives no rows; other columns are not read.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from martwright.llm.common import DistinctIds, binary_array, gather, text_slices

SPACE = "▁"
CACHED = 300_000
_BREAK = "\x00"
_UNIT_CHARS = 400_000
_SLICE = 4_000_000
_DECODED = 100  # documents decoded at once
_FIRST, _UNKNOWN = -2, -3  # in place of a last piece
_NEVER = np.int64(1) << 40


class _Table:
    """A fixed map of non-negative integers, looked up for whole arrays."""

    def __init__(self, entries: dict[int, int]):
        keys = np.fromiter(entries.keys(), np.int64, len(entries))
        values = np.fromiter(entries.values(), np.int64, len(entries))
        self.bits = max(len(keys) * 4, 2).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is not there."""
        slot = self._slot(keys)
        there = self.keys[slot]
        found = np.where(there == keys, self.values[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found


class Model:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.get_piece_size()
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        special = [
            lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)
            for i in range(size)
        ]
        pieces = {lib.id_to_piece(i): i for i in range(size) if not special[i]}
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        # Merges by falling score; single characters come before all.
        longer = sorted((p for p in pieces if len(p) > 1), key=lambda p: (-lib.get_score(pieces[p]), pieces[p]))
        self.rank = np.full(size, -1, np.int64)
        self.rank[[pieces[p] for p in longer]] = np.arange(len(longer))
        self.length = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        pairs: dict[int, int] = {}
        for piece in longer:
            for cut in range(1, len(piece)):
                left, right = pieces.get(piece[:cut]), pieces.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = pieces[piece]
        whole = []
        for piece, i in pieces.items():
            self.length[i] = len(piece)
            if len(piece) == 1 or self._merges(piece, i, pieces):
                whole.append(piece)
        self.pairs = _Table(pairs)
        # A trie of the pieces that merging can make.
        children: dict[int, int] = {}
        ends = [-1]
        for piece in whole:
            node = 0
            for char in piece:
                key = node << 21 | ord(char)
                if key not in children:
                    children[key] = len(ends)
                    ends.append(-1)
                node = children[key]
            ends[node] = pieces[piece]
        self.trie, self.ends = _Table(children), np.array(ends, np.int64)
        self.splits = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        self.tested = np.full(1 << 20, -1, np.int64)
        self.outcome = np.zeros(1 << 20, dtype=bool)
        self.distinct = DistinctIds(self.encode_units, CACHED)

    def _merges(self, piece: str, own: int, pieces: dict[str, int]) -> bool:
        """Whether merging the piece's characters ends in the piece; notes its last merge."""
        parts = list(piece)
        while len(parts) > 1:
            ranked = [
                (self.rank[pieces[a + b]], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                if a + b in pieces
            ]
            if not ranked:
                return False
            _, i = min(ranked)
            if len(parts) == 2:
                left, right = pieces.get(parts[0]), pieces.get(parts[1])
                if left is None or right is None:
                    return False
                self.left[own], self.right[own] = left, right
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return True

    def _compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the border between two pieces that merging has made stays."""
        left, right = first.copy(), second.copy()
        # Ranks of the merges that use up the pieces at the border.
        left_until = np.full(len(first), _NEVER)
        right_until = left_until.copy()
        stays = np.ones(len(first), dtype=bool)
        open_ = np.arange(len(first))
        while len(open_):
            a, b = left[open_], right[open_]
            merged = self.pairs.get(a << 20 | b)
            rank = np.where(merged >= 0, self.rank[merged], _NEVER)
            crossed = (rank < left_until[open_]) & (rank <= right_until[open_]) & (merged >= 0)
            stays[open_[crossed]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            undo_left = rank_a > rank_b
            at = open_[undo_left]
            left_until[at], left[at] = rank_a[undo_left], self.right[a[undo_left]]
            undo_right = ~undo_left & (rank_b >= 0)
            at = open_[undo_right]
            right_until[at], right[at] = rank_b[undo_right], self.left[b[undo_right]]
            open_ = open_[~crossed & (undo_left | undo_right)]
        return stays

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """_compatible, with the latest outcomes at hand."""
        key = first << 20 | second
        slot = ((key * 0x9E3779B1) >> 12) & (len(self.tested) - 1)
        result = self.outcome[slot]
        new = np.flatnonzero(self.tested[slot] != key)
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            found = self._compatible(keys >> 20, keys & ((1 << 20) - 1))[back]
            result[new] = found
            # Of those that share a slot one stays, key and outcome of the same pair.
            where = slot[new]
            self.tested[where] = key[new]
            kept = self.tested[where] == key[new]
            self.outcome[where[kept]] = found[kept]
        return result

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(u) for u in units], np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        unit = np.repeat(np.arange(len(units)), sizes)
        until = ends[unit]
        # Pieces at all places: a trie step for all places that are still inside the trie.
        begin, piece = [], []
        place = np.arange(len(chars))
        node = np.zeros(len(chars), np.int64)
        depth = 0
        while len(place):
            node = self.trie.get(node << 21 | chars[place + depth])
            alive = node >= 0
            if depth == 0:
                known = self.ends[np.maximum(node, 0)] >= 0
                unknown = place[~(alive & known)]
                begin.append(unknown)
                piece.append(np.full(len(unknown), _UNKNOWN))
            place, node = place[alive], node[alive]
            made = self.ends[node]
            begin.append(place[made >= 0])
            piece.append(made[made >= 0])
            depth += 1
            inside = place + depth < until[place]
            place, node = place[inside], node[inside]
        begin, piece = np.concatenate(begin), np.concatenate(piece)
        length = np.where(piece >= 0, self.length[np.maximum(piece, 0)], 1)
        # Borders: a unit has one more than it has characters.
        border = begin + unit[begin]
        first_border = ends - sizes + np.arange(len(units))
        reach = begin + length - (ends - sizes)[unit[begin]]
        order = np.argsort(reach.astype(np.int32), kind="stable")
        border, piece, length, reach = border[order], piece[order], length[order], reach[order]
        last = np.full(len(chars) + len(units), -1, np.int64)
        step = np.zeros(len(last), np.int64)
        number = np.zeros(len(last), np.int64)
        last[first_border] = _FIRST
        groups = np.flatnonzero(np.diff(reach, prepend=0))
        for low, high in zip(groups, [*groups[1:], len(reach)], strict=True):
            start, own = border[low:high], piece[low:high]
            before = last[start]
            fits = before != -1
            test = np.flatnonzero((before >= 0) & (own >= 0))
            fits[test] = self.compatible(before[test], own[test])
            start, own, size = start[fits], own[fits], length[low:high][fits]
            last[start + size], step[start + size] = own, size
            number[start + size] = number[start] + 1
        final = first_border + sizes
        counts = number[final]
        total = np.cumsum(counts)
        tokens, at_char = np.zeros(total[-1], np.int64), np.zeros(total[-1], np.int64)
        active, here, slot = np.flatnonzero(counts), final.copy(), total - 1
        while len(active):
            now = here[active]
            tokens[slot[active]] = last[now]
            here[active] = now - step[now]
            at_char[slot[active]] = here[active] - active
            slot[active] -= 1
            active = active[here[active] > first_border[active]]
        return self._spell(tokens, chars[at_char] if len(chars) else at_char, counts)

    def _spell(self, tokens, chars, counts) -> tuple[np.ndarray, np.ndarray]:
        """Ids with bytes in place of characters that have no piece."""
        unknown = np.flatnonzero(tokens < 0)
        if not len(unknown):
            return tokens.astype(np.uint32), counts
        spelled = [chr(c).encode() for c in chars[unknown].tolist()]
        sizes = np.ones(len(tokens), np.int64)
        sizes[unknown] = [len(s) for s in spelled]
        ids = np.repeat(tokens, sizes).astype(np.uint32)
        starts = np.cumsum(sizes) - sizes
        flat = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        ids[np.repeat(tokens < 0, sizes)] = flat
        total = np.concatenate([starts, [len(ids)]])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[edges])

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, first, size = [], 0, 0
        for i, unit in enumerate(units):
            size += len(unit)
            if size >= _UNIT_CHARS or i == len(units) - 1:
                parts.append(self._encode(units[first : i + 1]))
                first, size = i + 1, 0
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([n for _, n in parts])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts with begin and end ids, and the number of ids of each."""
        # A text that is not empty gets a space mark in front.
        marked = pc.replace_substring_regex(texts, "(?s)\\A(.)", f"{SPACE}\\1")
        marked = pc.replace_substring(marked, " ", SPACE)
        if self.splits:
            # No text with the break's own character is split.
            whole = pc.match_substring(texts, _BREAK)
            apart = pc.replace_substring_regex(marked, f"([^{SPACE}]){SPACE}", f"\\1{_BREAK}{SPACE}")
            units = pc.split_pattern(pc.if_else(whole, "", apart), _BREAK)
            if pc.any(whole).as_py():
                lists, texts_ = units.to_pylist(), marked.to_pylist()
                for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
                    lists[i] = [texts_[i]]
                units = pa.array(lists, pa.list_(pa.large_string()))
        else:
            units = pa.array([[t] for t in marked.to_pylist()], pa.list_(pa.large_string()))
        sizes = units.value_lengths().to_numpy().astype(np.int64)
        coded = units.flatten().dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        flat, starts, counts = self.distinct(coded.dictionary.to_pylist())
        lengths = counts[index]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = ends[np.concatenate([[0], np.cumsum(sizes)])]
        ids = gather(flat, starts[index], lengths).astype(np.uint32)
        at = np.stack([edges[:-1], edges[1:]], axis=1).ravel()
        ids = np.insert(ids, at, np.tile([self.begin, self.end], len(texts)).astype(np.uint32))
        return ids, np.diff(edges) + 2


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers, with begin and end ids) and
    decoded, the text the library's decode() gives for them, of `docs` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        model = load(model_path)
        for batch in batches:
            for row, texts in text_slices(batch.column(1), _SLICE):
                ids, counts = model.encode(texts)
                edges = np.concatenate([[0], np.cumsum(counts)])
                decoded: list[str] = []
                for first in range(0, len(texts), _DECODED):
                    part = edges[first : first + _DECODED + 1]
                    lists = [ids[a:b].tolist() for a, b in zip(part, part[1:], strict=False)]
                    decoded += model.library.decode(lists, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(texts)),
                        binary_array(ids.astype("<u4", copy=False), edges),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    schema = f"doc_id {kind}, ids binary, decoded string"
    return docs.select("doc_id", "text").mapInArrow(task, schema)
