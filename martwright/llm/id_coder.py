"""Adaptive context-mixing range coder for token ids.

Ids are dealt into blocks of about BLOCK ids. Each block starts with the same model, the
segment's table of id frequencies and no contexts, and has its own code words and checksum,
so that any block can be read without the others. Within a block an id's probability mixes
three predictions: the id last seen after the two ids before it (order 2), the id last
seen after the one before it (order 1), and the frequency table (order 0). The weights of
orders 1 and 2 follow how often they have come true in the block; contexts are hashed, so
different ones may share a place. Every bit of code comes from a modelled probability.

All blocks of a segment are coded side by side, one id of each at a time: every step is
a few array operations over the blocks. Integers only, so all machines agree.

A coded segment, little-endian: the four bytes ACM2; number of blocks, of ids, of different
ids and of the frequency table's bytes (unsigned 32-bit); for each block its number of code
words and its checksum (unsigned 32-bit; crc32 of its ids as unsigned 32-bit integers and
then of its code words); the frequency table, zlib over the steps from id to id and then the shares (unsigned 32-bit, the
lowest bytes of all first); the blocks' 16-bit code words.

A segment holds MAX_KINDS different ids at most, of up to 32 bits; more raise ValueError.
"""

import zlib

import numpy as np

MAGIC = b"ACM2"
BLOCK = 1024
#: Blocks coded side by side at most, which bounds the tables' memory.
LANES = 4096
MAX_KINDS = 1 << 17

_CONTEXTS = 1024
_WEIGHT_BITS, _TABLE_BITS = 10, 18
_TOTAL_BITS = _WEIGHT_BITS + _TABLE_BITS
_ALL = 1 << _WEIGHT_BITS
_LOW_BITS, _WORD_BITS = 56, 16
_LEAST_RANGE = np.uint64(1 << (_LOW_BITS - _WORD_BITS))
_LOW_MASK = np.uint64((1 << _LOW_BITS) - 1)
_WORD, _OUT = np.uint64(_WORD_BITS), np.uint64(_LOW_BITS - _WORD_BITS)
# Weights: at the start, at least, and what coming true adds; of 65,536.
_FIRST_RATE, _LEAST_RATE, _TRUE = 1 << 11, np.int32(320), np.int32(64_000)

_U = np.uint64


def _context_one(last):
    return (last * 0x9E5 >> 3) & (_CONTEXTS - 1)


def _context_two(last, second):
    return (last * 0x9E5 + second * 0x6F35 >> 4) & (_CONTEXTS - 1)


class _Table:
    """Order 0: the different ids, by rank, and each one's share of 1 << _TABLE_BITS."""

    def __init__(self, kinds: np.ndarray, shares: np.ndarray):
        self.kinds, self.shares = kinds, shares.astype(np.int32)
        self.starts = (np.cumsum(shares) - shares).astype(np.int32)

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple["_Table", np.ndarray]:
        """The table of some ids, and their ranks in it."""
        if int(ids.max()) < 1 << 20:
            counts = np.bincount(ids)
            kinds = np.flatnonzero(counts)
            rank = np.cumsum(counts > 0, dtype=np.int32) - 1
            ranks, counts = rank[ids], counts[kinds]
        else:
            kinds, ranks, counts = np.unique(ids, return_inverse=True, return_counts=True)
        if len(kinds) > MAX_KINDS:
            raise ValueError(f"a segment holds up to {MAX_KINDS} different ids")
        # One each, the rest by frequency, what is left over to the most frequent.
        spare = (1 << _TABLE_BITS) - len(kinds)
        shares = 1 + counts.astype(np.int64) * spare // len(ids)
        shares[np.argmax(shares)] += (1 << _TABLE_BITS) - shares.sum()
        return cls(kinds.astype(np.uint32), shares), ranks.astype(np.int32)

    def packed(self) -> bytes:
        steps = np.diff(self.kinds, prepend=np.uint32(0)).astype("<u4")
        values = np.concatenate([steps, self.shares.astype("<u4")])
        return zlib.compress(values.view(np.uint8).reshape(-1, 4).T.tobytes(), 6)

    @classmethod
    def unpacked(cls, code: bytes, size: int) -> "_Table":
        try:
            planes = np.frombuffer(zlib.decompress(code), np.uint8)
        except zlib.error as damage:
            raise ValueError("the frequency table is damaged") from damage
        if len(planes) != 8 * size:
            raise ValueError("the frequency table does not fit")
        values = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
        shares = values[size:].astype(np.int64)
        if shares.sum() != 1 << _TABLE_BITS or not shares.all():
            raise ValueError("the frequency table is damaged")
        return cls(np.cumsum(values[:size], dtype=np.uint32), shares)

    def by_slot(self) -> np.ndarray:
        """The rank that each slot of the shares belongs to."""
        return np.repeat(np.arange(len(self.shares), dtype=np.int32), self.shares)


class _Model:
    """Predictions of orders 1 and 2 for so many blocks, as ranks below `kinds`, in as few
    bytes as hold them; the blocks' contexts lie one after the other."""

    def __init__(self, lanes: int, kinds: int):
        # What stands for no prediction yet.
        self.kind, self.none = (np.uint16, 0xFFFF) if kinds <= 0xFFFF else (np.int32, -1)
        self.after_one = np.full(lanes * _CONTEXTS, self.none, self.kind)
        self.after_two = np.full(lanes * _CONTEXTS, self.none, self.kind)
        self.row = np.arange(lanes) * _CONTEXTS
        self.rate_one = np.full(lanes, _FIRST_RATE, np.int32)
        self.rate_two = np.full(lanes, _FIRST_RATE, np.int32)

    def predict(self, at_one, at_two) -> None:
        """Shares of the next id of the first blocks, whose contexts are given."""
        k = len(at_one)
        self.at_one, self.at_two = at_one, at_two
        self.one = self.after_one.take(at_one).astype(np.int32)
        self.two = self.after_two.take(at_two).astype(np.int32)
        # A prediction has a share where it exists; order 1 only where it differs.
        self.has_two = self.two != self.none
        self.share_two = (self.rate_two[:k] >> 6) * self.has_two
        self.has_one = (self.one != self.none) & (self.one != self.two)
        self.share_one = (self.rate_one[:k] * (_ALL - self.share_two) >> 16) * self.has_one
        self.taken = self.share_two + self.share_one
        self.rest = _ALL - self.taken

    def place(self, table, ranks, hit_two, hit_one):
        """Start and share of the next ids, of 1 << _TOTAL_BITS. Hits are 0 or 1; a rank in the
        frequency table counts where there is neither."""
        miss = 1 - hit_two - hit_one
        rest, two = self.rest * miss, self.share_two << _TABLE_BITS
        start = table.starts.take(ranks)
        start *= rest
        start += (self.taken << _TABLE_BITS) * miss
        start += two * hit_one
        share = table.shares.take(ranks)
        share *= rest
        share += two * hit_two
        share += (self.share_one << _TABLE_BITS) * hit_one
        return start, share

    def learn(self, ranks, hit_two, hit_one) -> None:
        rate = self.rate_two[: len(ranks)]
        rate += ((hit_two * _TRUE + _LEAST_RATE - rate) >> 5) * self.has_two
        rate = self.rate_one[: len(ranks)]
        rate += ((hit_one * _TRUE + _LEAST_RATE - rate) >> 5) * self.has_one
        ranks = ranks.astype(self.kind)
        self.after_one[self.at_one] = ranks
        self.after_two[self.at_two] = ranks


def _lengths(n_ids: int) -> np.ndarray:
    """Ids of each block: alike but for the last blocks, which may have one fewer."""
    blocks = -(-n_ids // BLOCK)
    longest = -(-n_ids // blocks)
    return np.where(np.arange(blocks) < n_ids - blocks * (longest - 1), longest, longest - 1)


def _encode_lanes(ranks: np.ndarray, full: int, table: _Table):
    """Code words and their numbers for the columns of ranks; the last row counts for the
    first `full`."""
    steps, lanes = ranks.shape
    model = _Model(lanes, len(table.kinds))
    last = second = np.zeros(lanes, np.int32)
    low, width = np.zeros(lanes, _U), np.full(lanes, 1 << _LOW_BITS, _U)
    # A step takes 28 bits at most, which is two words.
    room = 2 * steps + 6
    words = np.zeros(lanes * room, np.uint32)
    size = np.arange(lanes, dtype=np.int64) * room
    for step in range(steps):
        k = lanes if step < steps - 1 else full
        now, row = ranks[step, :k], model.row[:k]
        model.predict(_context_one(last[:k]) + row, _context_two(last[:k], second[:k]) + row)
        hit_two = ((now == model.two) & (model.share_two > 0)).astype(np.int32)
        # Order 1 has no share where it has no prediction.
        hit_one = ((now == model.one) & (model.share_one > 0)).astype(np.int32)
        start, share = model.place(table, now, hit_two, hit_one)
        unit = width[:k] >> _U(_TOTAL_BITS)
        low[:k] += start.astype(_U) * unit
        np.multiply(share.astype(_U), unit, out=width[:k])
        over = np.flatnonzero(low[:k] > _LOW_MASK)
        if len(over):
            words[size[over] - 1] += np.uint32(1)
            low[over] &= _LOW_MASK
        # Every block names its next word; where none is due, the place is written again.
        words[size[:k]] = (low[:k] >> _OUT).astype(np.uint32)
        due = width[:k] < _LEAST_RANGE
        shift = due * _WORD
        low[:k] <<= shift
        low[:k] &= _LOW_MASK
        width[:k] <<= shift
        size[:k] += due
        put = np.flatnonzero(width[:k] < _LEAST_RANGE)
        while len(put):
            words[size[put]] = low[put] >> _OUT
            size[put] += 1
            low[put] = (low[put] << _WORD) & _LOW_MASK
            width[put] <<= _WORD
            put = put[width[put] < _LEAST_RANGE]
        model.learn(now, hit_two, hit_one)
        last, second = now, last
    # Two more words name a place inside the last range, whatever follows them.
    low += _U((1 << (_LOW_BITS - 2 * _WORD_BITS)) - 1)
    over = np.flatnonzero(low > _LOW_MASK)
    words[size[over] - 1] += np.uint32(1)
    low &= _LOW_MASK
    for _ in range(2):
        words[size] = low >> _OUT
        low = (low << _WORD) & _LOW_MASK
        size += 1
    words = words.reshape(lanes, room)
    while (over := words >> np.uint32(_WORD_BITS)).any():
        words &= np.uint32(0xFFFF)
        words[:, :-1] += over[:, 1:]
    size -= np.arange(lanes) * room
    return words[np.arange(room) < size[:, None]].astype("<u2"), size


def _decode_lanes(words, size, steps: int, full: int, table: _Table, by_slot) -> np.ndarray:
    """The ranks that _encode_lanes has coded, as columns."""
    lanes = len(size)
    model = _Model(lanes, len(table.kinds))
    width = np.full(lanes, 1 << _LOW_BITS, _U)
    words = np.append(words, [0] * 8).astype(_U)
    at = np.cumsum(size) - size
    # The first 56 bits: three words and half of the fourth, the rest of which comes later.
    code = (words[at] << _U(32)) | (words[at + 1] << _U(16)) | words[at + 2]
    code = (code << _U(8)) | (words[at + 3] >> _U(8))
    at += 3
    # Each place holds the lower byte of a word and the upper one of the next.
    turned = ((words[:-1] & _U(0xFF)) << _U(8)) | (words[1:] >> _U(8))
    ranks = np.zeros((steps, lanes), np.int32)
    last, second = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for step in range(steps):
        k = lanes if step < steps - 1 else full
        row = model.row[:k]
        model.predict(_context_one(last[:k]) + row, _context_two(last[:k], second[:k]) + row)
        unit = width[:k] >> _U(_TOTAL_BITS)
        place = np.minimum(code[:k] // unit, _U((1 << _TOTAL_BITS) - 1)).astype(np.int32)
        taken = model.taken << _TABLE_BITS
        hit_two = (place < (model.share_two << _TABLE_BITS)).astype(np.int32)
        hit_one = (place < taken).astype(np.int32) - hit_two
        now = by_slot.take((place - taken) // model.rest, mode="clip")
        start, share = model.place(table, now, hit_two, hit_one)
        now *= 1 - hit_two - hit_one
        now += model.two * hit_two
        now += model.one * hit_one
        code[:k] -= start.astype(_U) * unit
        np.multiply(share.astype(_U), unit, out=width[:k])
        due = width[:k] < _LEAST_RANGE
        shift = due * _WORD
        code[:k] <<= shift
        code[:k] |= turned.take(at[:k]) * due
        width[:k] <<= shift
        at[:k] += due
        put = np.flatnonzero(width[:k] < _LEAST_RANGE)
        while len(put):
            code[put] = (code[put] << _WORD) | turned[at[put]]
            at[put] += 1
            width[put] <<= _WORD
            put = put[width[put] < _LEAST_RANGE]
        ranks[step, :k] = now
        model.learn(now, hit_two, hit_one)
        second[:k] = last[:k]
        last[:k] = now
    return ranks


def _columns(ranks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Blocks of consecutive ids as columns; shorter ones end with a zero."""
    table = np.zeros((len(lengths), lengths[0]), np.int32)
    full = int((lengths == lengths[0]).sum())
    cut = full * lengths[0]
    table[:full] = ranks[:cut].reshape(full, lengths[0])
    if full < len(lengths):
        table[full:, :-1] = ranks[cut:].reshape(len(lengths) - full, lengths[0] - 1)
    return np.ascontiguousarray(table.T)


def _checksum(ids: np.ndarray, words: np.ndarray) -> int:
    return zlib.crc32(words, zlib.crc32(ids))


def encode(ids: np.ndarray) -> bytes:
    """A coded segment of ids."""
    if not len(ids):
        return MAGIC + bytes(16)
    table, ranks = _Table.of(ids)
    lengths = _lengths(len(ids))
    ends = np.cumsum(lengths)
    plain = np.ascontiguousarray(ids, dtype="<u4")
    index, codes = [], []
    for first in range(0, len(lengths), LANES):
        part = lengths[first : first + LANES]
        begin = ends[first] - part[0]
        columns = _columns(ranks[begin : begin + part.sum()], part)
        words, size = _encode_lanes(columns, int((part == part[0]).sum()), table)
        sums = [
            _checksum(plain[e - n : e], words[c - m : c])
            for e, n, c, m in zip(ends[first : first + LANES], part, np.cumsum(size), size, strict=True)
        ]
        index.append(np.stack([size, sums], axis=1))
        codes.append(words)
    packed = table.packed()
    head = np.array([len(lengths), len(ids), len(table.kinds), len(packed)], "<u4")
    index = np.concatenate(index).astype("<u4")
    return b"".join([MAGIC, head.tobytes(), index.tobytes(), packed, *(c.tobytes() for c in codes)])


def decode(segment: bytes) -> np.ndarray:
    """The ids of a coded segment; raises ValueError where a block is damaged."""
    if segment[:4] != MAGIC or len(segment) < 20:
        raise ValueError("not a coded segment")
    blocks, n_ids, n_kinds, n_packed = (int(x) for x in np.frombuffer(segment, "<u4", 4, 4))
    if not n_ids:
        return np.zeros(0, np.uint32)
    code_at = 20 + 8 * blocks + n_packed
    if code_at > len(segment) or len(_lengths(n_ids)) != blocks:
        raise ValueError("a segment's index does not fit its code")
    index = np.frombuffer(segment, "<u4", 2 * blocks, 20).reshape(blocks, 2).astype(np.int64)
    size, sums = index.T
    if code_at + 2 * size.sum() != len(segment):
        raise ValueError("a segment's index does not fit its code")
    table = _Table.unpacked(segment[20 + 8 * blocks : code_at], n_kinds)
    by_slot = table.by_slot()
    words = np.frombuffer(segment, "<u2", size.sum(), code_at)
    lengths = _lengths(n_ids)
    ids = np.empty(n_ids, "<u4")
    ends, word_ends = np.cumsum(lengths), np.cumsum(size)
    for first in range(0, blocks, LANES):
        lanes = slice(first, first + LANES)
        part, n_words = lengths[lanes], size[lanes]
        begin = word_ends[first] - n_words[0]
        full = int((part == part[0]).sum())
        code = words[begin : begin + n_words.sum()]
        try:
            ranks = _decode_lanes(code, n_words, int(part[0]), full, table, by_slot).T
            found = table.kinds[ranks]
        except (IndexError, ZeroDivisionError) as damage:
            raise ValueError("a block's code is damaged") from damage
        at = ends[first] - part[0]
        cut = full * part[0]
        ids[at : at + cut] = found[:full].ravel()
        ids[at + cut : at + part.sum()] = found[full:, :-1].ravel()
    edges = zip(ends, lengths, word_ends, size, strict=True)
    for number, (end, length, code_end, n) in enumerate(edges):
        if _checksum(ids[end - length : end], words[code_end - n : code_end]) != sums[number]:
            raise ValueError(f"block {number} does not match its checksum")
    return ids
