"""An adaptive context-mixing range coder for token ids, many blocks at a time.

The ids are cut into blocks that are coded on their own: every block starts with
fresh tables, and none needs another. One NumPy step codes the next id of all
blocks together.

Three predictions are made for an id: the last id seen after the same two ids
(order 2), the last seen after the same one id (order 1), and the frequencies of
the chunk, stored before its blocks (order 0). The chance that order 2 or order 1 is
right adapts with each id, by how often the slot has been right before; where both
name the same id their chances are mixed with a weight that adapts too. First it is
coded which prediction holds, then, if neither, the id by order 0. All arithmetic is
on integers, so that any machine decodes alike.
"""

import zlib

import numpy as np

BLOCK = 1024
#: Which prediction holds is coded in shares of 2**12, kept with 8 more bits; an id by
#: order 0 in shares of 2**18. Together they cut the range into 2**30.
CHOICE_BITS, EXTRA_BITS, ID_BITS = 12, 8, 18
CHOICES, ONE, SHARES = 1 << CHOICE_BITS, 1 << (CHOICE_BITS + EXTRA_BITS), 1 << ID_BITS
SLOTS = 1 << 9
TOP = 8
RATE = 5
#: What the chance of being right moves towards.
GOAL, MISSED = np.int32(ONE - (ONE >> 7)), np.int32(ONE >> 9)
#: Multipliers of the last two ids; the low bits of the products name a slot.
CONTEXT = np.array([[0x9E3779B1], [0xC2B2AE35]], np.uint32)
WORD = np.uint64(32)
SHIFT = np.uint64(CHOICE_BITS + ID_BITS)
LEAST = np.uint64(1 << 32)
FULL = np.uint64((1 << 64) - 1)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids, their shares of ``SHARES``, each at least 1, and the rank of every id."""
    if ids.max() < 1 << 22:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        place = np.zeros(symbols[-1] + 1, np.int32)
        place[symbols] = np.arange(len(symbols))
        rank = place[ids]
    else:
        symbols, rank, counts = np.unique(ids, return_inverse=True, return_counts=True)
    if len(symbols) > SHARES // 2:
        raise ValueError("too many distinct ids in a chunk")
    share = 1 + counts * (SHARES - len(symbols)) // counts.sum()
    share[np.argmax(share)] += SHARES - share.sum()
    return symbols.astype(np.int64), share.astype(np.int64), rank


class Predictor:
    """Order-1 and order-2 tables of all blocks, and what they predict next.

    A slot holds an id (its rank plus one) and a trust of 1 to 7, or 0 if empty.
    The chance of being right is kept by block, order and trust; it is 0 for an
    empty slot. Arrays with two rows hold order 1 in the first, order 2 in the second.
    """

    def __init__(self, blocks: int):
        self.slots = np.zeros(2 * blocks * SLOTS, np.int32)
        self.first_slot = np.arange(2 * blocks).reshape(2, blocks) * SLOTS
        self.chance = np.zeros(2 * blocks * TOP, np.int32)
        self.first_chance = np.arange(2 * blocks).reshape(2, blocks) * TOP
        self.empty = self.chance.reshape(-1, TOP)[:, 0]
        self.chance.reshape(-1, TOP)[:, 1:] = np.arange(1, TOP) * (ONE // 8)
        self.weight = np.full(blocks, 1 << 15, np.int32)
        self.last = np.zeros((2, blocks), np.uint32)

    def predict(self, n: int) -> None:
        """For the first ``n`` blocks, in 32 bits: the ids named and the shares of ``CHOICES`` for
        each being right, at least 1 if any is named."""
        self.n = n
        context = self.last[:, :n] * CONTEXT
        context[1] += context[0]
        context >>= 15
        context &= SLOTS - 1
        self.at = at = self.first_slot[:, :n] + context
        self.held = self.slots.take(at)
        self.trust = self.held & (TOP - 1)
        self.name = self.held >> 3
        self.place = self.first_chance[:, :n] + self.trust
        self.base = self.chance.take(self.place)
        self.same = (self.name[0] == self.name[1]) & (self.trust[0] > 0)
        self.step = np.where(self.same, self.base[0] - self.base[1] >> 6, 0)
        self.share2 = (self.base[1] + ((self.step * self.weight[:n]) >> 10)) >> EXTRA_BITS
        one = ((CHOICES - self.share2) * (self.base[0] >> EXTRA_BITS)) >> CHOICE_BITS
        self.share1 = np.where(self.same, 0, np.maximum(one, self.trust[0] > 0))

    def learn(self, symbol: np.ndarray) -> None:
        n, after = self.n, symbol + 1
        right = self.name == after
        weight = self.weight[:n]
        weight += np.where(right[1], self.step, -self.step)
        np.maximum(weight, 1 << 11, out=weight)
        np.minimum(weight, (1 << 16) - (1 << 11), out=weight)
        goal = np.where(right, GOAL, MISSED)
        goal -= self.base
        goal >>= RATE
        goal += self.base
        self.chance[self.place.ravel()] = goal.ravel()
        self.empty[:] = 0
        after <<= 3
        after += 1
        wrong = np.where(self.trust < 2, after, self.held - (self.trust + 1 >> 1))
        held = np.where(right, self.held + (self.trust < TOP - 1), wrong)
        self.slots[self.at.ravel()] = held.ravel()
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = symbol + 1


def sizes(total: int) -> np.ndarray:
    """Ids in each block: all full but the last."""
    return np.diff(np.append(np.arange(0, total, BLOCK), total))


def encode(ids: np.ndarray) -> tuple[bytes, list[bytes]]:
    """The frequency table and the coded blocks; no ids give no blocks."""
    if not len(ids):
        return b"", []
    symbols, share, ranks = frequencies(ids)
    below, small_share = (np.cumsum(share) - share).astype(np.int32), share.astype(np.int32)
    count = sizes(len(ids))
    blocks = len(count)
    rank = np.zeros(blocks * BLOCK, np.int32)
    rank[: len(ids)] = ranks
    del ranks
    rank = np.ascontiguousarray(rank.reshape(blocks, BLOCK).T)
    low, width = np.zeros(blocks, np.uint64), np.full(blocks, FULL)
    out = np.zeros((blocks, 2 * BLOCK + 8), np.uint32)
    used = np.zeros(blocks, np.int64)

    def carry(lanes: np.ndarray) -> None:
        at = used[lanes] - 1
        while len(lanes):
            out[lanes, at] += 1
            more = out[lanes, at] == 0
            lanes, at = lanes[more], at[more] - 1

    def put(n: int, start: np.ndarray, size: np.ndarray) -> None:
        unit = width[:n] >> SHIFT
        added = low[:n] + unit * start.astype(np.uint64)
        wrapped = added < low[:n]
        if wrapped.any():
            carry(np.flatnonzero(wrapped))
        narrow = unit * size.astype(np.uint64)
        small = np.flatnonzero(narrow < LEAST)
        if len(small):
            out[small, used[small]] = added[small] >> WORD
            used[small] += 1
            added[small] <<= WORD
            narrow[small] <<= WORD
        low[:n], width[:n] = added, narrow

    model = Predictor(blocks)
    for t in range(int(count[0])):
        n = blocks if t < count[-1] else blocks - 1
        symbol = rank[t, :n]
        model.predict(n)
        hit1, hit2 = model.name == symbol + 1
        hit1 &= ~hit2
        both = model.share2 + model.share1
        rest = CHOICES - both
        start = np.where(hit2, 0, np.where(hit1, model.share2 << ID_BITS, (both << ID_BITS) + rest * below.take(symbol)))
        size = np.where(hit2, model.share2 << ID_BITS, np.where(hit1, model.share1 << ID_BITS, rest * small_share.take(symbol)))
        put(n, start, size)
        model.learn(symbol)
    every = np.arange(blocks)
    for _ in (0, 1):
        out[every, used] = low >> WORD
        used += 1
        low <<= WORD
    table = zlib.compress(np.stack([np.diff(symbols, prepend=0), share]).astype("<u4").tobytes())
    return table, [out[k, : used[k]].astype("<u4").tobytes() for k in range(blocks)]


def decode(table: bytes, coded: list[bytes], total: int) -> np.ndarray:
    """The ids that ``encode`` was given."""
    if not total:
        return np.zeros(0, np.int64)
    symbols, share = np.frombuffer(zlib.decompress(table), "<u4").reshape(2, -1).astype(np.int64)
    symbols = np.cumsum(symbols)
    below, small_share = (np.cumsum(share) - share).astype(np.int32), share.astype(np.int32)
    owner = np.repeat(np.arange(len(share), dtype=np.int32), share)
    count = sizes(total)
    blocks = len(count)
    longest = max(map(len, coded)) // 4
    words = np.zeros((blocks, longest + 2), np.uint64)
    for k, data in enumerate(coded):
        words[k, : len(data) // 4] = np.frombuffer(data, "<u4")
    code, width = (words[:, 0] << WORD) | words[:, 1], np.full(blocks, FULL)
    used = np.full(blocks, 2)
    out = np.zeros((BLOCK, blocks), np.int32)

    def take(n: int, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        rest = code[:n] - unit * start.astype(np.uint64)
        narrow = unit * size.astype(np.uint64)
        small = np.flatnonzero(narrow < LEAST)
        if len(small):
            rest[small] = (rest[small] << WORD) | words[small, used[small]]
            used[small] += 1
            narrow[small] <<= WORD
        code[:n], width[:n] = rest, narrow

    model = Predictor(blocks)
    for t in range(int(count[0])):
        n = blocks if t < count[-1] else blocks - 1
        model.predict(n)
        both = model.share2 + model.share1
        rest = CHOICES - both
        unit = width[:n] >> SHIFT
        at = np.minimum(code[:n] // unit, np.uint64((CHOICES << ID_BITS) - 1)).astype(np.int32)
        hit2 = at < model.share2 << ID_BITS
        past = at - (both << ID_BITS)
        miss = past >= 0
        found = owner[np.maximum(past, 0) // rest]
        start = np.where(hit2, 0, np.where(miss, (both << ID_BITS) + rest * below[found], model.share2 << ID_BITS))
        size = np.where(hit2, model.share2 << ID_BITS, np.where(miss, rest * small_share[found], model.share1 << ID_BITS))
        take(n, unit, start, size)
        symbol = np.where(miss, found, np.where(hit2, model.name[1], model.name[0]) - 1)
        out[t, :n] = symbol
        model.learn(symbol)
    return symbols[out.T.reshape(-1)[:total]]
