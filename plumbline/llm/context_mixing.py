"""Online logistic context mixing over bytes: the model, without Spark.

A text is its bytes, A-Z lower-cased, and a closing byte that UTF-8 never has.
Each byte is eight binary decisions.  For each decision, predictors of the orders
0 to 5 look up what followed the same last bytes (and the bits of this byte so
far) in the corpus: a slot of one hashed table holds the logit of the counts.  A
gate chooses a set of weights, and the weighted logits make the probability.
There are two gates, by the highest order that has seen the context, and by the
last byte; weights learn online, bit after bit of a stream, by the coding error.
Within a text the two mixers are weighed by what they have earned so far in it:
P(byte) = sum of weight * P, the weights multiplied by each P and normalised,
starting even.  Over a whole text that is the mean of the two products, so only
sums of logarithms are needed.

What a byte costs each mixer depends on its last five bytes alone, so costs are
kept in a cache by 6-gram.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from plumbline.llm.shingles import mix

_U = np.uint64
#: Orders of the predictors; keys hold the longest context and the byte.
ORDERS = (0, 1, 2, 3, 4, 5)
#: Orders with dense tables, 16 MB at most.
LOW = 3
SPAN = 6
#: Bits that name the slots of a hashed table.
MOST_BITS = 25
CLOSING = b"\xff"
#: Sets of weights: by order, certainty of it and of the next lower one, and bit; by last byte and bit.
GATES = (len(ORDERS) * 16 * 8, 256 * 8)
_SCALE = 16.0
#: Logits (times the scale) that part the levels of certainty.
_SURE = np.array([20, 40, 70])


def keys_of(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """6-grams (five bytes, then the byte) of all bytes of the texts and their closing bytes; where each text ends."""
    gap = b"\0" * (SPAN - 1)
    raw = np.frombuffer(b"".join(gap + (x or b"").lower() + CLOSING for x in texts), np.uint8)
    n = np.array([len(x or b"") + 1 for x in texts], np.int64)
    key = np.zeros(len(raw), np.uint64)
    for back in range(SPAN):
        key[back:] |= raw[: len(raw) - back].astype(np.uint64) << _U(8 * back)
    inside = np.ones(len(raw), bool)
    ends = np.cumsum(n + len(gap))
    for k in range(len(gap)):
        inside[ends - n - len(gap) + k] = False
    return key[inside], np.cumsum(n)


def bases(keys: np.ndarray) -> list[np.ndarray]:
    """Hash of the context of each order."""
    context = keys >> _U(8)
    return [mix(((context & _U((1 << (8 * k)) - 1)) << _U(3)) + _U(k + 1)) for k in ORDERS]


def slot(base: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    return ((base ^ (node * _U(0x9E3779B97F4A7C15))) * _U(0xD6E8FEB86659FD93)) >> _U(64 - bits)


def node_of(keys: np.ndarray, bit: int) -> np.ndarray:
    """The bits of a byte before `bit`, with a leading one."""
    return ((keys & _U(255)) >> _U(8 - bit)) | _U(1 << bit)


def node_counts(keys: np.ndarray, counts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slots (at MOST_BITS) and for each of `counts` how often a zero and a one followed: columns z, o, z, o, …"""
    slots, sums = [], []
    for base in bases(keys):
        for bit in range(8):
            s = slot(base, node_of(keys, bit), MOST_BITS)
            one = (((keys >> _U(7 - bit)) & _U(1)) == 1).astype(np.int64)
            order = np.argsort(s, kind="stable")
            s = s[order]
            cut = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, np.int64)
            slots.append(s[cut])
            columns = [c for n in counts for c in (n * (1 - one), n * one)]
            sums.append(np.stack([np.add.reduceat(c[order], cut) if len(cut) else c[:0] for c in columns], axis=1))
    return np.concatenate(slots), np.concatenate(sums)


def logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logits of counts as bytes; 0 where nothing was counted."""
    x = np.log((ones + 0.4) / (zeros + 0.4))
    return np.clip(np.round(_SCALE * x), -127, 127).astype(np.int8)


def path_logits(keys: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """For each key the logits of the eight nodes of its byte in its context of `order` bytes, from these keys alone."""
    part = keys & _U((1 << (8 * (order + 1))) - 1)
    by = np.argsort(part, kind="stable")
    part, n = part[by], counts[by]
    out = np.zeros((len(keys), 8), np.int8)
    for bit in range(8 if len(keys) else 0):
        run = part >> _U(8 - bit)
        cut = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        ones = np.add.reduceat(n * ((part >> _U(7 - bit)) & _U(1)).astype(np.int64), cut)
        both = np.add.reduceat(n, cut)
        value = np.where(both > 0, logits(both - ones, ones), 0).astype(np.int8)
        out[by, bit] = np.repeat(value, np.diff(np.append(cut, len(run))))
    return out


def dense(keys: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """The logits of all contexts of a low order, at (context, node)."""
    out = np.zeros(1 << (8 * (order + 1)), np.int8)
    values = path_logits(keys, counts, order)
    context = (keys & _U((1 << (8 * (order + 1))) - 1)) >> _U(8) << _U(8)
    for bit in range(8):
        out[context | node_of(keys, bit)] = values[:, bit]
    return out


class Exact:
    """Logits of unshared contexts: of the low orders from dense tables, of the others with each key."""

    def __init__(self, low: list[np.ndarray], high: np.ndarray):
        self.low, self.high = low, high

    def part(self, at: int, size: int) -> Exact:
        return Exact(self.low, self.high[at : at + size])

    def found(self, keys: np.ndarray, bit: int) -> list[np.ndarray]:
        context, node = keys >> _U(8), node_of(keys, bit)
        low = [t[((context & _U((1 << (8 * k)) - 1)) << _U(8)) | node] for k, t in enumerate(self.low)]
        return low + [self.high[:, k, bit] for k in range(self.high.shape[1])]


def inputs(table: np.ndarray | Exact, base: list[np.ndarray] | None, keys: np.ndarray, bit: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Logits of the orders and a constant, and the index of the weights by each gate."""
    if isinstance(table, Exact):
        found = table.found(keys, bit)
    else:
        node, bits = node_of(keys, bit), int(len(table)).bit_length() - 1
        found = [table[slot(b, node, bits)] for b in base]
    x = np.empty((len(keys), len(ORDERS) + 1), np.float32)
    high = np.zeros(len(keys), np.int64)
    sure = np.zeros(len(keys), np.int64)
    for k in range(len(ORDERS)):
        v = found[k]
        x[:, k] = v
        seen = v != 0
        high[seen] = k
        sure[seen] = (sure[seen] & 3) * 4 + np.searchsorted(_SURE, np.abs(v[seen].astype(np.int16)))
    x[:, :-1] /= _SCALE
    x[:, -1] = 0.3
    last = ((keys >> _U(8)) & _U(255)).astype(np.int64)
    return x, [(high * 16 + sure) * 8 + bit, last * 8 + bit]


def fresh_weights() -> list[np.ndarray]:
    return [np.full((n, len(ORDERS) + 1), 0.3, np.float64) for n in GATES]


def learn(table: np.ndarray, keys: np.ndarray, counts: np.ndarray, batch: int = 2048, rate: float = 0.05):
    """Weights after one online pass over the bits of `keys`, and how many bits each set has seen."""
    weights = fresh_weights()
    energy = [np.full_like(w, 1e-2) for w in weights]
    seen = [np.zeros(n) for n in GATES]
    for at in range(0, len(keys), batch):
        k, n = keys[at : at + batch], counts[at : at + batch].astype(np.float64)
        exact = isinstance(table, Exact)
        here, base = (table.part(at, batch), None) if exact else (table, bases(k))
        for bit in range(8):
            x, gates = inputs(here, base, k, bit)
            target = ((k >> _U(7 - bit)) & _U(1)).astype(np.float64)
            for w, e, s, g in zip(weights, energy, seen, gates, strict=True):
                p = 1 / (1 + np.exp(-np.einsum("ij,ij->i", x, w[g])))
                error = n * (target - p)
                mass = np.bincount(g, n, len(w))
                hit = mass > 0
                step = np.stack([np.bincount(g, error * x[:, j], len(w)) for j in range(x.shape[1])], axis=1)[hit]
                step /= mass[hit][:, None]
                e[hit] += step * step
                w[hit] += rate * step / np.sqrt(e[hit])
                s += mass
    return weights, seen


def cost(table: np.ndarray, weights: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Natural logarithm of 1/P of the byte of each 6-gram, by each mixer."""
    out = np.zeros((len(keys), len(weights)), np.float32)
    weights = [w.astype(np.float32) for w in weights]
    for at in range(0, len(keys), 1 << 15):
        k = keys[at : at + (1 << 15)]
        exact = isinstance(table, Exact)
        here, base = (table.part(at, 1 << 15), None) if exact else (table, bases(k))
        for bit in range(8):
            x, gates = inputs(here, base, k, bit)
            sign = np.where((k >> _U(7 - bit)) & _U(1), np.float32(-1), np.float32(1))
            for m, (w, g) in enumerate(zip(weights, gates, strict=True)):
                y = np.clip(sign * np.einsum("ij,ij->i", x, w[g]), -40, 40)
                out[at : at + len(k), m] += np.log1p(np.exp(y))
    return out


class Scorer:
    """Costs of texts.  Known 6-grams lie sorted, up to `most`; a table of fixed size in front answers most."""

    def __init__(self, table: np.ndarray, weights: list[np.ndarray], cache_bits: int = 21, most: int = 2_500_000):
        self.table, self.weights, self.shift, self.most = table, weights, _U(64 - cache_bits), most
        self.tag = np.full(1 << cache_bits, ~_U(0))
        self.kept = np.zeros((1 << cache_bits, len(weights)), np.float32)
        self.forget()

    def forget(self) -> None:
        self.known, self.values = np.zeros(0, np.uint64), np.zeros((0, len(self.weights)), np.float32)

    def of_distinct(self, keys: np.ndarray) -> np.ndarray:
        """Costs of sorted distinct 6-grams."""
        at = np.searchsorted(self.known, keys)
        found = np.zeros(len(keys), bool)
        inside = at < len(self.known)
        found[inside] = self.known[at[inside]] == keys[inside]
        out = np.empty((len(keys), len(self.weights)), np.float32)
        out[found] = self.values[at[found]]
        if not found.all():
            new = keys[~found]
            out[~found] = cost(self.table, self.weights, new)
            if len(self.known) + len(new) > self.most:
                self.forget()
            where = np.searchsorted(self.known, new)
            self.known = np.insert(self.known, where, new)
            self.values = np.insert(self.values, where, out[~found], axis=0)
        return out

    def costs(self, keys: np.ndarray) -> np.ndarray:
        place = (keys * _U(0x9E3779B97F4A7C15)) >> self.shift
        out = self.kept[place]
        missing = np.flatnonzero(self.tag[place] != keys)
        if len(missing):
            new, where = np.unique(keys[missing], return_inverse=True)
            made = self.of_distinct(new)
            out[missing] = made[where]
            # Of 6-grams that share a place one is named there, with its own costs.
            at, one = np.unique((new * _U(0x9E3779B97F4A7C15)) >> self.shift, return_index=True)
            self.tag[at], self.kept[at] = new[one], made[one]
        return out

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        """log10 of the probability of each text, its end included."""
        keys, ends = keys_of(texts)
        if not len(ends):
            return np.zeros(0)
        each = np.add.reduceat(self.costs(keys).astype(np.float64), np.append(0, ends[:-1]), axis=0)
        return (np.logaddexp.reduce(-each, axis=1) - np.log(each.shape[1])) / np.log(10)
