"""Token ids of whole texts through dictionaries of pre-tokens.

A byte-level tokenizer first splits a text into pre-tokens, and none of them
reaches over a single space that stands between two characters that aren't white
space.  So a text may be cut before each such space, every unit encoded alone and
the ids put together again: the result is the library's own, but a unit that
returns is looked up instead of encoded.  Spaces beside other white space are no
such places; texts that have them are cut by a pattern that leaves them whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence

import numpy as np

#: A single space between characters that aren't white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Marks that often end a word; alone, each is a pre-token.
MARKS = (".", ",")
#: Longer units are encoded, not kept: they seldom return.
LONGEST = 48

_LOADED: dict[str, object] = {}


def tokenizer(name: str):
    """The tokenizer of a file of the public collection, loaded once per worker."""
    if name not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        _LOADED[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _LOADED[name]


def rank_encoder(name: str) -> Callable[[str], list[int]]:
    """The encoder of a rank file of the public collection: the same ids as the tokenizer of its vocabulary, faster."""
    if name not in _LOADED:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _LOADED[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
    return _LOADED[name]


def lengths(ids: np.ndarray, ends: np.ndarray) -> list[int]:
    """Value of a unit: its number of tokens."""
    return np.diff(ends, prepend=0).tolist()


def packed(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Value of a unit: its ids, little-endian unsigned 32-bit."""
    raw, cuts = ids.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class Units:
    """Values of units, from a given table first, then from a bounded cache.

    With `ranks`, units of Latin characters without special strings are encoded by
    the rank file of the same vocabulary, all others by the tokenizer.  `kind` makes the values; `bad` stands for a unit that can't be cut out and
    must not equal a value.  The cache has two generations: when the younger is
    full it becomes the older and only the units just used stay in the younger, so
    memory is bounded by twice `most` entries and a slice of texts.
    """

    def __init__(
        self, name: str, kind: Callable, bad, given: dict | None = None, most: int = 500_000, ranks: str | None = None
    ):
        self.tokenizer = tokenizer(name)
        self.special = tuple(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.by_rank = rank_encoder(ranks) if ranks else None
        self.kind, self.bad, self.most = kind, bad, most
        self.given, self.older = (given or {}) | {"": bad}, {}
        self.now: dict = dict(self.given)
        self.marks = dict(zip(MARKS, self.alone(MARKS), strict=True))
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self.opens[[i for x, i in vocabulary.items() if x.startswith("\u0120")]] = True

    def alone(self, units: Sequence[str]) -> list:
        """Values of units or texts, each encoded for itself."""
        done = [e.ids for e in self.tokenizer.encode_batch_fast(list(units), add_special_tokens=False)]
        ends = np.cumsum([len(x) for x in done], dtype=np.int64)
        return self.kind(np.fromiter((i for x in done for i in x), np.uint32, int(ends[-1]) if done else 0), ends)

    def encoded(self, units: Sequence[str]) -> dict:
        """Values of units that can be cut out."""
        if not self.by_rank:
            return dict(zip(units, self.together(units, self._ids), strict=True))
        plain, other = [], []
        for u in units:
            fits = u.isalpha() or not any(x in u for x in self.special)
            (plain if fits and max(u) < "\u0250" else other).append(u)
        found = dict(zip(plain, self.together(plain, self.by_rank), strict=True))
        found.update(zip(other, self.together(other, self._ids), strict=True))
        return found

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def together(self, units: Sequence[str], encode: Callable[[str], list[int]]) -> list:
        """Values of units that can be cut out, encoded as one text: tokens with a leading space begin units."""
        out = []
        for at in range(0, len(units), 1024):
            part = units[at : at + 1024]
            ids = np.array(encode(" " + " ".join(part)), np.uint32)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(part) and starts[0] == 0:
                out += self.kind(ids, np.append(starts[1:], len(ids)))
            else:
                out += self.alone([" " + u for u in part])
        return out

    def fill(self, units: Sequence[str]) -> dict:
        """Values of units that the younger generation lacks."""
        todo = list(set(units))
        found = {u: v for u, v in zip(todo, map(self.older.get, todo), strict=True) if v is not None}
        fresh, ended = [], []
        for u in todo:
            if u in found:
                continue
            if not u or u.strip() != u:
                found[u] = self.bad
            elif u[-1] in self.marks and (stem := u[:-1]).isalpha() and max(stem) < "\u0250":
                ended.append((u, stem))  # a word of Latin letters and its mark are two pre-tokens
            else:
                fresh.append(u)
        stems = {s for _, s in ended}
        known = {s: v for s in stems if (v := self.now.get(s) or self.older.get(s)) is not None}
        fresh += stems - known.keys() - set(fresh)
        known.update(self.encoded(fresh))
        found.update(known)
        found.update((u, known[s] + self.marks[u[-1]]) for u, s in ended)
        self.now.update((u, v) for u, v in found.items() if len(u) <= LONGEST)
        return found

    def many(self, texts: Sequence[str | None]) -> list[list]:
        """Per text the values of its units, first to last; none for an empty text."""
        flat: list[str] = []
        ends, heads = [], []
        for x in texts:
            if x:
                units = x.split(" ")
                heads.append(units[0])
                units[0] = ""  # the first unit has no space before it
                flat += units
            ends.append(len(flat))
        values = list(map(self.now.get, flat))
        holes, at = [], -1
        try:
            while True:
                at = values.index(None, at + 1)
                holes.append(at)
        except ValueError:
            pass
        if holes:
            found = self.fill([flat[i] for i in holes])
            for i in holes:
                values[i] = found[flat[i]]
            if len(self.now) > self.most + len(self.given):
                self.older, self.now = self.now, self.given | dict(zip(flat, values, strict=True))
        firsts = iter(self.alone(heads))
        checked = values.count(self.bad) > len(heads)
        out, start, nth = [], 0, 0
        for x, end in zip(texts, ends, strict=True):
            own = values[start:end]
            start = end
            if x:
                head, first = heads[nth], next(firsts)
                nth += 1
                if (checked and own.count(self.bad) > 1) or (len(own) > 1 and head.strip() != head) or not head:
                    cut = CUT.split(x)
                    own = self.alone([cut[0], *(" " + u for u in cut[1:])])
                else:
                    own[0] = first
            out.append(own)
        return out
