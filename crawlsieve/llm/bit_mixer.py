"""Logistic mixing of hashed-context bit predictors, on numpy arrays.

A predictor is a table of (zeros, ones) counts whose slot is the hash of a context
and of the position inside the symbol's code.  The predictors' stretched
probabilities are added with weights that a small gate selects; weights follow
the coding error online.  A final adaptive map refines the mixed
probability by what really happened at that gate and level of confidence.

All work is on arrays of bits; each predictor has as many slots as its caller asks
for, and two states learned on different rows merge: counts add, weights average by
bits seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from crawlsieve.llm.common import columns, squeeze, uncolumns, unsqueeze

SLOT_BITS = 18            # least, see `language_model.slot_bits`
LEVELS = 33               # levels of the final map, over stretch(p) in -8..8
LIMIT = 1.0 / (1 << 16)   # probabilities stay in LIMIT..1-LIMIT
STEP = 1 << 16            # bits per weight update
CONSTANT = 0.3            # input of the bias weight



def squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Spread:
    """A value of each code bit, made for some bits at a time: its token's `first` plus the place of
    the bit in the token's code, or what `table` has there."""

    def __init__(self, sizes: np.ndarray, first: np.ndarray, table: np.ndarray | None = None):
        self.sizes, self.ends, self.first, self.table = sizes, np.cumsum(sizes), first, table

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def at(self, token: np.ndarray, nth: np.ndarray) -> np.ndarray:
        out = np.take(self.first, token, mode="clip") + nth
        return out if self.table is None else np.take(self.table, out, mode="clip")

    def __getitem__(self, part: slice) -> np.ndarray:
        """In the order of the tokens."""
        token = np.repeat(np.arange(len(self.sizes)), self.sizes)[part]
        return self.at(token, np.arange(len(self))[part] - (self.ends - self.sizes)[token])

    def by_depth(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(token, place in its code) of the bits a..b: first bits of codes first."""
        low, high = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.ends, b, "left") + 1
        sizes = self.sizes[low:high].copy()
        begin = self.ends[low:high] - sizes
        sizes[-1] = min(sizes[-1], b - begin[-1])
        return by_depth(sizes, low, a - int(begin[0]))


def by_depth(sizes: np.ndarray, low: int = 0, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(token, place in its code) of all bits, first bits of codes first; tokens are counted from
    `low`, the first `skip` bits of the first one are left out."""
    left, out = np.arange(len(sizes)), []
    for depth in range(int(sizes.max(initial=0))):
        left = left[sizes[left] > depth]
        out.append(left[1:] if depth < skip and left[0] == 0 else left)
    token = np.concatenate(out) if out else left[:0]
    return token + low, np.repeat(np.arange(len(out)), [len(x) for x in out])


@dataclass
class Shared:
    """Slots of one predictor that many bits share: the bit that each codes and how many times,
    and the place of each bit's slot among them."""
    slots: np.ndarray
    at: Spread
    bit: np.ndarray
    times: np.ndarray


Slots = np.ndarray | Shared    # of one predictor; an array has the slot of each bit


@dataclass
class BitMixer:
    contexts: int
    gates: int
    slot_bits: int | tuple[int, ...] = SLOT_BITS   # of all predictors, or of each
    counts: np.ndarray = field(default=None)     # slots of all predictors, one after another x 2
    weights: np.ndarray = field(default=None)    # gates x (contexts + 1)
    map: np.ndarray = field(default=None)        # gates x LEVELS x 2
    seen: float = 0.0

    def __post_init__(self) -> None:
        if isinstance(self.slot_bits, int):
            self.slot_bits = (self.slot_bits,) * self.contexts
        self.starts = [0, *np.cumsum([1 << b for b in self.slot_bits]).tolist()]
        if self.counts is None:
            self.counts = np.zeros((self.starts[-1], 2), np.uint32)      # of one task
        if self.weights is None:
            self.weights = np.full((self.gates, self.contexts + 1), 0.4)
        if self.map is None:
            self.map = np.zeros((self.gates, LEVELS, 2), np.int64)
        self.slopes = np.full_like(self.weights, 1e-4)
        self.known = None        # stretched probabilities of all slots; None: those of the counts
        self.refresh()

    @property
    def stretched(self) -> np.ndarray:
        """Stretched probability of each slot."""
        if self.known is None:
            self.known = np.concatenate([self.stretch(self.counts[a:a + STEP]) for a in range(0, len(self.counts), STEP)])
        return self.known

    def refresh(self) -> None:
        """The final map as counted."""
        level = squash(np.linspace(-8.0, 8.0, LEVELS))
        self.refined = (self.map[:, :, 1] + 16.0 * level) / (self.map.sum(axis=2) + 16.0)

    def slots(self, context: np.ndarray, node: np.ndarray, predictor: int = 0) -> np.ndarray:
        """Slots of (32-bit context hash, code node) pairs."""
        return (self.hashes(context, node) >> np.uint32(32 - self.slot_bits[predictor])).astype(np.int64)

    @staticmethod
    def hashes(context: np.ndarray, node: np.ndarray) -> np.ndarray:
        h = context ^ (node * np.uint32(0x9E3779B1))
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        return h

    def _values(self, slots: list[Slots], counted: bool) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per predictor, stretched probabilities and the place of each bit's among them (none: one a
        bit); `counted`: from the counts, without those of all slots."""
        each = [(s.slots, s.at) if isinstance(s, Shared) else (s, None) for s in slots]
        if counted:
            return [(self.stretch(np.take(self.counts, s + a, axis=0)), at) for a, (s, at) in zip(self.starts, each)]
        return [(np.take(self.stretched[a:], s, mode="clip").astype(np.float32), at) for a, (s, at) in zip(self.starts, each)]

    def _ends(self, gate: np.ndarray) -> np.ndarray:
        """Where each gate begins among ascending ones, and the end."""
        return np.searchsorted(gate, np.arange(self.gates + 1))

    def _mix(self, inputs: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        w = np.ascontiguousarray(self.weights.T, np.float32)
        x = np.repeat(w[-1] * np.float32(CONSTANT), np.diff(ends))
        for gate, (a, b) in enumerate(zip(ends, ends[1:])):
            for weight, value in zip(w, inputs):
                x[a:b] += weight[gate] * value[a:b]
        return np.clip(x, -11.0, 11.0, out=x)

    def _refine(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        at = (np.clip(x, -7.999, 7.999) + 8.0) * ((LEVELS - 1) / 16.0)
        low = at.astype(np.int64)
        part = at - low
        flat, low = self.refined.ravel(), low + gate * LEVELS
        mapped = np.take(flat, low, mode="clip") * (1.0 - part) + np.take(flat, low + 1, mode="clip") * part
        return np.clip(0.5 * (squash(x) + mapped), LIMIT, 1.0 - LIMIT)

    def probability(self, slots: list[Slots], gate: np.ndarray) -> np.ndarray:
        """Probability that each bit is one."""
        out, values = np.empty(len(gate)), self._values(slots, False)
        for a in range(0, len(gate), STEP):
            part = slice(a, a + STEP)
            order = np.argsort(gate[part], kind="stable")
            g, inputs = gate[part][order], [v[part][order] if at is None else np.take(v, at[part][order]) for v, at in values]
            out[part][order] = self._refine(self._mix(inputs, self._ends(g)), g)
        return out

    def probability_by_gate(self, slots: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        """As `probability`, of bits with ascending gates."""
        return self._refine(self._mix([v for v, _ in self._values(slots, False)], self._ends(gate)), gate)

    def _step(self, values: list[tuple[np.ndarray, Spread | None]], gate: np.ndarray | Spread, bit: np.ndarray | Spread, a: int, b: int):
        """(gate, bit, inputs) of the bits a..b in the order of their gates; those of a `Spread` ascend along a code."""
        if isinstance(bit, Spread):
            token, nth = bit.by_depth(a, b)
            return gate.at(token, nth), bit.at(token, nth), [np.take(v, at.at(token, nth), mode="clip") for v, at in values]
        order = np.argsort(gate[a:b].astype(np.uint16), kind="stable")
        return gate[a:b][order], bit[a:b][order], [v[a:b][order] for v, _ in values]

    def learn(self, slots: list[Slots], gate: np.ndarray | Spread, bit: np.ndarray | Spread, rate: float = 0.02) -> None:
        """One pass over bits in order, `STEP` at a time: mix, correct the weights, then count.
        All of `slots` are `Shared` and `gate` and `bit` are `Spread`, or none."""
        n = len(bit)
        if not n:
            return
        places, values = np.zeros(self.map.size, np.int64), self._values(slots, True)
        for a in range(0, n, STEP):
            g, b, inputs = self._step(values, gate, bit, a, min(n, a + STEP))
            ends = self._ends(g)
            x = self._mix(inputs, ends)
            error = b - squash(x)
            share = np.maximum(np.diff(ends), 1)
            for i, value in enumerate([*inputs, None]):
                slope = np.array([error[i:j].sum() * float(np.float32(CONSTANT)) if value is None else error[i:j] @ value[i:j]
                                  for i, j in zip(ends, ends[1:])]) / share
                self.slopes[:, i] += slope * slope
                self.weights[:, i] += rate * slope / np.sqrt(self.slopes[:, i])
            level = np.clip(x * np.float32((LEVELS - 1) / 16.0) + np.float32((LEVELS - 1) / 2 + 0.5), 0, LEVELS - 1).astype(np.int64)
            places += np.bincount((g * LEVELS + level) * 2 + b, minlength=self.map.size)
        self.map += places.reshape(self.map.shape)
        flat, kind = self.counts.reshape(-1), self.counts.dtype
        for a, s in zip(self.starts, slots):
            if isinstance(s, Shared):
                np.add.at(flat, (s.slots + a) * 2 + s.bit, s.times.astype(kind, copy=False))
            else:
                np.add.at(flat, (s + a) * 2 + bit, kind.type(1))
        self.seen += n
        self.known = None
        self.refresh()

    # states as rows, so that Spark can merge those of many tasks

    PAGE = 1 << 12

    def __getstate__(self) -> dict:
        """What scoring needs: a state that is sent can predict, not learn."""
        return {"contexts": self.contexts, "gates": self.gates, "slot_bits": self.slot_bits, "starts": self.starts, "weights": self.weights,
                "refined": self.refined, "known": self.stretched.astype(np.float16, copy=False)}

    def rows(self) -> list[tuple[int, bytes]]:
        """(page, bytes): non-empty pages of counts, then weights and map."""
        pages = self.counts.reshape(-1, 2 * self.PAGE)
        out = [(int(p), columns(np.minimum(pages[p], 0xFFFFFFFF).astype("<u4"))) for p in np.flatnonzero(pages.any(axis=1))]
        small = np.concatenate([[self.seen], (self.weights * self.seen).ravel(), self.map.ravel()])
        return [*out, (-1, squeeze(small.astype("<f8")))]

    @staticmethod
    def add(page: int, raw: bytes, total):
        """Running sum of one page."""
        given = unsqueeze(raw, "<f8") if page < 0 else uncolumns(raw, "<u4")[0].astype(np.int64)
        return given + (0 if total is None else total)

    @staticmethod
    def stretch(counts: np.ndarray) -> np.ndarray:
        """Stretched probabilities of slots, from their (zeros, ones)."""
        n = counts.reshape(-1, 2).astype(np.float32) + np.float32(0.4)
        return np.log(n[:, 1] / n[:, 0])

    def _load_small(self, s: np.ndarray) -> None:
        if s[0] > 0:
            w = self.weights.size
            self.seen = float(s[0])
            self.weights = (s[1:1 + w] / s[0]).reshape(self.weights.shape)
            self.map = np.rint(s[1 + w:]).astype(np.int64).reshape(self.map.shape)

    def load_stretched(self, pages) -> "BitMixer":
        """This state becomes the merged one for scoring, from pages of `stretch` and
        the sums of weights and map (page -1); its counts stay empty."""
        self.known = np.zeros(self.starts[-1], np.float16)
        for p, s in pages:
            if p < 0:
                self._load_small(s)
            else:
                self.known[p * self.PAGE:(p + 1) * self.PAGE] = s
        self.refresh()
        return self

    def load(self, sums: dict[int, np.ndarray]) -> "BitMixer":
        """This state becomes the merged one."""
        self.counts = np.zeros(self.counts.shape, np.int64)      # of all tasks
        pages = self.counts.reshape(-1, 2 * self.PAGE)
        for p, s in sums.items():
            if p >= 0:
                pages[p] = s
        if -1 in sums:
            self._load_small(sums[-1])
        self.known = None
        self.refresh()
        return self
