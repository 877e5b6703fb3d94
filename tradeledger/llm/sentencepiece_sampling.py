"""Sampled SentencePiece segmentations without replacement, and decoding.

A text's lattice holds every way to spell it with the model's pieces. Segmentations are drawn
by Gumbel top-k: each has its log-probability perturbed by Gumbel noise, and an A* search over
regions of the lattice emits the k highest. A region's bound is the exact maximum of the
perturbed values in it, so the first k segmentations that the search reaches are the sample,
and the next bound is the threshold from which inclusion probabilities follow.

Lattices are made and remembered for units: a text is cut wherever no piece has the two characters there
next to each other, and what is likely on one side of a cut does not depend on the other.

A region is all that first leaves a drawn path at one of a range of its decisions. It has one
Gumbel, that of its summed probability, and is split only when the search reaches it. Paths
from there on are plain draws, taken for all texts of a batch at once.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeledger.llm.textbytes import mix
from tradeledger.llm.worker_memory import Step, parts, released

SAMPLES = 3
# Weight of a piece: (rank + 2) ** -SHARPNESS. Ranks are what a BPE model has for scores.
SHARPNESS = 1.5
# Nodes of remembered lattices, and characters that are drawn for at once (one text at least).
MEMORY = 1_500_000
BATCH = 500_000
_GAP = "▁"
# Pairs of characters are looked up in a table of so many places; two in one place only leave a cut out.
_PAIRS = 1 << 20
# Odd numbers for hashes of units, the inverse of the first, and the place of a length.
_RATIO = 0x9E3779B97F4A7C15
_INVERSE = pow(_RATIO, -1, 1 << 64)
# Columns of the edges: next node or -1, first id, number of ids; then cumulated probability, log-probability, that of all others.
_NEXT, _FIRST, _COUNT = range(3)
_UPTO, _LOG, _REST = range(3)


class Lattice:
    """Pieces of a model, and the lattices of stretches of text that no piece crosses."""

    def __init__(self, model: str, sharpness: float = SHARPNESS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.model.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        for i in range(size):
            if self.model.is_byte(i):
                self.bytes[int(self.model.id_to_piece(i)[3:-1], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                rank = max(0.0, -self.model.get_score(i))
                self.pieces[self.model.id_to_piece(i)] = (i, -sharpness * math.log(rank + 2))
        self.byte_weight = -sharpness * math.log(size + 2)
        self.longest = max(map(len, self.pieces), default=1)
        # gaps only ever open a piece, or form runs: elsewhere in a piece they would tie words together
        self.split = all(_GAP not in p.lstrip(_GAP) for p in self.pieces)
        self._tied = np.zeros(_PAIRS, bool)
        pairs = sorted({p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)})
        if pairs:
            first, second = np.frombuffer("".join(pairs).encode("utf-32-le"), np.uint32).reshape(-1, 2).T.astype(np.int64)
            self._tied[_pair(first, second)] = True
        self._build_trie()
        self._forget()

    def _build_trie(self) -> None:
        """The pieces' beginnings as states: sorted keys (state, next character), the states they lead to, pieces there."""
        steps: dict[int, int] = {}
        ids, weights = [-1], [0.0]
        for piece, (i, weight) in self.pieces.items():
            state = 0
            for c in piece:
                key = state << 21 | ord(c)
                if key not in steps:
                    steps[key] = len(ids)
                    ids.append(-1)
                    weights.append(0.0)
                state = steps[key]
            ids[state], weights[state] = i, weight
        self._keys = np.array(sorted(steps) or [-1], np.int64)
        self._leads = np.array([steps.get(k, 0) for k in self._keys.tolist()], np.int64)
        self._piece, self._weight = np.array(ids, np.int64), np.array(weights)
        self._build_table()
        # the first step of a piece by its character
        first = self._keys[self._keys < 1 << 21]
        self._starts = np.zeros(int(first[-1]) + 2 if len(first) else 1, np.int64)
        self._starts[first] = self._leads[: len(first)]

    def _build_table(self) -> None:
        """The keys in a hash table of which a quarter or less is filled; a key lies at its place or at the next free ones."""
        self._bits = max(4, (4 * len(self._keys)).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int64)
        self._to = np.zeros(1 << self._bits, np.int64)
        left, place = np.arange(len(self._keys)), self._slot(self._keys)
        while len(left):
            free = self._slots[place] == -1
            self._slots[place[free]] = self._keys[left[free]]
            self._to[place[free]] = self._leads[left[free]]
            over = self._slots[place] != self._keys[left]
            left, place = left[over], (place[over] + 1) & (len(self._slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_RATIO)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _step(self, keys: np.ndarray) -> np.ndarray:
        """The states that the keys lead to, 0 where there is none."""
        place = self._slot(keys)
        there = self._slots[place]
        lead = np.where(there == keys, self._to[place], 0)
        left = np.flatnonzero((there != keys) & (there != -1))
        place = place[left]
        while len(left):
            place = (place + 1) & (len(self._slots) - 1)
            there, wanted = self._slots[place], keys[left]
            hit = there == wanted
            lead[left[hit]] = self._to[place[hit]]
            on = ~hit & (there != -1)
            left, place = left[on], place[on]
        return lead

    def _forget(self) -> None:
        """No lattices: nodes of a unit are numbered by its characters, edges of a node follow each other."""
        self._known = np.zeros(0, np.uint64)
        self._home = np.zeros(0, np.int64)
        self._size = np.zeros(0, np.int64)
        self._again = np.zeros(0, bool)
        self.nodes = 0
        self._first = np.zeros(1, np.int64)
        self._edges = np.zeros((3, 0), np.int32)
        self._weights = np.zeros((3, 0))
        self._room = self._first, self._edges, self._weights
        self._ids = np.arange(self.model.get_piece_size(), dtype=np.int32)

    def _keep_repeated(self) -> None:
        """Forget the units that came in one batch alone, and all if the others take half the room."""
        keep = self._again
        if 2 * int(self._size[keep].sum()) > MEMORY:
            self._forget()
            return
        home, size = self._home[keep], self._size[keep]
        node = _ranges(home, size)
        degree = self._first[node + 1] - self._first[node]
        edge = _ranges(self._first[node], degree)
        new = np.cumsum(size) - size
        edges = self._edges[:, edge]
        shift = np.repeat(np.repeat(new - home, size), degree)
        edges[_NEXT] = np.where(edges[_NEXT] < 0, -1, edges[_NEXT] + shift)
        self._known, self._home, self._size = self._known[keep], new, size
        self._again = np.zeros(len(new), bool)
        self._first = np.concatenate([[0], np.cumsum(degree)])
        self._edges, self._weights = edges, self._weights[:, edge]
        self._room = self._first, self._edges, self._weights
        self.nodes = len(node)

    def _put(self, first: np.ndarray, edges: np.ndarray, weights: np.ndarray) -> None:
        """Nodes and edges behind those there are, in room that grows by half."""
        have = self._first, self._edges, self._weights
        room = []
        for old, kept, new in zip(self._room, have, (first, edges, weights), strict=True):
            begin = kept.shape[-1]
            end = begin + new.shape[-1]
            if old.shape[-1] < end:
                old = np.empty((*old.shape[:-1], end + end // 2), old.dtype)
                old[..., :begin] = kept
            old[..., begin:end] = new
            room.append((old, old[..., :end]))
        self._room = tuple(old for old, _ in room)
        self._first, self._edges, self._weights = (filled for _, filled in room)

    def _cuts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Characters of the texts with gaps for blanks, begin of each text, where units begin, and where stretches do.

        A stretch begins at each run of gaps, if gaps only open pieces.
        """
        codes = np.frombuffer("".join([_GAP + text if text else "" for text in texts]).encode("utf-32-le"), np.uint32)
        codes = codes.astype(np.int64)
        codes[codes == 0x20] = ord(_GAP)
        begins = np.cumsum([0, *[len(text) + 1 if text else 0 for text in texts]])
        opens = np.zeros(len(codes) + 1, bool)
        opens[begins] = True
        opens = opens[:-1]
        cuts = opens.copy()
        cuts[1:] |= ~self._tied[_pair(codes[:-1], codes[1:])]
        if self.split:
            gaps = codes == ord(_GAP)
            opens[1:] |= gaps[1:] & ~gaps[:-1]
        return codes, begins, np.flatnonzero(cuts | opens), opens

    def _found(self, codes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Begin, end, place in the ids, number of ids and weight of all pieces, or of bytes where no piece begins."""
        found = []
        begin = at = np.arange(len(codes))
        state = None
        while len(begin):
            if state is None:
                lead = self._starts[np.minimum(codes, len(self._starts) - 1)]
            else:
                lead = self._step(state << 21 | codes[at])
            on = lead > 0
            begin, at, state = begin[on], at[on] + 1, lead[on]
            hit = self._piece[state] >= 0
            there = state[hit]
            found.append((begin[hit], at[hit], self._piece[there], np.ones(len(there), np.int64), self._weight[there]))
            on = at < end[begin]
            begin, at, state = begin[on], at[on], state[on]
        bare = np.ones(len(codes), bool)
        for f in found:
            bare[f[0]] = False
        begin = np.flatnonzero(bare)
        if len(begin):
            characters, which = np.unique(codes[begin], return_inverse=True)
            spelled = [
                [self.bytes[x] for x in chr(c).encode()] if self.bytes else [self.model.unk_id()] for c in characters.tolist()
            ]
            count = np.array([len(x) for x in spelled], np.int64)
            first = len(self._ids) + np.cumsum(count) - count
            self._ids = np.concatenate([self._ids, np.array(sum(spelled, []), np.int32)])
            found.append((begin, begin + 1, first[which], count[which], self.byte_weight * count[which]))
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _learn(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The lattices of new units, all at once; returns their first nodes.

        The weight of an edge is its log-probability given the position. These come after a backward
        pass of log-sums, so probabilities are of the whole unit.
        """
        ends = np.cumsum(lengths)
        end = np.repeat(ends, lengths)
        begin, to, first, count, weight = self._found(codes, end)
        order = _stable_order(begin, len(codes))
        begin, to, first, count, weight = (x[order] for x in (begin, to, first, count, weight))
        sizes = np.bincount(begin, minlength=len(codes))
        heads = np.cumsum(sizes) - sizes
        closes = to == end[begin]
        togo = end - np.arange(len(codes))
        # positions as far from the end of their unit as each other, nearest first; their edges in that order
        nodes = _stable_order(togo, int(lengths.max()) + 1)
        each = sizes[nodes]
        place = _ranges(heads[nodes], each)
        near, last, weigh = to[place], closes[place], weight[place]
        total = np.zeros(len(codes) + 1)
        logs = np.empty(len(begin))
        begins = np.concatenate([[0], np.cumsum(each)])
        bounds = np.concatenate([[0], np.cumsum(np.bincount(togo)[1:])])
        for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            a, b = begins[p], begins[q]
            values = weigh[a:b] + np.where(last[a:b], 0.0, total[near[a:b]])
            starts, many = begins[p:q] - a, each[p:q]
            top = np.maximum.reduceat(values, starts)
            sums = top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, many)), starts))
            total[nodes[p:q]] = sums
            logs[place[a:b]] = values - np.repeat(sums, many)
        shares = np.exp(logs)
        upto = shares.copy()
        more, r = heads[sizes > 1], 1
        while len(more):
            upto[more + r] += upto[more + r - 1]
            r += 1
            more = heads[sizes > r]
        upto[heads + sizes - 1] = 2.0
        # one edge of a position may have more than a half; what the others have is added up, not subtracted
        small = shares <= 0.5
        with np.errstate(divide="ignore"):
            rest = np.log1p(-np.where(small, shares, 0.0))
            others = np.log(np.add.reduceat(np.where(small, shares, 0.0), heads))
            rest[~small] = np.repeat(others, sizes)[~small]
        base = self.nodes
        edges = np.stack([np.where(closes, -1, base + to), first, count])
        self._put(self._first[-1] + np.cumsum(sizes), edges, np.stack([upto, logs, rest]))
        self.nodes += len(codes)
        return base + ends - lengths

    def _nodes_of(self, codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The first node of each unit; lattices of new units are made. Units are known by 64-bit hashes."""
        names = _names(codes, begins, lengths)
        distinct, one, which = np.unique(names, return_index=True, return_inverse=True)
        place = np.searchsorted(self._known, distinct)
        old = np.zeros(len(distinct), bool)
        inside = place < len(self._known)
        old[inside] = self._known[place[inside]] == distinct[inside]
        self._again[place[old]] = True
        new = one[~old]
        if len(new):
            sizes = lengths[new]
            homes = self._learn(codes[_ranges(begins[new], sizes)], sizes)
            at = place[~old]
            self._known = np.insert(self._known, at, distinct[~old])
            self._home, self._size = np.insert(self._home, at, homes), np.insert(self._size, at, sizes)
            self._again = np.insert(self._again, at, False)
            place = np.searchsorted(self._known, distinct)
        return self._home[place][which]

    def _draw(self, nodes: np.ndarray, at: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each node to the end of its unit: all edges, one path after the other, and where each begins.

        The draw at a character depends on ``seeds`` and the character's place ``at`` in its text alone.
        """
        upto, following = self._weights[_UPTO], self._edges[_NEXT]
        bases = seeds + (at - nodes).astype(np.uint64) * np.uint64(_RATIO)
        who = np.arange(len(nodes))
        steps = []
        lengths = np.zeros(len(at), np.int64)
        while len(who):
            u = _uniform(bases, nodes)
            edge = self._first[nodes]
            late = np.flatnonzero(u >= upto[edge])
            while len(late):
                edge[late] += 1
                late = late[u[late] >= upto[edge[late]]]
            steps.append((who, edge))
            lengths[who] += 1
            nodes = following[edge]
            more = np.flatnonzero(nodes >= 0)
            who, nodes, bases = who[more], nodes[more].astype(np.int64), bases[more]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        path = np.empty(begins[-1], np.int64)
        for i, (who, edge) in enumerate(steps):
            path[begins[who] + i] = edge
        return path, begins

    def _complete(self, edge: int, draw) -> list[int]:
        """The edge and a drawn path from its end to the end of the unit."""
        path = [edge]
        while (node := self._edges[_NEXT, edge]) >= 0:
            edge = self._drawn_edge(node, draw)
            path.append(edge)
        return path

    def _drawn_edge(self, node: int, draw) -> int:
        edge, u = int(self._first[node]), draw()
        while u >= self._weights[_UPTO, edge]:
            edge += 1
        return edge

    def spell(self, path: np.ndarray) -> np.ndarray:
        """Ids of a path's edges."""
        count = self._edges[_COUNT][path]
        first = self._edges[_FIRST][path]
        if len(path) == count.sum():
            return self._ids[first]
        begins = np.cumsum(count) - count
        return self._ids[np.repeat(first - begins, count) + np.arange(count.sum())]

    def sample_all(self, texts: list[str], k: int, seeds: list[str]) -> list[list[tuple[np.ndarray, float, float]]]:
        """For each text up to k different segmentations: ids, log-probability, inclusion probability."""
        if self.nodes > MEMORY:
            self._keep_repeated()
        codes, texts_at, begins, opens = self._cuts(texts)
        if not len(codes):
            return [[(self._ids[:0], 0.0, 1.0)] for _ in texts]
        lengths = np.diff(begins, append=len(codes))
        node = self._nodes_of(codes, begins, lengths)
        bounds = np.searchsorted(begins, texts_at)
        owners = np.diff(bounds)
        at = begins - np.repeat(texts_at[:-1], owners)
        # the unit after the last one of each unit's stretch
        stretches = np.flatnonzero(opens[begins])
        after = np.repeat(np.append(stretches[1:], len(begins)), np.diff(stretches, append=len(begins)))
        kinds = np.array([_seeds(seed, k) for seed in seeds], np.uint64).reshape(len(texts), k)
        drawn = [self._draw(node, at, np.repeat(kinds[:, j], owners)) for j in range(k)]
        return [
            self._search(drawn, node, after, begin, end, random.Random(seed)) if end > begin else [(self._ids[:0], 0.0, 1.0)]
            for seed, begin, end in zip(seeds, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]

    def _search(
        self, drawn: list, nodes: np.ndarray, after: np.ndarray, begin: int, end: int, noise: random.Random
    ) -> list[tuple[np.ndarray, float, float]]:
        """The sample of one text out of plain draws of its units ``begin`` to ``end``.

        Where a path is left, the rest of the stretch is drawn anew, and the stretches after it are plain draws.
        """
        draw, log = noise.random, math.log

        def units(j: int, first: int) -> tuple[np.ndarray, np.ndarray]:
            path, begins = drawn[j]
            return path[begins[first]:begins[end]], begins[first:end + 1] - begins[first]

        def push(mass: float, bound: float, *region) -> None:
            """A region with the maximum of its perturbed values, a Gumbel cut off at ``bound``."""
            if mass > -math.inf:
                noisy = log(-log(draw() or 0.5)) - mass
                low, high = sorted((-bound, noisy))
                heapq.heappush(queue, (high + math.log1p(math.exp(low - high)), next(serial), *region))

        def add(path: np.ndarray, heads: np.ndarray, since: int, bound: float, shared: np.ndarray, left: np.ndarray) -> None:
            """``shared`` and ``left`` are what the path it comes from had before and left at the edges up to their last one."""
            known = len(left)
            new = path[known:]
            before = np.empty(len(path) + 1)
            before[:known + 1] = shared
            before[known + 1:] = logs[new]
            np.cumsum(before[known:], out=before[known:])
            leave = np.empty(len(path))
            leave[:known] = left
            np.add(before[known:-1], rests[new], out=leave[known:])
            paths.append((path, heads, before, leave))
            done.append((path, float(before[-1])))
            push(_log_sum(leave[since:]), bound, len(paths) - 1, since, len(path), None)

        logs, rests = self._weights[_LOG], self._weights[_REST]
        queue: list[tuple] = []
        paths: list[tuple] = []
        done: list[tuple] = []
        serial = iter(range(1 << 62))
        add(*units(0, begin), 0, -log(-log(draw() or 0.5)), np.zeros(1), np.zeros(0))
        while queue and len(done) < len(drawn):
            bound, _, of, a, b, gone = heapq.heappop(queue)
            bound = -bound
            path, heads, before, leave = paths[of]
            if gone is None:
                part = leave[a:b]
                top = part.max()
                each = np.exp(part - top)
                shares = np.cumsum(each)
                d = a + min(int(np.searchsorted(shares, draw() * shares[-1], "right")), b - a - 1)
                push(_log_part(part[:d - a], each[:d - a], top), bound, of, a, d, None)
                push(_log_part(part[d - a + 1:], each[d - a + 1:], top), bound, of, d + 1, b, None)
                a, gone = d, (int(path[d]),)
            # the edges of the node that the path has left at decision a, but for those gone
            unit = int(np.searchsorted(heads, a, "right")) - 1
            node = int(np.searchsorted(self._first, path[a], "right")) - 1
            left = [e for e in range(int(self._first[node]), int(self._first[node + 1])) if e not in gone]
            weights = [float(self._weights[_LOG, e]) for e in left]
            top = max(weights)
            shares = [math.exp(w - top) for w in weights]
            u, c = draw() * sum(shares), 0
            while c < len(left) - 1 and u >= shares[c]:
                u -= shares[c]
                c += 1
            if len(left) > 1:
                others = [w for i, w in enumerate(weights) if i != c]
                push(float(before[a]) + _log_sum(np.array(others)), bound, of, a, a + 1, (*gone, left[c]))
            stem, starts = self._complete(left[c], draw), []
            stop = int(after[begin + unit])
            for i in range(begin + unit + 1, stop):
                starts.append(a + len(stem))
                stem += self._complete(self._drawn_edge(int(nodes[i]), draw), draw)
            rest, rest_heads = units(len(done), stop)
            grown = np.concatenate([path[:a], np.array(stem, np.int64), rest])
            begins = np.concatenate([heads[:unit + 1], np.array(starts, np.int64), a + len(stem) + rest_heads])
            add(grown, begins, a + 1, bound, before[:a + 1], leave[:a])
        if not queue:
            return [(self.spell(path), logp, 1.0) for path, logp in done]
        threshold = -queue[0][0]
        return [
            (self.spell(path), logp, -math.expm1(-math.exp(min(700.0, logp - threshold)))) for path, logp in done
        ]

    def sample(self, text: str, k: int, seed: str) -> list[tuple[list[int], float, float]]:
        """Up to k different segmentations of one text, likeliest draw first."""
        return [(ids.tolist(), logp, share) for ids, logp, share in self.sample_all([text], k, [seed])[0]]


def _seeds(seed: str, k: int) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{j} {seed}".encode(), digest_size=8).digest(), "little") for j in range(k)]


def _uniform(bases: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on ``bases`` and places alone: the mixing function of splitmix64."""
    x = at.astype(np.uint64)
    x *= np.uint64(_RATIO)
    x += bases
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    return x * 2.0**-53


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places of pairs of characters in a table of _PAIRS."""
    return (first * 0x9E3779B1 + second * 0x85EBCA77 >> 12) & (_PAIRS - 1)


def _names(codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of characters that depend on the characters alone."""
    powers = np.full(len(codes), _RATIO, np.uint64)
    powers[:1] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes) * powers, out=sums[1:])
    back = np.full(len(codes), _INVERSE, np.uint64)
    back[:1] = 1
    np.cumprod(back, out=back)
    return mix((sums[begins + lengths] - sums[begins]) * back[begins] + lengths.astype(np.uint64))


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _stable_order(numbers: np.ndarray, limit: int) -> np.ndarray:
    """Order of numbers from 0 below the limit; those of 16 bits are sorted by radix."""
    return np.argsort(numbers.astype(np.uint16) if limit <= 1 << 16 else numbers, kind="stable")


def _log_sum(logs: np.ndarray) -> float:
    top = logs.max(initial=-math.inf)
    return float(top + math.log(np.exp(logs - top).sum())) if top > -math.inf else -math.inf


def _log_part(logs: np.ndarray, shares: np.ndarray, top: float) -> float:
    """The log-sum of ``logs`` whose exponentials, without ``top``, are known; those that got too small are taken again."""
    total = float(shares.sum())
    return float(top) + math.log(total) if total > 1e-200 else _log_sum(logs)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to BATCH characters together, one text at least."""
    begin = size = 0
    for i, value in enumerate(texts):
        if i > begin and size + len(value) > BATCH:
            yield begin, i
            begin, size = i, 0
        size += len(value)
    if texts:
        yield begin, len(texts)


@functools.lru_cache(maxsize=1)
def _lattice(model: str, sharpness: float) -> Lattice:
    """A worker's lattices serve all its tasks; no draw depends on what they hold."""
    return Lattice(model, sharpness)


@functools.lru_cache(maxsize=1)
def _spelling(model: str) -> Spelling:
    return Spelling(model)


def encode(
    rows: DataFrame, model: str, keys: tuple[str, ...], text: str = "text", samples: int = SAMPLES,
    sharpness: float = SHARPNESS,
) -> DataFrame:
    """keys, sample, ids, log_prob, inclusion and the text: up to ``samples`` rows for each row.

    Whole texts, the draw seeded by the row's keys: equal keys draw alike wherever they are
    computed. A text with fewer segmentations has them all, with inclusion 1. Null and empty
    texts have one segmentation, without ids. Other columns are not read.
    """
    segment = _segment(model, keys, text, samples, sharpness)
    return rows.select(*keys, text).mapInArrow(released(segment), _encoded(rows, keys))


def encode_and_decode(
    rows: DataFrame, model: str, keys: tuple[str, ...], text: str = "text", samples: int = SAMPLES,
    sharpness: float = SHARPNESS,
) -> DataFrame:
    """What ``decode`` makes of ``encode``, by one worker for each task and without the ids on their way in between."""
    segment, spell = _segment(model, keys, text, samples, sharpness), _spell(model)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return spell(segment(batches))

    return rows.select(*keys, text).mapInArrow(released(both), _decoded(_encoded(rows, keys)))


def _encoded(rows: DataFrame, keys: tuple[str, ...]) -> T.StructType:
    return T.StructType(
        [f for f in rows.select(*keys).schema.fields]
        + [
            T.StructField("sample", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("log_prob", T.DoubleType()), T.StructField("inclusion", T.DoubleType()),
            T.StructField("text", T.StringType()),
        ]
    )


def _segment(model: str, keys: tuple[str, ...], text: str, samples: int, sharpness: float) -> Step:
    """A task's function: rows of ``keys`` and ``text`` to their segmentations."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model, sharpness)
        for batch in parts(batches, 2_000):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            for at, end in _slices(texts):
                part = batch.slice(at, end - at)
                names = list(zip(*[part.column(c).to_pylist() for c in keys], strict=True))
                drawn = lattice.sample_all(texts[at:end], samples, [repr(name) for name in names])
                found = [(i, k, *one) for i, several in enumerate(drawn) for k, one in enumerate(several)]
                owner = pa.array([f[0] for f in found], pa.int64())
                ends = np.cumsum([0, *[len(f[2]) for f in found]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(owner) for c in keys],
                        pa.array([f[1] for f in found], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([f[2] for f in found]), pa.int32())),
                        pa.array([f[3] for f in found], pa.float64()),
                        pa.array([f[4] for f in found], pa.float64()),
                        part.column(text).cast(pa.string()).take(owner),
                    ],
                    names=[*keys, "sample", "ids", "log_prob", "inclusion", "text"],
                )

    return segment


class Spelling:
    """The texts of many rows of ids at once, as the model's decoder spells them.

    What a piece adds behind another one is asked of the decoder once. Rows with ids that stand for no text, that
    begin with a piece of which the decoder leaves out more than a gap, or whose bytes are no text are left to the decoder.
    """

    def __init__(self, model: str):
        self.coder = coder = sentencepiece.SentencePieceProcessor(model_file=model)
        size = coder.get_piece_size()
        odd = [coder.is_control(i) or coder.is_unknown(i) or coder.is_unused(i) for i in range(size)]
        byte = [coder.is_byte(i) for i in range(size)]
        plain = [i for i in range(size) if not odd[i] and not byte[i]]
        before = next((i for i in plain if _GAP not in coder.id_to_piece(i)), None)
        tails = [bytes([int(coder.id_to_piece(i)[3:-1], 16)]) if byte[i] else b"" for i in range(size)]
        # gaps that the decoder leaves out where a row begins with the piece; -1: other than that
        skips = [0 if byte[i] else -1 for i in range(size)]
        if before is None:
            odd = [odd[i] or not byte[i] for i in range(size)]
        else:
            head = coder.decode([before])
            behind, alone = coder.decode([[before, i] for i in plain]), coder.decode([[i] for i in plain])
            for i, text, first in zip(plain, behind, alone, strict=True):
                tail = text.removeprefix(head)
                tails[i] = tail.encode()
                skips[i] = 0 if first == tail else 1 if first and tail == " " + first else -1
        self.odd, self.skips = np.array(odd, bool), np.array(skips, np.int64)
        self.lengths = np.array([len(x) for x in tails], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tails), np.uint8)

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        """The text of each row; row r has the ids from ends[r] to ends[r + 1]."""
        at = 0
        while at < len(ends) - 1:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + BATCH, "right")) - 1)
            yield from self._some(ids, ends[at : upto + 1].astype(np.int64))
            at = upto

    def _some(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        some = ids[ends[0] : ends[-1]]
        known = (some >= 0) & (some < len(self.lengths))
        which = np.where(known, some, 0)
        sizes = self.lengths[which]
        data = self.data[_ranges(self.begins[which], sizes)].tobytes()
        places = np.concatenate([[0], np.cumsum(sizes)])[ends - ends[0]]
        odd = np.concatenate([[0], np.cumsum(~known | self.odd[which])])[ends - ends[0]]
        filled = ends[:-1] < ends[1:]
        skips = np.zeros(len(filled), np.int64)
        skips[filled] = self.skips[which[ends[:-1][filled] - ends[0]]]
        skips[odd[:-1] < odd[1:]] = -1
        for r, (skip, begin, end) in enumerate(zip(skips.tolist(), places[:-1].tolist(), places[1:].tolist(), strict=True)):
            if skip >= 0:
                try:
                    yield data[begin + skip : end].decode()
                    continue
                except UnicodeDecodeError:
                    pass
            yield self.coder.decode(ids[ends[r] : ends[r + 1]].tolist())


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with a column decoded: the text its ids spell; null ids give a null."""
    return encoded.mapInArrow(released(_spell(model)), _decoded(encoded.schema))


def _decoded(encoded: T.StructType) -> T.StructType:
    return T.StructType([*[f for f in encoded.fields if f.name != "decoded"], T.StructField("decoded", T.StringType())])


def _spell(model: str) -> Step:
    """A task's function: encoded rows with the column ``decoded``."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = _spelling(model)
        for batch in batches:
            names = [name for name in batch.schema.names if name != "decoded"]
            ids = batch.column("ids")
            values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            whole = ids.is_valid().to_numpy(zero_copy_only=False)
            texts = [text if here else None for here, text in zip(whole, spelling.texts(values, ends), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "decoded"]
            )

    return spell
