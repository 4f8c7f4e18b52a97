"""LM scoring by logistic context mixing.

A text is predicted bit by bit. Its bytes are first turned into the bits of a prefix code (short for
bytes that are frequent behind the byte before), so a byte costs three to four decisions. For each
decision several predictors look up the odds of a one-bit in hashed tables, each under its own
context: the byte before, the two, three and four bytes before, the word before with the word so
far, and the word so far. Their log-odds are mixed by a weight vector chosen by a gate (how far into
the word the byte lies, and how often the three longest contexts were seen), and an adaptive table,
indexed by the place in the code and the mixed log-odds, refines the result. The model's log10
probability of a text is the sum over all decisions, the one that ends the text included.

Contexts run through the whole text, across its words, and begin anew only with the next text. Texts
are counted and scored in pieces of bounded size; what a text has behind it goes from piece to
piece. Each task counts its texts into tables of its own, which are added up by slot. Weights and
refinement are fitted online on all training texts, whole ones, each half of them against the counts
of the other: each task fits on its part, and the tasks' results are averaged by what they saw.
Scoring uses the fitted model as it is, so a text's score depends on nothing but the text.

The base score is a unigram over words with add-one smoothing. Counts are exact: frequent words come
with a table of bounded size, the rest through a join.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions, slices, strings

#: log2 of the slots of each predictor's table.
SLOT_BITS = (16, 18, 20, 20, 22, 21)
#: Slots of a block of a table: the unit in which counts are merged.
BLOCK_BITS = 14
DEPTHS = 8
#: A slot was seen so often at least: levels 1, 2 and 3 of the gate.
SEEN = (1, 4, 20)
GATES = DEPTHS * (len(SEEN) + 1) ** 3
#: Steps of a table entry for a unit of log-odds.
FINE = 256
#: Training texts are fitted half by half, each against the counts of the other.
HALVES = 2
#: A fitting task has at least so many texts, where there are as many.
FIT_ROWS = 2_000
FIT_STEP = 8_192
#: Shares of :func:`fit_sample`.
FIT_PARTS = 32
FIT_MOST = 4
RATE = 0.02
REFINE_BINS = 65
REFINE_LIMIT = 8.0
#: Frequent words that are looked up in a table sent to every task; the others are joined.
FREQUENT = 200_000
#: Random factors for the places in a word, used in turn; a power of two.
LONGEST = 256
#: Bytes before a byte that the orders look at.
ORDERS = 4
#: Bytes of text after which a task hands on its counts, so they fit 32 bits.
_COUNTED = 1 << 28
_CHUNK = 1 << 15
_SLICE_BYTES = 1 << 20
_END_BYTE = 255  # ends a text; no UTF-8 text holds it
_LN10 = float(np.log(10))
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)
#: A random factor for each place in a unit.
_PLACES = np.random.default_rng(5).integers(1, 1 << 63, LONGEST, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fold(text: str) -> bytes:
    """UTF-8 bytes with A-Z lower-cased."""
    return text.encode().translate(_FOLD)


def _prefix_code(counts: list[int]) -> list[list[tuple[int, int]]]:
    """Huffman's construction: for each byte the inner nodes and bits on its path."""
    heap = [(c + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for up in range(256, 511):
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]], parent[b[1]] = (up, 0), (up, 1)
        heapq.heappush(heap, (a[0] + b[0], up))
    paths = []
    for byte in range(256):
        path, at = [], byte
        while at in parent:
            at, bit = parent[at]
            path.append((at - 256, bit))
        paths.append(path[::-1])
    return paths


@dataclass
class Code:
    """Prefix codes, one for each byte before (0 at the beginning): the decisions of a byte behind
    another are ``start[pair]`` and the following ``length[pair]``, ``pair`` being before * 256 +
    byte."""

    length: np.ndarray
    start: np.ndarray
    node: np.ndarray  # inner node of each decision, times REFINE_BINS
    bit: np.ndarray   # its bit

    def __post_init__(self) -> None:
        before = np.repeat(np.arange(1 << 16) >> 8, self.length)
        # Slot behind the byte before alone (before * 256 + node) and the bit, in one number.
        self.steps = ((before * 256 + self.node // REFINE_BINS) * 2 + self.bit).astype(np.intp)

    @staticmethod
    def build(counts: np.ndarray) -> Code:
        """From counts of pairs; every byte stays possible behind every other."""
        paths = [p for row in counts.reshape(256, 256).tolist() for p in _prefix_code(row)]
        length = np.array([len(p) for p in paths])
        steps = np.array([x for p in paths for x in p])
        return Code(length, np.cumsum(length) - length, steps[:, 0] * REFINE_BINS,
                    np.ascontiguousarray(steps[:, 1]))


@dataclass
class Units:
    """Distinct units, one behind the other."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    def words(self) -> pa.Array:
        """Each unit without the byte behind its word."""
        return pc.binary_slice(self.binary(), 0, -1)

    def binary(self) -> pa.Array:
        offsets = np.append(self.starts, len(self.data)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.starts),
                                     [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data))])


def from_binary(column: pa.Array) -> Units:
    """Units of an Arrow column of them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    blob = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Units(blob, at[:-1] - at[0], np.diff(at))


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, start of each unit, its length, first unit of each text)``. Behind every text
    stands the end byte."""
    mark = bytes((_END_BYTE,))
    data = np.frombuffer(mark.join(texts) + mark if texts else b"", np.uint8)
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) - 1
    border = _SPACE.take(data)
    border[ends] = True
    last = np.flatnonzero(border)
    starts = np.concatenate((np.zeros(min(1, len(last)), np.int64), last[:-1] + 1))
    begin = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1] + 1))
    return data, starts, last - starts + 1, np.searchsorted(starts, begin)


def distinct(texts: list[bytes]) -> tuple[Units, np.ndarray, np.ndarray]:
    """``(units, unit of each token, first token of each text)``. Units are told apart by 64-bit
    hashes."""
    data, starts, lengths, first = cut(texts)
    if not len(starts):
        return Units(data, starts, lengths), starts, first
    place = np.arange(len(data), dtype=np.int32)
    place -= np.repeat(starts.astype(np.int32), lengths)
    place &= LONGEST - 1
    mixed = _PLACES.take(place)
    mixed *= data
    h = np.add.reduceat(mixed, starts) + lengths.astype(np.uint64) * _SALT
    del place, mixed
    for i in np.flatnonzero(lengths > LONGEST):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + lengths[i]].tobytes())
    told = pa.array(h).dictionary_encode()
    which = told.indices.to_numpy().astype(np.intp)
    chosen = np.empty(len(told.dictionary), np.intp)
    chosen[which[::-1]] = np.arange(len(which))[::-1]
    sizes = lengths[chosen]
    begin = np.cumsum(sizes) - sizes
    data = data.take(np.repeat(starts[chosen] - begin, sizes) + np.arange(sizes.sum()))
    return Units(data, begin, sizes), which, first


@dataclass
class Behind:
    """What the text that goes on in the next piece has behind it."""

    on: bool = False  # the next piece begins inside a text
    tail: np.ndarray = field(default_factory=lambda: np.zeros(ORDERS, np.uint64))  # last bytes + 1
    depth: int = 0  # bytes of the word so far
    so_far: np.uint64 = np.uint64(0)  # and their hash
    word: np.uint64 = np.uint64(0)  # hash of the word before


def runs(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Behind]]:
    """``(bytes, beginnings, text at each beginning, what is behind the first)``: texts that start
    at ``starts`` in pieces of bounded size. A piece's contexts are to be made before the next."""
    behind = Behind()
    for at in range(0, len(data), _CHUNK):
        end = min(at + _CHUNK, len(data))
        a, b = np.searchsorted(starts, (at, end)).tolist()
        fresh, text = starts[a:b] - at, np.arange(a, b)
        behind.on = a == len(starts) or starts[a] > at
        if behind.on:
            fresh, text = np.append(0, fresh), np.append(a - 1, text)
        yield data[at:end], fresh, text, behind


def parts(units: Units) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pieces of ``units``."""
    for data, fresh, unit, _ in runs(units.data, units.starts):
        yield data, fresh, unit


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, start of each text)``. Behind every text stands the end byte."""
    mark = bytes((_END_BYTE,))
    data = np.frombuffer(mark.join(texts) + mark if texts else b"", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    return data, np.cumsum(sizes) - sizes


def pairs(data: np.ndarray, fresh: np.ndarray, behind: Behind | None = None) -> np.ndarray:
    """The byte before (0 where contexts begin) * 256 + byte."""
    out = data.astype(np.int64)
    before = np.concatenate((np.zeros(1, np.int64), out[:-1]))
    before[fresh] = 0
    if behind is not None and behind.on:
        before[0] = int(behind.tail[-1]) - 1
    return before * 256 + out


def contexts(data: np.ndarray, fresh: np.ndarray,
             behind: Behind | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Context of every predictor at each byte, and how far it lies in its word. ``behind`` is
    brought up to the end of the piece."""
    n = len(data)
    old = behind if behind is not None and behind.on else Behind()
    begins = np.zeros(n, bool)
    begins[1:] = _SPACE.take(data[:-1])
    begins[fresh] = True
    words = np.flatnonzero(begins)
    sizes = np.diff(np.append(words, n))
    depth = np.arange(n) - np.repeat(words, sizes)
    depth[:sizes[0]] += old.depth
    b = data.astype(np.uint64) + np.uint64(1)
    line = np.concatenate((old.tail, b))
    # The byte before lies in the salt of a decision.
    out = [np.zeros(n, np.uint64)]
    inner = fresh[1:] if old.on else fresh
    for k in range(2, ORDERS + 1):
        back = line[ORDERS - k:ORDERS - k + n].copy()
        none = (inner[:, None] + np.arange(k)).ravel()
        back[none[none < n]] = 0
        back *= np.uint64(257 ** (k - 2))
        out.append(out[-1] + back)
    place = _PLACES.take(depth & (LONGEST - 1))
    if depth.max() >= LONGEST:
        place += (depth // LONGEST).astype(np.uint64) * _SALT
    place *= b
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(place)))
    so_far = sums[:-1] - np.repeat(sums.take(words), sizes)
    so_far[:sizes[0]] += old.so_far
    # The last word that is not empty before each word, in its text.
    last = words + sizes - 1
    whole = so_far.take(last)
    known = np.maximum.accumulate(np.where(depth.take(last) > 0, np.arange(len(words)), -1))
    known = np.append(-1, known[:-1])
    at = np.searchsorted(words, fresh)
    lowest = np.repeat(at, np.diff(np.append(at, len(words))))
    before = np.where(known >= lowest, whole.take(known), np.uint64(0))
    if old.on:
        before[(lowest == 0) & (known < 0)] = old.word
    mixed = before * _SALT
    mixed ^= mixed >> np.uint64(29)
    out.append(so_far + np.repeat(mixed * _MULTIPLY, sizes))
    out.append(so_far)
    if behind is not None:
        behind.tail = line[n:].copy()
        seen = n - int(fresh[-1])
        if seen < ORDERS and not (old.on and len(fresh) == 1):
            behind.tail[:ORDERS - seen] = 0
        if _SPACE[data[-1]]:
            behind.word = whole[-1] if depth[-1] else before[-1]
            behind.depth, behind.so_far = 0, np.uint64(0)
        else:
            behind.word = before[-1]
            behind.depth, behind.so_far = int(depth[-1]) + 1, (so_far[-1:] + place[-1:])[0]
    return out, depth


def decisions(data: np.ndarray, fresh: np.ndarray, code: Code, behind: Behind | None = None):
    """For every bit decision of ``data``: node (times REFINE_BINS), bit, slot of each predictor,
    depth; and the first decision behind each beginning."""
    pair = pairs(data, fresh, behind)
    ctx, depth = contexts(data, fresh, behind)
    sizes, start = code.length.take(pair), code.start.take(pair)
    ends = np.cumsum(sizes)
    first = ends - sizes
    # A decision's byte and its place in the code are running sums, as every byte has a decision.
    pos = np.zeros(int(ends[-1]), np.intp)
    pos[first[1:]] = 1
    np.cumsum(pos, out=pos)
    place = np.ones(len(pos), np.intp)
    place[first] = start
    place[first[1:]] -= (start + sizes)[:-1] - 1
    np.cumsum(place, out=place)
    # All places lie in their arrays; mode "clip" spares a second look at them.
    steps = code.steps.take(place, mode="clip")
    bit = steps & 1
    steps >>= 1
    node = steps & 255
    # Nodes near the root have high numbers, so a context's first decisions lie side by side.
    turn = 255 - node
    slots = [steps]
    before = (pair >> 8).astype(np.uint64)
    before *= _SALT
    for c, bits in zip(ctx[1:], SLOT_BITS[1:], strict=True):
        # A context is hashed once a byte, with the byte before; its decisions lie apart by their nodes.
        c = c * _MULTIPLY
        c += before
        c ^= c >> np.uint64(32)
        c *= _MULTIPLY
        c >>= np.uint64(64 - bits)
        h = c.view(np.intp).take(pos, mode="clip")
        h ^= turn
        slots.append(h)
    depth = np.minimum(depth, DEPTHS - 1).astype(np.int16)
    node *= REFINE_BINS
    return node, bit, slots, depth.take(pos, mode="clip"), first[fresh]


def entries(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Table entries of counts: log-odds of a one in steps of ``1 / FINE``, times four, plus the
    level of ``SEEN``. An unseen slot says nothing (0)."""
    odds = np.log((ones + 0.4) / (zeros + 0.4)) * FINE
    level = np.searchsorted(np.array(SEEN), zeros + ones, side="right")
    return (np.clip(np.rint(odds), -8000, 8000).astype(np.int16) << 2) + level.astype(np.int16)


@dataclass
class Model:
    code: Code
    tables: list[np.ndarray]  # entries
    weights: np.ndarray  # (gate, predictor + 1)
    refine: np.ndarray   # (node, bin) log-odds

    def _inputs(self, slots, depth) -> tuple[list[np.ndarray], np.ndarray]:
        """The predictors' log-odds in steps of ``1 / FINE`` and the gate of each decision."""
        found = [t.take(s, mode="clip") for t, s in zip(self.tables, slots, strict=True)]
        gate = depth.astype(np.int16)
        for f in found[-1:-4:-1]:
            gate <<= 2
            gate += f & 3
        for f in found:
            f >>= 2
        return [f.astype(np.float32) for f in found], gate.astype(np.intp)

    def _sum(self, x, gate) -> np.ndarray:
        """The mixed log-odds."""
        columns = self.weights.T * np.float32(1 / FINE)  # a power of two: exact
        z = (self.weights[:, -1] * np.float32(0.3)).take(gate, mode="clip")
        for v, w in zip(x, columns, strict=False):
            w = w.take(gate, mode="clip")
            w *= v
            z += w
        return z

    def _bins(self, node, z) -> np.ndarray:
        """Refinement slot nearest to the mixed log-odds."""
        scale = np.float32((REFINE_BINS - 1) / (2 * REFINE_LIMIT))
        at = z * scale
        at += np.float32(REFINE_LIMIT * scale + 0.5)
        np.clip(at, np.float32(0), np.float32(REFINE_BINS - 1), out=at)
        slot = at.astype(np.int32)
        slot += node
        return slot

    def _final(self, node, z) -> np.ndarray:
        out = self.refine.ravel().take(self._bins(node, z), mode="clip")
        out += z
        out *= np.float32(0.5)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        out = np.zeros(len(texts))
        for data, fresh, text, behind in runs(*joined(texts)):
            node, bit, slots, depth, first = decisions(data, fresh, self.code, behind)
            z = self._final(node, self._sum(*self._inputs(slots, depth)))
            # Nats of a decision: log(1 + e^z) with the sign that the bit gives z.
            away = np.abs(z)
            z *= (1 - 2 * bit).astype(np.float32)
            nats = np.maximum(z, np.float32(0))
            np.negative(away, out=away)
            np.exp(away, out=away)
            away += np.float32(1)
            nats += np.log(away, out=away)
            np.subtract.at(out, text, np.add.reduceat(nats, first, dtype=np.float64) / _LN10)
        return out

    def fit(self, texts: Iterable[list[bytes]], rate: float = RATE,
            step: int = FIT_STEP) -> tuple[np.ndarray, np.ndarray]:
        """Online over slices of texts in their order: for each run of decisions predict, then
        move the weights of their gates (by steps that shrink with the gradients so far) and the
        refinement slots towards what happened. Returns the decisions of each gate and slot."""
        flat = self.refine.ravel()
        chance = 1 / (1 + np.exp(-flat.astype(np.float64)))
        rounds = np.zeros(flat.size)
        passed = np.zeros(GATES)
        sizes = np.full(self.weights.T.shape, 1e-2)
        moves = np.zeros(sizes.shape)
        for data, fresh, _, behind in chain.from_iterable(runs(*joined(t)) for t in texts):
            node, bit, slots, depth, _ = decisions(data, fresh, self.code, behind)
            inputs, gates = self._inputs(slots, depth)
            hits = bit.astype(np.float32)
            for at in range(0, len(hits), step):
                part = slice(at, at + step)
                x, gate, y = [v[part] for v in inputs], gates[part], hits[part]
                z = self._sum(x, gate)
                slot = self._bins(node[part], z)
                np.clip(z, np.float32(-20), np.float32(20), out=z)
                np.negative(z, out=z)
                np.exp(z, out=z)
                z += np.float32(1)
                np.reciprocal(z, out=z)
                miss = np.subtract(y, z, out=z)
                for j, v in enumerate(x):
                    v *= miss
                    moves[j] = np.bincount(gate, v, GATES)
                moves[:-1] /= FINE
                miss *= np.float32(0.3)
                moves[-1] = np.bincount(gate, miss, GATES)
                sizes += moves * moves
                self.weights += (rate * moves / np.sqrt(sizes)).T.astype(np.float32)
                n = np.bincount(slot, minlength=flat.size)
                used = np.flatnonzero(n > 0)
                n = n[used]
                p = chance[used]
                mean = np.bincount(slot, y, flat.size)[used] / n
                seen = rounds[used] + n
                rounds[used] = seen
                share = np.maximum(n / (seen + 20), 0.002)
                chance[used] = np.clip(p + share * (mean - p), 1e-4, 1 - 1e-4)
            passed += np.bincount(gates, minlength=GATES)
        # No step above looks at the refined log-odds.
        used = rounds > 0
        flat[used] = np.log(chance[used] / (1 - chance[used]))
        return passed, rounds


def empty_model(code: Code, tables: list[np.ndarray]) -> Model:
    weights = np.full((GATES, len(SLOT_BITS) + 1), 0.25, np.float32)
    weights[:, -1] = 0
    centers = np.linspace(-REFINE_LIMIT, REFINE_LIMIT, REFINE_BINS, dtype=np.float32)
    return Model(code, tables, weights, np.tile(centers, (256, 1)).copy())


def held_out(doc_id="doc_id", parts: int = 7, part: int = 2):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


_COUNTS = "kind int, block int, counts binary"
_COUNTED_ROWS = "kind int, block int, counts binary, places binary, above binary"


def _merge_blocks(counted: DataFrame) -> DataFrame:
    """Sum (64 bits) of the count blocks of each (kind, block). A task sends a block once
    for every ``_COUNTED`` bytes, so a group has about as many rows as there are tasks, of bounded
    size; they are added as they come."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                 pa.array([total.tobytes()], pa.binary())], ["kind", "block", "counts"])

        for b in slices(batches, 64):
            for kind, block, counts, places, above in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (kind, block) != key:
                    if key is not None:
                        yield row()
                    key, total = (kind, block), np.zeros(len(counts), np.int64)
                total += np.frombuffer(counts, np.uint8)
                total[np.frombuffer(places, np.int32)] += np.frombuffer(above, np.int32)
        if key is not None:
            yield row()

    return (counted.repartition("kind", "block").sortWithinPartitions("kind", "block")
            .mapInArrow(add, _COUNTS))


def count_units(texts: DataFrame) -> DataFrame:
    """``(unit, n)`` over all texts; each slice is added up before the shuffle, each task again."""
    def run(batches):
        for b in slices(batches, 5_000, "text", _SLICE_BYTES):
            units, which, _ = distinct([fold(t) for t in strings(b.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [units.binary(), pa.array(np.bincount(which, minlength=len(units.starts)), pa.int64())],
                ["unit", "n"])

    return (texts.select("text").mapInArrow(run, "unit binary, n long")
            .groupBy("unit").agg(F.sum("n").alias("n")))


def count_words(units: DataFrame) -> DataFrame:
    """``(word, n)`` of counted units."""
    word = F.expr("substring(unit, 1, length(unit) - 1)")
    return (units.filter("length(unit) > 1").groupBy(word.alias("word"))
            .agg(F.sum("n").alias("n")))


def _count_blocks(texts: DataFrame, shapes: list[tuple[int, ...]], block: int, make) -> DataFrame:
    """Counts of the texts (``half``, ``text``), added up over the tasks: ``make()`` gives a task its
    ``add(tables, texts)``, which counts a half's share of a slice into its rows of tables of
    ``(halves * rows, slots)``, the ``shapes``; a row holds ``block`` columns of one of them."""
    def run(batches):
        add = make()
        tables, size = [np.zeros(s, np.int32) for s in shapes], 0

        def rows():
            for kind, t in enumerate(tables):
                for i in range(t.shape[1] // block):
                    part = t[:, i * block:(i + 1) * block].ravel()
                    if part.any():
                        # A byte a count; what is above 255 follows by place.
                        many = np.flatnonzero(part > 255).astype(np.int32)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([kind], pa.int32()), pa.array([i], pa.int32()),
                             pa.array([np.minimum(part, 255).astype(np.uint8).tobytes()]),
                             pa.array([many.tobytes()]), pa.array([(part[many] - 255).tobytes()])],
                            ["kind", "block", "counts", "places", "above"])

        for b in slices(batches, 5_000, "text", _SLICE_BYTES):
            found = by_half(b)
            more = sum(len(t) + 1 for _, texts in found for t in texts)
            if size + more > _COUNTED and size:
                yield from rows()
                for t in tables:
                    t[:] = 0
                size = 0
            for half, texts in found:
                add([t[half * rows_of:(half + 1) * rows_of] for t in tables], texts)
            size += more
        yield from rows()

    rows_of = shapes[0][0] // HALVES
    return _merge_blocks(texts.select("half", "text").mapInArrow(run, _COUNTED_ROWS))


def by_half(b: pa.RecordBatch) -> list[tuple[int, list[bytes]]]:
    """Folded texts of each half that a batch (``half``, ``text``) holds."""
    halves, texts = b.column("half").to_pylist(), strings(b.column("text"))
    found = ((h, [fold(t) for g, t in zip(halves, texts, strict=True) if g == h]) for h in range(HALVES))
    return [(h, t) for h, t in found if t]


def _count_pairs(texts: DataFrame) -> np.ndarray:
    def add(tables, found):
        for data, fresh, _, behind in runs(*joined(found)):
            tables[0][0] += np.bincount(pairs(data, fresh, behind), minlength=1 << 16).astype(np.int32)
            behind.tail[-1] = int(data[-1]) + 1

    total = np.zeros(1 << 16, np.int64)
    for r in _count_blocks(texts, [(HALVES, 1 << 16)], 1 << 16, lambda: add).collect():  # one row
        total += np.frombuffer(r["counts"], np.int64).reshape(HALVES, -1).sum(0)
    return total


def _add(tables: list[np.ndarray], data: np.ndarray, fresh: np.ndarray, n: np.ndarray, code: Code,
         behind: Behind | None = None) -> None:
    """Add a piece's decisions to the predictors' counts, ``(bit, slot)``: each as often as its
    beginning's ``n``. The rows of a table are contiguous."""
    _, bit, slots, _, first = decisions(data, fresh, code, behind)
    times = np.repeat(n.astype(tables[0].dtype), np.diff(np.append(first, len(bit))))
    for t, s, bits in zip(tables, slots, SLOT_BITS, strict=True):
        np.add.at(t.ravel(), s + (bit << bits), times)


def add_texts(tables: list[np.ndarray], texts: list[bytes], code: Code) -> None:
    """Add the decisions of whole texts."""
    for data, fresh, _, behind in runs(*joined(texts)):
        _add(tables, data, fresh, np.ones(len(fresh), np.int64), code, behind)


def fitted(code: Code, tables: list[np.ndarray], sample: list[bytes]) -> Model:
    """A model of counts ``(bit, slot)``, weights and refinement fitted in this process on ``sample``,
    texts that were counted: what they added is left out while fitting."""
    own = [np.zeros(t.shape, np.int64) for t in tables]
    add_texts(own, sample, code)
    model = empty_model(code, [entries(*np.maximum(t - o, 0)) for t, o in zip(tables, own, strict=True)])
    model.fit([sample])
    model.tables = [entries(*t) for t in tables]
    return model


def fit_sample(docs: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 11) -> tuple[DataFrame, DataFrame, int]:
    """A share of the texts, for trials; :func:`train` fits on all of them instead. ``(texts to fit on,
    the other texts, fitting tasks)`` of ``docs`` (``doc_id``, ``text``). A
    row's id and text decide, so the choice does not depend on order or partitions; rows that are
    equal in both are chosen together and dealt to tasks (``_task``) one by one."""
    rows = docs.count()
    share = min(1 / FIT_MOST, max(1 / FIT_PARTS, fit_rows / max(1, rows)))
    hashed = docs.select(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text").alias("_h"), "text")
    low = F.col("_h") <= int(share * 2**64) - 2**63
    equal = hashed.filter(low).groupBy("_h", "text").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    tasks = max(1, round(rows * share / max(1, fit_rows)))
    # Whole texts, each in full.
    chosen = (equal.select("_h", "text", F.explode(F.expr("sequence(1, _n)")).alias("_copy"))
              .withColumn("_task", F.pmod(F.xxhash64(F.lit(seed + 1), "_h", "_copy"), F.lit(tasks)).cast("int")))
    return chosen, hashed.filter(~low).select("text"), tasks


def halved(docs: DataFrame, seed: int = 11) -> DataFrame:
    """``(half, text)``, a row per row of ``docs`` (``doc_id``, ``text``): id and text decide."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text")
    return docs.select(F.pmod(h, F.lit(HALVES)).cast("int").alias("half"), "text")


def train(docs: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 11) -> Model:
    """Fit a model on the texts of ``docs`` (``doc_id``, ``text``): the tables on all of them, weights
    and refinement on all of them too, each half against the counts of the other. A fitting task has
    ``fit_rows`` texts at least, if there are as many."""
    spark = docs.sparkSession
    texts = halved(docs, seed)
    code = Code.build(_count_pairs(texts))
    held = spark.sparkContext.broadcast((code.length, code.start, code.node, code.bit))
    size = 1 << BLOCK_BITS

    def make():
        own = Code(*held.value)
        return lambda tables, found: add_texts(tables, found, own)

    counted = _count_blocks(texts, [(HALVES * 2, 1 << bits) for bits in SLOT_BITS], size, make)

    def table_blocks(batches):
        for b in slices(batches, 16):
            found = [np.frombuffer(c, np.int64).reshape(HALVES, 2, size) for c in b.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("kind"), b.column("block"),
                 # What a half is fitted against, half by half.
                 pa.array([b"".join(entries(*(c.sum(0) - own)).tobytes() for own in c) for c in found], pa.binary()),
                 pa.array([entries(*c.sum(0)).tobytes() for c in found], pa.binary())],
                ["kind", "block", "others", "counts"])

    entry_rows = materialise(counted.mapInArrow(
        table_blocks, "kind int, block int, others binary, counts binary"), "cm-tables")
    tables = [np.zeros(1 << bits, np.int16) for bits in SLOT_BITS]
    others = [[np.zeros(1 << bits, np.int16) for bits in SLOT_BITS] for _ in range(HALVES)]
    # The whole model: 2 bytes a slot and as many for each half, a size fixed by SLOT_BITS.
    for r in entry_rows.toLocalIterator():
        at = slice(r["block"] * size, (r["block"] + 1) * size)
        tables[r["kind"]][at] = np.frombuffer(r["counts"], np.int16)
        for t, part in zip(others, np.frombuffer(r["others"], np.int16).reshape(HALVES, size), strict=True):
            t[r["kind"]][at] = part
    model = empty_model(code, tables)
    held_tables = spark.sparkContext.broadcast(others)

    def fit_all(batches):
        own = empty_model(Code(*held.value), held_tables.value[0])

        def found():
            for b in slices(batches, 5_000, "text", _SLICE_BYTES):
                for half, part in by_half(b):
                    own.tables = held_tables.value[half]
                    yield part

        passed, rounds = own.fit(found())
        if passed.any():
            arrays = [passed, own.weights * passed[:, None], rounds, own.refine.ravel() * rounds]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a.astype(np.float64).tobytes()], pa.binary()) for a in arrays],
                ["passed", "weights", "rounds", "refine"])

    # Dealt in turn, so equal rows do not meet in one task.
    tasks = max(1, min(shuffle_partitions(spark), docs.count() // max(1, fit_rows)))
    parts_fitted = (texts.repartition(tasks).sortWithinPartitions(F.xxhash64("text"), "text", "half")
                    .mapInArrow(fit_all, "passed binary, weights binary, rounds binary, refine binary"))
    sums = [np.zeros(GATES), np.zeros(model.weights.shape), np.zeros(model.refine.size), np.zeros(model.refine.size)]
    # A row of a fixed size for each task, added up as they come.
    for r in materialise(parts_fitted, "cm-fitted").toLocalIterator():
        for total, name in zip(sums, ("passed", "weights", "rounds", "refine"), strict=True):
            total += np.frombuffer(r[name], np.float64).reshape(total.shape)
    passed, weights, rounds, refine = sums
    model.weights[passed > 0] = weights[passed > 0] / passed[passed > 0, None]
    model.refine.ravel()[rounds > 0] = refine[rounds > 0] / rounds[rounds > 0]
    return model


def score(docs: DataFrame, model: Model, units: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)``, a row
    per row of ``docs``; ``units`` are the counted units of the training rows. Bits are those of the
    model over the text's UTF-8 bytes and its end."""
    spark = docs.sparkSession
    counts = materialise(count_words(units), "cm-words")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # One end token per training text: a unit behind whose word no white space stands.
    ends = units.filter(F.expr(f"substring(unit, -1, 1) = X'{_END_BYTE:02X}'")).agg(F.sum("n")).first()[0] or 0
    total, distinct_words = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    scale = float(np.log10(total + distinct_words + 1))
    top = counts.orderBy(F.col("n").desc(), "word").limit(frequent)
    # At most `frequent` words and log10(c + 1) of them.
    table = [(bytes(r["word"]), math.log10(r["n"] + 1)) for r in top.toLocalIterator()]
    table = (pa.array([w for w, _ in table], pa.binary()), np.array([x for _, x in table]))
    held = spark.sparkContext.broadcast((
        model.code.length, model.code.start, model.code.node, model.code.bit,
        model.tables, model.weights, model.refine, table))
    log_ends = float(np.log10(ends + 1)) - scale

    def run(batches):
        length, start, node, bit, tables, weights, refine, (known_words, known_logs) = held.value
        own = Model(Code(length, start, node, bit), tables, weights, refine)
        known = dict(zip(known_words.to_pylist(), known_logs.tolist(), strict=True))
        for b in slices(batches, 5_000, "text", _SLICE_BYTES):
            texts = [fold(t) for t in strings(b.column("text"))]
            found, which, first = distinct(texts)
            words = found.words()
            # 0 for no word, its logarithm for a frequent one, else not a number.
            logs = np.array([known.get(w, math.nan) for w in words.to_pylist()], np.float64)
            logs[found.lengths == 1] = 0.0
            here = logs.take(which)
            missing = np.isnan(here)
            is_word = (found.lengths > 1).take(which)
            tokens = np.add.reduceat(is_word, first, dtype=np.int64) + 1
            absent = np.add.reduceat(missing, first, dtype=np.int64)
            # The words that are not in the table, once for each text, with their number there.
            text = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(which))))
            keys, times = np.unique(text[missing] * len(words) + which[missing], return_counts=True)
            offsets = np.searchsorted(keys, np.arange(len(first) + 1) * len(words)).astype(np.int32)
            rest = words.take(pa.array(keys % len(words)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), b.column("_row"), pa.array(tokens),
                 pa.array(tokens - 1 - absent),
                 pa.array(np.add.reduceat(np.where(missing, 0.0, here), first)),
                 pa.array(own.score(texts)), pa.array([len(t) + 1 for t in texts], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), rest),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(times, pa.int64()))],
                ["doc_id", "held_out", "_row", "n_tokens", "_known", "_log", "score", "_bytes",
                 "_rest", "_times"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.monotonically_increasing_id().alias("_row"),
                       F.col("text").cast("string").alias("text"))
    part = materialise(rows.mapInArrow(
        run, "doc_id long, held_out boolean, _row long, n_tokens long, _known long, _log double, "
             "score double, _bytes long, _rest array<binary>, _times array<long>"), "cm-scores")
    # Words outside the table, with their exact counts through a join.
    rare = part.select("_row", F.explode(F.arrays_zip("_rest", "_times")).alias("_w")).select(
        "_row", F.col("_w._rest").alias("word"), F.col("_w._times").alias("_t"))
    met = rare.join(counts, "word")
    found = met.groupBy("_row").agg(F.sum("_t").alias("_known2"),
                                    F.sum(F.col("_t") * F.log10(F.col("n") + 1)).alias("_log2"))
    out = part.drop("_rest", "_times").join(found, "_row", "left")
    known_end = F.lit(1 if ends else 0)
    base = (F.col("_log") + F.coalesce("_log2", F.lit(0.0))
            - (F.col("n_tokens") - 1) * F.lit(scale) + F.lit(log_ends))
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("_known") + F.coalesce("_known2", F.lit(0)) + known_end).cast("long").alias("n_known"),
                      F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
                      (-F.col("score") * F.lit(math.log2(10)) / F.col("_bytes")).alias("bits_per_byte"))


def language_model(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and score every row of ``docs``.

    Texts are folded (A-Z lower-cased), a null text is empty: it scores its end. A null ``doc_id``
    is not held out. Repeated rows count and are scored each time. With no training row the tables
    say nothing and no token is known; an empty table gives no rows.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    training = rows.filter(~held_out())
    units = materialise(count_units(training), "cm-units")
    return score(rows, train(training), units)
