"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words and the 4- and 5-byte beginnings of its longer
words, hashed to buckets. The score is

    sigmoid(b + sum_i w_i + 1/2 * sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over the terms present: ``w`` are additive weights, and the factors ``v`` give every pair of terms
an interaction ``<v_i, v_j>`` (an insult together with a mention of a group), learned also for
pairs never seen together. Fitted by mini-batch AdaGrad on a bounded sample of labelled rows. While
fitting, a term counts by how far its share of toxic rows lies from chance, in standard deviations, so
the many terms of a long text that happened to fall into few rows are not learned by heart. A term of
many rows counts too, as its pairs may tell what it does not tell by itself. The fitted weights hold
these factors, so scoring knows nothing of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, strings

#: Labelled rows that the machine is fitted on at most, taken in the order of a seeded hash.
MAX_FIT_ROWS = 24_000
BUCKETS = 1 << 20
FACTORS = 4
#: Buckets present in fewer fitted rows keep no weight.
MIN_ROWS = 3
#: Standard deviations from chance, or rows, at which a term counts in full; the least and the most it
#: counts.
EVIDENCE = 10
COMMON = 1_000
LEAST, MOST = 0.05, 3.0
EPOCHS = 12
BATCH = 256
RATE = 0.3
DECAY = 3e-4
SEED = 17
THRESHOLD = 0.3
#: A word's beginnings that are terms of their own, so inflected forms share what is learned.
PREFIXES = (4, 5)
#: Odd multipliers of the hash.
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: A-Z to a-z; white space and punctuation to the separator; other bytes (UTF-8 too) unchanged.
_FOLD = bytes(32 if chr(c).isspace() or chr(c) in ".,;:!?\"'()[]{}<>" else ord(chr(c).lower())
              for c in range(128)) + bytes(range(128, 256))


class Terms:
    """Hashed terms of a text: prefix sums of ``byte * BASE**position`` modulo 2**64 give the hash
    of any word or beginning in one subtraction, so a text is hashed in a few array passes."""

    def __init__(self, buckets: int = BUCKETS, chunk: int = 1 << 18) -> None:
        self.chunk = chunk
        self.shift = np.uint64(64 - (buckets - 1).bit_length())
        self.buckets = buckets
        self.power, self.inverse = (
            np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(chunk, x, np.uint64))))
            for x in (_BASE, pow(_BASE, -1, 1 << 64)))

    def _pieces(self, raw: bytes) -> Iterator[bytes]:
        """``raw`` in pieces that end at a separator; only a longer single word is cut."""
        at = 0
        while at < len(raw):
            end = at + self.chunk
            if end < len(raw):
                space = raw.rfind(b" ", at, end)
                end = space if space > at else end
            yield raw[at:end]
            at = end

    def __call__(self, text: str) -> np.ndarray:
        raw = text.encode().translate(_FOLD)
        found = [self._hash(p) for p in self._pieces(raw)]
        if not found:
            return np.empty(0, np.int32)
        terms = np.sort(np.concatenate(found))
        if not len(terms):
            return terms
        return terms[np.concatenate(([True], terms[1:] != terms[:-1]))]

    def _hash(self, raw: bytes) -> np.ndarray:
        b = np.frombuffer(raw, np.uint8)
        edge = np.diff((b != 32).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:len(b)], out=sums[1:])
        out = []
        for n in (0, *PREFIXES):
            s, e = starts, ends
            if n:
                longer = ends - starts > n
                s = starts[longer]
                e = s + n
            h = (sums[e] - sums[s]) * self.inverse[s] + np.uint64(n)
            h = (h ^ (h >> np.uint64(32))) * _MIX
            out.append((h ^ (h >> np.uint64(29))) * _MIX >> self.shift)
        return np.concatenate(out).astype(np.int32)


@dataclass
class Machine:
    """Fitted weights; only buckets that carry a weight are held."""

    bias: float
    ids: np.ndarray
    w: np.ndarray
    v: np.ndarray
    buckets: int = BUCKETS

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        w = np.zeros(self.buckets, np.float32)
        v = np.zeros((self.buckets, self.v.shape[1]), np.float32)
        w[self.ids], v[self.ids] = self.w, self.v
        return w, v


def evidence(rows: np.ndarray, toxic: np.ndarray, rate: float) -> np.ndarray:
    """How much terms count that are present in so many rows, so many of them toxic, where ``rate`` is
    the share of toxic rows."""
    away = np.abs(toxic - rows * rate) / np.sqrt(rows * rate * (1 - rate))
    common = np.minimum(1, rows / COMMON)
    return np.clip(np.maximum(away / EVIDENCE, common), LEAST, MOST).astype(np.float32)


def fit(rows: list[np.ndarray], labels: np.ndarray, buckets: int = BUCKETS,
        seed: int = SEED) -> Machine:
    """Fit on the rows' term lists, in the given order; the result depends on nothing else."""
    n = len(rows)
    none = np.empty(0, np.int32)
    if n == 0:
        return Machine(-30.0, none, none.astype(np.float32), np.empty((0, FACTORS), np.float32),
                       buckets)
    seen = np.bincount(np.concatenate([none, *rows]), minlength=buckets)
    ids = np.flatnonzero(seen >= MIN_ROWS).astype(np.int32)
    at = np.full(buckets, -1, np.int32)
    at[ids] = np.arange(len(ids), dtype=np.int32)
    rows = [x[x >= 0] for x in (at[r] for r in rows)]
    y = labels.astype(np.float32)
    rate = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(rate / (1 - rate)))
    x = evidence(seen[ids], np.bincount(np.concatenate([none, *[r for r, t in zip(rows, y, strict=True) if t]]),
                                        minlength=len(ids)), rate)
    rng = np.random.default_rng(seed)
    w = np.zeros(len(ids), np.float32)
    v = rng.normal(0, 0.01, (len(ids), FACTORS)).astype(np.float32)
    gw, gv, gb = np.full(len(ids), 1e-3, np.float32), np.full(v.shape, 1e-3, np.float32), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for start in range(0, n, BATCH):
            part = order[start:start + BATCH]
            lists = [rows[i] for i in part]
            sizes = np.array([len(x) for x in lists])
            idx = np.concatenate(lists)
            row = np.repeat(np.arange(len(part)), sizes)
            xi = x[idx]
            vi = v[idx] * xi[:, None]
            sums = np.stack([np.bincount(row, vi[:, f], len(part)) for f in range(FACTORS)], 1)
            squares = np.bincount(row, (vi * vi).sum(1), len(part))
            z = bias + np.bincount(row, w[idx] * xi, len(part)) + 0.5 * ((sums ** 2).sum(1) - squares)
            # Rows that are already far on the right side pull little; the mean over the batch.
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]).astype(np.float32)
            each = g[row] * xi
            used, where = np.unique(idx, return_inverse=True)
            dw = np.bincount(where, each, len(used)) + DECAY * w[used] * len(part)
            pull = each[:, None] * (sums.astype(np.float32)[row] - vi)
            # Without any term the counts are of whole numbers.
            dv = np.stack([np.bincount(where, pull[:, f], len(used)) for f in range(FACTORS)], 1).astype(float)
            dv += DECAY * v[used] * len(part)
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= 0.2 * RATE * dv / np.sqrt(gv[used])
            db = float(g.sum())
            gb += db * db
            bias -= RATE * db / gb ** 0.5
    return Machine(float(bias), ids, w * x, v * x[:, None], buckets)


def score_rows(machine: Machine, w: np.ndarray, v: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    out = np.empty(len(rows))
    for i, idx in enumerate(rows):
        vi = v[idx]
        z = machine.bias + w[idx].sum(dtype=np.float64) + 0.5 * (
            (vi.sum(0, dtype=np.float64) ** 2).sum() - (vi.astype(np.float64) ** 2).sum())
        out[i] = 1 / (1 + np.exp(-min(600.0, max(-600.0, z))))
    return out


def held_out(doc_id="doc_id", parts: int = 4, part: int = 2):
    """Whether the row's label may not be learned from: crc32 of the id's text mod ``parts``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, seed: int = SEED) -> Machine:
    """Fit a machine on at most ``max_rows`` labelled rows of ``docs`` that are not held out.

    ``labels``: ``doc_id, toxic``; a null id or label is left out, and of repeated ids the highest
    label counts. The ids are those with the smallest seeded hash, so the sample does not depend on
    the order or the partitions; rows that repeat in id and text are fitted once, and of ids with
    several texts the rows with the smallest seeded hash are taken. The terms are made in parallel; the bounded sample
    is fitted in one task and only the weights reach the driver.
    """
    known = (labels.select("doc_id", "toxic").dropna().filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_y")))
    chosen = (known.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id"))
              .orderBy("_h", "doc_id").limit(max_rows))
    # At most max_rows rows of three numbers: a proven size.
    picked = F.broadcast(materialise(chosen, "fm-sample"))
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(picked, "doc_id")
    # Copies of a row count once, added up before the shuffle; the ids bound the rows only if none
    # repeats with other texts, so the rows are bounded as well.
    sample = materialise(sample.groupBy("_h", "doc_id", "_y", F.xxhash64("text").alias("_t"))
                         .agg(F.min("text").alias("text")), "fm-texts")
    if sample.count() > max_rows:
        chosen_rows = (sample.select("doc_id", "_t").orderBy(F.xxhash64(F.lit(seed), "doc_id", "_t"), "doc_id", "_t")
                       .limit(max_rows))
        kept = F.broadcast(materialise(chosen_rows, "fm-rows"))
        sample = sample.join(kept, ["doc_id", "_t"])

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in slices(batches, 1_000, "text"):
            yield pa.RecordBatch.from_arrays(
                [b.column("_h"), b.column("doc_id"), b.column("_y"),
                 pa.array([terms(t) for t in strings(b.column("text"))], pa.list_(pa.int32()))],
                ["_h", "doc_id", "_y", "terms"])

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = []
        for b in batches:
            lists = b.column("terms")
            for h, d, y, t in zip(b.column("_h").to_pylist(), b.column("doc_id").to_pylist(),
                                  b.column("_y").to_pylist(), lists, strict=True):
                x = t.values.to_numpy() if len(t) else np.empty(0, np.int32)
                got.append((h, d, x.tobytes(), y, x.copy()))
        got.sort(key=lambda r: r[:4])
        m = fit([r[4] for r in got], np.array([r[3] for r in got]), BUCKETS, seed)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.bias]), pa.array([m.ids.tobytes()], pa.binary()),
             pa.array([m.w.tobytes()], pa.binary()), pa.array([m.v.tobytes()], pa.binary())],
            ["bias", "ids", "w", "v"])

    made = sample.select("_h", "doc_id", "_y", "text").mapInArrow(
        terms_of, "_h long, doc_id long, _y int, terms array<int>")
    fitted = (made.repartition(1)
              .mapInArrow(fit_all, "bias double, ids binary, w binary, v binary").collect())
    if not fitted:
        return fit([], np.empty(0))
    r = fitted[0]
    return Machine(r["bias"], np.frombuffer(r["ids"], np.int32), np.frombuffer(r["w"], np.float32),
                   np.frombuffer(r["v"], np.float32).reshape(-1, FACTORS))


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` up) added.

    Whole texts are scored, from the text alone. A null or empty text scores the bias. Columns of
    the same names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.ids, machine.w, machine.v, machine.buckets))
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Machine(*held.value)
        w, v = m.dense()
        terms = Terms(m.buckets)
        for column in texts:
            out = []
            for s in slices([pa.RecordBatch.from_arrays([column], ["t"])], 500, "t"):
                out.append(score_rows(m, w, v, [terms(t) for t in strings(s.column(0))]))
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    scored = F.arrow_udf(run, "double")
    out = docs.select(*kept, scored(F.col("text").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """Train on the labelled rows that are not held out, then score every row of ``docs``.

    With no usable label every score is (nearly) 0. Repeated rows and ids are scored one by one;
    an empty ``docs`` gives no rows.
    """
    return score(docs, train(docs, labels, max_rows), threshold)
