"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint (majority of the XXH64 bits of 4-word shingles) is cut into three segments of
22, 21 and 21 bits, each zero-padded to a 23-bit word. The perfect binary Golay code (23, 12, 7)
maps every word to one codeword within distance 3; decoding a segment and all its one-bit
neighbours gives the segment's few codeword indices, and two segments that differ in at most two
bits always share one of them (the word halfway lies in both neighbourhoods).

Pigeonhole over at most four differing bits in three segments:

* some segment is equal: of the two others one differs in at most 2 bits. Key: the equal segment
  with a codeword index of another (6 combinations);
* no segment is equal: the differences are (1,1,1) or (1,1,2) in some order, all at most 2.
  Key: a codeword index of each segment.

Keys hold 33 and 36 bits, so buckets stay near-empty for unrelated texts. Bucket members are
verified by their true bit distance and emit a spanning set of links, never all pairs; a bucket
too large for one task is compared block against block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions, slices
from .components import components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
#: Fixed values of the perfect binary Golay code: word length, check bits, generator polynomial.
WORD_BITS, CHECK_BITS, GENERATOR = 23, 11, 0xC75
#: (first bit, bits) of the segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Distinct fingerprints of one bucket that a task holds; larger buckets go block against block.
BUCKET_ROWS = 20_000
_CHUNK = 1 << 16


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text`` with A-Z lower-cased (UTF-8 bytes)."""
    return text.encode().lower().split()


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit ``b`` is set if it is set in more than half of the shingles' XXH64 (seed 42)."""
    w = words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    ends = starts + lengths
    n = len(w) - shingle + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        m = min(_CHUNK, n - at)
        firsts = starts[at:at + m].tolist()
        lasts = ends[at + shingle - 1:at + shingle - 1 + m].tolist()
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(firsts, lasts, strict=True)),
                        np.uint64, m)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(m, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, _text)`` of each row: the 64-bit fingerprint as a signed long and a hash of the
    text, which tells apart rows that share an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2_000, "text"):
            fps = [_signed(fingerprint(t, shingle)) for t in b.column("text").fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fps, pa.int64()), b.column("_text")],
                ["doc_id", "fp", "_text"])
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"), _text_hash().alias("_text"))
    return source.mapInArrow(run, "doc_id long, fp long, _text long")


def _text_hash():
    return F.xxhash64(F.col("text").cast("string"))


class Golay:
    """Codeword indices of 23-bit words, by syndrome tables computed from the generator."""

    def __init__(self) -> None:
        residue = []
        for i in range(WORD_BITS):
            r = 1 << i
            for b in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
                if r >> b & 1:
                    r ^= GENERATOR << (b - CHECK_BITS)
            residue.append(r)
        low = np.zeros(1 << 12, np.uint32)
        high = np.zeros(1 << 11, np.uint32)
        for table, first, bits in ((low, 0, 12), (high, 12, 11)):
            index = np.arange(1 << bits)
            for i in range(bits):
                table[(index >> i & 1) == 1] ^= np.uint32(residue[first + i])
        self.low, self.high = low, high
        error = np.zeros(1 << CHECK_BITS, np.uint32)  # each pattern of weight <= 3, by syndrome
        ones = [1 << i for i in range(WORD_BITS)]
        for i in range(WORD_BITS):
            error[residue[i]] = ones[i]
            for j in range(i):
                error[residue[i] ^ residue[j]] = ones[i] | ones[j]
                for k in range(j):
                    error[residue[i] ^ residue[j] ^ residue[k]] = ones[i] | ones[j] | ones[k]
        self.error = error

    def index(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> CHECK_BITS

    def keys(self, segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of each word and its one-bit neighbours, sorted along axis 1, and a mask of the
        first of each distinct value."""
        flips = np.array([0, *[1 << i for i in range(bits)]], np.uint32)
        found = np.sort(self.index(segment[:, None] ^ flips[None, :]), axis=1)
        first = np.ones(found.shape, bool)
        first[:, 1:] = found[:, 1:] != found[:, :-1]
        return found.astype(np.uint64), first


_GOLAY: Golay | None = None


def _golay() -> Golay:
    global _GOLAY
    if _GOLAY is None:
        _GOLAY = Golay()
    return _GOLAY


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of every bucket key of the fingerprints (uint64)."""
    golay = _golay()
    segs = [((fps >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.uint32) for a, n in SEGMENTS]
    kept = [golay.keys(s, n) for s, (_, n) in zip(segs, SEGMENTS, strict=True)]
    # Ragged lists of distinct indices, as (row, index) sorted by row.
    ragged = []
    for found, first in kept:
        rows, cols = np.nonzero(first)
        ragged.append((rows, found[rows, cols]))
    out_rows, out_keys = [], []
    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                rows, idx = ragged[j]
                exact = segs[i][rows].astype(np.uint64)
                out_rows.append(rows)
                out_keys.append(np.uint64(tag << 40) | exact << np.uint64(12) | idx)
                tag += 1
    rows, code = ragged[0][0], ragged[0][1]
    for r2, k2 in ragged[1:]:
        counts = np.bincount(r2, minlength=len(fps))
        first_at = np.concatenate(([0], np.cumsum(counts)))[:-1]
        times = counts[rows]
        base = np.repeat(np.arange(len(rows)), times)
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        code = code[base] << np.uint64(12) | k2[first_at[rows[base]] + within]
        rows = rows[base]
    out_rows.append(rows)
    out_keys.append(np.uint64(tag << 40) | code)
    return np.concatenate(out_rows), np.concatenate(out_keys)


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join exactly the fingerprints reachable from one another by steps of at most
    ``max_bits`` bits, at most one link per fingerprint. ``fps``: distinct uint64."""
    links = []
    left = np.sort(fps)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            pivot = queue.pop()
            near = np.bitwise_count(left ^ pivot) <= max_bits
            if near.any():
                hit = left[near]
                links.append((np.full(len(hit), pivot), hit))
                queue.extend(hit)
                left = left[~near]
    return links


def _bucket_links(rows: Iterator[pa.RecordBatch], max_bits: int, limit: int):
    """Sorted ``(key, fp)`` rows to links; a bucket of over ``limit`` rows is passed on whole as
    ``(key, fp)`` rows of kind 1 for the block stage."""
    def table(kind, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)),
             pa.array(b.view(np.int64))], ["kind", "u", "v"])

    held_a: list[np.ndarray] = []
    held_b: list[np.ndarray] = []

    def flush():
        if held_a:
            pairs = np.unique(np.stack([np.concatenate(held_a), np.concatenate(held_b)], 1), axis=0)
            held_a.clear()
            held_b.clear()
            return [table(0, np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))]
        return []

    def links_of(keys, fps):
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        two = starts[sizes == 2]
        if len(two):
            a, b = fps[two], fps[two + 1]
            ok = np.bitwise_count(a ^ b) <= max_bits
            held_a.append(np.minimum(a, b)[ok])
            held_b.append(np.maximum(a, b)[ok])
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            for a, b in spanning_links(fps[at:at + n], max_bits):
                held_a.append(np.minimum(a, b))
                held_b.append(np.maximum(a, b))

    keys = np.empty(0, np.uint64)
    fps = np.empty(0, np.uint64)
    over = None  # key of a bucket that is being passed on
    for batch in rows:
        k = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if over is not None:
            same = int(np.searchsorted(k != over, True)) if len(k) else 0
            if same:
                yield table(1, k[:same], f[:same])
                k, f = k[same:], f[same:]
            if not len(k):
                continue
            over = None
        keys, fps = np.concatenate((keys, k)), np.concatenate((fps, f))
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on in the next batch
        if last:
            links_of(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
        if len(keys) > limit:
            over = keys[0]
            yield table(1, keys, fps)
            keys, fps = keys[:0], fps[:0]
        if sum(map(len, held_a)) > 200_000:
            yield from flush()
    if len(keys):
        links_of(keys, fps)
    yield from flush()


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints (column ``fp``) whose components are those
    of all pairs within ``max_bits`` bits (at most 4, the bound of the segment keys)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be between 0 and {MAX_BITS}")
    spark = fps.sparkSession
    n = shuffle_partitions(spark)

    def emit(batches):
        for b in slices(batches, 4_000):
            f = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, keys = bucket_keys(f)
            for at in range(0, len(keys), 200_000):
                part = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part].view(np.int64)), pa.array(f[rows[part]].view(np.int64))],
                    ["key", "fp"])

    def meet(batches):
        return _bucket_links(batches, max_bits, bucket_rows)

    # Spread the few bytes of the fingerprints first: each makes some 180 keys.
    keyed = fps.select("fp").repartition(n, F.xxhash64("fp")).mapInArrow(emit, "key long, fp long")
    found = materialise(keyed.repartition(n, "key").sortWithinPartitions("key")
                        .mapInArrow(meet, "kind int, u long, v long"), "golay-links")
    direct = found.filter("kind = 0").select("u", "v")
    large = found.filter("kind = 1").select(F.col("u").alias("key"), F.col("v").alias("fp"))
    return direct.unionByName(_block_links(large, max_bits, bucket_rows)).distinct()


def _block_links(large: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """Buckets too large for one task: their rows are dealt to blocks by hash, and every pair of
    blocks is one task's group. Each group holds about ``bucket_rows`` rows."""
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    blocks = sizes.select("key", F.ceil(F.col("_n") * 2 / F.lit(bucket_rows)).cast("int").alias("_k"))
    own = (large.join(blocks, "key")
           .withColumn("_b", F.pmod(F.xxhash64("fp"), F.col("_k")).cast("int"))
           .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))))
    paired = own.select("key", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"),
                        "fp")

    def meet(table: pa.Table) -> pa.Table:
        f = np.unique(table.column("fp").to_numpy().view(np.uint64))
        found = spanning_links(f, max_bits)
        a = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.uint64)
        b = np.concatenate([y for _, y in found]) if found else np.empty(0, np.uint64)
        return pa.table({"u": np.minimum(a, b).view(np.int64), "v": np.maximum(a, b).view(np.int64)})

    return paired.groupBy("key", "_i", "_j").applyInArrow(meet, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` of the rows reachable over links of at most
    ``max_bits`` differing fingerprint bits, the row itself included. Equal texts share their
    fingerprint and so a component; a text without words (null, empty, white space) has
    fingerprint 0 and is linked like any other; a row with a null ``doc_id`` takes part in the
    linking but never names a component that holds another id (null if it holds none). Repeated
    rows stay repeated. An empty table gives no rows. Other columns are left out.
    """
    prints = materialise(with_fingerprint(docs, shingle), "golay-fp")
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    roots = components(links(lowest.select("fp"), max_bits, bucket_rows))
    rooted = (lowest.join(roots, lowest["fp"] == roots["node"], "left")
              .select("fp", "_least", F.coalesce("root", "fp").alias("root")))
    names = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(names, "root").select(F.col("fp").alias("_fp"), "component_id")
    return (prints.join(named, prints["fp"] == named["_fp"], "left")
            .select("doc_id", "fp", "component_id"))


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one row left of each component: the one with the smallest ``doc_id`` (null last;
    of rows that repeat the id in one component the one with the smallest hash of its text).

    Rows that share an id but not a component each stay. Of rows equal in id and text one stays, with
    all its columns as they are (the one with the smallest hash of its columns).
    """
    prints = materialise(with_fingerprint(docs, shingle), "golay-fp")
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")
    first = materialise(prints.groupBy("fp").agg(F.min(name).alias("name")), "golay-first")
    roots = components(links(first.select("fp"), max_bits, bucket_rows))
    keep = (first.join(roots, first["fp"] == roots["node"], "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("name").alias("name"))
            .select(F.coalesce("name.doc_id", F.lit(0)).alias("_keep_id"), F.col("name._text").alias("_keep_text"),
                    F.col("name.none").alias("_keep_none")))
    own = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(own, F.lit(0)).alias("_id"), _text_hash().alias("_text"),
                       own.isNull().alias("_none"), F.struct(*docs.columns).alias("_row"))
    same = ((F.col("_id") == F.col("_keep_id")) & (F.col("_text") == F.col("_keep_text"))
            & (F.col("_none") == F.col("_keep_none")))
    # Equal rows are reduced in the map tasks before they meet.
    kept = rows.join(keep, same, "left_semi").groupBy("_id", "_text", "_none").agg(
        F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return kept.select("_row.*")


def fingerprint_hex(column="fp"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")
