"""Approximate nearest neighbours by robust-pruned directed graphs.

Equal vectors are one node that carries its smallest ids. Nodes are dealt to shards of bounded size,
and a shard's nodes to bands of like norms. In each band a directed graph is built: nodes enter in
batches, a greedy beam search over the graph so far proposes their neighbours, and relaxed pruning
keeps a candidate only if no kept one is closer to it than ``1 / ALPHA`` of its own distance, so few
but diverse edges remain. Edges are added in both directions and pruned again where a node has too
many. The index is shuffled once; the queries stream past each shard and are searched by beams from
the entry points of its bands, the largest norms first. A band whose largest norm times the query's
cannot reach the query's ``k``-th score so far is passed over.

Within a band largest inner product becomes smallest distance by one more coordinate,
``sqrt(M^2 - |x|^2)`` with ``M`` the band's largest norm (0 for queries). Norms in a band are alike, so
this coordinate does not drown the others; vectors are scaled by ``M``, so no size overflows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, slices
from .exact_vectors import matrix, streamed_past

K = 20
QUERY_STEP = 20
#: Nodes of a shard, which bound a task's memory, and queries searched together.
SHARD_ROWS = 16_384
QUERY_BLOCK = 512
#: A band ends where a norm falls below its largest one by this factor, once it has so many nodes, or
#: by the other factor at any rate.
BAND_RATIO = 1.1
BAND_ROWS = 512
BAND_LIMIT = 4.0
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 96
ALPHA = 1.2
BATCH = 256
ENTRIES = 8
#: Unexpanded beam entries that are expanded together in one step.
WIDTH = 4


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers and squared distances of each query's beam, nearest first (-1: none).

    ``graph``: neighbours of each node, -1 where it has fewer.
    """
    nq, n = len(queries), len(x)
    norms = np.einsum("ij,ij->i", x, x)
    own = np.einsum("ij,ij->i", queries, queries)[:, None]
    ids = np.full((nq, beam), -1, np.int64)
    dist = np.full((nq, beam), np.inf, np.float32)
    todo = np.zeros((nq, beam), bool)
    seen = np.zeros((nq, n + 1), bool)  # the last column stands for "no node"
    rows = np.arange(nq)[:, None]

    def merge(found: np.ndarray, active: np.ndarray) -> None:
        """Add the nodes ``found`` (per active query, -1: none) to the beams."""
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        r = active[:, None]
        found[seen[r, found]] = -1
        seen[r, found] = True
        seen[active, n] = False
        cand = np.where(found < 0, 0, found)
        d = (own[active] + norms[cand]
             - 2 * np.einsum("ijk,ik->ij", x[cand], queries[active])).astype(np.float32)
        d[found < 0] = np.inf
        all_d = np.concatenate((dist[active], d), 1)
        all_i = np.concatenate((ids[active], found), 1)
        all_t = np.concatenate((todo[active], found >= 0), 1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(all_d, best, 1)
        ids[active] = np.take_along_axis(all_i, best, 1)
        todo[active] = np.take_along_axis(all_t, best, 1) & np.isfinite(dist[active])

    merge(np.tile(entries, (nq, 1)), np.arange(nq))
    active = np.arange(nq)
    while True:
        active = active[todo[active].any(1)]
        if not len(active):
            break
        # The first WIDTH open entries of each beam, which is sorted by distance.
        t = todo[active]
        pick = t & (np.cumsum(t, 1) <= WIDTH)
        todo[active] = t & ~pick
        slots = np.argsort(~pick, axis=1, kind="stable")[:, :WIDTH]
        nodes = np.take_along_axis(ids[active], slots, 1)
        nodes[~np.take_along_axis(pick, slots, 1)] = -1
        around = graph[np.where(nodes < 0, 0, nodes)]
        around[nodes < 0] = -1
        merge(around.reshape(len(active), -1).astype(np.int64), active)
    order = np.argsort(dist, axis=1, kind="stable")
    return ids[rows, order], dist[rows, order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int,
                 alpha: float) -> np.ndarray:
    """For each of ``nodes`` at most ``degree`` of its candidates (-1: none): always the nearest
    left, then without those that lie ``alpha`` times closer to it than to the node."""
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == nodes[:, None]] = -1
    v = x[np.where(cand < 0, 0, cand)]
    d = ((v - x[nodes][:, None, :]) ** 2).sum(2)
    d[cand < 0] = np.inf
    out = np.full((len(nodes), degree), -1, np.int32)
    r = np.arange(len(nodes))
    for k in range(degree):
        best = np.argmin(d, axis=1)
        live = np.isfinite(d[r, best])
        if not live.any():
            break
        out[live, k] = cand[r, best][live]
        away = ((v - v[r, best][:, None, :]) ** 2).sum(2)
        d[alpha * alpha * away <= d] = np.inf
        d[r, best] = np.inf
    return out


def build_graph(x: np.ndarray, seed: int, degree: int = DEGREE, beam: int = BUILD_BEAM,
                alpha: float = ALPHA, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """``(graph, entries)`` over the rows of ``x``; depends only on the rows and the seed."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n)
    middle = ((x - x.mean(0)) ** 2).sum(1)
    entries = np.unique(np.concatenate(([np.argmin(middle)], order[:ENTRIES]))).astype(np.int64)
    start = min(n, max(batch, ENTRIES))
    # The first batch is compared with itself; later ones search the graph so far.
    done = np.concatenate((entries, order[~np.isin(order, entries)][:max(0, start - len(entries))]))
    first = np.tile(done, (len(done), 1))
    graph[done] = robust_prune(x, done, first, degree, alpha)
    rest = order[~np.isin(order, done)]
    for at in range(0, len(rest), batch):
        nodes = rest[at:at + batch]
        near, _ = beam_search(x, graph, entries, x[nodes], beam)
        graph[nodes] = robust_prune(x, nodes, near, degree, alpha)
        # Reverse edges, grouped by the node they lead to.
        to = graph[nodes]
        src = np.repeat(nodes, degree)[to.ravel() >= 0]
        dst = to.ravel()[to.ravel() >= 0].astype(np.int64)
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, counts = np.unique(dst, return_counts=True)
        within = np.arange(len(dst)) - np.repeat(np.cumsum(counts) - counts, counts)
        if not len(targets):
            continue
        added = np.full((len(targets), counts.max()), -1, np.int64)
        added[np.repeat(np.arange(len(targets)), counts), within] = src
        old = graph[targets].astype(np.int64)
        room = (old >= 0).sum(1) + counts <= degree
        for full in (False, True):
            pick = np.flatnonzero(room != full)
            if not len(pick):
                continue
            both = np.concatenate((old[pick], added[pick]), 1)
            if full:
                graph[targets[pick]] = robust_prune(x, targets[pick], both, degree, alpha)
            else:
                keep = np.argsort(both < 0, axis=1, kind="stable")[:, :degree]
                graph[targets[pick]] = np.take_along_axis(both, keep, 1)
    return graph, entries


def _usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows with an id and a vector that is neither null nor zero nor holds a null, infinite or
    NaN component; the vector as doubles (-0 as 0)."""
    v = F.transform(F.col(vector), lambda c: c.cast("double") + F.lit(0.0))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec"))
    good = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c) != F.lit(float("inf"))))
    some = F.exists("vec", lambda c: c != F.lit(0.0))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(good & some)


def bands(norms: np.ndarray) -> np.ndarray:
    """Number of each row's band, from 0 for the largest norms."""
    order = np.argsort(-norms, kind="stable")
    out = np.empty(len(norms), np.int32)
    band, top, size = -1, 0.0, 0
    for row in order.tolist():
        norm = norms[row]
        if band < 0 or norm * BAND_LIMIT < top or (size >= BAND_ROWS and norm * BAND_RATIO < top):
            band, top, size = band + 1, norm, 0
        out[row] = band
        size += 1
    return out


def lengths(v: np.ndarray) -> np.ndarray:
    """Norms of the rows; no square overflows or vanishes."""
    most = np.abs(v).max(1)
    with np.errstate(over="ignore"):
        return np.minimum(most * np.sqrt(((v / most[:, None]) ** 2).sum(1)), np.finfo(np.float64).max)


def lifted(v: np.ndarray, top: float) -> np.ndarray:
    """Rows of a band scaled by its largest norm ``top``, with the coordinate that makes all of them
    equally long."""
    x = v / top
    return np.concatenate((x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))[:, None]), 1).astype(np.float32)


def build_shard(table: pa.Table) -> pa.Table:
    """The graphs of one shard's bands; a node's edges and number count within its band."""
    v = matrix(table.column("vec"))
    order = np.lexsort(v.T[::-1])  # not the order in which rows happened to come
    v, table = v[order], table.take(pa.array(order))
    norms = lengths(v)
    band = bands(norms)
    node, entry, edges = np.empty(len(v), np.int32), np.zeros(len(v), bool), [None] * len(v)
    for b in range(int(band.max()) + 1):
        rows = np.flatnonzero(band == b)
        graph, entries = build_graph(lifted(v[rows], norms[rows].max()), seed=len(rows))
        node[rows] = np.arange(len(rows))
        entry[rows[entries]] = True
        for r, g in zip(rows.tolist(), graph, strict=True):
            edges[r] = g
    return pa.table({"shard": table.column("shard"), "vec": table.column("vec"), "ids": table.column("ids"),
                     "band": pa.array(band), "node": pa.array(node), "entry": pa.array(entry),
                     "edges": pa.array(edges, pa.list_(pa.int32()))})


class Shard:
    """The held graphs of a shard, and the search."""

    def __init__(self, rows: pa.Table, k: int, beam: int, block: int) -> None:
        self.k, self.beam, self.block, self.bands = k, max(beam, k + 1), block, []
        band = rows.column("band").to_numpy()
        for b in range(int(band.max()) + 1):
            part = rows.filter(pa.array(band == b)).sort_by("node")
            v = matrix(part.column("vec"))
            top = float(lengths(v).max())
            entries = np.flatnonzero(part.column("entry").to_numpy(zero_copy_only=False))
            self.bands.append((v, lifted(v, top), top, matrix(part.column("edges")).astype(np.int32), entries,
                               part.column("ids").to_pylist()))

    def search(self, own: list[int], q: np.ndarray) -> list[list[tuple[float, int]]]:
        """The best ``(-score, id)`` of each query, nearest first, at most ``k``."""
        norms = lengths(q)
        probe = np.concatenate((q / norms[:, None], np.zeros((len(q), 1))), 1).astype(np.float32)
        best: list[list[tuple[float, int]]] = [[] for _ in own]
        for v, x, top, graph, entries, ids in self.bands:
            with np.errstate(over="ignore"):
                reach = (norms * top * (1 + 1e-9)).tolist()
            todo = np.array([i for i, b in enumerate(best) if len(b) < self.k or -b[-1][0] <= reach[i]], np.int64)
            if not len(todo):
                break  # later bands reach less
            if len(v) <= 2 * self.beam:
                found = np.tile(np.arange(len(v)), (len(todo), 1))
            else:
                found, _ = beam_search(x, graph, entries, probe[todo], self.beam)
            for i, hits in zip(todo.tolist(), found, strict=True):
                hits = hits[hits >= 0]
                with np.errstate(over="ignore", invalid="ignore"):
                    scores = (v[hits] * q[i]).sum(1)
                named = [(-s, n) for s, h in zip(scores.tolist(), hits.tolist(), strict=True) for n in ids[h]
                         if n != own[i]]
                best[i] = sorted(best[i] + named)[:self.k]
        return best

    def __call__(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices([asked], self.block):
            own = batch.column("vec_id").to_pylist()
            found = self.search(own, matrix(batch.column("vec")))
            out = [(o, n, -s) for o, b in zip(own, found, strict=True) for s, n in b]
            if out:
                cols = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, vector: str = "embedding", k: int = K, query_step: int = QUERY_STEP,
            shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose ``vec_id`` is divisible by
    ``query_step`` the ``k`` rows found with the largest inner product, in double precision on the
    vectors as given, nearest first, ties to the smaller id; all other rows if they are fewer.

    Unusable vectors (null, zero, with a null or non-finite component) and rows with a null id
    take no part; vectors of different lengths are compared only with their like. Rows that repeat
    an id with the same vector count once; with different vectors each counts, is answered by its
    best score as a candidate, and as a query shares one ranking with the others of its id. A query
    never finds a row of its own id. Components may be of any finite size; a score beyond a double is
    infinite. Other columns are left out. An empty table gives no rows.
    """
    rows = _usable(vectors, vector).distinct()
    # Of equal vectors the k + 1 smallest ids can be among a query's k nearest, so each node
    # carries these; Spark cuts the groups before the shuffle.
    smallest = Window.partitionBy("vec").orderBy("vec_id")
    ranked = rows.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
    nodes = materialise(ranked.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "ann-nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int")
    dealt = nodes.withColumn("shard", shard).groupBy("shard", F.size("vec").alias("dim"))
    index = materialise(dealt.applyInArrow(
        build_shard, "shard int, vec array<double>, ids array<long>, band int, node int, entry boolean, "
                     "edges array<int>"), "ann-index")
    asked = materialise(rows.filter(F.col("vec_id") % query_step == 0), "ann-queries")
    found = streamed_past(index.withColumn("vec_id", F.col("node").cast("long")), asked, shards,
                          lambda held: Shard(held, k, beam, query_block), "query_id long, vec_id long, score double", "shard")
    # An id that repeats with different vectors answers once, with its best score.
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
