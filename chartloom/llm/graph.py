"""Nearest neighbours by largest inner product on robust-pruned directed graphs.

Vectors are dealt to shards of bounded size. A shard lifts its vectors to one more dimension so that the largest inner
product is the least distance, and builds a graph: each vector's neighbours are found by greedy beam search, and an edge
stays only if no kept neighbour is closer to its end by the factor ALPHA. Queries search every shard with a wide beam;
what they find is scored on the original vectors in double precision and merged.

Equal vectors are one node of the graph, all their ids are found with it, ties go to the smaller id. Vectors that are
null, zero or not finite throughout take no part. Every length has graphs of its own, and a query searches all vectors
of its length. Rows with equal ids are candidates of their own. Empty tables give no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import cut

SHARD, QUERIES = 5000, 2048
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 120, 1.2
BATCH, HOPS = 256, 4


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `width` nearest nodes that a greedy walk over `edges` meets, and their squared distances.

    A step opens the HOPS nearest nodes not opened yet. `edges` has one row more than `points`, which is empty.
    """
    count, n = len(queries), len(points)
    width = min(width, n)
    norms, own = (points**2).sum(1), (queries**2).sum(1)
    nodes = np.full((count, width), n)
    far = np.full((count, width), np.inf, points.dtype)
    nodes[:, 0], far[:, 0] = start, ((queries - points[start]) ** 2).sum(1)
    open_ = np.zeros((count, width), bool)
    open_[:, 0] = True
    seen = np.zeros((count, n + 1), bool)
    seen[:, [start, n]] = True
    while len(active := np.flatnonzero(open_.any(1))):
        line = np.arange(len(active))[:, None]
        pick = np.argsort(~open_[active], 1, kind="stable")[:, :HOPS]
        at = np.where(open_[active[:, None], pick], nodes[active[:, None], pick], n)
        open_[active[:, None], pick] = False
        near = np.sort(edges[at].reshape(len(active), -1), 1)
        new = ~seen[active[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        row, column = np.nonzero(new)
        met = near[row, column]
        seen[active[row], met] = True
        distance = np.full(near.shape, np.inf, points.dtype)
        inner = np.einsum("ij,ij->i", points[met], queries[active[row]])
        distance[row, column] = norms[met] + own[active[row]] - 2 * inner
        every = np.concatenate((far[active], distance), 1)
        best = np.argsort(every, 1, kind="stable")[:, :width]
        far[active] = every[line, best]
        nodes[active] = np.concatenate((nodes[active], near), 1)[line, best]
        open_[active] = np.concatenate((open_[active], new), 1)[line, best]
    return nodes, far


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node at most `degree` of its candidates: nearest first, dropping those a kept one is closer to by `alpha`.

    Rows of candidates and of the result are padded with len(points).
    """
    n, line = len(points), np.arange(len(nodes))
    candidates = np.sort(candidates, 1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
    candidates[candidates == nodes[:, None]] = n
    some = points[np.minimum(candidates, n - 1)]
    distance = ((some - points[nodes][:, None]) ** 2).sum(2)
    distance[candidates == n] = np.inf
    order = np.argsort(distance, 1, kind="stable")
    candidates, distance, some = candidates[line[:, None], order], distance[line[:, None], order], some[line[:, None], order]
    norms = (some**2).sum(2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(some, some.transpose(0, 2, 1))
    open_, kept = np.isfinite(distance), np.full((len(nodes), degree), n)
    for j in range(degree):
        left = np.flatnonzero(open_.any(1))
        if not len(left):
            break
        first = open_[left].argmax(1)
        kept[left, j] = candidates[left, first]
        open_[left] &= alpha * alpha * between[left, first] > distance[left]
        open_[left, first] = False
    return kept


def _link_back(points: np.ndarray, edges: np.ndarray, batch: np.ndarray, own: np.ndarray, alpha: float) -> None:
    """Edges from the new neighbours back to the nodes of `batch`; a node with too many is pruned anew."""
    n, degree = len(points), edges.shape[1]
    row, column = np.nonzero(own < n)
    ends, sources = own[row, column], batch[row]
    order = np.argsort(ends, kind="stable")
    ends, sources = ends[order], sources[order]
    others, first, counts = np.unique(ends, return_index=True, return_counts=True)
    by_count = np.argsort(counts, kind="stable")
    for at in range(0, len(by_count), BATCH):
        some = by_count[at : at + BATCH]
        place = first[some][:, None] + np.arange(counts[some].max())
        fresh = np.where(place < (first + counts)[some][:, None], sources[np.minimum(place, len(sources) - 1)], n)
        node, every = others[some], np.sort(np.concatenate((edges[others[some]], fresh), 1), 1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = n
        every.sort(1)
        full = every[:, degree] < n
        edges[node[~full]] = every[~full, :degree]
        if full.any():
            edges[node[full]] = robust_prune(points, node[full], every[full], degree, alpha)


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges of every node, padded with len(points), one empty row more, and the node to start from."""
    n, random = len(points), np.random.default_rng(11)
    start = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n + 1, degree), n)
    if n > 1:
        some = random.integers(0, n, (n, min(degree // 2, n - 1)))
        edges[:n, : some.shape[1]] = np.where(some == np.arange(n)[:, None], (some + 1) % n, some)
    for slack in (1.0, alpha):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            batch = order[at : at + BATCH]
            found, _ = beam_search(points, edges, start, points[batch], beam)
            edges[batch] = robust_prune(points, batch, np.concatenate((found, edges[batch]), 1), degree, slack)
            _link_back(points, edges, batch, edges[batch], slack)
    return edges, start


def _index(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    vectors = np.array(table.column("embedding").to_pylist(), np.float64)
    points, group = np.unique(vectors, axis=0, return_inverse=True)
    scaled = points / np.abs(points).max()
    norms = (scaled**2).sum(1)
    lifted = np.concatenate((scaled, np.sqrt(norms.max() - norms)[:, None]), 1) / np.sqrt(norms.max())
    lifted = lifted.astype(np.float32)
    edges, start = build_graph(lifted)
    data = io.BytesIO()
    np.savez(data, points=points, lifted=lifted, edges=edges, start=start, ids=ids, group=group.ravel())
    key = [table.column(c).slice(0, 1) for c in ("shard", "size")]
    return pa.table([*key, pa.array([data.getvalue()], pa.binary())], names=["shard", "size", "graph"])


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            shard = np.load(io.BytesIO(left.column("graph")[0].as_py()))
            points, lifted, edges, group, ids = (shard[c] for c in ("points", "lifted", "edges", "group", "ids"))
            names = right.column("query_id").to_pylist()
            asked = right.column("vector").to_pylist()
            order = np.lexsort((ids, group))
            first = np.searchsorted(group[order], np.arange(len(points) + 1))
            for at in range(0, len(asked), 256):
                some = range(at, min(at + 256, len(asked)))
                queries = np.array([asked[i] for i in some], np.float64)
                asking = queries / np.abs(queries).max(1, keepdims=True)
                asking = np.pad(asking / np.linalg.norm(asking, axis=1, keepdims=True), ((0, 0), (0, 1))).astype(np.float32)
                found, far = beam_search(lifted, edges, int(shard["start"]), asking, max(SEARCH_BEAM, 2 * k))
                for i, query, near, gap in zip(some, queries, found, far, strict=True):
                    near = near[np.isfinite(gap)]
                    scores = np.array([float(np.dot(points[p], query)) for p in near])
                    best = np.lexsort((ids[order[first[near]]], -scores))[: k + 1]
                    for node, score in zip(near[best], scores[best], strict=True):
                        members = [m for m in ids[order[first[node] : first[node + 1]]][: k + 1].tolist() if m != names[i]]
                        out += [(names[i], m, float(score)) for m in members]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The `k` nearest of `vectors` (`vec_id`, `embedding`) to each of `queries`: query_id, rank, vec_id, score."""
    value = F.transform(F.col("embedding"), lambda x: x.cast("double"))

    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("embedding"))
        finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
        return rows.withColumn("size", F.size("embedding"))

    kept = clean(vectors)
    shards = max(1, -(-kept.count() // SHARD))
    asked = clean(queries).dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // QUERIES))
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    graphs = cut(dealt.groupBy("shard", "size").applyInArrow(_index, "shard long, size int, graph binary"))
    left = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.select(
        F.col("vec_id").alias("query_id"),
        F.col("embedding").alias("vector"),
        "size",
        F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(blocks)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
    )
    found = left.groupBy("shard", "size", "part").cogroup(right.groupBy("shard", "size", "part"))
    found = found.applyInArrow(_search(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
