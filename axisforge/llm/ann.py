"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axisforge.llm.common import discard, table, without, written

#: Centroids for each half, so CENTROIDS**2 cells.
CENTROIDS = 128
#: The codebooks are fitted on this many vectors at most; every vector is indexed.
FIT = 20_000
#: Cells are traversed until they hold as large a share of the vectors as gives RECALL among the fitted vectors, for TRIED of them as queries.
RECALL, TRIED = 0.93, 256
#: Cells hold LEAST vectors at least.
LEAST = 1000
#: Entries and queries that meet in one task.
BLOCK = 8192


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * rows @ centroids.T, axis=1)


def fit_codebook(rows: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """k-means centroids; fewer than k if there are fewer distinct rows."""
    distinct = np.unique(rows, axis=0)
    k = min(k, len(distinct))
    centroids = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(rows, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        n = np.bincount(own, minlength=k)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells (i * len(second) + j) by rising first[i] + second[j], through a heap, until they hold `enough` entries.

    The pair after (i, j) in the order of either half enters the heap once its neighbour has left it.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    fa, fb, na, nb = first[a].tolist(), second[b].tolist(), len(a), len(b)
    a, b = a.tolist(), b.tolist()
    heap, cells, held, reached = [(fa[0] + fb[0], 0, 0)], [], 0, [0] * na
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        if n := int(sizes[a[i], b[j]]):
            held += n
            cells.append(a[i] * nb + b[j])
        if i + 1 < na and reached[i + 1] == j:
            heapq.heappush(heap, (fa[i + 1] + fb[j], i + 1, j))
        if j + 1 < nb and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (fa[i] + fb[j + 1], i, j + 1))
    return cells


def enough_for_recall(x: np.ndarray, books, codes, k: int) -> float:
    """The share of the vectors that traversals have to reach for the k nearest of a query to be among them with the chance RECALL.

    Measured on the vectors x themselves, TRIED of them as queries. Of more vectors the nearest
    are nearer, and so reached sooner.
    """
    half = books[0].shape[1]
    ranks = []
    for q in np.linspace(0, len(x) - 1, min(TRIED, len(x))).astype(np.int64):
        near = x @ x[q]
        near[q] = -np.inf
        top_ = np.argpartition(near, max(0, len(x) - 1 - k))[-min(k, len(x) - 1) :]
        reach = (books[0] @ x[q, :half])[codes[0]] + (books[1] @ x[q, half:])[codes[1]]
        ranks.append(len(x) - np.searchsorted(np.sort(reach), reach[top_], side="left"))
    return float(np.quantile(np.concatenate(ranks), RECALL)) / len(x)


def pack_cells(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """cell -> (first block, blocks): cells in order fill blocks of BLOCK entries; a larger cell has blocks of its own."""
    out, block, room = {}, -1, 0
    for cell, n in sorted(sizes.items()):
        if n > BLOCK:
            parts = -(-n // BLOCK)
            out[cell] = (block + 1, parts)
            block, room = block + parts, 0
        else:
            if n > room:
                block, room = block + 1, BLOCK
            out[cell] = (block, 1)
            room -= n
    return out


def top(query_id: int, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the rows with finite scores; ties to smaller ids. Products are summed anew, alike for equal rows."""
    at = np.flatnonzero((scores > -np.inf) & (ids != query_id))
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least - 1e-9 * max(1.0, abs(least))]
    exact = (vectors[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order], exact[order]


def valid_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, n): the vectors that take part, as doubles, and their lengths."""
    v = F.col("v")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.where(v.isNotNull() & F.col("vec_id").isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0))
    return rows.withColumn("n", F.size(v))


def inverted_multi_index(vectors: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows found nearest to each row whose id is divisible by `every`.

    Nearness is the inner product in double precision. Each half of a vector has a codebook;
    a cell is a pair of centroids. For a query, cells are traversed by the summed products
    of the halves with their centroids (negated, as a distance), the best pair first, until
    they hold the share of the entries that RECALL takes, and LEAST at least; all of their
    entries are reranked by exact products. Ties go to the smaller vec_id; a query with fewer
    candidates gets them all.

    Entries lie in blocks of whole cells, and a cell of many entries (equal vectors, say) is
    cut into several blocks, so that no task holds more than BLOCK entries and BLOCK queries.
    Queries crowd by their best cells, and a block goes only to the crowds that look into it.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows
    without an id take no part. Products are only between vectors of one length: each length
    has an index of its own. A row that shares the query's id counts as the query; rows that
    share an id but not a vector are all candidates, and the query is the least of their
    vectors. Empty tables give empty results; further columns are ignored.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = valid_vectors(without(vectors), vec_id, vector)
    lengths = rows.groupBy("n").count().orderBy("n").collect()  # a row for each length of a vector
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    found = [_search(rows.where(F.col("n") == dim).drop("n"), dim, total, k, every) for dim, total in lengths]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    if len(found) > 1:  # rows that share an id may have vectors of several lengths: the query is the shortest
        first = Window.partitionBy("query_id")
        out = out.withColumn("_af_least", F.min("n").over(first)).where("n = _af_least")
    return out.select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, dim: int, total: int, k: int, every: int) -> DataFrame:
    """(query_id, rank, vec_id, score, n) among the `total` rows (vec_id, v), all of length dim."""
    one_in = -(-total // FIT)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(one_in)) == 0).orderBy("vec_id").limit(FIT).select("v").toPandas()
    if not len(sample):
        sample = rows.orderBy("vec_id").limit(FIT).select("v").toPandas()
    fit = np.array(sample["v"].tolist(), dtype=np.float64)
    half = max(1, dim // 2)
    books = fit_codebook(fit[:, :half], CENTROIDS), fit_codebook(fit[:, half:], CENTROIDS) if dim > 1 else np.zeros((1, 0))
    na, nb = len(books[0]), len(books[1])

    def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _nearest(x[:, :half], books[0]), _nearest(x[:, half:], books[1]) if dim > 1 else np.zeros(len(x), dtype=np.int64)

    share = enough_for_recall(fit, books, codes(fit), k)

    def assign(batches):
        for b in batches:
            x = np.array(b["v"].tolist(), dtype=np.float64).reshape(len(b), -1)
            first, second = codes(x)
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": [r.tobytes() for r in x], "cell": (first * nb + second).astype(np.int32)})

    index = written(rows.mapInPandas(assign, "vec_id bigint, v binary, cell int"), "ann-index")
    counts = {r[0]: r[1] for r in index.groupBy("cell").count().collect()}  # a row for each cell: CENTROIDS**2 at most
    sizes = np.zeros((na, nb), dtype=np.int64)
    for c, n in counts.items():
        sizes[divmod(c, nb)] = n
    place = pack_cells(counts)
    enough = max(math.ceil(share * total), LEAST, k + 1)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    crowds = max(1, -(-queries.count() // BLOCK))

    def route(batches):
        for b in batches:
            out = []
            for q, v in zip(b["vec_id"], b["v"], strict=True):
                x = np.array(v, dtype=np.float64)
                raw = x.tobytes()
                cells = traverse(-(books[0] @ x[:half]), -(books[1] @ x[half:]), sizes, enough)
                # Queries with one best cell look into much the same cells; a cell of very many is spread by the hash below.
                crowd = place[cells[0]][0] * crowds // blocks
                by: dict[int, list[int]] = {}
                for c in cells:
                    first, n = place[c]
                    for block in range(first, first + n):
                        by.setdefault(block, []).append(c)
                out += [(block, crowd, q, raw, np.array(own, dtype=np.int32).tobytes()) for block, own in by.items()]
            yield pd.DataFrame(out, columns=["block", "crowd", "query_id", "q", "cells"])

    blocks = max(f + n for f, n in place.values())
    probes = queries.repartition(max(1, min(crowds * 8, 64 * crowds))).mapInPandas(route, "block int, crowd int, query_id bigint, q binary, cells binary")
    probes = written(probes, "ann-probes")
    # A crowd of more than BLOCK queries is cut.
    sizes_ = probes.select("crowd", "query_id").distinct().groupBy("crowd").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts"))
    probes = probes.join(F.broadcast(sizes_), "crowd").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    wanted = probes.select("block", "crowd", "part").distinct().groupBy("block").agg(F.collect_list(F.struct("crowd", "part")).alias("to"))

    def block_of(batches):
        for b in batches:
            spot = [place[c] for c in b["cell"]]
            yield b.assign(block=np.array([f + (i % n) for (f, n), i in zip(spot, b["vec_id"], strict=True)], dtype=np.int32))

    entries = index.mapInPandas(block_of, "vec_id bigint, v binary, cell int, block int")
    entries = entries.join(wanted, "block").select("vec_id", "v", "cell", "block", F.explode("to").alias("to")).select("vec_id", "v", "cell", "block", "to.crowd", "to.part")

    def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids = left["vec_id"].to_numpy()
            x = np.frombuffer(b"".join(left["v"])).reshape(len(ids), -1)
            cells = left["cell"].to_numpy()
            seen = np.zeros(na * nb, dtype=bool)
            for lo in range(0, len(right), 128):
                part = right.iloc[lo : lo + 128]
                q = np.frombuffer(b"".join(part["q"])).reshape(len(part), -1)
                scores = q @ x.T
                for i, (query, own) in enumerate(zip(part["query_id"], part["cells"], strict=True)):
                    seen[:] = False
                    seen[np.frombuffer(own, dtype=np.int32)] = True
                    best, s = top(query, q[i], ids, x, np.where(seen[cells], scores[i], -np.inf), k)
                    found.append(pd.DataFrame({"query_id": query, "vec_id": best, "score": s}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    by = ["block", "crowd", "part"]
    near = written(entries.groupBy(*by).cogroup(probes.groupBy(*by)).applyInPandas(rerank, "query_id bigint, vec_id bigint, score double"), "ann-near")
    discard(index)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).withColumn("n", F.lit(dim))


def op4_inverted_multi_index(spark, sf_dir):
    return inverted_multi_index(table(spark, sf_dir, "embeddings"))
