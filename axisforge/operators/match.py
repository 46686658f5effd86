"""Nearest-neighbour matching of hemispheres: a theta join on circular distance made an equality join by buckets."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from axisforge.functions import kinematics as K
from axisforge.operators import search

#: Buckets are widened by this share, so that rounding loses no pair at their edges; the exact conditions follow.
SLACK = 1e-9


def _cell(x: Column, width: float) -> Column:
    return F.floor(x / F.lit(width)).cast("long")


def _cells(low: Column, high: Column, width: float) -> Column:
    return F.sequence(_cell(low, width), _cell(high, width))


def _buckets(max_distance: float | None, pt_tolerance: float | None):
    """For each key: its cell for a candidate, and the cells that a seed has to look into."""
    out = []
    if max_distance is not None and max_distance > 0:
        n = max(1, math.floor(K.TWO_PI / max_distance))
        width, reach = K.TWO_PI / n, max_distance * (1 + SLACK) + SLACK
        own = F.least(_cell(F.col("direction"), width), F.lit(n - 1))
        q = F.col("query")
        out.append((own, F.array_distinct(F.transform(_cells(q - reach, q + reach, width), lambda c: F.pmod(c, F.lit(n))))))
        e = F.col("partner_eta")
        out.append((_cell(F.col("eta"), max_distance), _cells(e - reach, e + reach, max_distance)))
    if pt_tolerance is not None and 0 < pt_tolerance < 1:
        width = -math.log(1 - pt_tolerance)
        log = F.log(F.when(F.col("pt") > 0, F.col("pt")))
        low, high = math.log(1 - pt_tolerance) - SLACK, math.log(1 + pt_tolerance) + SLACK
        none = F.lit(-(1 << 40))
        out.append((F.coalesce(_cell(log, width), none), F.coalesce(_cells(log + low, log + high, width), F.array(none))))
    return out


def candidate_edges(seeds: DataFrame, lib: DataFrame, scope: list[str], max_distance: float | None = 0.5, pt_tolerance: float | None = 0.10, event: str = "ev") -> DataFrame:
    """(scope, seed, match, d2): all pairs of one library (equal `scope`) that may be matched.

    seeds: scope, id, event, pt, query, partner_eta; lib: scope, id, event, pt, direction, eta.
    A candidate's pt lies within pt_tolerance of the seed's (None: any pt), it is of another
    event (a null event is of none), and its distance in (direction, eta) from (query,
    partner_eta) is max_distance or less (None: any). Edges are directed. Without any limit
    every pair of a library is a candidate, and the join says so. Rows with a null or NaN
    coordinate match nothing.
    """
    keys = _buckets(max_distance, pt_tolerance)
    fine = lambda *cs: [F.col(c).isNotNull() & ~F.isnan(c) for c in cs]
    seeds, lib = seeds.select(*scope, "id", event, "pt", "query", "partner_eta"), lib.select(*scope, "id", event, "pt", "direction", "eta")
    for condition in fine("pt", "query", "partner_eta"):
        seeds = seeds.where(condition)
    for condition in fine("pt", "direction", "eta"):
        lib = lib.where(condition)
    for i, (_, cells) in enumerate(keys):
        seeds = seeds.withColumn(f"_b{i}", F.explode(cells))
    for i, (cell, _) in enumerate(keys):
        lib = lib.withColumn(f"_b{i}", cell)
    s = seeds.select(*scope, *[f"_b{i}" for i in range(len(keys))], F.col("id").alias("seed"), F.col(event).alias("_se"), F.col("pt").alias("_sp"), "query", "partner_eta")
    c = lib.select(*scope, *[f"_b{i}" for i in range(len(keys))], F.col("id").alias("match"), F.col(event).alias("_ce"), F.col("pt").alias("_cp"), "direction", "eta")
    on = [*scope, *[f"_b{i}" for i in range(len(keys))]]
    pairs = s.join(c, on) if on else s.crossJoin(c)
    other = F.coalesce(F.col("_se") != F.col("_ce"), F.lit(True)) & (F.col("seed") != F.col("match"))
    pairs = pairs.where(other)
    if pt_tolerance is not None:
        pairs = pairs.where(F.abs(F.col("_cp") - F.col("_sp")) <= F.lit(pt_tolerance) * F.col("_sp"))
    pairs = pairs.withColumn("d2", K.distance_squared(F.col("direction"), F.col("query"), F.col("eta"), F.col("partner_eta")))
    if max_distance is not None:
        pairs = pairs.where(F.sqrt("d2") <= max_distance)
    return pairs.select(*scope, "seed", "match", "d2")


def nearest(edges: DataFrame, scope: list[str], k: int = 1) -> DataFrame:
    """(scope, seed, match, distance, rank): the k nearest candidates of each seed; ties to the lower id."""
    order = Window.partitionBy(*scope, "seed").orderBy("d2", "match")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*scope, "seed", "match", F.sqrt("d2").alias("distance"), "rank")


def _tiles(max_distance: float | None, pt_tolerance: float | None):
    """As _buckets the other way round, and wider: for each key the tile of a seed, and the tiles whose seeds may have a candidate."""
    out = []
    if max_distance is not None and max_distance > 0:
        n = min(12, max(1, math.floor(K.TWO_PI / (2 * max_distance))))
        width, reach, wide = K.TWO_PI / n, max_distance * (1 + SLACK) + SLACK, max(0.5, 2 * max_distance)
        own, d, e = F.pmod(_cell(F.col("query"), width), F.lit(n)), F.col("direction"), F.col("eta")
        out.append((own, F.array_distinct(F.transform(_cells(d - reach, d + reach, width), lambda c: F.pmod(c, F.lit(n))))))
        out.append((_cell(F.col("partner_eta"), wide), _cells(e - reach, e + reach, wide)))
    if pt_tolerance is not None and 0 < pt_tolerance < 1:
        width = max(0.4, -4 * math.log(1 - pt_tolerance))
        log = F.log(F.when(F.col("pt") > 0, F.col("pt")))
        low, high = -math.log(1 + pt_tolerance) - SLACK, -math.log(1 - pt_tolerance) + SLACK
        none = F.lit(-(1 << 40))
        out.append((F.coalesce(_cell(log, width), none), F.coalesce(_cells(log + low, log + high, width), F.array(none))))
    return out


def nearest_candidates(seeds: DataFrame, lib: DataFrame, scope: list[str], k: int | str = 1, max_distance: float | None = 0.5, pt_tolerance: float | None = 0.10, event: str = "ev") -> DataFrame:
    """(scope, seed, match, distance, rank): nearest(candidate_edges(..), scope, k), without making the edges.

    k: a number, or a column of seeds. A tile of seeds and all that may be their candidates are
    a task's, which searches them by a tree: work and memory grow with the rows and k, not with
    the candidates that a seed has.
    """
    types = {f.name: f.dataType for f in seeds.schema.fields}
    schema = T.StructType([*(T.StructField(x, types[x]) for x in scope), T.StructField("seed", types["id"]), T.StructField("match", types["id"]), T.StructField("distance", T.DoubleType()), T.StructField("rank", T.IntegerType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        s, c = _numbers(left, right)
        a, b, d2 = search.nearest(s | {"k": left["_k"].to_numpy()}, c, max_distance, pt_tolerance)
        turn = np.arange(len(a)) - np.flatnonzero(np.append(True, a[1:] != a[:-1])[: len(a)])[np.cumsum(np.append(True, a[1:] != a[:-1])[: len(a)]) - 1] + 1
        at = pa.array(a)
        return pa.table({**{x: left[x].take(at) for x in scope}, "seed": left["seed"].take(at), "match": right["match"].take(pa.array(b)), "distance": np.sqrt(d2), "rank": turn.astype(np.int32)})

    asked = (F.col(k) if isinstance(k, str) else F.lit(k)).cast("long").alias("_k")
    return _by_tiles(seeds, lib, scope, max_distance, pt_tolerance, event, [asked], run, schema)


def candidate_totals(seeds: DataFrame, lib: DataFrame, scope: list[str], max_distance: float | None = 0.5, pt_tolerance: float | None = 0.10, event: str = "ev") -> DataFrame:
    """(scope, seed, candidates, farthest): how many candidate_edges(..) a seed has, and the largest distance of them, without making the edges.

    Seeds without any have no row. Tiles are those of nearest_candidates, and a grid counts whole
    cells of candidates. Coordinates that aren't finite match nothing. Candidates of a seed's own
    event, of which there are few, are taken off one by one.
    """
    types = {f.name: f.dataType for f in seeds.schema.fields}
    schema = T.StructType([*(T.StructField(x, types[x]) for x in scope), T.StructField("seed", types["id"]), T.StructField("candidates", T.LongType()), T.StructField("farthest", T.DoubleType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        count, d2 = search.totals(*_numbers(left, right), max_distance, pt_tolerance)
        some = np.flatnonzero(count)
        at = pa.array(some)
        return pa.table({**{x: left[x].take(at) for x in scope}, "seed": left["seed"].take(at), "candidates": count[some], "farthest": np.sqrt(d2[some])})

    there = lambda df, *cs: df.where(" and ".join(f"{c} is not null" for c in ("id", *scope))).where(reduce(and_, (F.abs(c) < math.inf for c in cs)))
    return _by_tiles(there(seeds, "pt", "query", "partner_eta"), there(lib, "pt", "direction", "eta"), scope, max_distance, pt_tolerance, event, [], run, schema)


def _numbers(left: pa.Table, right: pa.Table) -> tuple[dict, dict]:
    """A tile's seeds and candidates for the search: events and ids as numbers, ids in their order."""
    numbers = lambda t, *cs: {x: t[x].to_numpy() for x in cs}
    e = pd.factorize(np.concatenate([left["_e"].to_pandas().to_numpy(), right["_e"].to_pandas().to_numpy()]))[0]
    r = pd.factorize(np.concatenate([left["seed"].to_pandas().to_numpy(), right["match"].to_pandas().to_numpy()]), sort=True)[0]
    n = left.num_rows
    return numbers(left, "pt", "query", "partner_eta") | {"event": e[:n], "rank": r[:n]}, numbers(right, "pt", "direction", "eta") | {"event": e[n:], "rank": r[n:]}


def _by_tiles(seeds: DataFrame, lib: DataFrame, scope: list[str], max_distance: float | None, pt_tolerance: float | None, event: str, more: list[Column], run, schema: T.StructType) -> DataFrame:
    """run(seeds, candidates) for each tile of seeds and all that may be their candidates; more: further columns of seeds."""
    fine = lambda *cs: [F.col(c).isNotNull() & ~F.isnan(c) for c in cs]
    seeds, lib = seeds.select(*scope, "id", event, "pt", "query", "partner_eta", *more), lib.select(*scope, "id", event, "pt", "direction", "eta")
    asked = seeds.columns[len(scope) + 5 :]
    for condition in fine("pt", "query", "partner_eta"):
        seeds = seeds.where(condition)
    for condition in fine("pt", "direction", "eta"):
        lib = lib.where(condition)
    tiles = _tiles(max_distance, pt_tolerance)
    for i, (own, reached) in enumerate(tiles):
        seeds, lib = seeds.withColumn(f"_b{i}", own), lib.withColumn(f"_b{i}", F.explode(reached))
    on = [*scope, *[f"_b{i}" for i in range(len(tiles))]]
    s, c = (df.select(*on, F.col("id").alias(name), F.col(event).alias("_e"), *[F.col(x).cast("double").alias(x) for x in own], *others) for df, name, own, others in ((seeds, "seed", ("pt", "query", "partner_eta"), asked), (lib, "match", ("pt", "direction", "eta"), [])))
    c = c.select(*[F.col(x).alias(f"_c{i}") for i, x in enumerate(on)], "match", "_e", "pt", "direction", "eta")
    if not on:  # a tile for all
        s, c = s.withColumn("_b", F.lit(0)), c.withColumn("_c", F.lit(0))
        return s.groupBy("_b").cogroup(c.groupBy("_c")).applyInArrow(run, schema)
    return s.groupBy(*on).cogroup(c.groupBy(*[f"_c{i}" for i in range(len(on))])).applyInArrow(run, schema)


def unordered_pairs(best: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, a, b, distance, mutual): each unordered pair of the best matches once, with the distance of the lower seed's side that chose it."""
    pairs = best.select(*scope, F.least("seed", "match").alias("a"), F.greatest("seed", "match").alias("b"), F.col("seed"), "distance")
    return pairs.groupBy(*scope, "a", "b").agg(F.min_by("distance", "seed").alias("distance"), (F.count(F.lit(1)) > 1).alias("mutual"))
