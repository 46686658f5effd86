"""Stitching: hemispheres drawn and matched under usage budgets, and the pseudo-events that they make."""

from __future__ import annotations

import math
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from axisforge.operators import search
from axisforge.operators.hemisphere import with_parent_hemispheres
from axisforge.operators.thrust import with_thrust

#: Candidates of a seed that are looked up at once.
NEAR = 8


class Usage:
    """Who of a library may still be used, and how often.

    Draws are uniform over those with uses left. The one used up is replaced in the pool by
    the pool's last, so that the order of the pool, and with it every later draw, depends on
    what was used up before.
    """

    def __init__(self, budgets: np.ndarray, generator):
        budgets = np.asarray(budgets, dtype=np.int64)
        pool, place = np.flatnonzero(budgets > 0), np.full(len(budgets), -1, dtype=np.int64)
        place[pool] = np.arange(len(pool))
        self.left, self.pool, self.place = (array("q", x.astype(np.int64).tobytes()) for x in (budgets, pool, place))
        self.generator = generator

    def spend(self, i: int, uses: int = 1) -> None:
        uses = min(uses, self.left[i])
        if uses > 0:
            self.left[i] -= uses
            if not self.left[i]:
                hole, end = self.place[i], self.pool.pop()
                if end != i:
                    self.pool[hole] = end
                    self.place[end] = hole

    def draw(self) -> int | None:
        if not self.pool:
            return None
        i = self.pool[int(self.generator.integers(len(self.pool)))]
        self.spend(i)
        return i


class Pairing(Usage):
    """Usage, and who has been paired with whom: pairs don't repeat, in either direction."""

    def __init__(self, budgets: np.ndarray, generator):
        super().__init__(budgets, generator)
        self.paired: set[tuple] = set()

    def admit(self, budget: int) -> int:
        """The number of one more member."""
        i = len(self.left)
        self.left.append(budget)
        self.place.append(len(self.pool) if budget > 0 else -1)
        if budget > 0:
            self.pool.append(i)
        return i

    def first_open(self, seed, candidates, at: int = 0, end: int | None = None, used_up: bool = False) -> int:
        """The first place from `at` on of a candidate that isn't paired with the seed and, unless `used_up` ones count, has uses left; `end` if there is none."""
        end = len(candidates) if end is None else end
        while at < end and ((seed, candidates[at]) in self.paired or not (used_up or self.left[candidates[at]] > 0)):
            at += 1
        return at

    def pair(self, seed, match: int) -> None:
        self.spend(match)
        self.paired |= {(seed, match), (match, seed)}

    def retire(self, seed: int) -> None:
        """A seed that found no match would only fail again: it loses the uses it has left."""
        self.spend(seed, self.left[seed])


class HashDraws:
    """Whole numbers by hashes of their turn, in the place of a random generator: the k-th, from 1, of integers(n) is floor(u n)."""

    def __init__(self, seed: int):
        self.seed, self.turn = seed, 0

    def integers(self, n: int) -> int:
        self.turn += 1
        return (self.turn * 69_621 + self.turn * self.turn * 40_503 + self.seed * 9_973) % 1_000_003 * n // 1_000_003


def drawn_budgets(weights: np.ndarray, generator: np.random.Generator) -> np.ndarray:
    """Stochastic rounding with one uniform number for each weight, whether it needs one or not."""
    floor = np.floor(weights)
    return (floor + (generator.random(len(weights)) < weights - floor)).astype(np.int64)


def resolve(budgets: np.ndarray, generator, seeds: np.ndarray, matches: np.ndarray, distances: np.ndarray) -> list[tuple[int, int | None, float | None]]:
    """(seed, match, distance) of each draw until no uses are left, by positions in the library; match None: none was found.

    The candidate edges are sorted by (seed, distance, match). A candidate that is used up or
    paired with the seed before is never open to it again, so that each seed keeps a cursor
    in its candidates, and the work is one pass over the edges and draws.
    """
    pairing = Pairing(budgets, generator)
    cursor = np.searchsorted(seeds, np.arange(len(budgets)), side="left").tolist()
    stop = np.searchsorted(seeds, np.arange(len(budgets)), side="right").tolist()
    partner, far = matches.tolist(), distances.tolist()
    out = []
    while (seed := pairing.draw()) is not None:
        cursor[seed] = at = pairing.first_open(seed, partner, cursor[seed], stop[seed])
        if at == stop[seed]:
            pairing.retire(seed)
            out.append((seed, None, None))
        else:
            pairing.pair(seed, partner[at])
            out.append((seed, partner[at], far[at]))
    return out


class OpenPairing(Pairing):
    """Pairing by first_open() of open candidates only: a pair counts no more when either has no uses left."""

    def pair(self, seed: int, match: int) -> None:
        self.spend(match)
        if self.left[seed] and self.left[match]:
            self.paired |= {(seed, match), (match, seed)}


class Lists:
    """Candidates by seed, the nearest first: `flat` from cursor to stop; more: there may be others beyond."""

    def __init__(self, size: int, seeds: np.ndarray, matches: np.ndarray, most: int):
        """seeds: sorted."""
        n = np.bincount(seeds, minlength=size)
        stop = np.cumsum(n)
        self.flat, self.cursor, self.stop, self.more = (memoryview(np.ascontiguousarray(x)) for x in (matches.astype(np.int32), stop - n, stop, (n >= most).astype(np.uint8)))


def resolve_nearest(budgets: np.ndarray, generator, library: dict, lists: Lists, max_distance: float | None, pt_tolerance: float | None, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, matches) of the draws of resolve(), match -1 where none was found, from the `near` nearest candidates of each seed.

    library: pt, direction, eta, query, partner_eta, event (numbers, -1 for none) by position.
    Who is used up or paired with a seed is never open to it again. So a list serves until its
    end; then the nearest are searched again, among those that are open: for all seeds when
    a third of them is left or many lists have ended, else for this one.
    """
    pairing = OpenPairing(budgets, generator)
    rank = np.arange(len(budgets))
    fine = ~np.isnan(np.stack([library[c] for c in ("pt", "direction", "eta")])).any(axis=0)
    names, coordinates = ("pt", "query", "partner_eta", "event"), ("pt", "direction", "eta", "event")
    seeds, matches = array("q"), array("q")
    own: dict[int, tuple[int, list[int]]] = {}  # lists of single seeds: how many were asked for, and which
    open_ = np.flatnonzero((np.asarray(budgets) > 0) & fine)
    built, ended, tree = len(pairing.pool), 0, None
    while (seed := pairing.draw()) is not None:
        found = -1
        while True:
            if seed in own:
                asked, listed = own[seed]
                at = pairing.first_open(seed, listed)
                end, more = len(listed), len(listed) >= asked
                if at < end:
                    found, own[seed] = listed[at], (asked - at, listed[at:])
            else:
                at = lists.cursor[seed] = pairing.first_open(seed, lists.flat, lists.cursor[seed], lists.stop[seed])
                asked, end, more = near, lists.stop[seed], lists.more[seed]
                if at < end:
                    found = lists.flat[at]
            if at < end or not more:
                break
            if 3 * len(pairing.pool) <= built or 16 * ended > len(pairing.pool) + 1600:
                pool = np.sort(np.frombuffer(pairing.pool, dtype=np.int64)) if len(pairing.pool) else np.zeros(0, dtype=np.int64)
                open_, built, ended, tree = pool[fine[pool]], len(pool), 0, None
                own.clear()
                again = np.union1d(pool, [seed])
                again = again[~np.isnan(library["query"][again]) & ~np.isnan(library["partner_eta"][again]) & ~np.isnan(library["pt"][again])]
                some = {c: library[c][again] for c in names} | {"rank": again, "k": np.full(len(again), near)}
                a, b, _ = search.nearest(some, {c: library[c][open_] for c in coordinates} | {"rank": open_}, max_distance, pt_tolerance)
                lists = Lists(len(budgets), again[a], open_[b], near)
            else:
                ended += 1
                if tree is None:
                    tree = search.Tree(*(library[c][open_] for c in coordinates), open_, max_distance, pt_tolerance)
                asked = 4 * max(asked, near)
                _, b, _ = tree.nearest(*(library[c][[seed]] for c in names), rank[[seed]], np.array([asked]))
                own[seed] = asked, open_[b].tolist()
        if found < 0:
            pairing.retire(seed)
        else:
            pairing.pair(seed, found)
        if not pairing.left[seed]:
            own.pop(seed, None)
        seeds.append(seed)
        matches.append(found)
    return np.array(seeds, dtype=np.int64), np.array(matches, dtype=np.int64)


def stitch_nearest(lib: DataFrame, near: DataFrame, scope: str, seed: int = 42, random: str = "pcg64", max_distance: float | None = 0.5, pt_tolerance: float | None = 0.10, event: str = "ev") -> DataFrame:
    """stitch() by the NEAR nearest candidates of each seed (match.nearest_candidates) in the place of all edges.

    A library still is one task, as its draws depend on each other. It holds some numbers and
    NEAR candidates for each hemisphere, which come in batches.
    """
    has_budget = "budget" in lib.columns
    size, numbers = "budget" if has_budget else "weight", ("pt", "direction", "eta", "query", "partner_eta")
    types = {f.name: f.dataType for f in lib.schema.fields}
    schema = T.StructType([T.StructField(scope, types[scope]), T.StructField("draw", T.LongType()), T.StructField("seed", types["id"]), T.StructField("match", types["id"]), T.StructField("distance", T.DoubleType())])
    listed = near.groupBy(F.col(scope).alias("_scope"), F.col("seed").alias("_seed")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "match"))), lambda x: x["match"]).alias("_near"))
    rows = lib.select(scope, "id", F.col(event).alias("_ev"), F.col(size).alias("_size"), *[F.col(c).cast("double").alias(c) for c in numbers])
    rows = rows.join(listed, rows[scope].eqNullSafe(F.col("_scope")) & (rows["id"] == F.col("_seed")), "left").drop("_scope", "_seed")

    def draws(parts: list[pa.RecordBatch]):
        column = lambda c: pa.chunked_array([p.column(c) for p in parts])
        ids, values = column("id"), column("_size").to_numpy()
        library = {c: column(c).to_numpy() for c in numbers} | {"event": pd.factorize(column("_ev").to_pandas())[0]}
        name, order = column(scope).slice(0, 1), ids.to_pandas().to_numpy()
        owners, found, done = [], [], 0
        for i, p in enumerate(parts):
            lists, parts[i] = p.column("_near"), None
            n = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
            owners.append(np.repeat(np.arange(done, done + len(n), dtype=np.int32), n))
            found.append(np.searchsorted(order, lists.flatten().to_pandas().to_numpy()).astype(np.int32))
            done += len(n)
        generator = HashDraws(seed) if random == "hash" else np.random.default_rng(seed)
        budgets = values.astype(np.int64) if has_budget else drawn_budgets(values.astype(np.float64), generator)
        s, m = resolve_nearest(budgets, generator, library, Lists(len(budgets), np.concatenate(owners), np.concatenate(found), NEAR), max_distance, pt_tolerance)
        for i in range(0, len(s), 100_000):
            a, b = s[i : i + 100_000], m[i : i + 100_000]
            d = np.sqrt(search.distance_squared(library["direction"][b], library["query"][a], library["eta"][b], library["partner_eta"][a]))
            to = pa.array(np.maximum(b, 0), mask=b < 0)
            columns = [name.take(pa.array(np.zeros(len(a), dtype=np.int64))).combine_chunks(), pa.array(np.arange(i, i + len(a))), ids.take(pa.array(a)).combine_chunks(), ids.take(to).combine_chunks(), pa.array(d, mask=b < 0)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    def run(batches):
        parts, now = [], None
        for batch in batches:
            at = batch.column(scope).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                if low < high:
                    piece = batch.slice(low, high - low)
                    value = piece.column(scope)[0].as_py()
                    if parts and value != now:
                        yield from draws(parts)
                        parts = []
                    now = value
                    parts.append(piece)
        if parts:
            yield from draws(parts)

    return rows.repartition(scope).sortWithinPartitions(scope, "id").mapInArrow(run, schema)


def with_drawn_budgets(lib: DataFrame, scope: str, seed: int = 42) -> DataFrame:
    """(scope, id, pt, budget): the budgets that stitch() draws for a library's weights."""
    types = {f.name: f.dataType for f in lib.schema.fields}

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        return rows.assign(budget=drawn_budgets(rows.pop("weight").to_numpy(dtype=np.float64), np.random.default_rng(seed)))

    schema = T.StructType([*(T.StructField(c, types[c]) for c in (scope, "id", "pt")), T.StructField("budget", T.LongType())])
    return lib.select(scope, "id", "pt", "weight").groupBy(scope).applyInPandas(run, schema)


def stitch(lib: DataFrame, edges: DataFrame, scope: str, seed: int = 42, random: str = "pcg64") -> DataFrame:
    """(scope, draw, seed, match, distance) of every draw in every library; match is null where none was found.

    lib: scope, id, and either budget or weight (from which budgets are then drawn, in the
    order of id, by the same generator that draws seeds). Draws depend on each other within
    a library, so a library is a task; its candidate edges, found beforehand by a distributed
    join, are all that it needs. Each library starts from the same seed. random: `pcg64`, or
    `hash` for draws by HashDraws, which needs budgets.
    """
    has_budget = "budget" in lib.columns
    size = "budget" if has_budget else "weight"
    types = {f.name: f.dataType for f in lib.schema.fields}
    schema = T.StructType([T.StructField(scope, types[scope]), T.StructField("draw", T.LongType()), T.StructField("seed", types["id"]), T.StructField("match", types["id"]), T.StructField("distance", T.DoubleType())])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("id", kind="stable")
        ids, values = left["id"].to_numpy(), left[size].to_numpy()
        generator = HashDraws(seed) if random == "hash" else np.random.default_rng(seed)
        budgets = values.astype(np.int64) if has_budget else drawn_budgets(values.astype(np.float64), generator)
        s, m, d2 = np.searchsorted(ids, right["seed"].to_numpy()), np.searchsorted(ids, right["match"].to_numpy()), right["d2"].to_numpy(dtype=np.float64)
        order = np.lexsort((m, d2, s))
        draws = resolve(budgets, generator, s[order], m[order], np.sqrt(d2[order]))
        if not draws:
            return pd.DataFrame({f.name: pd.Series(dtype="object") for f in schema.fields})
        a, b, d = zip(*draws, strict=True)
        return pd.DataFrame({scope: left[scope].iloc[0], "draw": range(len(draws)), "seed": ids[list(a)], "match": pd.array([None if i is None else ids[i] for i in b], dtype="Int64"), "distance": pd.array(d, dtype="Float64")})

    return lib.select(scope, "id", size).groupBy(scope).cogroup(edges.select(F.col(scope).alias("_scope"), "seed", "match", "d2").groupBy("_scope")).applyInPandas(run, schema)


def pseudo_events(pairs: DataFrame, lib: DataFrame, scope: list[str], scan_points: int = 180) -> DataFrame:
    """One event for each pair (seed, match, distance) of hemispheres of lib (scope, id, jets).

    The jets of both, unchanged, by falling pt (equal: the seed's first), each with
    hemisphere 0 for the seed's and 1 for the match's; HT, a new thrust axis, and Hemisphere
    by parentage. The columns of pairs stay.
    """
    own = lambda name, flag: lib.select(*scope, F.col("id").alias(name), F.transform("jets", lambda j, i: F.struct(j.pt.cast("double").alias("pt"), j.eta.cast("double").alias("eta"), j.phi.cast("double").alias("phi"), j.m.cast("double").alias("m"), F.lit(flag).alias("hemisphere"), i.alias("_i"))).alias(f"_{name}"))
    out = pairs.where(F.col("match").isNotNull()).join(own("seed", 0), [*scope, "seed"]).join(own("match", 1), [*scope, "match"])
    key = lambda j: F.struct(-j.pt, j.hemisphere, j._i)
    ordered = F.transform(F.array_sort(F.transform(F.concat("_seed", "_match"), lambda j: F.struct(key(j).alias("k"), j.alias("j")))), lambda x: F.struct(*[x.j[c].alias(c) for c in ("pt", "eta", "phi", "m", "hemisphere")]))
    out = out.withColumn("jets", ordered).drop("_seed", "_match")
    out = with_thrust(out, scan_points)
    out = with_parent_hemispheres(out)
    return out.withColumn("HT", F.aggregate("jets", F.lit(0.0), lambda a, j: a + j.pt).cast("float")).withColumn("xs_weight", F.lit(1.0).cast("float"))


def brute_force_draws(budgets: np.ndarray, generator: np.random.Generator, allowed, distance) -> list[tuple[int, int | None, float | None]]:
    """What resolve() gives, by a scan of the whole library at each draw; for tests of small libraries."""
    usage, paired, out, n = Usage(budgets, generator), set(), [], len(budgets)
    while (seed := usage.draw()) is not None:
        open_ = [(distance(seed, c), c) for c in range(n) if usage.left[c] > 0 and (seed, c) not in paired and allowed(seed, c)]
        if not open_:
            usage.spend(seed, usage.left[seed])
            out.append((seed, None, None))
            continue
        d, match = min(open_)
        usage.spend(match)
        paired |= {(seed, match), (match, seed)}
        out.append((seed, match, math.sqrt(d)))
    return out
