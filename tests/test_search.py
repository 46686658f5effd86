import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from axisforge.operators import match, search, stitch
from axisforge.plans import pipeline
from axisforge.plans.queries import QUERIES

from .conftest import SF
from .test_operators import random_library

LIMITS = [(0.5, 0.1), (2.5, 0.5), (7.0, None), (0.2, 1.5), (None, 0.1)]


@pytest.mark.parametrize("distance,tolerance", LIMITS)
def test_nearest_candidates_are_the_nearest_of_all_edges(spark, distance, tolerance):
    lib = random_library(np.random.default_rng(3), 120)
    lib["k"] = 1 + lib.id % 4
    df = spark.createDataFrame(lib)
    best = match.nearest(match.candidate_edges(df, df, ["job"], distance, tolerance), ["job"], 4)
    key = ["job", "seed", "match", "distance", "rank"]
    assert sorted(match.nearest_candidates(df, df, ["job"], 4, distance, tolerance).select(key).collect()) == sorted(best.select(key).collect())
    some = best.where(F.col("rank") <= 1 + F.col("seed") % 4)
    assert sorted(match.nearest_candidates(df, df, ["job"], "k", distance, tolerance).select(key).collect()) == sorted(some.select(key).collect())


def crowd(n, spots=None):
    g = np.random.default_rng(1)
    at = g.integers(0, spots or n, n) if spots else np.arange(n)
    lib = {"pt": np.exp(g.normal(4, 0.1, n))[at], "direction": g.uniform(0, 6.28, n)[at], "eta": g.normal(0, 0.5, n)[at], "event": np.arange(n) // 2, "rank": np.arange(n)}
    return {"pt": lib["pt"], "query": g.uniform(0, 6.28, n), "partner_eta": g.normal(0, 0.5, n), "event": lib["event"], "rank": lib["rank"], "k": np.full(n, 1)}, lib


@pytest.mark.parametrize("spots", [None, 20])
@pytest.mark.parametrize("tolerance", [0.1, None])
def test_work_grows_with_the_rows_and_not_with_the_candidates(monkeypatch, spots, tolerance):
    seen, exact = [], search.distance_squared
    monkeypatch.setattr(search, "distance_squared", lambda d, *a: (seen.append(len(d)), exact(d, *a))[1])
    work = []
    for n in (2000, 16000):
        seen.clear()
        search.nearest(*crowd(n, spots), 0.5, tolerance)
        work.append(sum(seen))
    assert work[1] < 16 * work[0]  # the edges would be 64 times as many


@pytest.mark.parametrize("name", ["q12_nearest_partner", "q13_nearest_partner_any_pt", "q14_three_nearest", "q15_unordered_pairs", "q15b_next_partner", "q21_ranked_jets", "q25_distance_histogram", "q28_best_match_events"])
def test_no_query_of_nearest_partners_sorts_all_edges(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "FlatMapCoGroupsInArrow" in plan


@pytest.mark.parametrize("near", [1, 3, 8])
def test_draws_from_few_candidates_are_those_from_all_edges(near):
    seeds, lib = crowd(400, 40)
    budgets = np.random.default_rng(2).choice([0, 1, 1, 2, 9], 400)
    edges = lambda k: search.nearest(seeds | {"k": np.full(400, k)}, lib, 0.5, 0.3)
    s, m, d2 = edges(400)
    want = stitch.resolve(budgets, np.random.default_rng(1), s, m, np.sqrt(d2))
    s, m, _ = edges(near)
    library = {**lib, "query": seeds["query"], "partner_eta": seeds["partner_eta"]}
    got = stitch.resolve_nearest(budgets, np.random.default_rng(1), library, stitch.Lists(400, s, m, near), 0.5, 0.3, near)
    assert [(a, -1 if b is None else b) for a, b, _ in want] == list(zip(*(x.tolist() for x in got)))


@pytest.mark.parametrize("random", ["hash", "pcg64"])
def test_libraries_are_stitched_without_their_edges(spark, random):
    parts = [random_library(np.random.default_rng(i), 150).assign(job=j) for i, j in enumerate(["a", "b", None])]
    parts[0].loc[3, "eta"] = np.nan
    df = spark.createDataFrame(pd.concat(parts), "job string, id bigint, ev bigint, pt double, direction double, query double, eta double, partner_eta double, weight double").where("job is not null")
    df = df.withColumn("budget", F.ceil("weight")) if random == "hash" else df
    want = stitch.stitch(df, match.candidate_edges(df, df, ["job"], 1.0, 0.3), "job", 42, random)
    near = match.nearest_candidates(df, df, ["job"], stitch.NEAR, 1.0, 0.3)
    got = stitch.stitch_nearest(df, near, "job", 42, random, 1.0, 0.3)
    assert got.orderBy("job", "draw").collect() == want.orderBy("job", "draw").collect() != []


@pytest.mark.parametrize("name", ["q23_stitch_draws", "q23b_sequential_draws", "q24_pseudo_events", "q26_stitch_cutflow"])
def test_no_query_of_draws_writes_all_edges(spark, name, monkeypatch):
    made, write = [], pipeline.written
    monkeypatch.setattr(pipeline, "written", lambda df, table: (made.append(table), write(df, table))[1])
    assert QUERIES[name](spark, SF).count() >= 0 and made == ["library", "library-draws"]


@pytest.mark.parametrize("distance,tolerance", LIMITS)
def test_candidate_totals_are_those_of_all_edges(spark, distance, tolerance):
    lib = pd.concat([random_library(np.random.default_rng(i), 120).assign(job=j) for i, j in enumerate(["a", "b"])])
    lib.loc[7, "eta"], lib.loc[8, "query"] = np.nan, np.nan
    df = spark.createDataFrame(lib).withColumn("ev", F.when(F.col("ev") % 5 > 0, F.col("ev")))
    edges = match.candidate_edges(df, df, ["job"], distance, tolerance)
    want = edges.groupBy("job", "seed").agg(F.count(F.lit(1)).alias("candidates"), F.sqrt(F.max("d2")).alias("farthest"))
    got = match.candidate_totals(df, df, ["job"], distance, tolerance)
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect()) != []


@pytest.mark.parametrize("distance,tolerance", [*LIMITS, (None, None), (0.0, 0.3), (0.05, 0.0)])
@pytest.mark.parametrize("spots", [None, 12, 1])
@pytest.mark.parametrize("band,pairs", [(128, 1_000_000), (8, 256)])
def test_counts_by_cells_equal_a_scan(monkeypatch, distance, tolerance, spots, band, pairs):
    monkeypatch.setattr(search, "BAND", band)
    monkeypatch.setattr(search, "PAIRS", pairs)
    seeds, lib = crowd(300, spots)
    seeds["query"][:100], seeds["partner_eta"][:100] = lib["direction"][:100], lib["eta"][:100]  # on a spot, as an event's own other half is
    seeds["pt"][:5], lib["pt"][3:8] = 0, 0
    seeds["event"][200:] = -1
    got = search.totals(seeds, lib, distance, tolerance)
    for i in range(300):
        d2 = search.distance_squared(lib["direction"], seeds["query"][i], lib["eta"], seeds["partner_eta"][i])
        there = (lib["rank"] != seeds["rank"][i]) & ((seeds["event"][i] < 0) | (lib["event"] != seeds["event"][i]))
        there &= True if tolerance is None else np.abs(lib["pt"] - seeds["pt"][i]) <= tolerance * seeds["pt"][i]
        there &= True if distance is None else np.sqrt(d2) <= distance
        assert (got[0][i], got[1][i]) == (there.sum(), d2[there].max(initial=-1))


@pytest.mark.parametrize("spots", [None, 20])
@pytest.mark.parametrize("tolerance", [0.1, None])
def test_counting_compares_few_of_the_candidates(monkeypatch, spots, tolerance):
    seen, exact = [], search.distance_squared
    monkeypatch.setattr(search, "distance_squared", lambda d, *a: (seen.append(len(d)), exact(d, *a))[1])
    work = []
    for n in (2000, 16000):
        seen.clear()
        search.totals(*crowd(n, spots), 0.5, tolerance)
        work.append(sum(seen))
    assert work[1] < 24 * work[0]  # 8 times the rows, and the edges of a cell's border; all edges would be 64 times as many


def test_the_query_of_edges_counts_them_without_making_them(spark):
    plan = QUERIES["q29_candidate_edges"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "FlatMapCoGroupsInArrow" in plan
