"""The queries in DuckDB's SQL, written from the definitions rather than from the plans."""

from __future__ import annotations


def _r(x: str, name: str, digits: int = 4) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits}) + 0.0 AS {name}"


JETS = """
jets AS (SELECT CAST(l_orderkey AS BIGINT) AS ev,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS j,
    l_extendedprice / 1000 AS pt,
    CAST((l_partkey * 15485863 + l_suppkey * 6700417 + CAST(round(l_extendedprice * 100) AS BIGINT) * 127) % 1000033 AS DOUBLE) / 1000033 * 5 - 2.5 AS eta,
    CAST((l_partkey * 7919 + l_suppkey * 104729 + CAST(round(l_extendedprice * 100) AS BIGINT) * 31) % 1000003 AS DOUBLE) / 1000003 * 2 * pi() - pi() AS phi,
    l_quantity / 5 AS m FROM lineitem),
five AS (SELECT ev FROM jets GROUP BY ev HAVING count(*) = 5),
mom AS (SELECT ev AS key, j, pt, eta, phi, m, pt * cos(phi) AS px, pt * sin(phi) AS py, pt * sinh(eta) AS pz, sqrt(pt * cosh(eta) * (pt * cosh(eta)) + m * m) AS e FROM jets WHERE ev IN (SELECT ev FROM five))
"""


def _axis(jets: str = "mom", out: str = "axis") -> str:
    """phi (of a float) and thrust by key, from jets (key, j, pt, px, py)."""
    proj = lambda a: f"sum(abs(px * cos({a}) + py * sin({a})) ORDER BY j)"
    return f"""
{out}_grid AS (SELECT key, k, {proj("k * (pi() / 180)")} AS h FROM {jets}, range(180) g(k) GROUP BY key, k),
{out}_best AS (SELECT key, k, h FROM {out}_grid QUALIFY row_number() OVER (PARTITION BY key ORDER BY h DESC, k) = 1),
{out}_near AS (SELECT key, any_value(b.k * (pi() / 180)) AS a, any_value(b.h) AS h, {proj("b.k * (pi() / 180) - pi() / 180")} AS lo, {proj("b.k * (pi() / 180) + pi() / 180")} AS hi FROM {jets} JOIN {out}_best b USING (key) GROUP BY key),
{out}_moved AS (SELECT key, a + CASE WHEN abs(lo - 2 * h + hi) > 1e-12 THEN greatest(-1, least(1, 0.5 * (lo - hi) / (lo - 2 * h + hi))) ELSE 0 END * (pi() / 180) AS x FROM {out}_near),
{out}_phi AS (SELECT key, x - floor(x / pi()) * pi() AS phi FROM {out}_moved),
{out} AS (SELECT key, CAST(CAST(any_value(a.phi) AS FLOAT) AS DOUBLE) AS phi, CAST(CAST(CASE WHEN sum(pt) > 0 THEN {proj("a.phi")} / sum(pt ORDER BY j) ELSE 0 END AS FLOAT) AS DOUBLE) AS thrust FROM {jets} JOIN {out}_phi a USING (key) GROUP BY key)
"""


def _halves(jets: str, side: str, axis: str = "axis", out: str = "halves") -> str:
    """Sums by (key, side in 1, -1) as floats; `side` is an expression on a jet t and its axis a."""
    f = lambda x: f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
    s = lambda c: f"coalesce(sum({c} ORDER BY j), 0)"
    return f"""
{out}_sided AS (SELECT t.*, {side} AS side FROM {jets} t JOIN {axis} a USING (key)),
{out}_spine AS (SELECT key, a.phi AS axis, s.side FROM {axis} a, (VALUES (1), (-1)) s(side)),
{out}_sums AS (SELECT key, side, any_value(axis) AS axis, {s("px")} AS x, {s("py")} AS y, {s("pz")} AS z, {s("e")} AS en, count(j) AS n FROM {out}_spine LEFT JOIN {out}_sided USING (key, side) GROUP BY key, side),
{out}_one AS (SELECT key, side, axis, CAST(n AS INTEGER) AS n_jets, {f("x")} AS px, {f("y")} AS py, {f("z")} AS pz, {f("en")} AS energy, {f("sqrt(x * x + y * y)")} AS pt,
    {f("CASE WHEN sqrt(x * x + y * y) > 0 THEN asinh(z / sqrt(x * x + y * y)) ELSE 0 END")} AS eta, {f("atan2(y, x)")} AS phi, {f("sqrt(greatest(en * en - (x * x + y * y + z * z), 0))")} AS mass,
    {f("x * cos(axis) + y * sin(axis)")} AS pt_par, {f("-x * sin(axis) + y * cos(axis)")} AS pt_perp FROM {out}_sums),
{out} AS (SELECT a.*, b.eta AS partner_eta FROM {out}_one a JOIN {out}_one b ON a.key = b.key AND a.side = -b.side)
"""


BY_AXIS = "CASE WHEN t.px * cos(a.phi) + t.py * sin(a.phi) > 0 THEN 1 ELSE -1 END"
MIXED = f"{JETS}, {_axis()}, {_halves('mom', BY_AXIS)}"
#: Floored modulo.
MOD = lambda x, y: f"(({x}) - floor(({x}) / {y}) * {y})"
TWO_PI = "(2 * pi())"
_ALONG = MOD(MOD("axis", "pi()"), TWO_PI)
_DIRECTION = f"CASE WHEN side >= 0 THEN {_ALONG} ELSE {MOD(f'{_ALONG} + pi()', TWO_PI)} END"
LIBRARY = f"""{MIXED},
lib AS (SELECT key AS ev, key * 2 + CASE WHEN side > 0 THEN 0 ELSE 1 END AS id, CASE WHEN side > 0 THEN 0 ELSE 1 END AS slot, side, pt, eta, partner_eta, {_DIRECTION} AS direction, {MOD(f"({_DIRECTION}) + pi()", TWO_PI)} AS query FROM halves WHERE n_jets = 3)
"""


def _edges(window: str = "abs(c.pt - s.pt) <= 0.1 * s.pt AND") -> str:
    turn = MOD("abs(c.direction - s.query)", TWO_PI)
    d = f"least({turn}, {TWO_PI} - {turn})"
    return f"edges AS (SELECT * FROM (SELECT s.id AS seed, c.id AS match, {d} * {d} + (c.eta - s.partner_eta) * (c.eta - s.partner_eta) AS d2 FROM lib s, lib c WHERE {window} s.ev <> c.ev) WHERE sqrt(d2) <= 0.5)"


BEST = "best AS (SELECT seed, match, sqrt(d2) AS distance FROM edges QUALIFY row_number() OVER (PARTITION BY seed ORDER BY d2, match) = 1)"
WEIGHTS = """
xs(dataset, xs_pb) AS (VALUES ('1-URGENT', 2.4::DOUBLE), ('2-HIGH', 1.6), ('3-MEDIUM', 1.0), ('4-NOT SPECIFIED', 0.8), ('5-LOW', 0.3)),
slice_n AS (SELECT o_orderpriority AS dataset, count(*) AS n FROM orders GROUP BY 1),
slice_w AS (SELECT dataset, (SELECT count(*) FROM orders) / 5.0::DOUBLE * xs_pb / n AS w FROM slice_n JOIN xs USING (dataset)),
event_w AS (SELECT CAST(o_orderkey AS BIGINT) AS ev, w FROM orders JOIN slice_w ON dataset = o_orderpriority)
"""
_W = "CAST(CAST(w AS FLOAT) AS DOUBLE)"
_U = "CAST((ev % 1000003 * 69621 + (side + 2) * 40503 + 42 * 9973) % 1000003 AS DOUBLE) / 1000003"
BUDGET = f"CAST(floor({_W}) AS BIGINT) + CASE WHEN {_U} < {_W} - floor({_W}) THEN 1 ELSE 0 END"
FILES = """
files AS (SELECT c_mktsegment AS slice, concat('root://host//store/slim/', c_mktsegment, '/', c_name, '.root') AS path, 'events' AS tree FROM customer GROUP BY ALL),
nth AS (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY path) AS nth FROM files),
assigned AS (SELECT *, CAST(floor((nth - 1) / 5) + 1 AS BIGINT) AS k, (SELECT min(n // 5) FROM (SELECT count(*) AS n FROM files GROUP BY slice)) AS jobs FROM nth),
placed AS (SELECT 'job_' || k AS job, path, tree FROM assigned WHERE k <= jobs),
cut AS (SELECT job, path, CAST((row_number() OVER (PARTITION BY job ORDER BY path) - 1) // 10 AS BIGINT) AS sub_job FROM placed)
"""


def _histogram(name: str, source: str, value: str, bins: int, high: str) -> str:
    at = f"CASE WHEN {value} < 0 THEN 0 WHEN {value} >= {high} THEN {bins + 1} ELSE least(CAST(floor({value} * {bins} / {high}) AS INTEGER), {bins - 1}) + 1 END"
    edge = lambda k: f"round(({k}) * ({high} / {bins}), 4) + 0.0"
    return f"""SELECT '{name}' AS hist, CAST(b AS INTEGER) AS bin, CASE WHEN b > 0 THEN {edge("b - 1")} END AS low, CASE WHEN b <= {bins} THEN {edge("b")} END AS high, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM range({bins + 2}) s(b) LEFT JOIN (SELECT {at} AS cell, count(*) AS n FROM {source} GROUP BY 1) ON cell = b"""


SUMS = ("px", "py", "pz", "energy", "pt", "eta", "phi", "mass", "pt_par", "pt_perp", "partner_eta")
_SUMS = ", ".join(_r(c, c) for c in SUMS)
_THRUST = f"WITH {JETS}, {_axis()} SELECT key AS ev, {_r('phi', 'thrust_axis_phi')}, {_r('thrust', 'thrust')} FROM axis"


def _pair_jets(made: str, key: str) -> str:
    """The jets of the pairs (seed, match) of `made`, by a key of theirs."""
    return f"""
sided AS (SELECT t.*, CASE WHEN t.px * cos(a.phi) + t.py * sin(a.phi) > 0 THEN 0 ELSE 1 END AS slot FROM mom t JOIN axis a USING (key)),
own AS (SELECT key * 2 + slot AS id, j, pt, eta, phi, m, px, py, pz, e FROM sided),
six AS (SELECT b.{key} AS key, 0 AS flag, own.* FROM {made} b JOIN own ON own.id = b.seed UNION ALL SELECT b.{key}, 1, own.* FROM {made} b JOIN own ON own.id = b.match),
pairs AS (SELECT key, flag, row_number() OVER (PARTITION BY key ORDER BY pt DESC, flag, j) AS j, pt, eta, phi, m, px, py, pz, e FROM six)
"""


def _pair_events(made: str, key: str, names: str) -> str:
    """The pseudo-events of the pairs of `made`, by halves."""
    return f"""{_pair_jets(made, key)}, {_axis("pairs", "axis6")}, {_halves("pairs", "CASE WHEN t.flag = 0 THEN 1 ELSE -1 END", "axis6", "halves6")},
        ht AS (SELECT key, CAST(sum(pt ORDER BY j) AS FLOAT) AS ht FROM pairs GROUP BY key)
        SELECT {names}, {_r("ht", "HT")}, {_r("a.phi", "thrust_axis_phi")}, {_r("a.thrust", "thrust")}, CAST(CASE WHEN h.side > 0 THEN 0 ELSE 1 END AS INTEGER) AS slot, h.n_jets, 1.0::DOUBLE AS weight, {", ".join(_r("h." + c, c) for c in SUMS)}
        FROM halves6 h JOIN {made} b ON b.{key} = h.key JOIN axis6 a ON a.key = h.key JOIN ht ON ht.key = h.key"""


_TURN = "((t + 1) * 69621 + (t + 1) * (t + 1) * 40503 + 42 * 9973) % 1000003"
_WITHOUT = lambda pool, place: f"list_transform({pool}[1:len({pool}) - 1], lambda x, j: CASE WHEN j = {place} THEN {pool}[len({pool})] ELSE x END)"
#: Draws until no uses are left, one step a draw: who is drawn, its nearest open candidate, and what both have left.
DRAWS = f"""
b AS (SELECT id, row_number() OVER (ORDER BY id) AS i, {BUDGET} AS budget FROM lib JOIN event_w USING (ev)),
near AS (SELECT s.i AS seed, list(c.i ORDER BY d2, c.i) AS m, list(sqrt(d2) ORDER BY d2, c.i) AS d FROM edges JOIN b s ON edges.seed = s.id JOIN b c ON edges.match = c.id GROUP BY s.i),
run(t, uses, pool, paired, s, mm, dd) AS (
    SELECT 0::BIGINT, list(budget ORDER BY i), coalesce(list(i ORDER BY i) FILTER (budget > 0), []), []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM b
    UNION ALL
    SELECT t + 1, uses2, CASE WHEN uses2[gone] = 0 AND place IS NOT NULL THEN {_WITHOUT("pool1", "place")} ELSE pool1 END,
        CASE WHEN mm IS NULL THEN paired ELSE list_concat(paired, [s * 1000000 + mm, mm * 1000000 + s]) END, s, mm, dd
    FROM (SELECT *, coalesce(mm, s) AS gone, list_position(pool1, coalesce(mm, s)) AS place,
            list_transform(uses1, lambda x, j: CASE WHEN j = coalesce(mm, s) THEN CASE WHEN mm IS NULL THEN 0 ELSE x - 1 END ELSE x END) AS uses2
        FROM (SELECT *, m[x] AS mm, d[x] AS dd
            FROM (SELECT q.*, near.m, near.d, list_filter(range(1, coalesce(len(near.m), 0) + 1), lambda y: uses1[near.m[y]] > 0 AND NOT list_contains(paired, s * 1000000 + near.m[y]))[1] AS x
                FROM (SELECT t, paired, s, list_transform(uses, lambda x, j: CASE WHEN j = s THEN x - 1 ELSE x END) AS uses1, CASE WHEN uses[s] = 1 THEN {_WITHOUT("pool", "k")} ELSE pool END AS pool1
                    FROM (SELECT t, uses, pool, paired, k, pool[k] AS s FROM (SELECT t, uses, pool, paired, 1 + {_TURN} * len(pool) // 1000003 AS k FROM run WHERE len(pool) > 0))) q LEFT JOIN near ON near.seed = q.s)))),
draws AS (SELECT t - 1 AS draw, x.id AS seed, y.id AS match, dd AS distance FROM run JOIN b x ON x.i = run.s LEFT JOIN b y ON y.i = run.mm WHERE t > 0),
made AS (SELECT * FROM draws WHERE match IS NOT NULL)
"""
_DRAWN = f"WITH RECURSIVE {LIBRARY}, {_edges()}, {WEIGHTS}, {DRAWS}"

SQL = {
    "q01_jet_fourvectors": f"WITH {JETS} SELECT ev, j, {_r('pt * cos(phi)', 'px')}, {_r('pt * sin(phi)', 'py')}, {_r('pt * sinh(eta)', 'pz')}, {_r('sqrt(pt * cosh(eta) * (pt * cosh(eta)) + m * m)', 'energy')} FROM jets",
    "q02_mixer_cutflow": f"WITH {JETS} SELECT count(DISTINCT ev) AS n_read, (SELECT count(*) FROM five) AS n_pass FROM jets",
    "q03_event_ht": f"WITH {JETS} SELECT ev, {_r('sum(pt ORDER BY j)', 'ht', 6)} FROM jets GROUP BY ev",
    "q04_thrust_axis": _THRUST,
    "q04b_thrust_axis_expressions": _THRUST,
    "q05_hemispheres": f"WITH {MIXED} SELECT key AS ev, n_jets, CAST(side AS INTEGER) AS side, 1.0::DOUBLE AS weight, {_SUMS} FROM halves",
    "q06_mix_histograms": f"WITH {MIXED} {_histogram('thrust_axis_phi', 'axis', 'phi', 90, 'pi()')} UNION ALL {_histogram('hemisphere_njets', 'halves', 'n_jets', 20, '20.0::DOUBLE')}",
    "q07_event_weights": f"WITH {JETS}, {WEIGHTS} SELECT ev, {_r('w', 'xs_weight')} FROM event_w WHERE ev IN (SELECT ev FROM five)",
    "q08_dataset_inference": f"""WITH f AS (SELECT 'slimmed_' || n_name || '_0.root' AS name FROM nation), k AS (SELECT n_name AS dataset, CAST(n_nationkey + 1 AS DOUBLE) AS xs FROM nation WHERE n_nationkey <= 12 AND n_nationkey <> 2),
        b AS (SELECT name, dataset, xs FROM f LEFT JOIN k ON contains(name, dataset) QUALIFY row_number() OVER (PARTITION BY name ORDER BY length(dataset) DESC NULLS LAST, dataset) = 1)
        SELECT name, dataset, {_r("coalesce(2.0::DOUBLE * xs / 100, 1)", "xs_weight")} FROM b""",
    "q09_library": f"""WITH {LIBRARY} SELECT lib.ev, CAST(lib.slot AS INTEGER) AS slot, CAST(lib.side AS INTEGER) AS side, row_number() OVER (PARTITION BY lib.id ORDER BY j) - 1 AS i, {", ".join(_r("t." + c, c, 6) for c in ("pt", "eta", "phi", "m"))}
        FROM lib JOIN halves_sided t ON t.key = lib.ev AND t.side = lib.side""",
    "q10_directions": f"WITH {LIBRARY} SELECT ev, CAST(slot AS INTEGER) AS slot, {_r('direction', 'direction')}, {_r('query', 'query')} FROM lib",
    "q11_hash_budgets": f"WITH {LIBRARY}, {WEIGHTS} SELECT ev, CAST(slot AS INTEGER) AS slot, {BUDGET} AS budget FROM lib JOIN event_w USING (ev)",
    "q12_nearest_partner": f"WITH {LIBRARY}, {_edges()}, {BEST} SELECT seed, match, {_r('distance', 'distance')} FROM best",
    "q13_nearest_partner_any_pt": f"WITH {LIBRARY}, {_edges('')}, {BEST} SELECT seed, match, {_r('distance', 'distance')} FROM best",
    "q14_three_nearest": f"WITH {LIBRARY}, {_edges()} SELECT seed, CAST(row_number() OVER (PARTITION BY seed ORDER BY d2, match) AS INTEGER) AS rank, match, {_r('sqrt(d2)', 'distance')} FROM edges QUALIFY rank <= 3",
    "q15_unordered_pairs": f"WITH {LIBRARY}, {_edges()}, {BEST} SELECT least(seed, match) AS a, greatest(seed, match) AS b, {_r('arg_min(distance, seed)', 'distance')}, count(*) > 1 AS mutual FROM best GROUP BY 1, 2",
    "q15b_next_partner": f"""WITH {LIBRARY}, {_edges()}, {BEST}, rest AS (SELECT * FROM edges WHERE NOT EXISTS (SELECT 1 FROM best b WHERE (b.seed = edges.seed AND b.match = edges.match) OR (b.seed = edges.match AND b.match = edges.seed)))
        SELECT seed, match, {_r("sqrt(d2)", "distance")} FROM rest QUALIFY row_number() OVER (PARTITION BY seed ORDER BY d2, match) = 1""",
    "q16_slice_balanced_jobs": f"WITH {FILES} SELECT job, path, tree FROM placed",
    "q17_leftover_files": f"WITH {FILES} SELECT path, tree FROM assigned WHERE k > jobs",
    "q18_sub_jobs": f"WITH {FILES} SELECT job, path, sub_job FROM cut",
    "q18b_split_jobs": f"WITH {FILES} SELECT job, count(DISTINCT sub_job) AS sub_jobs, count(*) AS files FROM cut GROUP BY job HAVING count(DISTINCT sub_job) > 1",
    "q19_redirectors": """WITH p AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+/+', '/') AS plain FROM pages), n AS (SELECT *, split_part(plain, '/', -1) AS name FROM p)
        SELECT page_id, plain, 'root://xcache//' || ltrim(plain, '/') AS redirected, name, regexp_replace(name, '^(.+)\\.[^.]*$', '\\1') AS stem FROM n""",
    "q20_dataset_labels": """SELECT '/store/' || c_name || '/' AS path, split_part(c_name, '#', 1) AS label FROM customer GROUP BY ALL
        UNION ALL SELECT 'lists/' || p_brand || '_filelist.txt', p_brand FROM part GROUP BY ALL""",
    "q20b_filelist_lines": """SELECT c_mktsegment AS source, CASE c_custkey % 5 WHEN 0 THEN 'root://xcache//store/' || c_name WHEN 2 THEN 'root://host//store/' || c_name END AS path, 'events' AS tree, c_custkey % 5 = 4 AS skipped FROM customer WHERE c_custkey % 5 NOT IN (1, 3)""",
    "q21_ranked_jets": f"WITH {LIBRARY}, {_edges()}, {BEST}, {_pair_jets('best', 'seed')} SELECT p.key AS seed, b.match, p.j - 1 AS i, {', '.join(_r('p.' + c, c, 6) for c in ('pt', 'eta', 'phi', 'm'))}, CAST(p.flag AS INTEGER) AS hemisphere FROM pairs p JOIN best b ON b.seed = p.key",
    "q22_layout_round_trip": f"WITH {JETS} SELECT ev, j, {', '.join(_r(c, c, 6) for c in ('pt', 'eta', 'phi', 'm'))} FROM jets",
    "q23_stitch_draws": f"{_DRAWN} SELECT CAST(1 AS INTEGER) AS job, draw, seed, coalesce(match, -1) AS match, {_r('distance', 'distance')} FROM draws",
    "q24_pseudo_events": f"{_DRAWN}, {_pair_events('made', 'draw', 'b.draw, b.seed, b.match')}",
    "q25_distance_histogram": f"WITH {LIBRARY}, {_edges()}, {BEST} {_histogram('match_distance', '(SELECT CAST(CAST(distance AS FLOAT) AS DOUBLE) AS d FROM best)', 'd', 100, '0.5::DOUBLE')}",
    "q26_stitch_cutflow": f"""{_DRAWN} SELECT CAST(1 AS INTEGER) AS job, step, CAST(n AS BIGINT) AS n FROM (SELECT 'hemispheres' AS step, count(*) AS n FROM b UNION ALL SELECT 'total budget', sum(budget) FROM b
        UNION ALL SELECT 'draws', count(*) FROM draws UNION ALL SELECT 'pseudo-events', count(*) FROM made UNION ALL SELECT 'failed matches', count(*) FROM draws WHERE match IS NULL)""",
    "q27_library_totals": f"""WITH {LIBRARY}, {WEIGHTS}, b AS (SELECT pt, {BUDGET} AS budget FROM lib JOIN event_w USING (ev))
        SELECT count(*) AS n_hemispheres, count(*) FILTER (budget > 0) AS n_available, CAST(sum(budget) AS BIGINT) AS total_budget, {_r("max(pt)", "pt_max")} FROM b""",
    "q28_best_match_events": f"WITH {LIBRARY}, {_edges()}, {BEST}, {_pair_events('best', 'seed', 'b.seed, b.match')}",
    "q29_candidate_edges": f"WITH {LIBRARY}, {_edges()} SELECT seed, count(*) AS candidates, {_r('sqrt(max(d2))', 'farthest')} FROM edges GROUP BY seed",
    "q30_slice_totals": "SELECT o_orderpriority AS slice, o_orderstatus AS file, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS n_original FROM orders GROUP BY 1, 2",
    "q31_merged_filesets": f"WITH {FILES} SELECT slice, path, CASE WHEN substring(path, length(path) - 5, 1) IN ('0', '3', '6', '9') THEN 'Events' ELSE tree END AS tree FROM files WHERE slice LIKE '%BUILD%' OR slice LIKE '%AUTO%' OR slice LIKE '%MACH%'",
}
