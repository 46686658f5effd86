"""Each operator against brute force or its law, and on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from axisforge.llm import ann, bpe, common, exact, language, mixing, near, quality, sharding, suffix, urls
from axisforge.llm.queries import QUERIES, SQL

from ..conftest import SF
from ..oracle import compare

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the and with tion ing her ere ent tha nth was eth for dth hat she ion his sth ers".split()


def prose(g, n):
    return " ".join(g.choice(WORDS) + g.choice(WORDS) for _ in range(n))


def corpus(seed=1, n=60):
    g = random.Random(seed)
    texts = [prose(g, g.choice([3, 40, 120])) for _ in range(n)]
    texts += [texts[0], texts[1] + "  " + texts[2], texts[5].replace(" ", "\n "), texts[5], texts[6][:200] + " x " + texts[6][200:], "", " \t ", None, None, "é中😀 " * 20, prose(g, 30000), texts[7], texts[7]]
    rows = [(i, t, g.choice(["en", "de", None]), g.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[-1], rows[3]]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    common.ship(spark)
    return frame(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    compare(spark, SF, QUERIES[name], SQL[name])


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_EDGES", few)
    g = random.Random(4)
    edges = [(g.randrange(60), g.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {tuple(r) for r in common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {(x, find(x)) for x in parent}


# 1: sharding


def shard(rows, shards=4):
    text = F.coalesce("text", F.lit(""))
    return sharding.lpt_shards(rows, shards, text, F.octet_length(text) + 1, [F.col("doc_id"), text])


def test_shards_are_near_equal_whole_groups_with_gapless_slots(spark, docs):
    rows = shard(docs.drop("n_chars").withColumn("shard", F.lit("clash"))).collect()
    assert len(rows) == docs.count()
    slots, load, where = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += len((r.text or "").encode()) + 1
        where[r.text or ""].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(w) == 1 for w in where.values())
    big = max(len(t.encode()) for t in where)
    assert max(load.values()) <= max(big * 1.01 + 3, sum(load.values()) / 4 * 1.05)


def test_many_small_groups_are_dealt_evenly(spark):
    g = random.Random(2)
    rows = spark.createDataFrame([(i, str(i), g.choice([3, 5, 8, 13, 21, 5000])) for i in range(20000)], "doc_id bigint, k string, size bigint")
    out = sharding.lpt_shards(rows, 16, F.col("k"), F.col("size"), [F.col("doc_id")]).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(out) == 16 and max(r.b for r in out) - min(r.b for r in out) <= 5000


def test_run_length_scheduling_equals_single_steps():
    g = random.Random(3)
    for _ in range(200):
        a, b = sharding.LeastLoaded(5), sharding.LeastLoaded(5)
        for _ in range(4):
            first = g.randrange(1, 400)
            assert a.put(first) == b.put(first)
        size, n = g.randrange(1, 50), g.randrange(0, 300)
        got, want = a.put_many(size, n), Counter(b.put(size) for _ in range(n))
        assert got == dict(want)


def test_no_shards_of_nothing(none):
    assert shard(none).collect() == []


# 2: suffix arrays


def repeats(rows):
    seen, out = {}, []
    rows = sorted({(i, (t or "").encode()) for i, t in rows})
    for i, b in rows:
        for p in range(len(b) - 49):
            seen.setdefault(b[p : p + 50], i)
    for i, b in rows:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone[:-1]])
        out.append((i, len(b), len(b) - len(kept), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_bytes_equal_brute_force(spark, docs):
    got = suffix.suffix_dedup(docs.withColumn("kept", F.lit(1)), results=("kept", "spans")).collect()
    assert len(got) == docs.count()
    assert sorted({tuple(r)[:5] for r in got}) == repeats([(r.doc_id, r.text) for r in docs.collect()])
    by = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        data = (by[r.doc_id] or "").encode()
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(b - a for a, b in r.spans) == r.n_removed == len(data) - len(r.kept)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_bytes_of_repetitive_texts(spark, seed):
    g = random.Random(seed)
    parts = ["a" * 60, "ab" * 40, "x" * 49, "q" * 50, prose(g, 8), prose(g, 9), prose(g, 20), "é" * 30]
    rows = [(g.randrange(12), "".join(g.choice(parts)[g.randrange(5) :] for _ in range(g.randrange(6)))) for _ in range(40)]
    rows += [(5, "one text " * 20), (5, "another text " * 20), (2, "another text " * 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted({tuple(r) for r in suffix.suffix_dedup(df, results=()).collect()}) == repeats(rows)


def test_repeats_without_ids_or_rows(spark, none):
    assert suffix.suffix_dedup(none).collect() == []
    df = spark.createDataFrame([(None, "z" * 80), (1, "z" * 80), (None, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in suffix.suffix_dedup(df).collect()) == [(False, 80, 0), (True, 0, 0), (True, 80, 0)]


def test_longest_previous_factors():
    g = np.random.default_rng(5)
    rows, owners = g.integers(97, 99, (60, 12)).astype(np.uint8), g.integers(0, 9, 60)
    common_ = lambda a, b: int((a != b).argmax()) if (a != b).any() else 12
    want = [max([common_(rows[i], rows[j]) for j in range(60) if owners[j] < owners[i]], default=0) for i in range(60)]
    assert suffix.longest_previous_factors(rows, owners).tolist() == want


# 3: mixing


def mix(docs, weights=(3, 1, 2), share=1.5, epochs=2.0):
    return mixing.water_fill_mix(docs, mixing.cyclic_weights(docs, weights), share, epochs, 17, mixing.n_words(F.col("text")), F.col("doc_id"))


def test_mix_comes_near_its_targets(spark):
    g = random.Random(6)
    rows = [(i, prose(g, g.randrange(1, 30)), "en", g.choice(["a"] * 10 + ["b", "c", None]), 0) for i in range(2000)]
    df = frame(spark, rows).withColumn("target", F.lit("clash"))
    out = mix(df).collect()
    assert len(out) == 2000 and sorted(map(tuple, out)) == sorted(map(tuple, mix(df).collect()))
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in size:
        assert target[s] <= 2 * size[s] + 1e-6 and abs(taken[s] - target[s]) <= 31
    # Water-filling: sources below their caps share by weight.
    free = [(s, w) for s, w in zip(["a", "b", "c", None], (3, 1, 2, 3)) if target[s] < 2 * size[s] - 1e-6]
    assert len({round(target[s] / w, 6) for s, w in free}) <= 1
    assert mixing.repeated(mix(df), ["doc_id"]).count() == sum(r.whole + r.extra for r in out)


def test_mix_of_edge_cases(spark, docs, none):
    assert mix(none).collect() == []
    assert mix(docs).count() == docs.count()
    everything = mix(docs, share=9.0).collect()
    assert all(r.taken == 2 * r.size for r in everything)
    empty = frame(spark, [(1, None, None, None, None), (2, " ", None, "a", 1), (3, "", None, "b", 0), (4, "some words", None, "b", 0)])
    out = {r.doc_id: (r.size, r.whole, r.extra, r.taken) for r in mix(empty, share=9.0).collect()}
    assert out == {1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (0, 1, 0, 0), 4: (2, 2, 0, 4)}
    # Rows without ids share a hash: what is taken doesn't depend on how they are dealt out.
    same = [(None, f"{'w ' * (1 + i % 3)}{i}", None, "a", i) for i in range(200)]
    taken = [sorted((r.text, r.taken) for r in mix(frame(spark, same).repartition(n), share=0.5).collect()) for n in (1, 5)]
    assert taken[0] == taken[1]


# 4: nearest neighbours


def brute_neighbours(rows, k=20):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    out = {}
    for q in sorted({i for i in ids if i % 20 == 0}):
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), s[j]) for j in order]
    return out


def vectors(n, seed=0):
    g = np.random.default_rng(seed)
    rows = [(i, g.normal(size=8).astype(np.float32).tolist()) for i in range(n)]
    rows[3] = (3, rows[40][1])
    rows[4] = (4, rows[40][1])
    return rows + [(1000, None), (1020, [0.0] * 8), (1040, [1.0, None] * 4), (1060, [float("nan")] * 8), (1080, [float("inf")] + [0.0] * 7), (1100, [1.0, 2.0]), (1120, []), (None, [1.0] * 8)]


def test_neighbours_of_a_small_table_are_exact(spark):
    rows = vectors(300)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash"))
    got = defaultdict(list)
    for r in ann.inverted_multi_index(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_neighbours(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_neighbours_are_found(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 700)
    g = np.random.default_rng(1)
    centres = g.normal(size=(30, 8))
    rows = [(i, (centres[g.integers(30)] + 0.3 * g.normal(size=8)).tolist() if i < 3200 else [1.0] * 8) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, hit, total = defaultdict(list), 0, 0
    for r in ann.inverted_multi_index(df).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    for q, want in brute_neighbours(rows).items():
        assert sorted(k for k, _ in got[q]) == list(range(1, 21))
        hit += len({i for _, i in got[q]} & {i for i, _ in want})
        total += 20
    assert hit / total >= 0.9


def test_neighbours_of_several_lengths_and_shared_ids(spark):
    g = np.random.default_rng(3)
    rows = [(i, g.normal(size=(2, 3, 5)[i % 3]).tolist()) for i in range(0, 300, 5)]
    rows += [(40, [1.0, 2.0, 3.0]), (40, [1.0, 2.0, 4.0]), (45, rows[9][1])]
    got = defaultdict(list)
    for r in ann.inverted_multi_index(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id))
    by = defaultdict(list)
    for i, v in rows:
        by[i].append(v)
    queries = {i: min((v for v in own if len(v) == min(map(len, own)))) for i, own in by.items() if i % 20 == 0}
    assert set(got) == set(queries) and {len(v) for v in queries.values()} == {2, 3, 5}
    for q, x in queries.items():
        near = sorted((-(np.array(v) * x).sum(), i) for i, v in rows if i != q and len(v) == len(x))
        assert [i for _, i in got[q]] == [i for _, i in near[:20]]


def test_neighbours_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (7, [2.0]), (8, [2.0])], "vec_id bigint, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.inverted_multi_index(df).orderBy("rank").collect()] == [(0, 1, 7, 2.0), (0, 2, 8, 2.0)]
    assert ann.inverted_multi_index(df.limit(0)).collect() == []


def test_traversal_is_by_summed_distance():
    g = np.random.default_rng(2)
    a, b, sizes = g.normal(size=9), g.normal(size=7), g.integers(0, 4, (9, 7))
    cells = ann.traverse(a, b, sizes, 10**9)
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sums == sorted(sums) and sorted(cells) == [int(i) for i in np.flatnonzero(sizes.reshape(-1))]


# 5: byte-level BPE

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    v = bpe.Vocabulary.load(PATH)
    return v, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


def test_ids_equal_the_library(spark, docs, library):
    out = bpe.bpe_encode(docs.withColumn("ids", F.lit(0)), PATH, P.PATTERN, ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert len(out) == docs.count()
    for r in out:
        want = library[1].encode_ordinary(r.text or "")
        assert r.ids == want and r.n_tokens == len(want) and bytes(r.decoded).decode() == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_ids_of_odd_texts(library):
    memo, split, _ = bpe.encoder(PATH, P.PATTERN)
    g = random.Random(8)
    for _ in range(3000):
        s = "".join(g.choice("abcdetions  \n\t'1!é中😀<|endoftext|>rlsv \x1c") for _ in range(g.randrange(60)))
        assert [int(i) for i in " ".join(map(memo.__getitem__, split(s))).split()] == library[1].encode_ordinary(s)
    for s in ("a" * 50_000, " " * 5_000 + "x", "thin" * 9_000):
        assert [int(i) for i in " ".join(map(memo.__getitem__, split(s))).split()] == library[1].encode_ordinary(s)


def test_appends_and_edits_are_exact(library):
    v, g = library[0], random.Random(9)
    for _ in range(500):
        data = bytes(g.choice(b"aeintho r") for _ in range(g.randrange(80)))
        t = bpe.PrefixTable(v, data[:20])
        t.append(data[20:])
        assert t.last == bpe.PrefixTable(v, data).last
        a = g.randrange(len(data) + 1)
        b = g.randrange(a, len(data) + 1)
        new = bytes(g.choice(b"aeint") for _ in range(g.randrange(8)))
        t.edit(a, b, new)
        assert t.data == data[:a] + new + data[b:] and t.last == bpe.PrefixTable(v, t.data).last and v.decode(t.ids()) == t.data
    t = bpe.PrefixTable(v, b"thin" * 3000)
    steps = t.steps
    t.edit(100, 103, b"x")
    assert t.steps - steps < 500 and t.ids() == bpe.PrefixTable(v, t.data).ids()


# 6: URL filters

RULES = "host string, path string, verdict string"


def test_url_rules_and_aliases(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.bad.com/x?q#f", None),
            (2, "https://Other.ORG/page", '<link rel="canonical" href="http://a.bad.com/x?q">'),
            (3, "https://third.org/", '<meta http-equiv="refresh" content="0; url=https://other.org/page">'),
            (4, "https://good.org/", '<link href="https://third.org/" rel=canonical>'),
            (5, "https://alone.org/#top", "<p>canonical</p>"),
            (6, None, None),
            (7, "no scheme", "refresh"),
            (8, "http://bad.com", None),
            (9, "http://xbad.com/x", None),
            (9, "http://xbad.com/x", None),
        ],
        "page_id bigint, url string, html string",
    ).withColumn("verdict", F.lit("clash"))
    rules = spark.createDataFrame([("bad.com", "/", "block"), ("good.org", "/", "allow"), ("com", "/zz", "block")], RULES)
    # An empty path is the usual variant of /.
    assert [r.verdict for r in urls.url_verdicts(pages, rules).where("page_id = 8").collect()] == ["block"]
    out = {r.page_id: r for r in urls.url_verdicts(pages, rules, variants=False).collect()}
    assert {k: r.verdict for k, r in out.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow"}
    assert (out[1].host, out[1].path, out[1].rule) == ("a.bad.com", "/x", "bad.com/") and (out[8].host, out[8].path, out[8].rule) == ("bad.com", "", None)
    assert (out[6].host, out[6].path) == ("", "") == (out[7].host, out[7].path) and out[2].host == "other.org"
    assert urls.url_verdicts(pages, rules).count() == 10 and urls.url_verdicts(pages.limit(0), rules).count() == 0
    assert urls.url_verdicts(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_the_longest_rule_wins(spark):
    pages = spark.createDataFrame([(1, "http://www.example.com/en/1"), (2, "http://m.example.com/en/1"), (3, "http://example.com/enx"), (4, "http://a.net/fr/")], "page_id bigint, url string")
    rules = spark.createDataFrame(urls.RULES, RULES)
    got = {r.page_id: (r.rule, r.verdict) for r in urls.url_verdicts(pages, rules).collect()}
    assert got == {1: ("www.example.com/en/", "allow"), 2: ("example.com/en/", "block"), 3: ("com/", "allow"), 4: ("net/fr/", "block")}


def test_links_in_all_usual_forms_make_aliases(spark):
    link = '<link rel="canonical" href="{}">'.format
    pages = spark.createDataFrame(
        [
            (1, "https://good.org/a/1", link("/bad/x")),
            (2, "https://good.org/a/2", link("../bad/x")),
            (3, "http://good.org/3", link("//evil.org/x")),
            (4, "https://good.org/4", '<meta http-equiv="refresh" content="0; url=/bad/y">'),
            (5, "https://good.org/5", link("https://fine.org/") + link("http://evil.org/x")),
            (6, "https://good.org/6", '<meta http-equiv=refresh content="0;url=/5"><meta http-equiv=refresh content="0;url=/bad/y">'),
            (7, "https://good.org/7", link("https://evil.org/q?a=1&amp;b=2&#38;copy=3")),
            (8, "https://evil.org/q?a=1&b=2&copy=3", None),
            (9, "https://good.org/9", '<base href="/bad/">' + link("z")),
            (10, "https://good.org/10", link("mailto:a@evil.org") + link("http://[") + link("/10")),
            (11, None, link("/bad/x")),
            (12, "https://good.org/12", '<meta http-equiv="refresh" content="600; url=/bad/y">'),
            (13, "https://good.org/13", "<p>" + "x" * 300_000 + "</p>" + link("/bad/" + "y" * 50_000)),
        ],
        "page_id bigint, url string, html string",
    )
    rules = spark.createDataFrame([("evil.org", "/", "block"), ("good.org", "/bad/", "block")], RULES)
    got = {r.page_id: r.verdict for r in urls.url_verdicts(pages, rules).collect()}
    assert got == {i: "allow" if 9 < i < 13 else "block" for i in range(1, 14)}
    targets = {(r.url, r.target) for r in urls.html_links(pages).collect()}
    assert ("https://good.org/7", "https://evil.org/q?a=1&b=2&copy=3") in targets and ("http://good.org/3", "http://evil.org/x") in targets


def test_variants_of_an_address_are_aliases(spark):
    pages = spark.createDataFrame([(1, "http://www.a.org/es?utm_source=x&q=1#top"), (2, "https://a.org:443/es/?q=1"), (3, "https://a.org/es/?q=2"), (4, "ftp://a.org/es/"), (5, "http://www.com/es"), (6, "HTTP://A.org/es?q=1&GCLID=7"), (7, "https://m.a.org/es?q=1"), (8, "http://b.org")], "page_id bigint, url string")
    form = {r.page_id: r.f for r in pages.select("page_id", urls.usual_form(F.col("url")).alias("f")).collect()}
    assert form == {1: "https://a.org/es?q=1", 2: "https://a.org/es?q=1", 3: "https://a.org/es?q=2", 4: None, 5: "https://www.com/es", 6: "https://a.org/es?q=1", 7: "https://m.a.org/es?q=1", 8: "https://b.org/"}
    rules = spark.createDataFrame([("org:443", "/es/", "block")], RULES)
    assert {r.page_id for r in urls.url_verdicts(pages, rules).where("verdict = 'block'").collect()} == {1, 2, 6}
    assert {r.page_id for r in urls.url_verdicts(pages, rules, variants=False).where("verdict = 'block'").collect()} == {2}


# 7: language


def test_languages_of_the_test_table(spark):
    common.ship(spark)
    table = common.table(spark, SF, "documents")
    out = language.identify(table, declared="lang", host="source").collect()
    assert len(out) == table.count()
    assert np.mean([r.language == r.lang for r in out if r.text]) > 0.97 and np.mean([r.kept for r in out]) > 0.97
    # Without a declaration the text and the host decide.
    some = table.withColumn("d", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    assert np.mean([r.language == r.lang for r in language.identify(some, declared="d", host="source").collect()]) > 0.9


def test_evidence_is_fused_as_stated(spark):
    table = common.table(spark, SF, "documents")
    langs, model = language.fit_text_model(table, "lang", "text")
    out = language.text_likelihoods(table.select("text"), "text", langs, model).collect()
    for r in out[:40]:
        data = np.frombuffer(r.text.encode(), dtype=np.uint8)
        cells = [(int(language._LOWER[a]) << 16 | int(language._LOWER[b]) << 8 | int(language._LOWER[c])) * 0x9E3779B1 % 2**32 >> 16 for a, b, c in zip(data, data[1:], data[2:])]
        assert np.allclose(r._af_ll, sum((model[c].astype(float) for c in cells), np.zeros(len(langs))) * language.TEMPER, rtol=1e-4, atol=1e-3)
    assert np.allclose(np.exp(model.astype(float)).sum(axis=0), 1, atol=1e-3)


def test_the_posterior_equals_bayes_by_hand(spark):
    """All kinds of evidence against the formula, from counts in dictionaries."""
    common.ship(spark)
    g = random.Random(21)
    other = lambda n: " ".join("".join(g.choice("xyzqjkw") for _ in range(5)) for _ in range(n))
    rows = []
    for i in range(120):
        en = g.random() < 0.6
        rows.append((i, prose(g, 6) if en else other(6), g.choice(["en", "EN-us", None, "not a code"] if en else ["xx", "xx_YY", None]), f"h{i % 5}", f"d{i % 2}", "en" if en and i % 3 else "org"))
    rows += [(900, None, "en", "h0", "d0", "en"), (901, "12345", "en", "new", None, None), (902, "", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, l string, h string, d string, s string")
    how = {"declared": "l", "host": "h", "domain": "d", "suffix": "s"}
    known = language.Evidence(df, **how)
    langs = known.langs
    assert langs == ["en", "xx", language.UNKNOWN]
    ll = {r.doc_id: (list(map(float, r._af_ll)), r._af_best) for r in known.scored(df, ["doc_id"]).collect()}
    code = lambda v: {"en": "en", "EN-us": "en", "xx": "xx", "xx_YY": "xx"}.get(v)
    counts = [Counter((key(r), ll[r[0]][1]) for r in rows) for key in (lambda r: code(r[2]), lambda r: r[5], lambda r: r[4], lambda r: r[3])]
    total = Counter(best for _, best in ll.values())
    out = {r.doc_id: r for r in language.identify(df, carry=["doc_id"], **how).collect()}
    for r in rows:
        log = []
        for j, lang in enumerate(langs):
            x = ll[r[0]][0][j]
            for table, value in ((counts[0], code(r[2])), (counts[1], r[5])):
                values = len({v for v, _ in table}) + 1
                x += math.log((table[value, lang] + 0.5) / (total[lang] + 0.5 * values))
            log.append(x)
        prior = [language.UNKNOWN_PRIOR if lang == language.UNKNOWN else max(total[lang], 1) / len(rows) for lang in langs]
        for table, value in ((counts[2], r[4]), (counts[3], r[3])):
            mass = [table[value, lang] + p * language.STRENGTH for lang, p in zip(langs, prior)]
            prior = [m / sum(mass) for m in mass]
        log = [x + math.log(p) for x, p in zip(log, prior)]
        top = max(log)
        got = out[r[0]]
        assert got.posterior == pytest.approx(1 / sum(math.exp(x - top) for x in log), rel=1e-4)
        want = langs[log.index(top)] if any(c.isalpha() for c in r[1] or "") else language.UNKNOWN
        assert got.language == want and got.kept == (want != language.UNKNOWN and got.posterior >= language.LEAST)


def test_language_of_edge_cases(spark, docs, none):
    out = language.identify(docs.withColumn("kept", F.lit(1)), declared="lang", host="source").collect()
    assert len(out) == docs.count()
    assert all(not r.kept and r.language == language.UNKNOWN for r in out if not (r.text or "").strip())
    assert language.identify(none, declared="lang", host="source").collect() == []
    assert {r.language for r in language.identify(docs).collect()} == {language.UNKNOWN}


def test_pages(spark):
    common.ship(spark)
    pages = common.table(spark, SF, "pages").unionByName(spark.createDataFrame([(-1, None, None)], "page_id bigint, url string, html string"))
    out = {r.page_id: r for r in language.identify_pages(pages).collect()}
    lang = {r.page_id: re.search(r'lang="(\w+)"', r.html or "") for r in pages.collect()}
    assert len(out) == pages.count() and np.mean([out[i].language == m[1] for i, m in lang.items() if m]) > 0.9 and not out[-1].kept


def test_rare_declared_languages_stay(spark):
    g = random.Random(5)
    rare = ["".join(g.choice("абвгдежзиклмнопрст ") for _ in range(300)) for _ in range(2)]
    rows = [(i, prose(g, 12), "en", "a", 0) for i in range(2500)] + [(9000 + i, t, "ru", "b", 0) for i, t in enumerate(rare)]
    out = {r.doc_id: r for r in language.identify(frame(spark, rows), declared="lang", host="source").collect()}
    assert [(out[i].language, out[i].kept) for i in (9000, 9001)] == [("ru", True)] * 2
    assert np.mean([r.language == "en" for i, r in out.items() if i < 9000]) > 0.99


def test_copies_count_once_in_the_text_model(spark, monkeypatch):
    g = random.Random(6)
    texts = [prose(g, 12) for _ in range(80)]
    once, copied = (frame(spark, [(i, t, "en", "a", 0) for i, t in enumerate(rows)]) for rows in (texts, texts + texts[:1] * 300))
    (langs, a), (_, b) = (language.fit_text_model(d, "lang", "text") for d in (once, copied))
    assert langs == ["en", language.UNKNOWN] and np.array_equal(a, b)
    monkeypatch.setattr(language, "FIT", 20)
    sample, _ = language.fit_sample(copied, "lang", "text")
    assert sample.count() == sample.distinct().count() == 20


def test_the_language_query_covers_documents_and_pages(spark):
    out = QUERIES["op7_fused_language_id"](spark, SF)
    docs, pages = common.table(spark, SF, "documents"), common.table(spark, SF, "pages")
    assert sorted(r.doc_id for r in out.where("page_id is null").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    got = sorted((r.page_id, r.language, r.kept) for r in out.where("doc_id is null").collect())
    assert got == sorted((r.page_id, r.language, r.kept) for r in language.identify_pages(pages).collect()) and len(got) == pages.count()


# 8: exact dedup


def test_content_sort_equals_brute_force(spark, docs):
    out = exact.content_sort(docs.withColumn("kept", F.lit("clash"))).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    assert len(out) == docs.count() and sum(r.kept for r in out) == len(groups)
    for r in out:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        assert (r.keep_id, r.group_size, r.text_sha256) == (min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) and (not r.kept or r.doc_id == r.keep_id)


def test_a_text_of_many_copies_spreads_over_ranges(spark):
    rows = spark.range(4000).select((F.col("id") * 7 % 4000).alias("doc_id"), F.when(F.col("id") % 3 > 0, "one hot  text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact.content_sort(rows).where("text = 'one hot  text'").agg(F.count_if("kept"), F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count(F.lit(1))).first()
    low = rows.where("text = 'one hot  text'").agg(F.min("doc_id")).first()[0]
    assert tuple(out) == (1, low, low, out[4], out[4])


def test_exact_dedup_keeps_columns(spark, docs, none):
    assert exact.exact_dedup(none).collect() == []
    assert exact.exact_dedup(docs).columns == docs.columns
    df = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b"), (None, "b")], "doc_id bigint, text string")
    assert sorted(map(str, exact.exact_dedup(df).collect())) == sorted(["Row(doc_id=3, text='a')", "Row(doc_id=None, text='b')"])


# 9: quality


def test_kneser_ney_is_a_distribution_and_equals_the_formula(spark):
    common.ship(spark)
    texts = [prose(random.Random(i), 12) for i in range(30)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = quality.Shard.of(quality.fit(df, "text").toPandas())
    for h in (b"than", b"zzzz", b"\0\0\0\0", b"ther"):
        g = np.array([int.from_bytes(h + bytes([w]), "big") for w in range(256)], dtype=np.uint64)
        assert np.exp(model.log_probabilities(g)).sum() == pytest.approx(1, abs=1e-5)
    counts = [None, *(Counter() for _ in range(5))]
    for t in texts:
        data = b"\0\0\0\0" + t.encode()
        counts[5].update(data[i : i + 5] for i in range(len(data) - 4))
    for k in (4, 3, 2, 1):
        counts[k].update(gram[1:] for gram in counts[k + 1])

    def discount(k, n):
        t = [sum(v == i for v in counts[k].values()) for i in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] and t[1] else 0.5
        i = min(n, 3)
        return min(i, max(0.05, i - (i + 1) * y * t[i] / t[i - 1])) if t[i - 1] else 0.5 * i

    def p(gram):
        if not gram:
            return 1 / 256
        k = len(gram)
        after = {g: n for g, n in counts[k].items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total = sum(after.values())
        own = after.get(gram, 0)
        return ((own - discount(k, own)) / total if own else 0) + sum(discount(k, n) for n in after.values()) / total * p(gram[1:])

    g = random.Random(1)
    for gram in g.sample(sorted(counts[5]), 40) + [b"thxzz", b"zzzzz", b"\0\0\0\0t", b"t the"]:
        got = model.log_probabilities(np.array([int.from_bytes(gram, "big")], dtype=np.uint64))[0]
        assert got == pytest.approx(math.log(p(gram)), rel=1e-4)


def test_quality_tells_held_out_junk_from_prose(spark):
    table, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    out = quality.kneser_ney_quality(table, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.kept for r in out if r.quality == q and not (q and r.toxic)] for q in (1, 0))
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_perplexity_quantiles_and_verdicts_equal_brute_force(spark, monkeypatch):
    common.ship(spark)
    docs, labels = (common.table(spark, SF, t) for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()] + [(-1, None, "en"), (-2, "", "de"), (-3, "zz", None), (-4, prose(random.Random(1), 9000), "xx"), (3, docs.where("doc_id = 3").first().text, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5).withColumn("threshold", F.lit("clash"))
    for name, value in (("RUN", 20_000), ("GROUP", 2_000), ("SHARD_ROWS", 2_000)):  # many runs, groups and shards
        monkeypatch.setattr(quality, name, value)
    out = quality.kneser_ney_quality(df, labels, carry=["doc_id", "lang"]).collect()
    assert len(out) == len(rows)
    good = {r.doc_id for r in labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0").collect()}
    fold = {r.doc_id for r in df.select("doc_id").distinct().where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(quality.FOLDS)) == 0).collect()}
    # Counts in a dictionary, byte by byte.
    trusted = [t.encode() for i, t, _ in rows if t and i in good & fold]
    model = quality.Shard.of(quality.fit(spark.createDataFrame([(t.decode(),) for t in trusted], "text string"), "text").toPandas())
    known = {}

    def perplexity(text):
        data, bits = b"\0\0\0\0" + text.encode(), 0.0
        for i in range(len(data) - 4):
            gram = data[i : i + 5]
            if gram not in known:
                known[gram] = float(model.log_probabilities(np.array([int.from_bytes(gram, "big")], dtype=np.uint64))[0])
            bits -= known[gram]
        return math.exp(bits / (len(data) - 4))

    want = {(i, lang): perplexity(t) if t else None for i, t, lang in rows}
    tested = [(lang, len(t.encode()), math.log(want[i, lang])) for i, t, lang in rows if t and i in good - fold]
    average = lambda some: sum(n * e for _, n, e in some) / sum(n for _, n, _ in some)
    mean = {lang: average([x for x in tested if x[0] == lang]) for lang in {x[0] for x in tested}}
    counted = [(lang, (n * e + quality.PRIOR * mean[lang]) / (n + quality.PRIOR)) for lang, n, e in tested]
    at = lambda values: sorted(values)[math.ceil(quality.QUANTILE * len(values)) - 1]
    limit = {lang: (at([c for x, c in counted if x == lang]), mean[lang]) for lang in mean} | {"all": (at([c for _, c in counted]), average(tested))}
    assert len(limit) > 2
    by = {(i, lang): len((t or "").encode()) for i, t, lang in rows}
    for r in out:
        p, n = want[r.doc_id, r.lang], by[r.doc_id, r.lang]
        if not n:
            assert (r.perplexity, r.threshold, r.kept) == (None, None, True)
            continue
        most, middle = limit.get(r.lang, limit["all"])
        assert r.perplexity == pytest.approx(p, rel=1e-5) and r.threshold == pytest.approx(math.exp(most + (most - middle) * quality.PRIOR / n), rel=1e-4)
        assert r.kept == (r.perplexity <= r.threshold)


def test_quality_counts_grow_with_the_trusted_documents(spark, monkeypatch):
    many = spark.range(50_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "1 AS quality", "0 AS toxic")
    counted, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda trusted, text: counted.append(trusted.count()) or fit(trusted, text))
    quality.kneser_ney_quality(many.select("doc_id", "text", "lang"), many.select("doc_id", "quality", "toxic"))
    assert 24_000 < counted[0] < 26_000


def test_quality_of_edge_cases(spark, docs, none):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(3, 1, 0), (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    out = quality.kneser_ney_quality(docs.withColumn("threshold", F.lit("clash")), labels).collect()
    assert len(out) == docs.count() and all(r.kept for r in out if not r.text)
    assert quality.kneser_ney_quality(none, labels).collect() == []
    assert all(r.kept and r.threshold is None for r in quality.kneser_ney_quality(docs, labels.limit(0)).collect())


# 10: near-duplicates


def near_truth(rows, similar=0.8):
    sets, df = {}, Counter()
    for i, t in rows:
        words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in re.split(rb"[ \t-\r]+", (t or "").encode()) if w]
        sets.setdefault(i, Counter()).update(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else None
    for s in sets.values():
        df.update(s.keys())
    idf = {k: float(near.idf(np.array([v]), len(rows))[0]) for k, v in df.items()}
    total = {i: sum(n * idf[k] for k, n in s.items()) for i, s in sets.items()}
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b:
                both = sum(min(n, sets[b][k]) * idf[k] for k, n in sets[a].items() if k in sets[b])
                if both / (total[a] + total[b] - both) >= similar:
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: find(i) for i, _ in rows}


def edited(g, text, n):
    words = text.split()
    for _ in range(n):
        words[g.randrange(len(words))] = "edit%d" % g.randrange(10**6)
    return " ".join(words)


def test_near_classes_equal_brute_force(spark):
    common.ship(spark)
    g = random.Random(11)
    base = [prose(g, 150) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for t in base[:8]:
        rows += [(len(rows) + k, edited(g, t, g.choice([0, 1, 2, 3, 9]))) for k in range(6)]
    # A chain: each is near the next, the ends are not.
    chain = base[8]
    for k in range(8):
        chain = edited(g, chain, 3)
        rows.append((len(rows), chain))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "two words"), (len(rows) + 3, "TWO  words"), (len(rows) + 4, prose(g, 20000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit("clash")).repartition(4)
    out = near.near_dedup(df).collect()
    assert {r.doc_id: r.class_id for r in out} == near_truth(rows) and all(r.kept == (r.doc_id == r.class_id) for r in out) and len(out) == len(rows)
    kept = near.near_filter(df).collect()
    assert {r.doc_id for r in kept} == set(near_truth(rows).values())


def test_near_dedup_of_edge_cases(spark, docs, none):
    assert near.near_dedup(none).collect() == []
    assert near.near_dedup(docs).count() == docs.count()
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.class_id, r.kept) for r in near.near_dedup(df).collect()) == [(0, 1, False), (1, 1, True), (2, 1, False)]
    # Rows without an id, or with another's, are told apart by their texts; equal rows share their fate.
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    rows = [(None, long), (None, long + " x"), (7, long + " y"), (7, "quite another text of seven words"), (7, "quite another text of seven words"), (9, long + " y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = sorted(((r.doc_id or 0, r.text, r.class_id, r.kept) for r in near.near_dedup(df).collect()), key=str)
    assert out == sorted([(0, long, 7, False), (0, long + " x", 7, False), (7, long + " y", 7, True), *[(7, rows[3][1], 7, True)] * 2, (9, long + " y", 7, False)], key=str)
    assert sorted((r.doc_id, r.text) for r in near.near_filter(df).collect()) == sorted([rows[2], rows[3], rows[4]])


def test_samples_collide_with_the_chance_of_the_weighted_similarity():
    g = np.random.default_rng(12)
    hits = []
    for _ in range(60):
        h = g.integers(0, 1 << 62, 60, dtype=np.uint64)
        a, b = g.uniform(0.5, 3, 60), g.uniform(0.5, 3, 60)
        s = near.samples(np.concatenate([h, h]), np.concatenate([a, b]), np.array([0, 60]))
        hits.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(hits)) < 0.03


def test_crc32_is_unsigned(spark):
    df = spark.createDataFrame([("é",)], "t string")
    assert df.select(F.crc32(F.col("t").cast("binary"))).first()[0] == zlib.crc32("é".encode())


def test_crowds_are_compared_in_blocks(spark, monkeypatch):
    common.ship(spark)
    monkeypatch.setattr(near, "CROWD", 4)
    monkeypatch.setattr(near, "BLOCK", 7)
    g = random.Random(13)
    base = prose(g, 120) + " again and again and again and again and again and again"
    rows = [(i, edited(g, base, g.choice([1, 2, 3, 4, 5]))) for i in range(60)]
    chain = base
    for _ in range(20):
        chain = edited(g, chain, 2)
        rows.append((len(rows), chain))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.class_id for r in near.near_dedup(df).collect()}
    want = near_truth(rows)
    assert sum(out[i] != want[i] for i in out) <= 1  # a pair at the edge may share no band
    # The size of a bucket changes how its documents are compared, not what is found.
    for crowd, block in ((63, 40), (1000, 512)):
        monkeypatch.setattr(near, "CROWD", crowd)
        monkeypatch.setattr(near, "BLOCK", block)
        assert {r.doc_id: r.class_id for r in near.near_dedup(df).collect()} == out


def test_a_first_document_apart_from_a_crowd_does_not_split_it(spark, monkeypatch):
    common.ship(spark)
    monkeypatch.setattr(near, "BLOCK", 50)
    g = random.Random(17)
    base = prose(g, 150)
    # The smallest id is too far from all others, which are near each other; and many exact copies.
    rows = [(0, edited(g, base, 7))] + [(i, edited(g, base, g.choice([0, 1, 1, 1]))) for i in range(1, 200)]
    rows += [(1000 + i, rows[3][1]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert {r.doc_id: r.class_id for r in near.near_dedup(df).collect()} == near_truth(rows)
