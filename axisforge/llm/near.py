"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.llm.blobs import groups, in_chunks, joined, lean_memory, mix, pack, part_keys, part_of, repeated, runs, starts, steps, unpack, word_hashes
from axisforge.llm.common import components, discard, partitions, row_key, text_bytes, without, written

#: Words in a shingle, and the least similarity of near-duplicates.
WORDS, SIMILAR = 5, 0.8
#: Samples of a document: BANDS bands of ROWS; a pair of similarity s shares no band with the chance (1 - s**ROWS)**BANDS: 0.0002 at 0.8.
BANDS, ROWS = 16, 4
#: Shingles are known by hashes of this many bits.
BITS = 56
#: Members of one representative that are verified in one block.
MEMBERS = 512
#: Documents of the largest bucket of which those in different classes are compared in pairs, and of a block of larger ones.
#: Both find the same links; blocks take less to move where many documents meet.
CROWD, BLOCK = 64, 512
#: Parts of a bucket, which learn its smallest document each for itself.
SALTS = 64
#: Bytes of text in a part, of whose shingles a task holds one at a time.
PART = 32 << 20

_RANDOM = np.random.default_rng(7)
_SEEDS = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_RATE = _RANDOM.gamma(2.0, 1.0, 1 << 16)
_LOG_START = np.log(_RANDOM.gamma(2.0, 1.0, 1 << 16))


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, occurrences) of the distinct shingles of each text, by number and hash.

    A text of fewer words has one shingle of them all; one without words has none.
    """
    out = []
    for lo, hi in in_chunks(texts):
        data, begin = joined(texts[lo:hi])
        at, words_ = word_hashes(data)
        doc = np.searchsorted(begin, at, side="right") - 1
        n = np.bincount(doc, minlength=hi - lo)
        first = np.cumsum(n) - n
        short = np.flatnonzero((n > 0) & (n < words))
        m = max(0, len(words_) - words + 1)
        whole = doc[:m] == doc[words - 1 :] if m else np.zeros(0, dtype=bool)
        sums = np.zeros(m, dtype=np.uint64)
        for k in range(words):
            sums = sums * np.uint64(0xD1342543DE82EF95) + words_[k : k + m]
        h, d = sums[whole], doc[:m][whole]
        if len(short):
            few = [np.uint64(n[s]) for s in short]
            for j, s in enumerate(short):
                for w in words_[first[s] : first[s] + n[s]]:
                    few[j] = np.uint64((int(few[j]) * 0xD1342543DE82EF95 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            h, d = np.concatenate([h, np.array(few, dtype=np.uint64)]), np.concatenate([d, short])
        h = mix(h) >> np.uint64(64 - BITS)
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        at = np.flatnonzero(starts(d, h))
        out.append(((d[at] + lo).astype(np.int32), h[at], np.diff(np.append(at, len(h))).astype(np.uint32)))
    if not out:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def idf(df: np.ndarray, total: int) -> np.ndarray:
    """From 1 for a shingle of one document down to a half: copies of a text count it in large groups too."""
    return 0.5 + 0.5 * np.log((1.0 + total) / (1.0 + df)) / max(1e-9, math.log((1.0 + total) / 2.0))


def samples(h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Improved consistent weighted samples [document, sample] of weighted sets that start at `first`, as hashes.

    For each element and sample, a rate r and a start c are Gamma(2, 1) and b is uniform,
    all from a hash of the element. With t = floor(ln(weight) / r + b) the element with the
    least ln(c) - r (t - b + 1) is the sample, with its t. Two sets have equal samples with
    the chance of their weighted Jaccard similarity (Ioffe, 2010).
    """
    n = np.diff(np.append(first, len(h)))
    log_weight = np.log(weight)
    out = np.empty((len(first), len(_SEEDS)), dtype=np.uint64)
    lo = 0
    while lo < len(first):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(n[lo:]), 1 << 15)))
        a, b = first[lo], first[hi - 1] + n[hi - 1]
        own, lw, cuts, of = h[a:b], log_weight[a:b], first[lo:hi] - a, np.repeat(np.arange(hi - lo), n[lo:hi])
        for k, seed in enumerate(_SEEDS):
            x = mix(own ^ seed)
            rate = _RATE[(x & np.uint64(0xFFFF)).astype(np.int64)]
            start = _LOG_START[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
            uniform = (x >> np.uint64(32)) * (0.5**32)
            t = np.floor(lw / rate + uniform)
            value = start - rate * (t - uniform + 1.0)
            least = np.minimum.reduceat(value, cuts)
            hit = np.flatnonzero(value == least[of])
            docs, at = np.unique(of[hit], return_index=True)
            hit = hit[at]
            out[lo:hi, k] = mix(own[hit] ^ mix(t[hit].astype(np.int64).view(np.uint64) ^ seed))
        lo = hi
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signatures), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        x = np.full(len(signatures), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            x = mix(x * np.uint64(0xD1342543DE82EF95) + signatures[:, b * ROWS + r])
        keys[:, b] = x
    return keys.view(np.int64)


def weighted_sets(docs: DataFrame, doc_id: str, text: str, similar: float) -> DataFrame:
    """(doc_id, total, shared, bands) of the documents that can have a near-duplicate.

    The document frequencies of shingles cover all documents: shingles meet by ranges of
    their hash, packed. A shingle of one document is never in an intersection, so only those
    of two or more go back to their documents; for the others their number and weight do.
    A document of which the shared shingles have less than `similar` of the weight has no
    near-duplicate, and no samples. total is the whole weight; shared packs hashes,
    occurrences and document frequencies; bands are the keys of the bands.
    """
    spark = docs.sparkSession
    parts = partitions(spark, text_bytes(docs, text), PART)
    to = np.array(part_keys(parts))
    total_docs = docs.count()
    bounds = np.array([-(-(b << BITS) // parts) for b in range(1, parts)], dtype=np.uint64)
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])

    def emit(batches):
        lean_memory()
        for (ids,), texts in runs(batches):
            doc, h, n = shingles(texts)
            rows = []
            sums = np.bincount(doc, weights=n, minlength=len(ids)).astype(np.uint64)
            distinct = np.bincount(doc, minlength=len(ids)).astype(np.uint64)
            some = np.flatnonzero(distinct)
            for part, at in groups(part_of(ids[some], parts)):
                at = some[at]
                rows.append((int(to[part]), 1, pack(ids[at], distinct[at], sums[at])))
            order = np.argsort(h, kind="stable")
            h, doc, n = h[order], doc[order].astype(np.uint32 if len(ids) > 65535 else np.uint16), n[order]
            cuts = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:
                    many = np.flatnonzero(n[a:b] > 1).astype(np.uint32)
                    own, local = np.unique(doc[a:b], return_inverse=True)
                    rows.append((int(to[part]), 0, pack(ids[own], steps(h[a:b]), local.astype(doc.dtype), many, n[a:b][many])))
            c = zip(*rows, strict=True)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(c, schema, strict=True)], schema=schema)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        kinds = pdf["kind"].to_numpy()
        out = [(int(pdf["part"].iloc[0]), 1, b) for b in pdf["blob"][kinds == 1]]
        blobs = list(pdf["blob"][kinds == 0])
        if blobs:
            # Most shingles occur in one document: the other columns are unpacked for the rest.
            hs = [np.cumsum(unpack(b, (1,))[0]) for b in blobs]
            cols = []
            for i, keep in enumerate(repeated(hs)):
                ids, doc, many, occurs = unpack(blobs[i], (0, 2, 3, 4))
                n = np.ones(len(doc), dtype=np.uint32)
                n[many] = occurs
                cols.append((hs[i][keep], ids[doc[keep]], n[keep]))
                hs[i] = None
            h, d, n = map(np.concatenate, zip(*cols, strict=True))
            order = np.argsort(h, kind="stable")
            h, d, n = h[order], d[order], n[order]
            df = np.diff(np.append(np.flatnonzero(starts(h)), len(h))).astype(np.uint32)
            df = np.repeat(df, df)
            for part, rows in groups(part_of(d, parts)):
                rows = rows[np.argsort(d[rows], kind="stable")]
                own, local = np.unique(d[rows], return_inverse=True)
                out.append((int(to[part]), 0, pack(own, local.astype(np.uint32), h[rows], n[rows], df[rows])))
        return pd.DataFrame(out, columns=["part", "kind", "blob"])

    def sign(pdf: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        kinds = pdf["kind"].to_numpy()
        totals = [unpack(b) for b in pdf["blob"][kinds == 1]]
        cols = [(own[local], h, n, df) for own, local, h, n, df in map(unpack, pdf["blob"][kinds == 0])]
        empty = pd.DataFrame({"doc_id": [], "total": [], "shared": [], "bands": []}, dtype=object)
        if not cols:
            return empty
        d, h, n, df = map(np.concatenate, zip(*cols, strict=True))
        ids, distinct, sums = map(np.concatenate, zip(*totals, strict=True))
        order = np.lexsort((h, d))
        d, h, n, df = d[order], h[order], n[order], df[order]
        # Rows that share a key are one document.
        ids, at = np.unique(ids, return_inverse=True)
        distinct, sums = np.bincount(at, weights=distinct), np.bincount(at, weights=sums)
        weight = n * idf(df, total_docs)
        docs_, first, count_ = np.unique(d, return_index=True, return_counts=True)
        spot = np.searchsorted(ids, docs_)
        shared = np.add.reduceat(weight, first)
        single = np.maximum(distinct[spot] - count_, 0.0)
        occurs = np.maximum(sums[spot] - np.add.reduceat(n.astype(np.float64), first), 0.0)
        alone = occurs * idf(np.ones(1), total_docs)[0]
        total = shared + alone
        chosen = np.flatnonzero(shared >= similar * total * (1 - 1e-9))
        out = []
        for lo in range(0, len(chosen), 256):
            own = chosen[lo : lo + 256]
            # The shingles of one document alone count with any hash that no other document has.
            sizes = count_[own] + single[own].astype(np.int64)
            begin = np.cumsum(sizes) - sizes
            hs, ws = np.empty(sizes.sum(), dtype=np.uint64), np.empty(sizes.sum())
            for j, i in enumerate(own):
                a, m, s = begin[j], count_[i], int(single[i])
                hs[a : a + m], ws[a : a + m] = h[first[i] : first[i] + m], weight[first[i] : first[i] + m]
                if s:
                    hs[a + m : a + m + s] = mix(np.arange(s, dtype=np.uint64) + mix(docs_[i : i + 1].view(np.uint64))) | np.uint64(1 << 63)
                    ws[a + m : a + m + s] = alone[i] / s
            keys = band_keys(samples(hs, ws, begin))
            for j, i in enumerate(own):
                a, m = first[i], count_[i]
                out.append((docs_[i], total[i], pack(steps(h[a : a + m]), n[a : a + m], df[a : a + m]), keys[j].tolist()))
        return pd.DataFrame(out, columns=empty.columns) if out else empty

    slim = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))
    rows = "part int, kind int, blob binary"
    back = slim.mapInArrow(emit, rows).repartition(parts, "part").groupBy("part").applyInPandas(count, rows)
    return back.repartition(parts, "part").groupBy("part").applyInPandas(sign, "doc_id bigint, total double, shared binary, bands array<bigint>")


def similarities(pairs: DataFrame, sets: DataFrame, total_docs: int) -> DataFrame:
    """(a, b, similarity) of distinct pairs (a, b): the weighted Jaccard similarity of their sets.

    Pairs are dealt out by a; an `a` with many partners is copied to several blocks.
    """
    blocks = partitions(pairs.sparkSession)
    busy = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(MEMBERS)).cast("int").alias("copies"))
    block = lambda a, part: F.pmod(F.xxhash64(a, part), F.lit(blocks)).cast("int")
    slim = sets.select("doc_id", "total", "shared")
    left = busy.join(slim, busy.a == slim.doc_id).select("a", F.col("total").alias("ta"), F.col("shared").alias("sa"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"))
    left = left.select(block(F.col("a"), F.col("part")).alias("block_a"), F.col("a").alias("head"), "ta", "sa").dropDuplicates(["block_a", "head"])
    right = pairs.join(busy, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("part"))
    right = right.join(slim, right.b == slim.doc_id).select(block(F.col("a"), F.col("part")).alias("block_b"), "a", "b", F.col("total").alias("tb"), F.col("shared").alias("sb"))

    def weigh(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sets_ = {a: (t, s) for a, t, s in zip(left["head"], left["ta"], left["sa"], strict=True)}
        out, now = [], None
        right = right.sort_values("a", kind="stable")
        for a, b, tb, sb in zip(right["a"], right["b"], right["tb"], right["sb"], strict=True):
            if a != now:
                now, (ta, raw) = a, sets_[a]
                gaps, na, _ = unpack(raw)
                ha = np.cumsum(gaps)
            gaps, nb, df = unpack(sb)
            hb = np.cumsum(gaps)
            at = np.minimum(np.searchsorted(ha, hb), len(ha) - 1)
            same = ha[at] == hb
            both = float((np.minimum(na[at[same]], nb[same]) * idf(df[same], total_docs)).sum())
            out.append((a, b, both / (ta + tb - both)))
        return pd.DataFrame(out, columns=["a", "b", "similarity"])

    return left.groupBy("block_a").cogroup(right.groupBy("block_b")).applyInPandas(weigh, "a bigint, b bigint, similarity double")


def crowd_sizes(placed: DataFrame) -> DataFrame:
    """(crowd, main, all, most): the largest class of each crowd of (doc_id, crowd, class), and how many documents both have."""
    sizes = placed.groupBy("crowd", "class").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("crowd").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))


def leader_links(placed: DataFrame, sets: DataFrame, total_docs: int, similar: float) -> DataFrame:
    """(a, b): links of one more document of each large crowd, the smallest outside of its largest class, with those of other classes."""
    main = crowd_sizes(placed).where(F.col("all") - F.col("most") > BLOCK)
    rows = placed.join(main.select("crowd", "main"), "crowd")
    lead = rows.where(F.col("class") != F.col("main")).groupBy("crowd").agg(F.min_by(F.struct("doc_id", "class"), "doc_id").alias("lead"))
    lead = lead.select("crowd", F.col("lead.doc_id").alias("a"), F.col("lead.class").alias("of")).join(sets.select(F.col("doc_id").alias("a"), F.col("bands").alias("bands_a")), "a")
    pairs = rows.join(lead, "crowd").where(F.col("class") != F.col("of")).select("a", F.col("doc_id").alias("b"), "bands_a")
    pairs = pairs.join(sets.select(F.col("doc_id").alias("b"), "bands"), "b").where(F.arrays_overlap("bands_a", "bands")).select("a", "b")
    pairs = written(pairs, "near-leaders")
    return similarities(pairs, sets, total_docs).where(F.col("similarity") >= similar).select("a", "b")


def block_links(docs: DataFrame, sets: DataFrame, total_docs: int, similar: float) -> DataFrame:
    """(a, b): links between documents of different classes in each crowd that share a band; docs: (doc_id, crowd, class).

    Of a crowd's documents, those that aren't in its largest class are compared with all
    others, in blocks of BLOCK by BLOCK documents: the intersections of a block are products
    of matrices. For each document and class of the others one link is given.
    """
    placed = docs.join(crowd_sizes(docs), "crowd").withColumn("out", F.col("class") != F.col("main"))
    blocks = lambda n: F.greatest(F.ceil(n / F.lit(BLOCK)), F.lit(1)).cast("int")
    placed = placed.withColumn("outs", blocks(F.col("all") - F.col("most"))).withColumn("blocks", blocks(F.col("all"))).where(F.col("all") > F.col("most"))
    slot = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    placed = placed.join(sets.select("doc_id", "total", "shared", "bands"), "doc_id")
    cols = ["class", "doc_id", "total", "shared", "bands"]
    left = placed.where("out").select(F.col("crowd").alias("c1"), slot(F.col("outs")).alias("o1"), every(F.col("blocks")).alias("b1"), *[F.col(c).alias(f"{c}_1") for c in cols])
    right = placed.select(F.col("crowd").alias("c2"), every(F.col("outs")).alias("o2"), slot(F.col("blocks")).alias("b2"), *[F.col(c).alias(f"{c}_2") for c in cols])

    def side(blobs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, hash, occurrences, document frequency) of all shingles of a block."""
        cols = [unpack(b) for b in blobs]
        row = np.repeat(np.arange(len(cols)), [len(c[0]) for c in cols])
        return row, np.concatenate([np.cumsum(c[0]) for c in cols]), np.concatenate([c[1] for c in cols]), np.concatenate([c[2] for c in cols])

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            k1, k2, i1, i2 = (f[c].to_numpy() for f, c in ((left, "class_1"), (right, "class_2"), (left, "doc_id_1"), (right, "doc_id_2")))
            bands = [np.array(f[c].tolist(), dtype=np.int64).reshape(len(f), -1) for f, c in ((left, "bands_1"), (right, "bands_2"))]
            met = np.zeros((len(left), len(right)), dtype=bool)
            for b in range(BANDS):
                met |= bands[0][:, b, None] == bands[1][None, :, b]
            met &= k1[:, None] != k2[None, :]
            r1, h1, n1, _ = side(left["shared_1"])
            r2, h2, n2, df = side(right["shared_2"])
            words, first = np.unique(h2, return_index=True)
            words, at = np.intersect1d(words, h1, return_indices=True)[:2]
            weight = idf(df[first[at]], total_docs)
            c1, c2 = np.searchsorted(words, h1), np.searchsorted(words, h2)
            ok1, ok2 = (np.minimum(c, max(len(words) - 1, 0)) for c in (c1, c2))
            ok1, ok2 = (words[ok1] == h1, words[ok2] == h2) if len(words) else (np.zeros(len(h1), bool), np.zeros(len(h2), bool))
            both = np.zeros((len(left), len(right)))
            for lo in range(0, len(words) if met.any() else 0, 4096):
                hi = min(lo + 4096, len(words))
                m1, m2 = (ok1 & (c1 >= lo) & (c1 < hi)), (ok2 & (c2 >= lo) & (c2 < hi))
                a, b = np.zeros((len(left), hi - lo)), np.zeros((len(right), hi - lo))
                a[r1[m1], c1[m1] - lo], b[r2[m2], c2[m2] - lo] = n1[m1], n2[m2]
                level = 0.0
                for top in np.unique(n1[m1]).tolist():  # the lesser number of occurrences, level by level
                    use = np.flatnonzero((a >= top).any(axis=0))
                    both += ((a[:, use] >= top) * (weight[lo + use] * (top - level))) @ (b[:, use] >= top).T.astype(np.float64)
                    part = b[:, use]
                    between = (part > level) & (part < top)
                    if between.any():  # occurrences of the right side between two levels of the left one
                        both += np.einsum("iw,jw->ij", (a[:, use] >= top) * weight[lo + use], np.where(between, part - level, 0.0))
                    level = top
            sim = both / (left["total_1"].to_numpy()[:, None] + right["total_2"].to_numpy()[None, :] - both)
            i, j = np.nonzero((sim >= similar) & met)
            _, one = np.unique(np.stack([i, k2[j]]), axis=1, return_index=True)
            out = list(zip(i1[i[one]].tolist(), i2[j[one]].tolist(), strict=True))
        return pd.DataFrame(out, columns=["a", "b"])

    return left.groupBy("c1", "o1", "b1").cogroup(right.groupBy("c2", "o2", "b2")).applyInPandas(compare, "a bigint, b bigint")


def _with_class(frame: DataFrame, classes: DataFrame, key: str, name: str) -> DataFrame:
    """frame with `name`, the class of its column key: itself for what has none."""
    of = classes.select(F.col("node").alias("_n"), F.col("component").alias(name))
    return frame.join(of, F.col(key) == F.col("_n"), "left").withColumn(name, F.coalesce(name, key)).drop("_n")


def _joined_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """classes after more links: only the classes that these join are contracted."""
    ends = _with_class(_with_class(links, classes, "a", "ca"), classes, "b", "cb")
    up = written(components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "near-up")
    moved = classes.join(up.select(F.col("node").alias("_c"), F.col("component").alias("_to")), F.col("component") == F.col("_c"), "left")
    return written(moved.select("node", F.coalesce("_to", "component").alias("component")).unionByName(up).distinct(), "near-classes")


def near_classes(docs: DataFrame, key: str, text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(node, component): every row (a long key) in a class with others, component being the smallest key in it.

    Classes are the connected components of the pairs with a weighted Jaccard similarity of
    TF-IDF shingles of `similar` or more that share a band. In each band's bucket all are
    compared with the one of the smallest key, which parts of the bucket learn apart. What
    this leaves in different classes of one bucket is compared with each other: in buckets of
    up to CROWD documents in pairs, as far as the triangle inequality of the Jaccard distance
    allows a link; larger ones, which often hold the same documents, once for all of them.
    There, further documents are compared with all while that joins classes, and what is
    left outside of the largest class in blocks. Each way finds all links.
    """
    total_docs = docs.count()
    sets = written(weighted_sets(docs, key, text, similar), "near-sets")
    salted = sets.select("doc_id", F.explode("bands").alias("band"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    local = salted.groupBy("band", "salt").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("members"))
    heads = local.groupBy("band").agg(F.min("a").alias("a"), F.sum("members").alias("members")).where("members > 1")
    spots = written(local.select("band", "salt").join(heads, "band"), "near-heads")
    buckets = written(salted.join(spots, ["band", "salt"]).where("doc_id <> a").drop("salt"), "near-buckets")
    discard(spots)
    first = written(similarities(buckets.select("a", F.col("doc_id").alias("b")).distinct(), sets, total_docs), "near-first")
    classes = written(components(first.where(F.col("similarity") >= similar).select("a", "b")), "near-classes")
    placed = _with_class(_with_class(buckets, classes, "doc_id", "class"), classes, "a", "head").withColumn("inside", F.col("class") == F.col("head"))
    mixed = placed.groupBy("band").agg(F.count_if(~F.col("inside")).alias("outside")).where("outside > 0").select("band")
    rest = written(placed.join(mixed, "band"), "near-rest")
    discard(buckets)

    few = rest.where((F.col("members") <= CROWD) & (F.col("members") > 2)).join(first.select("a", F.col("b").alias("doc_id"), "similarity"), ["a", "doc_id"])
    x = few.where(~F.col("inside")).select("band", F.col("doc_id").alias("x"), F.col("class").alias("cx"), F.col("similarity").alias("sx"))
    y = few.select("band", F.col("doc_id").alias("y"), F.col("class").alias("cy"), F.col("similarity").alias("sy"), F.col("inside").alias("iy"))
    near = F.abs(F.col("sx") - F.col("sy")) <= 1 - similar + 1e-9
    met = x.join(y, "band").where((F.col("cx") != F.col("cy")) & (F.col("iy") | (F.col("x") < F.col("y"))) & near)
    pairs = written(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-pairs")
    links = written(similarities(pairs, sets, total_docs).where(F.col("similarity") >= similar).select("a", "b"), "near-more")

    many = rest.where(F.col("members") > CROWD)
    crowds = written(components(many.select(F.col("a"), F.col("doc_id").alias("b")).distinct()), "near-crowds")
    crowds = crowds.select(F.col("node").alias("doc_id"), F.col("component").alias("crowd"))
    if not crowds.isEmpty():
        while True:
            ends = written(_with_class(crowds, classes, "doc_id", "class"), "near-ends")
            if crowd_sizes(ends).where(F.col("all") - F.col("most") > BLOCK).isEmpty():
                break
            led = written(leader_links(ends, sets, total_docs, similar), "near-more")
            # A leader that joins few shows that its crowd is no cluster: blocks do the rest.
            if led.count() < BLOCK:
                links = links.unionByName(led)
                break
            classes = _joined_classes(classes, led)
        links = written(links.unionByName(block_links(ends, sets, total_docs, similar)), "near-more")
    return classes if links.isEmpty() else _joined_classes(classes, links)


def _keys(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, bool]:
    """What tells the rows apart as a long, and whether that is the id: a hash of id and text where ids are missing or shared."""
    own = F.col(f"`{doc_id}`").cast("long")
    some = docs.select(own.alias("i")).groupBy("i").count().where("count > 1 or i is null")
    return (own, True) if some.isEmpty() else (row_key(own, F.col(f"`{text}`")), False)


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, similar: float = SIMILAR) -> DataFrame:
    """The columns `carry` (by default all) with class_id and kept: of each class the document with the smallest id stays.

    Texts without words (null and empty ones too) have no near-duplicates. Rows that share
    an id are told apart by their texts, and a row without an id takes part: of a class, one
    with an id comes first, and class_id is null if there is none. Rows that are equal in both
    share their fate. Empty tables give empty results; columns named class_id or kept are
    replaced.
    """
    names = without(docs, "class_id", "kept").columns if carry is None else carry
    key, is_id = _keys(docs, doc_id, text)
    search = docs.select(key.alias("key"), F.col(f"`{text}`").alias("text"))
    classes = near_classes(search if is_id else search.dropDuplicates(["key"]), "key", "text", similar)
    classes = classes.select(F.col("node").alias("_af_node"), F.col("component").alias("_af_class"))
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{doc_id}`").cast("long").alias("_af_id"), key.alias("_af_key"))
    out = rows.join(classes, F.col("_af_key") == F.col("_af_node"), "left").withColumn("_af_class", F.coalesce("_af_class", "_af_key")).drop("_af_node")
    cols = [F.col(f"`{c}`") for c in names]
    if is_id:
        return out.select(*cols, F.col("_af_class").alias("class_id"), (F.col("_af_class") == F.col("_af_key")).alias("kept"))
    out = written(out, "near-rows")
    order = F.struct(F.col("_af_id").isNull(), F.col("_af_id"), F.col("_af_key"))
    first = out.groupBy(F.col("_af_class").alias("_af_c")).agg(F.min_by(F.struct(F.col("_af_id").alias("i"), F.col("_af_key").alias("k")), order).alias("_af_first"))
    out = out.join(first, F.col("_af_class") == F.col("_af_c"))
    return out.select(*cols, F.col("_af_first.i").alias("class_id"), (F.col("_af_first.k") == F.col("_af_key")).alias("kept"))


def near_filter(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs less the near-duplicates of documents with smaller ids; columns as they were, and cases as in near_dedup.

    Only what is to go meets the texts.
    """
    key, is_id = _keys(docs, doc_id, text)
    if is_id:
        drop = near_classes(docs.select(key.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text").where("node <> component").select(F.col("node").alias("_af_drop"))
    else:
        drop = near_dedup(docs.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").alias("t"), key.alias("_af_drop")), "i", "t", ["_af_drop"]).where("not kept").select("_af_drop").distinct()
    return docs.join(written(drop, "near-drop"), key == F.col("_af_drop"), "left_anti")


def op10_icws_near_dedup(spark, sf_dir):
    from axisforge.llm.common import table

    return near_dedup(table(spark, sf_dir, "documents"), carry=["doc_id"])
