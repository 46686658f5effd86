"""Suffix-array dedup: bytes that repeat from documents with smaller ids, by longest-previous-factor arrays.

Suffixes are compared only where a match can be. Each window of MATCH bytes has an anchor, the K-gram
in it with the least hash (the leftmost of equals), so that equal windows have equal anchors at equal
offsets. What surrounds an anchor, as far as the windows that hold it reach, is its context. Hashes of
anchors only decide which contexts come together: those with one K-gram, if they are of several documents.
What repeats is decided by bytes: the suffixes of the contexts that meet are sorted, and the previous and
next entries of smaller documents in suffix order give each suffix its longest previous factor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axisforge.llm.blobs import groups, in_chunks, lean_memory, mix, pack, part_keys, part_of, powers, repeated, runs, spread, starts, steps, unpack
from axisforge.llm.common import discard, partitions, row_key, table, text_bytes, written

#: Bytes of a match, of an anchor, and the reach of windows before and after an anchor's start.
MATCH, K = 50, 24
BACK, AHEAD = MATCH - K, MATCH
REACH = BACK + AHEAD
#: Suffixes that are sorted at once (more if they are all equal at the start).
SORTED = 50_000
#: Bits of the hashes by which anchors meet.
ANCHOR_BITS = 48
#: Bytes of text in a part, of which a task holds one at a time.
PART = 32 << 20

_POSITION = np.uint64(0xFFFFFFFF)
#: What no UTF-8 text holds: it fills contexts up at the end of a text.
_NONE = b"\xff"


def anchors(data: np.ndarray, size: np.ndarray):
    """(text, place in data, K-gram's hash, context's hash) of the anchors of all windows; data: texts of `size` bytes on end."""
    start = np.cumsum(size) - size
    if len(data) < MATCH:
        return [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64)]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = mix((sums[K:] - sums[:-K]) * down[: len(data) - K + 1])
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    for s in (1, 2, 4, 8):
        least = np.minimum(least[:-s], least[s:])
    least = np.minimum(least[: len(data) - MATCH + 1], least[BACK + 1 - 16 :][: len(data) - MATCH + 1])
    # Windows that lie in one text.
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    fits = size >= MATCH
    np.add.at(inside, start[fits], 1)
    np.add.at(inside, (start + size - MATCH + 1)[fits], -1)
    at = (least[np.cumsum(inside)[: len(least)] > 0] & _POSITION).astype(np.int64)
    at = at[starts(at)] if len(at) else at
    text = np.searchsorted(start, at, side="right") - 1  # empty texts start where the next one does
    begin, end = np.maximum(at - BACK, start[text]), np.minimum(at + AHEAD, start[text] + size[text])
    reach = ((at - begin) << 8 | (end - at)).astype(np.uint64)
    # Least hashes crowd at the low end: hashed again, they spread evenly over ranges.
    return text, at, mix(h[at]) >> np.uint64(64 - ANCHOR_BITS), mix(mix((sums[end] - sums[begin]) * down[begin]) + reach)


def nearest_smaller(values: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: the previous one of a smaller value (-1: none), and what both have in common.

    common[i] is what entries i - 1 and i have in common; it falls to the least on the way.
    All entries follow pointers at once: what a pointer skips is not smaller.
    """
    n = len(values)
    to = np.arange(n) - 1
    shared = common.copy()
    active = np.flatnonzero(to >= 0)
    active = active[values[to[active]] >= values[active]]
    while len(active):
        p = to[active]
        shared[active] = np.minimum(shared[active], shared[p])
        to[active] = to[p]
        active = active[to[active] >= 0]
        active = active[values[to[active]] >= values[active]]
    shared[to < 0] = 0
    return to, shared


def longest_previous_factors(rows: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The length of the longest common prefix of each row of bytes with one of a smaller owner.

    The rows are sorted (the suffix array); prefixes common to neighbours shrink with their
    distance in it, so that the previous and the next row of a smaller owner give the longest.
    """
    n = len(rows)
    if not n:
        return np.zeros(0, dtype=np.int64)
    wide = np.zeros((n, -(-rows.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, : rows.shape[1]] = rows
    order = np.lexsort(wide.view(">u8").T[::-1])
    wide = wide[order]
    differs = wide[1:] != wide[:-1]
    common = np.zeros(n, dtype=np.int64)
    common[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    own = owners[order]
    _, before = nearest_smaller(own, common)
    back = np.zeros(n, dtype=np.int64)
    back[1:] = common[1:][::-1]
    _, after = nearest_smaller(own[::-1], back)
    out = np.empty(n, dtype=np.int64)
    out[order] = np.maximum(before, after[::-1])
    return out


def factors_by_group(group: np.ndarray, rows, size: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """longest_previous_factors() up to `size`, with rows that can only match within their group, some groups at a time.

    group ascends; rows(lo, hi) gives the bytes of those entries.
    """
    out = np.zeros(len(group), dtype=np.int64)
    ends = np.append(np.flatnonzero(starts(group))[1:], len(group))
    lo = 0
    while lo < len(group):
        hi = int(ends[min(np.searchsorted(ends, lo + SORTED), len(ends) - 1)])
        out[lo:hi] = np.minimum(longest_previous_factors(rows(lo, hi), owners[lo:hi]), size[lo:hi])
        lo = hi
    return out


def window_hashes(raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, offset) of all windows within the first `size` bytes of rows."""
    up, down = powers(raw.shape[1] + 1)
    out = []
    for lo in range(0, len(raw), 4096):
        part = raw[lo : lo + 4096]
        sums = np.zeros((len(part), raw.shape[1] + 1), dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: raw.shape[1]], axis=1, out=sums[:, 1:])
        h = mix((sums[:, MATCH:] - sums[:, :-MATCH]) * down[: raw.shape[1] - MATCH + 1])
        row, offset = np.nonzero(np.arange(h.shape[1])[None, :] + MATCH <= size[lo : lo + 4096, None])
        out.append((h[row, offset], (row + lo).astype(np.int32), offset.astype(np.uint8)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint8))


def settled(hash_: np.ndarray, rows, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A mask of the entries whose `size` bytes a smaller owner has in whole; those have equal hashes. rows(at) gives bytes."""
    done = np.zeros(len(hash_), dtype=bool)
    order = np.lexsort((own, hash_))
    if not len(order):
        return done
    first = np.flatnonzero(starts(hash_[order]))
    last = np.append(first[1:], len(order)) - 1
    order = order[spread(own[order[first]] != own[order[last]], first, len(order))]
    if not len(order):
        return done
    # Of an owner's equal entries (a text may repeat itself any number of times) one is sorted; the others are compared with it.
    lead = starts(hash_[order], own[order])
    leads, of = order[lead], np.cumsum(lead) - 1
    verdict = (factors_by_group(hash_[leads], lambda lo, hi: rows(leads[lo:hi]), size[leads], own[leads]) >= size[leads])[of]
    others = np.flatnonzero(~lead & verdict)
    for lo in range(0, len(others), SORTED):
        at = others[lo : lo + SORTED]
        verdict[at] = (rows(order[at]) == rows(leads[of[at]])).all(axis=1)
    done[order] = verdict
    return done


def repeats_of(raw: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end): for contexts (`size` bytes of rows of raw) of documents `own`, the bytes that repeat from a smaller one.

    First whole contexts: one that a smaller document has in whole is done, and no other
    needs it. Of the rest all suffixes are compared; those whose first MATCH bytes have a
    hash of their own have no match and aren't sorted. Windows of one context overlap, so that
    what repeats in it is one run.
    """
    size = size.astype(np.int64)
    up, _ = powers(REACH + 1)
    whole = np.concatenate([mix((raw[lo : lo + 4096].astype(np.uint64) + np.uint64(1)) @ up[:REACH]) for lo in range(0, len(raw), 4096)])
    done = settled(whole, lambda at: raw[at], size, own)
    rest = np.flatnonzero(~done)
    hash_, row, offset = window_hashes(raw[rest], size[rest])
    order = np.argsort(hash_, kind="stable")
    same = hash_[order[1:]] == hash_[order[:-1]]
    order = order[np.append(False, same) | np.append(same, False)] if len(order) else order
    hash_, row, offset = hash_[order], rest[row[order]], offset[order].astype(np.int64)
    padded = np.concatenate([raw, np.full((len(raw), REACH - MATCH), _NONE[0], dtype=np.uint8)], axis=1)
    suffixes = np.lib.stride_tricks.sliding_window_view(padded, REACH, axis=1)
    long = factors_by_group(hash_, lambda lo, hi: suffixes[row[lo:hi], offset[lo:hi]], size[row] - offset, own[row])
    hit = np.flatnonzero(long >= MATCH)
    hit = hit[np.lexsort((offset[hit], row[hit]))]
    row, begin, end = row[hit], offset[hit], (offset + long)[hit]
    one = np.flatnonzero(starts(row))
    end = np.maximum.reduceat(end, one) if len(one) else end
    done = np.flatnonzero(done)
    return np.append(done, row[one]), np.append(np.zeros(len(done), dtype=np.int64), begin[one]), np.append(size[done], end)


def merged(key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) of each key, in order."""
    order = np.lexsort((begin, key))
    key, begin, end = key[order], begin[order].astype(np.int64), end[order].astype(np.int64)
    if not len(key):
        return key, begin, end
    # Ends that only grow within a key: each key gets a level of its own above all ends before.
    level = np.cumsum(starts(key)) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(level + end)
    new = np.append(True, level[1:] + begin[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return key[first], begin[first], (reach - level)[np.append(first[1:], len(key)) - 1]


#: Kinds of packed rows: anchors; bytes that repeat (key, begin, end); contexts wanted (key, position, anchor); contexts.
ANCHORS, SPANS, WANTED, CONTEXTS = range(4)
_ROWS = "part int, kind int, blob binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "kind", "blob"])


def _columns(blobs) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True)]


def keyed(docs: DataFrame, doc_id: str, text: str, parts: int) -> DataFrame:
    """(part, id, key, text): key is the id, or a hash of id and text where rows share an id; part is a hash of the key."""
    keys = part_keys(parts)
    at = F.pmod(F.hash("key"), F.lit(parts))
    of = at if keys == list(range(parts)) else F.element_at(F.array(*map(F.lit, keys)), at + 1)
    rows = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    unique = rows.groupBy("id").count().where("count > 1").isEmpty()
    return rows.withColumn("key", F.col("id") if unique else row_key(F.col("id"), F.col("text"))).select(of.alias("part"), "id", "key", "text")


def repeated_bytes(rows: DataFrame, parts: int) -> DataFrame:
    """(part, kind, blob): for each part of the rows of keyed(), the SPANS that repeat from smaller ids."""
    to = np.array(part_keys(parts))
    bounds = np.array([-(-(b << ANCHOR_BITS) // parts) for b in range(1, parts)], dtype=np.uint64)

    def by_key(kind: int, keys: np.ndarray, *columns: np.ndarray) -> list[tuple]:
        return [(int(to[part]), kind, pack(keys[r], *(c[r] for c in columns))) for part, r in groups(part_of(keys, parts))]

    def scan(batches):
        lean_memory()
        for (ids, keys), texts in runs(batches):
            out = scan_run(ids, keys, texts)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    def scan_run(ids: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> list[tuple]:
        size = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(texts) + _NONE * REACH, dtype=np.uint8)
        found = []
        for lo, hi in in_chunks(texts):
            doc, at, h, context = anchors(data[start[lo] : start[hi - 1] + size[hi - 1]], size[lo:hi])
            found.append((doc + lo, at + start[lo], h, context))
        doc, at, h, context = map(np.concatenate, zip(*found, strict=True))
        del found
        if not len(doc):
            return []
        begin, end = np.maximum(at - BACK, start[doc]), np.minimum(at + AHEAD, start[doc] + size[doc])

        def bytes_at(i: np.ndarray) -> np.ndarray:
            place = np.arange(REACH)
            raw = data[begin[i, None] + place]
            raw[place >= (end - begin)[i, None]] = _NONE[0]
            return raw

        # Contexts that an earlier document of this run has are done here, so that any number of copies leaves one of them.
        done = settled(context, bytes_at, end - begin, ids[doc])
        of, a, b = merged(doc[done], begin[done], end[done])
        out = by_key(SPANS, keys[of], (a - start[of]).astype(np.uint32), (b - start[of]).astype(np.uint32))
        rest = np.flatnonzero(~done)
        rest = rest[np.argsort(h[rest], kind="stable")]
        same = bool((ids == keys).all())
        doc, at, h = doc[rest].astype(np.uint32 if len(ids) > 65535 else np.uint16), (at - start[doc])[rest].astype(np.uint32), h[rest]
        cuts = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                docs_, local = np.unique(doc[a:b], return_inverse=True)
                out.append((int(to[part]), ANCHORS, pack(ids[docs_], keys[docs_[:0] if same else docs_], steps(h[a:b]), local.astype(doc.dtype), at[a:b])))
        return out

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        kinds = pdf["kind"].to_numpy()
        out = [(int(pdf["part"].iloc[0]), SPANS, b) for b in pdf["blob"][kinds == SPANS]]
        blobs = list(pdf["blob"][kinds == ANCHORS])
        if not blobs:
            return _frame(out)
        # Most anchors occur once: the other columns are unpacked for the rest.
        hs = [np.cumsum(unpack(b, (2,))[0]) for b in blobs]
        cols = []
        for i, keep in enumerate(repeated(hs)):
            ids, keys, doc, at = unpack(blobs[i], (0, 1, 3, 4))
            doc = doc[keep]
            cols.append((hs[i][keep], ids[doc], (keys if len(keys) else ids)[doc], at[keep]))
            hs[i] = None
        h, own, key, at = map(np.concatenate, zip(*cols, strict=True))
        del cols
        if not len(h):
            return _frame(out)
        # Only anchors of several documents: what those have in common is for their bytes to say.
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(starts(h[order]))
        several = spread(np.minimum.reduceat(own[order], first) != np.maximum.reduceat(own[order], first), first, len(order))
        order = order[several]
        return _frame(out + by_key(WANTED, key[order], at[order], h[order]))

    def contexts(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        if not len(texts) or not len(marks):
            return _frame([])
        key, at, h = _columns(marks["blob"])
        known = {k: (i, t.encode()) for k, i, t in zip(texts["key"], texts["id"], texts["text"], strict=True)}
        own = np.array([known[k][0] for k in key.tolist()], dtype=np.int64)
        begin = np.maximum(at.astype(np.int64) - BACK, 0)
        out = []
        for part, r in groups(part_of(h.view(np.int64), parts)):
            pieces = [known[k][1][b : p + AHEAD] for k, b, p in zip(key[r].tolist(), begin[r].tolist(), at[r].tolist(), strict=True)]
            size = np.array([len(p) for p in pieces], dtype=np.uint8)
            raw = np.frombuffer(b"".join(p.ljust(REACH, _NONE) for p in pieces), dtype=np.uint8)
            out.append((int(to[part]), CONTEXTS, pack(own[r], key[r], begin[r].astype(np.uint32), size, raw)))
        return _frame(out)

    def factors(pdf: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        own, key, begin, size, raw = _columns(pdf["blob"])
        row, a, b = repeats_of(raw.reshape(len(own), REACH), size, own)
        k, a, b = merged(key[row], a + begin[row], b + begin[row])
        return _frame(by_key(SPANS, k, a.astype(np.uint32), b.astype(np.uint32)))

    marks = rows.select("id", "key", "text").mapInArrow(scan, _ROWS).repartition(parts, "part").groupBy("part").applyInPandas(meet, _ROWS)
    marks = written(marks, "suffix-marks")
    wanted = marks.where(F.col("kind") == WANTED).withColumnRenamed("part", "to")
    near = rows.groupBy("part").cogroup(wanted.groupBy("to")).applyInPandas(contexts, _ROWS)
    found = written(near.repartition(parts, "part").groupBy("part").applyInPandas(factors, _ROWS), "suffix-spans")
    own = written(marks.where(F.col("kind") == SPANS).unionByName(found), "suffix-all")
    discard(marks, found)
    return own


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", results: tuple[str, ...] = ("kept", "spans")) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and `results`: kept (binary, the remaining bytes), spans (removed [begin, end)).

    A byte goes if a string of MATCH bytes that covers it also starts in a document with a
    smaller id, in the input as it is; texts are UTF-8 bytes, and matches stay within a text.

    A task holds a run of texts, the texts of a part, or the anchors or contexts that lie in
    a part's range of hashes; there are as many parts as the texts need at PART bytes each.
    The contexts of one anchor meet in one task: one for each run of texts and different
    surroundings, 76 bytes each.

    Null and shorter texts stay whole. Rows that share an id don't repeat each other; each
    row is returned. A row without an id is compared with none. Memory and time go with the
    length of a text. Empty tables give empty results; further columns are ignored.
    """
    spark = docs.sparkSession
    parts = max(2 * partitions(spark), partitions(spark, text_bytes(docs, text), PART))
    rows = keyed(docs, doc_id, text, parts)
    marks = repeated_bytes(rows, parts).withColumnRenamed("part", "to")
    types = {"kept": "binary", "spans": "array<struct<begin:bigint,end:bigint>>"}
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *results]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + "".join(f", {r} {types[r]}" for r in results)

    def cut(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        lean_memory()
        found: dict[int, list[tuple[int, int]]] = {}
        if len(marks):
            for k, a, b in zip(*(c.tolist() for c in merged(*_columns(marks["blob"]))), strict=True):
                found.setdefault(k, []).append((a, b))
        out = []
        for i, k, t in zip(texts["id"], texts["key"], texts["text"], strict=True):
            data = t.encode()
            gone = found.get(k, [])
            kept, last = [], 0
            for a, b in gone:
                kept.append(data[last:a])
                last = b
            kept = b"".join([*kept, data[last:]]) if gone else data
            row = {"kept": kept, "spans": gone}
            out.append((i, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), *(row[r] for r in results)))
        return pd.DataFrame(out, columns=columns)

    done = rows.groupBy("part").cogroup(marks.groupBy("to")).applyInPandas(cut, schema)
    data = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    none = {"kept": data, "spans": F.array().cast(types["spans"])}
    alone = docs.where(F.col(f"`{doc_id}`").isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(data, 256).alias("kept_sha256"), *(none[r].alias(r) for r in results))
    return done.unionByName(alone)


def op2_suffix_lpf_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), results=())
