"""Byte-level BPE by prefix dynamic programming.

For each prefix of a byte string its encoding ends in one token, which is the only one among the
tokens that are suffixes of the prefix whose junction with the last token of the shorter prefix is
valid: merging the bytes of both again would not cross the junction. The table of these last tokens
is extended byte by byte, so that appends are exact and cost only what is appended, and an edit
costs only the bytes up to where the table agrees again with the one before.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from axisforge.llm.blobs import lean_memory

#: Bytes of encodings that are kept in a task, in two generations of this size; an entry has ENTRY bytes beside its strings.
MEMO, ENTRY = 32 << 20, 220
#: Junctions of two tokens of which a task keeps whether they are valid.
JUNCTIONS = 250_000
#: Rows that are encoded and handed on at once.
ROWS = 500
_SHIFT = 24


class Vocabulary:
    """Tokens by rank, how each was merged, and the junctions that are valid."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens) if t is not None}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"no tokens for the bytes {missing[:5]}")
        self.left = list(range(len(tokens)))
        self.right = list(range(len(tokens)))
        self.merged: dict[int, int] = {}
        self.longest = max(map(len, self.ranks))
        ranks = self.ranks
        for i, token in enumerate(tokens):
            for k in range(1, len(token or b"")):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None and (a < i or k == 1) and (b < i or len(token) - k == 1) and self.stays(a, b):
                    self.left[i], self.right[i] = a, b
                    self.merged[a << _SHIFT | b] = i
                    break
        self.known = 0
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            # A longer token that no merge makes can only be a whole piece.
            if len(token) == 1 or self.left[i] != i:
                # The token, its length, and the tokens before it by whether their junction with it is valid, as far as known.
                self.automaton.add_word(token.decode("latin-1"), (i, len(token), {}))
        self.automaton.make_automaton()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        ranks = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    ranks[int(rank)] = base64.b64decode(token)
        return cls([ranks.get(i) for i in range(max(ranks) + 1)])

    def stays(self, a: int, b: int) -> bool:
        """Whether the junction of the tokens a and b survives the merging of their bytes.

        Merges are undone from the latest back; at each step the two tokens that meet at the
        junction must not be a pair that would have been merged sooner than what is undone.
        Of equal merges the left one comes first.
        """
        merged, left, right = self.merged, self.left, self.right
        before = len(self.tokens)
        while True:
            both = merged.get(a << _SHIFT | b)
            if both is not None and both < before:
                return False
            undo_a = right[a] != a and (a > b or left[b] == b)
            if undo_a:
                before, a = a, right[a]
            elif left[b] != b:
                before, b = b + 1, left[b]
            else:
                return True

    def forget(self) -> None:
        for _, _, valid in self.automaton.values():
            valid.clear()
        self.known = 0

    def after(self, before: int, token: int, valid: dict[int, bool]) -> bool:
        """Whether token may follow before; remembered in `valid`, of which JUNCTIONS are kept in all."""
        if self.known >= JUNCTIONS:
            self.forget()
        self.known += 1
        ok = valid[before] = self.stays(before, token)
        return ok

    def extend(self, data: bytes, last: list[int], start: int, stop_at=None) -> int:
        """Fills last[i] for the prefixes of data from length start + 1 on; returns where it ended.

        last[0] is -1, and last[:start + 1] is filled. stop_at(i), if given, ends the work early.
        """
        begin = max(0, start - self.longest)
        done = start
        for end, (token, size, valid) in self.automaton.iter(data[begin:].decode("latin-1")):
            i = begin + end + 1
            if i <= done:
                continue
            before = last[i - size]
            if before >= 0:
                ok = valid.get(before)
                if not (self.after(before, token, valid) if ok is None else ok):
                    continue
            last[i] = token
            done = i
            if stop_at and stop_at(i):
                return i
        return done

    def walk(self, last: list[int], size: int) -> list[int]:
        ids, tokens = [], self.tokens
        while size > 0:
            ids.append(last[size])
            size -= len(tokens[last[size]])
        return ids[::-1]

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        last, done, after = [-1] * (len(piece) + 1), 0, self.after
        for end, (token, size, valid) in self.automaton.iter(piece.decode("latin-1")):
            if end >= done:  # else the prefix has its last token
                before = last[end + 1 - size]
                if before >= 0:
                    ok = valid.get(before)
                    if not (after(before, token, valid) if ok is None else ok):
                        continue
                done = end + 1
                last[done] = token
        return self.walk(last, len(piece))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The last tokens of all prefixes of one byte string, kept up to date under appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.steps = vocabulary, b"", [-1], 0
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self.vocabulary.extend(self.data, self.last, start)
        self.steps += len(more)

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replaces data[start:stop] by new."""
        shift, old, after = len(new) - (stop - start), self.last, start + len(new)
        self.data = self.data[:start] + new + self.data[stop:]
        last = old[: start + 1] + [-1] * (len(self.data) - start)
        agreed, longest = 0, self.vocabulary.longest

        def agrees(i: int) -> bool:
            nonlocal agreed
            agreed = agreed + 1 if i > after and last[i] == old[i - shift] else 0
            return agreed >= longest and i - after >= longest

        end = self.vocabulary.extend(self.data, last, start, agrees)
        last[end + 1 :] = old[end + 1 - shift :]
        self.last = last
        self.steps += end - start

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self.last, len(self.data))


class Memo(dict):
    """piece -> its ids, joined by spaces; the pieces least recently met are forgotten by generations."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.older, self.held = vocabulary, {}, 0

    def forget(self) -> None:
        """What was learnt goes back to the system: a worker outlives its task, and the vocabulary alone is worth keeping."""
        self.clear()
        self.older, self.held = {}, 0
        self.vocabulary.forget()
        lean_memory()

    def __missing__(self, piece: str) -> str:
        ids = self.older.get(piece)
        if ids is None:
            ids = " ".join(map(str, self.vocabulary.encode(piece.encode())))
        if self.held >= MEMO:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += len(piece) + len(ids) + ENTRY
        self[piece] = ids
        return ids


_LOADED: dict[str, tuple] = {}


def encoder(path: str, pattern: str):
    """(memo, split, tokens by the decimal id) of a rank file; kept for the life of a worker."""
    key = f"{path}\n{pattern}"
    if key not in _LOADED:
        v = Vocabulary.load(path)
        _LOADED[key] = Memo(v), regex.compile(pattern).findall, {str(i): t for i, t in enumerate(v.tokens) if t is not None}
    return _LOADED[key]


RESULTS = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded": pa.binary(), "decoded_sha256": pa.string()}
SQL_TYPES = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}


def bpe_encode(docs: DataFrame, path: str, pattern: str, results: tuple[str, ...] = ("ids", "n_tokens"), carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns `carry` of docs (by default all) with `results`, any of RESULTS, of the whole column `text`.

    path: a rank file that each executor can open; pattern: cuts the text into pieces, which
    are encoded separately. Special tokens are ordinary text. Null texts count as empty, and
    an empty text has no ids. Long texts cost time and memory in proportion. Rows map to
    rows, without a shuffle, so that repeated rows stay and an empty table gives an empty
    one; columns with the names of the results are replaced.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in {r.lower() for r in results}]
    fields = {f.name: f for f in docs.schema.fields}
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    schema = ", ".join([*(f"{quoted(c)} {fields[c].dataType.simpleString()}" for c in names), *(f"{r} {SQL_TYPES[r]}" for r in results)])
    decode = bool({"decoded", "decoded_sha256"} & set(results))

    def encode(batches):
        lean_memory()
        memo, split, by_id = encoder(path, pattern)
        try:
            for whole in batches:
                for lo in range(0, whole.num_rows, ROWS):
                    yield encoded(whole.slice(lo, ROWS), memo.__getitem__, split, by_id.__getitem__)
        finally:
            memo.forget()

    def encoded(batch, piece_ids, split, token):
        out = {r: [] for r in results}
        for text in batch.column(batch.num_columns - 1):
            ids = " ".join(map(piece_ids, split(text.as_py() or "")))
            if "ids" in out:
                out["ids"].append(np.fromstring(ids, dtype=np.int32, sep=" "))
            if "n_tokens" in out:
                out["n_tokens"].append(ids.count(" ") + 1 if ids else 0)
            if "ids_sha256" in out:
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
            if decode:
                data = b"".join(map(token, ids.split()))
                if "decoded" in out:
                    out["decoded"].append(data)
                if "decoded_sha256" in out:
                    out["decoded_sha256"].append(hashlib.sha256(data).hexdigest())
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(out[r], RESULTS[r]) for r in results)], names=[*names, *results])

    from pyspark.sql import functions as F

    return docs.select(*map(quoted, names), F.col(quoted(text)).alias("_af_text")).mapInArrow(encode, schema)


def op5_prefix_bpe(spark, sf_dir):
    import public_tokenizers

    from axisforge.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256"), ["doc_id"])
