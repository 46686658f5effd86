"""Arrays packed into binary columns, and hashes of words and byte strings, for stages that move many small values."""

from __future__ import annotations

import ctypes
import struct

import numpy as np
import pyarrow as pa
import zstandard

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at once; longer texts are hashed in slices that end at white space.
SLICE = 1 << 19


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as bytes: the lowest bytes of all values, then the next, compressed."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""
        z = zstandard.compress(planes, 1)
        out.append(struct.pack("<2sQQ", a.dtype.str[1:].encode(), len(a), len(z)) + z)
    return b"".join(out)


def unpack(blob: bytes, only: tuple[int, ...] | None = None) -> list[np.ndarray]:
    """The packed arrays, or those numbered in `only`."""
    out, at, i = [], 0, -1
    while at < len(blob):
        i += 1
        kind, n, size = struct.unpack_from("<2sQQ", blob, at)
        at += struct.calcsize("<2sQQ")
        if only is not None and i not in only:
            at += size
            continue
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(zstandard.decompress(blob[at : at + size]) if n else b"", dtype=np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype))
        at += size
    return out


def repeated(parts: list[np.ndarray]) -> list[np.ndarray]:
    """For each of the arrays, a mask of the values that occur twice or more in all of them together."""
    whole = np.concatenate(parts)
    order = np.argsort(whole, kind="stable")
    whole = whole[order]
    same = whole[1:] == whole[:-1]
    mask = np.zeros(len(whole), dtype=bool)
    mask[order[1:]] = same
    mask[order[:-1]] |= same
    return np.split(mask, np.cumsum([len(p) for p in parts])[:-1])


def lean_memory() -> None:
    """Makes this process give freed memory back to the system: workers live on after a task, beside the JVM's heap."""
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):  # glibc
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: larger blocks are unmapped once they are freed
        libc.malloc_trim(0)


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending unsigned array, which np.cumsum undoes."""
    return np.diff(a, prepend=a.dtype.type(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE + 1)
        base, inverse = int(_MULTIPLIER), pow(int(_MULTIPLIER), -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.append(np.uint64(1), np.full(size - 1, b, dtype=np.uint64))) for b in (base, inverse)]
    return _POWERS[0], _POWERS[1]


_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: A-Z as a-z, other bytes as they are.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of the words of bytes: what stands between white space, A-Z lower-cased."""
    starts, hashes, lo = [], [], 0
    while lo < len(data):
        hi = min(len(data), lo + SLICE)
        if hi < len(data):
            cut = np.flatnonzero(_SPACE[data[lo:hi]])
            if len(cut):
                hi = lo + int(cut[-1]) + 1
            else:
                more = np.flatnonzero(_SPACE[data[hi:]])
                hi = hi + int(more[0]) + 1 if len(more) else len(data)
        part = data[lo:hi]
        space = _SPACE[part]
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(len(part) + 1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((LOWER[part] + np.uint64(1)) * up[: len(part)])])
        starts.append(first + lo)
        hashes.append(mix((sums[end] - sums[first]) * down[first]))
        lo = hi
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a space after each, where each starts)."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), starts


#: Bytes of text of which what is found is sorted and packed at once.
RUN = 1 << 23


def runs(batches, size: int = RUN):
    """(rows of numbers [column][row], texts as bytes) of about `size` bytes, from Arrow batches of long columns and a text."""
    numbers, texts, held = [], [], 0
    for batch in batches:
        own = [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
        columns = np.array([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns - 1)], dtype=np.int64).reshape(batch.num_columns - 1, batch.num_rows)
        for lo, hi in in_chunks(own, size):
            numbers.append(columns[:, lo:hi])
            texts += own[lo:hi]
            held += sum(map(len, own[lo:hi]))
            if held >= size:
                yield np.concatenate(numbers, axis=1), texts
                numbers, texts, held = [], [], 0
    if texts:
        yield np.concatenate(numbers, axis=1), texts


def in_chunks(texts, size: int = SLICE):
    """Runs (first, last) of texts with about `size` bytes together; a longer text is a run of its own."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield lo, i
            lo, held = i, 0
        held += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def _murmur(words: list[np.ndarray], size: int) -> np.ndarray:
    u = np.uint32
    h = np.full(len(words[0]), 42, dtype=u)
    turn = lambda x, n: (x << u(n)) | (x >> u(32 - n))
    for k in words:
        h ^= turn(k * u(0xCC9E2D51), 15) * u(0x1B873593)
        h = turn(h, 13) * u(5) + u(0xE6546B64)
    h ^= u(size)
    h ^= h >> u(16)
    h *= u(0x85EBCA6B)
    h ^= h >> u(13)
    h *= u(0xC2B2AE35)
    return (h ^ (h >> u(16))).view(np.int32)


def hash_longs(x: np.ndarray) -> np.ndarray:
    """What F.hash gives for a bigint column."""
    x = x.astype(np.int64).view(np.uint64)
    return _murmur([x.astype(np.uint32), (x >> np.uint64(32)).astype(np.uint32)], 8)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """What F.pmod(F.hash(key), parts) gives for a bigint column."""
    return np.mod(hash_longs(keys).astype(np.int64), parts).astype(np.int32)


KEYED = 1 << 13


def part_keys(parts: int) -> list[int]:
    """A number for each part that a shuffle by it into `parts` partitions sends to the partition of that number.

    Beyond KEYED parts the numbers are the parts': some partitions then get several parts, and the plan holds no long list.
    """
    if parts > KEYED:
        return list(range(parts))
    out, left, lo = [-1] * parts, parts, 0
    while left:
        x = np.arange(lo, lo + 16 * parts, dtype=np.int32)
        for v, p in zip(x.tolist(), np.mod(_murmur([x.view(np.uint32)], 4).astype(np.int64), parts).tolist(), strict=True):
            if out[p] < 0:
                out[p] = v
                left -= 1
        lo += 16 * parts
    return out


def groups(keys: np.ndarray):
    """(key, rows) of equal keys."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(keys[rows[0]]), rows


def starts(*columns: np.ndarray) -> np.ndarray:
    """A mask of where runs of equal rows of sorted columns begin."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def spread(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """A value for each run, given where runs start, as a value for each of the n rows."""
    return np.repeat(values, np.diff(np.append(first, n)))
