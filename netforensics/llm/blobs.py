"""Arrays of numbers as rows: kind, bucket, data. Sorting and summing happens on whole arrays inside tasks, Spark deals the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .common import remembers

MIX = np.uint64(0x9E3779B97F4A7C15)
BLOBS = "kind int, bucket int, data binary"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word) | 4  # never one of the marks
        return out


HASHES = WordHashes()  # of this worker process


remembers("hashes", HASHES.clear)


def mixed(a: np.ndarray, b: np.ndarray | np.uint64 = np.uint64(0)) -> np.ndarray:
    """A 64-bit hash of one or two hashes."""
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(32))) * MIX + b
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the values by key, keys ascending."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values)


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join([len(arrays[0]).to_bytes(8, "little"), *(a.tobytes() for a in arrays)])


def unpack(data: bytes, kinds: tuple) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def key_bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(key, MIX) % np.uint64(buckets)).astype(np.int32)


def dealt(kind: int, buckets: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of `arrays`, cut by bucket; their order stays within a bucket."""
    order = np.argsort(buckets, kind="stable")
    numbers, starts = np.unique(buckets[order], return_index=True)
    for number, start, stop in zip(numbers.tolist(), starts.tolist(), [*starts.tolist()[1:], len(order)], strict=True):
        part = order[start:stop]
        yield blob(kind, number, pack(*(a[part] for a in arrays)))


def blob(kind: int, bucket: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["kind", "bucket", "data"])


def by_bucket(batches: Iterator[pa.RecordBatch], kinds: dict[int, tuple], raw: tuple[int, ...] = ()) -> Iterator[tuple[int, dict]]:
    """All arrays of each bucket of this task; a task has one bucket or a few."""
    parts: dict[int, dict[int, list]] = {}
    for batch in batches:
        for kind, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "data")), strict=True):
            parts.setdefault(bucket, {}).setdefault(kind, []).append(data)
    for bucket in sorted(parts):
        of = parts.pop(bucket)
        yield bucket, {k: blobs if k in raw else [np.concatenate(c) for c in zip(*(unpack(b, kinds[k]) for b in blobs), strict=True)] for k, blobs in of.items()}


