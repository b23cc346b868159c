"""Removal of repeated word windows behind a count-min prefilter (operator 13).

A window is `width` consecutive words of one document; a word goes if a window that covers it has the
same word sequence as a window that starts anywhere else. Windows are judged on the input.

1. Rows are dealt into slices by a hash. Each slice enters its windows into a count-min sketch of two
   rows. The sketch grows with the input: it is cut into shards that each take about WINDOWS windows,
   and a slice sends every shard the sorted cells it has filled (a cell twice if two or more of its
   windows fell there). A shard merges the sketches of all slices and answers each of them with one bit
   for a cell: count of two or more. Counts are never too small, so no repeated window is lost.
2. A slice sends only the windows whose two cells are both counted twice, as 128-bit hashes, to the
   task of their hash range. There they are grouped exactly, and the answer is one bit for a window.
3. A slice cuts the words under windows that the second answer names.

A slice sends a window at most once, however often it has it, so copies do not pile up in one task.
Answers follow the sorted order of hashes, never that of rows, so a recomputed slice fits them. All
steps are one plan over one exchange of the texts. Two different windows are only taken for equal if
both 64-bit halves collide: a chance under 1e-11 for 10^13 windows.

Nulls count as empty texts. Null, repeated and non-numeric keys are kept as they are: every row is a
document of its own, so equal rows repeat each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import only, remembers

SLICE_BYTES = 8 << 20
WINDOWS = 1 << 21  # a shard of the sketch takes about so many
WORD_BYTES = 6  # of a word and the space behind it, on average
CELL_BITS = 24  # cells of a shard's row: eight a window
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)
# Odd factors of the two polynomials over the words of a window.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MESSAGES = "slice int, unit long, data binary"
OWN = -1  # what a slice keeps for itself: units below 0


class _Digests(dict):
    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = xxhash.xxh3_128_digest(word)
        return out


DIGESTS = _Digests()  # of this worker process
remembers("digests", DIGESTS.clear)


def _window_hashes(halves: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Of every run of `width` words, the polynomial of their hashes modulo 2^64."""
    n = len(halves)
    up = np.full(n, factor, np.uint64)
    down = np.full(n, pow(factor, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(halves * np.cumprod(up))])
    value = (sums[width:] - sums[:-width]) * np.cumprod(down)[: n - width + 1]
    # The low bits of such a sum are weak, the places below come from the high ones.
    value = (value ^ (value >> HALF)) * np.uint64(FACTORS[0])
    return value ^ (value >> np.uint64(29))


class Slice:
    """The words and the distinct windows of the documents of one slice.

    `first`, `second`: halves of the hashes of distinct windows, ascending by the first. `of` gives for
    each window in text order its number there; `times` how often it occurs here.
    """

    def __init__(self, texts: list[str | None], width: int):
        self.width, digests, self.sizes = width, [], []
        for text in texts:
            words = (text or "").encode().split()
            self.sizes.append(len(words))
            digests.append(b"".join(map(DIGESTS.__getitem__, words)))
        halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        del digests
        sizes = np.array(self.sizes, np.int64)
        ends = np.cumsum(sizes)
        if len(halves) < width:
            self.starts, hashes = np.zeros(0, np.int64), [np.zeros(0, np.uint64)] * 2
        else:
            inside = np.ones(len(halves) - width + 1, bool)
            for end in ends[:-1].tolist():  # windows over the end of a document are none
                inside[max(0, end - width + 1) : end] = False
            self.starts = np.flatnonzero(inside)
            hashes = [_window_hashes(np.ascontiguousarray(halves[:, k]), width, FACTORS[k])[self.starts] for k in (0, 1)]
        a, b = hashes
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        if (~new[1:] & (b[1:] != b[:-1])).any():
            order = np.lexsort(hashes[::-1])
            a, b = hashes[0][order], hashes[1][order]
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        heads = np.flatnonzero(new)
        self.first, self.second = a[heads], b[heads]
        self.of = np.empty(len(a), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.times = np.diff(np.append(heads, len(a)))


def _place(value: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and cell of hashes; both follow the order of the hashes."""
    scaled = (value >> HALF) * np.uint64(shards) + (((value & LOW) * np.uint64(shards)) >> HALF)
    return scaled >> HALF, (scaled & LOW) >> np.uint64(32 - CELL_BITS)


def _packed(numbers: np.ndarray, width: int) -> bytes:
    """Numbers by byte planes, where small ones leave long runs of zeros."""
    return zstandard.compress(numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def _unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).view(bool)


def _cut(units: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(unit, start, stop) of the runs of ascending units."""
    if not len(units):
        return iter(())
    starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
    return zip(units[starts].tolist(), starts.tolist(), [*starts.tolist()[1:], len(units)], strict=True)


def _rows(found: Slice, shards: int) -> Iterator[tuple[int, np.ndarray | None, np.ndarray, np.ndarray]]:
    """For both rows of the sketch: number, order of the windows, shard and cell of each in this order."""
    yield 0, None, *_place(found.first, shards)
    order = np.argsort(found.second)
    yield 1, order, *_place(found.second[order], shards)


def _batch(slices: list[int], units: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(units, pa.int64()), pa.array(data, pa.binary())], ["slice", "unit", "data"])


def _cells(shards: np.ndarray, cells: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shard, cell), the number of each window's, and how many windows of the slice fell there."""
    new = np.ones(len(cells), bool)
    new[1:] = (cells[1:] != cells[:-1]) | (shards[1:] != shards[:-1])
    heads = np.flatnonzero(new)
    filled = np.add.reduceat(times, heads) if len(heads) else times
    return shards[heads], cells[heads], np.cumsum(new) - 1, filled


def _sketch(number: int, found: Slice, shards: int) -> pa.RecordBatch:
    """The cells that a slice fills, by shard; a unit is a row of a shard."""
    units, data = [], []
    for row, order, shard, cell in _rows(found, shards):
        shard, cell, _, filled = _cells(shard, cell, found.times if order is None else found.times[order])
        for unit, start, stop in _cut(shard):
            twice = np.repeat(cell[start:stop], np.minimum(filled[start:stop], 2))
            units.append(2 * unit + row)
            data.append(_packed(np.diff(twice, prepend=np.uint64(0)), 4))
    return _batch([number] * len(units), units, data)


def _merged(messages: list[tuple[int, bytes]]) -> list[bytes]:
    """The sketches of all slices for one unit, merged; for each slice the bits of its distinct cells."""
    seen, twice, sent = np.zeros(1 << CELL_BITS, bool), np.zeros(1 << CELL_BITS, bool), []
    for _, data in messages:
        cells = np.cumsum(_unpacked(data, 4), dtype=np.int64)
        again = np.r_[False, cells[1:] == cells[:-1]]
        twice[cells[again]] = True
        cells = cells[~again]
        twice[cells[seen[cells]]] = True
        seen[cells] = True
        sent.append(cells.astype(np.int32))
    return [_bits(twice[cells]) for cells in sent]


def _estimated(found: Slice, shards: int, answers: dict[int, bytes]) -> np.ndarray:
    """Whether the sketch counts each distinct window of a slice twice or more."""
    out = np.ones(len(found.first), bool)
    for row, order, shard, cell in _rows(found, shards):
        shard, cell, of, _ = _cells(shard, cell, found.times if order is None else found.times[order])
        counted = np.zeros(len(cell), bool)
        for unit, start, stop in _cut(shard):
            counted[start:stop] = _flags(answers[2 * unit + row], stop - start)
        if order is None:
            out &= counted[of]
        else:
            out[order] &= counted[of]
    return out


def _candidates(number: int, found: Slice, shards: int, estimated: np.ndarray) -> pa.RecordBatch:
    """The windows for the exact grouping by hash range, and what the slice has to remember of them."""
    first, second, times = found.first[estimated], found.second[estimated], found.times[estimated]
    units, data = [OWN - number], [zstandard.compress(_bits(estimated), 1)]
    for unit, start, stop in _cut(_place(first, shards)[0]):
        near = _packed(np.diff(first[start:stop], prepend=first[start:stop][:1]), 8)
        head = int(first[start]).to_bytes(8, "little") + len(near).to_bytes(4, "little")
        units.append(unit)
        data.append(head + near + second[start:stop].tobytes() + _bits(times[start:stop] > 1))
    return _batch([number] * len(units), units, data)


def _grouped(messages: list[tuple[int, bytes]]) -> list[bytes]:
    """For each slice, which of its windows occur again in it or in another slice."""
    parts = []
    for _, data in messages:
        size = int.from_bytes(data[8:12], "little")
        near = _unpacked(data[12 : 12 + size], 8)
        first = np.cumsum(near) + np.uint64(int.from_bytes(data[:8], "little"))
        second = np.frombuffer(data, np.uint64, len(near), 12 + size)
        parts.append((first, second, _flags(data[12 + size + 8 * len(near) :], len(near))))
    first, second, twice = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((second, first))
    same = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    again = np.r_[False, same] | np.r_[same, False]
    out = np.empty(len(first), bool)
    out[order] = again
    out |= twice
    stops = np.cumsum([len(p[0]) for p in parts])[:-1]
    return [_bits(x) for x in np.split(out, stops)]


def _spans(found: Slice, repeated: np.ndarray) -> np.ndarray:
    """Whether each word of the slice is covered by a repeated window."""
    change = np.zeros(sum(found.sizes) + 1, np.int32)
    hit = found.starts[repeated[found.of]]
    np.add.at(change, hit, 1)
    np.subtract.at(change, hit + found.width, 1)
    return np.cumsum(change)[:-1] > 0


def _by_unit(batches: Iterator[pa.RecordBatch], settle) -> Iterator[pa.RecordBatch]:
    """Messages of one unit after the other (they come sorted); answers to the slices."""

    def answered(unit: int, messages: list[tuple[int, bytes]]) -> pa.RecordBatch:
        messages.sort()
        return _batch([s for s, _ in messages], [unit] * len(messages), settle(messages))

    unit, held = None, []
    for batch in batches:
        for s, u, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "unit", "data")), strict=True):
            if u < 0:
                yield _batch([s], [u], [data])
                continue
            if u != unit and held:
                yield answered(unit, held)
                held = []
            unit = u
            held.append((s, data))
    if held:
        yield answered(unit, held)


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35, columns: tuple[str, ...] = ()) -> DataFrame:
    """Per row: `key` and `columns` as they are, n_words, removed (word spans start..stop) and kept.

    `kept` are the words that stay, joined by one space. Spans are maximal runs of removed words,
    counted from 0, the stop excluded. Nothing is removed from documents of fewer than `width` words.
    """
    if width < 1:
        raise ValueError("a window has one word at least")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SLICE_BYTES))
    shards = max(slices, -(-total // (WINDOWS * WORD_BYTES)))
    names = [key, *columns]
    place = {c: "text" if c == text else f"k{i}" for i, c in enumerate(names)}
    sent = [F.col(c).alias(k) for c, k in place.items() if k != "text"]
    dealt = docs.select(*sent, F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(slices)).cast("int").alias("slice"))
    dealt = dealt.repartition(slices, "slice")

    def sketch(tables: pa.Table) -> pa.Table:
        only("digests")
        found = Slice(tables.column("text").to_pylist(), width)
        return pa.Table.from_batches([_sketch(tables.column("slice")[0].as_py(), found, shards)])

    def estimate(left: pa.Table, right: pa.Table) -> pa.Table:
        only("digests")
        found = Slice(left.column("text").to_pylist(), width)
        answers = dict(zip(right.column("unit").to_pylist(), right.column("data").to_pylist(), strict=True))
        number = left.column("slice")[0].as_py()
        return pa.Table.from_batches([_candidates(number, found, shards, _estimated(found, shards, answers))])

    kept_schema = pa.schema([("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.string())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        only("digests")
        texts = left.column("text").to_pylist()
        found = Slice(texts, width)
        answers = dict(zip(right.column("unit").to_pylist(), right.column("data").to_pylist(), strict=True))
        own = answers.pop(OWN - left.column("slice")[0].as_py())
        repeated = _flags(zstandard.decompress(own), len(found.first)).copy()
        numbers = np.flatnonzero(repeated)
        for unit, start, stop in _cut(_place(found.first[numbers], shards)[0]):
            repeated[numbers[start:stop]] = _flags(answers[unit], stop - start)
        gone, at, rows = _spans(found, repeated), 0, []
        for value, size in zip(texts, found.sizes, strict=True):
            own, at = gone[at : at + size], at + size
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist()
            spans = list(zip(edges[::2], edges[1::2], strict=True))
            words = (value or "").encode().split()
            for start, stop in reversed(spans):
                del words[start:stop]
            rows.append((size, [{"start": a, "stop": b} for a, b in spans], b" ".join(words).decode()))
        out = [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kept_schema, strict=True)]
        return pa.Table.from_arrays([*(left.column(k) for k in place.values()), *out], [*place.values(), *kept_schema.names])

    def settled(messages: DataFrame, settle) -> DataFrame:
        return messages.repartition(max(slices, 2 * shards), "unit").sortWithinPartitions("unit").mapInArrow(lambda b: _by_unit(b, settle), MESSAGES)

    by_slice = dealt.groupBy("slice")
    counted = settled(by_slice.applyInArrow(sketch, MESSAGES), _merged)
    asked = by_slice.cogroup(counted.repartition(slices, "slice").groupBy("slice")).applyInArrow(_if_texts(estimate, _batch([], [], []).schema), MESSAGES)
    answers = settled(asked, _grouped)
    span = StructType([StructField("start", IntegerType()), StructField("stop", IntegerType())])
    schema = StructType([*(StructField(k, docs.schema[c].dataType) for c, k in place.items()), StructField("n_words", LongType()), StructField("removed", ArrayType(span)), StructField("kept", StringType())])
    out = by_slice.cogroup(answers.repartition(slices, "slice").groupBy("slice")).applyInArrow(_if_texts(cut, kept_schema), schema)
    return out.select(*(F.col(k).alias(c) for c, k in place.items()), "n_words", "removed", "kept")


def _if_texts(function, schema: pa.Schema):
    """Of slices that have texts; others get no answers."""
    return lambda left, right: function(left, right) if left.num_rows else schema.empty_table()


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35) -> DataFrame:
    """`docs` with the repeated windows cut out of `text`; a text that loses nothing stays as it is, null too."""
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no clash with the columns added
    renamed = docs.select(*(F.col(c).alias(p) for c, p in place.items()))
    out = repeated_windows(renamed, place[key], place[text], width, tuple(p for c, p in place.items() if c != key))
    changed = F.when(F.size("removed") > 0, F.col("kept")).otherwise(F.col(place[text]))
    return out.select(*((changed if c == text else F.col(place[c])).alias(c) for c in docs.columns))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: the counts and digests of `repeated_windows`."""
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return repeated_windows(docs, key, text, width).select(key, "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
