"""Removal of repeated byte strings by column-wise suffix-array construction (operator 1).

A byte is removed if a string of `length` bytes that covers it also starts earlier: in a document
with a smaller key, or earlier in the same one. The suffixes are never sorted as one collection:

1. Every string of `length` bytes has an anchor, the least hash of the grams inside it. Equal
   strings have equal anchors, so runs of neighbouring strings with one anchor (segments) are dealt
   to buckets by it. An anchor that occurs once can't belong to a repeat. Equal segments
   are recognised by their hash and all but the first are settled at once, in the task that reads
   them and then among the tasks.
2. Different segments with one anchor may still overlap in whole strings. Their bytes are
   fetched, and each bucket builds the suffix order of its collection column by column: round t
   inserts the suffixes of length t of all segments at once, one symbol for each, at the rows that
   the Burrows-Wheeler transform of the round before gives for them, and updates the common
   prefixes of neighbouring rows with range minima. Each round is a sequential pass over the arrays
   of the bucket; the buckets are the files of a Spark exchange.
   An anchor with more than HOT different segments (a line with many neighbours) is not built in
   one collection: its strings are dealt by anchor and hash of the whole string, and equal ones
   are recognised by it, as equal segments are.
3. Rows in a common prefix of `length` bytes are equal strings; all but the first are settled.
4. The settled strings of each document are merged to spans and cut out.

Null texts count as empty. Rows with a null key are left whole and are compared with nothing.
Keys must be unique; repeated rows of one key and text are treated alike and do not count as
repeats of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from netforensics.session import reliable_checkpoint

from .blobs import BLOBS, blob, by_bucket, dealt, key_bucket, mixed
from .common import as_batch, only, slices, texts

GRAM = 32
STRETCH = 1 << 17  # bytes that are hashed at once
PENDING = 600_000  # segments that a task gathers before it sends them
BATCH = 1_000  # segments of one construction, more only for one anchor
HOT = 20_000  # different segments of an anchor beyond which its strings are dealt by their hashes
BROADCAST_IDS = 1_000_000
SELF = 1 << 31  # mark in the number of strings: the anchor occurs twice in the segment
SEGMENTS, SETTLED, ASKED, CONTENTS = 0, 1, 2, 3
SEGMENT = ("<u8", "<u8", "<i8", "<u4", "<u4")  # anchor, content hash, key, start, strings
SPAN = ("<i8", "<u4", "<u4")  # key, first string, strings
ASK = ("<i8", "<u4", "<u4", "<u8")  # key, first string, strings, anchor


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as they have been needed."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            base = 0x9E3779B97F4A7C15
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64)])


POWERS = _Powers()
BYTE_HASHES = mixed(np.arange(256, dtype=np.uint64), np.uint64(99))


def segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of documents laid end to end: document number, start in `data`, strings (with SELF), anchor, content hash."""
    none = tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    n = len(data) - length + 1
    if n < 1:
        return none
    with np.errstate(over="ignore"):
        grams = BYTE_HASHES[data]
        for k in (1, 2, 4, 8, 16):
            grams = mixed_step(grams[:-k], grams[k:], k)
        span, width = length - GRAM + 1, 1
        least = grams
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))[:n]
        at = np.flatnonzero(np.arange(n) + length <= ends[owner])
        if not len(at):
            return none
        value, doc = least[at], owner[at]
        first = np.r_[True, (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(at)])
        if sizes.max() > span:  # periodic text: cut long runs
            parts = -(-sizes // span)
            which = np.repeat(np.arange(len(starts)), parts)
            step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
            starts, sizes = starts[which] + step * span, np.minimum(span, sizes[which] - step * span)
        begin = at[starts]
        # Does the anchor occur twice in a segment? Then it may repeat a string by itself.
        reach = sizes + span - 1
        offset = np.cumsum(reach) - reach
        places = np.arange(int(reach.sum())) + np.repeat(begin - offset, reach)
        own = np.add.reduceat(grams[places] == np.repeat(value[starts], reach), offset, dtype=np.int64) > 1
        POWERS.to(len(data) + 1)
        sums = np.cumsum(np.r_[np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * POWERS.up[: len(data)]])
        content = mixed((sums[begin + sizes + length - 1] - sums[begin]) * POWERS.down[begin], sizes.astype(np.uint64))
    return doc[starts], begin, sizes | np.where(own, SELF, 0), value[starts], content


def mixed_step(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    x = a * np.uint64(0xBF58476D1CE4E5B9 + 2 * k) + b
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def _stretches(keys: list, data: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int]], np.ndarray]]:
    """Bytes of several documents laid end to end, where each piece comes from, and where it ends.

    A document longer than a stretch is cut so that every string lies in one piece.
    """
    parts: list[bytes] = []
    origin: list[tuple[int, int]] = []
    held = 0
    for key, text in zip(keys, data, strict=True):
        for at in range(0, max(1, len(text) - length + 1), STRETCH):
            piece = text[at : at + STRETCH + length - 1]
            if key is None or len(piece) < length:
                continue
            parts.append(piece)
            origin.append((key, at))
            held += len(piece)
            if held >= STRETCH:
                yield np.frombuffer(b"".join(parts), np.uint8), origin, np.cumsum([len(p) for p in parts])
                parts, origin, held = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), origin, np.cumsum([len(p) for p in parts])


def suffix_rows(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of a collection of strings laid end to end, built column by column.

    Per row, in order: the string, the length of the suffix, and the length of the prefix that it has in common
    with the row before. Ends of strings sort before all symbols and are all different.
    """
    ends = np.asarray(ends)
    n = len(ends)
    sizes = np.diff(np.r_[0, ends])
    alphabet, coded = np.unique(symbols, return_inverse=True)
    coded = (coded + 1).astype(np.uint8 if len(alphabet) < 255 else np.uint16)
    # Round 0: the empty suffixes. The transform holds the symbol before each suffix, 0 if there is none.
    transform = np.where(sizes > 0, coded[np.maximum(ends - 1, 0)], 0).astype(coded.dtype)
    string = np.arange(n, dtype=np.int32)
    size = np.zeros(n, np.uint8 if len(sizes) and sizes.max() < 256 else np.int32)
    common = np.zeros(n, size.dtype)
    row = np.arange(n)  # of the latest suffix of each string that goes on
    live = np.flatnonzero(sizes > 0)
    row = row[live]
    for t in range(1, int(sizes.max()) + 1 if n else 1):
        order = np.argsort(transform, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        free = len(order) - np.count_nonzero(transform)
        r = rank[row]
        target = n + r - free
        by_row = np.argsort(row)
        at, r, target, who = row[by_row], r[by_row], target[by_row], live[by_row]
        symbol = transform[at]
        # Neighbours that begin with the same symbol, and the common prefix with them: one more than
        # the least common prefix between the rows that they extend.
        padded = np.r_[common, common[:1]]
        left = order[np.maximum(r - 1, 0)]
        has_left = (r > free) & (transform[left] == symbol)
        with_left = _between(padded, left[has_left] + 1, at[has_left] + 1)
        right = order[np.minimum(r + 1, len(order) - 1)]
        has_right = (r + 1 < len(order)) & (transform[right] == symbol)
        with_right = _between(padded, at[has_right] + 1, right[has_right] + 1)
        total = len(order) + len(at)
        old = np.ones(total, bool)
        old[target] = False

        def spread(values: np.ndarray, new: np.ndarray | int) -> np.ndarray:
            out = np.empty(total, values.dtype)  # noqa: B023
            out[old] = values  # noqa: B023
            out[target] = new  # noqa: B023
            return out

        goes_on = sizes[who] > t
        before = np.where(goes_on, coded[np.maximum(ends[who] - t - 1, 0)], 0)
        transform, string, size = spread(transform, before), spread(string, who), spread(size, t)
        common = spread(common, 0)
        after = target + 1
        inside = after < total
        common[after[inside]] = 0
        common[after[has_right]] = with_right + 1
        common[target] = 0
        common[target[has_left]] = with_left + 1
        live, row = who[goes_on], target[goes_on]
    return string, size, common


def _between(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of values[start:stop] for each pair, start < stop."""
    if not len(start):
        return values[:0]
    return np.minimum.reduceat(values, np.stack([start, stop], 1).ravel())[::2]


def repeated(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Key and start of every string of `length` bytes of the segments that also starts earlier in one of them."""
    string, size, common = suffix_rows(symbols, ends)
    joined = common >= length
    if not joined.any():
        return keys[:0], starts[:0]
    inside = joined | np.r_[joined[1:], False]
    group = np.cumsum(~joined)[inside]
    string, size = string[inside], size[inside]
    key, at = keys[string], starts[string] + (np.diff(np.r_[0, ends])[string] - size)
    order = np.lexsort((at, key, group))
    group, key, at = group[order], key[order], at[order]
    head = np.r_[True, group[1:] != group[:-1]]
    which = np.cumsum(head) - 1
    again = (key != key[head][which]) | (at != at[head][which])
    return key[again], at[again]


def _first_of_equal(anchor: np.ndarray, content: np.ndarray, key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by anchor, content and place, which entries of it are the first of equal ones, and which start later."""
    order = np.lexsort((start, key, content, anchor))
    anchor, content, key, start = (x[order] for x in (anchor, content, key, start))
    head = np.r_[True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])]
    which = np.cumsum(head) - 1
    return order, head, (key != key[head][which]) | (start != start[head][which])


def strings_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, place in it and hash of every string of the segments laid end to end."""
    POWERS.to(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.cumsum(np.r_[np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * POWERS.up[: len(data)]])
        begin = np.r_[0, ends[:-1]]
        counts = ends - begin - length + 1
        which = np.repeat(np.arange(len(ends)), counts)
        place = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begin[which] + place
        return which, place, mixed((sums[at + length] - sums[at]) * POWERS.down[at], np.uint64(length))


def _spans(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring strings of a document as spans."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] > at[:-1] + 1)]) if len(key) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(key)] - 1 if len(key) else first
    return key[first], at[first], at[last] - at[first] + 1


def _by_document(rows: DataFrame, kinds: dict[int, tuple], buckets: int, names: dict[int, str]) -> DataFrame:
    """Blobs dealt by document to one row per document: id and, for each kind, its sorted entries without the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_bucket(batches, kinds):
            entries: dict[str, dict[int, bytes]] = {}
            ids = np.unique(np.concatenate([p[0] for p in parts.values()]))
            for kind, (key, *values) in parts.items():
                order = np.lexsort((values[0], key))
                record = np.empty(len(key), [(f"f{i}", v.dtype) for i, v in enumerate(values)])
                for i, v in enumerate(values):
                    record[f"f{i}"] = v[order]
                key = key[order]
                begin = np.searchsorted(key, ids, "left")
                end = np.searchsorted(key, ids, "right")
                entries[names[kind]] = [record[a:b].tobytes() if b > a else None for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            for a in range(0, len(ids), 5000):
                part = ids[a : a + 5000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), *(pa.array(entries[c][a : a + 5000] if c in entries else [None] * len(part), pa.binary()) for c in names.values())],
                    ["id", *names.values()],
                )

    return rows.repartition(buckets, "bucket").mapInArrow(run, "id long, " + ", ".join(f"{c} binary" for c in names.values()))


def _with_marks(docs: DataFrame, marks: DataFrame) -> tuple[DataFrame, bool]:
    """`docs` (key, ...) of the marked documents with their marks; and whether only their texts moved."""
    ids = marks.select(F.col("id").alias("i"))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    wanted = docs.join(F.broadcast(ids), F.col("key") == F.col("i"), "left_semi") if few else docs
    return wanted.join(marks, F.col("key") == F.col("id")).drop("id"), few


def settled_strings(docs: DataFrame, length: int = 100) -> DataFrame:
    """id and `spans` (start and number of strings, both 32 bits) of the documents (key, text) with repeats."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        held: list[tuple] = []
        size = 0
        for batch in slices(batches):
            data = [t.encode() for t in texts(batch)]
            for stretch, origin, ends in _stretches(batch.column("key").to_pylist(), data, length):
                doc, begin, strings, anchor, content = segments(stretch, ends, length)
                key, base = (np.array(x, np.int64) for x in zip(*origin, strict=True))
                start = begin - np.r_[0, ends[:-1]][doc] + base[doc]
                held.append((anchor, content, key[doc], start.astype("<u4"), strings.astype("<u4")))
                size += len(doc)
            if size >= PENDING:
                yield from send(held)
                held, size = [], 0
        if size:
            yield from send(held)

    def send(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        yield from combined(*(np.concatenate(x) for x in zip(*held, strict=True)), by_content=False)

    def combined(anchor, content, key, start, strings, by_content: bool) -> Iterator[pa.RecordBatch]:
        """The first of equal segments is sent, the later ones are settled."""
        order, head, again = _first_of_equal(anchor, content, key, start)
        anchor, content, key, start, strings = (x[order] for x in (anchor, content, key, start, strings))
        if again.any():
            yield from settled(key[again], start[again], strings[again] & (SELF - 1))
        rest = [x[head] for x in (anchor, content, key, start, strings)]
        yield from dealt(SEGMENTS, key_bucket(mixed(rest[0], rest[1]) if by_content else rest[0], buckets), *rest)

    def settled(key: np.ndarray, start: np.ndarray, strings: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from dealt(SETTLED, key_bucket(key.astype(np.uint64), buckets), key, start, strings)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_bucket(batches, {SEGMENTS: SEGMENT, SETTLED: SPAN}):
            if SETTLED in parts:
                yield from settled(*parts[SETTLED])
            if SEGMENTS not in parts:
                continue
            anchor, content, key, start, strings = parts[SEGMENTS]
            _, which, times = np.unique(anchor, return_inverse=True, return_counts=True)
            twice = (times[which] > 1) | (strings >= SELF)
            anchor, content, key, start, strings = (x[twice] for x in (anchor, content, key, start, strings))
            if not len(anchor):
                continue
            order, head, again = _first_of_equal(anchor, content, key, start)
            anchor, key, start, strings = (x[order] for x in (anchor, key, start, strings))
            if again.any():
                yield from settled(key[again], start[again], strings[again] & (SELF - 1))
            anchor, key, start, strings = anchor[head], key[head], start[head], strings[head]
            _, which, times = np.unique(anchor, return_inverse=True, return_counts=True)
            several = (times[which] > 1) | (strings >= SELF)
            if several.any():
                hot = np.where(times[which] > HOT, SELF, 0).astype("<u4")
                strings = (strings & (SELF - 1)) | hot
                yield from dealt(ASKED, key_bucket(key[several].astype(np.uint64), buckets), key[several], start[several], strings[several].astype("<u4"), anchor[several])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, hot = [], []
            for key, text, asked in zip(batch.column("key").to_pylist(), texts(batch), batch.column("asked").to_pylist(), strict=True):
                data = text.encode()
                for start, strings, anchor in np.frombuffer(asked, "<u4,<u4,<u8").tolist():
                    (hot if strings & SELF else rows).append((anchor, key, start, data[start : start + (strings & (SELF - 1)) + length - 1]))
            for at in range(0, len(hot), 5_000):
                anchor, key, start, content = zip(*hot[at : at + 5_000], strict=True)
                which, place, hashes = strings_of(np.frombuffer(b"".join(content), np.uint8), np.cumsum([len(c) for c in content]), length)
                starts = (np.array(start, np.int64)[which] + place).astype("<u4")
                yield from combined(np.array(anchor, np.uint64)[which], hashes, np.array(key, np.int64)[which], starts, np.ones(len(which), "<u4"), by_content=True)
            if rows:
                anchor, key, start, content = zip(*rows, strict=True)
                anchors = np.array(anchor, np.uint64)
                bucket = key_bucket(anchors, buckets)
                for number in np.unique(bucket).tolist():
                    part = np.flatnonzero(bucket == number).tolist()
                    head = (anchors[part], np.array([key[i] for i in part], np.int64), np.array([start[i] for i in part], np.uint32), np.array([len(content[i]) for i in part], np.uint32))
                    data = b"".join([len(part).to_bytes(8, "little"), *(x.tobytes() for x in head), *(content[i] for i in part)])
                    yield blob(CONTENTS, number, data)

    def construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in by_bucket(batches, {SEGMENTS: SEGMENT, SETTLED: SPAN}, (CONTENTS,)):
            if SETTLED in parts:
                yield from settled(*parts[SETTLED])
            if SEGMENTS in parts:
                anchor, content, key, start, _ = parts[SEGMENTS]
                order, _, again = _first_of_equal(anchor, content, key, start)
                if again.any():
                    keys, at, strings = _spans(key[order][again], start[order][again].astype(np.int64))
                    yield from settled(keys, at.astype("<u4"), strings.astype("<u4"))
            if CONTENTS not in parts:
                continue
            heads, bodies = [], []
            for data in parts[CONTENTS]:
                n = int.from_bytes(data[:8], "little")
                at, head = 8, []
                for kind in ("<u8", "<i8", "<u4", "<u4"):
                    head.append(np.frombuffer(data, kind, n, at))
                    at += n * np.dtype(kind).itemsize
                heads.append(head)
                ends = np.cumsum(head[3], dtype=np.int64) + at
                bodies += [data[e - s : e] for e, s in zip(ends.tolist(), head[3].tolist(), strict=True)]
            anchor, key, start, sizes = (np.concatenate(x) for x in zip(*heads, strict=True))
            order = np.argsort(anchor, kind="stable")
            borders = np.flatnonzero(np.r_[True, np.diff(anchor[order]) != 0, True])
            found, first = [], 0
            for border in borders[1:].tolist():
                if border - first >= BATCH or border == len(order):
                    part = order[first:border]
                    symbols = np.frombuffer(b"".join([bodies[i] for i in part.tolist()]), np.uint8)
                    found.append(repeated(key[part], start[part].astype(np.int64), np.cumsum(sizes[part], dtype=np.int64), symbols, length))
                    first = border
            keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(keys):
                keys, at, strings = _spans(keys, at)
                yield from dealt(SETTLED, key_bucket(keys.astype(np.uint64), buckets), keys, at.astype("<u4"), strings.astype("<u4"))

    rows = docs.mapInArrow(cut, BLOBS).repartition(buckets, "bucket").mapInArrow(match, BLOBS)
    marks = reliable_checkpoint(_by_document(rows, {SETTLED: SPAN, ASKED: ASK}, buckets, {SETTLED: "spans", ASKED: "asked"}))
    asking, _ = _with_marks(docs, marks.where("asked is not null").select("id", "asked"))
    rest = asking.mapInArrow(fetch, BLOBS).repartition(buckets, "bucket").mapInArrow(construct, BLOBS)
    more = _by_document(rest, {SETTLED: SPAN}, buckets, {SETTLED: "more"}).withColumnRenamed("id", "m")
    both = marks.where("spans is not null").select("id", "spans").join(more, F.col("id") == F.col("m"), "full")
    none = F.lit(b"")
    both = both.select(F.coalesce("id", "m").alias("id"), F.concat(F.coalesce("spans", none), F.coalesce("more", none)).alias("spans"))
    return reliable_checkpoint(both)


def removed(size: int, spans: bytes | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a document."""
    if not spans:
        return []
    pairs = np.frombuffer(spans, "<u4").reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    begin, end = pairs[:, 0], np.maximum.accumulate(np.minimum(pairs[:, 0] + pairs[:, 1] + length - 1, size))
    first = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return list(zip(begin[first].tolist(), end[np.r_[first[1:], len(end)] - 1].tolist(), strict=True))


def _remaining(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _both(docs: DataFrame, marks: DataFrame) -> list[DataFrame]:
    """All documents with their spans (null: none), as parts that together are the whole."""
    marked, few = _with_marks(docs, marks)
    if few:
        ids = F.broadcast(marks.select(F.col("id").alias("i")))
        return [marked, docs.join(ids, F.col("key") == F.col("i"), "left_anti").withColumn("spans", F.lit(None).cast("binary"))]
    return [docs.join(marks, F.col("key") == F.col("id"), "left").drop("id")]


def repeats_report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans and kept_sha256 of the remaining bytes."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marks = settled_strings(source, length)
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.string()], strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for k, t, spans in zip(batch.column("key").to_pylist(), texts(batch), batch.column("spans").to_pylist(), strict=True):
                data = t.encode()
                runs = removed(len(data), spans, length)
                rows.append((k, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_remaining(data, runs)).hexdigest()))
            yield as_batch(dict(zip(names, zip(*rows, strict=True) if rows else [[]] * 5, strict=True)), kinds)

    schema = StructType([*(StructField(n, LongType()) for n in names[:4]), StructField("kept_sha256", StringType())])
    parts = [p.select("key", "text", "spans").mapInArrow(run, schema) for p in _both(source, marks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("key", key)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """`docs` with the repeated strings cut out of `text`; columns unchanged.

    A character goes if all its bytes go, so texts stay valid; null texts stay null.
    """
    columns = docs.columns
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marks = settled_strings(source, length).select("id", F.col("spans").alias("spans"))
    rows = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(columns)})
    place = columns.index(text)
    rows = rows.withColumn("key", F.col(f"c{columns.index(key)}").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{place}"):
            out = []
            for t, spans in zip(batch.column(f"c{place}").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if not spans or t is None:
                    out.append(t)
                    continue
                data = t.encode()
                out.append(_remaining(data, whole_characters(data, removed(len(data), spans, length))).decode())
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, pa.string())).select(list(range(len(columns))))

    schema = StructType([f for f in rows.drop("key").schema])
    parts = [p.select(*(f"c{i}" for i in range(len(columns))), "spans").mapInArrow(run, schema) for p in _both(rows, marks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(columns)})


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without characters of which a byte stays."""
    out = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        if b < len(data) and data[b] & 0xC0 == 0x80:
            while b > a and data[b - 1] & 0xC0 == 0x80:
                b -= 1
            b -= 1
        if a < b:
            out.append((a, b))
    return out
