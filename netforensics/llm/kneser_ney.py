"""Interpolated modified Kneser-Ney language model (operator 9).

Bigrams are counted by Spark: a task sums the pairs of its texts and sends them, sorted, as
arrays to buckets; a bucket merges them, stores its bigrams as two sorted arrays (hash, count)
in the shared folder and passes on what its pairs add to contexts and words; a second exchange
completes those and stores them as sorted arrays too. A bucket holds its share of the pairs
whatever the words are: a context is dealt over `spread` buckets by its successors, so frequent
words do not gather in one task. Scoring maps the arrays into memory and looks sorted distinct
pairs up in them; nothing of the model passes through the driver but file names and a few sums.

Tokens are the words of a text with A-Z lowered, then one end; the first token follows a begin
mark. Words are identified by 64-bit hashes. Null and empty texts consist of the end alone.
"""

from __future__ import annotations

import ast
import os
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .blobs import BLOBS, HASHES, blob, by_bucket, dealt, key_bucket, mixed, summed
from .common import only, shared_folder, slices, texts

BEGIN, FINISH = np.uint64(1), np.uint64(2)
PENDING = 4_000_000  # pairs that a task sums before it sends them
# Kinds of rows between the stages: pairs, contexts, words, and notes for the driver.
PAIRS, CONTEXTS, WORDS_KIND, NOTE = 0, 1, 2, 3


def tokens(many: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, and the number of tokens of each text."""
    parts, sizes = [], []
    for text in many:
        words = text.encode().lower().split()
        parts.append(np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words)))
        parts.append(np.array([FINISH]))
        sizes.append(len(words) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def histories(found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.empty_like(found)
    before[1:] = found[:-1]
    before[np.cumsum(sizes) - sizes] = BEGIN
    return before


def in_training(key: object) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 7 != 2


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def _store(folder: str, *arrays: np.ndarray) -> str:
    """Write arrays under a name of this attempt; only names that reach the driver are read."""
    system, base = _system(folder)
    system.create_dir(base, recursive=True)
    name = uuid.uuid4().hex
    for k, a in enumerate(arrays):
        with system.open_output_stream(f"{base}/{name}.{k}") as out:
            out.write(np.ascontiguousarray(a).data)
    return name


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str, k: int, kind: str) -> np.ndarray:
    """An array of the shared folder, mapped into memory; from a remote store by way of a file that is unlinked at once."""
    system, base = _system(folder)
    path = f"{base}/{name}.{k}"
    if system.type_name != "local":
        with tempfile.NamedTemporaryFile() as copy, system.open_input_stream(path) as source:
            shutil.copyfileobj(source, copy)
            copy.flush()
            return np.memmap(copy.name, kind, "r") if os.path.getsize(copy.name) else np.zeros(0, kind)
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


TABLES = {"pairs": ("<u8", "<u4"), "contexts": ("<u8", "<u8", "<u8", "<u8", "<u8"), "words": ("<u8", "<u8", "<u8")}


@dataclass
class Model:
    """Files by table and bucket, and the sums that the formulas need."""

    folder: str
    buckets: int
    files: dict[str, dict[int, str]] = field(default_factory=dict)
    tokens: int = 0
    words: int = 0
    distinct_pairs: int = 0
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_rest: float = 1.0

    def look_up(self, table: str, keys: np.ndarray, buckets: np.ndarray) -> list[np.ndarray]:
        """Values of the keys, 0 where they are missing. Keys are looked up bucket by bucket in ascending order."""
        kinds = TABLES[table]
        out = [np.zeros(len(keys), np.int64) for _ in kinds[1:]]
        order = np.lexsort((keys, buckets))
        numbers, starts = np.unique(buckets[order], return_index=True)
        for number, start, stop in zip(numbers.tolist(), starts.tolist(), [*starts.tolist()[1:], len(order)], strict=True):
            if (name := self.files[table].get(number)) is None:
                continue
            part = order[start:stop]
            sorted_keys = _mapped(self.folder, name, 0, kinds[0])
            at = np.minimum(np.searchsorted(sorted_keys, keys[part]), len(sorted_keys) - 1)
            hit = sorted_keys[at] == keys[part]
            for k, values in enumerate(out):
                values[part[hit]] = _mapped(self.folder, name, k + 1, kinds[k + 1])[at[hit]]
        return out


def _pair_bucket(u: np.ndarray, v: np.ndarray, buckets: int) -> np.ndarray:
    spread = max(4, buckets // 16)
    return ((mixed(u) % np.uint64(buckets) + mixed(v) % np.uint64(spread) * np.uint64(max(1, buckets // spread))) % np.uint64(buckets)).astype(np.int32)


def _discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of entries that occur once to four times."""
    n1, n2, n3, n4 = (max(float(c), 1.0) for c in counts)
    y = n1 / (n1 + 2 * n2)
    clip = lambda value, top: min(max(value, 0.05), top - 0.05)
    return clip(1 - 2 * y * n2 / n1, 1.0), clip(2 - 3 * y * n3 / n2, 2.0), clip(3 - 4 * y * n4 / n3, 3.0)


def discount(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3)]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Count the training documents of `docs` and store the model in the shared folder."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "kneser-ney")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("hashes")
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            u, v = (np.concatenate(x) for x in zip(*held, strict=True))
            _, first, times = np.unique(mixed(u, v), return_index=True, return_counts=True)
            u, v, times = u[first], v[first], times.astype(np.uint32)
            order = np.argsort(u)  # equal contexts side by side take little room once compressed
            u, v, times = u[order], v[order], times[order]
            yield from dealt(PAIRS, _pair_bucket(u, v, buckets), u, v, times)

        for batch in slices(batches):
            chosen = [t for k, t in zip(batch.column("key").to_pylist(), texts(batch), strict=True) if in_training(k)]
            found, sizes = tokens(chosen)
            if len(found):
                held.append((histories(found, sizes), found))
                size += len(found)
            if size >= PENDING:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, parts in by_bucket(batches, {PAIRS: ("<u8", "<u8", "<u4")}):
            u, v, n = parts[PAIRS]
            keys = mixed(u, v)
            order = np.argsort(keys, kind="stable")
            keys, u, v, n = keys[order], u[order], v[order], n[order].astype(np.int64)
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, u, v, n = keys[starts], u[starts], v[starts], np.add.reduceat(n, starts)
            name = _store(folder, keys, np.minimum(n, 0xFFFFFFFF).astype("<u4"))
            contexts = summed(u, n, *((n == k).astype(np.int64) for k in (1, 2)), (n > 2).astype(np.int64))
            words = summed(v, n, np.ones(len(n), np.int64))
            for kind, table in ((CONTEXTS, contexts), (WORDS_KIND, words)):
                yield from dealt(kind, key_bucket(table[0], buckets), table[0], *(c.astype("<u4") for c in table[1:]))
            note = ("pairs", bucket, name, [len(n), int(n.sum()), *((int((n == k).sum())) for k in (1, 2, 3, 4))])
            yield blob(NOTE, bucket, repr(note).encode())

    def merge_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {CONTEXTS: ("<u8", *["<u4"] * 4), WORDS_KIND: ("<u8", "<u4", "<u4")}
        for bucket, parts in by_bucket(batches, kinds, (NOTE,)):
            for note in parts.get(NOTE, []):
                yield blob(NOTE, bucket, note)
            for kind, table in ((CONTEXTS, "contexts"), (WORDS_KIND, "words")):
                if kind in parts:
                    keys, *values = summed(parts[kind][0], *(p.astype(np.int64) for p in parts[kind][1:]))
                    name = _store(folder, keys, *values)
                    last = values[-1]
                    numbers = [len(keys), int(values[0].sum()), *(int((last == k).sum()) for k in (1, 2, 3, 4))]
                    yield blob(NOTE, bucket, repr((table, bucket, name, numbers)).encode())

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(count, BLOBS)
    rows = rows.repartition(buckets, "bucket").mapInArrow(merge_pairs, BLOBS)
    rows = rows.repartition(buckets, "bucket").mapInArrow(merge_tables, BLOBS)

    model = Model(folder, buckets, {table: {} for table in TABLES})
    pair_counts, word_counts = np.zeros(4), np.zeros(4)
    for row in rows.select("data").collect():  # three short notes for each bucket
        table, bucket, name, numbers = ast.literal_eval(row["data"].decode())
        model.files[table][bucket] = name
        if table == "pairs":
            model.distinct_pairs += numbers[0]
            model.tokens += numbers[1]
            pair_counts += numbers[2:]
        elif table == "words":
            model.words += numbers[0]
            word_counts += numbers[2:]
    model.pair_discounts, model.word_discounts = _discounts(pair_counts), _discounts(word_counts)
    d, total = model.word_discounts, max(model.distinct_pairs, 1)
    often = model.words - word_counts[0] - word_counts[1]
    model.word_rest = float(d[0] * word_counts[0] + d[1] * word_counts[1] + d[2] * often) / total if model.words else 1.0
    return model


def probabilities(model: Model, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(v | u) by the model, and the training count of v; for distinct pairs."""
    (pair,) = model.look_up("pairs", mixed(u, v), _pair_bucket(u, v, model.buckets))
    contexts, of_u = np.unique(u, return_inverse=True)
    total, once, twice, often = (x[of_u] for x in model.look_up("contexts", contexts, key_bucket(contexts, model.buckets)))
    words, of_v = np.unique(v, return_inverse=True)
    count, preceded = (x[of_v] for x in model.look_up("words", words, key_bucket(words, model.buckets)))
    d = model.word_discounts
    alone = np.maximum(preceded - discount(preceded, d), 0) / max(model.distinct_pairs, 1) + model.word_rest / (model.words + 1)
    d = model.pair_discounts
    seen = np.maximum(total, 1)
    rest = np.where(total > 0, (d[0] * once + d[1] * twice + d[2] * often) / seen, 1.0)
    return np.maximum(pair - discount(pair, d), 0) / seen + rest * alone, count


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, sizes = tokens(texts(batch))
            before = histories(found, sizes)
            _, first, which = np.unique(mixed(before, found), return_index=True, return_inverse=True)
            p, count = probabilities(model, before[first], found[first])
            starts = np.cumsum(sizes) - sizes
            known = np.add.reduceat((count[which] > 0).astype(np.int64), starts)
            base = np.add.reduceat(np.log10((count[which] + 1) / (model.tokens + model.words + 1)), starts)
            own = np.add.reduceat(np.log10(p)[which], starts)
            held = [not in_training(k) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(held),
                    pa.array(sizes),
                    pa.array(known),
                    pa.array(np.full(len(sizes), model.tokens)),
                    pa.array(base),
                    pa.array(own),
                    pa.array(10 ** np.minimum(-own / sizes, 300)),
                ],
                ["key", *FIELDS],
            )

    kinds = [BooleanType(), LongType(), LongType(), LongType(), DoubleType(), DoubleType(), DoubleType()]
    schema = StructType([StructField("key", docs.schema[key].dataType), *(StructField(n, k) for n, k in zip(FIELDS, kinds, strict=True))])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


FIELDS = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
