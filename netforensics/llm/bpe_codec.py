"""BPE encoding and decoding of whole texts (operator 2), by the method of `word_bpe`.

Null texts count as empty; an empty text has no ids. The lists of a text of any length are
built in one row, words are looked up in a bounded memory of the worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import slices, texts
from .word_bpe import WordBpe, split_words, word_memory


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with the ids of `text` as array<int> in `into` (replaced if it exists)."""
    kept = docs.drop(into)
    schema = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_memory(path, "ids", lambda _, ids: tuple(ids))
        for batch in slices(batches, text):
            words = list(map(split_words, texts(batch, text)))
            memory.learn(set().union(*words))
            ids = [[t for w in ws for t in memory[w]] for ws in words]
            yield batch.append_column(into, pa.array(ids, schema))

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(into, ArrayType(IntegerType()))]))


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`docs` with the library's decoding of `ids`: token texts joined by a blank. Null lists give null."""
    kept = docs.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordBpe(path).tokens
        for batch in batches:
            lists = batch.column(ids)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            parts = tokens[flat].tolist()
            at, out = 0, []
            for n in (None if v is None else len(v) for v in lists.to_pylist()):
                out.append(None if n is None else " ".join(parts[at : at + n]))
                at += n or 0
            yield batch.append_column(into, pa.array(out, pa.string()))

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(into, StringType())]))


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, SHA-256 of the decimal ids and of the decoded text.

    The same encoder as `encode`, but each remembered word carries its ids and its decoded form as
    finished text, so a row is two joins instead of two lists of numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def render(coder: WordBpe, ids: list[int]) -> tuple[str, str]:
            return " ".join(map(str, ids)), " ".join(coder.tokens[ids])

        memory = word_memory(path, "digests", render)
        for batch in slices(batches, text):
            words = list(map(split_words, texts(batch, text)))
            memory.learn(set().union(*words))
            counts, of_ids, of_text = [], [], []
            for ws in words:
                pairs = [memory[w] for w in ws]
                ids = " ".join([p[0] for p in pairs])
                counts.append(ids.count(" ") + 1 if ids else 0)
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_text.append(hashlib.sha256(" ".join([p[1] for p in pairs]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = StructType(
        [
            StructField("key", docs.schema[key].dataType),
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
        ]
    )
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def ids_text(ids: str | Column) -> Column:
    """Decimal ids joined by one blank."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")
