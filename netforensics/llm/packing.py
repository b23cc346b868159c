"""Vector best-fit packing of documents into sequences (operator 7).

Documents become pieces of at most `tokens` ids. Pieces are dealt into groups of a bounded size
and packed within them, longest first: every open sequence has a residual of tokens, documents
and attention cost (the sum of squared piece lengths), and among the sequences in which a piece
fits in every one of the three, the rule picks one: "norm" the least weighted norm of what
would be left, "dot" the largest weighted product of piece and residual. Sequences that a group
could not fill well are taken apart once more and packed in groups that gather the poorly filled
sequences of many groups, so the number of groups hardly costs sequences.

Null texts count as empty; every document has its end id, so no piece is empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from netforensics.session import reliable_checkpoint

from .common import slices, texts
from .word_bpe import split_words, word_memory

GROUP_ROWS = 5_000


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence, the weights of the three residuals and the rule that picks a sequence."""

    tokens: int = 4096
    documents: int = 4096
    cost: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"
    well_filled: float = 0.995

    def check(self) -> None:
        if self.cost < self.tokens * self.tokens or self.documents < 1:
            raise ValueError("a full piece must fit into an empty sequence")


def pieces(docs: DataFrame, path: str, tokens: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text", words_kept: int = 700_000) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32 and slot (a number that spreads equal rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_memory(path, "bytes", lambda _, ids: pack_ids(f"<{len(ids)}I", *ids), words_kept)
        end = np.array([end_id], "<u4").tobytes()
        slot = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in slices(batches, text):
            words = list(map(split_words, texts(batch, text)))
            memory.learn(set().union(*words))
            rows: list[tuple] = []
            for i, ws in enumerate(words):
                data = b"".join(map(memory.__getitem__, ws)) + end
                for k, at in enumerate(range(0, len(data), 4 * tokens)):
                    part = data[at : at + 4 * tokens]
                    slot += 1
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), slot))
            take, *rest = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(take, pa.int32())), *map(pa.array, rest, kinds)],
                ["key", "piece", "start", "length", "ids_crc32", "slot"],
            )

    schema = StructType(
        [
            StructField("key", docs.schema[key].dataType),
            StructField("piece", IntegerType()),
            *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "slot")),
        ]
    )
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def best_fit(lengths: np.ndarray, limit: Capacity) -> np.ndarray:
    """Sequence number of each piece, longest pieces first."""
    caps = np.array([limit.tokens, limit.documents, limit.cost], float)
    weights = np.array(limit.weights)
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(lengths), np.int64)
    left = np.empty((len(lengths), 3))  # residuals of the open sequences, as shares of the capacities
    number = np.empty(len(lengths), np.int64)
    n_open = made = 0
    for i in order.tolist():
        size = np.array([lengths[i], 1.0, float(lengths[i]) ** 2]) / caps
        rest = left[:n_open] - size
        fits = np.flatnonzero((rest >= -1e-12).all(axis=1))
        if len(fits):
            score = -(weights * rest[fits] ** 2).sum(axis=1) if limit.rule == "norm" else left[fits] @ (weights * size)
            j = int(fits[np.argmax(score)])
            left[j] = rest[j]
        else:
            j, n_open = n_open, n_open + 1
            left[j], number[j] = 1 - size, made
            made += 1
        out[i] = number[j]
        if left[j, 0] < 0.5 / limit.tokens or left[j, 1] < 0.5 / limit.documents:  # full: the last one takes its place
            n_open -= 1
            left[j], number[j] = left[n_open], number[n_open]
    return out


def _packed(rows: DataFrame, limit: Capacity, turn: int, last: bool) -> DataFrame:
    """Pack each group; `open` marks pieces of sequences that another turn should take apart."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("slot", "ascending")])
        lengths = table.column("length").to_numpy()
        sequence = best_fit(lengths, limit)
        order = np.argsort(sequence, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.r_[True, sequence[order][1:] != sequence[order][:-1]] if len(order) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(first, ends - lengths[order], 0))
        offset = np.empty(len(order), np.int64)
        offset[order] = ends - lengths[order] - base
        filled = np.bincount(sequence, lengths, minlength=1)[sequence]
        group = table.column("grp")[0].as_py()
        made = {
            "sequence_id": pa.array((sequence << 32) + (group << 1) + turn),
            "offset": pa.array(offset),
            "open": pa.array((filled < limit.well_filled * limit.tokens) & (not last)),
        }
        for name, values in made.items():
            table = table.append_column(name, values)
        return table.drop_columns(["grp"])

    fields = [*rows.drop("grp").schema.fields, *(StructField(n, LongType()) for n in ("sequence_id", "offset"))]
    return rows.groupBy("grp").applyInArrow(run, StructType([*fields, StructField("open", BooleanType())]))


def _dealt(rows: DataFrame, count: int) -> DataFrame:
    """Deal rows into groups of about GROUP_ROWS, whatever their keys are."""
    return rows.withColumn("grp", F.pmod(F.xxhash64("slot"), F.lit(max(1, -(-count // GROUP_ROWS)))).cast("long"))


def pack(docs: DataFrame, path: str, limit: Capacity | None = None, key: str = "doc_id", text: str = "text", end_id: int = 1, words_kept: int = 700_000) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    A worker remembers `words_kept` words (two generations of about 200 bytes a word); fewer only cost time.
    """
    limit = limit or Capacity()
    limit.check()
    rows = reliable_checkpoint(pieces(docs, path, limit.tokens, end_id, key, text, words_kept))
    total = rows.count()
    once = total <= GROUP_ROWS
    first = reliable_checkpoint(_packed(_dealt(rows, total), limit, 0, once))
    columns = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    if once:
        return first.select(columns)
    remaining = first.where("open").select(rows.columns)
    second = _packed(_dealt(remaining, remaining.count()), limit, 1, True)
    return first.where("not open").unionByName(second).select(columns)
