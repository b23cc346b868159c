"""Ranked lexical search by the Best Position Algorithm (operator 11).

Every text is cut into terms once; the postings of the terms that the query set holds go into an index
of a few arrays per batch of documents, written to the shared folder. Statistics of the corpus (N, L
and the document frequencies) are sums over this index. The batches are then dealt into shards of about
POSTINGS postings each; a shard sorts them into impact lists, one for each term, highest impact first,
and ranks its documents for every item:

* Each list is read from the top, some positions at a time. A document met in one list is looked up in
  all others (direct access), which gives its whole score and its position in them.
* The best position of a list is the end of its unbroken run of seen positions from the top, whichever
  way they were seen, so it lies at or below the position last read. A document not seen yet scores at
  most the weighted sum of the impacts behind the best positions: the threshold.
* Reading stops when the threshold is strictly below the k-th score, or when nothing unseen can score
  above 0. Documents that tie with the k-th are all seen then.

The k best of the shards meet in one ranking per item, which keeps only k of a task before the shuffle.
The query set is streamed through the driver in blocks of BLOCK_BYTES of text, which bounds the
vocabulary that is sent to the tasks; the documents and their postings never pass through the driver.

Null texts have no terms. Items without terms and documents without a term of an item return nothing.
Repeated items, repeated documents and null ids are rows of their own; null ids rank last among equals.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from netforensics.session import reliable_checkpoint

from .common import only, slices, texts

POSTINGS = 1 << 20
BLOCK_BYTES = 16 << 20
FIRST_READ = 32  # positions of the first turn; every turn reads twice as many as the one before

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_CLEAN = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII; only A-Z are lowered."""
    return (text or "").encode().translate(_CLEAN).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


INDEX = "documents long, terms long, postings long, data binary"


def _pack(**arrays: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays.values()], list(arrays))
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


KINDS = {"ids": np.int64, "known": np.bool_, "sizes": np.int64, "counts": np.int32, "numbers": np.int32, "tf": np.int32}


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return {name: np.frombuffer(batch.column(name)[0].as_py(), kind) for name, kind in KINDS.items()}


def index(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Postings of the terms in `vocabulary`, one row per batch of documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        number = known.value
        for batch in slices(batches):
            documents = total = 0
            ids, sizes, counts, numbers, tfs = [], [], [], [], []
            for one, value in zip(batch.column("key").to_pylist(), texts(batch), strict=True):
                found = terms(value)
                if not found:
                    continue
                documents, total = documents + 1, total + len(found)
                own = [(number[t], n) for t, n in Counter(found).items() if t in number]
                if own:
                    ids.append(one)
                    sizes.append(len(found))
                    counts.append(len(own))
                    numbers += [t for t, _ in own]
                    tfs += [n for _, n in own]
            data = _pack(
                ids=np.array([0 if i is None else i for i in ids], np.int64), known=np.array([i is not None for i in ids], bool),
                sizes=np.array(sizes, np.int64), counts=np.array(counts, np.int32), numbers=np.array(numbers, np.int32), tf=np.array(tfs, np.int32),
            )
            yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [total], "postings": [len(tfs)], "data": [data]})

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, INDEX)


def frequencies(indexed: DataFrame, size: int) -> dict[int, int]:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                count += np.bincount(_unpack(data)["numbers"], minlength=size)
        found = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(count[found], pa.int64())], ["term", "df"])

    counted = indexed.select("data").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in counted.collect()}


class ImpactLists:
    """The impact lists of a shard: for each term its documents by falling impact, and a way to look up any of them."""

    def __init__(self, parts: list[dict[str, np.ndarray]], documents: int, total: int):
        part = {name: np.concatenate([p[name] for p in parts]) for name in KINDS}
        self.ids, self.known = part["ids"], part["known"]
        doc = np.repeat(np.arange(len(self.ids)), part["counts"])
        m = 75 + (25 * part["sizes"] * documents) // max(1, total)
        score = impact(part["tf"].astype(np.int64), m[doc])
        order = np.lexsort((doc, -score, part["numbers"]))
        self.docs, self.scores, numbers = doc[order], score[order], part["numbers"][order]
        heads = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else np.zeros(0, np.int64)
        stops = np.append(heads[1:], len(numbers))
        self.lists = {t: (a, b) for t, a, b in zip(numbers[heads].tolist(), heads.tolist(), stops.tolist(), strict=True)}
        # Direct access: of every list, its documents ascending and where they stand.
        self.places = np.lexsort((self.docs, numbers))
        self.sorted = self.docs[self.places]

    def look_up(self, span: tuple[int, int], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `docs` are in a list, and their positions in it."""
        start, stop = span
        at = np.minimum(np.searchsorted(self.sorted[start:stop], docs), stop - start - 1)
        hit = np.flatnonzero(self.sorted[start + at] == docs)
        return hit, self.places[start + at[hit]] - start


def best_positions(shard: ImpactLists, query: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents of the k highest scores and all that tie with the last, their scores, and how many were seen.

    `query` gives the weight of each term, repeats multiplied in.
    """
    lists = [(shard.lists[t], w) for t, w in query.items() if w and t in shard.lists]
    seen = [np.zeros(stop - start + 1, bool) for (start, stop), _ in lists]  # one more, never seen, behind the end
    best = [0] * len(lists)
    met = np.zeros(len(shard.ids), bool)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    read, step = 0, FIRST_READ
    while True:
        new = np.concatenate([shard.docs[start + read : min(stop, start + read + step)] for (start, stop), _ in lists] or [docs])
        new = np.unique(new[~met[new]])
        met[new] = True
        own = np.zeros(len(new), np.int64)
        bound = 0
        for i, ((start, stop), w) in enumerate(lists):
            seen[i][read : min(stop - start, read + step)] = True
            if len(new):
                hit, places = shard.look_up((start, stop), new)
                own[hit] += w * shard.scores[start + places]
                seen[i][places] = True
            best[i] += int(np.argmin(seen[i][best[i] :]))
            if best[i] < stop - start:
                bound += w * int(shard.scores[start + best[i]])
        docs, scores = np.append(docs, new), np.append(scores, own)
        kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
        if bound == 0 or (len(scores) >= k and bound < kth):
            keep = np.flatnonzero((scores > 0) & (scores >= kth))
            return docs[keep], scores[keep], len(docs)
        read, step = read + step, 2 * step


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, size = [], 0
    for row in items.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).toLocalIterator():
        found = terms(row["text"])
        if found:
            block.append((row["key"], found))
            size += len(row["text"])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


FOUND = "query long, item_id long, doc_id long, score long, seen long"


def _search_block(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int, key: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in block for t in found}))}
    indexed = reliable_checkpoint(index(docs, vocabulary, key, text))
    documents, total, postings = (x or 0 for x in indexed.agg(F.sum("documents"), F.sum("terms"), F.sum("postings")).first())
    weights = {t: weight(documents, df) for t, df in frequencies(indexed, len(vocabulary)).items()}
    queries = []
    for item, found in block:
        repeats = Counter(vocabulary[t] for t in found)
        queries.append((item, {t: n * weights[t] for t, n in repeats.items() if weights.get(t)}))
    sent = spark.sparkContext.broadcast(queries)
    shards = max(1, -(-postings // POSTINGS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
            lists = ImpactLists(parts, documents, total)
            rows = []
            for number, (item, query) in enumerate(sent.value):
                found, scores, n = best_positions(lists, query, k)
                # Ties with the last place go by id, so that a common score does not send its documents all.
                order = np.lexsort((lists.ids[found], ~lists.known[found], -scores))[:k]
                for d, s in zip(found[order].tolist(), scores[order].tolist(), strict=True):
                    rows.append((number, item, int(lists.ids[d]) if lists.known[d] else None, s, n))
            names = ("query", "item_id", "doc_id", "score", "seen")
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))

        only()
        shard, held = None, []
        for batch in batches:
            for s, data in zip(batch.column("shard").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if s != shard and held:
                    yield ranked(held)
                    held = []
                shard = s
                held.append(_unpack(data))
        if held:
            yield ranked(held)

    dealt = indexed.where("postings > 0").select(F.pmod(F.xxhash64("data"), F.lit(shards)).alias("shard"), "data")
    return dealt.repartition(max(shards, 2), "shard").sortWithinPartitions("shard").mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each item the k documents of the highest score above 0.

    Equal scores rank by ascending id. `seen` is the number of documents that the item's search of
    this document's shard had to score before it could stop.
    """
    for df, name in ((docs, key), (items, item_key)):
        if not isinstance(df.schema[name].dataType, IntegralType):
            raise TypeError(f"{name} has to be a whole number")
    spark, out = docs.sparkSession, None
    for number, block in enumerate(_blocks(items, item_key, item_text)):
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = _search_block(docs, block, k, key, text).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = found.select("item_id", "rank", "doc_id", "score", "seen")
        out = found if out is None else reliable_checkpoint(out).unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long, seen long")
