"""Merkle fingerprints of documents (operator 10).

Leaves are the segments of a paragraph (sentences), paragraphs are lines, sections are runs of
paragraphs between blank lines or, in texts without blank lines, between paragraphs whose hash
ends a section, so that an edit does not move later borders. A node hashes its children. The
fingerprint is the text of the tree: the root and, for every section, its hash, the hashes of its
paragraphs and of their leaves. Equal texts have equal fingerprints and equal roots; to locate an
edit one descends only into branches that differ. The likeness of two fingerprints is twice the
weight of the leaves they share, over the weight of both, where whole equal sections and
paragraphs are settled by their own hash.

Null texts count as empty: a tree with one empty leaf.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import shared_folder, slices, texts

# A sentence of at least 24 characters, cut after 160.
SEGMENT = re.compile(r".{0,24}[^.!?|]{0,136}[.!?|]*\s*")
SECTION_ENDS = 8  # one paragraph hash in so many ends a section
# Digits of the hashes: root, section, paragraph, leaf.
ROOT, SECTION, PARAGRAPH, LEAF = 32, 16, 16, 8


def _hash(data: bytes, digits: int) -> str:
    return hashlib.blake2b(data, digest_size=digits // 2).hexdigest()


def tree(text: str) -> list[list[list[str]]]:
    """Sections of paragraphs of leaf hashes."""
    sections: list[list[list[str]]] = [[]]
    blank_lines = "\n\n" in text
    for line in text.split("\n"):
        leaves = [_hash(s.encode(), LEAF) for s in SEGMENT.findall(line) if s] or [_hash(b"", LEAF)]
        sections[-1].append(leaves)
        ends = not line.strip() if blank_lines else int(_hash("".join(leaves).encode(), 8), 16) % SECTION_ENDS == 0
        if ends:
            sections.append([])
    if not sections[-1] and len(sections) > 1:
        sections.pop()
    return sections


def fingerprint(text: str) -> str:
    """root;section=paragraph:leaves,paragraph:leaves;section=..."""
    parts = []
    for section in tree(text):
        paragraphs = [(_hash("".join(leaves).encode(), PARAGRAPH), leaves) for leaves in section]
        own = _hash("".join(p for p, _ in paragraphs).encode(), SECTION)
        parts.append(f"{own}=" + ",".join(f"{p}:{''.join(leaves)}" for p, leaves in paragraphs))
    # The root also takes the whole text, so that short leaf hashes never make different texts equal.
    root = _hash("".join(p[:SECTION] for p in parts).encode() + hashlib.blake2b(text.encode()).digest(), ROOT)
    return ";".join([root, *parts])


def _sections(mark: str) -> Counter:
    return Counter(mark.split(";")[1:])


def _paragraphs(sections: Counter) -> Counter:
    out: Counter = Counter()
    for section, n in sections.items():
        for paragraph in section.partition("=")[2].split(","):
            out[paragraph] += n
    return out


def _leaves(paragraphs: Counter) -> Counter:
    out: Counter = Counter()
    for paragraph, n in paragraphs.items():
        leaves = paragraph.partition(":")[2]
        for k in range(0, len(leaves), LEAF):
            out[leaves[k : k + LEAF]] += n
    return out


def likeness(a: str, b: str) -> float:
    """Share of leaves in common, from 0 to 1; settled level by level, 1 only for equal roots."""
    if a == b:
        return 1.0
    of_a, of_b = _sections(a), _sections(b)
    total = sum(_leaves(_paragraphs(of_a)).values()) + sum(_leaves(_paragraphs(of_b)).values())
    shared = 0
    for deeper in (_paragraphs, _leaves):
        common = of_a & of_b
        shared += sum(_leaves(common if deeper is _leaves else _paragraphs(common)).values())
        of_a, of_b = deeper(of_a - common), deeper(of_b - common)
    shared += sum((of_a & of_b).values())
    return min(2 * shared / total, 1 - 1e-6)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(map(fingerprint, texts(batch)), pa.string())], ["key", "fingerprint"])

    schema = StructType([StructField("key", docs.schema[key].dataType), StructField("fingerprint", StringType())])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def edited(text: str, following: str) -> str:
    """`text` with its last third replaced by the beginning of `following`."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(own: str, following: str, mark: str, next_mark: str) -> tuple:
    new = edited(own, following)
    new_mark = fingerprint(new)
    return (len(own), hashlib.sha256(new.encode()).hexdigest(), mark, new_mark, likeness(mark, new_mark), likeness(mark, next_mark))


def edit_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with the next document in descending key order.

    Rows are range-partitioned and sorted by key, so that a document and the next one lie in one
    task. Only the two rows at the ends of each range meet elsewhere: as many as there are ranges.
    After the last document comes the first one. Equal keys are ordered by a hash of the text and the
    text, null keys last; the ranges are drawn by key and hash, so that no texts are sampled.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    by = [F.col("key").desc_nulls_last(), F.xxhash64("text").desc()]
    order = [*by, F.col("text").desc()]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finished rows; besides them the first text of the range (head) and its last document (tail)."""
        last = None

        def out(keys: list, places: list[str], values: list[tuple], loose: list) -> pa.RecordBatch:
            columns = list(zip(*values, strict=True))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), pa.array(places), *map(pa.array, columns, kinds), pa.array(loose, pa.string())],
                ["key", "place", *FIELDS, "loose"],
            )

        none = (None,) * len(FIELDS)
        key_type = None
        for batch in slices(batches):
            key_type = batch.column("key").type
            keys, values = [], []
            for k, own in zip(batch.column("key").to_pylist(), texts(batch), strict=True):
                mark = fingerprint(own)
                if last is None:
                    yield out([k], ["head"], [none], [own])
                else:
                    keys.append(last[0])
                    values.append(_compare(last[1], own, last[2], mark))
                last = (k, own, mark)
            if keys:
                yield out(keys, ["inner"] * len(keys), values, [None] * len(keys))
        if last is not None:
            yield out([last[0]], ["tail"], [none], [last[1]])

    report = StructType(
        [
            StructField("key", kind),
            StructField("place", StringType()),
            StructField("n_chars", LongType()),
            *(StructField(n, StringType()) for n in FIELDS[1:4]),
            *(StructField(n, DoubleType()) for n in FIELDS[4:]),
            StructField("loose", StringType()),
        ]
    )
    found = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*order).mapInArrow(run, report)
    # Compressed, unlike a checkpoint: fingerprints are hex digits. Both reads below get the same ranges.
    path = shared_folder(docs.sparkSession, "fingerprints")
    found.write.option("compression", "zstd").parquet(path)
    found = docs.sparkSession.read.schema(report).parquet(path)

    def join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Heads and tails in order: every tail goes with the head that follows, the last with the first."""
        first = tail = None
        for batch in batches:
            keys, values = [], []
            for k, place, own in zip(batch.column("key").to_pylist(), batch.column("place").to_pylist(), texts(batch, "loose"), strict=True):
                if place == "tail":
                    tail = (k, own, batch.column("key").type)
                    continue
                first = own if first is None else first
                if tail is not None:
                    keys.append(tail[0])
                    values.append(_compare(tail[1], own, fingerprint(tail[1]), fingerprint(own)))
            if keys:
                yield finished(keys, values, batch.column("key").type)
        if tail is not None:
            yield finished([tail[0]], [_compare(tail[1], first, fingerprint(tail[1]), fingerprint(first))], tail[2])

    def finished(keys: list, values: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, key_type), *map(pa.array, list(zip(*values, strict=True)), kinds)], ["key", *FIELDS]
        )

    ends = found.where("place <> 'inner'").select("key", "place", "loose")
    # In key order; within one key a head stands before the tail of the same range.
    sequence = [F.col("key").desc_nulls_last(), F.xxhash64("loose").desc(), F.col("loose").desc(), F.when(F.col("place") == "head", 0).otherwise(1)]
    joined = ends.repartition(1).sortWithinPartitions(*sequence).mapInArrow(join_ends, StructType([f for f in report if f.name not in ("place", "loose")]))
    inner = found.where("place = 'inner'").select("key", *FIELDS)
    return inner.unionByName(joined).withColumnRenamed("key", key)
