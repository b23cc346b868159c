"""Chain of custody: case manifests, hash chains and their verification."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from netforensics.operators.folds import Fold, fold
from netforensics.session import reliable_checkpoint
from netforensics.sources.lines import case_from_path
from netforensics.vocab import GENESIS


def canonical_json(columns: Sequence[str]) -> Column:
    """Row text with sorted names and explicit NULLs."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def chain_positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add chain_pos, the 0-based place of a row in its case.

    Rows are range-partitioned by (case, order), so a large case spans many partitions; places
    are counted per partition and shifted by the counts before it. The partitioning is fixed by
    a checkpoint because the counts and the rows are read separately.
    """
    ranged = rows.repartitionByRange("case_id", *order).withColumn("_part", F.spark_partition_id())
    fixed = reliable_checkpoint(ranged)
    before = Window.partitionBy("case_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy("case_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy("case_id", "_part").orderBy(*order)
    place = F.col("_offset") + F.row_number().over(inside) - 1
    return fixed.join(offsets, ["case_id", "_part"]).withColumn("chain_pos", place).drop("_part", "_offset")


def segment_seed(seed: Column, segment: Column) -> Column:
    """Segment 0 starts from the case seed, a later one from the seed and its number."""
    later = F.sha2(F.concat(seed, F.lit(":"), segment.cast("string")), 256)
    return F.when(segment == 0, seed).otherwise(later)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, prev = None, ""
    for batch in batches:
        names = batch.schema.names
        cases = batch.column(names.index("case_id")).to_pylist()
        segments = batch.column(names.index("chain_segment")).to_pylist()
        seeds = batch.column(names.index("_start")).to_pylist()
        texts = batch.column(names.index("row_text")).to_pylist()
        hashes = []
        for case, segment, seed, text in zip(cases, segments, seeds, texts):
            if (case, segment) != key:
                key, prev = (case, segment), seed
            prev = hashlib.sha256((prev + text).encode()).hexdigest()
            hashes.append(prev)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], [*names, "evidence_hash"])


def hash_chain(
    rows: DataFrame, order: Sequence[str], text: str = "row_text", seed: str | None = None,
    segment_rows: int | None = None,
) -> DataFrame:
    """Add chain_pos and evidence_hash with h(i) = sha256(h(i-1) + row text) per case.

    A chain is serial by definition: a case of any size is one plain chain, whose rows stream through
    a task in order; nothing is collected. Only a caller that passes `segment_rows` has cases cut into
    segments of so many rows, each a chain of its own from a seed derived from the case seed and
    named in its rows (`chain_segment`); `seal_segments` binds them.
    """
    base = rows.withColumn("row_text", F.col(text)) if text != "row_text" else rows
    base = base.withColumn("_seed", F.coalesce(F.col(seed), F.lit(GENESIS)) if seed else F.lit(GENESIS))
    placed = chain_positions(base, order)
    segment = F.floor(F.col("chain_pos") / segment_rows) if segment_rows else F.lit(0).cast("bigint")
    ready = (
        placed.withColumn("chain_segment", segment)
        .withColumn("_start", segment_seed(F.col("_seed"), F.col("chain_segment")))
        .repartition("case_id", "chain_segment")
        .sortWithinPartitions("case_id", "chain_segment", "chain_pos")
    )
    schema = StructType([*ready.schema.fields, StructField("evidence_hash", StringType())])
    return ready.mapInArrow(_fold, schema).drop("_start").withColumnRenamed("_seed", "chain_seed")


def seal_segments(chained: DataFrame) -> DataFrame:
    """One row per case: the hash over its segment tails, in order (a case has few segments)."""
    tails = chained.groupBy("case_id", "chain_segment").agg(
        F.max(F.struct("chain_pos", "evidence_hash")).alias("t"), F.first("chain_seed").alias("chain_seed")
    )
    order = F.array_sort(F.collect_list(F.struct("chain_segment", F.col("t.evidence_hash").alias("h"))))
    sealed = tails.groupBy("case_id").agg(
        order.alias("tails"), F.first("chain_seed").alias("seed"), (F.max("t.chain_pos") + 1).alias("rows")
    )
    folded = F.aggregate("tails", F.col("seed"), lambda acc, t: F.sha2(F.concat(acc, t["h"]), 256))
    return sealed.select("case_id", "rows", F.size("tails").alias("segments"), folded.alias("seal"))


def verify_chain(
    chained: DataFrame, segment_rows: int | None = None, text: Column | None = None, record: DataFrame | None = None
) -> DataFrame:
    """(case_id, rows, is_valid, first_broken): fully parallel, each row against its predecessor.

    Every position from 0 on must be there exactly once, so removed, repeated and swapped rows show.
    `text` recomputes the row text from the event columns, so an edited column shows although
    `row_text` was kept. `record` (case_id, rows, seal: the stored result of `seal_segments`) shows
    removed last rows, rewritten chains and missing cases. Segments are those written in the rows
    (`chain_segment`); `segment_rows` is only needed for rows without it.

    The predecessor comes from an equi join on (case, position), so a long chain is no hot key.
    `first_broken` is -1 for a valid chain.
    """
    segment = F.floor(F.col("chain_pos") / segment_rows) if segment_rows else F.lit(0).cast("bigint")
    segment = F.col("chain_segment") if "chain_segment" in chained.columns else segment
    shown = F.col("row_text") if text is None else text
    needed = chained.select(
        "case_id", "chain_pos", "chain_seed", "row_text", "evidence_hash", segment.alias("_segment"),
        F.coalesce(shown != F.col("row_text"), F.lit(True)).alias("_edited"),
    )
    places = needed.groupBy("case_id", "chain_pos").agg(
        F.count(F.lit(1)).alias("_times"), F.min("evidence_hash").alias("_hash"), F.min("_segment").alias("_of")
    )
    own = places.select("case_id", "chain_pos", "_times")
    previous = places.select(
        "case_id", (F.col("chain_pos") + 1).alias("chain_pos"), F.col("_hash").alias("_prev"), F.col("_of").alias("_before")
    )
    starts = (F.col("chain_pos") == 0) | (F.col("_before") != F.col("_segment"))
    before = F.when(starts, segment_seed(F.col("chain_seed"), F.col("_segment"))).otherwise(F.col("_prev"))
    expected = F.sha2(F.concat(before, F.col("row_text")), 256)
    missing = (F.col("chain_pos") > 0) & F.col("_prev").isNull()
    bad = F.coalesce(expected != F.col("evidence_hash"), F.lit(True)) | missing | (F.col("_times") > 1) | F.col("_edited")
    # A missing row breaks the chain at its own place, not at that of the row behind the gap.
    place = F.when(missing, F.col("chain_pos") - 1).otherwise(F.col("chain_pos"))
    checked = (
        needed.join(own, ["case_id", "chain_pos"])
        .join(previous, ["case_id", "chain_pos"], "left")
        .withColumn("_bad", bad)
        .groupBy("case_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("_bad"), place)).alias("_first"))
    )
    if record is not None:
        stored = record.select("case_id", F.col("rows").alias("_rows"), F.col("seal").alias("_stored"))
        seals = seal_segments(chained).select("case_id", "seal") if "chain_segment" in chained.columns else None
        if seals is None:
            raise ValueError("a record can only be compared with rows that carry their segment")
        cut = F.coalesce((F.col("rows") != F.col("_rows")) | (F.col("seal") != F.col("_stored")), F.lit(True))
        known = F.coalesce("rows", F.lit(0))
        checked = (
            checked.join(seals, "case_id", "left").join(stored, "case_id", "full")
            .withColumn("_first", F.coalesce("_first", F.when(cut, F.least(known, F.coalesce("_rows", known)))))
            .withColumn("rows", known)
        )
    return checked.select(
        "case_id", "rows", F.col("_first").isNull().alias("is_valid"), F.coalesce("_first", F.lit(-1)).cast("bigint").alias("first_broken")
    )


def shared_file(path: str) -> BinaryIO:
    """A file of the shared file system, opened for reading ranges (local, HDFS, S3 and what else Arrow knows)."""
    if path.startswith(("/", "file:")):
        return pa.fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inside = pa.fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def file_digest(stream: BinaryIO, size: int, range_bytes: int) -> str:
    """SHA-256 of a file, read one byte range after the other; shorter than `size` is an error."""
    digest, left = hashlib.sha256(), size
    while left:
        part = stream.read(min(range_bytes, left))
        if not part:
            raise EOFError(f"{left} bytes are missing")
        digest.update(part)
        left -= len(part)
    return digest.hexdigest()


def hash_inputs(
    spark: SparkSession, path: str | list[str], range_bytes: int = 8 << 20, opener: Callable[[str], BinaryIO] = shared_file
) -> DataFrame:
    """(case_id, role, path, sha256, size_bytes) of evidence files of any size, below `path`.

    Only paths and lengths are rows; a task reads its files range by range and keeps the state of one
    digest, so memory does not depend on the size of a file. `opener` opens a path in a store that
    Arrow does not know.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # A scan passes over empty files, the listing that Spark keeps for it has them.
    listed = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in found.inputFiles()]
    sizes = found.select("path", "length")
    files = spark.createDataFrame(listed, "path string").join(sizes, "path", "left").select("path", F.coalesce("length", F.lit(0)).alias("length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size in zip(*(batch.column(c).to_pylist() for c in ("path", "length")), strict=True):
                with opener(name) as stream:
                    digest = file_digest(stream, size, range_bytes)
                yield pa.RecordBatch.from_pydict({"path": [name], "size_bytes": [size], "sha256": [digest]})

    # Dealt by path: the listing comes in few partitions, and reading the files is the work.
    hashed = files.repartition("path").mapInArrow(run, "path string, size_bytes long, sha256 string")
    role = (
        F.when(F.col("path").endswith(".log"), "zeek_log")
        .when(F.col("path").rlike(r"\.pcap(ng)?$"), "pcap").otherwise("sample")
    )
    return hashed.select(case_from_path(F.col("path")).alias("case_id"), role.alias("role"), "path", "sha256", "size_bytes")


class _Identity(Fold):
    """Digest of the text {"inputs":[sorted hashes],"parameters":...} as its parts come in."""

    def __init__(self):
        self.digest, self.inputs, self.bytes, self.parameters, self.between = hashlib.sha256(b'{"inputs":["'), 0, 0, "", ""

    def add(self, sha256, size_bytes, parameters) -> None:
        self.inputs, self.bytes, self.parameters = self.inputs + 1, self.bytes + (size_bytes or 0), parameters
        if sha256 is not None:
            self.digest.update((self.between + sha256).encode())
            self.between = '","'

    def result(self) -> tuple:
        self.digest.update(f'"],"parameters":{self.parameters}}}'.encode())
        return self.inputs, self.bytes, self.digest.hexdigest()


def case_manifest(inputs: DataFrame, parameters: Column | None = None) -> DataFrame:
    """Deterministic case identity from the sorted input hashes and the parameters, not from time.

    The hashes of a case stream in order into one digest; they are never gathered.
    """
    rows = inputs.select(
        "case_id", "sha256", "size_bytes", (parameters if parameters is not None else F.lit("{}")).alias("parameters")
    )
    schema = StructType([rows.schema["case_id"]]).add("inputs", "long").add("total_bytes", "long").add("manifest_id", "string")
    return fold(rows, ["case_id"], ["sha256"], _Identity, schema)
