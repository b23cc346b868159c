"""Near duplicates by a coordinate join of MinHash signatures (operator 6).

Texts with equal shingle sets form a class; only classes are compared. A class has COORDINATES
minimum hashes and is posted under each coordinate-value pair. Two sets of the wanted similarity
agree in at least MATCHES coordinates but for a chance of about one in ten million, so it is
enough that they meet under one of the rarest COORDINATES - MATCHES + 1 pairs of both (prefix
merging; pairs that only one class has come first in that order and lead nowhere, values of
passages that many documents share come last and are mostly skipped). Within a posting list
agreements are counted over a longer signature of one byte per coordinate, and pairs below its
threshold or with sizes too unlike are dropped. What remains is confirmed on the full sets.

Lists are not expanded into all their pairs. First every class proposes the one earlier member
that agrees most; confirmed links give components. Then components that share a list propose
their smallest members. At last only pairs of different components are listed, all of them, so
that no link between components is lost. Long lists are dealt into blocks in the first two steps.
In the last one lists of up to HOT rows are compared as pairs of blocks. A longer list is not: it
holds what shares a passage, and its members are posted anew under the rarest shingles of their
full sets, for each pair of size bands as many as two sets of these sizes and the wanted
similarity must have one in common of. The shingles of a passage that does not make two texts
similar enough are not among them, so the work does not grow with the square of the list.

Sets: distinct shingles of `width` words (A-Z lowered, words are runs of anything but blanks,
tabs and line ends); fewer words: the whole sequence; no words or null: empty and linked with
nothing. The class id is its smallest key; keys must name one text each (repeated rows of the same text are fine).
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from netforensics.session import reliable_checkpoint

from .blobs import HASHES, mixed
from .common import free_name, only, release, slices, texts
from .components import components

COORDINATES, MATCHES = 32, 12
BYTES, BYTE_MATCHES = 128, 78  # at a similarity of 0.8 five standard deviations below the mean
BLOCK = 500
HOT = 4 * BLOCK  # rows of a list beyond which its members meet under shingles
PAIRS_A_PART = 100
SLOTS = 1 << 22  # counters by which shingles are ordered from rare to common
EDGES = [1]  # sizes at which the bands of sizes begin
while EDGES[-1] < 1 << 40:
    EDGES.append(max(EDGES[-1] + 1, EDGES[-1] * 21 // 20))
BROADCAST_IDS = 1_000_000  # ids of 8 bytes; beyond it the join with the texts shuffles

_numbers = np.random.default_rng(7)
FACTORS = _numbers.integers(1 << 30, 1 << 32, BYTES, dtype=np.uint32) | np.uint32(1)
OFFSETS = _numbers.integers(0, 1 << 32, BYTES, dtype=np.uint32)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(codes) - width + 1)
    rolled = codes[:n]
    for k in range(1, min(width, len(codes))):
        rolled = mixed(rolled, codes[k : k + n])
    return np.unique(mixed(rolled, np.uint64(min(width, len(codes)))))


def signature(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minimum of each of BYTES hash functions: values of the first COORDINATES, one byte of all."""
    folded = (found ^ (found >> np.uint64(32))).astype(np.uint32)
    least = np.full(BYTES, np.iinfo(np.uint32).max)
    for at in range(0, len(folded), 256):
        least = np.minimum(least, (folded[at : at + 256, None] * FACTORS + OFFSETS).min(axis=0))
    least = least.astype(np.uint64)
    return least[:COORDINATES], (mixed(least) & np.uint64(255)).astype(np.uint8)


def _rows(docs: DataFrame, width: int) -> DataFrame:
    """key, n_shingles, class hash, posting keys and byte signature of every text with shingles or without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("hashes")
        coordinate = np.arange(COORDINATES, dtype=np.uint64)
        for batch in slices(batches):
            sizes, classes, keys, marks = [], [], [], []
            for text in texts(batch):
                found = shingles(text, width)
                sizes.append(len(found))
                if len(found):
                    values, byte = signature(found)
                    classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    keys.append(mixed(values, coordinate).view(np.int64))
                    marks.append(byte.tobytes())
                else:
                    classes.append(None)
                    keys.append(None)
                    marks.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["key", "n", "cls", "keys", "marks"],
            )

    return docs.mapInArrow(run, "key long, n long, cls binary, keys array<long>, marks binary")


def _lists(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Runs of rows with equal (key, block, other) of sorted batches, as arrays of cid, n, marks and comp."""
    held: pa.Table | None = None

    def runs(table: pa.Table, last: bool) -> Iterator:
        keys = np.stack([table.column(c).to_numpy() for c in names])
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        stops = np.r_[starts[1:], table.num_rows]
        cid, n, comp = (table.column(c).to_numpy() for c in ("cid", "n", "comp"))
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, BYTES)
        side = table.column("side").to_numpy()
        posted = table.column("posted").to_pylist() if "posted" in table.column_names else None
        members = table.column("members").to_pylist() if "members" in table.column_names else None
        whole = len(starts) if last else len(starts) - 1
        for a, b in zip(starts[:whole].tolist(), stops[:whole].tolist(), strict=True):
            if b - a > 1:
                yield [tuple(k[a] for k in keys), cid[a:b], n[a:b], marks[a:b], comp[a:b], side[a:b], members and members[a:b], posted and posted[a:b]]
        return table.slice(int(starts[-1])) if not last else None

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if table.num_rows:
            held = yield from runs(table, False)
    if held is not None and held.num_rows:
        yield from runs(held, True)


def _agreements(n: np.ndarray, marks: np.ndarray, i: int, others: slice) -> np.ndarray:
    """Agreements of member i with the others, 0 for sizes too unlike."""
    count = (marks[others] == marks[i]).sum(axis=1)
    small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
    return np.where(100 * small >= 80 * large, count, 0)


PAIR = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("agree", LongType())])
POSTS = ["cid", "n", "marks", "comp"]


def _emit(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    a, b, agree = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, agree)], ["a", "b", "agree"])


def _best_pairs(posts: DataFrame) -> DataFrame:
    """For each class the earlier member of another component that agrees most, over all its lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int, int]] = []
        for _, cid, n, marks, comp, *_ in _lists(batches, ["key", "block"]):
            for i in range(1, len(cid)):
                count = np.where(comp[:i] != comp[i], _agreements(n, marks, i, slice(0, i)), 0)
                j = int(count.argmax())
                if count[j] >= BYTE_MATCHES:
                    found.append((int(cid[i]), int(cid[j]), int(count[j])))
            if len(found) > 50_000:
                yield _emit(found)
                found = []
        yield _emit(found)

    dealt = posts.repartition("key", "block").sortWithinPartitions("key", "block", "cid")
    pairs = dealt.select("key", "block", *POSTS, F.lit(0).alias("side")).mapInArrow(run, PAIR)
    best = pairs.groupBy("a").agg(F.max(F.struct("agree", (-F.col("b")).alias("b"))).alias("best"))
    return best.select("a", (-F.col("best.b")).alias("b"))


CELL = ["key", "block", "other"]


def _heads(labelled: DataFrame) -> DataFrame:
    """Smallest members of the components of each list, dealt into blocks."""
    heads = labelled.groupBy("key", "comp").agg(F.min(F.struct("cid", "n", "marks")).alias("head"))
    many = heads.groupBy("key").agg(F.count("*").alias("heads")).where("heads > 1").withColumnRenamed("key", "k")
    block = F.pmod(F.xxhash64("head.cid"), F.ceil(F.col("heads") / BLOCK)).cast("int")
    return heads.join(many, F.col("key") == F.col("k")).select("key", block.alias("block"), "comp", "head.cid", "head.n", "head.marks")


def prefixes(found: np.ndarray, counts: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """Posting keys of a set for each pair of size bands, ascending, and the side of the pair that it is on.

    `counts` has 0 for shingles of one component only; they come first in the order and are not posted.

    Sets of the sizes a and s that are similar enough share at least o = percent (a + s) / (100 + percent)
    members, so the first shared one in any common order is among the first a - o + 1 of either.
    """
    size = len(found)
    times = counts[(found % np.uint64(SLOTS)).astype(np.int64)]
    order = np.lexsort((found, times))
    ranked, alone = found[order], int((times == 0).sum())
    own = bisect.bisect_right(EDGES, size) - 1
    least, most = -(-percent * size // 100), 100 * size // percent
    out = []
    for band in range(bisect.bisect_right(EDGES, least) - 1, bisect.bisect_right(EDGES, most)):
        shared = -(-percent * (size + max(EDGES[band], least)) // (100 + percent))
        part = ranked[alone : max(0, size - shared + 1)]
        keys = mixed(part, mixed(np.uint64([min(own, band) << 16 | max(own, band)]))).view(np.int64)
        out.append((np.sort(keys), 2 if own == band else int(own > band)))
    return out


def _by_shingles(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """key, cid, n, marks, comp, posted: posts of `members` (cid, n, marks, comp) under the rarest shingles of their sets."""
    sets = _sets(members.select(F.col("cid").alias("id")), docs, width)
    of = members.select("cid", F.col("comp").alias("group"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("hashes")
        counts, low, high = np.zeros(SLOTS, np.int64), np.full(SLOTS, np.iinfo(np.int64).max), np.full(SLOTS, np.iinfo(np.int64).min)
        for batch in batches:
            for data, group in zip(batch.column("members").to_pylist(), batch.column("group").to_pylist(), strict=True):
                slots = np.unique((np.frombuffer(data, np.uint64) % np.uint64(SLOTS)).astype(np.int64))
                counts[slots] += 1
                low[slots], high[slots] = np.minimum(low[slots], group), np.maximum(high[slots], group)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(x[at]) for x in (counts, low, high))], ["slot", "times", "low", "high"])

    # SLOTS numbers at most. Whatever they are, they give one order to all sets; a slot of one component has no link between two.
    joined = sets.join(of, F.col("id") == F.col("cid")).select("members", "group")
    tallied = joined.mapInArrow(tally, "slot int, times long, low long, high long").groupBy("slot")
    table = tallied.agg(F.sum("times").alias("times"), F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("slot", "times").toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[table.column("slot").to_numpy()] = table.column("times").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, data in zip(batch.column("id").to_pylist(), batch.column("members").to_pylist(), strict=True):
                for keys, side in prefixes(np.frombuffer(data, np.uint64), shared.value, percent):
                    if len(keys):
                        some = pa.array([keys[:COORDINATES]] * len(keys), pa.list_(pa.int64()))
                        columns = [pa.array(keys), pa.array(np.full(len(keys), side, np.int32)), pa.array(np.full(len(keys), cid)), some]
                        yield pa.RecordBatch.from_arrays(columns, ["key", "half", "c", "posted"])

    posts = reliable_checkpoint(sets.mapInArrow(post, "key long, half int, c long, posted array<long>"))
    # Of a pair of bands both must be there.
    several = posts.groupBy("key").agg(F.min("half").alias("lo"), F.max("half").alias("hi"), F.count("*").alias("rows"))
    several = several.where("rows > 1 and (lo <> hi or lo = 2)").select(F.col("key").alias("k"))
    posts = posts.join(several, F.col("key") == F.col("k")).select("key", "c", "posted")
    return posts.join(members, F.col("c") == F.col("cid")).select("key", *POSTS, "posted")


def _cells(posts: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of the lists with different components, once for each pair of blocks that they belong to."""

    def mixed_lists(posts: DataFrame) -> DataFrame:
        lists = posts.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("length"))
        return lists.where("lo <> hi").select(F.col("key").alias("k"), "length")

    lists = reliable_checkpoint(mixed_lists(posts))
    rows = posts.join(lists.where(F.col("length") <= HOT), F.col("key") == F.col("k")).drop("k")
    hot = lists.where(F.col("length") > HOT).select("k")
    if not hot.isEmpty():
        members = posts.join(hot, F.col("key") == F.col("k"), "left_semi").groupBy("cid").agg(*(F.min(c).alias(c) for c in ("n", "marks", "comp")))
        anew = reliable_checkpoint(_by_shingles(reliable_checkpoint(members), docs, width, percent))
        anew = anew.join(mixed_lists(anew), F.col("key") == F.col("k")).drop("k")
        rows = rows.unionByName(anew)
    blocks = F.ceil(F.col("length") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int")).withColumn("meets", F.explode(F.sequence(F.lit(0), blocks - 1)))
    block, other, side = F.least("own", "meets"), F.greatest("own", "meets"), (F.col("own") <= F.col("meets")).cast("int")
    return rows.select("key", block.alias("block"), other.alias("other"), side.alias("side"), *POSTS, "posted")


def _cross_links(posts: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between different components: every pair of a list that agrees often enough is compared on the full sets.

    Long lists are compared as pairs of blocks. A first pass finds the members that have a
    candidate at all; only they get their sets. Of the confirmed links of a pair of blocks a
    spanning forest is returned, so neither pass has a row for each pair.
    """
    rows = _cells(posts, docs, width, percent)

    def wanted(comp: np.ndarray, side: np.ndarray, i: int) -> np.ndarray:
        """Earlier members of other components; of the other block if the cell has two."""
        apart = comp[:i] != comp[i]
        return apart & (side[:i] != side[i]) if side.min() != side.max() else apart

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, cid, n, marks, comp, side, _, posted in _lists(batches, CELL):
            hit = np.zeros(len(cid), bool)
            lists = np.full((len(cid), COORDINATES), np.iinfo(np.int64).max)
            for i, keys in enumerate(posted):
                lists[i, : len(keys)] = keys
            for i in range(1, len(cid)):
                ask = wanted(comp, side, i)
                if ask.any():
                    close = ask & (_agreements(n, marks, i, slice(0, i)) >= BYTE_MATCHES)
                    if close.any():  # a pair that shares several lists is compared in the first of them only
                        at = np.flatnonzero(close)
                        shared = np.where(np.isin(lists[at], posted[i]), lists[at], np.iinfo(np.int64).max)
                        close[at] = shared.min(axis=1) >= cell[0]  # rows name their first lists, maybe not this one
                    hit[:i] |= close
                    hit[i] |= close.any()
            at = np.flatnonzero(hit)
            if len(at):
                fixed = [pa.array(np.full(len(at), v), k) for v, k in zip(cell, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
                columns = [*fixed, pa.array(side[at], pa.int32()), *(pa.array(x[at], pa.int64()) for x in (cid, n)), pa.array([m.tobytes() for m in marks[at]], pa.binary()), pa.array(comp[at], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*CELL, "side", *POSTS])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cid, n, marks, comp, side, members, _ in _lists(batches, CELL):
            sets = [np.frombuffer(m, np.uint64) for m in members]
            distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
            sizes = np.array([len(x) for x in sets])
            starts = np.cumsum(sizes) - sizes
            flag = np.zeros(len(distinct), np.int64)
            group = comp.copy()  # joined as links are found
            found = []
            for i in range(1, len(cid)):
                ask = wanted(group, side, i)
                if not ask.any() or not (ask & (_agreements(n, marks, i, slice(0, i)) >= BYTE_MATCHES)).any():
                    continue
                own = flat[starts[i] : starts[i] + sizes[i]]
                flag[own] = 1
                both = np.add.reduceat(flag[flat[: starts[i]]], starts[:i])
                flag[own] = 0
                linked = ask & (100 * both >= percent * (sizes[:i] + sizes[i] - both))
                for j in np.flatnonzero(linked).tolist():
                    if group[j] != group[i]:
                        found.append((int(max(cid[i], cid[j])), int(min(cid[i], cid[j])), 0))
                        group[group == group[j]] = group[i]
            yield _emit(found)

    dealt = rows.repartition(*CELL).sortWithinPartitions(*CELL, "cid").select(*CELL, "side", *POSTS, "posted")
    types = "key long, block int, other int, side int, cid long, n long, marks binary, comp long"
    hits = reliable_checkpoint(dealt.mapInArrow(candidates, types))
    release(docs.sparkSession)
    sets = _sets(hits.select(F.col("cid").alias("id")).distinct(), docs, width)
    rows = hits.join(sets, F.col("cid") == F.col("id")).repartition(*CELL).sortWithinPartitions(*CELL, "cid")
    return rows.select(*CELL, "side", *POSTS, "members").mapInArrow(compare, PAIR).select("a", "b").distinct()


def _sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """id and members (sorted 64-bit hashes) of the texts with these keys."""
    ids = reliable_checkpoint(ids)
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    found = docs.join(F.broadcast(ids) if few else ids, F.col("key") == F.col("id")).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(t, width).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], ["id", "members"])

    return found.dropDuplicates(["key"]).mapInArrow(run, "id long, members binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = reliable_checkpoint(pairs)
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = _sets(ends, docs, width).repartition("id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # All near copies of a text propose it: its set is sent once for each PAIRS_A_PART of its pairs.
    parts = pairs.groupBy(F.col("b").alias("idb")).agg(F.ceil(F.count("*") / PAIRS_A_PART).alias("parts"))
    several = parts.where("parts > 1")
    left = sets.select(F.col("id").alias("ida"), F.col("members").alias("of_a"))
    right = sets.select(F.col("id").alias("idb"), F.col("members").alias("of_b"))
    salted = pairs.join(several, F.col("b") == F.col("idb"), "left").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).alias("part")
    )
    right = right.join(parts, "idb").withColumn("part_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    joined = salted.join(left, F.col("a") == F.col("ida")).join(right, (F.col("b") == F.col("idb")) & (F.col("part") == F.col("part_b")))
    return joined.select("a", "b", "of_a", "of_b").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept (the row whose key names its component).

    `percent` is the similarity in hundredths that links; the counts of agreements are made for 80 and
    hold for more as well. Rows with a null key are kept alone. Keys are whole numbers; others are refused.
    """
    if percent < 80:
        raise ValueError("the signature thresholds are made for a similarity of 0.8 and more")
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} has to be a whole number")
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = reliable_checkpoint(_rows(source, width))
    classes = (
        rows.where(F.col("cls").isNotNull() & F.col("key").isNotNull())
        .groupBy("cls")
        .agg(F.min("key").alias("cid"), F.max("n").alias("n"), F.min("marks").alias("marks"), F.min("keys").alias("keys"))
    )
    classes = reliable_checkpoint(classes)
    # Posting lists: a pair that only one class has is counted, but not posted.
    posted = classes.select("cid", F.explode("keys").alias("key"))
    lengths = posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1").withColumnRenamed("key", "k")
    shared = posted.join(lengths, F.col("key") == F.col("k")).groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("length", "key"))).alias("shared"))
    prefix = COORDINATES - MATCHES + 1
    kept = F.greatest(F.size("shared") - (COORDINATES - prefix), F.lit(0))
    chosen = shared.where(F.size("shared") >= MATCHES).select(F.col("cid").alias("c"), F.slice("shared", 1, kept).alias("posts"))
    chosen = chosen.select("c", F.col("posts.key").alias("posted"), F.explode("posts").alias("post"))
    posts = chosen.join(classes.select("cid", "n", "marks"), F.col("c") == F.col("cid"))
    posts = reliable_checkpoint(posts.select(F.col("post.key").alias("key"), F.col("post.length").alias("length"), "cid", "n", "marks", "posted"))
    blocks = F.ceil(F.col("length") / BLOCK)
    alone = posts.withColumn("comp", F.col("cid")).withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    release(docs.sparkSession)
    links = reliable_checkpoint(_confirmed(_best_pairs(alone), source, width, percent))

    def labelled(found: DataFrame) -> DataFrame:
        parts = components(found)
        return posts.join(parts, F.col("cid") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "cid")).drop("id", "component")

    links = reliable_checkpoint(links.unionByName(_confirmed(_best_pairs(_heads(labelled(links))), source, width, percent)))
    release(docs.sparkSession)
    links = links.unionByName(_cross_links(labelled(links).drop("length"), source, width, percent))
    parts = components(links)
    of_class = classes.join(parts, F.col("cid") == F.col("id"), "left").select("cls", F.coalesce("component", "cid").alias("component"))
    found = rows.select("key", "n", "cls").join(of_class.withColumnRenamed("cls", "c"), F.col("cls") == F.col("c"), "left")
    component = F.coalesce("component", "key")
    return found.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row's document of each group of near duplicates; columns unchanged."""
    own = free_name(docs, "_gone")
    gone = near_duplicates(docs.select(key, text), key, text, width, percent).where("not kept").select(F.col(key).cast("long").alias(own))
    gone = reliable_checkpoint(gone)
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, F.col(key).cast("long") == F.col(own), "left_anti")
