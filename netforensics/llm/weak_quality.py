"""Quality classifier from weak labels (operator 5).

Heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over
the counts of all vote patterns of the corpus estimates how reliable each labeller is (a two-class
model, labellers independent given the class) and gives every pattern its posterior of being
good. The posteriors are the targets of a linear scorer over hashed words, word shapes and
repetitions, fitted on a bounded sample of `sample` documents; the scorer judges every document.

There are at most 3^7 patterns, whatever the corpus: the estimation needs no more than their
counts. Null and empty texts have no features and score the intercept; all labellers abstain, and
they are not kept. Rows are judged one by one: repeated rows and null keys come back as they are.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from .common import free_name, only, remembers, slices, texts

# Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = frozenset(
    "a an and as at be by for from in is it of on or that the this to was with "
    "au aux dans de des du elle en est et la le les ou par pour que qui sur un une "
    "auf das dem den der die ein eine ist mit nicht von und zu "
    "al como con del el ella los no por se su una y".split()
)
LABELLERS = ("symbols", "capitals", "variety", "exclamations", "function_words", "bars", "runs")
GOOD, BAD, ABSTAIN = 1, 0, 2
# Labellers are made to spare good documents: their rate of good votes on those is held above this, so that a
# kind of junk that few of them see is not taken for a kind of good documents.
LEAST_GOOD = 0.95
BUCKETS = 1 << 14
SAMPLE = 5_000
PUNCTUATION = ".,;:?!()"
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class _Words(dict):
    """Word -> one number: buckets of letters and shape, two flags and a checksum; forgets when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        low = word.lower()
        core = low if word.isalpha() else low.strip(MARKS)
        marks = "" if core is low else low.replace(core, "", 1)[:4] if core else low[:4]
        upper = word.isupper() and len(core) > 1
        shape = f" {'U' if upper else 'T' if word[:1].isupper() else 'l'}{marks}"
        self[word] = out = (
            zlib.crc32(core.encode()) % BUCKETS
            | zlib.crc32(shape.encode()) % BUCKETS << 14
            | upper << 28
            | (low.strip(PUNCTUATION) in FUNCTION_WORDS) << 29
            | zlib.crc32(word.encode()) << 30
        )
        return out


WORDS = _Words()  # of this worker process
remembers("quality", WORDS.clear)


def coded(words: list[str]) -> np.ndarray:
    return np.fromiter(map(WORDS.__getitem__, words), np.int64, len(words))


def runs(codes: np.ndarray) -> int:
    """Words equal to the one before."""
    return int((codes[1:] == codes[:-1]).sum())


def votes(text: str) -> int:
    """The votes of all labellers as the digits of a number in base 3."""

    def by(value: float, good: float, bad: float) -> int:
        """Good up to `good`, bad from `bad` on, no vote between; the bounds may run downwards."""
        if bad > good:
            return GOOD if value <= good else BAD if value >= bad else ABSTAIN
        return GOOD if value >= good else BAD if value <= bad else ABSTAIN

    words = text.split()
    n = len(words)
    if not n:
        return sum(ABSTAIN * 3**k for k in range(len(LABELLERS)))
    codes = coded(words)
    cast = (
        by(sum(map(text.count, "#*$%&<>")) / n, 0.05, 0.5),
        by(int((codes >> 28 & 1).sum()) / n, 0.15, 0.5) if n >= 5 else ABSTAIN,
        by(len(set(words)) / n, 0.4, 0.2) if 20 <= n <= 2000 else ABSTAIN,
        by(text.count("!") / n, 0.05, 0.5),
        by(int((codes >> 29 & 1).sum()) / n, 0.15, 0.05) if n >= 20 else ABSTAIN,
        by(text.count("|") / n, 0.02, 0.3),
        by(runs(codes) / n, 0.05, 0.3) if n >= 5 else ABSTAIN,
    )
    return sum(v * 3**k for k, v in enumerate(cast))


def estimate(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], dict]:
    """Posterior of good for each pattern, and the estimated share of good documents and vote rates by class."""
    patterns = np.array(sorted(counts), np.int64)
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    cast = (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    voted = cast != ABSTAIN
    good = np.where(voted, cast, 0)
    nays = voted.sum(axis=1) - good.sum(axis=1)
    posterior = 0.9 * 0.3**nays  # to begin with: each vote for bad counts, whoever casts it
    share, rates = 0.5, np.zeros((2, len(LABELLERS)))
    for _ in range(rounds):
        share = min(max(float((weight * posterior).sum() / max(weight.sum(), 1.0)), 1e-3), 1 - 1e-3)
        by_class = np.stack([weight * (1 - posterior), weight * posterior])
        rates = (by_class @ good + [[1.0], [2.0]]) / (by_class @ voted + 3.0)
        rates[1] = np.maximum(rates[1], LEAST_GOOD)
        odds = math.log(share / (1 - share)) + np.where(
            voted, np.where(good == 1, np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))), 0.0
        ).sum(axis=1)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    accuracies = {n: {"good_if_good": float(rates[1, k]), "good_if_bad": float(rates[0, k])} for k, n in enumerate(LABELLERS)}
    return dict(zip(patterns.tolist(), posterior.tolist(), strict=True)), {"share_good": share, "labellers": accuracies}


REPEAT = zlib.crc32(b"repeat") % BUCKETS


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their shares: every word counts for its letters, its shape and if it repeats."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = coded(words)
    at, times = np.unique(np.r_[codes % BUCKETS, codes >> 14 & BUCKETS - 1, np.full(runs(codes), REPEAT)], return_counts=True)
    return at, times / len(words)


def score(text: str, weights: np.ndarray, bias: float) -> float:
    """Probability of being good: the same sum as over `features`."""
    words = text.split()
    total = 0.0
    if words:
        codes = coded(words)
        total = float(weights[codes % BUCKETS].sum() + weights[codes >> 14 & BUCKETS - 1].sum() + runs(codes) * weights[REPEAT]) / len(words)
    return 1 / (1 + math.exp(-min(max(total + bias, -30.0), 30.0)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 8, batch: int = 50, rate: float = 1.0, decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets: passes of small batches in a fixed order, step sizes per weight."""
    weights, bias = np.zeros(BUCKETS), 0.0
    seen, seen_bias = np.full(BUCKETS, 1e-8), 1e-8
    order = np.random.default_rng(0).permutation(len(rows))
    parts = []
    for k in range(0, len(rows), batch):
        part = [rows[i] for i in order[k : k + batch]]
        owner = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
        parts.append((np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part]), owner, np.array([r[2] for r in part])))
    for _ in range(epochs):
        for at, value, owner, target in parts:
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights[at] * value, len(target)) + bias, -30, 30)))
            error = (p - target) / len(target)
            gradient = np.bincount(at, error[owner] * value, BUCKETS) + decay * weights
            seen += gradient**2
            seen_bias += float(error.sum()) ** 2
            weights -= rate * gradient / np.sqrt(seen)
            bias -= 0.1 * rate * float(error.sum()) / math.sqrt(seen_bias)
    return weights, bias


def drawn(docs: DataFrame, sample: int) -> DataFrame:
    """`sample` distinct texts, or all if there are fewer: those of the smallest hashes. Equal texts count once."""
    hashed = docs.where(F.length("text") > 0).select(F.xxhash64("text").alias("hash"))
    least = hashed.distinct().orderBy("hash").limit(sample)
    found = docs.where(F.length("text") > 0).join(F.broadcast(least), F.xxhash64("text") == F.col("hash"), "left_semi")
    return found.groupBy(F.xxhash64("text").alias("hash")).agg(F.min("text").alias("text")).select("text")


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, float, dict]:
    """Weights, intercept and the labeller model. All documents are voted on; `sample` distinct texts fit the scorer."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("quality")
        for batch in slices(batches):
            counts = Counter(map(votes, texts(batch)))
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(counts.keys(), pa.int32()), "n": pa.array(counts.values(), pa.int32())})

    source = docs.select(F.col(text).alias("text"))
    voted = source.mapInArrow(vote, "pattern int, n int").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r["pattern"]: r["n"] for r in voted.collect()}
    posterior, model = estimate(counts)

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(votes(t), *features(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1].astype(np.uint16).tobytes() for r in rows], pa.binary()),
                    pa.array([r[2].astype(np.float32).tobytes() for r in rows], pa.binary()),
                ],
                ["pattern", "at", "value"],
            )

    schema = StructType([StructField("pattern", IntegerType()), StructField("at", BinaryType()), StructField("value", BinaryType())])
    rows = [
        (np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["value"], np.float32).astype(float), posterior[r["pattern"]])
        for r in drawn(source, sample).mapInArrow(shape, schema).collect()
    ]
    weights, bias = fit(rows)
    return weights, bias, model


def with_score(docs: DataFrame, model: tuple[np.ndarray, float, dict], into: str, text: str = "text") -> DataFrame:
    """`docs` with the probability of being good in `into`."""
    weights, bias, _ = model
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(float), bias))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("quality")
        w, b = shared.value
        for batch in slices(batches, text):
            scores = [score(t, w, b) for t in texts(batch, text)]
            yield batch.append_column(into, pa.array(scores, pa.float64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Per row: key, quality_score, kept (score at least `limit`; texts without words are not kept)."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = with_score(rows, train(rows, sample=sample), "quality_score")
    return scored.select(F.col("key").alias(key), "quality_score", _kept("text", "quality_score", limit).alias("kept"))


def _kept(text: str, score: str, limit: float) -> F.Column:
    # What the labellers split at: Unicode's white space and the four separators from FS on.
    has_words = F.col(text).rlike(r"(?U)[^\s\x1c-\x1f]")
    return F.coalesce(has_words, F.lit(False)) & (F.col(score) >= limit)


def keep_good(docs: DataFrame, text: str = "text", limit: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that the classifier keeps; columns unchanged."""
    score, columns = free_name(docs, "quality_score"), docs.columns
    return with_score(docs, train(docs, text, sample), score, text).where(_kept(text, score, limit)).select(columns)
