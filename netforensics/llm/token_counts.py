"""Token counts by overlap resynchronisation (operator 3).

A text longer than `chunk` characters is encoded in overlapping chunks with offsets, one after
the other inside its task, so memory stays bounded by a chunk; two neighbours are joined at the
first position of their overlap that both take for the start of a token, that stands at a word
gap (where the encoders start afresh whatever came before) and after which both give the same
tokens up to the next such gap. If there is none, the overlap is widened until there is one or
the text ends. A cell of a table has at most 2 GiB, so the work on one text is bounded as well.

Null texts count as empty, empty texts have no tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import slices, texts
from .word_bpe import ODD_CONTROLS, SPACES, regex, split_words, word_memory

CHUNK, OVERLAP = 1 << 16, 256
WORDS = regex.compile(f"[^{SPACES}]+")


class Encoder:
    """offsets(text): start of every token (or of its word) and the ids. gap(text, p): may p be a joint?"""

    def learn(self, many: list[str]) -> None:
        pass

    def count(self, text: str) -> int:
        return len(self.offsets(text)[1])

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def gap(self, text: str, p: int) -> bool:
        """A single blank between two words: piece encoders attach it to the word that follows."""
        return text[p] == " " and p > 0 and not text[p - 1].isspace() and not text[p + 1 : p + 2].isspace()


class WordEncoder(Encoder):
    """For vocabularies that drop white space: a word's tokens depend on nothing else."""

    def __init__(self, path: str) -> None:
        self.memory = word_memory(path, "ids", lambda _, ids: tuple(ids))

    def learn(self, many: list[str]) -> None:
        self.memory.learn(set().union(*map(split_words, many)))

    def count(self, text: str) -> int:
        return sum(map(len, map(self.memory.__getitem__, split_words(text))))

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        spans = [(m.start(), m[0]) for m in WORDS.finditer(text)]
        self.memory.learn({w for _, w in spans})
        coded = [self.memory[w] for _, w in spans]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        starts = np.repeat(np.fromiter((s for s, _ in spans), np.int64, len(spans)), lengths)
        return starts, np.fromiter((t for ids in coded for t in ids), np.int64, int(lengths.sum()))

    def gap(self, text: str, p: int) -> bool:
        before = text[p - 1 : p]
        return p > 0 and before.isspace() and not ODD_CONTROLS.match(before)


class LibraryEncoder(Encoder):
    """Any other tokenizers file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        coded = self.library.encode(text, add_special_tokens=False)
        return np.array([a for a, _ in coded.offsets], np.int64), np.array(coded.ids, np.int64)


class PieceEncoder(Encoder):
    """A sentencepiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, text: str) -> int:
        return len(self.library.encode(text))

    def offsets(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        pieces = self.library.encode(text, return_type="proto").pieces
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.r_[np.cumsum((data & 0xC0) != 0x80) - 1, len(text)]  # the model's offsets count bytes
        return character[[p.begin for p in pieces]].astype(np.int64), np.array([p.id for p in pieces], np.int64)


def encoder(path: str) -> Encoder:
    if path.endswith(".model"):
        return PieceEncoder(path)
    try:
        return WordEncoder(path)
    except ValueError:
        return LibraryEncoder(path)


def joint(text: str, start: int, stop: int, left: tuple, right: tuple, gap: Callable[[str, int], bool]) -> int | None:
    """The first proven common boundary in text[start:stop]; left and right hold absolute starts and ids.

    The last word of the left side may be cut off by its end, so a boundary needs a later gap.
    """
    zone = [(s[(s >= start) & (s < stop)], t[(s >= start) & (s < stop)]) for s, t in (left, right)]
    (a, ids_a), (b, ids_b) = zone
    common = [p for p in np.intersect1d(a, b).tolist() if gap(text, p)]
    for p, following in zip(common, common[1:], strict=False):
        of_a, of_b = ids_a[(a >= p) & (a < following)], ids_b[(b >= p) & (b < following)]
        if len(of_a) == len(of_b) and (of_a == of_b).all():
            return p
    return None


def count(text: str, enc: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded in chunks if it is long."""
    if len(text) <= chunk:
        return enc.count(text)

    def encoded(start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        starts, ids = enc.offsets(text[start:stop])
        return starts + start, ids

    total, start, valid = 0, 0, 0
    left = encoded(0, chunk + overlap)
    while True:
        cut, wide = start + chunk, overlap
        while True:
            stop = cut + wide
            if stop >= len(text):
                if wide > overlap:
                    left = encoded(start, len(text))
                return total + int((left[0] >= valid).sum())
            right = encoded(cut, stop + chunk)
            if wide > overlap:
                left = encoded(start, stop)
            p = joint(text, max(cut, valid), stop, left, right, enc.gap)
            if p is not None:
                break
            wide *= 4
        total += int(((left[0] >= valid) & (left[0] < p)).sum())
        start, valid, left = cut, p, right if wide == overlap else encoded(cut, cut + chunk + overlap)


def token_counts(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit (n_tokens > limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches, text):
            many = texts(batch, text)
            short = [i for i, t in enumerate(many) if len(t) <= chunk]
            enc.learn([many[i] for i in short])
            counts = [0] * len(many)
            # Short texts first: the chunks of a long one make the memory forget what was just learned.
            for i in [*short, *(i for i, t in enumerate(many) if len(t) > chunk)]:
                counts[i] = count(many[i], enc, chunk, overlap)
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), sizes, pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = StructType(
        [
            StructField("key", docs.schema[key].dataType),
            StructField("n_bytes", LongType()),
            StructField("n_tokens", LongType()),
            StructField("over_limit", BooleanType()),
        ]
    )
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
