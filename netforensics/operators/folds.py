"""Ordered folds: the rows of a key stream through one task in order, only a small state is kept.

For results that are serial by definition (digests, documents). Nothing of a key is collected: Spark
sorts outside memory, and the state has a fixed size however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

BATCH_ROWS = 1024


class Fold:
    """State of one key; `add` takes the values of a row, `result` gives the columns behind the key."""

    def add(self, *values) -> None:
        raise NotImplementedError

    def result(self) -> tuple:
        raise NotImplementedError


def fold(rows: DataFrame, keys: list[str], order: list[str | Column], new: Callable[[], Fold], schema: StructType) -> DataFrame:
    """One row per key: the key columns, then what `new().result()` gives after all its rows in `order`.

    The other columns of `rows` are handed to `add` in their order; `schema` describes the result.
    """
    values = [c for c in rows.columns if c not in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.type for f in pa_schema(schema)]
        key, state, done = None, None, []
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                own = zip(*(part.column(c).to_pylist() for c in keys), strict=True)
                rest = zip(*(part.column(c).to_pylist() for c in values), strict=True)
                for this, row in zip(own, rest, strict=True):
                    if state is None or this != key:
                        if state is not None:
                            done.append((*key, *state.result()))
                        key, state = this, new()
                    state.add(*row)
                if len(done) >= BATCH_ROWS:
                    yield as_rows(done, kinds, schema.names)
                    done = []
        if state is not None:
            done.append((*key, *state.result()))
        if done:
            yield as_rows(done, kinds, schema.names)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def pa_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def as_rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
