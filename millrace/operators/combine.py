"""Aggregation by combiners that built-in functions lack: partial states in each task, merged by key.

A group is never in one task as a whole: its rows become a state where they lie, and only states are shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: States that a task holds; beyond, they are sent on and begun anew.
HELD = 50_000


class Combiner(Protocol):
    """``merge`` of the states of two sets of rows is the state of both, in any order."""

    def of(self, rows: list[tuple]) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    def result(self, state: Any) -> Any: ...


class Stretches:
    """Of integers: the maximal stretches without a gap, as ``(first, last)`` in order, whatever order they come in and however often."""

    schema = "array<struct<first: long, last: long>>"

    def of(self, rows: list[tuple]) -> list[tuple[int, int]]:
        return self._joined([(v, v) for (v,) in rows if v is not None])

    def merge(self, a: list, b: list) -> list:
        return self._joined(a + b)

    def result(self, state: list) -> list[dict]:
        return [{"first": a, "last": b} for a, b in state]

    @staticmethod
    def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out


def combined(df: DataFrame, key: list[str], values: list[str], combiner: Combiner, name: str, kind: str) -> DataFrame:
    """One row per key with ``name``, of type ``kind``: the combiner's result over the group's ``values``; null is a key.

    What is shuffled is a state for each key and task.  The combiner's module must be on the workers' path.
    """
    keys = [df.schema[c] for c in key]
    state = T.StructType([*keys, T.StructField("_state", T.BinaryType())])
    out = T.StructType([*keys, T.StructField(name, T._parse_datatype_string(kind))])
    state_schema, out_schema, n = to_arrow_schema(state), to_arrow_schema(out), len(key)

    def rows_of(held: dict, make, schema: pa.Schema) -> pa.RecordBatch:
        cols = [[k[i] for k in held] for i in range(n)] + [[make(s) for s in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        for b in batches:
            groups: dict[tuple, list] = {}
            for row in zip(*(c.to_pylist() for c in b.columns)):
                groups.setdefault(row[:n], []).append(row[n:])
            for k, rows in groups.items():
                made = combiner.of(rows)
                held[k] = combiner.merge(held[k], made) if k in held else made
            if len(held) > HELD:
                yield rows_of(held, pickle.dumps, state_schema)
                held = {}
        if held:
            yield rows_of(held, pickle.dumps, state_schema)

    def merged(group: pa.Table) -> pa.Table:
        total = None
        for s in group.column("_state").to_pylist():
            total = pickle.loads(s) if total is None else combiner.merge(total, pickle.loads(s))
        k = tuple(group.column(i)[0].as_py() for i in range(n))
        return pa.Table.from_batches([rows_of({k: total}, combiner.result, out_schema)])

    return df.select(*key, *values).mapInArrow(partial, state).groupBy(*key).applyInArrow(merged, out)
