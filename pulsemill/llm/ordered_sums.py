"""Running sums within a key, in order, where one key may hold most of the rows.

Rows are put in ranges of (key, order); each task sums its own range and says where it ended; what
a key brings along from the ranges before is added afterwards. One range ends with one key, so
these carries number no more than the ranges, however many keys or rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.frames import staged


def running_sums(spark: SparkSession, df: DataFrame, key: str, order: list[Column], sums: list[str], label: str) -> DataFrame:
    """``df`` with each column of ``sums`` (longs) replaced by its sum from the key's first row to this one.

    Sums wrap at 64 bits. ``key`` is a column of longs without nulls. Rows alike in key and order are
    summed in any order. The rows are staged once, in order.
    """
    names = df.columns
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_key, held = TaskContext.get().partitionId(), None, dict.fromkeys(sums, 0)
        previous: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch[key])
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            run = np.repeat(starts, np.diff(np.r_[starts, len(keys)]))
            columns = {name: batch[name] for name in batch.schema.names}
            for name in sums:
                values = np.asarray(batch[name]).astype(np.int64).view(np.uint64)
                total = np.cumsum(values, dtype=np.uint64)
                own = total - (total[run] - values[run])
                if keys[0] == open_key:
                    own[run == 0] += np.uint64(held[name])
                held[name] = int(own[-1])
                columns[name] = pa.array(own.view(np.int64))
            open_key = keys[-1]
            if previous is not None:
                yield previous
            marks = {"__part": pa.array(np.full(len(keys), part, np.int32)), "__ends": pa.array(np.zeros(len(keys), bool))}
            previous = pa.RecordBatch.from_pydict(columns | marks)
        if previous is not None:  # the last row of the range
            ends = np.zeros(previous.num_rows, bool)
            ends[-1] = True
            yield previous.set_column(previous.num_columns - 1, "__ends", pa.array(ends))

    ranged = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    rows = staged(spark, ranged.mapInArrow(local, f"{kind}, __part int, __ends boolean"), label)
    carries: dict[int, tuple[int, list[int]]] = {}
    before: tuple[int, list[int]] | None = None
    for end in rows.where("__ends").select("__part", key, *sums).orderBy("__part").toArrow().to_pylist():
        carried = [0] * len(sums)
        if before is not None and before[0] == end[key]:
            carried = before[1]
        if before is not None:
            carries[end["__part"]] = before
        before = end[key], [(a + end[name]) % (1 << 64) for a, name in zip(carried, sums, strict=True)]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = np.asarray(batch[key]), np.asarray(batch["__part"])
            columns = {name: batch[name] for name in names}
            for part in np.unique(parts).tolist():
                if part in carries:
                    mine = (parts == part) & (keys == carries[part][0])
                    if mine.any():
                        for name, carried in zip(sums, carries[part][1], strict=True):
                            values = np.asarray(columns[name]).view(np.uint64).copy()
                            values[mine] += np.uint64(carried)
                            columns[name] = pa.array(values.view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(whole, kind)
