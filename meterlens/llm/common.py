"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from meterlens.session import scratch_path

#: Text handled at a time inside a task, so that memory does not follow the
#: number of rows that Spark puts into one Arrow batch.
SLICE_BYTES = 4 << 20
#: Parts whose ids are gathered at a time.
GATHER_PARTS = 1 << 16


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage at a table that survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(
    batch: pa.RecordBatch, text: str = "text", limit: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows holding about ``limit`` bytes of text (``SLICE_BYTES``).

    For a list column, runs of rows with a fourth of that many elements.
    """
    column = batch.column(text)
    if pa.types.is_list(column.type):
        counts = pc.multiply(pc.list_value_length(column), 4)
    else:
        counts = pc.binary_length(column)
    sizes = pc.fill_null(counts, 0).to_pylist()
    limit = SLICE_BYTES if limit is None else limit
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


class _Numbers(dict):
    """Numbers of parts in order of appearance; ``new`` holds those not coded yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = n = len(self)
        self.new.append(part)
        return n


class RecentIds:
    """Ids of text parts: a part is coded when it is first seen, then remembered.

    ``code`` gives the ids of new parts in one array, and where each part's ids start and how many they are.
    All is forgotten between two slices once more than ``parts`` are held.
    """

    def __init__(self, code: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int):
        self.code, self.parts = code, parts
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def _learn(self) -> None:
        ids, start, length = self.code(self.number.new)
        self.number.new.clear()
        self.start = np.concatenate([self.start, len(self.ids) + start])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def encode(self, texts: Iterable[list[str]], tail: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (lists of parts), each with ``tail`` behind, and n + 1 bounds.

        Texts are taken one at a time, so that the parts of one text are in memory and not a slice's.
        """
        if len(self.number) > self.parts:
            self._forget()
        look = self.number.__getitem__
        rows = [np.fromiter(map(look, parts), np.int32, len(parts)) for parts in texts]
        if self.number.new:
            self._learn()
        end = np.array([len(self.start)], np.int32)  # the tail stands behind all parts
        ids = np.concatenate([self.ids, np.frombuffer(tail, "<u4")])
        start = np.append(self.start, len(self.ids))
        length = np.append(self.length, len(tail) // 4)
        found, counts = [ids[:0]], [np.zeros(1, np.int64)]
        size = np.cumsum([len(r) + 1 for r in rows], dtype=np.int64) // GATHER_PARTS
        cuts = np.flatnonzero(np.r_[True, size[1:] != size[:-1], True][: len(rows) + 1])
        for lo, hi in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            order = np.concatenate([x for r in rows[lo:hi] for x in (r, end)])
            n = length[order]
            stop = np.cumsum(n)
            found.append(ids[np.arange(stop[-1]) + np.repeat(start[order] - stop + n, n)])
            last = np.cumsum([len(r) + 1 for r in rows[lo:hi]]) - 1
            counts.append(np.diff(stop[last], prepend=0))
        return np.concatenate(found), np.cumsum(np.concatenate(counts))
