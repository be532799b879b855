"""Batch-keyed tables: a batch is stored once, with its counters, however often it is written.

A batch is written aside (``_staging`` of its table), its counters beside its
rows; then the rows are moved to ``batch_id=<n>`` in one rename, and last the counters
to ``_counts``.  A reader, also a stream, sees a whole batch or none.  Whoever
writes a batch may be stopped at any point and write it again: rows that were moved
stay as they are, and a batch that has its counters is left alone.

On a store without an atomic rename (an object store), a table has to be read
through :func:`read_batches`, which reads those batches only that have their
counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlens.session import child_names, move_path, path_exists, remove_path

BATCH = "batch_id"
COUNTS = "_counts"


def batch_path(target: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/{BATCH}={int(batch_id)}"


def batch_counts(spark: SparkSession, target: str, names: list[str]) -> DataFrame:
    """``batch_id`` and the counters of every stored batch."""
    root = target.rstrip("/")
    schema = ", ".join(f"`{n}` long" for n in (BATCH, *names))
    if not path_exists(spark, f"{root}/{COUNTS}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{root}/{COUNTS}")


def ingest_totals(spark: SparkSession, target: str, names: list[str]) -> DataFrame:
    """One row: the sums of the counters over all batches, exact after any restart."""
    return batch_counts(spark, target, names).agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)
    )


def stored_counts(spark: SparkSession, target: str, batch_id: int) -> dict[str, int] | None:
    """The counters of a stored batch; None when it is not stored."""
    path = f"{target.rstrip('/')}/{COUNTS}/{BATCH}={int(batch_id)}"
    if not path_exists(spark, path):
        return None
    row = spark.read.json(path).first()
    return {k: v for k, v in row.asDict().items() if k != BATCH}


def write_batch(
    rows: DataFrame,
    target: str,
    batch_id: int,
    measures: dict[str, Column],
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> dict[str, int]:
    """Store ``rows`` as batch ``batch_id`` of the table ``target``; returns its counters.

    ``measures`` (aggregates by name) are observed while writing.
    """
    spark = rows.sparkSession
    done = stored_counts(spark, target, batch_id)
    if done is not None:
        return done
    root = target.rstrip("/")
    aside = f"{root}/_staging/{BATCH}={int(batch_id)}"
    place, counted = batch_path(root, batch_id), f"{root}/{COUNTS}/{BATCH}={int(batch_id)}"
    if path_exists(spark, place) and not path_exists(spark, f"{aside}/rows"):
        # an earlier try moved all rows, and was stopped before their counters
        move_path(spark, f"{aside}/counts", counted)
        return stored_counts(spark, root, batch_id)
    seen = Observation(f"{BATCH}-{int(batch_id)}")
    observed = rows.observe(seen, *(m.alias(n) for n, m in measures.items()))
    writer = observed.write.mode("overwrite").format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{aside}/rows")
    counts = {n: int(v) for n, v in seen.get.items()}
    store_counts(spark, f"{aside}/counts", batch_id, counts)
    remove_path(spark, place)  # what a store without atomic renames left of an earlier move
    move_path(spark, f"{aside}/rows", place)
    move_path(spark, f"{aside}/counts", counted)
    remove_path(spark, aside)
    return counts


def store_counts(spark: SparkSession, path: str, batch_id: int, counts: dict[str, int]) -> None:
    fields = ", ".join(f"`{n}` long" for n in (BATCH, *counts))
    row = spark.createDataFrame([(int(batch_id), *counts.values())], fields)
    row.coalesce(1).write.mode("overwrite").json(path)


def stored_batches(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the stored batches (of their counters' folder names)."""
    names = child_names(spark, f"{target.rstrip('/')}/{COUNTS}")
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in names if n.startswith(f"{BATCH}="))


def read_batches(spark: SparkSession, target: str, schema, fmt: str = "parquet") -> DataFrame:
    """The rows of all stored batches; batches without their counters are no part of it."""
    stored = stored_batches(spark, target)
    if not stored:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).format(fmt).load(target)
    return rows.filter(F.col(BATCH).isin(stored)).drop(BATCH)  # a filter on folders
