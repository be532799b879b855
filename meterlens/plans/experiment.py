"""Data-size scaling experiment over the benchmark workload.

The prepared input is persisted once; each size is a nested hash sample that
is itself persisted before timing, so the timed region contains only the
three workload queries (forced with the ``noop`` sink).  Median of ``runs``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from meterlens.operators.sampling import hash_sample
from meterlens.operators.workload import workload_run

RESULT_SCHEMA = (
    "data_percentage int, records long, execution_time_seconds double, "
    "throughput_records_per_second double"
)


def _median(values: list[float]) -> float:
    ordered = sorted(values)
    return ordered[len(ordered) // 2]


def scalability_experiment(
    spark: SparkSession,
    prepared: DataFrame,
    sizes: tuple[int, ...] = (25, 50, 100),
    runs: int = 3,
    warmup: int | None = 25,
    combined: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """One row per size: records, median seconds, records per second (6 dp).

    Every run times all sizes, starting with another size each time, so that no
    size is always the first or the last.  The input keeps its partitioning
    unless ``partitions`` asks for another.  A lost cached block is rebuilt from lineage.
    """
    base = prepared.repartition(partitions) if partitions else prepared
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    base.count()
    if warmup:
        workload_run(hash_sample(base, warmup), combined)
    subsets = {
        pct: hash_sample(base, pct).persist(StorageLevel.MEMORY_AND_DISK) if pct < 100 else base
        for pct in sizes
    }
    records = {pct: subset.count() for pct, subset in subsets.items()}
    seconds: dict[int, list[float]] = {pct: [] for pct in sizes}
    for run in range(runs):
        first = run % len(sizes)
        for pct in (*sizes[first:], *sizes[:first]):
            seconds[pct].append(sum(workload_run(subsets[pct], combined).values()))
    rows = []
    for pct in sizes:
        median = _median(seconds[pct])
        throughput = records[pct] / median if median > 0 else 0.0
        rows.append((int(pct), int(records[pct]), round(median, 6), round(throughput, 6)))
    for cached in {id(df): df for df in (*subsets.values(), base)}.values():
        cached.unpersist()
    return spark.createDataFrame(rows, RESULT_SCHEMA)
