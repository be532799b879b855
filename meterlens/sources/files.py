"""Batch readers.  Every read carries an explicit schema (no inference pass)."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.schema import RAW_FEED_SCHEMA, RECORD_SCHEMA, as_readings, Roles

# Column layout of each written result dataset.
RESULT_SCHEMAS = {
    "hourly_consumption": "hour int, total_energy_kwh double",
    "daily_consumption": "date date, total_energy_kwh double",
    "monthly_consumption": "year int, month int, total_energy_kwh double",
    "household_consumption": (
        "LCLid string, total_energy_kwh double, average_half_hour_kwh double, "
        "minimum_half_hour_kwh double, maximum_half_hour_kwh double, "
        "stddev_half_hour_kwh double, readings long"
    ),
    "weekday_consumption": (
        "day_of_week string, total_energy_kwh double, average_energy_kwh double, readings long"
    ),
    "overall_statistics": (
        "total_energy_kwh double, average_half_hour_kwh double, minimum_half_hour_kwh double, "
        "maximum_half_hour_kwh double, stddev_half_hour_kwh double, valid_readings long"
    ),
    "peak_hour": "hour int, total_energy_kwh double",
    "peak_day": "date date, total_energy_kwh double",
    "peak_month": "year int, month int, total_energy_kwh double",
    "anomaly_summary": (
        "total_records long, q1_kwh double, q3_kwh double, iqr_kwh double, "
        "lower_bound_kwh double, upper_bound_kwh double, anomaly_count long, "
        "high_consumption_anomalies long, low_consumption_anomalies long, "
        "anomaly_percentage double"
    ),
    "anomaly_detection": (
        "LCLid string, stdorToU string, DateTime timestamp_ntz, energy_kwh double, "
        "date date, year int, month int, day int, hour int, day_of_week string, "
        "anomaly boolean, anomaly_type string"
    ),
    "cleaned_sample": (
        "LCLid string, stdorToU string, DateTime timestamp_ntz, energy_kwh double, "
        "date date, year int, month int, day int, hour int, day_of_week string"
    ),
    "scalability_results": (
        "data_percentage int, records long, execution_time_seconds double, "
        "throughput_records_per_second double"
    ),
}
RESULT_SCHEMAS["scalability_experiment"] = RESULT_SCHEMAS["scalability_results"]


def feed_columns(names: list[str]) -> list[Column]:
    """The four feed columns picked by name from a file with this header.

    Names are compared without surrounding white space; fails when one is missing.
    """
    found = {n.strip(): n for n in names}
    missing = [f.name for f in RAW_FEED_SCHEMA.fields if f.name.strip() not in found]
    if missing:
        raise ValueError(f"feed header {names} lacks {missing}")
    return [
        F.col(f"`{found[f.name.strip()]}`").alias(f.name) for f in RAW_FEED_SCHEMA.fields
    ]


def read_feed(reader, names: list[str], paths) -> DataFrame:
    """Feed files with this header, through ``reader`` (batch or stream).

    The header of every file is compared with ``names``: another order or another
    column fails the read instead of being bound by position.
    """
    columns = feed_columns(names)
    rows = (
        reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .csv(paths)
    )
    return rows.select(*columns)


def feed_lines(reader, paths) -> DataFrame:
    """Lines of feed files, each with its file and the place of its block there.

    Through ``reader``: batch or stream.
    """
    at = F.col("_metadata")
    return reader.text(paths).select(
        F.ltrim(F.col("value"), F.lit("\ufeff")).alias("value"),
        at["file_path"].alias("path"),
        at["file_block_start"].alias("block"),
    )


def line_headers(lines: DataFrame) -> DataFrame:
    """``(path, header)``: the first line of every file that has one, by one aggregate."""
    first = lines.filter("block = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str) -> list[str]:
    return next(csv.reader([header]))


def bind_feed_lines(lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """The four feed columns of :func:`feed_lines`, bound by the header of each line's file.

    Only the distinct headers come to the driver.  Where all files share one, no
    join is needed; else each line meets its file's header (a table of one row
    per file; Spark broadcasts it as long as its measured size allows).  A line
    equal to its file's header is a header, wherever it stands; empty lines are left
    out; a line with fewer fields has nulls.  Fails when a header lacks a feed
    column.
    """
    if headers is None:
        headers = line_headers(lines)
    distinct = sorted(r["header"] for r in headers.select("header").distinct().collect())
    names = [header_names(h) for h in distinct]
    width = max(map(len, names), default=1)
    wanted = [f.name for f in RAW_FEED_SCHEMA.fields]
    places = []
    for found in names:
        at = {n.strip(): i for i, n in enumerate(found)}
        missing = [w for w in wanted if w.strip() not in at]
        if missing:
            raise ValueError(f"feed header {found} lacks {missing}")
        places.append([at[w.strip()] for w in wanted])
    fields = ", ".join(f"c{i} string" for i in range(width))
    rows = lines.filter(F.trim("value") != "")
    parsed = F.from_csv("value", F.lit(fields), {"escape": '"'}).alias("c")  # "" is a quote within quotes
    if len(distinct) <= 1:
        rows = rows.filter(F.col("value") != F.lit(distinct[0])) if distinct else rows.filter("false")
        places = places or [[0] * len(wanted)]
        return rows.select(parsed).select(
            *(F.col(f"c.c{at}").alias(w) for w, at in zip(wanted, places[0], strict=True))
        )
    rows = rows.join(headers, "path").filter(F.col("value") != F.col("header"))
    kinds = [F.when(F.col("header") == F.lit(h), F.lit(k)) for k, h in enumerate(distinct)]
    rows = rows.select(parsed, F.coalesce(*kinds).alias("kind"))
    columns = []
    for i, name in enumerate(wanted):
        by_place: dict[int, list[int]] = {}
        for kind, place in enumerate(places):
            by_place.setdefault(place[i], []).append(kind)
        # one branch per place that the column has in any header
        picks = [F.when(F.col("kind").isin(kinds), F.col(f"c.c{place}")) for place, kinds in by_place.items()]
        columns.append((F.coalesce(*picks) if len(picks) > 1 else F.col(f"c.c{places[0][i]}")).alias(name))
    return rows.select(*columns)


def feed_headers(spark: SparkSession, pattern: str) -> list[tuple[str, ...]]:
    """The distinct headers of the feed files; none when there are no files."""
    try:
        headers = line_headers(feed_lines(spark.read, pattern))
    except AnalysisException as exc:
        if (exc.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return []
        raise
    return sorted(tuple(header_names(r["header"])) for r in headers.select("header").distinct().collect())


def read_raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.csv`` directly in ``folder`` (header, BOM tolerated), all text.

    Columns are bound by each file's header: files whose columns come in another
    order, or with more columns, are read right.  Two scans of the lines, however
    many files there are: one for the headers (nothing is parsed there), one for
    the rows.  Fails when the folder holds no CSV file or a header lacks a feed
    column.
    """
    return bind_feed_lines(feed_lines(spark.read, f"{folder.rstrip('/')}/*.csv"))


def read_readings(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    schema=RECORD_SCHEMA,
) -> DataFrame:
    """Load stored reading records.

    Parquet (schema from the files) by default; any other format (``json``,
    ``csv``, or a document-store connector given by name plus its options) is
    read with the fixed record schema.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "parquet" and schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path) if path else reader.load()
    except Exception as exc:  # a JVM-side lookup error arrives wrapped
        text = str(exc)
        if "DATA_SOURCE_NOT_FOUND" in text or "failed to find data source" in text.lower():
            raise RuntimeError(
                f"format {fmt!r} needs its Spark connector on the classpath "
                "(spark-submit --packages ...)"
            ) from exc
        raise


def read_table(spark: SparkSession, path: str, roles: Roles, keep: list[str] | None = None) -> DataFrame:
    """Any Parquet table mapped onto the reading columns by ``roles``."""
    return as_readings(spark.read.parquet(path), roles, keep)


def read_result(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "csv"
) -> DataFrame | None:
    """A written result: a directory of part files or a single file.

    A CSV result is read with ``schema``, by default the known layout of the
    result named by the last path segment, and its header must agree with it;
    other formats carry their schema.  Returns ``None`` when nothing is stored
    at ``path``; any other error is raised.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(f".{fmt}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        schema = schema or RESULT_SCHEMAS.get(name)
        if schema:
            reader = reader.schema(schema).option("enforceSchema", False)
    try:
        df = reader.load(path)
        df.schema  # resolves the path now
        return df
    except AnalysisException as exc:
        if (exc.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            return None
        raise
