from pyspark.sql import functions as F

from meterlens.operators.cleaning import (
    clean_readings,
    coerce_result,
    data_quality_counts,
    normalize_feed,
    prepare_workload_input,
    select_household,
)
from meterlens.schema import CLEANED_SCHEMA, ENERGY, HOUSEHOLD, RAW_ENERGY, TIME

from helpers import raw_feed, ts

EDGE_ROWS = [
    ("MAC1", "Std", "2012-02-08 13:30:00.0000000", "0"),  # 7-digit layout, zero energy
    ("MAC1", "Std", "2012-02-08 14:00:00", " 0.5 "),  # plain layout, padded number
    ("\tMAC2 ", "ToU", "2012-02-08T14:30:00", "1.5"),  # ISO T form, tab-padded id
    ("\xa0MAC2", "ToU", "bad", "2.0"),  # bad time
    ("MAC2", "ToU", None, "2.0"),  # null time
    ("MAC3", "Std", "2012-02-08 15:00:00", "Null"),
    ("MAC3", "Std", "2012-02-08 15:30:00", "none"),
    ("MAC3", "Std", "2012-02-08 16:00:00", ""),
    ("MAC3", "Std", "2012-02-08 16:30:00", "NaN"),
    ("MAC3", "Std", "2012-02-08 17:00:00", "inf"),
    ("MAC3", "Std", "2012-02-08 17:30:00", "abc"),
    (None, "Std", "2012-02-08 18:00:00", "0.25"),  # null household
    ("MAC4", "Std", "2012-02-08 13:30:00", "0.75"),  # same time as MAC1
]


def test_normalize_feed(spark):
    recs = normalize_feed(raw_feed(spark, EDGE_ROWS))
    assert recs.columns == [HOUSEHOLD, "stdorToU", TIME, ENERGY]
    rows = recs.collect()
    assert [r[HOUSEHOLD] for r in rows][:5] == ["MAC1", "MAC1", "MAC2", "MAC2", "MAC2"]
    energies = [r[ENERGY] for r in rows]
    assert energies == [0.0, 0.5, 1.5, 2.0, 2.0, None, None, None, None, None, None, 0.25, 0.75]


def test_clean_readings_edges(spark):
    cleaned = clean_readings(normalize_feed(raw_feed(spark, EDGE_ROWS)))
    assert cleaned.schema.fieldNames() == CLEANED_SCHEMA.fieldNames()
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in CLEANED_SCHEMA]
    got = {(r[HOUSEHOLD], r[TIME], r[ENERGY]) for r in cleaned.collect()}
    assert got == {
        ("MAC1", ts("2012-02-08T13:30:00"), 0.0),
        ("MAC1", ts("2012-02-08T14:00:00"), 0.5),
        ("MAC2", ts("2012-02-08T14:30:00"), 1.5),
        (None, ts("2012-02-08T18:00:00"), 0.25),
        ("MAC4", ts("2012-02-08T13:30:00"), 0.75),
    }
    row = cleaned.filter(F.col(HOUSEHOLD) == "MAC2").first()
    assert (row.year, row.month, row.day, row.hour, row.day_of_week) == (
        2012, 2, 8, 14, "Wednesday",
    )
    assert str(row.date) == "2012-02-08"


def test_clean_drops_store_id(spark):
    df = spark.createDataFrame(
        [("x1", "MAC1", "Std", "2012-02-08 13:30:00", 1.0)],
        "_id string, LCLid string, stdorToU string, DateTime string, energy_kwh double",
    )
    assert "_id" not in clean_readings(df).columns


def test_data_quality_counts(spark):
    row = data_quality_counts(normalize_feed(raw_feed(spark, EDGE_ROWS))).first()
    assert row.asDict() == {
        "raw_records": 13,
        "missing_energy_records": 6,
        "valid_records": 5,
    }


def test_zero_fill_keeps_rows(spark):
    prepared = prepare_workload_input(normalize_feed(raw_feed(spark, EDGE_ROWS)))
    assert prepared.columns == [HOUSEHOLD, TIME, ENERGY, "stdorToU"]
    rows = prepared.collect()
    assert len(rows) == 13
    assert sum(1 for r in rows if r[ENERGY] == 0.0) == 7
    assert all(r[ENERGY] is not None for r in rows)


def test_coerce_result(spark):
    text = spark.createDataFrame(
        [("2012-02-08", "1.5"), ("oops", "2"), ("2012-02-09", "x"), ("2012-02-10", "3")],
        "date string, total_energy_kwh string",
    )
    out = coerce_result(
        text, numeric=["total_energy_kwh"], dates=["date"], required=["date", "total_energy_kwh"]
    ).collect()
    assert [(str(r.date), r.total_energy_kwh) for r in out] == [
        ("2012-02-08", 1.5),
        ("2012-02-10", 3.0),
    ]


def test_select_household_text_compare(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (12, 3.0)], "LCLid long, energy_kwh double")
    assert [r.LCLid for r in select_household(df, "1").collect()] == [1]


def test_raw_energy_column_name_has_trailing_space():
    assert RAW_ENERGY.endswith(" ")


def test_select_household_numeric_pushdown_and_text_semantics(spark):
    df = spark.createDataFrame([(1, 1.0), (42, 2.0), (420, 3.0)], "LCLid long, energy_kwh double")
    assert [r.LCLid for r in select_household(df, "42").collect()] == [42]
    assert select_household(df, "042").count() == 0  # text semantics: '042' is no id
    assert select_household(df, "x").count() == 0
    import __spark_entry__ as E

    q = E.queries()["select_household"](spark, "/root/testdata/sf0.001")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,42)" in plan


def test_text_time_is_parsed_once_per_row(spark):
    import __spark_entry__ as E
    from meterlens.functions.columns import ZONED_TIME

    cleaned = clean_readings(E.feed_records(spark, "/root/testdata/sf0.001"))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(ZONED_TIME) == 1  # not duplicated into a pushed-down filter
    typed = clean_readings(E.events_readings(spark, "/root/testdata/sf0.001"))
    physical = typed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), IsNotNull(ts)]" in physical


def test_evaluate_once_keeps_filters_above_it(spark):
    from meterlens.operators.common import evaluate_once

    df = spark.createDataFrame([("1.5", 1), ("x", 2), (None, 3)], "v string, other int")
    parsed = evaluate_once(df, "v", F.col("v").try_cast("double"))
    kept = parsed.filter(F.col("v").isNotNull())
    assert [tuple(r) for r in kept.collect()] == [(1.5, 1)]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # the filter sits above the generator; the cast appears once, inside it
    assert plan.index("Filter") < plan.index("Generate")
    assert plan.count("try_cast") == 1


def test_text_time_table_is_pruned_and_pushed_down(spark, scratch):
    import __spark_entry__ as E
    from meterlens.functions.columns import ZONED_TIME
    from meterlens.operators.rollups import hourly_consumption

    E.feed_records(spark, "/root/testdata/sf0.001").write.parquet(f"{scratch}/stored")
    hourly = hourly_consumption(clean_readings(spark.read.parquet(f"{scratch}/stored")))
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<DateTime:string,energy_kwh:double>" in plan
    assert "PushedFilters: [IsNotNull(energy_kwh)]" in plan
    assert hourly._jdf.queryExecution().optimizedPlan().toString().count(ZONED_TIME) == 1
