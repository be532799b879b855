"""DataFrame -> DataFrame operators over reading tables."""

from meterlens.operators.anomalies import (
    anomaly_records,
    anomaly_summary,
    detect_anomalies,
    flag_anomalies,
    household_anomalies,
    iqr_bounds,
    top_anomalies,
    top_anomalous_households,
)
from meterlens.operators.cleaning import (
    add_calendar,
    clean_readings,
    coerce_result,
    data_quality_counts,
    normalize_feed,
    prepare_workload_input,
    project_readings,
    type_readings,
    typed_quality_measures,
    valid_reading,
    select_household,
    zero_fill_energy,
)
from meterlens.operators.peaks import (
    cleaned_sample,
    peak_day,
    peak_hour,
    peak_month,
    result_peak,
)
from meterlens.operators.reports import (
    add_formatted,
    add_hour_label,
    add_period_label,
    first_or_default,
    overview_report,
    result_status,
)
from meterlens.operators.rollups import (
    calendar_rollups,
    daily_consumption,
    hourly_consumption,
    household_consumption,
    household_list,
    household_total,
    monthly_consumption,
    overall_statistics,
    split_rollup,
    weekday_consumption,
)
from meterlens.operators.sampling import hash_sample
from meterlens.operators.workload import (
    workload_household,
    workload_hourly,
    workload_overall,
    workload_run,
)

__all__ = [name for name in dir() if not name.startswith("_")]
