"""Operators that need no keys treat the whole table as one series."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators import evaluate as ev
from tidewright.operators import features as feat
from tidewright.operators import monitor, profile, screening, structure
from tidewright.operators import regularize as reg

CASES = {
    "resample": lambda d: reg.resample(d, "W"),
    "resample_sum": lambda d: reg.resample(d, "MS", method="sum"),
    "resample_median": lambda d: reg.resample(d, "MS", method="median"),
    "infer_frequency": lambda d: reg.infer_frequency(d),
    "align_to_spine": lambda d: reg.align_to_spine(d, "D"),
    "missing_periods": lambda d: reg.missing_periods(d.where(F.dayofmonth("ts") != 3), "D"),
    "gap_report": lambda d: reg.gap_report(d, "D"),
    "fill_gaps": lambda d: reg.fill_gaps(d, "D"),
    "impute_lookback": lambda d: reg.impute_lookback(d, "D"),
    "dedupe": lambda d: reg.dedupe_timestamps(d),
    "flag_outliers": lambda d: reg.flag_outliers(d),
    "outlier_share_raw": lambda d: reg.outlier_share(d, gridded=False),
    "validate": lambda d: reg.validate_series(d),
    "lag_roll": lambda d: feat.lag_roll_features(d),
    "lag_roll_blocks": lambda d: feat.lag_roll_features(d, block_rows=40),
    "rolling": lambda d: feat.rolling_stats(d),
    "leakage": lambda d: feat.leakage_report(feat.lag_roll_features(d), ["lag_1", "roll7_mean"]),
    "last_rows": lambda d: feat.last_rows(d, 5),
    "basic_stats": lambda d: profile.basic_stats(d),
    "basic_stats_raw": lambda d: profile.basic_stats(d, gridded=False),
    "quality": lambda d: profile.quality(d),
    "summary": lambda d: profile.summary_stats(d),
    "temporal": lambda d: profile.temporal_stats(d),
    "seasonal_strength": lambda d: profile.seasonal_strength(d),
    "acf": lambda d: profile.acf(d, nlags=10),
    "pacf": lambda d: profile.pacf(profile.acf(d, nlags=10), nlags=5),
    "rolling_cv": lambda d: profile.rolling_cv(d),
    "histogram": lambda d: profile.histogram(d),
    "month_box": lambda d: profile.month_box(d),
    "split": lambda d: ev.train_valid_split(d, "D"),
    "folds": lambda d: ev.rolling_origin(d),
    "fold_table": lambda d: ev.fold_table(d),
    "cv_windows": lambda d: ev.cv_windows(d, "D"),
    "choose_metric": lambda d: ev.choose_metric(d),
    "choose_metric_raw": lambda d: ev.choose_metric(d, gridded=False),
    "mad": lambda d: monitor.mad_change_points(d),
    "decompose": lambda d: structure.decompose(d, 7),
    "trend_line": lambda d: structure.trend_line(d),
    "season_period": lambda d: structure.seasonal_period(profile.acf(d, nlags=14), [7, 14]),
    "corr_screen": lambda d: screening.corr_screen(feat.calendar_features(d), ["dow", "month", "dayofyear"], min_abs=0.0),
    "corr_pairs": lambda d: screening.corr_pairs(feat.calendar_features(d), ["dow", "month", "dayofyear"]),
    "vif_table": lambda d: screening.vif_table(feat.calendar_features(d), ["dow", "month", "dayofyear"]),
    "vif_select": lambda d: screening.select_by_vif(feat.calendar_features(d), ["dow", "month", "dayofyear"]),
}


@pytest.mark.parametrize("name", CASES)
def test_without_keys(daily, name):
    one = daily.where("series_id = 's2'").drop("series_id")
    keyed_rows = CASES[name](one).collect()
    assert keyed_rows
