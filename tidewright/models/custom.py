"""A caller's own model, fitted and run once per series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from tidewright.models.gram import key_schema
from tidewright.models.naive import future_spine


def fit_forecast(
    df: DataFrame,
    fn: Callable[[pd.Series, int], pd.DataFrame],
    freq: str,
    horizon: int,
    keys: Sequence[str],
    ts: str = "ts",
    y: str = "y",
) -> DataFrame:
    """``fn(history, horizon)`` returns ``forecast`` (and optionally ``lower`` and
    ``upper``) for the coming steps.

    Series must be gridded: one series is one pandas frame, so its length is
    bounded by the calendar. Spark spreads the series over tasks.
    """
    keys = list(keys)
    columns = ["forecast", "lower", "upper"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        history = pdf.sort_values(ts).set_index(ts)[y]
        out = fn(history, horizon).reset_index(drop=True)
        out = out.reindex(columns=columns).astype(float)
        out.insert(0, "step", range(1, len(out) + 1))
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    schema = key_schema(df, keys) + "step int, forecast double, lower double, upper double"
    paths = df.select(*keys, ts, y).groupBy(*keys).applyInPandas(run, schema)
    return future_spine(df, freq, horizon, keys, ts).join(paths, [*keys, "step"])
