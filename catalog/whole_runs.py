"""Load, back-test and forecast end to end; custom models; streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DAILY_BY_PRIORITY, KEYS, MONTHLY_BY_PRIORITY, daily_by_priority, monthly_by_priority, query, raw_events, rounded, table
from catalog.evaluating import _split_sql
from catalog.monitoring import _mad_steps
from catalog.regularizing import _FILLED, OUTLIERS_SQL, policy_sql
from catalog.screening import _LAGGED_SQL, lagged_features
from tidewright.functions import frequency as fq
from tidewright.functions.expressions import safe_divide
from tidewright.models import custom
from tidewright.operators import monitor, screening
from tidewright.operators.layout import by_series
from tidewright.plans import forecasting as plan
from tidewright.plans.load import LoadOptions, load_series
from tidewright.session import scratch_path
from tidewright.streaming import live, watch


# Sub-hourly and hourly series are read by the hour, wider ones by 6 hours or a day.
@query("load_series", f"""
WITH raw AS (SELECT event_type || '_' || (user_id < 50)::VARCHAR AS series_id, date_trunc('second', ts)::TIMESTAMP AS ts, value AS y FROM events),
u AS (SELECT DISTINCT series_id, ts FROM raw),
w AS (SELECT series_id, date_diff('second', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) AS g FROM u),
c AS (SELECT series_id, g, count(*) AS n FROM w WHERE g > 0 GROUP BY series_id, g),
l AS (SELECT series_id, CASE WHEN g <= 3600 THEN 'h' WHEN g <= 21600 THEN '6h' ELSE 'D' END AS freq, CASE WHEN g <= 3600 THEN 3600 WHEN g <= 21600 THEN 21600 ELSE 86400 END AS step
  FROM (SELECT series_id, g, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, g) AS k FROM c) AS t WHERE k = 1),
h AS (SELECT raw.series_id, make_timestamp((epoch(ts)::BIGINT // step * step * 1000000)::BIGINT) AS ts, avg(y) AS y FROM raw JOIN l ON raw.series_id = l.series_id GROUP BY 1, 2),
e AS (SELECT h.series_id, freq, step, min(ts) AS a, max(ts) AS b, count(*) AS n, count(DISTINCT hour(ts)) AS hours FROM h JOIN l ON h.series_id = l.series_id GROUP BY 1, 2, 3),
x AS (SELECT *, date_diff('second', a, b) // step + 1 AS want, date_diff('second', a, b) // 86400 + 1 AS days FROM e),
p AS (SELECT *, CASE WHEN want = n THEN 'none' WHEN (want - n)::DOUBLE / want < 0.1 THEN 'ffill'
  WHEN freq = 'h' AND hours < 24 AND abs(n - days * hours) < days * 2 THEN 'zero' ELSE 'keep' END AS fill_policy FROM x),
s AS (SELECT series_id, freq, fill_policy, unnest(generate_series(a, b, to_seconds(step)))::TIMESTAMP AS ts FROM p),
d AS (SELECT s.series_id, s.ts, h.y, freq, fill_policy, (CASE WHEN h.ts IS NULL THEN 1 ELSE 0 END)::INTEGER AS imputed_flag
  FROM s LEFT JOIN h ON s.series_id = h.series_id AND s.ts = h.ts),
f AS (SELECT *, {_FILLED} AS filled FROM d)
SELECT series_id, ts, imputed_flag, fill_policy, freq,
  round(CASE fill_policy WHEN 'ffill' THEN filled WHEN 'zero' THEN coalesce(y, 0.0::DOUBLE) ELSE y END, 7) AS y
FROM f WHERE fill_policy IN ('ffill', 'zero') OR imputed_flag = 0
""")
def load_whole(spark, sf):
    """Text dates and times, two id columns, sub-hourly rows: the full load."""
    raw = table(spark, sf, "events").select(
        "event_type", (F.col("user_id") < 50).cast("string").alias("small"),
        F.date_format("ts", "dd-MM-yyyy").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"), F.col("value").alias("Total"),
    )
    o = LoadOptions(target="Total", date="Date", time="Time", id_cols=("event_type", "small"))
    return rounded(load_series(raw, o), 7, "y")


@query("load_series_daily", f"SELECT *, 'D' AS freq FROM ({policy_sql(DAILY_BY_PRIORITY, 'day')}) AS p")
def load_series_daily(spark, sf):
    o = LoadOptions(target="o_totalprice", date="o_orderdate", id_cols=("o_orderpriority",), freq="D", duplicates="sum")
    return rounded(load_series(table(spark, sf, "orders"), o), 2, "y")


@query("load_series_validated", f"""
WITH d AS (SELECT * FROM ({policy_sql(DAILY_BY_PRIORITY, 'day')}) AS p), {OUTLIERS_SQL},
s AS (SELECT series_id, count(*) AS n_rows, min(y) AS min_y, avg((y IS NULL)::INTEGER) AS ms, avg(is_outlier::INTEGER) AS os FROM f GROUP BY series_id)
SELECT d.*, 'D' AS freq,
  concat_ws(',', CASE WHEN n_rows < 30 THEN 'too_few_rows' END, CASE WHEN min_y < 0 THEN 'negative_values' END,
    CASE WHEN ms > 0.2 THEN 'too_many_missing' END) AS violations,
  concat_ws(',', CASE WHEN os > 0.1 THEN 'many_outliers' END) AS warnings
FROM d JOIN s ON d.series_id = s.series_id
""")
def load_series_validated(spark, sf):
    """Year, month and day in columns of their own; every series carries its findings."""
    raw = table(spark, sf, "orders").select(
        "o_orderpriority", "o_totalprice", *[F.date_format("o_orderdate", f).alias(c) for c, f in (("year", "yyyy"), ("month", "M"), ("day", "d"))])
    o = LoadOptions(target="o_totalprice", date_parts=("year", "month", "day"), id_cols=("o_orderpriority",), freq="D", duplicates="sum", validate="report")
    return rounded(load_series(raw, o), 2, "y").withColumns({c: F.concat_ws(",", c) for c in ("violations", "warnings")})


@query("custom_drift_model", f"""
WITH d AS ({MONTHLY_BY_PRIORITY}), m AS (SELECT series_id, arg_min(y, ts) AS a, arg_max(y, ts) AS b, max(ts) AS t, count(*) AS n FROM d GROUP BY series_id)
SELECT series_id, step::INTEGER AS step, (t + to_months(step::INTEGER))::TIMESTAMP AS ts, round(b + step * (b - a) / (n - 1), 2) AS forecast, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper
FROM m, range(1, 13) AS r(step)
""")
def custom_drift_model(spark, sf):
    def drift(history, horizon):
        import numpy as np
        import pandas as pd

        slope = (history.iloc[-1] - history.iloc[0]) / (len(history) - 1)
        return pd.DataFrame({"forecast": history.iloc[-1] + slope * np.arange(1, horizon + 1)})

    return rounded(custom.fit_forecast(monthly_by_priority(spark, sf), drift, "MS", 12, KEYS), 2, "forecast")


SCREEN = 0.02  # drops a candidate in some series, and all of them in others


@query("external_features", f"""
WITH d AS ({_LAGGED_SQL}), c AS (SELECT series_id, covar_pop(coalesce(lag_7, 0), y) / nullif(stddev_pop(coalesce(lag_7, 0)) * stddev_pop(y), 0) AS r7,
  covar_pop(coalesce(roll7_mean, 0), y) / nullif(stddev_pop(coalesce(roll7_mean, 0)) * stddev_pop(y), 0) AS rr FROM d GROUP BY series_id),
k AS (SELECT series_id, coalesce(abs(r7) >= {SCREEN}, false) AS in7, coalesce(abs(rr) >= {SCREEN}, false) AS inr FROM c),
f AS (SELECT d.series_id, date_trunc('month', ts) AS fold, avg(abs((y - lag_1) / y)) * 100 AS base,
  avg(abs((y - (lag_1 + CASE WHEN in7 THEN lag_7 ELSE 0 END + CASE WHEN inr THEN roll7_mean ELSE 0 END) / (1 + in7::INTEGER + inr::INTEGER)) / y)) * 100 AS plus
  FROM d JOIN k ON d.series_id = k.series_id WHERE roll7_mean IS NOT NULL AND lag_7 IS NOT NULL GROUP BY 1, 2),
m AS (SELECT series_id, quantile_cont(base, 0.5) AS mb, quantile_cont(plus, 0.5) AS mp FROM f GROUP BY series_id)
SELECT k.series_id, concat_ws(',', CASE WHEN in7 THEN 'lag_7' END, CASE WHEN inr THEN 'roll7_mean' END) AS screened,
  round(mb, 6) AS median_base, round(mp, 6) AS median_plus, round(mb - mp, 6) AS uplift, mb - mp >= 1.0 AND (in7 OR inr) AS accepted FROM k JOIN m ON k.series_id = m.series_id
""")
def external_features(spark, sf):
    d = lagged_features(spark, sf).withColumn("whole", F.col("roll7_mean").isNotNull() & F.col("lag_7").isNotNull())

    def monthly_error(df, columns):
        total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns), F.lit(0.0))
        mean = total / sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
        error = F.avg(F.abs(safe_divide(F.col("y") - mean, F.col("y")))) * 100
        folds = df.where("whole").withColumn("fold", F.date_trunc("month", "ts"))
        return folds.groupBy("series_id", "fold").agg(error.alias("score")).drop("fold")

    out = screening.select_external_features(d, ["lag_7", "roll7_mean"], KEYS, monthly_error, base=["lag_1"], min_abs=SCREEN)
    return rounded(out, 6, "median_base", "median_plus", "uplift").withColumn("screened", F.concat_ws(",", "screened"))


# ------------------------------------------------------------------ whole runs

def _monthly_run(spark, sf, ladder):
    from tidewright.operators.regularize import fill_gaps

    d = fill_gaps(monthly_by_priority(spark, sf), "MS", KEYS, policy="ffill").select("series_id", "ts", "y")
    return plan.backtest(d, "MS", KEYS, ladder)


@query("fitted_ladder")
def fitted_ladder(spark, sf):
    return rounded(_monthly_run(spark, sf, plan.LADDER).ranked, 4, "score", "improvement_pct")


@query("flagship_forecast")
def flagship_forecast(spark, sf):
    run = _monthly_run(spark, sf, plan.LADDER)
    return rounded(plan.forecast("MS", KEYS, run), 2, "forecast", "lower", "upper")


@query("run_report")
def run_report(spark, sf):
    r = plan.report(KEYS, _monthly_run(spark, sf, (*plan.BASELINES, *plan.LADDER)))
    return r.withColumns({"models_tried": F.to_json("models_tried"), "metrics": F.to_json("metrics")})


_LAST = f"WITH d AS ({MONTHLY_BY_PRIORITY}), m AS (SELECT series_id, max(ts) AS t FROM d GROUP BY series_id)"
_STEPS = """SELECT m.series_id, h.label AS horizon_label, s.step::INTEGER AS step, (m.t + to_months(s.step::INTEGER))::TIMESTAMP AS ts"""
_HORIZONS = "(VALUES {}) AS h(label, n)".format(", ".join(f"('{n}', {h})" for n, h in fq.frequency("MS").horizons))


def _won_by(spark, sf, name):
    run = plan.backtest(monthly_by_priority(spark, sf), "MS", KEYS, (name,))
    return rounded(plan.forecast("MS", KEYS, run), 2, "forecast").drop("lower", "upper")


@query("plan_naive_winner", f"""{_LAST}
{_STEPS}, round(d.y, 2) AS forecast, 'naive' AS model, false AS fallback
FROM m JOIN d ON m.series_id = d.series_id AND m.t = d.ts, {_HORIZONS}, range(1, h.n + 1) AS s(step)
""")
def plan_naive_winner(spark, sf):
    """A series won by the naive model is forecast by it."""
    return _won_by(spark, sf, "naive")


@query("plan_moving_average_winner", f"""{_LAST},
a AS (SELECT series_id, avg(y) AS y FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM d) WHERE k <= {plan.AVERAGED} GROUP BY series_id)
{_STEPS}, round(a.y, 2) AS forecast, 'moving_average' AS model, false AS fallback
FROM m JOIN a ON m.series_id = a.series_id, {_HORIZONS}, range(1, h.n + 1) AS s(step)
""")
def plan_moving_average_winner(spark, sf):
    return _won_by(spark, sf, "moving_average")


_GAPPED = ("seasonal_ar", "seasonal_ar_x", "trend_season", "snaive")


@query("plan_scored_rows", f"""
WITH s AS ({_split_sql(DAILY_BY_PRIORITY, fq.frequency("D").valid_cap, fq.frequency("D").min_train)}),
n AS (SELECT series_id, count(*) AS n_rows FROM s WHERE split = 'valid' GROUP BY series_id)
SELECT series_id, model, n_rows FROM n, (VALUES {", ".join(f"('{m}')" for m in _GAPPED)}) AS v(model)
""")
def plan_scored_rows(spark, sf):
    """Series with gaps: every model is scored on the same rows."""
    run = plan.backtest(daily_by_priority(spark, sf), "D", KEYS, _GAPPED)
    return run.predictions.groupBy("series_id", "model").agg(F.count(F.lit(1)).alias("n_rows"))


@query("plan_series_complete", f"""
WITH d AS ({MONTHLY_BY_PRIORITY}), c AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS k FROM d),
s AS (SELECT series_id, n AS kept FROM (SELECT DISTINCT series_id FROM c), (VALUES (1), (3), (1000)) AS v(n))
SELECT series_id || '-' || kept AS series_id, horizon_label, count(*) AS n_steps
FROM s, {_HORIZONS.replace("label, n", "horizon_label, h")}, range(1, h + 1) AS r(step) GROUP BY ALL
""")
def plan_series_complete(spark, sf):
    """Series of one row, of three and whole ones: each comes out with every step."""
    d = monthly_by_priority(spark, sf).withColumn("k", F.row_number().over(by_series(KEYS, "ts")))
    d = d.withColumn("kept", F.explode(F.array(*map(F.lit, (1, 3, 1000))))).where("k <= kept")
    d = d.withColumn("series_id", F.concat_ws("-", "series_id", "kept")).drop("k", "kept")
    out = plan.forecast("MS", KEYS, plan.backtest(d, "MS", KEYS, ("seasonal_ar", "trend_season")))
    return out.where("forecast is not null").groupBy("series_id", "horizon_label").agg(F.count(F.lit(1)).alias("n_steps"))


# -------------------------------------------------------------------- streams

_SEEN = """SELECT event_type AS series_id, ts, value AS y FROM events WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


def _rolling_psi_sql(span: int, every: int) -> str:
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""p AS (SELECT series_id, rn AS place FROM n WHERE rn % {every} = 0 AND rn >= {2 * span}),
  x AS (SELECT p.series_id, p.place, n.rn > p.place - {span} AS now, n.y FROM p JOIN n ON n.series_id = p.series_id AND n.rn > p.place - {2 * span} AND n.rn <= p.place WHERE n.y IS NOT NULL),
  e AS (SELECT series_id, place, quantile_cont(y, [{edges}]) AS edges FROM x WHERE NOT now GROUP BY series_id, place),
  side AS (SELECT x.*, len(list_filter(edges, lambda q: q <= y)) AS k FROM x JOIN e USING (series_id, place)),
  c AS (SELECT series_id, place, count(*) FILTER (now) AS nn, count(*) FILTER (NOT now) AS nb FROM side GROUP BY series_id, place),
  b AS (SELECT unnest(range(0, 10)) AS bin),
  f AS (SELECT c.series_id, c.place, nn, nb, b.bin, count(*) FILTER (s.now) AS cn, count(*) FILTER (NOT s.now) AS cb
    FROM c CROSS JOIN b LEFT JOIN side s ON s.series_id = c.series_id AND s.place = c.place AND s.k = b.bin GROUP BY ALL),
  r AS (SELECT series_id, place, CASE WHEN max(nn) >= 10 AND max(nb) >= 10 THEN
    sum((coalesce(cn, 0) / nn - coalesce(cb, 0) / nb) * ln((coalesce(cn, 0) / nn + 1e-9::DOUBLE) / (coalesce(cb, 0) / nb + 1e-9::DOUBLE))) END AS psi FROM f GROUP BY series_id, place)"""


@query("stream_watch", f"""
WITH {_mad_steps(_SEEN)},
  n AS (SELECT series_id, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn, ts, z FROM z),
  {_rolling_psi_sql(90, 30)}
SELECT n.series_id, n.ts, n.y, round(n.z, 6) AS z, coalesce(abs(n.z) > 4.0, false) AS is_change, n.rn, round(r.psi, 9) AS psi
FROM n LEFT JOIN r ON r.series_id = n.series_id AND r.place = n.rn
""")
def stream_watch(spark, sf):
    """Change points and rolling drift of a stream equal those of the rows it has passed."""
    out, ckpt = scratch_path(spark, "watch"), scratch_path(spark, "watch-state")
    live.write_stream(watch.watch_series(_event_stream(spark, sf), "1 hour", KEYS), out, ckpt).awaitTermination()
    return rounded(rounded(spark.read.parquet(out), 6, "z"), 9, "psi")


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.select(F.col("event_type").alias("series_id"), "ts", F.col("value").alias("y"))


@query("stream_resample", """
SELECT event_type AS series_id, date_trunc('hour', ts)::TIMESTAMP AS ts, round(avg(value), 7) AS mean, round(sum(value), 2) AS sum, count(value) AS n
FROM events GROUP BY event_type, date_trunc('hour', ts)
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_resample(spark, sf):
    """Windows still open at the watermark are not emitted."""
    out, ckpt = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    live.write_stream(live.resample_stream(_event_stream(spark, sf), "1 hour", "1 hour", KEYS), out, ckpt).awaitTermination()
    return rounded(rounded(spark.read.parquet(out), 7, "mean"), 2, "sum")


@query("stream_drift", """
WITH a AS (SELECT event_type AS series_id, value AS y FROM events WHERE hour(ts) < 12), b AS (SELECT event_type AS series_id, value AS y FROM events),
e AS (SELECT series_id, quantile_cont(y, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM a GROUP BY series_id),
x AS (SELECT series_id, y, 'a' AS side FROM a UNION ALL SELECT series_id, y, 'b' FROM b),
k AS (SELECT x.series_id, side, len(list_filter(edges, lambda q: q <= y)) AS bin FROM x JOIN e ON x.series_id = e.series_id),
c AS (SELECT series_id, bin, count(*) FILTER (side = 'a')::DOUBLE AS ca, count(*) FILTER (side = 'b')::DOUBLE AS cb FROM k GROUP BY series_id, bin),
p AS (SELECT series_id, ca / sum(ca) OVER (PARTITION BY series_id) AS pa, cb / sum(cb) OVER (PARTITION BY series_id) AS pb FROM c)
SELECT series_id, round(sum((pb - pa) * ln((pb + 1e-9::DOUBLE) / (pa + 1e-9::DOUBLE))), 9) AS psi FROM p GROUP BY series_id
""")
def stream_drift(spark, sf):
    base = raw_events(spark, sf).where(F.hour("ts") < 12)
    edges = monitor.bin_edges(base, KEYS)
    counts = monitor.bin_counts(base, edges, KEYS)
    out, ckpt = scratch_path(spark, "drift"), scratch_path(spark, "drift-state")
    live.watch_drift(_event_stream(spark, sf), edges, counts, KEYS, out, ckpt).awaitTermination()
    return rounded(spark.read.parquet(out).select("series_id", "psi"), 9, "psi")
