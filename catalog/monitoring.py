"""Drift and change points."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, daily_by_priority, hourly_events, query, raw_events, rounded
from tidewright.operators import monitor


def _psi_sql(a: str, b: str) -> str:
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""
WITH a AS ({a}), b AS ({b}),
e AS (SELECT series_id, quantile_cont(y, [{edges}]) AS edges FROM a GROUP BY series_id),
x AS (SELECT series_id, y, 'a' AS side FROM a UNION ALL SELECT series_id, y, 'b' FROM b),
k AS (SELECT x.series_id, side, len(list_filter(edges, lambda q: q <= y)) AS bin FROM x JOIN e ON x.series_id = e.series_id WHERE y IS NOT NULL),
n AS (SELECT series_id, count(*) FILTER (side = 'a') AS na, count(*) FILTER (side = 'b') AS nb FROM k GROUP BY series_id),
f AS (SELECT series_id, na, nb, unnest(range(0, 10)) AS bin FROM n),
c AS (SELECT f.series_id, f.bin, na, nb, (SELECT count(*) FROM k WHERE k.series_id = f.series_id AND k.bin = f.bin AND side = 'a')::DOUBLE / na AS pa,
  (SELECT count(*) FROM k WHERE k.series_id = f.series_id AND k.bin = f.bin AND side = 'b')::DOUBLE / nb AS pb FROM f)
SELECT series_id, round(CASE WHEN max(na) >= 10 AND max(nb) >= 10 THEN sum((pb - pa) * ln((pb + 1e-9::DOUBLE) / (pa + 1e-9::DOUBLE))) END, 9) AS psi FROM c GROUP BY series_id
"""


_RAW = "SELECT event_type AS series_id, value AS y FROM events WHERE "


@query("psi_drift", _psi_sql(_RAW + "ts < TIMESTAMP '2024-01-16'", _RAW + "ts >= TIMESTAMP '2024-01-16'"))
def psi_drift(spark, sf):
    d = raw_events(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return rounded(monitor.psi(d.where(F.col("ts") < cut), d.where(F.col("ts") >= cut), KEYS), 9, "psi").select("series_id", "psi")


# Whole-number values repeat, so several quantile edges coincide.
_COARSE = "SELECT event_type AS series_id, floor(value / 40) AS y FROM events WHERE "


@query("psi_duplicate_edges", _psi_sql(_COARSE + "hour(ts) < 12", _COARSE + "hour(ts) >= 12"))
def psi_duplicate_edges(spark, sf):
    d = raw_events(spark, sf).withColumn("y", F.floor(F.col("y") / 40).cast("double"))
    return rounded(monitor.psi(d.where(F.hour("ts") < 12), d.where(F.hour("ts") >= 12), KEYS), 9, "psi").select("series_id", "psi")


_BACK = f"SELECT series_id, y FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM ({DAILY_BY_PRIORITY}) AS d) AS r WHERE "


@query("psi_last_180", _psi_sql(_BACK + "k BETWEEN 91 AND 180", _BACK + "k <= 90"))
def psi_last_180(spark, sf):
    return rounded(monitor.recent_drift(daily_by_priority(spark, sf), KEYS), 9, "psi").select("series_id", "psi")


def _mad_steps(inner: str, window: int = 30) -> str:
    """Tables up to z: rows with their robust score."""
    w = f"PARTITION BY series_id ORDER BY ts ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
    need = max(5, window // 2)
    return f"""m AS (SELECT *, CASE WHEN count(y) OVER ({w}) >= {need} THEN quantile_cont(y, 0.5) OVER ({w}) END AS med FROM ({inner}) AS d),
  v AS (SELECT *, abs(y - med) AS dev FROM m),
  s AS (SELECT *, CASE WHEN count(dev) OVER ({w}) >= {need} THEN quantile_cont(dev, 0.5) OVER ({w}) END * 1.4826::DOUBLE AS mad FROM v),
  z AS (SELECT *, (y - med) / nullif(mad, 0) AS z FROM s)"""


def _mad_sql(inner: str, threshold: float, window: int = 30) -> str:
    return f"""
WITH {_mad_steps(inner, window)}
SELECT series_id, ts, y, round(z, 6) AS z, coalesce(abs(z) > {threshold}, false) AS is_change FROM z
"""


@query("mad_changepoints", _mad_sql(HOURLY_EVENTS, 4.0))
def mad_changepoints(spark, sf):
    return rounded(monitor.mad_change_points(hourly_events(spark, sf), KEYS), 6, "z")


@query("mad_changepoints_blocks", _mad_sql(DAILY_BY_PRIORITY, 3.0))
def mad_changepoints_blocks(spark, sf):
    d = monitor.mad_change_points(daily_by_priority(spark, sf), KEYS, threshold=3.0, block_rows=256)
    return rounded(d, 6, "z")


@query("mad_changepoints_wide", _mad_sql(HOURLY_EVENTS, 4.0, 336))
def mad_changepoints_wide(spark, sf):
    """A window of two weeks of hours."""
    return rounded(monitor.mad_change_points(hourly_events(spark, sf), KEYS, window=336), 6, "z")


_AT = f"SELECT series_id, ts, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM ({DAILY_BY_PRIORITY}) AS d"


@query("psi_rolling", f"""
WITH n AS ({_AT}),
  p AS (SELECT series_id, ts, rn AS place FROM n WHERE rn % 50 = 0 AND rn >= 120),
  x AS (SELECT p.series_id, p.place, n.rn > p.place - 60 AS now, n.y FROM p JOIN n ON n.series_id = p.series_id AND n.rn > p.place - 120 AND n.rn <= p.place),
  e AS (SELECT series_id, place, quantile_cont(y, [{", ".join(f"{i / 10}" for i in range(1, 10))}]) AS edges FROM x WHERE NOT now GROUP BY series_id, place),
  k AS (SELECT series_id, place, now, len(list_filter(edges, lambda q: q <= y)) AS bin FROM x JOIN e USING (series_id, place)),
  c AS (SELECT series_id, place, bin, count(*) FILTER (now) / 60 AS q, count(*) FILTER (NOT now) / 60 AS p FROM k GROUP BY series_id, place, bin),
  r AS (SELECT series_id, place, sum((q - p) * ln((q + 1e-9::DOUBLE) / (p + 1e-9::DOUBLE))) AS psi FROM c GROUP BY series_id, place)
SELECT p.series_id, p.ts, p.place AS rn, round(r.psi, 9) AS psi FROM p LEFT JOIN r USING (series_id, place)
""")
def psi_rolling(spark, sf):
    return rounded(monitor.rolling_drift(daily_by_priority(spark, sf), KEYS, span=60, every=50), 9, "psi")
