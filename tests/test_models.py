"""Fitted models against direct NumPy computations, one series at a time."""

import numpy as np
import pandas as pd
import pytest
from conftest import series_of
from pyspark.sql import functions as F

from tidewright.models import boosted, custom, gram, naive, seasonal_ar, trend_season, unit_root
from tidewright.operators import evaluate as ev
from tidewright.operators.features import calendar_features

KEYS = ["series_id"]


def ols(x, y):
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    sse = ((y - x @ beta) ** 2).sum()
    var = sse / (len(y) - x.shape[1])
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * var)
    return beta, se, sse, var


def test_wide_and_narrow_grams_agree(daily):
    d = daily.withColumns({"one": F.lit(1.0), "m": F.month("ts").cast("double")})
    a = gram.gram(d, KEYS, ["one", "m", "y"]).toPandas().set_index("series_id").sort_index()
    z = d.select("series_id", F.array("one", "m", "y").alias("z"))
    b = gram.gram_of_vectors(z, KEYS, "z").toPandas().set_index("series_id").sort_index()
    assert a["n"].tolist() == b["n"].tolist()
    for k in a.index:
        np.testing.assert_allclose(a.loc[k, "gram"], b.loc[k, "gram"], rtol=1e-12)


# ---------------------------------------------------------------- unit root

def adf_reference(s, lags=None):
    top = min(int(np.ceil(12 * (len(s) / 100) ** 0.25)), len(s) // 2 - 2)
    u = ((s - s.mean()) / s.std()).to_numpy()

    def design(k, skip):
        dy = np.diff(u)
        rows = range(skip, len(dy))
        x = np.array([[1.0, u[t], *(dy[t - i] for i in range(1, k + 1))] for t in rows])
        return x, dy[skip:]

    if lags is None:
        aic = {}
        for k in range(top + 1):
            x, y = design(k, top)
            _, _, sse, _ = ols(x, y)
            aic[k] = len(y) * np.log(sse / len(y)) + 2 * x.shape[1]
        lags = min(aic, key=aic.get)
    x, y = design(lags, lags)
    beta, se, _, _ = ols(x, y)
    return beta[1] / se[1], lags


@pytest.mark.parametrize("lags", ["aic", 0, 3])
def test_adf_statistic(daily, daily_pdf, lags):
    got = {r["series_id"]: r for r in unit_root.adf_test(daily, KEYS, lags=lags).collect()}
    for name, s in series_of(daily_pdf).items():
        stat, used = adf_reference(s, None if lags == "aic" else lags)
        assert got[name]["adf_statistic"] == pytest.approx(stat, rel=1e-6)
        assert got[name]["used_lags"] == used


def test_adf_pvalues():
    # published 1 %, 5 % and 10 % points of the constant-only case
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert unit_root.mackinnon_p(tau) == pytest.approx(p, abs=2e-3)
    assert unit_root.mackinnon_p(5.0) == 1.0 and unit_root.mackinnon_p(-30.0) == 0.0


# -------------------------------------------------------------- seasonal AR

def two_stage(s, m, exog=None):
    mu, sd = s.mean(), s.std()
    u = (s - mu) / sd
    w = u.diff().diff(m)
    lagged = pd.concat([w.shift(k) for k in sorted({1, 2, 3, m, m + 1})], axis=1)
    ok = lagged.notna().all(axis=1) & w.notna()
    beta, *_ = ols(lagged[ok].to_numpy(), w[ok].to_numpy())
    e = w - lagged.to_numpy() @ beta
    cols = [w.shift(1), e.shift(1), w.shift(m), e.shift(m)]
    if exog is not None:
        cols += [exog[c].diff().diff(m) for c in exog]
    x = pd.concat(cols, axis=1)
    ok = x.notna().all(axis=1) & w.notna()
    coef, _, _, var = ols(x[ok].to_numpy(), w[ok].to_numpy())
    return coef, var, u, w, e.fillna(0.0), mu, sd


def test_seasonal_ar_coefficients(daily, daily_pdf):
    coef, _ = seasonal_ar.fit(daily, KEYS, season=7)
    got = {r["series_id"]: r for r in coef.collect()}
    for name, s in series_of(daily_pdf).items():
        want, var, *_ = two_stage(s, 7)
        np.testing.assert_allclose(got[name]["beta"], want, rtol=1e-6, atol=1e-8)
        assert got[name]["var"] == pytest.approx(var, rel=1e-6)


def test_seasonal_ar_forecast_and_bounds(daily, daily_pdf):
    got = seasonal_ar.forecast(daily, "D", 20, KEYS).toPandas()
    for name, s in series_of(daily_pdf).items():
        coef, var, u, w, e, mu, sd = two_stage(s, 7)
        u, w, e = u.tolist(), w.tolist(), e.tolist()
        want = []
        for _ in range(20):
            nxt = coef[0] * w[-1] + coef[1] * e[-1] + coef[2] * w[-7] + coef[3] * e[-7]
            u.append(nxt + u[-1] + u[-7] - u[-8])
            w.append(nxt)
            e.append(0.0)
            want.append(mu + sd * u[-1])
        g = got[got.series_id == name].sort_values("step")
        np.testing.assert_allclose(g.forecast, want, rtol=1e-6)
        # shock weights by pushing a unit shock through the same recursion
        w, u, e, psi = [0.0] * 8, [0.0] * 8, [0.0] * 8, []
        for h in range(20):
            shock = 1.0 if h == 0 else 0.0
            nxt = coef[0] * w[-1] + coef[1] * e[-1] + coef[2] * w[-7] + coef[3] * e[-7] + shock
            u.append(nxt + u[-1] + u[-7] - u[-8])
            w.append(nxt)
            e.append(shock)
            psi.append(u[-1])
        half = sd * np.sqrt(var * np.cumsum(np.square(psi))) * 1.959963984540054
        np.testing.assert_allclose(g.upper - g.forecast, half, rtol=1e-6)
        assert g.ts.iloc[0] == s.index[-1] + pd.Timedelta(days=1)


def test_seasonal_ar_with_features(daily, daily_pdf):
    exog = ["sin_annual", "cos_annual"]
    future = calendar_features(naive.future_spine(daily, "D", 5, KEYS))
    got = seasonal_ar.forecast(calendar_features(daily), "D", 5, KEYS, exog=exog, exog_future=future).toPandas()
    for name, s in series_of(daily_pdf).items():
        idx = s.index.append(pd.date_range(s.index[-1] + pd.Timedelta(days=1), periods=5))
        angle = 2 * np.pi * idx.dayofyear / 365.25
        x = pd.DataFrame({"sin": np.sin(angle), "cos": np.cos(angle)}, index=idx)
        coef, var, u, w, e, mu, sd = two_stage(s, 7, x.loc[s.index])
        dx = x.diff().diff(7).iloc[-5:].to_numpy()
        u, w, e, want = u.tolist(), w.tolist(), e.tolist(), []
        for h in range(5):
            nxt = coef[0] * w[-1] + coef[1] * e[-1] + coef[2] * w[-7] + coef[3] * e[-7] + dx[h] @ coef[4:]
            u.append(nxt + u[-1] + u[-7] - u[-8])
            w.append(nxt)
            e.append(0.0)
            want.append(mu + sd * u[-1])
        np.testing.assert_allclose(got[got.series_id == name].sort_values("step").forecast, want, rtol=1e-5)


def test_order_grid(daily, daily_pdf):
    got = seasonal_ar.order_grid(daily, KEYS, season=7, max_p=2, max_seasonal=1).toPandas()
    for name, s in series_of(daily_pdf).items():
        w = ((s - s.mean()) / s.std()).diff().diff(7)
        every = pd.concat([w.shift(1), w.shift(2), w.shift(7)], axis=1)
        ok = every.notna().all(axis=1) & w.notna()
        x, y = every[ok].to_numpy(), w[ok].to_numpy()
        for p in range(3):
            for q in range(2):
                a = np.column_stack([np.ones(len(y)), x[:, :p], x[:, 2 : 2 + q]])
                _, _, sse, _ = ols(a, y)
                r = got[(got.series_id == name) & (got.p == p) & (got.seasonal_p == q)]
                assert r.aic.iloc[0] == pytest.approx(len(y) * np.log(sse / len(y)) + 2 * a.shape[1], rel=1e-6)
    best = {r["series_id"]: r["aic"] for r in seasonal_ar.best_order(seasonal_ar.order_grid(daily, KEYS, season=7, max_p=2, max_seasonal=1), KEYS).collect()}
    assert best == pytest.approx(got.groupby("series_id").aic.min().to_dict())


# --------------------------------------------------------- trend and season

DESIGN = trend_season.Design(changepoints=4, yearly=2, weekly=2)


def design_matrix(idx, start, end, d):
    t = (idx - start).total_seconds() / (end - start).total_seconds()
    days = (idx - pd.Timestamp("1970-01-01")).total_seconds() / 86400
    cols = [np.ones(len(idx)), t]
    cols += [np.maximum(0, t - d.history_share * j / (d.changepoints + 1)) for j in range(1, d.changepoints + 1)]
    for period, pairs in ((365.25, d.yearly), (7.0, d.weekly), (1.0, d.daily)):
        for k in range(1, pairs + 1):
            cols += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    return np.column_stack(cols)


def ridge_fit(x, y, prior, d):
    return np.linalg.solve(x.T @ x + np.diag(d.ridge(prior)), x.T @ y)


def test_trend_season_forecast(daily, daily_pdf):
    got = trend_season.forecast(daily, "D", 15, KEYS, design=DESIGN).toPandas()
    for name, s in series_of(daily_pdf).items():
        beta = ridge_fit(design_matrix(s.index, s.index[0], s.index[-1], DESIGN), np.log1p(s), 0.05, DESIGN)
        ahead = pd.date_range(s.index[-1] + pd.Timedelta(days=1), periods=15)
        want = np.expm1(design_matrix(ahead, s.index[0], s.index[-1], DESIGN) @ beta)
        g = got[got.series_id == name].sort_values("step")
        np.testing.assert_allclose(g.forecast, want, rtol=1e-6)
        assert (g.lower <= g.forecast).all() and (g.forecast <= g.upper).all() and (g.lower >= 0).all()
        assert len(g) == 15


def test_prior_grid_equals_refitting_every_fold(daily, daily_pdf):
    got = trend_season.prior_scores(daily, "D", KEYS, design=DESIGN).toPandas()
    for name, s in series_of(daily_pdf).items():
        cutoff, cuts = s.index[-1] - pd.Timedelta(days=30), []
        while cutoff >= s.index[0] + pd.Timedelta(days=90):
            cuts.append(cutoff)
            cutoff -= pd.Timedelta(days=7)
        x = design_matrix(s.index, s.index[0], s.index[-1], DESIGN)
        for prior in trend_season.PRIORS:
            scores = []
            for c in cuts:
                tr, va = s.index <= c, (s.index > c) & (s.index <= c + pd.Timedelta(days=30))
                beta = ridge_fit(x[tr], np.log1p(s[tr]), prior, DESIGN)
                scores.append((np.abs(s[va] - np.expm1(x[va] @ beta)) / s[va]).mean() * 100)
            r = got[(got.series_id == name) & (got.prior == prior)].iloc[0]
            assert r.n_folds == len(cuts)
            assert r.cv_mape == pytest.approx(np.mean(scores), rel=1e-5)


def test_chosen_priors_are_used(daily):
    scores = trend_season.prior_scores(daily, "D", KEYS, design=DESIGN)
    chosen = trend_season.choose_prior(scores, KEYS)
    model = trend_season.fit(daily, DESIGN, KEYS, priors=chosen)
    a = {r["series_id"]: r["prior"] for r in model.collect()}
    assert a == {r["series_id"]: r["prior"] for r in chosen.collect()} and len(a) == 3


def reference_minimum(a, b, weight):
    """Proximal gradient steps with momentum until nothing moves."""
    step = 1 / np.linalg.eigvalsh(a)[-1]
    x = z = np.zeros(len(b))
    k = 1.0
    for _ in range(400_000):
        u = z - step * (a @ z - b)
        new = np.sign(u) * np.maximum(np.abs(u) - step * weight, 0)
        if (new - x) @ (z - new) > 0:  # restart
            k = 1.0
        nk = (1 + np.sqrt(1 + 4 * k * k)) / 2
        z, gap, x, k = new + (k - 1) / nk * (new - x), np.abs(new - x).max(), new, nk
        if gap < 1e-15:
            break
    return x


def test_sparse_minimum():
    rng = np.random.default_rng(0)
    for n, p in ((60, 6), (200, 15), (40, 12)):
        x = rng.normal(size=(n, p)) + 0.8 * rng.normal(size=(n, 1))
        y = x[:, 0] * 2 - x[:, 3] + rng.normal(size=n)
        a, b = x.T @ x / n + 1e-6 * np.eye(p), x.T @ y / n
        for lam in (0.0, 0.01, 0.1, 0.5, 10.0):
            weight = np.full(p, lam)
            weight[0] = 0.0
            found = gram._sparse(a, b, weight, np.zeros(p))
            np.testing.assert_allclose(found, reference_minimum(a, b, weight), atol=1e-8)
            assert lam < 10 or not found[1:].any()
            warm = gram._sparse(a, b, weight, rng.normal(size=p))
            np.testing.assert_allclose(found, warm, atol=1e-10)


def test_sparse_changepoints(daily, daily_pdf):
    """All priors from one path; the conditions of the minimum hold to rounding, and a
    bend is found where there is one."""
    design = trend_season.Design(changepoints=10, yearly=2, weekly=2, sparse=True)
    for _, s in series_of(daily_pdf).items():
        s = s + np.maximum(0, np.arange(len(s)) - 0.4 * len(s)) * 2
        x = design_matrix(s.index, s.index[0], s.index[-1], design)
        z = np.column_stack([x, np.log1p(s)])
        fits = design.solutions(z.T @ z, len(s), trend_season.PRIORS)
        kept = []
        for prior, found in zip(trend_season.PRIORS, fits):
            ridge = design.ridge(1.0)
            ridge[2:12] = 0
            slope = x.T @ (np.log1p(s).to_numpy() - x @ found["beta"]) - ridge * found["beta"]
            hinge, weight = found["beta"][2:12], trend_season.NOISE / prior
            np.testing.assert_allclose(slope[[0, 1, *range(12, design.width)]], 0, atol=1e-6)
            np.testing.assert_allclose(slope[2:12][hinge != 0], weight * np.sign(hinge[hinge != 0]), atol=1e-6)
            assert (np.abs(slope[2:12][hinge == 0]) <= weight + 1e-6).all()
            kept.append(int((hinge != 0).sum()))
        assert kept == sorted(kept) and 0 < kept[-1] < 10


def test_sparse_designs_of_short_and_constant_series(spark):
    rows = [("short", f"2024-01-0{i}", 5.0) for i in range(1, 4)] + [("flat", f"2024-01-{i:02d}", 5.0) for i in range(1, 31)]
    d = spark.createDataFrame(rows, "series_id string, ts string, y double").withColumn("ts", F.to_timestamp_ntz("ts"))
    design = trend_season.Design(changepoints=4, yearly=0, weekly=1, sparse=True)
    got = {r.series_id: r.beta for r in trend_season.fit(d, design, KEYS).collect()}
    assert set(got) == {"flat"} and got["flat"][0] == pytest.approx(np.log1p(5.0), abs=1e-6) and np.abs(got["flat"][1:]).max() < 1e-5


# ------------------------------------------------------------------ boosted

def test_recursion_feeds_predictions_back(daily, daily_pdf):
    d = daily.withColumn("level", F.lit(1.0))
    score = lambda f: f.withColumn("_pred", F.col("lag_1") * 0.5 + F.col("lag_7") * 0.2 + F.col("roll7_mean") * 0.2 + F.col("roll7_std") + F.col("dow"))
    got = boosted.recursive_forecast(d, "D", 9, KEYS, score, checkpoint_every=4).toPandas()
    for name, s in series_of(daily_pdf).items():
        h = s.tolist()
        for i in range(9):
            date = s.index[-1] + pd.Timedelta(days=i + 1)
            week = np.array(h[-7:])
            h.append(h[-1] * 0.5 + h[-7] * 0.2 + week.mean() * 0.2 + week.std(ddof=1) + date.dayofweek)
        np.testing.assert_allclose(got[got.series_id == name].sort_values("step").forecast, h[-9:], rtol=1e-9)


def test_boosted_model_learns_and_stops(daily):
    table = boosted.training_table(ev.train_valid_split(daily, "D", KEYS), KEYS)
    model = boosted.train(table, maxIter=12, patience=3, stepSize=0.3)
    assert 1 <= model.getNumTrees <= 12
    curve = boosted.learning_curve(table, model).toPandas()
    assert len(curve) == model.getNumTrees
    assert curve.valid_rmse.idxmin() == len(curve) - 1  # cut at its best round
    out = boosted.predict(table.where("split = 'valid'"), model)
    assert ev.score(out, KEYS, ["mape"]).agg(F.max("mape")).first()[0] < 15
    imp = boosted.importance(daily.sparkSession, model)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_custom_model_runs_per_series(daily, daily_pdf):
    got = custom.fit_forecast(daily, lambda h, n: pd.DataFrame({"forecast": [h.median()] * n}), "D", 3, KEYS).toPandas()
    for name, s in series_of(daily_pdf).items():
        assert got[got.series_id == name].forecast.tolist() == [s.median()] * 3


def test_naive_validation(daily, daily_pdf):
    split = ev.train_valid_split(daily, "D", KEYS)
    got = naive.naive_validation(split, 7, KEYS, window=10).toPandas()
    for name, s in series_of(daily_pdf).items():
        p = split.where(F.col("series_id") == name).toPandas().sort_values("ts")
        train = p[p.split == "train"].y.to_numpy()
        n = (p.split == "valid").sum()
        for model, want in (("naive", [train[-1]] * n), ("snaive", [train[-7 + i % 7] for i in range(n)]), ("moving_average", [train[-10:].mean()] * n)):
            g = got[(got.series_id == name) & (got.model == model)].sort_values("ts")
            np.testing.assert_allclose(g.yhat, want)


def test_tree_arrays_are_the_model(spark, daily):
    table = boosted.training_table(ev.train_valid_split(daily, "D", KEYS), KEYS).cache()
    model = boosted.train(table, patience=None, maxIter=12, stepSize=0.3)
    rows = boosted.predict(table, model).select(*boosted.FEATURES, "yhat", "level").toPandas()
    got = boosted.Trees(model).each(rows[boosted.FEATURES].to_numpy(float)).sum(1) * rows.level
    np.testing.assert_allclose(got, rows.yhat, rtol=1e-9)
    assembled = boosted._assembled(table, boosted.FEATURES).select("features", "_scaled")
    np.testing.assert_allclose(boosted.losses(table, model), model.evaluateEachIteration(assembled, "squared"), rtol=1e-9)


def test_forecast_inside_a_task_equals_the_step_by_step_one(daily):
    split = ev.train_valid_split(daily, "D", KEYS)
    table = boosted.training_table(split, KEYS).cache()
    model = boosted.train(table, patience=None, maxIter=8, stepSize=0.3)
    got = boosted.forecast(daily, table, model, "D", 9, KEYS).toPandas().sort_values(["series_id", "step"])
    scaled = daily.join(table.select("series_id", "level").distinct(), KEYS).withColumn("_scaled", F.col("y") / F.col("level"))
    score = lambda d: model.transform(boosted._assembled(d, boosted.FEATURES))
    want = boosted.recursive_forecast(scaled, "D", 9, KEYS, score, y="_scaled").toPandas().sort_values(["series_id", "step"])
    np.testing.assert_allclose(got.forecast, want.forecast, rtol=1e-9)
    assert (got.ts.to_numpy() == want.ts.to_numpy()).all()
