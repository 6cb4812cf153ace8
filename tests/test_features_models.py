from __future__ import annotations

import datetime as dt
import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aquifold import schemas
from aquifold.functions import with_moments
from aquifold.functions.quantiles import unit_quantile
from aquifold.operators import boosting, features, forecast, forest
from aquifold.plans import forecasting
from aquifold.sources import landed

START = dt.date(2023, 6, 9)
DAYS, BORES = 1095, 6


def seasonal(spark, days=DAYS, bores=BORES, seed=42):
    """Gap-free daily levels with a yearly cycle; bore 1 jumps on its last day, bore 5 turns salty."""
    rng = np.random.default_rng(seed)
    rows = []
    for bore in range(1, bores + 1):
        for i in range(days):
            date = START + dt.timedelta(days=i)
            level = 5 + bore * 0.4 + 0.8 * math.sin(2 * math.pi * i / 365.25) + rng.normal(0, 0.05)
            tds = 600 + 10 * bore + rng.normal(0, 4)
            if bore == 1 and i == days - 1:
                level += 2.5
            if bore == 5 and i >= days - 30:
                tds += 6 * (i - days + 31)
            rows.append((bore, date, float(round(level, 3)), float(round(tds, 2)), 0, "measured"))
    readings = spark.createDataFrame(
        pd.DataFrame(rows, columns=[
            "well_id", "reading_date", "water_level_mbgl", "tds_mg_per_l", "pumping_event", "data_quality_flag"
        ]).astype({"well_id": "int32", "pumping_event": "int32"})
    )
    wells = spark.createDataFrame(
        [(b, f"DH{b}", f"area {(b - 1) // 2}", int(b >= 5)) for b in range(1, bores + 1)],
        "well_id int, source_dh_no string, management_area string, coastal_flag int",
    )
    rain = spark.createDataFrame(
        [(f"s{a}", f"area {a}", START + dt.timedelta(days=i), float(rng.choice([0, 0, 0, 8])), "measured")
         for a in range(3) for i in range(days)],
        "station_id string, management_area string, obs_date date, rainfall_mm double, data_quality_flag string",
    )
    return wells, readings, rain


@pytest.fixture(scope="module")
def data(spark):
    wells, readings, rain = seasonal(spark)
    return wells, readings.cache(), rain.cache()


@pytest.fixture(scope="module")
def frame(data):
    wells, readings, rain = data
    return features.forecast_features(wells, readings, rain.drop("station_id", "data_quality_flag"), 30).cache()


def test_target_is_the_level_thirty_days_later(frame, data):
    later = data[1].select("well_id", F.col("reading_date").alias("target_date"), F.col("water_level_mbgl").alias("later"))
    checked = frame.join(later, ["well_id", "target_date"]).agg(
        F.count("*").alias("n"), F.max(F.abs(F.col("target") - F.col("later"))).alias("gap"),
        F.max(F.datediff("target_date", "reading_date")).alias("days"),
    ).first()
    assert (checked.n, checked.gap, checked.days) == (frame.count(), 0.0, 30)


def test_purged_split_sizes_and_order(frame):
    train, test, cutoff = features.purged_time_split(frame)
    assert (train.count(), test.count()) == (4788, 1242)
    day = frame.limit(1).select(cutoff).first()[0]
    assert train.agg(F.max("target_date")).first()[0] < day <= test.agg(F.min("reading_date")).first()[0]


def test_no_target_among_the_features(frame):
    names = features.feature_columns(frame)
    assert not {"target", "target_date", "water_level_mbgl", "well_id", "reading_date"} & set(names)
    assert {"level_now", "rainfall_mm", "tds_mg_per_l", "coastal_flag", "area_area 0"} <= set(names)


def test_features_against_pandas(spark):
    rng = np.random.default_rng(5)
    rows = [
        (w, START + dt.timedelta(days=2 * i), None if rng.random() < 0.2 else float(round(rng.normal(5, 1), 3)),
         None if rng.random() < 0.3 else float(round(rng.normal(500, 9), 2)))
        for w in (1, 2) for i in range(90)
    ]
    schema = "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double"
    wells = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "well_id int, management_area string, coastal_flag int")
    rain_rows = [(a, START + dt.timedelta(days=i), float(i % 5)) for a in "ab" for i in range(0, 180, 3)]
    rain = spark.createDataFrame(rain_rows, "management_area string, obs_date date, rainfall_mm double")
    got = features.forecast_features(wells, spark.createDataFrame(rows, schema), rain, 7).toPandas()
    got = got.sort_values(["well_id", "reading_date"]).reset_index(drop=True)

    df = pd.DataFrame(rows, columns=["well_id", "reading_date", "level", "tds"])
    df["area"] = df.well_id.map({1: "a", 2: "b"})
    df = df.merge(pd.DataFrame(rain_rows, columns=["area", "reading_date", "mm"]), how="left").fillna({"mm": 0.0})
    g = df.groupby("well_id", group_keys=False)
    want = pd.DataFrame({"well_id": df.well_id, "reading_date": df.reading_date})
    for n in (1, 7, 14, 30):
        want[f"level_lag_{n}"] = g["level"].shift(n)
    for n, k in ((7, 3), (30, 15)):
        want[f"level_roll_mean_{n}"] = g["level"].transform(lambda s, n=n, k=k: s.rolling(n, min_periods=k).mean())
        want[f"level_roll_std_{n}"] = g["level"].transform(lambda s, n=n, k=k: s.rolling(n, min_periods=k).std())
    for n in (7, 14, 30):
        want[f"rain_sum_{n}"] = g["mm"].transform(lambda s, n=n: s.rolling(n, min_periods=1).sum())
    want["tds_mg_per_l"] = g["tds"].ffill()
    want["target"] = g["level"].shift(-7)
    want = want.dropna(subset=["target", "level_lag_30"]).reset_index(drop=True)
    assert list(got.reading_date) == list(want.reading_date)
    for column in want.columns[2:]:
        np.testing.assert_allclose(
            got[column].astype(float), want[column].astype(float), atol=1e-9, err_msg=column
        )


def test_moments_across_batches(spark):
    """Rows of a batch look back into the batches before it, never into another bore's rows."""
    rng = np.random.default_rng(3)
    df = pd.DataFrame({
        "well_id": np.repeat([1, 2, 3], [40, 3, 25]), "reading_date": np.arange(68),
        "v": np.where(rng.random(68) < 0.2, np.nan, rng.normal(50, 9, 68)),
    })
    rows = spark.createDataFrame(df.astype(object).where(df.notna(), None), "well_id int, reading_date int, v double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        of = {("mean_9", "std_9"): ("v", 9, 1, 3), ("mean_4", "std_4"): ("v", 3, 0, 2)}
        got = with_moments(rows.repartition(2, "well_id"), of).toPandas().sort_values("reading_date")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for name, shift, n, k in (("9", 1, 9, 3), ("4", 0, 4, 2)):
        windows = df.groupby("well_id")["v"].transform
        for kind in ("mean", "std"):
            want = windows(lambda s: getattr(s.shift(shift).rolling(n, min_periods=k), kind)())
            np.testing.assert_allclose(got[f"{kind}_{name}"].astype(float), want, atol=1e-9)


def test_anomaly_features_are_finite(data):
    wells, readings, rain = data
    out = features.anomaly_features(wells, readings, rain.drop("station_id", "data_quality_flag"))
    values = out.select(*features.ANOMALY_FEATURES).toPandas().to_numpy()
    assert len(values) and np.isfinite(values).all()


# forecast ------------------------------------------------------------------------


def test_model_beats_persistence_at_sixty_days(data):
    wells, readings, rain = data
    run = forecasting.run_forecast(wells, readings, rain, horizon=60, trees=20, learning_rate=0.2)
    row = run.metrics.first()
    assert row.model_mae_m < row.baseline_mae_m and row.mae_improvement_pct > 0
    assert run.predictions.columns == ["well_id", "reading_date", "target_date", "level_now", "actual", "predicted"]
    top = forecast.feature_importance(run.model).collect()
    assert len(top) == 6 and top[0].importance >= top[-1].importance


def test_missing_feature_is_an_error(frame):
    holed = frame.limit(50).withColumn("tds_mg_per_l", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="(?i)null"):
        forecast.fit_forecast(holed, trees=1)


def test_metrics_by_hand(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 1.5), (1.0, 0.0, 0.5)], "level_now double, actual double, predicted double")
    row = forecast.forecast_metrics(rows).first()
    assert tuple(row) == (2, 0.5, 0.5, 1.0, 1.0, 50.0)


def test_persistence_matches_the_feature_frames(data):
    wells, readings, rain = data
    got = {r.horizon_days: r for r in forecast.persistence_baseline(readings, (7, 30)).collect()}
    frame = features.forecast_features(wells, readings, rain.drop("station_id", "data_quality_flag"), 30)
    _, test, _ = features.purged_time_split(frame)
    mae = test.agg(F.avg(F.abs(F.col("target") - F.col("level_now")))).first()[0]
    assert got[30].n_test == 1242 and got[30].baseline_mae_m == pytest.approx(mae, abs=6e-5)


def test_sweep_matches_a_fit_per_horizon(data):
    """The sweep's baselines are those of persistence, and its errors near those of a fit of its own."""
    wells, readings, rain = data
    rain = rain.drop("station_id", "data_quality_flag")
    got = {r.horizon_days: r for r in forecast.horizon_sweep(wells, readings, rain, (7, 30), trees=4, learning_rate=0.4).collect()}
    naive = {r.horizon_days: r.baseline_mae_m for r in forecast.persistence_baseline(readings, (7, 30)).collect()}
    assert {h: r.baseline_mae_m for h, r in got.items()} == pytest.approx(naive, abs=2e-4)
    train, test, _ = features.purged_time_split(features.forecast_features(wells, readings, rain, 30))
    alone = forecast.forecast_metrics(forecast.predict(forecast.fit_forecast(train, trees=4, learning_rate=0.4), test)).first()
    assert got[30].model_mae_m == pytest.approx(alone.model_mae_m, rel=0.1)


def test_rows_in_files_and_in_the_cache_grow_the_same_trees(spark, monkeypatch):
    """Targets with gaps, a column of one value, more shares than one, more trees than the cache is refreshed after."""
    rng = np.random.default_rng(11)
    rows = [
        (i, START, float(rng.normal()), float(rng.integers(0, 3)), 7.0, float(rng.normal()) if i % 5 else None, float(i % 11))
        for i in range(400)
    ]
    columns = "well_id int, reading_date date, a double, b double, c double, near double, far double"
    train = spark.createDataFrame(rows, columns).repartition(3)
    grown = []
    for folder in (boosting._opened_folder, lambda _: None):
        monkeypatch.setattr(boosting, "_opened_folder", folder)
        grown.append(boosting.fit_boosted(train, ["a", "b", "c"], ("near", "far"), trees=9, learning_rate=0.3))
    for mapped, cached in zip(*grown):
        assert len(mapped.trees) == 9 and mapped.trees == cached.trees and mapped.base == cached.base
    # The first tree's root, counted row by row: the best cut of all rows drawn for it.
    frame, model = train.toPandas(), grown[0][1]
    draw = train.select("well_id", F.expr("xxhash64(well_id, reading_date, 0) & 4294967295L").alias("d")).toPandas()
    word = int.from_bytes(hashlib.md5(b"0|0").digest()[:4], "little") | 1
    frame = frame.merge(draw, on="well_id")
    frame = frame[(frame["d"] * word % 2**32) < int(0.8 * 2**32)]
    gains = {}
    for f, name in enumerate(model.features):
        for cut, edge in enumerate(model.edges[f]):
            left = frame[name] <= edge
            r = frame["far"] - model.base
            if 0 < left.sum() < len(left):
                gains[f, cut] = r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum() - r.sum() ** 2 / len(r)
    assert (model.trees[0]["feature"][0], model.trees[0]["bin"][0]) == max(gains, key=gains.get)


def test_few_partial_quantiles_meet_in_one_task(spark, monkeypatch):
    """However many partitions the rows come in; the cuts are those of the rows."""
    train = spark.range(4000).select(F.col("id").alias("well_id"), F.lit(START).alias("reading_date"), F.col("id").cast("double").alias("a"))
    train = train.withColumn("target", F.col("a") % 7).repartition(40)
    partitions, agg = [], type(train).agg
    monkeypatch.setattr(type(train), "agg", lambda self, *c: partitions.append(self.rdd.getNumPartitions()) or agg(self, *c))
    (model,) = boosting.fit_boosted(train, ["a"], trees=1)
    assert partitions == [max(32, spark.sparkContext.defaultParallelism)]
    assert model.edges == [[float(-(-4000 * i // 32) - 1) for i in range(1, 32)]]


def test_a_share_that_is_read_again_finds_what_it_started_from(tmp_path):
    """The first job of a tree writes its residuals beside those it started from, so its task may run twice."""
    layout, rng = boosting._Layout([4, 3]), np.random.default_rng(2)
    codes = layout.codes(np.stack([rng.integers(0, 4, 50), rng.integers(0, 3, 50)]).astype(np.uint8))
    draw, residuals = rng.integers(0, 2**32, 50, dtype=np.uint32), rng.integers(-99, 99, (2, 50)).astype(np.int32)
    residuals[1, 12:17] = boosting._UNUSED
    (tmp_path / "rows").write_bytes(draw.tobytes() + residuals.tobytes() + codes.tobytes())
    share, name = [(str(tmp_path / "rows"), 50, 10, 45)], str(tmp_path / "0")
    steps = [[([0], [1], np.array([5, -3], dtype=np.int32))], [([1], [0], np.array([1, 2], dtype=np.int32))]]
    want = residuals[:, 10:45]
    for tree in (1, 2, 3, 4):
        want = boosting._advanced(layout, codes[:, 10:45], want, steps)
        for grown in (steps, steps, []):
            (block,) = boosting._mapped(layout, 2, name, share, tree, grown)
            assert (block[0] == draw[10:45]).all() and (block[1] == codes[:, 10:45]).all() and (block[2] == want).all()
    right = layout.codes(np.array([[3], [2]], dtype=np.uint8))
    assert list(layout.node(right, [0, 1, 1], [2, 0, 1])) == [3] and (want[1, 2:7] == boosting._UNUSED).all()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["0-3", "0-4", "rows"]


def test_sweep_finds_its_cutoffs_once(data, monkeypatch):
    """Test rows are filtered by a date at hand, not by a query over the history for each reader."""
    wells, readings, rain = data
    plans, predict = [], forecast.predict
    monkeypatch.setattr(
        forecast, "predict", lambda model, test: plans.append(test._jdf.queryExecution().toString()) or predict(model, test)
    )
    got = forecast.horizon_sweep(wells, readings, rain.drop("station_id", "data_quality_flag"), (14,), trees=2, learning_rate=0.4).first()
    assert len(plans) == 1 and "subquery" not in plans[0].lower()
    assert got.baseline_mae_m == pytest.approx(forecast.persistence_baseline(readings, (14,)).first().baseline_mae_m, abs=2e-4)


# isolation forest -------------------------------------------------------------------


def test_planted_bores_are_flagged(spark, data, tmp_path):
    wells, readings, rain = data
    run = forecasting.run_anomalies(wells, readings, rain, trees=100)
    scores = run.scores
    total, flagged = scores.count(), scores.filter("is_anomaly").count()
    assert 0.005 * total < flagged <= math.ceil(0.01 * total)
    planted = wells.filter("well_id in (1, 5)")
    assert {r.well_id for r in forest.rediscovered_bores(scores, planted).collect()} == {1, 5}
    worst = forest.top_anomalies(scores, 10).collect()
    assert len(worst) == 10 and worst[0].anomaly_score >= worst[-1].anomaly_score > 0

    forecasting.save_anomalies(run, str(tmp_path))
    again = forest.IsolationForestModel.load(spark, f"{tmp_path}/anomaly_model")
    assert (again.features, again.sample_size, again.threshold) == (run.model.features, run.model.sample_size, run.model.threshold)
    points = features.anomaly_features(wells, readings, rain.drop("station_id", "data_quality_flag"))
    keys = ["well_id", "reading_date", "anomaly_score", "is_anomaly"]
    assert {tuple(r) for r in again.transform(points).select(keys).collect()} == {tuple(r) for r in scores.select(keys).collect()}
    stored = spark.read.parquet(f"{tmp_path}/anomaly_scores")
    assert {tuple(r) for r in stored.select(keys).collect()} == {tuple(r) for r in scores.select(keys).collect()}
    top = landed.read_csv_by_name(spark, f"{tmp_path}/top_anomalies", schemas.SCORES)
    assert [r.well_id for r in top.orderBy(F.desc("anomaly_score"), "well_id", "reading_date").collect()] == [r.well_id for r in worst]
    sweep = spark.createDataFrame([(7, 0.1, 0.2, 50.0)], "horizon_days int, model_mae_m double, baseline_mae_m double, improvement_pct double")
    forecasting.save_sweep(sweep, str(tmp_path))
    assert landed.read_csv_by_name(spark, f"{tmp_path}/forecast_horizon_sweep", sweep.schema).collect() == sweep.collect()


def test_forest_separates_an_outlier_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, START, float(rng.normal()), float(rng.normal())) for i in range(500)] + [(999, START, 9.0, -9.0)]
    df = spark.createDataFrame(rows, "well_id int, reading_date date, a double, b double")
    model = forest.fit_isolation_forest(df, ["a", "b"], trees=50)
    scored = model.transform(df)
    assert scored.orderBy(F.col("anomaly_score").desc()).first().well_id == 999
    again = forest.fit_isolation_forest(df.repartition(5), ["a", "b"], trees=50)
    assert again.threshold == model.threshold


def test_scores_against_a_row_by_row_walk(spark):
    rng = np.random.default_rng(8)
    points = [(i, START, float(rng.normal()), float(rng.normal())) for i in range(300)]
    df = spark.createDataFrame(points, "well_id int, reading_date date, a double, b double")
    model = forest.fit_trees(df, ["a", "b"], trees=12, max_samples=64)
    trees = model.trees.orderBy("tree").collect()
    scale = 2 * (math.log(63) + np.euler_gamma) - 2 * 63 / 64

    def walk(row):
        lengths = []
        for tree in trees:
            node = 0
            while node < len(tree.feature):
                node = 2 * node + (2 if row[2 + tree.feature[node]] > tree.threshold[node] else 1)
            lengths.append(tree.path[node - len(tree.feature)])
        return round(2 ** (-np.mean(lengths) / 1e9 / scale), 9)

    got = {r.well_id: r.raw for r in df.select("well_id", model.raw_score(df).alias("raw")).collect()}
    assert got == pytest.approx({p[0]: walk(p) for p in points}, abs=2e-9)


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
def test_path_sums_against_a_walk(depth):
    """Every depth, below and above the levels that are compared for all rows at once."""
    rng = np.random.default_rng(depth)
    columns = [rng.normal(size=50) for _ in range(3)]
    columns[0][:5] = np.nan
    inner = 2**depth - 1
    feature = rng.integers(0, 3, (4, inner)).astype(np.int32)
    threshold = np.where(rng.random((4, inner)) < 0.2, np.inf, rng.normal(size=(4, inner)))
    path = rng.integers(0, 10**10, (4, inner + 1))
    want = np.zeros(50, dtype=np.int64)
    for row in range(50):
        for f, t, p in zip(feature, threshold, path):
            node = 0
            while node < inner:
                node = 2 * node + (2 if columns[f[node]][row] > t[node] else 1)
            want[row] += p[node - inner]
    assert (forest._path_sums(columns, feature, threshold, path) == want).all()


def test_tree_samples_have_the_asked_size(spark):
    df = spark.range(5000).select(F.col("id").cast("int").alias("well_id"), F.lit(START).alias("reading_date"))
    sizes = forest.tree_samples(df, ["well_id", "reading_date"], 20, 64, 5000, 0).groupBy("tree").count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {64}
    small = forest.tree_samples(df.limit(30), ["well_id", "reading_date"], 5, 30, 30, 0)
    assert {r["count"] for r in small.groupBy("tree").count().collect()} == {30}


def test_tiny_table_still_fits(spark):
    df = spark.createDataFrame([(1, START, 1.0), (2, START, 5.0)], "well_id int, reading_date date, a double")
    assert forest.fit_isolation_forest(df, ["a"], trees=5).transform(df).count() == 2
    with pytest.raises(ValueError, match="empty"):
        forest.fit_isolation_forest(df.limit(0), ["a"], trees=5)


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_quantile_against_numpy(spark, q):
    values = np.round(np.random.default_rng(2).random(777), 9)
    values[:50] = values[60]
    df = spark.createDataFrame([(float(v),) for v in values], "score double")
    assert unit_quantile(df, "score", q) == pytest.approx(np.quantile(values, q), abs=1e-12)


# boosting ---------------------------------------------------------------------------


def boosting_rows(spark, n=3000):
    rng = np.random.default_rng(11)
    points = [(i, START, float(rng.random()), float(rng.integers(0, 3)), int(i % 2)) for i in range(n)]
    df = spark.createDataFrame(points, "well_id int, reading_date date, a double, b double, c int")
    return df.withColumn("target", F.when(F.col("a") > 0.5, 3.0).otherwise(0.0) + F.col("b") - 0.5 * F.col("c"))


def test_first_boosted_tree_against_every_split(spark):
    df = boosting_rows(spark).cache()
    model = boosting.fit_boosted(df, ["a", "b", "c"], trees=1, learning_rate=1.0, depth=1, subsample=1.0)[0]
    rows = df.toPandas()
    best = min(
        (((side - side.mean()) ** 2).sum() + ((other - other.mean()) ** 2).sum(), name, cut)
        for name, edges in zip(model.features, model.edges) for cut in edges
        for side, other in [(rows.target[rows[name] <= cut], rows.target[rows[name] > cut])]
    )
    tree = model.trees[0]
    assert (model.features[tree["feature"][0]], model.edges[tree["feature"][0]][tree["bin"][0]]) == best[1:]
    left = rows[best[1]] <= best[2]
    want = np.where(left, rows.target[left].mean(), rows.target[~left].mean())
    got = model.transform(df).select("predicted").toPandas()["predicted"]
    np.testing.assert_allclose(got, want, atol=1e-6)


def test_boosted_trees_do_not_depend_on_placement(spark, tmp_path):
    df = boosting_rows(spark)
    model = boosting.fit_boosted(df, ["a", "b", "c"], trees=62, learning_rate=0.2)[0]
    again = boosting.fit_boosted(df.orderBy(F.desc("a")).repartition(7), ["a", "b", "c"], trees=62, learning_rate=0.2)[0]
    assert again.trees == model.trees and again.edges == model.edges
    error = model.transform(df).agg(F.avg(F.abs(F.col("predicted") - F.col("target")))).first()[0]
    assert error < 0.05 and sum(model.importances) == pytest.approx(1.0)
    model.save(spark, str(tmp_path))
    loaded = boosting.BoostedModel.load(spark, str(tmp_path))
    assert loaded.transform(df).exceptAll(model.transform(df)).count() == 0


def test_models_of_several_targets_grow_in_the_same_jobs(spark):
    """A job per level of a tree, however many models; each learns from the rows that have its target."""
    df = boosting_rows(spark, 400).withColumn("early", F.when(F.col("well_id") < 200, F.col("target") * 2))
    context = spark.sparkContext
    context.setJobGroup("two-models", "")
    both = boosting.fit_boosted(df, ["a", "b", "c"], ("target", "early"), trees=9)
    context.setJobGroup("", "")
    assert len(context.statusTracker().getJobIdsForGroup("two-models")) <= 3 * 9 + 3
    assert both[0].trees == boosting.fit_boosted(df, ["a", "b", "c"], trees=9)[0].trees
    early = df.filter("early is not null").agg(F.avg("early")).first()[0]
    assert both[1].base == pytest.approx(early, abs=1e-8)


def test_boosting_of_a_table_with_nothing_to_learn(spark):
    df = boosting_rows(spark, 20).withColumn("target", F.lit(2.0))
    model = boosting.fit_boosted(df, ["a", "b", "c"], trees=3)[0]
    assert {r.predicted for r in model.transform(df).collect()} == {2.0} and set(model.importances) == {0.0}
    with pytest.raises(ValueError, match="empty"):
        boosting.fit_boosted(df.limit(0), ["a"], trees=1)


def test_one_rolling_mean_without_the_other_features(spark):
    wells = spark.createDataFrame([(1, 1, "a"), (2, 0, "b")], "well_id int, coastal_flag int, management_area string")
    days = [(w, dt.date(2024, 1, 1) + dt.timedelta(days=i), None if i % 9 == w else 5.0 + (i * 7 % 11) / 3, 500.0 + i, "measured") for w in (1, 2) for i in range(90)]
    readings = spark.createDataFrame(days, "well_id int, reading_date date, water_level_mbgl double, tds_mg_per_l double, data_quality_flag string")
    rain = spark.createDataFrame([("a", dt.date(2024, 1, 3), 4.0)], "management_area string, obs_date date, rainfall_mm double")
    few = features.forecast_features(wells, readings, rain, 7, only=["level_roll_mean_7"])
    whole = features.forecast_features(wells, readings, rain, 7)
    names = ["well_id", "reading_date", "target_date", "level_now", "target", "level_roll_mean_7"]
    assert sorted(map(tuple, few.select(names).collect())) == sorted(map(tuple, whole.select(names).collect()))
    assert few.count() > 50 and "rain_sum_7" not in few.columns
    assert "Join" not in few._sc._jvm.PythonSQLUtils.explainString(few._jdf.queryExecution(), "simple")
