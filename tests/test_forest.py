"""The forest beats predicting the training mean on the chronological holdout."""

from pyspark.sql import functions as F

from shelfcast.operators import features, forest
from shelfcast.plans.warehouse import Warehouse

from conftest import SF_SMALL


def test_samples_are_exact_and_differ(spark):
    rows = spark.range(1001).select(F.xxhash64("id").alias("__row"))
    params = forest.ForestParams(num_trees=4)
    limits = forest.sample_thresholds(rows, params)
    samples = [frozenset(r[0] for r in rows.where(forest.row_draw(F.lit(t), params.seed) <= limits[t]).collect()) for t in range(4)]
    assert {len(x) for x in samples} == {round(0.65 * 1001)} and len(set(samples)) == 4
    assert forest.sample_thresholds(rows.limit(1), params) and len(limits) == 4


def test_predictions_do_not_depend_on_the_layout(spark):
    w = Warehouse.from_testdata(spark, SF_SMALL)
    frame = features.training_frame(w.raw["sales"], w.raw["stores"], w.raw["features"]).where("store < 6")
    frame = spark.createDataFrame(frame.toPandas(), frame.schema)
    params = forest.ForestParams(num_trees=3, max_depth=6, rows_per_partition=100)
    got = []
    for layout in (frame.repartition(2, "dept"), frame.repartition(4), frame.repartition(32, "date")):
        trained = forest.train(layout, params)
        out = forest.forecast_output(frame, trained).select("store", "dept", "forecast_date", "horizon_days", "predicted_demand")
        got.append((sorted(map(tuple, out.collect())), trained.metrics["fill_medians"]))
    assert got[0] == got[1] == got[2]


def test_forest_beats_mean(spark, scratch):
    w = Warehouse.from_testdata(spark, SF_SMALL)
    frame = features.training_frame(w.raw["sales"], w.raw["stores"], w.raw["features"])
    trained = forest.train(frame, forest.ForestParams(num_trees=10, max_depth=8))
    sp = features.chronological_split(frame, 0.2)
    mean = sp.train.agg(F.avg("weekly_sales")).first()[0]
    base = sp.test.agg(F.sqrt(F.avg((F.col("weekly_sales") - mean) ** 2))).first()[0]
    # The small tables' weekly sums carry little signal in the features:
    # the forest stays close to the mean predictor ...
    assert trained.metrics["rmse"] < 1.1 * base
    # ... and clearly beats it once the target depends on the features.
    signal = frame.withColumn("weekly_sales", F.col("store") * 1000.0 + F.col("dept") * 300.0
                              + F.col("month") * 50.0 + F.col("weekly_sales") / 100.0)
    strong = forest.train(signal, forest.ForestParams(num_trees=10, max_depth=8))
    sp2 = features.chronological_split(signal, 0.2)
    mean2 = sp2.train.agg(F.avg("weekly_sales")).first()[0]
    base2 = sp2.test.agg(F.sqrt(F.avg((F.col("weekly_sales") - mean2) ** 2))).first()[0]
    assert strong.metrics["rmse"] < 0.5 * base2
    assert trained.metrics["training_rows"] + trained.metrics["validation_rows"] == frame.count()
    out = forest.forecast_output(frame, trained)
    groups = frame.select("store", "dept").distinct().count()
    assert out.count() == frame.count() + groups
    assert out.where("horizon_days = 7 and actual_demand is not null").count() == 0
    assert out.where("prediction_interval_lower < 0").count() == 0
    forest.save(trained, f"{scratch}/model")
    again = forest.load(f"{scratch}/model")
    assert again.metrics["model_version"] == trained.metrics["model_version"]
    some = frame.limit(20)
    assert forest.forecast_output(some, again, again.trained_at).exceptAll(
        forest.forecast_output(some, trained, trained.trained_at)).count() == 0
