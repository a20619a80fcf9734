"""Random-forest demand forecast with Spark MLlib.

Each tree is an MLlib regression tree grown level by level over the cluster;
the trees form one MLlib forest.  A tree's rows are exactly
``subsampling_rate`` of the training rows: those with the smallest hashes of
(row, tree), cut at a threshold found by ``selection.select_ranks``.  The
training rows are stored once, dealt by key into partitions whose number
follows from their count and sorted there, so the model is a function of the
rows: not of the input's layout, nor of the cluster's size.  Missing numbers
take the exact medians of the training part.
"""

from __future__ import annotations

import datetime as _dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import interval_lower, interval_upper
from ..session import cut_lineage
from .features import CATEGORICAL, NUMERIC, TARGET, chronological_split, next_week_rows
from .selection import exact_medians, select_ranks

MODEL_NAME = "random_forest_baseline"  # fixed value
FORECAST_COLUMNS = (
    "store", "dept", "forecast_date", "horizon_days", "predicted_demand", "actual_demand",
    "prediction_interval_lower", "prediction_interval_upper", "model_name", "model_version", "trained_at",
    "created_at",
)


@dataclass
class ForestParams:
    """Defaults of the reference's training CLI."""

    test_size: float = 0.2
    seed: int = 42
    num_trees: int = 50
    max_depth: int = 16
    min_instances_per_node: int = 5
    subsampling_rate: float = 0.65
    # 256 bins keep one bin per distinct store and department id (the
    # default 32 cannot); node statistics of up to 512 MB per pass bound the
    # memory of each concurrent task while keeping deep levels to few passes.
    max_bins: int = 256
    max_memory_mb: int = 512
    rows_per_partition: int = 50_000  # of the stored training rows
    concurrent_trees: int = 8  # trees grown at a time; no part of the result


@dataclass
class TrainedForecast:
    model: PipelineModel
    metrics: dict = field(default_factory=dict)

    @property
    def version(self) -> str:
        return self.metrics["model_version"]

    @property
    def trained_at(self) -> _dt.datetime:
        return _dt.datetime.fromisoformat(self.metrics["trained_at"])


def model_version(trained_at: _dt.datetime) -> str:
    return "baseline_rf_" + trained_at.strftime("%Y-%m-%dT%H%M%SZ")


def _prepare(frame: DataFrame) -> DataFrame:
    """Numeric features as doubles (bool and int included)."""
    return frame.select(
        "date", F.col(TARGET).cast("double").alias(TARGET), *[F.col(c).cast("double").alias(c) for c in NUMERIC],
        *CATEGORICAL,
    )


def _fills(train: DataFrame) -> tuple[dict[str, float], dict[str, str]]:
    """What missing values become: exact medians of the numeric columns (0 for
    one without values), the most frequent store type."""
    medians = {c: 0.0 if m is None else m for c, m in exact_medians(train, NUMERIC).items()}
    modes = {}
    for c in CATEGORICAL:
        top = train.where(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).first()
        modes[c] = top[c] if top is not None else "__missing__"
    return medians, modes


def _fill(df: DataFrame, medians: dict[str, float], modes: dict[str, str]) -> DataFrame:
    return df.fillna(medians).fillna(modes)


def encoding_pipeline() -> Pipeline:
    """Feature vectors: numbers as they are, one-hot store types (an unseen type is all zeros)."""
    return Pipeline(stages=[
        StringIndexer(inputCols=list(CATEGORICAL), outputCols=[f"{c}__idx" for c in CATEGORICAL], handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}__idx" for c in CATEGORICAL], outputCols=[f"{c}__vec" for c in CATEGORICAL],
                      dropLast=True, handleInvalid="keep"),
        VectorAssembler(inputCols=[*NUMERIC, *[f"{c}__vec" for c in CATEGORICAL]], outputCol="features"),
    ])


def row_draw(tree: Column, seed: int) -> Column:
    """The draw that decides whether a row (its stored hash) is in a tree's sample."""
    return F.xxhash64("__row", F.lit(seed), tree)


def sample_thresholds(rows: DataFrame, params: ForestParams) -> list[int]:
    """The largest draw in each tree's sample: the rows up to it are exactly
    ``round(subsampling_rate * n)``, at least one (equal rows share a draw)."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(params.num_trees - 1))).alias("i")
    draws = rows.select("__row", trees).select("i", row_draw(F.col("i"), params.seed).alias("k"))
    found = select_ranks(draws, params.num_trees, lambda _, n: [max(1, round(params.subsampling_rate * n)) - 1])
    return [next(iter(by_rank.values())) for _, by_rank in found]


def sample_report(frame: DataFrame, params: ForestParams | None = None) -> DataFrame:
    """tree, training_rows and sampled_rows: the size of each tree's sample."""
    params = params or ForestParams()
    train_part = chronological_split(_prepare(frame), params.test_size).train
    rows = cut_lineage(train_part.select(F.xxhash64(*train_part.columns).alias("__row")))
    limits = list(enumerate(sample_thresholds(rows, params)))
    limits = rows.sparkSession.createDataFrame(limits, "tree int, most long")  # a row for each tree
    trees = F.explode(F.sequence(F.lit(0), F.lit(params.num_trees - 1))).alias("tree")
    draws = rows.select("__row", trees).join(F.broadcast(limits), "tree")
    return draws.groupBy("tree").agg(
        F.count(F.lit(1)).alias("training_rows"),
        F.count_if(row_draw(F.col("tree"), params.seed) <= F.col("most")).alias("sampled_rows"))


def grow(rows: DataFrame, params: ForestParams) -> RandomForestRegressionModel:
    """One MLlib forest of trees that are grown each on its own sample of ``rows``."""
    thresholds = sample_thresholds(rows, params)

    def tree(number: int) -> DecisionTreeRegressionModel:
        sample = rows.where(row_draw(F.lit(number), params.seed) <= F.lit(thresholds[number])).select("features", TARGET)
        return DecisionTreeRegressor(
            featuresCol="features", labelCol=TARGET, maxDepth=params.max_depth, seed=params.seed,
            minInstancesPerNode=params.min_instances_per_node, maxBins=params.max_bins,
            maxMemoryInMB=params.max_memory_mb, cacheNodeIds=True, checkpointInterval=10,
        ).fit(sample)

    with ThreadPoolExecutor(params.concurrent_trees) as pool:
        trees = list(pool.map(tree, range(params.num_trees)))
    return as_forest(rows, trees)


def as_forest(rows: DataFrame, trees: list[DecisionTreeRegressionModel]) -> RandomForestRegressionModel:
    """The trees as one MLlib model, which averages them (and saves as one)."""
    context = rows.sparkSession.sparkContext
    package = context._jvm.org.apache.spark.ml.regression
    array = context._gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t._java_obj
    uid = f"forest_{len(trees)}_{trees[0].numFeatures}"
    model = package.RandomForestRegressionModel(uid, array, trees[0].numFeatures)
    model.set("featuresCol", "features")
    model.set("numTrees", len(trees))  # what the trees' sum is divided by
    return RandomForestRegressionModel(model)


def holdout_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE, WAPE (0 on a zero denominator) over scored holdout rows."""
    err = F.col(TARGET) - F.col("prediction")
    den = F.sum(F.abs(F.col(TARGET)))
    return predictions.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(F.sum(F.abs(err)), den)).alias("wape"),
        F.count(F.lit(1)).alias("validation_rows"),
    )


def train(frame: DataFrame, params: ForestParams | None = None, trained_at: _dt.datetime | None = None) -> TrainedForecast:
    """Fit the forecaster on the chronological training part, score the
    holdout, and return the model with its metrics (H1, H2, E4, D17)."""
    params = params or ForestParams()
    trained_at = (trained_at or _dt.datetime.now(_dt.timezone.utc)).replace(microsecond=0, tzinfo=None)
    prepared = cut_lineage(_prepare(frame))
    split = chronological_split(prepared, params.test_size)
    medians, modes = _fills(split.train)
    filled = _fill(split.train, medians, modes)
    encoder = encoding_pipeline().fit(filled)
    # The same rows in the same places whatever the input's layout: MLlib's own
    # sampling (of split candidates) and its sums go by partition.
    place = [F.col("__row"), *[F.col(c) for c in filled.columns]]
    rows = encoder.transform(filled.withColumn("__row", F.xxhash64(*filled.columns)))
    rows = rows.repartition(max(1, -(-split.train_rows // params.rows_per_partition)), "__row").sortWithinPartitions(*place)
    forest = grow(cut_lineage(rows.select("__row", "features", TARGET)), params)
    model = PipelineModel([*encoder.stages, forest])
    scored = model.transform(_fill(split.test, medians, modes))
    m = holdout_metrics(scored).first().asDict()
    span = prepared.agg(F.min("date").alias("s"), F.max("date").alias("e")).first()
    metrics = {
        "model_name": MODEL_NAME,
        "model_version": model_version(trained_at),
        "trained_at": trained_at.isoformat(),
        "training_rows": split.train_rows,
        "validation_rows": split.test_rows,
        "n_estimators": params.num_trees,
        "max_depth": params.max_depth,
        "min_samples_leaf": params.min_instances_per_node,
        "max_samples": params.subsampling_rate,
        "start_date": str(span["s"]),
        "end_date": str(span["e"]),
        "mae": m["mae"],
        "rmse": m["rmse"],
        "wape": m["wape"],
        "fill_medians": medians,
        "fill_modes": modes,
    }
    return TrainedForecast(model, metrics)


def save(trained: TrainedForecast, path: str) -> None:
    """Persist the pipeline and its metrics next to it (H3)."""
    from pyspark.sql import SparkSession

    trained.model.write().overwrite().save(f"{path}/pipeline")
    s = SparkSession.getActiveSession()
    s.createDataFrame([(json.dumps(trained.metrics, default=str),)], "metrics string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/metrics")


def load(path: str) -> TrainedForecast:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    model = PipelineModel.load(f"{path}/pipeline")
    metrics = json.loads(s.read.json(f"{path}/metrics").first()["metrics"])
    return TrainedForecast(model, metrics)


def metrics_frame(trained: TrainedForecast) -> DataFrame:
    """The metrics as a one-row table."""
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    m = {k: v for k, v in trained.metrics.items() if not isinstance(v, dict)}
    return s.createDataFrame([m])


def forecast_output(frame: DataFrame, trained: TrainedForecast, created_at: _dt.datetime | None = None) -> DataFrame:
    """Score every observed row (horizon 0) and one next-week row per
    (store, dept) (horizon 7); 2-place rounding and interval (H4, G2, B20)."""
    created_at = (created_at or _dt.datetime.now(_dt.timezone.utc)).replace(microsecond=0, tzinfo=None)
    medians, modes = trained.metrics["fill_medians"], trained.metrics["fill_modes"]
    observed = _prepare(frame).withColumn("horizon_days", F.lit(0)).withColumn("actual_demand", F.round(TARGET, 2))
    future = (
        _prepare(next_week_rows(frame)).withColumn("horizon_days", F.lit(7))
        .withColumn("actual_demand", F.lit(None).cast("double"))
    )
    both = observed.unionByName(future)
    scored = trained.model.transform(_fill(both, medians, modes))
    pred = F.round("prediction", 2)
    return scored.select(
        F.col("store").cast("int").alias("store"), F.col("dept").cast("int").alias("dept"),
        F.col("date").alias("forecast_date"), "horizon_days", pred.alias("predicted_demand"), "actual_demand",
        interval_lower(pred, 2).alias("prediction_interval_lower"),
        interval_upper(pred, 2).alias("prediction_interval_upper"),
        F.lit(MODEL_NAME).alias("model_name"), F.lit(trained.version).alias("model_version"),
        F.lit(trained.trained_at).cast("timestamp_ntz").alias("trained_at"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )
