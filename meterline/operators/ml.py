"""Tip regression: features, split, train, inspect, evaluate, predict,
explain, tune, persist (M1-M9).

Training and scoring are ``pyspark.ml`` estimators and transformers, so they
run distributed; every statistic below is one aggregate pass, and the
per-row explanation is a pure column expression (no UDF).

Categorical features (location and payment codes as text) are one-hot
encoded with the least frequent category as the all-zero baseline, so the
design stays full rank next to the intercept.  A category unseen in
training is scored as that baseline.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.operators.joins import LOOKUP_MAX_ROWS
from meterline.operators.search import Space, search

LABEL = "tip_amount"
NUMERIC_FEATURES = ["passenger_count", "trip_distance", "fare_amount", "tolls_amount"]
CATEGORICAL_FEATURES = ["PULocationID", "DOLocationID", "payment_type"]
NULL_CATEGORY = "__null__"


def ml_features(raw: DataFrame, keep=()) -> DataFrame:
    """M1: the feature table: codes cast to text (categorical), amounts as
    DOUBLE, rows with a zero fare dropped (NULL fares drop out too).
    ``keep`` carries extra columns (e.g. a row key for the split)."""
    return raw.filter(F.col("fare_amount") != 0).select(
        *keep,
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("PULocationID").cast("string").alias("PULocationID"),
        F.col("DOLocationID").cast("string").alias("DOLocationID"),
        F.col("payment_type").cast("string").alias("payment_type"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
        F.col("tolls_amount").cast("double").alias("tolls_amount"),
        F.col("tip_amount").cast("double").alias("tip_amount"),
    )


def split_bucket(key: Column) -> Column:
    """Stable bucket 0..99 of a row key: first 16 bits of md5, mod 100."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("int"),
                  F.lit(100))


def split(df: DataFrame, key: Column, eval_pct: int = 20) -> DataFrame:
    """M8: adds ``split`` = 'eval' for buckets below ``eval_pct``, else 'train'.

    Depends only on the row key, never on partitioning or a random seed, so a
    re-run (or a retried task) assigns every row the same side.
    """
    return df.withColumn("split", F.when(split_bucket(key) < eval_pct, "eval").otherwise("train"))


def _prep(df: DataFrame, categorical) -> DataFrame:
    return df.fillna(NULL_CATEGORY, subset=list(categorical)) if categorical else df


@dataclass
class TipModel:
    """A fitted pipeline plus what scoring and explaining need."""
    pipeline: PipelineModel
    label: str
    numeric: list[str]
    categorical: list[str]
    labels: dict[str, list[str]] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    frequencies: dict[str, dict[str, float]] = field(default_factory=dict)

    @property
    def prediction_col(self) -> str:
        return f"predicted_{self.label}"

    @property
    def linear(self):
        return self.pipeline.stages[-1]

    def coefficients(self) -> tuple[float, dict[str, float], dict[str, dict[str, float]]]:
        """(intercept, numeric coefficient per feature, categorical coefficient
        per feature and category; the baseline category has 0)."""
        coef = list(self.linear.coefficients)
        pos = 0
        cat: dict[str, dict[str, float]] = {}
        for c in self.categorical:
            labs = self.labels[c]
            cat[c] = {lab: (coef[pos + i] if i < len(labs) - 1 else 0.0)
                      for i, lab in enumerate(labs)}
            pos += len(labs) - 1
        num = {c: coef[pos + i] for i, c in enumerate(self.numeric)}
        return float(self.linear.intercept), num, cat


def _pipeline(label, numeric, categorical, reg_param=0.0, elastic_net=0.0) -> Pipeline:
    stages = []
    idx = [f"{c}__idx" for c in categorical]
    vec = [f"{c}__vec" for c in categorical]
    if categorical:
        stages += [StringIndexer(inputCols=list(categorical), outputCols=idx,
                                 stringOrderType="frequencyDesc", handleInvalid="error"),
                   OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True)]
    imputed = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean"))
    stages.append(VectorAssembler(inputCols=vec + imputed, outputCol="features__",
                                  handleInvalid="error"))
    stages.append(LinearRegression(featuresCol="features__", labelCol=label,
                                   predictionCol=f"predicted_{label}", regParam=reg_param,
                                   elasticNetParam=elastic_net, maxIter=200, tol=1e-9))
    return Pipeline(stages=stages)


def penalty(l1: float, l2: float) -> tuple[float, float]:
    """Map (l1, l2) strengths to Spark's (regParam, elasticNetParam)."""
    total = float(l1) + float(l2)
    return total, (float(l1) / total if total else 0.0)


def _finish(pm: PipelineModel, df: DataFrame, label, numeric, categorical) -> TipModel:
    labels = {}
    if categorical:
        sim = pm.stages[0]
        labels = {c: list(ls) for c, ls in zip(categorical, sim.labelsArray)}
    means = {}
    if numeric:
        row = df.agg(*[F.avg(c).alias(c) for c in numeric]).first()
        means = {c: float(row[c]) if row[c] is not None else 0.0 for c in numeric}
    freqs = {}
    total = None
    for c in categorical:
        # one row per category: bounded by the model's own size; the counts
        # of any one column sum to the row count (no separate count pass)
        counts = df.groupBy(c).count().collect()
        if total is None:
            total = sum(r["count"] for r in counts)
        freqs[c] = {r[c]: r["count"] / total for r in counts}
    return TipModel(pm, label, list(numeric), list(categorical), labels, means, freqs)


def train(df: DataFrame, label: str = LABEL, numeric=None, categorical=None,
          l1: float = 0.0, l2: float = 0.0) -> TipModel:
    """M2: fit the regression on rows with a non-NULL label."""
    numeric = NUMERIC_FEATURES if numeric is None else list(numeric)
    categorical = CATEGORICAL_FEATURES if categorical is None else list(categorical)
    data = _prep(df.filter(F.col(label).isNotNull()), categorical)
    reg, en = penalty(l1, l2)
    # Fitting makes several passes (indexer, imputer, solver, statistics):
    # keep the input in memory/disk for their duration (lost blocks are
    # recomputed from lineage).
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pm = _pipeline(label, numeric, categorical, reg, en).fit(data)
        return _finish(pm, data, label, numeric, categorical)
    finally:
        data.unpersist()


def _orig(c: str) -> str:
    return f"{c}__orig"


def _value(c: str) -> str:
    return f"{c}__value"


def _category_table(spark: SparkSession, c: str, labels, values) -> DataFrame:
    """(<c>__known, <c>__value): a feature's categories and a number for each;
    broadcast only if they are few."""
    rows = [(x, None if values is None else float(values[x])) for x in labels]
    table = spark.createDataFrame(rows, f"`{c}__known` string, `{_value(c)}` double")
    return F.broadcast(table) if len(rows) <= LOOKUP_MAX_ROWS else table


def _map_unseen(model: TipModel, df: DataFrame, values=None) -> DataFrame:
    """Model-ready copy of ``df``: NULL and unseen categories mapped to the
    baseline category; the caller's values are kept in ``<c>__orig``.
    ``values`` (feature, then category) adds its number as ``<c>__value``.
    Categories are joined as a table: a plan does not grow with them."""
    for c in model.categorical:
        df = df.withColumn(_orig(c), F.col(c))
    df = _prep(df, model.categorical)
    for c in model.categorical:
        labs = model.labels[c]
        own = None if values is None else values[c]
        df = df.join(_category_table(df.sparkSession, c, labs, own), F.col(c) == F.col(f"{c}__known"), "left")
        df = df.withColumn(c, F.coalesce(f"{c}__known", F.lit(labs[-1]))).drop(f"{c}__known")
        df = (df.drop(_value(c)) if own is None
              else df.withColumn(_value(c), F.coalesce(_value(c), F.lit(float(own[labs[-1]])))))
    return df


def _inputs(model: TipModel, columns) -> list[Column]:
    return [F.col(_orig(c)).alias(c) if c in model.categorical else F.col(c) for c in columns]


def predict(model: TipModel, df: DataFrame) -> DataFrame:
    """M5: inputs plus ``predicted_<label>``."""
    scored = model.pipeline.transform(_map_unseen(model, df))
    return scored.select(*_inputs(model, df.columns), model.prediction_col)


def medians(df: DataFrame, columns) -> DataFrame:
    """(input, median): the exact lower median of each column's non-NULL
    values, at any size.

    Equal values are counted with a partial aggregate, the distinct values
    are range-partitioned and written once; a total per partition tells
    which one holds the middle, and only those partitions (one a column) are
    summed up in order.  No task sees a whole column.
    """
    from meterline.operators.sinks import materialize
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    counts = (df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (input, value)"))
              .filter("value IS NOT NULL").groupBy("input", "value").agg(F.count("*").alias("n")))
    parts = materialize(counts.repartitionByRange("input", "value")
                        .withColumn("part", F.spark_partition_id()), "value_counts")
    # one row per column and partition
    totals = parts.groupBy("input", "part").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy("input").orderBy("part")
    middle = (totals.withColumn("through", F.sum("n").over(up_to))
              .withColumn("all", F.sum("n").over(Window.partitionBy("input")))
              .withColumn("before", F.col("through") - F.col("n"))
              .filter("2 * through >= all AND 2 * before < all").select("input", "part", "before", "all"))
    inside = parts.join(middle, ["input", "part"])
    running = F.col("before") + F.sum("n").over(Window.partitionBy("input").orderBy("value"))
    return (inside.withColumn("through", running).filter("2 * through >= all")
            .groupBy("input").agg(F.min("value").alias("median")))


def feature_info(df: DataFrame, numeric=None, categorical=None, scale: str = "decimal(18,4)") -> DataFrame:
    """M3: per input column: min, max, mean, median, stddev (numeric),
    category count (categorical) and null count.

    Means are sums of decimals of ``scale``, which do not depend on the order
    of rows; give a wider one if the inputs have more places.
    """
    numeric = NUMERIC_FEATURES if numeric is None else list(numeric)
    categorical = CATEGORICAL_FEATURES if categorical is None else list(categorical)
    parts = []
    if numeric:
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in numeric)
        x = F.col("value")
        stats = (df.select(F.expr(f"stack({len(numeric)}, {pairs}) AS (input, value)")).groupBy("input").agg(
            F.min(x).alias("min"), F.max(x).alias("max"),
            (F.sum(x.cast(scale)).cast("double") / F.nullif(F.count(x), F.lit(0))).alias("mean"),
            F.round(F.stddev_samp(x), 6).alias("stddev"), F.count_if(x.isNull()).alias("null_count")))
        parts.append(stats.join(medians(df, numeric), "input", "left").select(
            "input", "min", "max", "mean", "median", "stddev",
            F.lit(None).cast("bigint").alias("category_count"), "null_count"))
    if categorical:
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in categorical)
        nd = F.lit(None).cast("double")
        values = (df.select(F.expr(f"stack({len(categorical)}, {pairs}) AS (input, value)"))
                  .groupBy("input", "value").agg(F.count("*").alias("n")))
        parts.append(values.groupBy("input").agg(
            F.count("value").alias("category_count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count")).select(
            "input", *[nd.alias(c) for c in ("min", "max", "mean", "median", "stddev")],
            "category_count", "null_count"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """M4: MAE, MSE, MSLE, median absolute error, R², explained variance in
    one aggregate over (label, prediction) pairs.

    The squared log error has no value where label or prediction is -1 or
    less; it is the mean over the other rows, and ``rows_without_log`` says
    how many it leaves out.
    """
    pairs = scored.filter(F.col(label).isNotNull()).select(
        F.col(label).alias("y"), F.col(prediction).alias("p"))
    pairs = pairs.withColumn("e", F.col("p") - F.col("y")).withColumn("abs_e", F.abs("e"))
    y, p, e = F.col("y"), F.col("p"), F.col("e")
    has_log = (y > -1) & (p > -1)
    sq_log = F.when(has_log, F.pow(F.log1p(p) - F.log1p(y), 2))
    rest = pairs.agg(
        F.avg("abs_e").alias("mean_absolute_error"),
        F.avg(e * e).alias("mean_squared_error"),
        F.avg(sq_log).alias("mean_squared_log_error"),
        F.count_if(~has_log).alias("rows_without_log"),
        (1 - F.avg(e * e) / F.var_pop(y)).alias("r2_score"),
        (1 - F.var_pop(e) / F.var_pop(y)).alias("explained_variance"),
    ).withColumn("input", F.lit("abs_e"))
    return rest.join(medians(pairs, ["abs_e"]), "input", "left").select(
        "mean_absolute_error", "mean_squared_error", "mean_squared_log_error", "rows_without_log",
        F.col("median").alias("median_absolute_error"), "r2_score", "explained_variance")


def evaluate(model: TipModel, df: DataFrame) -> DataFrame:
    """M4 on a query's rows (use the M8 hold-out, not the training rows)."""
    return regression_metrics(predict(model, df), model.label, model.prediction_col)


def explain(model: TipModel, df: DataFrame, top_k: int = 3) -> DataFrame:
    """M6: prediction plus the ``top_k`` features by |attribution|.

    Attribution of a numeric feature = coefficient × (x − training mean); of
    a categorical one = its category's coefficient − the training-weighted
    mean coefficient.  Baseline = prediction at the training means, so
    baseline + Σ attributions = prediction.
    """
    intercept, num, cat = model.coefficients()
    attributions: dict[str, Column] = {}
    of_category: dict[str, dict[str, float]] = {}
    baseline = intercept
    for c in model.numeric:
        mean = model.means[c]
        x = F.coalesce(F.col(c).cast("double"), F.lit(mean))
        attributions[c] = F.lit(num[c]) * (x - F.lit(mean))
        baseline += num[c] * mean
    for c in model.categorical:
        coefs = cat[c]
        center = sum(coefs.get(k, 0.0) * f for k, f in model.frequencies[c].items())
        of_category[c] = {k: v - center for k, v in coefs.items()}
        attributions[c] = F.col(_value(c))
        baseline += center
    ranked = F.sort_array(F.array(*[
        F.struct((-F.abs(a)).alias("k"), F.lit(n).alias("feature"), a.alias("attribution"))
        for n, a in attributions.items()]))
    top = F.transform(F.slice(ranked, 1, top_k),
                      lambda s: F.struct(s["feature"].alias("feature"),
                                         s["attribution"].alias("attribution")))
    total = None
    for a in attributions.values():
        total = a if total is None else total + a
    out = model.pipeline.transform(_map_unseen(model, df, of_category)).select(
        *_inputs(model, df.columns), model.prediction_col,
        top.alias("top_feature_attributions"),
        F.lit(baseline).alias("baseline_prediction_value"),
        (F.lit(baseline) + total).alias("prediction_value"))
    return out


def tune(df: DataFrame, key: Column, label: str = LABEL, numeric=None, categorical=None,
         trials: int = 5, parallelism: int = 2, seed: int = 42,
         l1_range=(0.0, 20.0), l2_candidates=(0.0, 0.1, 1.0, 10.0), eval_pct: int = 20):
    """M7: ``trials`` settings of (l1, l2), ``parallelism`` at a time, fitted on
    the deterministic train split and scored on the eval split; returns
    (trial table, best model).  After the first few, each setting is where a
    model of the scores so far expects most (``search.py``); the seed fixes
    them.  Indexing, imputing and the statistics are done once; the trials
    differ in the regression only."""
    numeric = NUMERIC_FEATURES if numeric is None else list(numeric)
    categorical = CATEGORICAL_FEATURES if categorical is None else list(categorical)
    space = Space({"l1": tuple(l1_range)}, {"l2": list(l2_candidates)})
    data = _prep(split(df.filter(F.col(label).isNotNull()), key, eval_pct), categorical)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    train_rows = data.filter(F.col("split") == "train").drop("split")
    eval_rows = data.filter(F.col("split") == "eval").drop("split")
    *stages, _ = _pipeline(label, numeric, categorical).getStages()
    prepared = Pipeline(stages=stages).fit(train_rows)
    base = _finish(prepared, train_rows, label, numeric, categorical)
    fit_on = prepared.transform(train_rows).select("features__", label).persist(StorageLevel.MEMORY_AND_DISK)
    score_on = prepared.transform(_map_unseen(base, eval_rows)).select(
        "features__", label).persist(StorageLevel.MEMORY_AND_DISK)

    def run(setting):
        l1, l2 = setting["l1"], setting["l2"]
        reg, en = penalty(l1, l2)
        regression = _pipeline(label, numeric, categorical, reg, en).getStages()[-1].fit(fit_on)
        scored = regression.transform(score_on)
        e = F.col(base.prediction_col) - F.col(label)
        r = scored.agg(F.avg(e * e).alias("mse"),
                       (1 - F.avg(e * e) / F.var_pop(label)).alias("r2")).first()
        return l1, l2, reg, en, r["mse"], r["r2"], regression

    results: list[tuple] = []
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            def score(settings):
                found = list(pool.map(run, settings))
                results.extend([(len(results) + i, *r) for i, r in enumerate(found)])
                return [r[4] for r in found]

            search(score, space, trials, max(1, parallelism), seed)
    finally:
        for kept in (fit_on, score_on, data):
            kept.unpersist()
    spark = df.sparkSession
    table = spark.createDataFrame(
        [r[:7] for r in results],
        "trial_id int, l1_reg double, l2_reg double, reg_param double, elastic_net_param double, "
        "eval_mean_squared_error double, eval_r2_score double")
    best = min(results, key=lambda r: r[5])
    return table, replace(base, pipeline=PipelineModel([*prepared.stages, best[7]]))


STATISTICS = "statistics"


def save(model: TipModel, path: str) -> str:
    """M9: replace the persisted model at ``path``: the pipeline, and beside
    it the feature lists, means and frequencies that explaining needs."""
    model.pipeline.write().overwrite().save(path)
    spark = SparkSession.active()
    text = json.dumps({"label": model.label, "numeric": model.numeric, "categorical": model.categorical,
                       "labels": model.labels, "means": model.means, "frequencies": model.frequencies})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path.rstrip('/')}/{STATISTICS}")
    return path


def load(path: str) -> TipModel:
    """Reload a persisted model, ready to predict and to explain."""
    pm = PipelineModel.load(path)
    spark = SparkSession.active()
    known = json.loads(spark.read.text(f"{path.rstrip('/')}/{STATISTICS}", wholetext=True).first()[0])
    return TipModel(pm, known["label"], known["numeric"], known["categorical"], known["labels"],
                    known["means"], known["frequencies"])
