"""Fitted models: logistic grid, tree search, champion rule, folds, calibration.

The frames handed in should be persisted by the caller when many fits follow. What comes
back to the driver is one row of metrics per trial.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators import boosting, isotonic, search, stages
from sprintlens.operators.features import add_balanced_weight, folds
from sprintlens.operators.metrics import mcnemar, metric_suite
from sprintlens.operators.oversample import smote
from sprintlens.operators.scoring import predict
from sprintlens.operators.shaping import with_row
from sprintlens.session import scratch_dir

DELIVERY = ("deploy_frequency_weekly", "change_failure_rate")


def model_frame(matrix: DataFrame, features: Sequence[str] = P.FEATURES, label: str = P.LABEL) -> DataFrame:
    """Doubles for the model boundary; missing delivery values become 0 beside their flag."""
    keep = [c for c in ("sprint_id", "project", "split") if c in matrix.columns]
    year = [F.col("sprint_year").alias("year")] if "sprint_year" in matrix.columns else []
    return matrix.select(
        *keep,
        *year,
        F.col(label).cast("double").alias(label),
        *[
            (F.coalesce(F.col(f), F.lit(0)) if f in DELIVERY else F.col(f)).cast("double").alias(f)
            for f in features
        ],
    )


def packed(df: DataFrame, *keys: str) -> DataFrame:
    """Persisted rows in `spark.sql.shuffle.partitions` partitions, for the many jobs of a fit.

    Tree learners draw their bags per partition: with the row id as key, rows are placed by
    that id and the session's setting, not by files or the number of rows. The caller releases
    the frame.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys).persist()


def preparation(features: Sequence[str] = P.FEATURES) -> Pipeline:
    """Median imputation, assembly, standard scaling."""
    clean = [f"{f}__i" for f in features]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=list(features), outputCols=clean),
            VectorAssembler(inputCols=clean, outputCol="assembled"),
            StandardScaler(withMean=True, withStd=True, inputCol="assembled", outputCol="features"),
        ]
    )


def logistic(inverse_penalty: float, penalty: str, weight_sum: float, label: str = P.LABEL) -> LogisticRegression:
    """C multiplies the summed loss, Spark's regParam the mean loss: 1 / (C * sum of weights)."""
    return LogisticRegression(
        labelCol=label,
        weightCol="weight",
        regParam=1.0 / (inverse_penalty * weight_sum),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        standardization=False,
        maxIter=100,
    )


def without_summary(model, spark: SparkSession):
    """The model saved and loaded again. The summary of its training, which a fitted model takes
    along into every task, holds the session: once rows are observed in that session, such a
    model can't be sent to tasks."""
    path = scratch_dir(spark, "fitted")
    model.write().session(spark).save(path)
    return type(model).read().session(spark).load(path)


def tree_pipeline(estimator: Estimator, features: Sequence[str] = P.FEATURES) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
            estimator,
        ]
    )


# -- trials -----------------------------------------------------------------------

TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("study", T.StringType()),
        T.StructField("trial", T.IntegerType()),
        T.StructField("params_hash", T.StringType()),
        T.StructField("params", T.StringType()),
        *[T.StructField(m, T.DoubleType()) for m in ("f2", "precision", "recall", "pr_auc", "roc_auc", "brier")],
    ]
)


def measured(scored: DataFrame, by: Sequence[str], threshold=0.5, label: str = P.LABEL, digits: int | None = 4) -> DataFrame:
    """Suites of model-scored rows, computed now: each row goes through the models once.

    Only the metric rows (one per group of `by`) come to the driver.
    """
    kept = scored.select(*by, label, "p").persist()
    try:
        suites = metric_suite(kept, label, "p", threshold, by, digits)
        return scored.sparkSession.createDataFrame(suites.collect(), suites.schema)
    finally:
        kept.unpersist()


def score_with(models: dict[str, object], df: DataFrame, name: str, label: str = P.LABEL) -> DataFrame:
    """Long form (name, split.., label, p) of one scan scored by several models."""
    keep = [c for c in ("split", "project") if c in df.columns]
    wide = df
    for i, model in enumerate(models.values()):
        wide = predict(model, wide, f"__p{i}")
    options = F.array(
        *[F.struct(F.lit(key).alias(name), F.col(f"__p{i}").alias("p")) for i, key in enumerate(models)]
    )
    return wide.select(*keep, label, F.explode(options).alias("s")).select(*keep, label, f"s.{name}", "s.p")


def params_hash(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True).encode()).hexdigest()[:16]


def run_trials(
    study: str,
    trials: Sequence[dict],
    fit: Callable[[dict], object],
    val: DataFrame,
    label: str = P.LABEL,
    known: Iterable[str] = (),
    parallelism: int = 4,
) -> tuple[DataFrame, dict[str, object]]:
    """Fits every trial not yet known and scores all of them on `val` in one grouped job.

    Fits run from a small thread pool, each is a distributed job. Returns the trial table
    and the fitted models by parameter hash.
    """
    spark = val.sparkSession
    todo = [(i, params_hash(p), p) for i, p in enumerate(trials) if params_hash(p) not in set(known)]
    if not todo:
        return spark.createDataFrame([], TRIAL_SCHEMA), {}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        models = dict(zip([h for _, h, _ in todo], pool.map(lambda t: fit(t[2]), todo)))
    suites = measured(score_with(models, val, "params_hash", label), ["params_hash"], label=label)
    names = spark.createDataFrame(
        [(study, i, h, json.dumps(p, sort_keys=True)) for i, h, p in todo],
        "study string, trial int, params_hash string, params string",
    )
    table = names.join(suites, "params_hash").select(*[f.name for f in TRIAL_SCHEMA])
    return table, models


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest F2 of each study, earliest on ties."""
    return trials.groupBy("study").agg(
        F.max_by("params", F.struct("f2", -F.col("trial"))).alias("params"),
        F.max_by("params_hash", F.struct("f2", -F.col("trial"))).alias("params_hash"),
        F.max("f2").alias("f2"),
    )


# -- logistic grid ------------------------------------------------------------------


def logistic_grid() -> list[dict]:
    """6 strengths x {l2, l1}, plus 3 l2 strengths on the oversampled training set: 15."""
    plain = [{"C": c, "penalty": p, "smote": False} for c in P.LR_C for p in ("l2", "l1")]
    return plain + [{"C": c, "penalty": "l2", "smote": True} for c in P.LR_SMOTE_C]


def logistic_trials(
    train: DataFrame,
    val: DataFrame,
    grid: Sequence[dict] | None = None,
    features: Sequence[str] = P.FEATURES,
    label: str = P.LABEL,
    row_id: str = "sprint_id",
) -> tuple[DataFrame, dict[str, object]]:
    """The grid on the plain and the oversampled training rows.

    Imputation and scaling depend on the rows only, so they are fitted once per row set and
    the prepared vectors are kept for all fits on it.
    """
    grid = logistic_grid() if grid is None else grid
    sources = {}
    for enlarged in sorted({p["smote"] for p in grid}):
        rows = smote(train, features, label, row_id) if enlarged else train
        prepared = preparation(features).fit(rows)
        vectors = add_balanced_weight(prepared.transform(rows).select(label, "features"), label)
        kept = packed(vectors)
        sources[enlarged] = (prepared, kept, kept.count())

    def fit(p: dict):
        prepared, rows, size = sources[p["smote"]]
        fitted = logistic(p["C"], p["penalty"], size, label).fit(rows)
        return PipelineModel(stages=[*prepared.stages, without_summary(fitted, train.sparkSession)])

    try:
        return run_trials("logistic", grid, fit, val, label, parallelism=8)
    finally:
        for _, kept, _ in sources.values():
            kept.unpersist()


# -- tree studies -------------------------------------------------------------------


def boosted(params: dict, label: str = P.LABEL) -> Callable[[DataFrame], object]:
    settings = {k: v for k, v in params.items() if k != "positiveWeight"}
    weight = F.when(F.col(label) == 1, params.get("positiveWeight", 1.0)).otherwise(1.0)
    estimator = GBTClassifier(labelCol=label, weightCol="weight", seed=P.SEED, **settings)
    return lambda train: tree_pipeline(estimator).fit(train.withColumn("weight", weight))


def forest(params: dict, label: str = P.LABEL) -> Callable[[DataFrame], object]:
    estimator = RandomForestClassifier(labelCol=label, weightCol="weight", seed=P.SEED, **params)
    return lambda train: without_summary(tree_pipeline(estimator).fit(add_balanced_weight(train, label)), train.sparkSession)


def _second_order(family: str, params: dict, label: str) -> Callable[[DataFrame], object]:
    def fit(train: DataFrame) -> PipelineModel:
        trees = boosting.fit(train, {0: search.settings_of(family, params)}, label=label)[0]
        return stages.as_pipeline(stages.BoostedTrees(trees))

    return fit


def level_wise(params: dict, label: str = P.LABEL) -> Callable[[DataFrame], object]:
    """Second-order boosting by level; all rounds, as nothing is watched."""
    return _second_order("boosted", params, label)


def leaf_wise(params: dict, label: str = P.LABEL) -> Callable[[DataFrame], object]:
    """Second-order boosting, best leaf first, classes balanced; all rounds."""
    return _second_order("leafwise", params, label)


FAMILIES = {"boosted": level_wise, "leafwise": leaf_wise}


def tree_search(
    path: str, train: DataFrame, val: DataFrame, n_trials: int = 50, label: str = P.LABEL, row_id: str = "sprint_id"
) -> DataFrame:
    """The trial table of both families under `path`: what it lacks is fitted batch by batch on
    train and judged on val at .5, each batch stored as it ends. Called again, with any session,
    it fits only what is missing."""
    spark = train.sparkSession
    for end in [e for e in search.BATCHES if e < n_trials] + [n_trials]:
        rows = [(r["study"], r["trial"], json.loads(r["params"]), r["f2"]) for r in search.stored(spark, path, TRIAL_SCHEMA).collect()]
        known = {r[:2] for r in rows}
        first = max([0, *[e for e in search.BATCHES if e < end]])
        earlier = {f: [r[1:] for r in rows if r[0] == f and r[1] < first] for f in FAMILIES}
        todo = [(f, i, search.propose(f, i, earlier[f])) for i in range(first, end) for f in FAMILIES if (f, i) not in known]
        if not todo:
            continue
        settings = {n: search.settings_of(f, p, watched=True) for n, (f, _, p) in enumerate(todo)}
        forests = boosting.fit(train, settings, label=label, row_id=row_id, watched=val)
        suites = measured(search.scored_by(forests, val, label), ["trial"], label=label)
        names = spark.createDataFrame(
            [(n, f, i, params_hash(p), json.dumps(p, sort_keys=True)) for n, (f, i, p) in enumerate(todo)],
            "trial int, study string, number int, params_hash string, params string",
        )
        table = names.join(suites, "trial").drop("trial").withColumnRenamed("number", "trial")
        table.select(*[f.name for f in TRIAL_SCHEMA]).coalesce(1).write.mode("append").parquet(path)
    return search.stored(spark, path, TRIAL_SCHEMA)


def refit(family: str, params: dict, matrix: DataFrame, label: str = P.LABEL):
    """Final fit on train and val; the calibration year stays unseen."""
    return FAMILIES[family](params, label)(matrix.where(F.col("split").isin("train", "val")))


# -- champion, folds ------------------------------------------------------------------


def select_champion(
    f2_incumbent: float, f2_challenger: float, incumbent: str = "boosted", challenger: str = "leafwise",
    margin: float = P.PROMOTION_MARGIN,
) -> str:
    """The challenger wins only by more than the margin."""
    return challenger if f2_challenger - f2_incumbent > margin else incumbent


def champion_report(
    models: dict[str, object], f2_by_family: dict[str, float], matrix: DataFrame, label: str = P.LABEL
) -> DataFrame:
    """Suites of both families on val and test, the winner, and McNemar between them on val."""
    names = list(models)
    winner = select_champion(f2_by_family[names[0]], f2_by_family[names[1]], *names)
    judged = matrix.where(F.col("split").isin("val", "test"))
    both = predict(models[names[1]], predict(models[names[0]], judged, "p_a"), "p_b")
    suites = measured(score_with(models, judged, "model", label), ["model", "split"], label=label)
    test = mcnemar(
        both.where(F.col("split") == "val").withColumns(
            {"a": (F.col("p_a") >= 0.5).cast("int"), "b": (F.col("p_b") >= 0.5).cast("int")}
        ),
        label, "a", "b",
    )
    return with_row(suites, "m", test).select(
        *suites.columns,
        (F.col("model") == winner).alias("champion"),
        F.round("m.statistic", 4).alias("mcnemar_statistic"),
        F.round("m.p_value", 4).alias("mcnemar_p"),
    )


def fold_metrics(
    matrix: DataFrame, fit: Callable[[DataFrame], object], projects: Sequence[str] = P.FOLD_PROJECTS,
    label: str = P.LABEL, threshold: float = 0.5, parallelism: int = 2,
) -> DataFrame:
    """Leave-one-project-out: fit without the project, one grouped evaluation over all folds."""
    parts = folds(matrix, projects)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        models = list(pool.map(lambda f: fit(f[1]), parts))
    scored = [
        predict(model, held).select("project", label, "p") for model, (_, _, held) in zip(models, parts)
    ]
    return measured(reduce(DataFrame.unionByName, scored), ["project"], threshold, label)


def fold_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(
        F.count(F.lit(1)).alias("folds"),
        F.round(F.avg("f2"), 4).alias("f2_mean"),
        F.round(F.stddev_samp("f2"), 4).alias("f2_std"),
    )


# -- calibration ------------------------------------------------------------------------


def fit_platt(cal: DataFrame, label: str = P.LABEL, score: str = "p") -> stages.SigmoidMap:
    """Logistic map of the score with smoothed targets, fitted on distinct scores with weights."""
    counts = cal.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    sizes = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    high, low = (F.col("t.p") + 1.0) / (F.col("t.p") + 2.0), 1.0 / (F.col("t.n") + 2.0)
    weight_1 = F.col("pos") * high + F.col("neg") * low
    rows = with_row(counts, "t", sizes).select(
        F.col(score).alias("s"),
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("target"), weight_1.alias("w")),
                F.struct(F.lit(0.0).alias("target"), (F.col("pos") + F.col("neg") - weight_1).alias("w")),
            )
        ).alias("e"),
    ).select("s", "e.target", "e.w")
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=["s"], outputCol="f"),
            LogisticRegression(featuresCol="f", labelCol="target", weightCol="w", regParam=0.0, maxIter=200, tol=1e-10),
        ]
    ).fit(rows)
    logistic = model.stages[-1]
    return stages.SigmoidMap({"a": float(logistic.coefficients[0]), "b": float(logistic.intercept)})


def fit_isotonic(cal: DataFrame, label: str = P.LABEL, score: str = "p") -> stages.StepMap:
    """Non-decreasing map with interpolation between the ends of its steps."""
    scores, values = isotonic.isotonic_points(cal, label, score)
    return stages.StepMap({"scores": scores, "values": values})


def calibrate(scored: DataFrame, label: str = P.LABEL, score: str = "p", splits=("cal", "val", "test")):
    """Both maps fitted on cal; returns (winner name, map or None, Brier/F2 table).

    The winner has the lowest Brier score on cal; the raw score stays unless it gains more
    than the margin.
    """
    cal = scored.where(F.col("split") == "cal")
    maps = {"sigmoid": fit_platt(cal, label, score), "isotonic": fit_isotonic(cal, label, score)}
    judged = scored.where(F.col("split").isin(*splits)).select("split", label, score)
    stacked = judged.withColumn("method", F.lit("raw"))
    for name, fitted in maps.items():
        stacked = stacked.unionByName(fitted.on(judged, score, score).withColumn("method", F.lit(name)))
    stacked = stacked.withColumnRenamed(score, "p")
    table = measured(stacked, ["method", "split"], 0.5, label, None).select("method", "split", "brier", "f2")
    rows = {(r["method"], r["split"]): r["brier"] for r in table.where(F.col("split") == "cal").collect()}
    best = min(maps, key=lambda m: rows[(m, "cal")])
    if rows[(best, "cal")] >= rows[("raw", "cal")] - P.CALIBRATION_MARGIN:
        return "raw", None, table
    return best, maps[best], table
