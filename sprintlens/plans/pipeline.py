"""The modelling pipeline over a written sprint table, stage by stage.

Baselines, logistic grid, two tree studies, champion, calibration, thresholds, folds,
drift, explanations, final evaluation; every stage leaves a report, the metrics go to the
run log, models are saved. What the driver holds are metric rows and fitted models.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import drift, explain, features, metrics, models, resampling, risk, scoring, shapley, stages
from sprintlens.sources import readers, writers


@dataclass
class Settings:
    years: tuple[int, int] = P.FEATURE_YEARS
    bounds: Sequence[int] = (P.TRAIN_END, P.CAL_END, P.VAL_END)
    reference_end: int = P.DRIFT_REFERENCE_END
    projects: Sequence[str] = P.FOLD_PROJECTS
    cases: Sequence[tuple[str, str]] = (("tp", "HTTPCLIENT"), ("tn", "IO"), ("fn", "MATH"))
    trials: int = 50
    grid: Sequence[dict] = field(default_factory=models.logistic_grid)
    replicates: int = 1000


def run(spark: SparkSession, gold_path: str, out: str, settings: Settings | None = None) -> DataFrame:
    """Runs all stages and returns the one-row summary that is also written to `out`/summary."""
    s = settings or Settings()
    run_id = uuid.uuid4().hex
    report = lambda df, name: writers.write_report(df, f"{out}/reports/{name}")
    log = lambda df, role: writers.append_run_log(writers.metrics_long(df, run_id, role), f"{out}/run_log")

    matrix = features.feature_matrix(readers.read_feature_table(spark, gold_path, s.years), s.years, s.bounds)
    frame = models.model_frame(matrix).persist()
    try:
        train, val = (frame.where(F.col("split") == name) for name in ("train", "val"))
        report(features.split_profile(matrix), "splits")
        report(scoring.run_baselines(matrix), "baselines")

        table, _ = models.logistic_trials(train, val, s.grid)
        report(table, "logistic_trials")

        table = models.tree_search(f"{out}/trials", train, val, s.trials)
        found = {r["study"]: r for r in models.best_trial(table).collect()}
        fitted, f2, best_params = {}, {}, {}
        for family in models.FAMILIES:
            best = found[family]
            best_params[family], f2[family] = json.loads(best["params"]), best["f2"]
            fitted[family] = models.refit(family, best_params[family], frame)
        report(models.champion_report(fitted, f2, frame), "champion")
        names = list(models.FAMILIES)
        winner = models.select_champion(f2[names[0]], f2[names[1]], *names)
        scored = scoring.predict(fitted[winner], frame).persist()
        method, calibrated, table = models.calibrate(scored)
        report(table, "calibration")
        model = fitted[winner] if calibrated is None else stages.as_pipeline(fitted[winner], calibrated)
        writers.save_model(model, f"{out}/model")
        scored = scoring.predict(model, frame)
        scored = scored.withColumn("sprint_year", F.col("year").cast("bigint")).persist()

        per_fold = models_folds(frame, winner, best_params[winner], s)
        report(per_fold, "folds")

        on_val = scored.where(F.col("split") == "val")
        best = metrics.best_thresholds(metrics.threshold_sweep(on_val, digits=None)).first()
        threshold = best["threshold_f2"]
        report(metrics.threshold_sweep(on_val), "sweep_val")
        report(metrics.threshold_report(scored), "thresholds")
        report(
            metrics.metric_suite(
                scored.where(F.col("project").isin(*s.projects) & F.col("split").isin("train", "cal")),
                threshold=threshold, by=["project"],
            ),
            "projects_at_threshold",
        )

        is_ = lambda split: F.col("split") == split
        report(drift.drift_report(matrix, is_("train"), is_("test")), "drift")
        report(drift.yearly_drift(scored, s.reference_end), "drift_by_year")
        shifted = drift.simulated_shift(frame.where(is_("test")))
        rescored = scoring.predict(model, shifted)
        report(drift.simulated_drift(rescored, "log_avg_cycle_time"), "drift_simulated")

        test = frame.where(is_("test"))
        parts = shapley.tree_contributions(fitted[winner], test, "sprint_id").persist()
        importance = explain.global_importance(parts)
        report(importance, "importance")
        top = [r["feature"] for r in importance.limit(5).collect()]
        report(
            explain.partial_dependence(test, lambda df: scoring.predict(fitted[winner], df), top),
            "partial_dependence",
        )
        tested = scored.where(is_("test"))
        report(
            explain.local_cases(tested, s.cases, threshold=0.5).join(parts, "sprint_id"), "local_cases"
        )
        drivers = explain.top_drivers(parts, ["sprint_id"])
        risk.risk_snapshot(tested, drivers, threshold).write.mode("overwrite").parquet(f"{out}/snapshot")
        parts.unpersist()

        intervals = metrics.bootstrap_ci(
            resampling.multinomial_replicates(tested, threshold=threshold, replicates=s.replicates)
        )
        summary = metrics.final_evaluation(scored, threshold, intervals, per_fold=per_fold).withColumns(
            {
                "champion": F.lit(winner),
                "calibration_method": F.lit(method),
                "threshold_f2opt": F.lit(float(threshold)),
                "threshold_roi": F.lit(float(best["threshold_value"])),
            }
        )
        summary = spark.createDataFrame(summary.collect(), summary.schema)
        writers.write_summary(summary, f"{out}/summary")
        log(summary, "final_evaluation")
        return summary
    finally:
        spark.catalog.clearCache()


def models_folds(frame: DataFrame, family: str, params: dict, s: Settings) -> DataFrame:
    """Leave-one-project-out of the champion's parameters on train and cal."""
    build = models.FAMILIES[family]
    pool = frame.where(F.col("split").isin("train", "cal"))
    return models.fold_metrics(pool, build(params), s.projects)
