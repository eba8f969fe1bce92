"""The registered queries: name → function of (session, folder of the driver's tables)."""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import text as X
from sprintlens.operators import (
    boosting,
    drift,
    explain,
    features,
    gold,
    metrics,
    models,
    oversample,
    profile,
    resampling,
    risk,
    scoring,
    search,
    shaping,
    shapley,
    silver,
    stages,
)
from sprintlens.plans import setup as S
from sprintlens.session import scratch_dir, stable_dir
from sprintlens.sources import readers, views, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def split_is(name: str):
    return F.col("split") == name


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- silver and gold ------------------------------------------------------------


@query
def sprint_features(spark, d):
    df = S.sprints(spark, d)
    return S.shown(
        df.select(
            "sprint_id", "project", "sprint", "sprint_year", "sprint_month", "bug_story_ratio",
            "avg_cycle_time_days", "num_bugs_sprint", "num_stories_sprint", "num_tasks_sprint",
            "total_issues_sprint", P.LABEL,
        )
    )


@query
def module_density(spark, d):
    return S.silver_modules(spark, d).select(
        "basename", "project", "version", "wmc", "loc", "bug_count", "defect_flag", "defect_density", "total_modules"
    )


@query
def issues_classified_substring(spark, d):
    return S.silver_issues(spark, d).select("key", "project", "sprint", "issue_category", "cycle_time_days")


@query
def issues_classified_exact(spark, d):
    return silver.classify_tracker_b(S.tracker_b_raw(spark, d)).select(
        "issue_key", "project_key", "sprint", "issue_category", "cycle_time_days"
    )


@query
def sprint_ratio_attached(spark, d):
    return silver.silver_tracker_a(views.issues(spark, d)).select("key", "project", "sprint", "bug_story_ratio")


@query
def sprint_counts_attached(spark, d):
    return silver.silver_tracker_b(S.tracker_b_raw(spark, d)).select(
        "issue_key", "project_key", "sprint", "num_bugs", "num_stories", "num_tasks",
        "total_issues_sprint", "bug_story_ratio",
    )


@query
def delivery_monthly(spark, d):
    return S.silver_delivery(spark, d)


@query
def delivery_project(spark, d):
    return S.shown(gold.delivery_by_project(S.silver_delivery(spark, d)))


@query
def modules_project(spark, d):
    return S.shown(gold.modules_by_project(S.silver_modules(spark, d)))


@query
def sprint_features_full(spark, d):
    return S.shown(S.full_sprints(spark, d))


@query
def sprint_features_month_grain(spark, d):
    issues = S.silver_issues(spark, d)
    df = gold.build_sprint_features(
        issues,
        delivery=S.silver_delivery(spark, d),
        years=S.YEARS,
        month_grain=True,
        tracker_b=silver.silver_tracker_b(S.tracker_b_raw(spark, d)),
    )
    return S.shown(
        df.select(
            "sprint_id", "deploy_frequency_weekly", "change_failure_rate", "total_pushes_2022",
            "total_prs_2022", "tracker_b_ratio",
        )
    )


# -- sources and sinks: written from the tables, read back ------------------------


@query
def csv_header_union(spark, d):
    """Modules written under three headers (order, case, absent column), read as one frame."""
    base = scratch_dir(spark, "module-csv")
    m = views.modules(spark, d).withColumn("bug", F.coalesce("bug", F.lit(0)))
    shapes = (
        ["basename", "wmc", "dit", "cbo", "loc", "bug"],
        ["LOC", "bug", "WMC", "basename", "dit"],
        ["dit", " Wmc ", "rfc", "loc", "basename", "bug"],
    )
    for i, names in enumerate(shapes):
        part = m.where(F.length("basename") % 3 == i)
        part.select(*[F.col(n.strip().lower()).alias(n) for n in names]).write.option("header", True).csv(
            f"{base}/shape={i}"
        )
    raw = readers.read_module_csvs(spark, base)
    flagged = silver.flag_modules(raw, F.col("basename"))
    return S.shown(
        flagged.select(
            "basename", "project", "version", "wmc", "dit", "cbo", "rfc", "loc", "defect_flag",
            (F.col("_file_path").contains(".csv")).cast("int").alias("has_path"),
        )
    )


@query
def ndjson_nested_scan(spark, d):
    """Events written as gzipped JSON lines, scanned with the explicit nested schema."""
    path = scratch_dir(spark, "events")
    views.repository_events(spark, d).write.option("compression", "gzip").json(path)
    return silver.silver_delivery(readers.read_repository_events(spark, path))


@query
def parquet_merge_schema(spark, d):
    """Tracker B parts with and without the optional columns, merged, cleaned, written, read."""
    base = scratch_dir(spark, "tracker-b")
    raw = S.tracker_b_raw(spark, d)
    odd = F.crc32("Issue key") % 2 == 1
    raw.where(odd).write.parquet(f"{base}/raw/a")
    raw.where(~odd).drop("Assignee").withColumn("_source_file", F.lit("b")).write.parquet(f"{base}/raw/b")
    merged = readers.read_merged_parquet(spark, f"{base}/raw/a", f"{base}/raw/b")
    writers.write_by_key(silver.silver_tracker_b(merged), f"{base}/silver", "project_key")
    return spark.read.parquet(f"{base}/silver").select(
        "issue_key", "project_key", "sprint", "issue_category", "total_issues_sprint", "bug_story_ratio"
    )


@query
def hive_partition_scan(spark, d):
    """Delivery metrics partitioned by year and month, registered, queried with pruning."""
    path = scratch_dir(spark, "delivery")
    writers.write_by_key(S.silver_delivery(spark, d), path, "year", "month")
    readers.register_external(spark, "ext_silver_delivery", path)
    return spark.sql(
        """SELECT repo_name, year, month, push_count, total_prs_closed
           FROM ext_silver_delivery WHERE year >= 1998 AND month <= 6"""
    )


@query
def feature_table_scan(spark, d):
    """The written sprint table, nineteen columns, a year range that prunes partitions."""
    path = scratch_dir(spark, "feature-table")
    writers.write_feature_table(S.full_sprints(spark, d), path)
    return S.shown(readers.read_feature_table(spark, path, (1997, 2000)))


@query
def report_round_trip(spark, d):
    """Yearly label report as CSV and as JSON document, both read back and joined."""
    base = scratch_dir(spark, "reports")
    report = S.gold_table(spark, d).groupBy("sprint_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum(P.LABEL).alias("positives")
    )
    writers.write_report(report, f"{base}/csv")
    writers.write_summary(report, f"{base}/json")
    schema = "sprint_year bigint, n bigint, positives bigint"
    csv = spark.read.option("header", True).schema(schema).csv(f"{base}/csv")
    document = spark.read.schema(schema).json(f"{base}/json")
    return csv.join(document.select("sprint_year", F.col("n").alias("n_json")), "sprint_year")


@query
def run_log_evidence(spark, d):
    """Suite per split appended to the run log, then looked up with defaults."""
    path = scratch_dir(spark, "run-log")
    for split in ("val", "test"):
        suite = metrics.confusion(S.scored(spark, d).where(split_is(split)), threshold=S.THRESHOLD)
        renamed = suite.select(*[F.col(c).alias(f"{split}_{c}") for c in suite.columns])
        writers.append_run_log(writers.metrics_long(renamed, "run-1", "final_evaluation"), path)
    log = spark.read.parquet(path)
    defaults = {"val_tp": 0.0, "val_fp": 0.0, "test_tp": 0.0, "test_fn": -1.0, "lopo_f2_mean": 0.9526}
    return S.shown(readers.run_evidence(log, "run-1", defaults))


@query
def quality_counters(spark, d):
    """Rows, nulls and their share per parsed column, in one pass."""
    df = silver.classify_tracker_b(S.tracker_b_raw(spark, d))
    return S.shown(shaping.null_shares(df, ["issue_key", "created_ts", "resolved_ts", "cycle_time_days"]))


@query
def row_accounting(spark, d):
    """Rows before and after the filter on resolved issues, counted while they are written."""
    seen = Observation("resolved")
    df = silver.classify_tracker_b(S.tracker_b_raw(spark, d))
    kept = shaping.counted_filter(df, F.col("cycle_time_days") >= 30, seen)
    path = scratch_dir(spark, "resolved")
    kept.write.parquet(path)
    counts = seen.get
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_stored"))
    return stored.select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("rows_before", "rows_after")], "rows_stored")


@query
def module_files(spark, d):
    """Name, project and version of every module file, from its path alone."""
    path = F.concat(F.lit("file:/raw/code-1.0/"), "basename", F.when(F.length("basename") % 2 == 0, ".csv").otherwise(".CSV"))
    stem = X.file_stem(path)
    return views.modules(spark, d).select(
        "basename", stem.alias("stem"), X.module_project(stem).alias("project"), X.module_version(stem).alias("version")
    )


@query
def null_profile_drop(spark, d):
    """Columns more than 40 % null are dropped; the surviving schema and its null counts."""
    df = shaping.drop_sparse(S.tracker_b_raw(spark, d), 0.4, keep=["Issue key"])
    return shaping.null_shares(df).select("column", "rows", "nulls")


# -- profiling --------------------------------------------------------------------


@query
def cycle_time_summary(spark, d):
    return S.shown(profile.cycle_time_summary(S.silver_issues(spark, d)))


@query
def distribution_summary(spark, d):
    return S.shown(
        profile.distribution(S.silver_delivery(spark, d), ["deploy_frequency_weekly", "change_failure_rate"])
    )


@query
def class_balance(spark, d):
    return profile.class_balance(S.silver_modules(spark, d), "defect_flag")


@query
def label_balance(spark, d):
    return profile.class_balance(views.table(spark, d, "labels"), "quality")


MODULE_COLUMNS = ("wmc", "dit", "cbo", "rfc", "lcom", "loc")


@query
def metric_target_corr(spark, d):
    return S.shown(profile.target_correlation(S.silver_modules(spark, d), MODULE_COLUMNS, "defect_flag"))


@query
def metric_stats(spark, d):
    return S.shown(profile.metric_stats(S.silver_modules(spark, d), MODULE_COLUMNS))


@query
def density_top20(spark, d):
    flagged = silver.flag_modules(views.modules(spark, d), F.col("basename"))
    return silver.defect_density(flagged).orderBy(F.col("defect_density").desc(), "project", "version").limit(20)


@query
def density_preview(spark, d):
    """First fifty groups in key order."""
    flagged = silver.flag_modules(views.modules(spark, d), F.col("basename"))
    return silver.defect_density(flagged).orderBy("project", "version").limit(50)


@query
def collection_profile(spark, d):
    issues = profile.collection_profile(views.issues(spark, d), "issues")
    return issues.unionByName(profile.collection_profile(views.table(spark, d, "events"), "events")).unionByName(
        profile.collection_profile(views.modules(spark, d), "modules")
    )


@query
def issues_per_year(spark, d):
    return profile.issues_by_year(S.silver_issues(spark, d))


@query
def status_transitions(spark, d):
    return profile.status_transitions(views.change_log(spark, d))


@query
def frequency_tables(spark, d):
    issues = profile.frequencies(S.silver_issues(spark, d), ["issuetype_name", "status", "issue_category"])
    return issues.unionByName(profile.frequencies(views.table(spark, d, "events"), ["event_type"]))


@query
def table_meta(spark, d):
    return profile.table_meta(S.silver_issues(spark, d), ["project", "issuetype_name"], "created_ts").withColumns(
        {c: F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_ts", "last_ts")}
    )


@query
def events_by_hour(spark, d):
    return profile.events_by_hour(views.table(spark, d, "events"), "ts")


@query
def repo_activity(spark, d):
    """Fifteen most active repositories and ten with most deployments."""
    events = silver.flatten_events(views.repository_events(spark, d))
    push = (F.col("event_type") == "PushEvent") & F.col("payload_ref").isin(*P.DEPLOY_BRANCHES)
    busy = profile.top_counts(events, "repo_name", 15).withColumn("ranking", F.lit("events"))
    deploys = profile.top_counts(events, "repo_name", 10, push).withColumn("ranking", F.lit("deploys"))
    return busy.unionByName(deploys)


@query
def repository_keys(spark, d):
    return S.relevant_events(spark, d).select("repo_name", "apache_project_key").distinct()


@query
def distinct_menus(spark, d):
    """Sorted distinct projects and years, as filter menus."""
    df = S.gold_table(spark, d)
    projects = df.select(F.lit("project").alias("menu"), F.col("project").alias("entry")).distinct()
    years = df.select(F.lit("year").alias("menu"), F.col("sprint_year").cast("string").alias("entry")).distinct()
    return projects.unionByName(years).orderBy("menu", "entry")


@query
def global_cfr(spark, d):
    return S.shown(profile.merge_rate(S.relevant_events(spark, d)))


@query
def source_coverage(spark, d):
    return S.shown(
        profile.coverage(
            S.gold_table(spark, d),
            {
                "cycle_time": "avg_cycle_time_days",
                "ratio": "bug_story_ratio",
                "delivery": "deploy_frequency_weekly",
                "code_metrics": "avg_wmc",
            },
        )
    )


# -- features ---------------------------------------------------------------------


@query
def feature_matrix(spark, d):
    return S.shown(S.matrix(spark, d).select("sprint_id", "project", "split", P.LABEL, *P.FEATURES))


@query
def feature_stats(spark, d):
    return S.shown(features.feature_stats(S.matrix(spark, d)))


@query
def split_profile(spark, d):
    return S.shown(features.split_profile(S.matrix(spark, d)))


@query
def refit_pool(spark, d):
    """Train and val together (cal left out) by project; train and cal together likewise."""
    m = S.matrix(spark, d)
    count = lambda pool, *splits: (
        m.where(F.col("split").isin(*splits))
        .groupBy("project")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(P.LABEL).alias("positives"))
        .withColumn("pool", F.lit(pool))
    )
    return count("refit", "train", "val").unionByName(count("fold", "train", "cal"))


@query
def lopo_fold_sizes(spark, d):
    train = S.matrix(spark, d).where(F.col("split").isin("train", "cal"))
    return S.shown(features.fold_sizes(train, S.PROJECTS))


def what_if_inputs(spark, d):
    return S.gold_table(spark, d).select(
        "sprint_id",
        F.col("num_bugs_sprint").alias("bugs"),
        F.col("num_stories_sprint").alias("stories"),
        F.col("num_tasks_sprint").alias("tasks"),
        F.col("avg_cycle_time_days").alias("cycle"),
        F.col("sprint_year").alias("year"),
        F.col("sprint_month").alias("month"),
        F.col("deploy_frequency_weekly").alias("deploy"),
        F.col("change_failure_rate").alias("cfr"),
    )


@query
def what_if_rows_app(spark, d):
    return S.shown(features.what_if_app(what_if_inputs(spark, d)).select("sprint_id", *P.FEATURES))


@query
def what_if_rows_dashboard(spark, d):
    return S.shown(features.what_if_dashboard(what_if_inputs(spark, d)).select("sprint_id", *P.FEATURES))


@query
def class_weights(spark, d):
    return S.shown(features.class_weights(S.matrix(spark, d).where(split_is("train"))))


@query
def impute_scale(spark, d):
    train = S.matrix(spark, d).where(split_is("train"))
    names = list(P.FEATURES)
    return S.shown(features.impute_and_scale(train, names, ["sprint_id"]))


@query
def smote_balance(spark, d):
    train = models.model_frame(S.matrix(spark, d).where(split_is("train")))
    balanced = oversample.smote(train, P.FEATURES)
    # A synthetic row lies between two minority rows, so its year stays inside theirs.
    return balanced.groupBy(F.col(P.LABEL).cast("int").alias(P.LABEL), "synthetic").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("sprint_year").between(S.YEARS[0], S.BOUNDS[0])).alias("n_in_range"),
    )


# -- scores, baselines ------------------------------------------------------------


@query
def heuristic_score(spark, d):
    return S.scored(spark, d).select("sprint_id", "split", P.LABEL, "p")


@query
def baseline_majority(spark, d):
    return S.shown(scoring.majority_class(S.matrix(spark, d).where(split_is("train"))))


@query
def baseline_threshold(spark, d):
    return S.shown(scoring.ratio_threshold(S.matrix(spark, d).where(split_is("train"))))


@query
def baseline_suites(spark, d):
    return S.shown(scoring.run_baselines(S.matrix(spark, d), digits=None))


# -- evaluation -------------------------------------------------------------------


@query
def metric_suite(spark, d):
    return S.shown(metrics.metric_suite(S.scored(spark, d), threshold=S.THRESHOLD, by=["split"], digits=None))


@query
def roc_auc(spark, d):
    df = metrics.metric_suite(S.scored(spark, d), by=["sprint_year"], digits=None)
    return S.shown(df.select("sprint_year", "roc_auc"))


@query
def average_precision(spark, d):
    df = metrics.metric_suite(S.scored(spark, d), by=["sprint_year"], digits=None)
    return S.shown(df.select("sprint_year", "pr_auc"))


@query
def brier_score(spark, d):
    df = metrics.metric_suite(S.scored(spark, d), by=["project"], digits=None)
    return S.shown(df.select("project", "brier"))


@query
def pr_curve(spark, d):
    return S.shown(metrics.pr_curve(S.scored(spark, d), by=["split"]))


@query
def confusion(spark, d):
    return metrics.confusion(S.scored(spark, d), threshold=S.THRESHOLD, by=["project"])


@query
def confusion_cells(spark, d):
    celled = metrics.with_cell(S.scored(spark, d), threshold=S.THRESHOLD)
    return celled.groupBy("cell", "split").agg(F.count(F.lit(1)).alias("n"))


@query
def threshold_sweep(spark, d):
    return S.shown(metrics.threshold_sweep(S.scored(spark, d), by=["split"], digits=None))


@query
def threshold_best(spark, d):
    sweep = metrics.threshold_sweep(S.scored(spark, d), by=["split"], digits=None)
    return S.shown(metrics.best_thresholds(sweep, ["split"]))


@query
def threshold_report(spark, d):
    return S.shown(metrics.threshold_report(S.scored(spark, d), digits=None))


@query
def reliability_curve(spark, d):
    return S.shown(metrics.reliability_curve(S.scored(spark, d), by=["split"], digits=6))


@query
def bootstrap_ci(spark, d):
    """Exactly n draws per replicate, by cells."""
    test = S.scored(spark, d).where(split_is("test"))
    replicates = resampling.multinomial_replicates(test, threshold=S.THRESHOLD, replicates=S.REPLICATES, digits=None)
    return S.shown(metrics.bootstrap_ci(replicates))


@query
def bootstrap_poisson(spark, d):
    test = S.scored(spark, d).where(split_is("test"))
    replicates = metrics.bootstrap_replicates(
        test, "sprint_id", threshold=S.THRESHOLD, replicates=S.REPLICATES, digits=None
    )
    return S.shown(metrics.bootstrap_ci(replicates))


@query
def mcnemar(spark, d):
    scored = S.scored(spark, d).withColumns(
        {"a": (F.col("p") >= 0.5).cast("int"), "b": (F.col("p") >= 0.75).cast("int")}
    )
    return S.shown(metrics.mcnemar(scored, P.LABEL, "a", "b", ["sprint_year"]))


@query
def metrics_by_project(spark, d):
    train = S.scored(spark, d).where(F.col("project").isin(*S.PROJECTS))
    return S.shown(metrics.metric_suite(train, threshold=S.THRESHOLD, by=["project"], digits=None))


@query
def leaderboard(spark, d):
    matrix = S.matrix(spark, d)
    baselines = scoring.run_baselines(matrix, ["val"], digits=None).withColumnRenamed("baseline", "label")
    score = metrics.metric_suite(
        S.scored(spark, d).where(split_is("val")), threshold=S.THRESHOLD, digits=None
    ).withColumn("label", F.lit("closed_form"))
    return S.shown(metrics.leaderboard(baselines, score))


def _folds(spark, d):
    """Suites of the fold projects under the closed-form score, which no fold has to fit."""
    return metrics.metric_suite(
        S.scored(spark, d).where(F.col("project").isin(*S.PROJECTS)), threshold=S.THRESHOLD, by=["project"], digits=None
    )


@query
def final_evaluation(spark, d):
    scored = S.scored(spark, d)
    replicates = metrics.bootstrap_replicates(
        scored.where(split_is("test")), "sprint_id", threshold=S.THRESHOLD, replicates=S.REPLICATES, digits=None
    )
    intervals = metrics.bootstrap_ci(replicates)
    return S.shown(metrics.final_evaluation(scored, S.THRESHOLD, intervals, digits=None, per_fold=_folds(spark, d)))


# -- drift and monitoring -----------------------------------------------------------


# The SQL twins of the drift queries state the limit series; exact p-values have a query of their own.
def _report(spark, d, names=P.FEATURES):
    return drift.drift_report(S.matrix(spark, d), split_is("train"), split_is("test"), names, digits=None, exact=False)


@query
def psi_by_feature(spark, d):
    return S.shown(_report(spark, d).select("feature", "psi", drift.psi_light(F.col("psi")).alias("light")))


@query
def ks_by_feature(spark, d):
    return S.shown(_report(spark, d).select("feature", "ks_stat", "p_value"))


@query
def drift_report(spark, d):
    return S.shown(_report(spark, d))


@query
def drift_report_exact(spark, d):
    """As `drift_report`, with p-values by path counts where samples allow."""
    return S.shown(drift.drift_report(S.matrix(spark, d), split_is("train"), split_is("test"), digits=None))


@query
def drift_by_year(spark, d):
    return S.shown(drift.yearly_drift(S.scored(spark, d), S.REFERENCE_END, digits=None, exact=False))


def _simulated(spark, d):
    shifted = drift.simulated_shift(S.matrix(spark, d).where(split_is("test")))
    return drift.simulated_drift(
        scoring.closed_form_score(shifted, S.INTERCEPT, 6), "log_avg_cycle_time", digits=None
    )


@query
def drift_simulated(spark, d):
    return S.shown(_simulated(spark, d))


@query
def drift_headline(spark, d):
    yearly = drift.yearly_drift(S.scored(spark, d), S.REFERENCE_END, digits=None, exact=False)
    return S.shown(drift.drift_headline(_report(spark, d), yearly, _simulated(spark, d)))


@query
def monitoring_guards(spark, d):
    final = metrics.final_evaluation(S.scored(spark, d), S.THRESHOLD, digits=None, per_fold=_folds(spark, d)).select(
        "flagging_rate_test", F.col("test_brier").alias("brier"), F.col("test_f2").alias("f2"), "lopo_f2_std", F.col("f2_gap").alias("f2_drop")
    )
    return S.shown(drift.monitoring_guards(writers.metrics_long(final, "run", "final").select("key", "value")))


@query
def health_lights(spark, d):
    suite = metrics.metric_suite(S.scored(spark, d).where(split_is("test")), threshold=S.THRESHOLD, digits=None)
    worst = _report(spark, d).agg(F.max("psi")).scalar()
    lights = suite.withColumn("psi_max", worst)
    return S.shown(
        lights.select(
            "f2", "psi_max", "brier", *drift.health_lights(F.col("f2"), F.col("psi_max"), F.col("brier"))
        )
    )


# -- explanations ---------------------------------------------------------------------


@query
def contributions_closed_form(spark, d):
    return S.shown(scoring.contributions(S.matrix(spark, d).where(split_is("test")), ["sprint_id"]))


@query
def global_importance(spark, d):
    return S.shown(
        explain.global_importance(scoring.contributions(S.matrix(spark, d).where(split_is("test")), ["sprint_id"]))
    )


# The closed-form score's own coefficients of the features that it is linear in.
LINEAR = {
    "log_avg_cycle_time": P.SCORE_CYCLE, "bugs_per_issue": P.SCORE_RATIO,
    "log_total_issues": P.SCORE_SIZE, "cycle_missing": P.SCORE_MISSING,
}


@query
def linear_contributions(spark, d):
    return S.shown(
        explain.linear_contributions(S.matrix(spark, d).where(split_is("test")), LINEAR, ["sprint_id"])
    )


@query
def top5_features(spark, d):
    table = explain.linear_contributions(S.matrix(spark, d).where(split_is("test")), LINEAR, ["sprint_id"])
    return S.shown(explain.global_importance(table).limit(5))


@query
def local_cases(spark, d):
    test = S.scored(spark, d).where(split_is("test"))
    cases = explain.local_cases(test, S.CASES, threshold=0.5)
    return S.shown(
        cases.join(scoring.contributions(test, ["sprint_id"]), "sprint_id").select(
            "cell", "wanted_project", "sprint_id", "project", "p", P.LABEL, "feature", "contribution"
        )
    )


def _drivers(spark, d):
    return explain.top_drivers(scoring.contributions(S.matrix(spark, d), ["sprint_id"]), ["sprint_id"])


@query
def top_drivers(spark, d):
    return _drivers(spark, d)


@query
def partial_dependence(spark, d):
    test = S.matrix(spark, d).where(split_is("test"))
    importance = explain.global_importance(scoring.contributions(test, ["sprint_id"]))
    names = [r["feature"] for r in importance.limit(5).collect()]
    return S.shown(
        explain.partial_dependence(test, lambda df: scoring.closed_form_score(df, S.INTERCEPT), names)
    )


# -- risk tables ------------------------------------------------------------------------


def _snapshot(spark, d):
    """Scored sprints with drivers, written once and read back as a snapshot table."""
    return risk.risk_snapshot(S.scored(spark, d), _drivers(spark, d), S.THRESHOLD)


@query
def risk_snapshot(spark, d):
    path = scratch_dir(spark, "snapshot")
    _snapshot(spark, d).write.parquet(path)
    return readers.read_snapshot(spark, path)


@query
def risk_top30(spark, d):
    return S.shown(risk.riskiest(_snapshot(spark, d)))


@query
def risk_top30_filtered(spark, d):
    return S.shown(risk.riskiest(_snapshot(spark, d), year=2000, level="medio"))


@query
def risk_by_project(spark, d):
    return S.shown(risk.risk_by(_snapshot(spark, d), "project", 15))


@query
def risk_by_year(spark, d):
    return S.shown(risk.risk_by(_snapshot(spark, d), "sprint_year"))


@query
def risk_levels(spark, d):
    return S.shown(risk.level_totals(_snapshot(spark, d)))


@query
def score_histogram(spark, d):
    return risk.score_histogram(_snapshot(spark, d), threshold=S.THRESHOLD)


@query
def bug_sensitivity(spark, d):
    inputs = what_if_inputs(spark, d)
    return S.shown(
        risk.bug_sensitivity(inputs, lambda df: scoring.closed_form_score(df, S.INTERCEPT), ["sprint_id"])
    )


@query
def champion_vs_baseline(spark, d):
    val = S.scored(spark, d).where(split_is("val"))
    champion = metrics.metric_suite(val, threshold=S.THRESHOLD, digits=None)
    train = S.matrix(spark, d).where(split_is("train"))
    base = metrics.metric_suite(scoring.majority_baseline(train, val.drop("p")), digits=None)
    return S.shown(risk.champion_vs_baseline(champion, base))


# -- fitted models ------------------------------------------------------------------------


#: Parameters of the challenger outside the search.
LEAFWISE = {
    "n_estimators": 1000, "max_depth": 9, "learning_rate": 0.05, "subsample": 1.0, "colsample_bytree": 0.8,
    "reg_alpha": 0.01, "reg_lambda": 1.0, "num_leaves": 31, "min_child_samples": 20,
}


def _model_matrix(spark, d):
    return models.model_frame(S.matrix(spark, d))


@contextmanager
def _prepared(spark, d, *splits):
    """The model frame, packed for the many jobs of a fit; released afterwards."""
    frame = _model_matrix(spark, d)
    frame = models.packed(frame.where(F.col("split").isin(*splits)) if splits else frame, "sprint_id")
    try:
        yield frame
    finally:
        frame.unpersist()


def _splits(frame):
    return frame.where(split_is("train")), frame.where(split_is("val"))


_SEARCHED: dict[tuple[str, str], DataFrame] = {}


def _trials(spark, d):
    """The full search of both families, kept in the shared scratch folder under a name that
    follows from the rows: any session with that folder goes on where the last one ended."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SEARCHED:
        with _prepared(spark, d, "train", "val") as frame:
            parts = _splits(frame)
            path = stable_dir(spark, f"tree-trials-{search.fingerprint(*parts)}")
            _SEARCHED[key] = models.tree_search(path, *parts)
    return _SEARCHED[key]


def _tuned(spark, d):
    """Best parameters and their F2 on val by family, and the family of the champion."""
    best = {r["study"]: r for r in models.best_trial(_trials(spark, d)).collect()}
    params = {family: json.loads(best[family]["params"]) for family in models.FAMILIES}
    f2 = {family: best[family]["f2"] for family in models.FAMILIES}
    return params, f2, models.select_champion(*f2.values(), *f2)


def _refitted(spark, d, frame):
    """The champion, fitted again on train and val."""
    params, _, winner = _tuned(spark, d)
    return models.refit(winner, params[winner], frame)


@query
def lr_grid_trials(spark, d):
    with _prepared(spark, d) as frame:
        table, _ = models.logistic_trials(*_splits(frame))
        return spark.createDataFrame(table.collect(), table.schema)


@query
def tree_trials(spark, d):
    return _trials(spark, d)


@query
def champion(spark, d):
    params, f2, _ = _tuned(spark, d)
    with _prepared(spark, d) as frame:
        fitted = {family: models.refit(family, params[family], frame) for family in models.FAMILIES}
        report = models.champion_report(fitted, f2, frame)
        return spark.createDataFrame(report.collect(), report.schema)


@query
def lopo_metrics(spark, d):
    params, _, winner = _tuned(spark, d)
    with _prepared(spark, d, "train", "cal") as frame:
        build = models.FAMILIES[winner]
        table = models.fold_metrics(frame, build(params[winner]), S.PROJECTS)
        summary = models.fold_summary(table)
        table = shaping.with_row(table, "s", summary).select(*table.columns, "s.f2_mean", "s.f2_std")
        return spark.createDataFrame(table.collect(), table.schema)


@query
def leafwise_boosting(spark, d):
    """Best leaf first, stopped by the validation loss: suites of both splits and the rounds kept."""
    with _prepared(spark, d, "train", "val") as frame:
        train, val = _splits(frame)
        settings = search.settings_of("leafwise", LEAFWISE, watched=True)
        forest = boosting.fit(train, {0: settings}, watched=val)[0]
        scored = scoring.predict(stages.BoostedTrees(forest), frame)
        table = models.measured(scored, ["split"]).withColumn("rounds", F.lit(len(forest.trees)))
        return spark.createDataFrame(table.collect(), table.schema)


def _calibrated(spark, d, frame):
    """The champion and its calibration map as one pipeline, saved and loaded again."""
    fitted = _refitted(spark, d, frame)
    winner, calibration, table = models.calibrate(scoring.predict(fitted, frame))
    path = scratch_dir(spark, "model")
    writers.save_model(fitted if calibration is None else stages.as_pipeline(fitted, calibration), path)
    return readers.load_model(path), winner, table


@query
def calibration_compare(spark, d):
    """Refit on train and val, calibrated on cal, compared per split."""
    with _prepared(spark, d) as frame:
        _, winner, table = _calibrated(spark, d, frame)
        table = table.withColumn("winner", F.col("method") == winner)
        return spark.createDataFrame(table.collect(), table.schema)


@query
def calibrated_scores(spark, d):
    """Every sprint scored by the saved pipeline of champion and calibration map."""
    with _prepared(spark, d) as frame:
        model, _, _ = _calibrated(spark, d, frame)
        path = scratch_dir(spark, "scores")
        scoring.predict(model, frame).select("sprint_id", "split", "p").write.parquet(path)
        return spark.read.parquet(path)


def _explained(spark, d, explainer):
    """Contributions of the champion on the test rows, written once."""
    with _prepared(spark, d) as frame:
        path = scratch_dir(spark, "contributions")
        explainer(_refitted(spark, d, frame), frame.where(split_is("test"))).write.parquet(path)
        return spark.read.parquet(path)


@query
def shapley_sampled(spark, d):
    table = _explained(spark, d, lambda model, test: explain.sampled_contributions(model, test, P.FEATURES, "sprint_id"))
    return explain.global_importance(table)


@query
def shapley_trees(spark, d):
    """Exact contributions of the champion's trees to the margin of every test row."""
    return _explained(spark, d, lambda model, test: shapley.tree_contributions(model, test, "sprint_id"))


@query
def shapley_kernel(spark, d):
    """Contributions of the best logistic model by weighted coalitions against the mean row."""
    with _prepared(spark, d) as frame:
        grid = [{"C": 1.0, "penalty": "l2", "smote": False}]
        _, fitted = models.logistic_trials(*_splits(frame), grid)
        path = scratch_dir(spark, "contributions")
        model, test = next(iter(fitted.values())), frame.where(split_is("test"))
        shapley.kernel_contributions(model, test, P.FEATURES, "sprint_id").write.parquet(path)
        return spark.read.parquet(path)


@query
def partial_dependence_trees(spark, d):
    with _prepared(spark, d) as frame:
        model, test = _refitted(spark, d, frame), frame.where(split_is("test"))
        parts = shapley.tree_contributions(model, test, "sprint_id")
        top = [r["feature"] for r in explain.global_importance(parts).limit(5).collect()]
        path = scratch_dir(spark, "dependence")
        explain.partial_dependence(test, lambda df: scoring.predict(model, df), top).write.parquet(path)
        return spark.read.parquet(path)
