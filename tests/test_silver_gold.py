import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import gold, shaping, silver

DAY = datetime.datetime(2020, 3, 1)


def issues(spark, rows):
    """(key, type, created, days until resolved or None)"""
    data = [
        (k, t, c, None if d is None else c + datetime.timedelta(days=d)) for k, t, c, d in rows
    ]
    return spark.createDataFrame(data, "key string, issuetype_name string, created timestamp, resolutiondate timestamp")


def test_label_boundaries(spark):
    rows = [
        ("A-1", "Bug", DAY, 30), ("B-1", "Bug", DAY, 31), ("C-1", "Bug", DAY, None),
        ("D-1", "Bug", DAY, -5), ("E-1", "Story", DAY, None),
    ]
    spine = gold.sprint_spine(silver.classify_tracker_a(issues(spark, rows)))
    got = {r["project"]: (r[P.LABEL], r["avg_cycle_time_days"]) for r in spine.collect()}
    assert got == {"A": (0, 30.0), "B": (1, 31.0), "C": (1, None), "D": (0, None), "E": (0, None)}


def test_null_created_and_key_are_dropped_and_sparse_columns_go(spark):
    df = issues(spark, [("A-1", "Bug", DAY, 1), (None, "Bug", DAY, 1)]).withColumn("environment", F.lit("x"))
    out = silver.classify_tracker_a(df)
    assert out.count() == 1 and "environment" not in out.columns


def test_no_stories_gives_null_ratio(spark):
    df = silver.silver_tracker_a(issues(spark, [(f"A-{i}", "Bug", DAY, 1) for i in range(3)]))
    assert {r["bug_story_ratio"] for r in df.collect()} == {None}


def test_unparsable_sprint_is_absent_from_gold(spark):
    df = spark.createDataFrame(
        [("A", "", "bug", 3), ("A", "2001-2", "bug", 3), ("A", "1990-2", "bug", 3)],
        "project string, sprint string, issue_category string, cycle_time_days int",
    )
    out = gold.build_sprint_features(df).collect()
    assert [(r["sprint_id"], r["sprint_year"], r["sprint_month"]) for r in out] == [("A_2001-2", 2001, 2)]


def test_tracker_b_dates_and_counts(spark):
    raw = spark.createDataFrame(
        [
            ("K-1", "Bug", "K", "02/11/2023 10:00", "05/11/2023 09:00", None),
            ("K-2", "Enhancement", "K", "03/11/2023 10:00", None, "z"),
            ("K-3", "Bug", "K", "2023-11-03", None, "z"),
            (None, "Bug", "K", "03/11/2023 10:00", None, "z"),
        ],
        ["Issue key", "Issue Type", "Project key", "Created", "Resolved", "Assignee"],
    )
    out = {r["issue_key"]: r for r in silver.silver_tracker_b(raw).collect()}
    assert set(out) == {"K-1", "K-2", "K-3"}
    assert out["K-1"]["cycle_time_days"] == 3 and out["K-1"]["sprint"] == "2023-11"
    assert out["K-1"]["bug_story_ratio"] == 1.0 and out["K-1"]["num_stories"] == 1
    assert out["K-3"]["sprint"] == "" and "assignee" not in out["K-1"].asDict()


def events(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "event_id int, event_type string, repo_name string, payload_ref string, payload_action string, pr_merged boolean, created_at string",
    )


def test_delivery_one_sided_groups_and_three_valued_merge(spark):
    jan, ref = "2022-01-05T00:00:00Z", "refs/heads/main"
    rows = [
        ("PushEvent", "apache/a", ref, None, None, jan),
        ("PullRequestEvent", "apache/b", None, "closed", True, jan),
        ("PullRequestEvent", "apache/b", None, "closed", False, jan),
        ("PullRequestEvent", "apache/b", None, "closed", None, jan),
        ("PullRequestEvent", "apache/c", None, "opened", None, jan),
        ("PushEvent", "apache/d", "refs/heads/dev", None, None, jan),
        ("PushEvent", "other/a", ref, None, None, jan),
        ("IssuesEvent", "apache/a", ref, None, None, jan),
    ]
    out = {r["repo_name"]: r for r in silver.delivery_monthly(silver.relevant_events(events(spark, rows))).collect()}
    assert set(out) == {"apache/a", "apache/b"}
    a, b = out["apache/a"], out["apache/b"]
    assert (a["push_count"], a["deploy_frequency_weekly"], a["total_prs_closed"], a["change_failure_rate"]) == (1, 0.231, None, None)
    assert (b["push_count"], b["prs_merged"], b["prs_not_merged"], b["change_failure_rate"]) == (None, 1, 2, 0.6667)
    assert b["apache_project_key"] == "B" and (b["year"], b["month"]) == (2022, 1)


def test_single_aggregate_equals_outer_join(spark):
    from sprintlens.plans import setup as S

    relevant = S.relevant_events(spark, "/root/testdata/sf0.001")
    keys = ["repo_name", "apache_project_key", "year", "month"]
    push = relevant.where((F.col("event_type") == "PushEvent") & F.col("payload_ref").isin(*P.DEPLOY_BRANCHES))
    closed = relevant.where((F.col("event_type") == "PullRequestEvent") & (F.col("payload_action") == "closed"))
    joined = push.groupBy(*keys).agg(F.count("*").alias("push_count")).join(
        closed.groupBy(*keys).agg(F.count("*").alias("total_prs_closed")), keys, "outer"
    )
    mine = silver.delivery_monthly(relevant).select(*joined.columns)
    assert mine.exceptAll(joined).count() == 0 and joined.exceptAll(mine).count() == 0


def test_modules_flags_density_and_text_targets(spark):
    raw = spark.createDataFrame(
        [("ant-1.3", "1", "TRUE"), ("ant-1.3", "x", "FALSE"), ("ant-1.3", "3", None), ("arc", "2", "2")],
        ["basename", " WMC ", "Defects"],
    )
    out = silver.silver_modules(raw, F.col("basename")).orderBy("basename", "wmc").collect()
    assert [(r["project"], r["wmc"], r["defect_flag"], r["defect_density"], r["total_modules"]) for r in out] == [
        ("ant", None, 0, 0.5, 2), ("ant", 1.0, 1, 0.5, 2), ("", 2.0, 1, 1.0, 1),
    ]


def test_missing_target_raises(spark):
    with pytest.raises(ValueError):
        silver.flag_modules(spark.createDataFrame([("a-1", 1)], ["basename", "wmc"]), F.col("basename"))


def test_names_that_collide_raise(spark):
    with pytest.raises(ValueError):
        shaping.normalise_names(spark.createDataFrame([(1, 2)], ["a", " A"]))


def test_attach_equals_window_and_keeps_null_keys_unmatched(spark):
    from pyspark.sql.window import Window

    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    sums = rows.groupBy("k").agg(F.sum("v").alias("s"))
    got = {(r["k"], r["v"]): r["s"] for r in silver.attach(rows, sums, ["k"]).collect()}
    assert got == {("a", 1): 3, ("a", 2): 3, ("b", 3): 3, (None, 4): None}
    safe = {(r["k"], r["v"]): r["s"] for r in silver.attach(rows, sums, ["k"], null_safe=True).collect()}
    window = rows.withColumn("s", F.sum("v").over(Window.partitionBy("k")))
    assert safe == {(r["k"], r["v"]): r["s"] for r in window.collect()}


def test_counted_filter_counts_in_one_pass(spark):
    seen = Observation("drop")
    df = shaping.counted_filter(spark.newSession().range(10).toDF("x"), F.col("x") > 3, seen)
    assert df.count() == 6 and seen.get == {"rows_before": 10, "rows_after": 6}


def test_drop_sparse(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, None), (3, 1, 2)], "a int, b int, c int")
    assert shaping.drop_sparse(df).columns == ["a", "c"]
    assert shaping.drop_sparse(df, keep=["b"]).columns == ["a", "b", "c"]


def test_means_of_rounded_values_are_exact(spark):
    rows = [("A", 0.1, 0.1, 1, 1)] * 10
    df = spark.createDataFrame(rows, "apache_project_key string, deploy_frequency_weekly double, change_failure_rate double, push_count int, total_prs_closed int")
    assert gold.delivery_by_project(df).first()["deploy_frequency_weekly"] == 0.1
