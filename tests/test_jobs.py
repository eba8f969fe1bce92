"""Raw files through every batch job and the whole modelling pipeline."""

from pyspark.sql import functions as F

from sprintlens.operators import models
from sprintlens.plans import jobs, pipeline
from sprintlens.plans import setup as S
from sprintlens.sources import readers, views

FOLDER = "/root/testdata/sf0.001"


def test_jobs_and_pipeline(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    views.issues(spark, FOLDER, parts=20).write.parquet(f"{raw}/issues")
    S.tracker_b_raw(spark, FOLDER).write.parquet(f"{raw}/b")
    views.repository_events(spark, FOLDER).write.option("compression", "gzip").json(f"{raw}/events")
    (raw / "csv" / "c1").mkdir(parents=True)
    (raw / "csv" / "c1" / "c1-1.0.csv").write_text("WMC,dit,cbo,rfc,lcom,loc,bug\n3,1,1,1,1,10,1\n4,1,1,1,1,20,0\n")

    a = jobs.tracker_a(spark, f"{raw}/issues", f"{out}/issues")
    assert a["rows"] == 6000 and a["null_created"] == 0
    assert spark.read.parquet(f"{out}/issues").count() == 6000
    assert jobs.tracker_b(spark, f"{raw}/b", f"{out}/b")["rows"] == 6000
    assert jobs.modules(spark, f"{raw}/csv", f"{out}/modules") == {"rows": 2, "defective": 1}
    d = jobs.delivery(spark, f"{raw}/events", f"{out}/delivery")
    assert 0 < d["rows_after"] < d["rows_before"] == 1500

    # the jobs' fixed year range suits the published data; these orders lie before it in part
    seen = jobs.gold_table(spark, f"{out}/issues", f"{out}/modules", f"{out}/delivery", f"{out}/gold")
    assert spark.read.parquet(f"{out}/gold").count() == seen["rows"] > 0

    path = f"{out}/gold_all"
    from sprintlens.operators import gold
    from sprintlens.sources import writers

    writers.write_feature_table(
        gold.build_sprint_features(
            spark.read.parquet(f"{out}/issues"), spark.read.parquet(f"{out}/modules"),
            spark.read.parquet(f"{out}/delivery"), years=S.YEARS,
        ),
        path,
    )
    settings = pipeline.Settings(
        years=S.YEARS, bounds=S.BOUNDS, reference_end=S.REFERENCE_END, projects=("C1", "C2"),
        cases=(("tp", "C1"), ("tn", "C2")), replicates=10,
        grid=models.logistic_grid()[4:5], trials=1,
    )
    summary = pipeline.run(spark, path, f"{out}/run", settings).first()
    assert summary["champion"] in models.FAMILIES and 0 < summary["test_f2"] <= 1
    assert summary["test_f2_ci_lo"] <= summary["test_f2"] <= summary["test_f2_ci_hi"] + 1e-9

    log = spark.read.parquet(f"{out}/run/run_log")
    run_id = log.first()["run_id"]
    found = readers.run_evidence(log, run_id, {"test_f2": 0.0, "absent": 0.1}).first()
    assert (found["test_f2"], found["absent"]) == (summary["test_f2"], 0.1)
    snapshot = readers.read_snapshot(spark, f"{out}/run/snapshot")
    assert snapshot.where(F.col("driver_1").isNull()).count() == 0
    assert readers.read_metric_document(spark, f"{out}/run/summary").first()["champion"] == summary["champion"]
