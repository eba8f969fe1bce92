"""Explicit schemas of the sources (no inference pass, pruned parsing)."""

from pyspark.sql import types as T

from sprintlens import params as P

REPOSITORY_EVENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("repo", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("actor", T.StructType([T.StructField("login", T.StringType())])),
        T.StructField(
            "payload",
            T.StructType(
                [
                    T.StructField("ref", T.StringType()),
                    T.StructField("action", T.StringType()),
                    T.StructField(
                        "pull_request", T.StructType([T.StructField("merged", T.BooleanType())])
                    ),
                ]
            ),
        ),
        T.StructField("created_at", T.StringType()),
    ]
)

MODULE_METRIC_FIELDS = {name: T.DoubleType() for name in P.MODULE_METRICS}

CHANGE_LOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType([T.StructField("field", T.StringType()), T.StructField("to", T.StringType())])
            ),
        ),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)
