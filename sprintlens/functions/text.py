"""Keys, categories and dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintlens import params as P


def category_by_substring(kind: Column) -> Column:
    """Tracker A: first of bug/story/task found inside the type name; null is other."""
    text = F.lower(kind)
    rule = F.when(text.contains("bug"), "bug")
    for word in ("story", "task"):
        rule = rule.when(text.contains(word), word)
    return rule.otherwise("other")


def category_by_name(kind: Column) -> Column:
    """Tracker B: whole type name looked up in the story and task lists."""
    text = F.lower(kind)
    return (
        F.when(text == "bug", "bug")
        .when(text.isin(*P.STORY_TYPES), "story")
        .when(text.isin(*P.TASK_TYPES), "task")
        .otherwise("other")
    )


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.csv$", 1)


def module_project(stem: Column) -> Column:
    """Text before the first dash followed by a digit; no such dash gives ''."""
    return F.regexp_extract(stem, r"^(.+?)-\d", 1)


def module_version(stem: Column) -> Column:
    return F.regexp_extract(stem, r"-(\d[\d\.]*)$", 1)


def issue_project(key: Column) -> Column:
    return F.get(F.split(key, "-"), F.lit(0))


def repository_key(name: Column) -> Column:
    """Upper-cased repository part of owner/name; null when there is no slash."""
    return F.upper(F.get(F.split(name, "/"), F.lit(1)))


def sprint_key(ts: Column) -> Column:
    """year-month without padding; a null date gives '' because concat_ws skips nulls."""
    return F.concat_ws("-", F.year(ts), F.month(ts))


def sprint_part(sprint: Column, position: int) -> Column:
    return F.get(F.split(sprint, "-"), F.lit(position)).try_cast("bigint")


def timestamp_of(df: DataFrame, name: str, pattern: str | None = None) -> Column:
    """Timestamp from text or any date-like column; text that does not parse gives null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(F.col(name), F.lit(pattern)) if pattern else F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def labelled(code: Column, labels: dict[str, str]) -> Column:
    """Code → display label, the code itself where no label exists."""
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(pairs[code], code)
