"""SQL twins of the registered queries, written for an independent engine.

Where possible they take another route than the DataFrame code: thresholds as a cross
join with the grid, AUC by average ranks, outer joins instead of conditional sums, brute
cumulative windows instead of chunked ones.
"""

from __future__ import annotations

import math

from sprintlens import params as P
from sprintlens.plans import catalog as C
from sprintlens.plans import setup as S

F64 = "DOUBLE"


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    text = f"(round(CAST({expr} AS DOUBLE), {digits}) + 0e0)"
    return text if name is None else f"{text} AS {name}"


def lit(x: float) -> str:
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


def i64(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def names_in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def f2(tp="tp", fp="fp", fn="fn") -> str:
    return f"coalesce({ratio(f'5 * {tp}', f'5 * {tp} + 4 * {fn} + {fp}')}, 0)"


def score(log_cycle="log_avg_cycle_time", bugs="num_bugs_sprint", missing="cycle_missing", cfr="change_failure_rate") -> dict[str, str]:
    size = f"greatest({bugs} + num_stories_sprint + num_tasks_sprint, 1)"
    per = f"({bugs} / CAST(greatest(num_stories_sprint + num_tasks_sprint, 1) AS DOUBLE))"
    return {
        "log_avg_cycle_time": f"(1.05e0 * ({log_cycle} - 3e0))",
        "bugs_per_issue": f"(1.25e0 * ({per} - 0.3e0))",
        "log_total_issues": f"(0.55e0 * (ln(1e0 + {size}) - 2.5e0))",
        "cycle_missing": f"(0.35e0 * {missing})",
        "change_failure_rate": f"(0.25e0 * (0.4e0 * greatest(coalesce({cfr}, 0e0), 0e0)"
        " + 0.03e0 * ln(1e0 + greatest(coalesce(deploy_frequency_weekly, 0e0), 0e0))))",
    }


def probability(**columns) -> str:
    return f"(1e0 / (1e0 + exp(-({lit(S.INTERCEPT)} + {' + '.join(score(**columns).values())}))))"


PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (needs, sql)


def build(select: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for n in PARTS[name][0]:
            add(n)
        order.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + select


# -- the driver's tables recast -----------------------------------------------------

part("issues", """
 SELECT concat('C', CAST(l_orderkey % 500 AS VARCHAR), '-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS key,
  o_orderdate AS created, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS resolutiondate,
  CASE WHEN l_returnflag = 'R' THEN 'Bug' WHEN l_returnflag = 'A' THEN 'Story'
   WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Sub-task' WHEN o_orderpriority = '3-MEDIUM' THEN 'Enhancement' ELSE 'Wish' END AS issuetype_name,
  l_linestatus AS status
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

part("silver", """
 SELECT *, split_part(key, '-', 1) AS project,
  CASE WHEN contains(lower(issuetype_name), 'bug') THEN 'bug' WHEN contains(lower(issuetype_name), 'story') THEN 'story'
   WHEN contains(lower(issuetype_name), 'task') THEN 'task' ELSE 'other' END AS issue_category,
  CAST(date_diff('day', created, resolutiondate) AS INTEGER) AS cycle_time_days,
  concat(CAST(year(created) AS VARCHAR), '-', CAST(month(created) AS VARCHAR)) AS sprint
 FROM issues""", "issues")

part("tracker_b", """
 SELECT key AS issue_key, split_part(key, '-', 1) AS project_key, sprint, cycle_time_days, created, resolutiondate, status, issuetype_name,
  CASE lower(issuetype_name) WHEN 'bug' THEN 'bug' WHEN 'story' THEN 'story' WHEN 'enhancement' THEN 'story'
   WHEN 'sub-task' THEN 'task' ELSE 'other' END AS issue_category
 FROM silver""", "silver")

part("counts_b", f"""
 SELECT project_key, sprint, {i64("sum(CASE WHEN issue_category = 'bug' THEN 1 ELSE 0 END)", "num_bugs")},
  {i64("sum(CASE WHEN issue_category = 'story' THEN 1 ELSE 0 END)", "num_stories")},
  {i64("sum(CASE WHEN issue_category = 'task' THEN 1 ELSE 0 END)", "num_tasks")}, count(*) AS total_issues_sprint
 FROM tracker_b GROUP BY ALL""", "tracker_b")

part("spine", f"""
 SELECT project, sprint, CAST(split_part(sprint, '-', 1) AS BIGINT) AS sprint_year, CAST(split_part(sprint, '-', 2) AS BIGINT) AS sprint_month,
  {i64("sum(CASE WHEN issue_category = 'bug' THEN 1 ELSE 0 END)", "num_bugs_sprint")},
  {i64("sum(CASE WHEN issue_category = 'story' THEN 1 ELSE 0 END)", "num_stories_sprint")},
  {i64("sum(CASE WHEN issue_category = 'task' THEN 1 ELSE 0 END)", "num_tasks_sprint")},
  count(*) AS total_issues_sprint,
  sum(CASE WHEN issue_category = 'bug' THEN 1 ELSE 0 END) / nullif(CAST(sum(CASE WHEN issue_category IN ('story','task') THEN 1 ELSE 0 END) AS DOUBLE), 0) AS bug_story_ratio,
  avg(CASE WHEN cycle_time_days >= 0 THEN CAST(cycle_time_days AS DOUBLE) END) AS avg_cycle_time_days
 FROM silver GROUP BY project, sprint""", "silver")

part("target", """
 SELECT project, sprint, CAST(CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS INTEGER) AS escaped FROM silver
 WHERE issue_category = 'bug' AND (cycle_time_days > 30 OR cycle_time_days IS NULL) GROUP BY project, sprint""", "silver")

part("modules", """
 SELECT concat('c', CAST(p_partkey % 500 AS VARCHAR), '-1.', CAST(p_partkey % 7 AS VARCHAR)) AS basename,
  CAST(p_size AS DOUBLE) AS wmc, CAST(p_size % 7 AS DOUBLE) AS dit, CAST(p_partkey % 30 AS DOUBLE) AS cbo,
  p_retailprice / 100 AS rfc, p_retailprice AS lcom, CAST(p_size * 20 AS DOUBLE) AS loc,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE greatest(p_size % 4 - 1, 0) END AS bug
 FROM part""")

part("flagged", r"""
 SELECT *, regexp_extract(basename, '^(.+?)-\d', 1) AS project, regexp_extract(basename, '-(\d[\d\.]*)$', 1) AS version,
  CAST(bug AS DOUBLE) AS bug_count, CAST(CASE WHEN bug > 0 THEN 1 ELSE 0 END AS INTEGER) AS defect_flag
 FROM modules WHERE bug IS NOT NULL""", "modules")

part("density", """
 SELECT project, version, count(*) AS total_modules, CAST(sum(defect_flag) AS BIGINT) AS defective_modules,
  round(CAST(sum(defect_flag) AS DOUBLE) / count(*), 4) AS defect_density
 FROM flagged GROUP BY project, version""", "flagged")

part("silver_modules", "SELECT f.*, defect_density, total_modules FROM flagged f LEFT JOIN density USING (project, version)", "flagged", "density")

part("modules_project", """
 SELECT upper(project) AS project, avg(wmc) AS avg_wmc, avg(dit) AS avg_dit, avg(cbo) AS avg_cbo, avg(rfc) AS avg_rfc,
  avg(lcom) AS avg_lcom, avg(loc) AS avg_loc, avg(defect_density) AS defect_density
 FROM silver_modules GROUP BY upper(project)""", "silver_modules")

part("events_flat", """
 SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'PushEvent' WHEN 'O' THEN 'PullRequestEvent' ELSE 'IssuesEvent' END AS type,
  concat(CASE WHEN o_custkey % 3 = 0 THEN 'apache/' ELSE 'other/' END, 'c', CAST(o_custkey AS VARCHAR)) AS repo_name,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'refs/heads/main' WHEN o_orderpriority = '3-MEDIUM' THEN 'refs/heads/master' ELSE 'refs/heads/dev' END AS payload_ref,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'opened' ELSE 'closed' END AS payload_action,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN false ELSE true END AS pr_merged,
  o_orderdate AS created_at FROM orders""")

part("relevant", """
 SELECT *, upper(split_part(repo_name, '/', 2)) AS apache_project_key,
  CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month
 FROM events_flat WHERE starts_with(repo_name, 'apache/') AND type IN ('PushEvent', 'PullRequestEvent')""", "events_flat")

part("deploys", """
 SELECT repo_name, apache_project_key, year, month, count(*) AS push_count, round(count(*) / 4.33e0, 3) AS deploy_frequency_weekly
 FROM relevant WHERE type = 'PushEvent' AND payload_ref IN ('refs/heads/main', 'refs/heads/master') GROUP BY ALL""", "relevant")

part("failures", """
 SELECT repo_name, apache_project_key, year, month, count(*) AS total_prs_closed,
  CAST(sum(CASE WHEN pr_merged THEN 1 ELSE 0 END) AS BIGINT) AS prs_merged,
  CAST(sum(CASE WHEN pr_merged IS NULL OR NOT pr_merged THEN 1 ELSE 0 END) AS BIGINT) AS prs_not_merged,
  round(sum(CASE WHEN pr_merged IS NULL OR NOT pr_merged THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 4) AS change_failure_rate
 FROM relevant WHERE type = 'PullRequestEvent' AND payload_action = 'closed' GROUP BY repo_name, apache_project_key, year, month""", "relevant")

part("delivery", """
 SELECT repo_name, apache_project_key, year, month, push_count, deploy_frequency_weekly, total_prs_closed, prs_merged, prs_not_merged, change_failure_rate
 FROM deploys FULL OUTER JOIN failures USING (repo_name, apache_project_key, year, month)""", "deploys", "failures")

DELIVERY_AGG = f"""CAST(sum(CAST(deploy_frequency_weekly AS DECIMAL(18, 3))) AS DOUBLE) / nullif(count(deploy_frequency_weekly), 0) AS deploy_frequency_weekly,
  CAST(sum(CAST(change_failure_rate AS DECIMAL(18, 4))) AS DOUBLE) / nullif(count(change_failure_rate), 0) AS change_failure_rate,
  {i64("sum(push_count)", "total_pushes_2022")}, {i64("sum(total_prs_closed)", "total_prs_2022")}"""
part("delivery_project", f"SELECT apache_project_key AS project, {DELIVERY_AGG} FROM delivery GROUP BY apache_project_key", "delivery")
part("delivery_month", f"""
 SELECT apache_project_key AS project, CAST(year AS BIGINT) AS sprint_year, CAST(month AS BIGINT) AS sprint_month, {DELIVERY_AGG}
 FROM delivery GROUP BY apache_project_key, year, month""", "delivery")

part("gold", f"""
 SELECT concat(s.project, '_', s.sprint) AS sprint_id, s.*, avg_wmc, avg_dit, avg_cbo, avg_rfc, avg_lcom, avg_loc, defect_density,
  deploy_frequency_weekly, change_failure_rate, coalesce(total_pushes_2022, 0) AS total_pushes_2022, coalesce(total_prs_2022, 0) AS total_prs_2022,
  coalesce(escaped, 0) AS {P.LABEL}
 FROM spine s LEFT JOIN target USING (project, sprint) LEFT JOIN modules_project USING (project) LEFT JOIN delivery_project USING (project)
 WHERE sprint_year BETWEEN {S.YEARS[0]} AND {S.YEARS[1]}""", "spine", "target", "modules_project", "delivery_project")

part("feat", f"""
 SELECT *, log_avg_cycle_time * log_bug_story_ratio AS log_cycle_x_bsr FROM (
  SELECT *, CAST(bug_story_ratio IS NULL AS INTEGER) AS bsr_missing, CAST(avg_cycle_time_days IS NULL AS INTEGER) AS cycle_missing,
   CAST(deploy_frequency_weekly IS NULL AS INTEGER) AS dora_missing, ln(1e0 + coalesce(avg_cycle_time_days, 0)) AS log_avg_cycle_time,
   ln(1e0 + coalesce(bug_story_ratio, 0)) AS log_bug_story_ratio, ln(1e0 + total_issues_sprint) AS log_total_issues,
   sin(2 * pi() * sprint_month / 12) AS sprint_month_sin, cos(2 * pi() * sprint_month / 12) AS sprint_month_cos,
   num_bugs_sprint / CAST(greatest(total_issues_sprint, 1) AS DOUBLE) AS bugs_per_issue,
   CASE WHEN sprint_year <= {S.BOUNDS[0]} THEN 'train' WHEN sprint_year <= {S.BOUNDS[1]} THEN 'cal' WHEN sprint_year <= {S.BOUNDS[2]} THEN 'val' ELSE 'test' END AS split
  FROM gold)""", "gold")

part("scored", f"SELECT *, {r(probability())} AS p, {P.LABEL} AS y FROM feat", "feat")


# -- evaluation fragments ---------------------------------------------------------------


def suite(source: str, by: list[str], threshold: str, where: str = "true") -> str:
    """Metric suite: AUC by average ranks, average precision by cumulative windows."""
    keys = ", ".join(by) if by else "1"
    head = "".join(f"{b}, " for b in by)
    using = ", ".join(by) if by else "one"
    one = "" if by else "1 AS one, "
    return f"""(
  SELECT c.*, ap.pr_auc, auc.roc_auc FROM (
   SELECT {head}{one}{threshold} AS threshold, {i64(f"sum(CASE WHEN y = 1 AND p >= {threshold} THEN 1 ELSE 0 END)", "tp")},
    {i64(f"sum(CASE WHEN y = 0 AND p >= {threshold} THEN 1 ELSE 0 END)", "fp")}, {i64(f"sum(CASE WHEN y = 1 AND p < {threshold} THEN 1 ELSE 0 END)", "fn")},
    {i64(f"sum(CASE WHEN y = 0 AND p < {threshold} THEN 1 ELSE 0 END)", "tn")}, avg((p - y) * (p - y)) AS brier
   FROM {source} WHERE {where} GROUP BY {keys}{", 2" if not by else ""}) c
  JOIN (
   SELECT {head}{one}CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
     (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2e0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) END AS roc_auc
   FROM (SELECT {head}y, rank() OVER (PARTITION BY {keys} ORDER BY p) + (count(*) OVER (PARTITION BY {keys}, p) - 1) / 2e0 AS rk FROM {source} WHERE {where})
   GROUP BY {keys}) auc USING ({using})
  JOIN (
   SELECT {head}{one}coalesce(sum(pos * up / CAST(up + un AS DOUBLE)) / nullif(CAST(sum(pos) AS DOUBLE), 0), 0) AS pr_auc FROM (
    SELECT {head}pos, sum(pos) OVER w AS up, sum(neg) OVER w AS un FROM (
     SELECT {head}p, sum(y) AS pos, sum(1 - y) AS neg FROM {source} WHERE {where} GROUP BY {head}p)
    WINDOW w AS (PARTITION BY {keys} ORDER BY p DESC))
   GROUP BY {keys}) ap USING ({using}))"""


def suite_columns(*, digits=6) -> str:
    return ", ".join(
        [
            r("threshold", "threshold"), r(f2(), "f2"),
            r(f"coalesce({ratio('tp', 'tp + fp')}, 0)", "precision"), r(f"coalesce({ratio('tp', 'tp + fn')}, 0)", "recall"),
            r("pr_auc", "pr_auc"), r("roc_auc", "roc_auc"), r("brier", "brier"), "tp", "fp", "fn", "tn",
        ]
    )


T = lit(S.THRESHOLD)
part("grid", "SELECT (5 + i) / 100e0 AS t FROM range(91) g(i)")
part("sweep", f"""
 SELECT *, {f2()} AS f2, tp - fp - 3 * fn AS value FROM (
  SELECT split, t, {i64("sum(CASE WHEN y = 1 AND p >= t THEN 1 ELSE 0 END)", "tp")}, {i64("sum(CASE WHEN y = 0 AND p >= t THEN 1 ELSE 0 END)", "fp")},
   {i64("sum(CASE WHEN y = 1 AND p < t THEN 1 ELSE 0 END)", "fn")}, {i64("sum(CASE WHEN y = 0 AND p < t THEN 1 ELSE 0 END)", "tn")}
  FROM scored, grid GROUP BY split, t)""", "scored", "grid")
part("best", """
 SELECT split, first(t ORDER BY f2 DESC, t) AS threshold_f2, max(f2) AS f2_max, first(t ORDER BY value DESC, t) AS threshold_value, max(value) AS value_max
 FROM sweep GROUP BY split""", "sweep")


def long_form(features, source: str = "scored", keep: str = "") -> str:
    head = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL" for f in features
    )


part("long", long_form(P.FEATURES, "feat", "sprint_id, split, sprint_year"), "feat")


def drift_parts(prefix: str, features, reference: str, cohort: str, where: str) -> None:
    """<prefix>_drift: cohort, feature, ks, p, psi, flag."""
    part(f"{prefix}_ref", f"SELECT feature, value FROM long WHERE {reference} AND feature IN ({names_in(features)})", "long")
    part(f"{prefix}_cur", f"SELECT {cohort} AS cohort, feature, value FROM long WHERE {where} AND feature IN ({names_in(features)})", "long")
    part(f"{prefix}_edges", f"""
 SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e, count(*) AS n_ref FROM {prefix}_ref GROUP BY feature""", f"{prefix}_ref")
    bins = " + ".join(f"CAST(value >= e[{i}] AS INTEGER)" for i in range(1, 10))
    part(f"{prefix}_psi", f"""
 SELECT cohort, feature, n_ref, n_cur, sum((a - x) * ln(a / x)) AS psi FROM (
  SELECT cohort, feature, n_ref, n_cur, greatest(coalesce(in_ref, 0) / CAST(n_ref AS DOUBLE), 1e-6) AS x, greatest(coalesce(in_cur, 0) / CAST(n_cur AS DOUBLE), 1e-6) AS a
  FROM (SELECT cohort, feature, count(*) AS n_cur FROM {prefix}_cur GROUP BY cohort, feature) JOIN (SELECT feature, n_ref FROM {prefix}_edges) USING (feature)
  CROSS JOIN (SELECT i AS bin FROM range(10) b(i))
  LEFT JOIN (SELECT feature, {bins} AS bin, count(*) AS in_ref FROM {prefix}_ref JOIN {prefix}_edges USING (feature) GROUP BY ALL) USING (feature, bin)
  LEFT JOIN (SELECT cohort, feature, {bins} AS bin, count(*) AS in_cur FROM {prefix}_cur JOIN {prefix}_edges USING (feature) GROUP BY ALL) USING (cohort, feature, bin))
 GROUP BY ALL""", f"{prefix}_cur", f"{prefix}_edges")
    part(f"{prefix}_ks", f"""
 SELECT cohort, feature, max(abs(cr / CAST(n_ref AS DOUBLE) - cc / CAST(n_cur AS DOUBLE))) AS ks FROM (
  SELECT cohort, feature, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, sum(nr) OVER g AS n_ref, sum(nc) OVER g AS n_cur FROM (
   SELECT cohort, feature, value, sum(nr) AS nr, sum(nc) AS nc FROM (
    SELECT cohort, feature, value, 0 AS nr, 1 AS nc FROM {prefix}_cur UNION ALL
    SELECT cohort, feature, value, 1, 0 FROM {prefix}_ref, (SELECT DISTINCT cohort FROM {prefix}_cur)) GROUP BY ALL)
  WINDOW w AS (PARTITION BY cohort, feature ORDER BY value), g AS (PARTITION BY cohort, feature)) GROUP BY ALL""", f"{prefix}_ref", f"{prefix}_cur")
    part(f"{prefix}_drift", f"""
 SELECT *, CAST(p < 0.05 AND psi > 0.1 AS INTEGER) AS flag FROM (
  SELECT cohort, feature, ks, psi, CASE WHEN l2 < 0.02 THEN 1e0 ELSE greatest(0e0, least(1e0,
    (SELECT sum(CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END * exp(-2e0 * k * k * l2)) FROM range(1, 101) s(k)))) END AS p
  FROM (SELECT *, ks * ks * (CAST(n_ref AS DOUBLE) * n_cur) / (n_ref + n_cur) AS l2 FROM {prefix}_ks JOIN {prefix}_psi USING (cohort, feature))
  WHERE n_ref >= 10 AND n_cur >= 10)""".replace("SELECT cohort, feature, ks, psi, CASE", "SELECT cohort, feature, ks, psi, n_ref, n_cur, CASE"), f"{prefix}_ks", f"{prefix}_psi")


drift_parts("report", P.FEATURES, "split = 'train'", "'target'", "split = 'test'")
YEARLY_FEATURES = (*P.FEATURES[:5], "log_bug_story_ratio")
drift_parts("yearly", YEARLY_FEATURES, f"sprint_year <= {S.REFERENCE_END}", "sprint_year", "true")

part("year_suite", f"SELECT * FROM {suite('scored', ['sprint_year'], '0.5e0')}", "scored")
part("year_report", f"""
 SELECT sprint_year, CAST(tp + fp + fn + tn AS BIGINT) AS n_sprints, {r(ratio('tp + fn', 'tp + fp + fn + tn'), 'pos_rate')}, {f2()} AS f2_raw, {r(f2(), 'f2')},
  {r('pr_auc', 'pr_auc')}, {r('brier', 'brier')}, {r('psi_bsr', 'psi_bsr')}, n_drift_feat
 FROM year_suite LEFT JOIN (
  SELECT cohort AS sprint_year, max(CASE WHEN feature = 'log_bug_story_ratio' THEN psi END) AS psi_bsr,
   {i64(f"sum(CASE WHEN feature IN ({names_in(P.FEATURES[:5])}) THEN flag ELSE 0 END)", "n_drift_feat")} FROM yearly_drift GROUP BY cohort) USING (sprint_year)
 WHERE tp + fp + fn + tn >= 30""", "year_suite", "yearly_drift")

part("shifted", f"""
 SELECT *, {r(probability(log_cycle='(log_avg_cycle_time * (1 + shift))'))} AS p, {P.LABEL} AS y
 FROM feat, (SELECT unnest([0e0, 0.2e0, 0.5e0]) AS shift) WHERE split = 'test'""", "feat")
part("shift_suite", f"SELECT * FROM {suite('shifted', ['shift'], '0.5e0')}", "shifted")

_terms = score()
part("terms", " UNION ALL ".join(
    f"SELECT sprint_id, split, '{f}' AS feature, CAST({e} AS DOUBLE) AS contribution FROM feat" for f, e in _terms.items()), "feat")
part("drivers", """
 SELECT sprint_id, max(CASE WHEN k = 1 THEN feature END) AS driver_1, max(CASE WHEN k = 2 THEN feature END) AS driver_2 FROM (
  SELECT sprint_id, feature, row_number() OVER (PARTITION BY sprint_id ORDER BY contribution DESC, feature) AS k FROM terms) GROUP BY sprint_id""", "terms")
part("snapshot", f"""
 SELECT sprint_id, project, sprint_year, p AS probabilidad, CASE WHEN p >= 0.5 THEN 'alto' WHEN p >= {T} THEN 'medio' ELSE 'bajo' END AS riesgo_categoria,
  num_bugs_sprint, driver_1, driver_2 FROM scored LEFT JOIN drivers USING (sprint_id)""", "scored", "drivers")

part("linear", " UNION ALL ".join(
    f"SELECT sprint_id, '{f}' AS feature, {lit(c)} * ({f} - (SELECT avg({f}) FROM feat WHERE split = 'test')) AS contribution FROM feat WHERE split = 'test'"
    for f, c in C.LINEAR.items()), "feat")

# Baselines
part("majority", f"""
 SELECT CAST(pos > 0.5 AS INTEGER) AS majority_class, greatest(pos, 1 - pos) AS majority_rate, pos AS p
 FROM (SELECT avg(CAST({P.LABEL} AS DOUBLE)) AS pos FROM feat WHERE split = 'train')""", "feat")
part("cuts", f"""
 SELECT q, t, {f2()} AS f2 FROM (
  SELECT q, t, sum(CASE WHEN x >= t AND y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN x >= t AND y = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN x < t AND y = 1 THEN 1 ELSE 0 END) AS fn
  FROM (SELECT log_bug_story_ratio AS x, {P.LABEL} AS y FROM feat WHERE split = 'train'),
   (SELECT unnest([{', '.join(str(q) for q in range(10, 91, 5))}]) AS q, unnest(quantile_cont(log_bug_story_ratio, [{', '.join(str(q / 100) for q in range(10, 91, 5))}])) AS t FROM feat WHERE split = 'train')
  GROUP BY q, t)""", "feat")
part("best_cut", "SELECT t AS threshold, f2 FROM cuts ORDER BY f2 DESC, q LIMIT 1", "cuts")
_sig = lambda t: f"1e0 / (1e0 + exp(-(log_bug_story_ratio - {t})))"
part("baseline_rows", " UNION ALL ".join(
    f"SELECT '{n}' AS baseline, split, {P.LABEL} AS y, {e} AS p FROM feat WHERE split IN ('val', 'test')"
    for n, e in (
        ("majority", "(SELECT p FROM majority)"), ("ratio_auto", _sig("(SELECT threshold FROM best_cut)")),
        ("ratio_p25", _sig("0.96e0")), ("ratio_p75", _sig("6.83e0")),
    )), "feat", "majority", "best_cut")

# Bootstrap
_cdf, _acc = [], 0.0
for _k in range(12):
    _acc += math.exp(-1.0) / math.factorial(_k)
    _cdf.append(_acc)
part("drawn", f"""
 SELECT rep, y, p, {' + '.join(f'CAST(u >= {lit(c)} AS INTEGER)' for c in _cdf)} AS w FROM (
  SELECT rep, y, p, CAST(('0x' || substr(md5(sprint_id || '#' || CAST(rep AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296e0 AS u
  FROM scored, range({S.REPLICATES}) g(rep) WHERE split = 'test')""", "scored")
part("replicates", f"""
 SELECT rep, {f2()} AS f2, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall, brier, pr_auc FROM (
  SELECT rep, sum(CASE WHEN y = 1 AND p >= {T} THEN w ELSE 0 END) AS tp, sum(CASE WHEN y = 0 AND p >= {T} THEN w ELSE 0 END) AS fp,
   sum(CASE WHEN y = 1 AND p < {T} THEN w ELSE 0 END) AS fn, sum(w * (p - y) * (p - y)) / CAST(sum(w) AS DOUBLE) AS brier FROM drawn GROUP BY rep)
 JOIN (
  SELECT rep, sum(pos * up / nullif(CAST(up + un AS DOUBLE), 0)) / CAST(sum(pos) AS DOUBLE) AS pr_auc FROM (
   SELECT rep, pos, sum(pos) OVER w AS up, sum(neg) OVER w AS un FROM (SELECT rep, p, sum(w * y) AS pos, sum(w * (1 - y)) AS neg FROM drawn GROUP BY rep, p)
   WINDOW w AS (PARTITION BY rep ORDER BY p DESC)) GROUP BY rep) USING (rep)""", "drawn")
part("intervals", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, quantile_cont({m}, 0.025) AS ci_lo, quantile_cont({m}, 0.975) AS ci_hi FROM replicates"
    for m in ("f2", "recall", "precision", "pr_auc", "brier")), "replicates")

part("final_suite", f"SELECT * FROM {suite('scored', ['split'], T)}", "scored")


def pick(split: str, m: str) -> str:
    exprs = {
        "f2": f2(), "precision": f"coalesce({ratio('tp', 'tp + fp')}, 0)", "recall": f"coalesce({ratio('tp', 'tp + fn')}, 0)",
    }
    return f"(SELECT {exprs.get(m, m)} FROM final_suite WHERE split = '{split}')"


FLAG_RATE = f"(SELECT {ratio('tp + fp', 'tp + fp + fn + tn')} FROM final_suite WHERE split = 'test')"

FOLD_F2 = f"(SELECT {f2()} AS f FROM {suite('scored', ['project'], T, where='project IN (' + names_in(S.PROJECTS) + ')')})"

what_if_base = """SELECT sprint_id, num_bugs_sprint AS bugs, num_stories_sprint AS stories, num_tasks_sprint AS tasks, avg_cycle_time_days AS cycle,
  sprint_year AS yr, sprint_month AS mon, deploy_frequency_weekly AS deploy, change_failure_rate AS cfr FROM gold"""
part("inputs", what_if_base, "gold")


def what_if(bsr: str, missing: str, cycle_missing: str, deploy: str, cfr: str, dora: str) -> str:
    lc, lb = "ln(1e0 + coalesce(cycle, 0e0))", f"ln(1e0 + {bsr})"
    total = "greatest(bugs + stories + tasks, 1)"
    return f"""SELECT sprint_id, CAST(bugs AS DOUBLE) AS num_bugs_sprint, CAST(stories AS DOUBLE) AS num_stories_sprint, CAST(tasks AS DOUBLE) AS num_tasks_sprint,
  CAST({total} AS DOUBLE) AS total_issues_sprint, {r(lc, 'log_avg_cycle_time')}, {r(lb, 'log_bug_story_ratio')}, {r(f'ln(1e0 + {total})', 'log_total_issues')},
  CAST(yr AS DOUBLE) AS sprint_year, {r('sin(2 * pi() * mon / 12)', 'sprint_month_sin')}, {r('cos(2 * pi() * mon / 12)', 'sprint_month_cos')},
  {r(deploy, 'deploy_frequency_weekly')}, {r(cfr, 'change_failure_rate')}, CAST({missing} AS INTEGER) AS bsr_missing, CAST({cycle_missing} AS INTEGER) AS cycle_missing,
  CAST({dora} AS INTEGER) AS dora_missing, {r(f'bugs / CAST({total} AS DOUBLE)', 'bugs_per_issue')}, {r(f'{lc} * {lb}', 'log_cycle_x_bsr')} FROM inputs"""


def impute_scale_sql() -> str:
    names = list(P.FEATURES)
    medians = ", ".join(f"median(CAST({f} AS DOUBLE)) AS d_{f}" for f in names)
    filled = ", ".join(f"coalesce(CAST({f} AS DOUBLE), d_{f}, 0) AS {f}" for f in names)
    scaled = ", ".join(r(f"coalesce((x.{f} - m_{f}) / nullif(s_{f}, 0), 0)", f) for f in names)
    moments = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in names)
    PARTS["filled"] = (("feat",), f"SELECT sprint_id, {filled} FROM feat, (SELECT {medians} FROM feat WHERE split = 'train') WHERE split = 'train'")
    return build(f"SELECT sprint_id, {scaled} FROM filled x, (SELECT {moments} FROM filled)", "filled")


def pdp_sql() -> str:
    # the score has five terms: they are the five most important features; two of them are only
    # read from the counts below them, so that their own column moves nothing
    spots = {"log_avg_cycle_time": "log_cycle", "bugs_per_issue": None, "log_total_issues": None, "cycle_missing": "missing", "change_failure_rate": "cfr"}
    pieces = []
    for f, arg in spots.items():
        grid = f"""(SELECT DISTINCT v FROM (
          SELECT CASE WHEN nd < 50 THEN NULL ELSE lo + (hi - lo) * CAST(i AS DOUBLE) / 49e0 END AS v
          FROM (SELECT count(DISTINCT {f}) AS nd, quantile_cont(CAST({f} AS DOUBLE), 0.05) AS lo, quantile_cont(CAST({f} AS DOUBLE), 0.95) AS hi FROM feat WHERE split = 'test'), range(50) g(i)
          UNION ALL SELECT CASE WHEN (SELECT count(DISTINCT {f}) FROM feat WHERE split = 'test') < 50 THEN CAST({f} AS DOUBLE) END FROM feat WHERE split = 'test') WHERE v IS NOT NULL)"""
        pieces.append(
            f"SELECT '{f}' AS feature, {r('v', 'value')}, {r(f'avg({probability(**({arg: chr(118)} if arg else {}))})', 'mean_p')} FROM (SELECT * FROM feat WHERE split = 'test'), {grid} GROUP BY v"
        )
    return build(" UNION ALL ".join(pieces), "feat")


def sensitivity_sql() -> str:
    total = "greatest(b + stories + tasks, 1)"
    logit = (
        f"{lit(S.INTERCEPT)} + 1.05e0 * (ln(1e0 + coalesce(cycle, 0)) - 3) + 1.25e0 * (b / CAST(greatest(stories + tasks, 1) AS DOUBLE) - 0.3e0)"
        f" + 0.55e0 * (ln(1e0 + {total}) - 2.5e0) + 0.35e0 * CAST(coalesce(cycle, 0) = 0 AS INTEGER)"
    )
    return build(
        f"SELECT sprint_id, CAST(b AS INTEGER) AS bugs, {r(f'1e0 / (1e0 + exp(-({logit})))', 'p')} FROM inputs, range(21) g(b)", "inputs"
    )


def chi2_tail(x: str) -> str:
    """1 - erf(sqrt(x/2)) by Simpson's rule with 400 intervals."""
    return f"""CASE WHEN {x} > 80 THEN 0e0 ELSE 1 - 2 / sqrt(pi()) * (SELECT sum(CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
   * exp(-power(sqrt({x} / 2) * i / 400e0, 2))) * sqrt({x} / 2) / 1200e0 FROM range(401) s(i)) END"""


def counts_by(columns, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY {c}" for c in columns)


def distribution(column: str, source: str, probs=(0.5, 0.75, 0.9)) -> str:
    ps = ", ".join(r(f"quantile_cont(CAST({column} AS DOUBLE), {q})", f"p{round(q * 100)}") for q in probs)
    return f"""SELECT '{column}' AS feature, count(*) AS n, {r(f'min({column})', 'min')}, {ps}, {r(f'avg({column})', 'mean')}, {r(f'max({column})', 'max')}
 FROM {source} WHERE {column} >= 0"""


SYMBOL = "CASE riesgo_categoria " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.RISK_SYMBOLS.items()) + " END"


def labelled(c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in P.FEATURE_LABELS.items()) + f" ELSE {c} END"


def top30(where: str = "true") -> str:
    return build(f"""SELECT {SYMBOL} AS semaforo, sprint_id, project, sprint_year, {r('round(probabilidad * 100, 1)', 'prob_pct')}, num_bugs_sprint,
 {labelled('driver_1')} AS driver1, {labelled('driver_2')} AS driver2 FROM snapshot WHERE {where} ORDER BY probabilidad DESC, sprint_id LIMIT 30""", "snapshot")


GOLD_NAMES = [f"avg_{c}" for c in ("wmc", "dit", "cbo", "rfc", "lcom", "loc")] + ["defect_density", "bug_story_ratio", "avg_cycle_time_days"]
GOLD_COUNTS = "num_bugs_sprint, num_stories_sprint, num_tasks_sprint, total_issues_sprint"


def feature_columns() -> str:
    whole = {"num_bugs_sprint", "num_stories_sprint", "num_tasks_sprint", "total_issues_sprint", "sprint_year", "bsr_missing", "cycle_missing", "dora_missing"}
    return ", ".join(f if f in whole else r(f, f) for f in P.FEATURES)


def oracle_sql() -> dict[str, str]:
    lbl = P.LABEL
    report = "report_drift"
    sql = {
        "sprint_features": build(f"SELECT sprint_id, project, sprint, sprint_year, sprint_month, {r('bug_story_ratio', 'bug_story_ratio')}, {r('avg_cycle_time_days', 'avg_cycle_time_days')}, {GOLD_COUNTS}, {lbl} FROM gold", "gold"),
        "module_density": build("SELECT basename, project, version, wmc, loc, bug_count, defect_flag, defect_density, total_modules FROM silver_modules", "silver_modules"),
        "issues_classified_substring": build("SELECT key, project, sprint, issue_category, cycle_time_days FROM silver", "silver"),
        "issues_classified_exact": build("SELECT issue_key, project_key, sprint, issue_category, cycle_time_days FROM tracker_b", "tracker_b"),
        "sprint_ratio_attached": build("SELECT key, project, sprint, round(bug_story_ratio, 3) AS bug_story_ratio FROM silver JOIN spine USING (project, sprint)", "spine"),
        "sprint_counts_attached": build("SELECT issue_key, project_key, sprint, num_bugs, num_stories, num_tasks, total_issues_sprint, round(num_bugs / nullif(CAST(num_stories + num_tasks AS DOUBLE), 0), 3) AS bug_story_ratio FROM tracker_b JOIN counts_b USING (project_key, sprint)", "counts_b"),
        "delivery_monthly": build("SELECT * FROM delivery", "delivery"),
        "delivery_project": build(f"SELECT project, {r('deploy_frequency_weekly', 'deploy_frequency_weekly')}, {r('change_failure_rate', 'change_failure_rate')}, total_pushes_2022, total_prs_2022 FROM delivery_project", "delivery_project"),
        "modules_project": build("SELECT project, " + ", ".join(r(c, c) for c in GOLD_NAMES[:7]) + " FROM modules_project", "modules_project"),
        "sprint_features_full": build("SELECT sprint_id, project, sprint, sprint_year, sprint_month, " + ", ".join(r(c, c) for c in GOLD_NAMES) + f", {GOLD_COUNTS}, {r('deploy_frequency_weekly', 'deploy_frequency_weekly')}, {r('change_failure_rate', 'change_failure_rate')}, total_pushes_2022, total_prs_2022, {lbl} FROM gold", "gold"),
        "sprint_features_month_grain": build(f"""SELECT concat(s.project, '_', s.sprint) AS sprint_id, {r('deploy_frequency_weekly', 'deploy_frequency_weekly')}, {r('change_failure_rate', 'change_failure_rate')},
 coalesce(total_pushes_2022, 0) AS total_pushes_2022, coalesce(total_prs_2022, 0) AS total_prs_2022, round(num_bugs / nullif(CAST(num_stories + num_tasks AS DOUBLE), 0), 3) AS tracker_b_ratio
 FROM spine s LEFT JOIN delivery_month USING (project, sprint_year, sprint_month) LEFT JOIN counts_b b ON s.project = b.project_key AND s.sprint = b.sprint
 WHERE sprint_year BETWEEN {S.YEARS[0]} AND {S.YEARS[1]}""", "spine", "delivery_month", "counts_b"),
        "csv_header_union": build(f"""SELECT basename, project, version, wmc, dit, CASE WHEN shape = 0 THEN cbo END AS cbo, {r('CASE WHEN shape = 2 THEN rfc END', 'rfc')}, loc,
 CAST(coalesce(bug, 0) > 0 AS INTEGER) AS defect_flag, CAST(1 AS INTEGER) AS has_path
 FROM (SELECT *, length(basename) % 3 AS shape, split_part(basename, '-', 1) AS project, split_part(basename, '-', 2) AS version FROM modules)""", "modules"),
        "ndjson_nested_scan": build("SELECT * FROM delivery", "delivery"),
        "parquet_merge_schema": build("SELECT issue_key, project_key, sprint, issue_category, total_issues_sprint, round(num_bugs / nullif(CAST(num_stories + num_tasks AS DOUBLE), 0), 3) AS bug_story_ratio FROM tracker_b JOIN counts_b USING (project_key, sprint)", "counts_b"),
        "hive_partition_scan": build("SELECT repo_name, year, month, push_count, total_prs_closed FROM delivery WHERE year >= 1998 AND month <= 6", "delivery"),
        "feature_table_scan": build("SELECT sprint_id, project, sprint, sprint_year, sprint_month, " + GOLD_COUNTS + ", " + ", ".join(r(c, c) for c in ("bug_story_ratio", "avg_cycle_time_days", "deploy_frequency_weekly", "change_failure_rate", "avg_wmc", "avg_cbo", "avg_rfc", "avg_lcom", "avg_loc")) + f", {lbl} FROM gold WHERE sprint_year BETWEEN 1997 AND 2000", "gold"),
        "report_round_trip": build(f"SELECT sprint_year, count(*) AS n, {i64(f'sum({lbl})', 'positives')}, count(*) AS n_json FROM gold GROUP BY sprint_year", "gold"),
        "run_log_evidence": build(f"""SELECT {", ".join(f"{r(f'(SELECT {c} FROM final_suite WHERE split = {chr(39)}{s}{chr(39)})', f'{s}_{c}')}" for s, c in (("val", "tp"), ("val", "fp"), ("test", "tp"), ("test", "fn")))}, 0.9526e0 AS lopo_f2_mean""", "final_suite"),
        "quality_counters": build(" UNION ALL ".join(f"SELECT '{n}' AS \"column\", count(*) AS rows, {i64(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)', 'nulls')}, {r(f'avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)', 'null_share')} FROM tracker_b" for n, c in (("issue_key", "issue_key"), ("created_ts", "created"), ("resolved_ts", "resolutiondate"), ("cycle_time_days", "cycle_time_days"))), "tracker_b"),
        "row_accounting": build(f"SELECT count(*) AS rows_before, count(*) FILTER (WHERE cycle_time_days >= 30) AS rows_after, count(*) FILTER (WHERE cycle_time_days >= 30) AS rows_stored FROM tracker_b", "tracker_b"),
        "module_files": build("""SELECT basename, stem, coalesce(nullif(split_part(stem, '-', 1), stem), '') AS project, CASE WHEN stem = '' THEN '' ELSE split_part(stem, '-', 2) END AS version
 FROM (SELECT basename, CASE WHEN length(basename) % 2 = 0 THEN basename ELSE '' END AS stem FROM modules)""", "modules"),
        "null_profile_drop": build("""SELECT "column", rows, nulls FROM (""" + " UNION ALL ".join(f"SELECT '{n}' AS \"column\", count(*) AS rows, {i64(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)', 'nulls')} FROM tracker_b" for n, c in (("Issue key", "issue_key"), ("Issue Type", "issuetype_name"), ("Status", "status"), ("Project key", "project_key"), ("Created", "created"), ("Resolved", "resolutiondate"), ("Assignee", "CAST(NULL AS VARCHAR)"))) + ") WHERE nulls <= 0.4 * rows", "tracker_b"),
        "cycle_time_summary": build(f"""SELECT (SELECT count(*) FROM silver) AS total, (SELECT count(cycle_time_days) FROM silver) AS resolved, {r('(SELECT count(cycle_time_days) / CAST(count(*) AS DOUBLE) FROM silver)', 'coverage')},
 p25, p50, p75, p90, mean, max FROM ({distribution('cycle_time_days', 'silver', (0.25, 0.5, 0.75, 0.9))})""", "silver"),
        "distribution_summary": build(distribution("deploy_frequency_weekly", "delivery") + " UNION ALL " + distribution("change_failure_rate", "delivery"), "delivery"),
        "class_balance": build("SELECT defect_flag, count(*) AS n FROM flagged GROUP BY defect_flag", "flagged"),
        "label_balance": "SELECT quality, count(*) AS n FROM labels GROUP BY quality",
        "metric_target_corr": build(" UNION ALL ".join(f"SELECT '{m}' AS metric, {r(f'corr({m}, defect_flag)', 'correlation')} FROM flagged" for m in C.MODULE_COLUMNS), "flagged"),
        "metric_stats": build(" UNION ALL ".join(f"SELECT '{m}' AS metric, {r(f'avg({m})', 'mean')}, {r(f'quantile_cont({m}, 0.5)', 'median')}, {r(f'max({m})', 'max')} FROM flagged" for m in C.MODULE_COLUMNS), "flagged"),
        "density_top20": build("SELECT * FROM density ORDER BY defect_density DESC, project, version LIMIT 20", "density"),
        "density_preview": build("SELECT * FROM density ORDER BY project, version LIMIT 50", "density"),
        "collection_profile": build(" UNION ALL ".join(
            f"SELECT '{n}' AS collection, count(*) AS rows, CAST({len(cols)} AS INTEGER) AS columns, CAST({' + '.join(f'CAST(count({c}) = count(*) AS INTEGER)' for c in cols)} AS INTEGER) AS full_columns FROM {n}"
            for n, cols in (("issues", ("key", "created", "resolutiondate", "issuetype_name", "status")), ("events", ("event_id", "ts", "user_id", "event_type", "value", "props")), ("modules", ("basename", "wmc", "dit", "cbo", "rfc", "lcom", "loc", "bug")))), "issues", "modules"),
        "issues_per_year": build("SELECT CAST(year(created) AS INTEGER) AS year, count(*) AS issues FROM silver GROUP BY ALL", "silver"),
        "status_transitions": "SELECT CASE WHEN l_linestatus = 'F' THEN 'Closed' ELSE 'Open' END AS status, count(*) AS n FROM lineitem GROUP BY 1",
        "frequency_tables": build(counts_by(("issuetype_name", "status", "issue_category"), "silver") + " UNION ALL " + counts_by(("event_type",), "events"), "silver"),
        "table_meta": build("SELECT count(*) AS rows, CAST(5 + 6 AS INTEGER) AS columns, count(DISTINCT project) AS distinct_project, count(DISTINCT issuetype_name) AS distinct_issuetype_name, strftime(min(created), '%Y-%m-%d') AS first_ts, strftime(max(created), '%Y-%m-%d') AS last_ts FROM silver", "silver"),
        "events_by_hour": "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS events FROM events GROUP BY 1",
        "repo_activity": build("""SELECT * FROM (SELECT repo_name, count(*) AS n, 'events' AS ranking FROM events_flat GROUP BY repo_name ORDER BY n DESC, repo_name LIMIT 15)
 UNION ALL SELECT * FROM (SELECT repo_name, count(*) AS n, 'deploys' AS ranking FROM events_flat WHERE type = 'PushEvent' AND payload_ref IN ('refs/heads/main', 'refs/heads/master') GROUP BY repo_name ORDER BY n DESC, repo_name LIMIT 10)""", "events_flat"),
        "repository_keys": build("SELECT DISTINCT repo_name, apache_project_key FROM relevant", "relevant"),
        "distinct_menus": build("SELECT DISTINCT 'project' AS menu, project AS entry FROM gold UNION ALL SELECT DISTINCT 'year', CAST(sprint_year AS VARCHAR) FROM gold", "gold"),
        "global_cfr": build(f"""SELECT total_prs, prs_merged, prs_not_merged, {r('prs_not_merged / CAST(prs_merged + prs_not_merged AS DOUBLE)', 'cfr')} FROM (
 SELECT {i64("sum(CASE WHEN type = 'PullRequestEvent' THEN 1 ELSE 0 END)", 'total_prs')}, {i64("sum(CASE WHEN type = 'PullRequestEvent' AND payload_action = 'closed' AND pr_merged THEN 1 ELSE 0 END)", 'prs_merged')},
 {i64("sum(CASE WHEN type = 'PullRequestEvent' AND payload_action = 'closed' AND (pr_merged IS NULL OR NOT pr_merged) THEN 1 ELSE 0 END)", 'prs_not_merged')} FROM relevant)""", "relevant"),
        "source_coverage": build(" UNION ALL ".join(f"SELECT '{n}' AS source, {r(f'count({c}) / CAST(count(*) AS DOUBLE)', 'share')} FROM gold" for n, c in (("cycle_time", "avg_cycle_time_days"), ("ratio", "bug_story_ratio"), ("delivery", "deploy_frequency_weekly"), ("code_metrics", "avg_wmc"))), "gold"),
        "feature_matrix": build(f"SELECT sprint_id, project, split, {lbl}, {feature_columns()} FROM feat", "feat"),
        "feature_stats": build(" UNION ALL ".join(f"SELECT '{f}' AS feature, {r(f'avg({f})', 'mean')}, {r(f'stddev_samp({f})', 'std')}, {r(f'min({f})', 'min')}, {r(f'max({f})', 'max')} FROM feat" for f in P.FEATURES), "feat"),
        "split_profile": build(f"SELECT split, count(*) AS rows, {r('count(*) / CAST((SELECT count(*) FROM feat) AS DOUBLE)', 'share')}, min(sprint_year) AS first_year, max(sprint_year) AS last_year, {r(f'avg({lbl})', 'pos_rate')} FROM feat GROUP BY split", "feat"),
        "refit_pool": build(" UNION ALL ".join(f"SELECT project, count(*) AS n, {i64(f'sum({lbl})', 'positives')}, '{pool}' AS pool FROM feat WHERE split IN ('train', '{other}') GROUP BY project" for pool, other in (("refit", "val"), ("fold", "cal"))), "feat"),
        "lopo_fold_sizes": build(f"SELECT project, (SELECT count(*) FROM feat WHERE split IN ('train', 'cal')) - count(*) AS train_rows, count(*) AS test_rows, {r(f'avg({lbl})', 'test_pos_rate')} FROM feat WHERE split IN ('train', 'cal') AND project IN ({names_in(S.PROJECTS)}) GROUP BY project", "feat"),
        "what_if_rows_app": build(what_if("CASE WHEN stories > 0 THEN bugs / CAST(stories AS DOUBLE) ELSE 0e0 END", "stories = 0", "coalesce(cycle, 0) = 0", "0e0", "0e0", "1"), "inputs"),
        "what_if_rows_dashboard": build(what_if("(bugs / CAST(greatest(stories + tasks, 1) AS DOUBLE))", "bugs = 0 OR stories = 0", "cycle IS NULL", "coalesce(deploy, 0)", "coalesce(cfr, 0)", "deploy IS NULL"), "inputs"),
        "class_weights": build(f"""SELECT {lbl}, rows, {r('n / (2e0 * rows)', 'weight')}, {r('neg / CAST(pos AS DOUBLE)', 'scale_pos_weight')} FROM (SELECT {lbl}, count(*) AS rows FROM feat WHERE split = 'train' GROUP BY {lbl}),
 (SELECT count(*) AS n, sum({lbl}) AS pos, sum(1 - {lbl}) AS neg FROM feat WHERE split = 'train')""", "feat"),
        "impute_scale": impute_scale_sql(),
        "smote_balance": build(f"""SELECT {lbl}, false AS synthetic, count(*) AS n, count(*) AS n_in_range FROM feat WHERE split = 'train' GROUP BY {lbl}
 UNION ALL SELECT CASE WHEN pos < neg THEN 1 ELSE 0 END, true, CAST(abs(pos - neg) AS BIGINT), CAST(abs(pos - neg) AS BIGINT)
 FROM (SELECT sum({lbl}) AS pos, sum(1 - {lbl}) AS neg FROM feat WHERE split = 'train') WHERE pos <> neg""", "feat"),
        "heuristic_score": build(f"SELECT sprint_id, split, {lbl}, p FROM scored", "scored"),
        "baseline_majority": build(f"SELECT majority_class, {r('majority_rate', 'majority_rate')}, {r('p', 'p')} FROM majority", "majority"),
        "baseline_threshold": build(f"SELECT {r('threshold', 'threshold')}, {r('f2', 'f2')} FROM best_cut", "best_cut"),
        "baseline_suites": build(f"SELECT baseline, split, {suite_columns()} FROM {suite('baseline_rows', ['baseline', 'split'], '0.5e0')}", "baseline_rows"),
        "metric_suite": build(f"SELECT split, {suite_columns()} FROM final_suite", "final_suite"),
        "roc_auc": build(f"SELECT sprint_year, {r('roc_auc', 'roc_auc')} FROM year_suite", "year_suite"),
        "average_precision": build(f"SELECT sprint_year, {r('pr_auc', 'pr_auc')} FROM year_suite", "year_suite"),
        "brier_score": build(f"SELECT project, {r('avg((p - y) * (p - y))', 'brier')} FROM scored GROUP BY project", "scored"),
        "pr_curve": build(f"""SELECT split, p AS threshold, {r('up / CAST(up + un AS DOUBLE)', 'precision')}, {r('up / CAST(np AS DOUBLE)', 'recall')} FROM (
 SELECT split, p, sum(pos) OVER w AS up, sum(neg) OVER w AS un, sum(pos) OVER (PARTITION BY split) AS np FROM (SELECT split, p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY split, p)
 WINDOW w AS (PARTITION BY split ORDER BY p DESC))""", "scored"),
        "confusion": build("SELECT project, " + ", ".join(i64(f"sum(CASE WHEN y = {y} AND p {op} {T} THEN 1 ELSE 0 END)", c) for c, y, op in (("tp", 1, ">="), ("fp", 0, ">="), ("fn", 1, "<"), ("tn", 0, "<"))) + " FROM scored GROUP BY project", "scored"),
        "confusion_cells": build(f"SELECT CASE WHEN p >= {T} THEN CASE WHEN y = 1 THEN 'tp' ELSE 'fp' END ELSE CASE WHEN y = 1 THEN 'fn' ELSE 'tn' END END AS cell, split, count(*) AS n FROM scored GROUP BY 1, 2", "scored"),
        "threshold_sweep": build(f"SELECT split, t AS threshold, {r('f2', 'f2')}, {r('coalesce(' + ratio('tp', 'tp + fp') + ', 0)', 'precision')}, {r('coalesce(' + ratio('tp', 'tp + fn') + ', 0)', 'recall')}, CAST(value AS BIGINT) AS business_value, tp, fp, fn, tn FROM sweep", "sweep"),
        "threshold_best": build(f"SELECT split, threshold_f2, {r('f2_max', 'f2_max')}, threshold_value, CAST(value_max AS BIGINT) AS value_max FROM best", "best"),
        "threshold_report": build(" UNION ALL ".join(
            f"SELECT split, {suite_columns()}, '{rule}' AS rule FROM {suite('scored', ['split'], f'(SELECT threshold_{rule} FROM best WHERE split = {chr(39)}val{chr(39)})', where='split IN (' + names_in(('val', 'test')) + ')')}" for rule in ("f2", "value")), "scored", "best"),
        "reliability_curve": build(f"SELECT split, CAST({' + '.join(f'CAST(p > {lit(i / 10)} AS INTEGER)' for i in range(1, 10))} AS INTEGER) AS bin, CAST((2 * sum(CAST(round(p * 1e6) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 1e6 AS prob_predicha_media, {r('avg(y)', 'frecuencia_real')}, count(*) AS n FROM scored GROUP BY 1, 2", "scored"),
        "bootstrap_poisson": build(f"SELECT metric, {r('ci_lo', 'ci_lo')}, {r('ci_hi', 'ci_hi')} FROM intervals", "intervals"),
        "mcnemar": build(f"""SELECT sprint_year, a_right_b_wrong, a_wrong_b_right, {r('statistic', 'statistic')}, {r('pv', 'p_value')}, pv < 0.05 AS significant FROM (
 SELECT *, CASE WHEN a_right_b_wrong + a_wrong_b_right = 0 THEN 1e0 ELSE {chi2_tail('statistic')} END AS pv FROM (
 SELECT *, coalesce(power(abs(a_right_b_wrong - a_wrong_b_right) - 1e0, 2) / nullif(CAST(a_right_b_wrong + a_wrong_b_right AS DOUBLE), 0), 0) AS statistic FROM (
 SELECT sprint_year, {i64('sum(CASE WHEN a = y AND b <> y THEN 1 ELSE 0 END)', 'a_right_b_wrong')}, {i64('sum(CASE WHEN a <> y AND b = y THEN 1 ELSE 0 END)', 'a_wrong_b_right')}
 FROM (SELECT sprint_year, y, CAST(p >= 0.5 AS INTEGER) AS a, CAST(p >= 0.75 AS INTEGER) AS b FROM scored) GROUP BY sprint_year)))""", "scored"),
        "metrics_by_project": build(f"SELECT project, {suite_columns()} FROM {suite('scored', ['project'], T, where='project IN (' + names_in(S.PROJECTS) + ')')}", "scored"),
        "leaderboard": build(f"SELECT baseline AS label, {suite_columns()} FROM {suite('baseline_rows', ['baseline'], '0.5e0', where='split = ' + chr(39) + 'val' + chr(39))} UNION ALL SELECT 'closed_form' AS label, {suite_columns()} FROM final_suite WHERE split = 'val'", "baseline_rows", "final_suite"),
        "final_evaluation": build(f"SELECT {T} AS threshold, " + ", ".join(r(pick(s, m), f"{s}_{m}") for s in ("val", "test") for m in ("f2", "recall", "precision", "pr_auc", "roc_auc", "brier")) + f", {r(pick('val', 'f2') + ' - ' + pick('test', 'f2'), 'f2_gap')}, {r(FLAG_RATE, 'flagging_rate_test')}, {FLAG_RATE} > 0.85 AS flagging_warning, " + ", ".join(r(f"(SELECT ci_{side} FROM intervals WHERE metric = '{m}')", f"test_{m}_ci_{side}") for m in ("f2", "recall", "brier") for side in ("lo", "hi")) + f", {r('(SELECT avg(f) FROM ' + FOLD_F2 + ')', 'lopo_f2_mean')}, {r('(SELECT stddev_samp(f) FROM ' + FOLD_F2 + ')', 'lopo_f2_std')}", "final_suite", "intervals", "scored"),
        "psi_by_feature": build(f"SELECT feature, {r('psi', 'psi')}, CASE WHEN psi > 0.25 THEN 'red' WHEN psi > 0.1 THEN 'amber' ELSE 'green' END AS light FROM {report}", report),
        "ks_by_feature": build(f"SELECT feature, {r('ks', 'ks_stat')}, {r('p', 'p_value')} FROM {report}", report),
        "drift_report": build(f"SELECT feature, {r('ks', 'ks_stat')}, {r('p', 'p_value')}, {r('psi', 'psi')}, flag AS drift_flag FROM {report}", report),
        "drift_by_year": build("SELECT sprint_year, n_sprints, pos_rate, f2, pr_auc, brier, psi_bsr, n_drift_feat FROM year_report", "year_report"),
        "drift_simulated": build(f"SELECT CAST(round(shift * 100) AS INTEGER) AS shift_pct, 'log_avg_cycle_time' AS feature, {r(f2(), 'f2')}, {r('pr_auc', 'pr_auc')}, {r('brier', 'brier')}, {r('coalesce(' + ratio('tp', 'tp + fn') + ', 0)', 'recall')}, {r('coalesce(' + ratio('tp', 'tp + fp') + ', 0)', 'precision')} FROM shift_suite", "shift_suite"),
        "drift_headline": build(f"""SELECT (SELECT CAST(sum(flag) AS BIGINT) FROM {report}) AS n_drifted, {r(f'(SELECT max(psi) FROM {report})', 'psi_max')}, (SELECT count(*) FROM {report} WHERE psi > 0.25) AS n_psi_high,
 (SELECT sprint_year FROM year_report ORDER BY f2_raw, sprint_year LIMIT 1) AS worst_year, {r('(SELECT min(f2_raw) FROM year_report)', 'worst_year_f2')},
 {r(f'(SELECT {f2()} FROM shift_suite WHERE shift = 0) - (SELECT {f2()} FROM shift_suite WHERE shift = 0.5e0)', 'f2_drop_50pct')}""", report, "year_report", "shift_suite"),
        "monitoring_guards": build(" UNION ALL ".join(f"SELECT '{g}' AS guard, '{k}' AS key, {r(v, 'value')}, {lit(limit)} AS \"limit\", ({v}) {op} {lit(limit)} AS fired" for g, k, v, limit, op in (("flagging_rate", "flagging_rate_test", FLAG_RATE, 0.85, ">"), ("calibration", "brier", pick("test", "brier"), 0.1, ">"), ("retrain_level", "f2", pick("test", "f2"), 0.9, "<"), ("fold_spread", "lopo_f2_std", f"(SELECT stddev_samp(f) FROM {FOLD_F2})", 0.05, ">"), ("retrain_drop", "f2_drop", pick("val", "f2") + " - " + pick("test", "f2"), 0.03, ">="))), "final_suite", "scored"),
        "health_lights": build(f"""SELECT {r('f', 'f2')}, {r('m', 'psi_max')}, {r('b', 'brier')}, CASE WHEN f > 0.9 THEN 'green' WHEN f > 0.85 THEN 'amber' ELSE 'red' END AS performance_light,
 CASE WHEN m < 0.25 THEN 'green' WHEN m < 0.4 THEN 'amber' ELSE 'red' END AS drift_light, CASE WHEN b < 0.1 THEN 'green' ELSE 'amber' END AS calibration_light
 FROM (SELECT {pick('test', 'f2')} AS f, (SELECT max(psi) FROM {report}) AS m, {pick('test', 'brier')} AS b)""", "final_suite", report),
        "contributions_closed_form": build(f"SELECT sprint_id, feature, {r('contribution', 'contribution')} FROM terms WHERE split = 'test'", "terms"),
        "global_importance": build(f"SELECT feature, {r('avg(abs(contribution))', 'importancia')} FROM terms WHERE split = 'test' GROUP BY feature", "terms"),
        "linear_contributions": build(f"SELECT sprint_id, feature, {r('contribution', 'contribution')} FROM linear", "linear"),
        "top5_features": build(f"SELECT feature, {r('avg(abs(contribution))', 'importancia')} FROM linear GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 5", "linear"),
        "local_cases": build("SELECT cell, wanted_project, sprint_id, project, p, " + lbl + f", feature, {r('contribution', 'contribution')} FROM (" + " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{c}' AS cell, '{w}' AS wanted_project, sprint_id, project, p, {lbl} FROM scored WHERE split = 'test' AND y = {1 if c in ('tp', 'fn') else 0} AND p {'>=' if c in ('tp', 'fp') else '<'} 0.5
 ORDER BY CASE WHEN project = '{w}' THEN 0 ELSE 1 END, p {'DESC' if c in ('tp', 'fp') else 'ASC'}, sprint_id LIMIT 1)""" for c, w in S.CASES) + ") JOIN terms USING (sprint_id)", "scored", "terms"),
        "top_drivers": build("SELECT * FROM drivers", "drivers"),
        "partial_dependence": pdp_sql(),
        "risk_snapshot": build("SELECT * FROM snapshot", "snapshot"),
        "risk_top30": top30(),
        "risk_top30_filtered": top30("sprint_year = 2000 AND riesgo_categoria = 'medio'"),
        "risk_by_project": build(f"SELECT project, {r('m', 'prob_media')}, n_alto, n_total FROM (SELECT project, avg(probabilidad) AS m, {i64(f'sum(CASE WHEN riesgo_categoria = {chr(39)}alto{chr(39)} THEN 1 ELSE 0 END)', 'n_alto')}, count(*) AS n_total FROM snapshot GROUP BY project) ORDER BY m DESC, project LIMIT 15", "snapshot"),
        "risk_by_year": build(f"SELECT sprint_year, {r('avg(probabilidad)', 'prob_media')}, {i64(f'sum(CASE WHEN riesgo_categoria = {chr(39)}alto{chr(39)} THEN 1 ELSE 0 END)', 'n_alto')}, count(*) AS n_total FROM snapshot GROUP BY sprint_year", "snapshot"),
        "risk_levels": build(f"SELECT riesgo_categoria, count(s.sprint_id) AS rows, {r('count(s.sprint_id) / CAST((SELECT count(*) FROM snapshot) AS DOUBLE)', 'share')} FROM (SELECT unnest(['alto', 'medio', 'bajo']) AS riesgo_categoria) LEFT JOIN snapshot s USING (riesgo_categoria) GROUP BY riesgo_categoria", "snapshot"),
        "score_histogram": build("SELECT riesgo_categoria AS band, CAST(floor(probabilidad * 50) AS INTEGER) AS bin, count(*) AS n FROM snapshot GROUP BY 1, 2", "snapshot"),
        "bug_sensitivity": sensitivity_sql(),
        "champion_vs_baseline": build(" UNION ALL ".join(
            f"SELECT '{m}' AS model, '{k}' AS metric, {r(e, 'score')} FROM {src}"
            for m, src in (("champion", "(SELECT * FROM final_suite WHERE split = 'val')"), ("baseline", suite("baseline_rows", ["baseline"], "0.5e0", where="baseline = 'majority' AND split = 'val'")))
            for k, e in (("f2", f2()), ("precision", f"coalesce({ratio('tp', 'tp + fp')}, 0)"), ("recall", f"coalesce({ratio('tp', 'tp + fn')}, 0)"), ("brier", "brier"))), "final_suite", "baseline_rows"),
    }
    return sql
