"""Fixed values that must equal the published pipeline for right results."""

# -- Fixed values: source columns ---------------------------------------------
MODULE_METRICS = (
    "wmc", "dit", "noc", "cbo", "rfc", "lcom", "ca", "ce", "npm",
    "lcom3", "loc", "dam", "moa", "mfa", "cam", "ic", "cbm", "amc",
)
MODULE_TARGETS = ("bug", "bugs", "defects", "defect", "class", "fault")
ISSUE_TYPE_COLUMNS = ("issuetype_name", "issuetype", "issue_type")
SPARSE_ISSUE_COLUMNS = ("regression", "patchinfo", "environment", "duedate", "timeestimate")
TRACKER_B_NAMES = {
    "Issue key": "issue_key",
    "Issue Type": "issue_type",
    "Status": "status",
    "Project key": "project_key",
    "Project name": "project_name",
    "Project type": "project_type",
    "Resolution": "resolution",
    "Created": "created_raw",
    "Resolved": "resolved_raw",
    "Assignee": "assignee",
    "Updated": "updated_raw",
    "Fix Version/s": "fix_versions",
}
TRACKER_B_DROPPED = ("assignee", "updated_raw", "fix_versions", "_source_file", "_zip_source")
DAY_FIRST_FORMAT = "dd/MM/yyyy HH:mm"

# -- Fixed values: issue categories -------------------------------------------
STORY_TYPES = ("story", "epic", "feature", "feature request", "enhancement")
TASK_TYPES = ("task", "sub-task", "subtask", "spike", "component upgrade", "release")

# -- Fixed values: delivery metrics -------------------------------------------
OWNER_PREFIX = "apache/"
RELEVANT_EVENTS = ("PushEvent", "PullRequestEvent")
DEPLOY_BRANCHES = ("refs/heads/main", "refs/heads/master")
WEEKS_PER_MONTH = 4.33

# -- Fixed values: label, gold range, splits ----------------------------------
ESCAPE_DAYS = 30
GOLD_YEARS = (2000, 2022)
FEATURE_YEARS = (2000, 2021)
TRAIN_END, CAL_END, VAL_END = 2014, 2015, 2018
DRIFT_REFERENCE_END = 2015
FOLD_PROJECTS = ("HTTPCLIENT", "IO", "MATH", "MYFACES", "NET")
SEED = 42

# -- Fixed values: features ---------------------------------------------------
LABEL = "defecto_escapado"
FEATURES = (
    "num_bugs_sprint", "num_stories_sprint", "num_tasks_sprint", "total_issues_sprint",
    "log_avg_cycle_time", "log_bug_story_ratio", "log_total_issues",
    "sprint_year", "sprint_month_sin", "sprint_month_cos",
    "deploy_frequency_weekly", "change_failure_rate",
    "bsr_missing", "cycle_missing", "dora_missing",
    "bugs_per_issue", "log_cycle_x_bsr",
)
FEATURE_LABELS = {
    "num_bugs_sprint": "Bugs",
    "num_stories_sprint": "Stories",
    "num_tasks_sprint": "Tasks",
    "total_issues_sprint": "Total issues",
    "log_avg_cycle_time": "Cycle time (log)",
    "log_bug_story_ratio": "Bug/story ratio (log)",
    "log_total_issues": "Sprint size (log)",
    "sprint_year": "Year",
    "sprint_month_sin": "Month (sin)",
    "sprint_month_cos": "Month (cos)",
    "deploy_frequency_weekly": "Deploy freq",
    "change_failure_rate": "Change failure rate",
    "bsr_missing": "No bug/story ratio",
    "cycle_missing": "No cycle time",
    "dora_missing": "No DORA metrics",
    "bugs_per_issue": "Bug density",
    "log_cycle_x_bsr": "Chronic bugs",
}

# -- Fixed values: evaluation -------------------------------------------------
BETA = 2.0
GRID_FIRST, GRID_LAST = 5, 95  # thresholds in hundredths
COST_FP, COST_FN = 1.0, 3.0
PROMOTION_MARGIN = 0.005
CALIBRATION_MARGIN = 1e-6
BASELINE_CUTS = {"p25": 0.96, "p75": 6.83}
LEADERBOARD_ORDER = (
    "label", "f2", "pr_auc", "recall", "precision", "roc_auc", "brier",
    "tp", "fp", "fn", "tn", "threshold",
)
LR_C = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
LR_SMOTE_C = (0.1, 1.0, 10.0)

# -- Fixed values: closed-form score ------------------------------------------
SCORE_INTERCEPT = -1.90
SCORE_CYCLE, SCORE_CYCLE_CENTRE = 1.05, 3.0
SCORE_RATIO, SCORE_RATIO_CENTRE = 1.25, 0.30
SCORE_SIZE, SCORE_SIZE_CENTRE = 0.55, 2.5
SCORE_MISSING = 0.35
SCORE_DELIVERY, SCORE_CFR, SCORE_DEPLOY = 0.25, 0.4, 0.03

# -- Fixed values: risk and monitoring ----------------------------------------
OPERATING_THRESHOLD = 0.220
HIGH_RISK = 0.5
RISK_SYMBOLS = {"alto": "🔴", "medio": "🟡", "bajo": "🟢"}
PSI_FLOOR = 1e-6
DRIFT_P, DRIFT_PSI = 0.05, 0.10
MIN_SAMPLE, MIN_YEAR_ROWS = 10, 30
