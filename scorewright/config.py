"""Names, thresholds and policies shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The card-default dataset's column names, in file order. A
# generic export calls them x1..x23, so the alias of a name is its position.
FEATURE_COLUMNS = (
    "limit_bal", "sex", "education", "marriage", "age",
    "pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6",
    "bill_amt1", "bill_amt2", "bill_amt3", "bill_amt4", "bill_amt5", "bill_amt6",
    "pay_amt1", "pay_amt2", "pay_amt3", "pay_amt4", "pay_amt5", "pay_amt6",
)
# Names of the target, of categorical, monitored and slice columns.
TARGET = "default_next_month"
TARGET_ALIASES = ("default_payment_next_month", "y")
CATEGORICAL_COLUMNS = (
    "sex", "education", "marriage",
    "pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6",
)
MONITORED_COLUMNS = ("limit_bal", "age", "bill_amt1", "pay_amt1")
SLICE_COLUMNS = ("sex", "education", "marriage")

SEED = 42
TEST_SIZE = 0.20
HOLDOUT_SIZE = 0.30

DECISION_THRESHOLD = 0.5
REVIEW_FROM, HIGH_FROM = 0.20, 0.50
BANDS = ("low", "review", "high")
CALIBRATION_BINS = 10

PSI_BINS = 10
PSI_EPSILON = 1e-6
WATCH_PSI, ALERT_PSI = 0.10, 0.25

SELECTION_METRIC = "pr_auc"
BASELINE_MODEL, CHALLENGER_MODEL = "logistic_regression", "gradient_boosting"
TOP_FEATURES = 10
PERMUTATION_REPEATS = 2

ROW_ID = "row_id"

# A window over at most this many rows runs as one task; more rows are split
# by range first (operators/running.py).
ROWS_PER_TASK = 1_000_000


# The default promotion policy and its rollback text.
@dataclass(frozen=True)
class PromotionPolicy:
    minimum_pr_auc_gain: float = 0.005
    maximum_brier_degradation: float = 0.01
    minimum_recall: float = 0.30


ROLLBACK_TRIGGER = "PR-AUC or calibration breaches the approved production threshold"


def schema_ddl(columns=FEATURE_COLUMNS, categorical=CATEGORICAL_COLUMNS, target=TARGET) -> str:
    """DDL of the full dataset, so that large reads need no inference pass."""
    types = ["int" if c in categorical or c == "age" else "double" for c in columns]
    fields = [f"{c} {t}" for c, t in zip(columns, types)]
    return ", ".join([f"{ROW_ID} bigint", *fields, f"{target} int"])
