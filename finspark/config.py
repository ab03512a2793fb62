"""Pipeline parameters and the fixed values the results depend on."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# Seed table: plan -> monthly price used by MRR.
SUBSCRIPTION_PLANS = [("basic", 29), ("pro", 79), ("enterprise", 199)]
# ARR model prices its plans with its own CASE table (not the seed).
ARR_PLAN_PRICES = [("basic", 10), ("pro", 30), ("enterprise", 100)]
# Monitoring thresholds.
MAX_VOLUME_DROP_PCT = 0.35
MAX_VOLUME_SPIKE_PCT = 0.60
MAX_FRESHNESS_DAYS = 2
# Compliance scan.
PII_COLUMN_HINTS = ["full_name", "name", "email", "phone", "address"]
EMAIL_PATTERN = r"[A-Za-z0-9._%+]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\b(\+?\d[\d\s().-]{7,}\d)\b"
COMPLIANCE_SAMPLE_ROWS = 200
COMPLIANCE_SAMPLE_COLUMNS = 6
# Finance insight rules.
HEADLINE_MOVE_PCT = 0.10
REFUND_PRESSURE_RATE = 0.05
# Anomaly rule.
ANOMALY_Z = 3.0
# Retrieval defaults.
RETRIEVE_TOP_K = 8
RETRIEVE_MIN_SCORE = 0.30
CHUNK_TARGET_CHARS = 900
CHUNK_OVERLAP_CHARS = 120
CHUNK_MIN_CHARS = 80
CHURN_GATE_TERMS = ["churn", "subscription_status", "canceled", "cancelled"]
INTRO_PENALTY_TERMS = ["## purpose", "this document", "these queries are not exploratory"]
INTRO_PENALTY = 0.12
CHURN_SOURCE_BONUS = [("example_sql.md", 0.10), ("metric_definitions.md", 0.06), ("dbt_model_docs.md", 0.04)]
CHURN_SQL_TERMS = ["```sql", "select"]
CHURN_HEADING_TERMS = ["## churn", "churn calculation"]
CONTENT_BONUS = 0.10
GROUNDED_ANSWER_LINES = [
    "Churn is calculated from subscription cancellations.",
    "A churn event occurs when a subscription has `subscription_status = canceled`.",
    "Churn tables are built from `silver_subscriptions` and exposed via `gold_churn`.",
]
GROUNDED_FALLBACK = ("Based on retrieved documentation, churn is defined in the knowledge base, "
                     "but the exact definition was not strongly matched.")
GROUNDED_NO_MATCH = "No strong matches found in the knowledge base."
# Report texts.
CAUSE_TESTS_FAILED = "dbt tests failed, likely schema or data quality regression in upstream models"
CAUSE_VOLUME_DROP = "volume dropped sharply, likely missing ingest or incremental filter issue"
CAUSE_FRESHNESS = "freshness failure, likely pipeline did not load newest partition"
REASON_NO_HISTORY = "not enough history"
REASON_PREV_ZERO = "previous day count was 0"
REASON_NO_ROWS = "no rows"
HEADLINE_DOWN = "Net revenue down {pct} versus prior day"
HEADLINE_UP = "Net revenue up {pct} versus prior day"
HEADLINE_STABLE = "Net revenue stable versus prior day"
HEADLINE_NO_BASELINE = "Net revenue reported, but prior day baseline missing"
HEADLINE_NO_DATA = "No daily revenue data found"
NOTE_NO_DATA = "gold_daily_revenue missing or empty"
DRIVER_REFUND_PRESSURE = "Refund pressure: Refund rate {rate} is elevated"
FINDING_PII_COLUMN = "pii_column_name"
FINDING_PII_VALUE = "pii_value_pattern"
FINDING_SCAN_ERROR = "scan_error"
# ---------------------------------------------------------------------------

# Run date of the registered queries: after the last fixture date, so that
# their results are reproducible.  Runs without a date use the current one.
FIXTURE_AS_OF = dt.date(2002, 1, 1)


@dataclass(frozen=True)
class PipelineConfig:
    as_of: dt.date | None = None  # None: the current date
    max_volume_drop_pct: float = MAX_VOLUME_DROP_PCT
    max_volume_spike_pct: float = MAX_VOLUME_SPIKE_PCT
    max_freshness_days: int = MAX_FRESHNESS_DAYS
    # Incremental bronze: rows with ingestion_date >= max(target) - lookback_days
    lookback_days: int = 0
    # Compliance compatibility switches (see README, "Divergences").
    strict_compat: bool = False
    # PII value scan over the first 200 rows and six columns only (every row and column otherwise).
    pii_sample: bool = False
    extra_tables: tuple[str, ...] = field(default_factory=tuple)
