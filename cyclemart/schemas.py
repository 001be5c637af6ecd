"""Entity schemas, keys and rule sets.

The entity layout, primary keys and quality rules below are fixed values that must equal
the documented pipeline configuration for results to match; they are stated here once,
in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: expected file types of one cycle, in routing priority order -------
EXPECTED_FILE_TYPES = ["transactions", "policy", "coverage", "feature", "exchange", "rider"]

# --- fixed values: primary keys per entity ------------------------------------------
PRIMARY_KEYS = {
    "transactions": ["transaction_id", "cycle_date"],
    "policy": ["policy_id"],
    "coverage": ["coverage_id", "policy_id"],
    "feature": ["feature_id"],
    "exchange": ["exchange_id"],
    "rider": ["rider_id", "policy_id"],
}

# --- fixed values: quality rule sets per entity -------------------------------------
DQ_RULES = {
    "transactions": {
        "not_null": ["transaction_id", "cycle_date", "transaction_amount", "transaction_status"],
        "no_duplicates": ["transaction_id", "cycle_date"],
        "positive_values": ["transaction_amount"],
        "allowed_values": {"transaction_status": ["SUCCESS", "FAILED", "PENDING"]},
        "min_row_count": 1,
    },
    "policy": {"not_null": ["policy_id"], "no_duplicates": ["policy_id"], "min_row_count": 1},
    "coverage": {
        "not_null": ["coverage_id", "policy_id"],
        "no_duplicates": ["coverage_id", "policy_id"],
        "min_row_count": 1,
    },
    "feature": {"not_null": ["feature_id"], "no_duplicates": ["feature_id"], "min_row_count": 1},
    "exchange": {"not_null": ["exchange_id"], "no_duplicates": ["exchange_id"], "min_row_count": 1},
    "rider": {
        "not_null": ["rider_id", "policy_id"],
        "no_duplicates": ["rider_id", "policy_id"],
        "min_row_count": 1,
    },
}

# --- fixed values: business vocabularies ---------------------------------------------
SUCCESS_STATUS = "SUCCESS"
ACTIVE_POLICY_STATUSES = ["ACTIVE", "RENEWAL"]
AUDIT_STATUSES = ["RECEIVED", "PROCESSING", "SUCCESS", "FAILED"]
MERGE_UPDATED_BY = "glue_job"
INITIAL_LOAD_BY = "initial_load"
AUDIT_RETENTION_DAYS = 90

# --- fixed values: output columns, in order ---------------------------------------------
# Columns every staged entity carries (set at ingest time).
PROVENANCE_COLUMNS = ["ingestion_date", "cycle_date", "file_type"]
# Warehouse audit columns of the published fact.
DW_COLUMNS = ["dw_inserted_date", "dw_updated_date", "dw_updated_by", "dw_cycle_date", "dw_is_active"]


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STRING, DOUBLE, INT, TS, LONG = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType(), T.LongType()
)

# Explicit CSV schemas: inference would read ``20240101`` as INT.
ENTITY_SCHEMAS: dict[str, T.StructType] = {
    "transactions": _s(
        ("transaction_id", STRING), ("cycle_date", STRING), ("policy_id", STRING),
        ("transaction_amount", DOUBLE), ("transaction_status", STRING),
        ("is_commission_eligible", INT), ("agent_id", STRING), ("commission_rate", DOUBLE),
        ("exchange_code", STRING), ("feature_id", STRING),
    ),
    "policy": _s(("policy_id", STRING), ("policy_status", STRING)),
    "coverage": _s(("coverage_id", STRING), ("policy_id", STRING)),
    "feature": _s(("feature_id", STRING), ("feature_name", STRING)),
    "exchange": _s(("exchange_id", STRING), ("exchange_code", STRING), ("exchange_rate", DOUBLE)),
    "rider": _s(("rider_id", STRING), ("policy_id", STRING)),
}

# --- fixed values: columns of the quality results and of the audit table ------------------
DQ_RESULT_SCHEMA = T.StructType([
    T.StructField("table", STRING, False),
    T.StructField("rule", STRING, False),
    T.StructField("column", STRING, True),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("failing_count", LONG, False),
    T.StructField("details", STRING, False),
])

AUDIT_SCHEMA = _s(
    ("file_key", STRING), ("cycle_date", STRING), ("bucket", STRING), ("object_key", STRING),
    ("file_type", STRING), ("file_name", STRING), ("ingestion_timestamp", TS),
    ("status", STRING), ("file_size", LONG), ("created_at", TS), ("updated_at", TS),
)

AUDIT_KEYS = ["file_key", "cycle_date"]
