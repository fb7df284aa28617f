"""Names and literal values shared by every layer.

The block marked FIXED VALUES holds literals whose exact text is part of the
observable result (keys, labels, defaults); changing any of them changes the
output tables.
"""

# --- FIXED VALUES (must stay exactly as written) ---------------------------
# uuid v5 namespace used for version keys (the public ISO OID namespace).
UUID5_NAMESPACE = "6ba7b812-9dad-11d1-80b4-00c04fd430c8"
# Watermark used when the target table is empty.
EMPTY_WATERMARK = "1900-01-01"
# Default source-system label stamped by the ingest layer.
DEFAULT_SOURCE_SYSTEM = "SAP"
# Labels of the history mart.
STATE_OPEN = "VIGENTE"
STATE_CLOSED = "HISTORICO"
# Constant columns of the comparison mart.
SCD1_BEHAVIOR = "SCD1_SK_IS_STABLE"
SCD2_BEHAVIOR = "SCD2_SK_CHANGES_ON_UPDATE"
# Separator between the natural key and the change time in a version seed.
SEED_SEPARATOR = "|"
# ---------------------------------------------------------------------------

# Column names produced by the layers.
SOURCE_TS = "source_updated_at"
INGESTED_AT = "_ingested_at"
SOURCE_SYSTEM = "_source_system"
SK = "sk_name"
SILVER_UPDATED_AT = "_silver_updated_at"
SILVER_CREATED_AT = "_silver_created_at"
VALID_FROM = "valid_from_sk"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"
GOLD_CREATED_AT = "_gold_created_at"

# Change-log columns.
COMMIT_ID = "_commit_id"
COMMITTED_AT = "_committed_at"
OPERATION = "_operation"

# Audit columns never compared between runs (wall-clock or random).
AUDIT_COLUMNS = (INGESTED_AT, SILVER_UPDATED_AT, SILVER_CREATED_AT, GOLD_CREATED_AT)
