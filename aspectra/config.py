"""Fixed values shared by every pipeline.

These must equal the values the original applications use, because model
heads, stored tables and dashboards depend on their order.
"""

# --- fixed values (order matters: it is the model head / class index order) ---
ASPECTS = ["Price", "Shipping", "Outlook", "Quality", "Size", "Shop_Service", "General", "Others"]
SENTIMENTS = ["NONE", "NEG", "POS", "NEU"]          # class index 0..3
DASHBOARD_SENTIMENTS = ["POS", "NEU", "NEG"]        # bar/pie order; NONE optional
LABEL_VALUES = [-1, 0, 1, 2]                        # integer label of class index 0..3
UNKNOWN_LABEL = -99
PAD_ID = 0
UNK_ID = 1
HEAD_MAX_LEN = 64       # streaming scorer: keep the first 64 ids
TAIL_MAX_LEN = 100      # tokenizer-style scorer: keep the last 100 ids
RESULT_TABLE = "absa_results"   # relational result table read by dashboards
# --- end of fixed values ---

# --- fixed values: isolation forest settings of the anomaly application ---
FOREST_TREES = 50
FOREST_SAMPLE = 500
FOREST_CONTAMINATION = 0.01
FOREST_SEED = 42
# --- end of fixed values ---

# Envelope every topic source emits (same columns as the Kafka source).
ENVELOPE_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)
HELD_VOCAB = 200_000  # vocabulary entries that one Python worker holds; a larger vocabulary is joined
