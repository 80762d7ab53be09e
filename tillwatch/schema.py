"""Table schemas. The column lists are fixed values: the raw files carry no header."""

TRANSACTION_DDL = (
    "transaction_id LONG, tx_datetime STRING, customer_id LONG, terminal_id LONG, "
    "tx_amount DOUBLE, tx_time_seconds LONG, tx_time_days INT, tx_fraud INT, tx_fraud_scenario INT"
)
TRANSACTION_COLUMNS = [part.split()[0] for part in TRANSACTION_DDL.split(", ")]

FEATURE_COLUMNS = [
    "tx_amount", "tx_time_seconds", "tx_time_days",
    "avg_customer_amount", "customer_tx_count",
    "avg_terminal_amount", "terminal_tx_count", "customer_amount_ratio",
]

RUNS_DDL = "run_id STRING, experiment STRING, status STRING, best_auc DOUBLE, best_model STRING"
RUN_VALUES_DDL = "run_id STRING, name STRING, value STRING"
MODEL_VERSIONS_DDL = "name STRING, version INT, run_id STRING, current_stage STRING"
VERSIONS_DDL = "name STRING, version INT, run_id STRING"
STAGES_DDL = "name STRING, version INT, current_stage STRING, change BIGINT"
