"""Names and types of the tables."""

from __future__ import annotations

SNAPSHOT = "snapshot_date"
FEATURE_PREFIX = "fe_"
KEYS = ["loan_id", "Customer_ID", SNAPSHOT]

# Columns of the daily loan feed and their types in silver.
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

# Columns silver adds.
DELINQUENCY_TYPES = {
    "mob": "int",
    "installments_missed": "int",
    "first_missed_date": "date",
    "dpd": "int",
}

# Label store and prediction store.
LABEL_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "label": "int",
    "label_def": "string",
    "snapshot_date": "date",
}
PREDICTION_TYPES = {
    "Customer_ID": "string",
    "snapshot_date": "date",
    "model_name": "string",
    "model_predictions": "double",
}

SILVER_TYPES = LOAN_TYPES | DELINQUENCY_TYPES


def ddl(types: dict[str, str]) -> str:
    """Schema text of a column-to-type map."""
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def quoted(name: str) -> str:
    """Column name as it must be written where a dot would mean a field."""
    return "`" + name.replace("`", "``") + "`"


def feature_columns(columns: list[str]) -> list[str]:
    """Feature columns, found by their prefix, in table order."""
    return [name for name in columns if name.startswith(FEATURE_PREFIX)]
