"""Expectations and change flows of the financial pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

# Expectation names and predicates, per dataset.
ACCOUNTS = {
    "valid_acct_id": "acct_id IS NOT NULL",
    "valid_balance": "balance >= 0.0",
    "valid_acct_status": "acct_status IS NOT NULL",
}
CUSTOMERS = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_acct_id": "acct_id IS NOT NULL",
    "valid_state_cd": "state_cd IS NOT NULL AND length(state_cd) = 2",
    "valid_coordinates": "longitude IS NOT NULL AND latitude IS NOT NULL",
}
TRANSACTIONS = {
    "valid_transaction_id": "transaction_id IS NOT NULL",
    "valid_acct_id": "acct_id IS NOT NULL",
    "valid_total_amt": "total_amt IS NOT NULL AND total_amt > 0.0",
    "valid_transaction_date": "transaction_date IS NOT NULL",
}
TRANSACTIONS_APPEND = {
    **TRANSACTIONS,
    "valid_ticker_symbol": "ticker_symbol IS NOT NULL",
    "valid_total_holdings": "total_holdings IS NOT NULL AND total_holdings >= 0.0",
}
PROFILE = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_acct_id": "acct_id IS NOT NULL",
    "positive_transaction_count": "total_transactions > 0",
    "positive_transaction_value": "total_transactions_value > 0.0",
    "valid_date_range": "first_transaction_date <= latest_transaction_date",
}
GEO = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_acct_id": "acct_id IS NOT NULL",
    "valid_ticker_symbol": "ticker_symbol IS NOT NULL",
    "valid_state_cd": "state_cd IS NOT NULL",
    "valid_coordinates": "longitude IS NOT NULL AND latitude IS NOT NULL",
    "positive_holdings": "total_holdings >= 0.0",
}

# What counts as a delete, the columns of a feed, the flows' keys and exclusions.
DELETE_CONDITION = "operation_type = 'delete'"
FEED_COLUMNS = (
    "operation_type",
    "commit_version",
    "commit_timestamp",
    "source_file",
    "ingestion_timestamp",
)


@dataclass(frozen=True)
class ChangeFlow:
    """How one bronze table turns into one SCD2 table."""

    name: str
    keys: tuple[str, ...]
    except_column_list: tuple[str, ...]
    expectations: dict[str, str] = field(default_factory=dict)
    sequence_by: str = "commit_timestamp"
    apply_as_deletes: str | None = DELETE_CONDITION
    # Columns in which a null leaves the value that was there, or True for all.
    ignore_null_updates: bool | tuple[str, ...] = False


ACCOUNTS_FLOW = ChangeFlow(
    "accounts", ("acct_id",), FEED_COLUMNS + ("created_date",), ACCOUNTS
)
CUSTOMERS_FLOW = ChangeFlow(
    "customers", ("customer_id",), FEED_COLUMNS + ("created_at",), CUSTOMERS
)
TRANSACTIONS_FLOW = ChangeFlow(
    "transactions", ("transaction_id",), FEED_COLUMNS + ("created_date",), TRANSACTIONS
)


# What the pipelines' tables say about themselves, by layer.
COMMENTS = {
    "bronze": "Rows as they came from the source",
    "silver": "Typed rows with their validity",
    "gold": "A view rebuilt in full on each refresh",
}
PROPERTIES = {layer: {"quality": layer} for layer in COMMENTS}
