"""Row checks on a raw transaction. Every builder returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID_LABELS = (0, 1)


def parse_datetime(column: str = "tx_datetime") -> Column:
    """Text to timestamp; unparsable text gives NULL, also under ANSI mode."""
    return F.try_to_timestamp(F.col(column))


def is_bad_date(column: str = "tx_datetime") -> Column:
    return parse_datetime(column).isNull()


def is_nonpositive_amount(column: str = "tx_amount") -> Column:
    return F.col(column) <= 0


def label_in_domain(column: str = "tx_fraud") -> Column:
    """NULL for a NULL label, so as a filter it drops NULLs ..."""
    return F.col(column).isin(*VALID_LABELS)


def label_out_of_domain(column: str = "tx_fraud") -> Column:
    """... and its negation does not count them."""
    return ~label_in_domain(column)


def has_valid_ids() -> Column:
    return (F.col("customer_id") >= 0) & (F.col("terminal_id") >= 0)


def is_keepable() -> Column:
    """What the cleaner keeps: parsable date, label in domain, both ids known and not negative."""
    return ~is_bad_date() & label_in_domain() & has_valid_ids()


def reject_reason() -> Column:
    """First failing check of an arriving row, NULL for a good row."""
    return F.coalesce(
        F.when(F.col("transaction_id").isNull(), F.lit("missing_id")),
        F.when(is_bad_date(), F.lit("bad_date")),
        F.when(F.col("tx_fraud").isNull() | label_out_of_domain(), F.lit("bad_label")),
        F.when(F.coalesce(F.col("customer_id"), F.lit(-1)) < 0, F.lit("bad_customer")),
        F.when(F.coalesce(F.col("terminal_id"), F.lit(-1)) < 0, F.lit("bad_terminal")),
        F.when(F.col("tx_amount").isNull(), F.lit("missing_amount")),
        F.when(is_nonpositive_amount(), F.lit("nonpositive_amount")),
    )
