"""Import every query module so the registry is complete."""

from tallyframe.plans import (  # noqa: F401
    bank_queries, billing_queries, cleaning_queries, delivery_queries, ledger_queries, rollup_queries, subscription_queries,
)
from tallyframe.plans.registry import QUERIES, runner  # noqa: F401
