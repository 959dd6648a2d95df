"""Whole runs: full migration and incremental sync of one table."""

from tidegate.plans.flows import TableFlow, customer_flow, item_flow
from tidegate.plans.runs import SyncResult, run_migration, run_sync

__all__ = [
    "SyncResult", "TableFlow", "customer_flow", "item_flow", "run_migration", "run_sync",
]
