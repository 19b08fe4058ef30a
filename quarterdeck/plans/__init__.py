"""Table-level plans: managed tables, loaders, sinks and the staged build."""

from quarterdeck.plans.managed import managed_balance, managed_cash_flow, managed_income, managed_profile
from quarterdeck.plans.storage import checkpoint_root, checkpointed, staging_path
from quarterdeck.plans.tables import align_to, copy_tables, load_append, load_replace, save_table, write_partitioned

__all__ = [
    "align_to",
    "checkpoint_root",
    "checkpointed",
    "copy_tables",
    "load_append",
    "load_replace",
    "managed_balance",
    "managed_cash_flow",
    "managed_income",
    "managed_profile",
    "save_table",
    "staging_path",
    "write_partitioned",
]
