"""Sources: config-driven table reads and the adapters that shape the test tables."""

from pricekit.sources.tables import (
    columns_ci,
    read_previous,
    read_table,
    table_name,
)

__all__ = ["columns_ci", "read_previous", "read_table", "table_name"]
