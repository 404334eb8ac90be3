"""Column-level helpers: pure expressions, evaluated inside whole-stage codegen."""

from pricekit.functions.text import (
    clean_path,
    normalise_date_text,
    normalise_quarter,
    parse_date_text,
    to_amount,
)
from pricekit.functions.cost import COST_TERMS, landed_cost

__all__ = [
    "COST_TERMS",
    "clean_path",
    "landed_cost",
    "normalise_date_text",
    "normalise_quarter",
    "parse_date_text",
    "to_amount",
]
