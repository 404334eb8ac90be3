"""Landed cost of a product from its cost components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricekit.functions.text import to_amount

# The cost component columns, in the order they are added.
MATERIAL = "matrl_cost"
MATERIAL_ADDER_PCT = "malad_cost"
COST_TERMS = ("vwrty_cost", "vtrdx_cost", "vrlty_cost", "ovblc_cost", "ofxdc_cost")


def _term(name: str) -> Column:
    return F.coalesce(to_amount(name), F.lit(0.0))


def landed_cost(material: str = MATERIAL, adder_pct: str = MATERIAL_ADDER_PCT,
                terms: tuple[str, ...] = COST_TERMS) -> Column:
    """``material * (1 + adder_pct / 100) + term1 + term2 + ...`` as DOUBLE.

    Each component is parsed from text with ``try_cast`` and a missing or
    unparsable one counts as 0. The additions run left to right in the
    given order, so floating-point results are reproducible.
    """
    total = _term(material) * (F.lit(1.0) + _term(adder_pct) / F.lit(100.0))
    for t in terms:
        total = total + _term(t)
    return total.cast("double")
