"""pricekit: Spark DataFrame operators and plans for pricing-data tables.

Every operator takes and returns a ``DataFrame`` (or a ``Column`` for the
scalar helpers in :mod:`pricekit.functions`); nothing is collected except
one-row aggregates such as a high-water mark or a QC status.
"""

from pricekit.session import get_session

__all__ = ["get_session"]
