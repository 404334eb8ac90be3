"""The five pricing jobs, each a composition of operators with a ``run(spark, config)``."""

from pricekit.plans import cluster, cost, geo, ground_truth, rates

__all__ = ["cluster", "cost", "geo", "ground_truth", "rates"]
