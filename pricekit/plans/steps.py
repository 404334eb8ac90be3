"""The steps of a job as temporary views, to be looked at or queried in SQL.

A view is a name for a lazy plan: nothing runs until it is queried, and a query of one step plans only that step's
part of the job. Views live in the session; ``prefix`` keeps those of several runs apart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.operators.conform import conform_all, union_feeds
from pricekit.operators.latest import latest_period
from pricekit.plans import cluster, cost


def cost_steps(feed: DataFrame, previous: DataFrame | None = None, watermark=None,
               as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """``new``: eligible rows; ``waiting``: those that only their start date keeps out; ``batch``: the latest of each key;
    ``dropped``: batch rows that may not appear in the table; ``result``: the table after the run."""
    new = cost.valid_cost_rows(feed, watermark, as_of)
    batch = cost.batch_latest(new)
    return {"new": new, "waiting": cost.valid_cost_rows(feed, watermark, as_of, effective=False), "batch": batch,
            "dropped": batch.filter(~F.coalesce(cost.keep_final(as_of), F.lit(False))),
            "result": cost.cost_latest(feed, previous, watermark, as_of)}


def cluster_steps(feeds: Mapping[str, DataFrame], emea: Sequence[str], ams: Sequence[str]) -> dict[str, DataFrame]:
    """``conformed``: the feeds in one schema; ``allowed``: canonical rows of allowed countries; ``period``: the latest of each key; ``result``."""
    allowed = cluster.union_clusters(feeds, emea, ams)
    return {"conformed": union_feeds(conform_all(feeds, with_name=True), distinct=False), "allowed": allowed,
            "period": latest_period(allowed, cluster.KEYS, "fiscal_quarter", "PATH"),
            "result": cluster.cluster_latest(feeds, emea, ams)}


def as_views(steps: Mapping[str, DataFrame], prefix: str) -> dict[str, str]:
    """Register each step as the view ``<prefix>_<step>``; returns the names by step."""
    names = {step: f"{prefix}_{step}" for step in steps}
    for step, df in steps.items():
        df.createOrReplaceTempView(names[step])
    return names
