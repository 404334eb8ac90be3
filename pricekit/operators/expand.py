"""Rule-based row expansion and dimension enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_by_rule(df: DataFrame, key_col: str, rules: Mapping[str, Sequence[str]],
                   out_col: str) -> DataFrame:
    """Each row becomes one row per value its key maps to; keys without a rule vanish.

    ``rules`` is configuration (a handful of entries), so it is inlined as a
    literal map expression: the lookup and the ``explode`` run inside the
    scan stage — no join, no broadcast, no shuffle. Rows whose key has no
    rule (or an empty list) produce no output, like ``LATERAL VIEW explode``.
    """
    pairs = []
    for key, values in rules.items():
        pairs += [F.lit(key), F.array(*[F.lit(v) for v in values]).cast("array<string>")]
    lookup = F.create_map(*pairs)
    return (df.filter(F.col(key_col).isin(*rules.keys()))
              .withColumn(out_col, F.explode(F.try_element_at(lookup, F.col(key_col)))))


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join adding ``cols`` of ``dim``; unmatched rows get NULL, duplicate
    dimension keys multiply rows (as in SQL).

    No join hint: AQE broadcasts the dimension when its runtime size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a sort-merge
    join whose skewed partitions it splits (``skewJoin``), so a hot key on
    the fact side is spread over several tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(dim.select(*keys, *cols), on=keys, how="left")
