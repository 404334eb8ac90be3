"""Top-1 per key, latest period per key and merging of a batch into a table.

Design notes (scale):

* ``latest_per_key`` is ``row_number() = 1`` over a window that
  Catalyst plans as a *partial* ``WindowGroupLimit`` before the shuffle and
  a final one after it: every map task keeps only its best row per key, so
  a key holding a third of all rows is cut down to one row per input
  partition before anything moves, and the sort + limit run in generated code.
* Rows go by the declared order, then the tie-break (descending), then every
  other column (descending), so the chosen row is fully determined even when
  the caller's order has ties; NULL sorts last for descending and first for
  ascending. Columns that have no order (maps, variants) are refused unless
  the caller declares order and tie-break total.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = Sequence[str | tuple[str, str]]

_BEST = "__pricekit_best"


def _order_spec(order: Order) -> list[tuple[str, bool]]:
    spec = []
    for item in order:
        if isinstance(item, str):
            spec.append((item, True))
        else:
            name, direction = item
            spec.append((name, direction.lower() == "desc"))
    return spec


def _ranking_struct(df: DataFrame, keys: Sequence[str], order: Order,
                    tie_break: Sequence[str]) -> Column:
    """struct(order fields, tie-break fields, every non-key column)."""
    spec = _order_spec(order)
    fields = [F.col(name).alias(f"__o{i}") for i, (name, _) in enumerate(spec)]
    fields += [F.col(name).alias(f"__t{i}") for i, name in enumerate(tie_break)]
    fields += [F.col(c) for c in df.columns if c not in keys]
    return F.struct(*fields)


def _unpack(df: DataFrame, keys: Sequence[str], columns: Sequence[str], best: str = _BEST) -> DataFrame:
    return df.select(*[F.col(c) if c in keys else F.col(f"{best}.{c}").alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Order,
                   tie_break: Sequence[str] = (), total: bool = False) -> DataFrame:
    """One row per ``keys``: the first by ``order``, then ``tie_break`` and the other columns, both descending.

    ``order`` items are column names (descending) or ``(name, "asc"|"desc")``.
    ``total=True`` declares that order and tie-break leave no ties, so that
    columns without an order may be present.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    bad = [c for c in rest if not _orderable(df.schema[c].dataType)]
    if bad and not total:
        raise ValueError(f"columns without an order can't break ties: {bad}; declare the order total")
    w = Window.partitionBy(*keys).orderBy(
        *[F.col(n).desc() if d else F.col(n).asc() for n, d in _order_spec(order)],
        *[F.col(t).desc() for t in tie_break],
        *[F.col(c).desc() for c in rest if c not in bad])
    rn = "__pricekit_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def dedupe_keys(df: DataFrame, keys: Sequence[str], order: Order = ()) -> DataFrame:
    """Keep one row per key subset; which one is fixed by ``order`` then by all columns."""
    return latest_per_key(df, keys, order)


def merge_latest(new: DataFrame, previous: DataFrame | None, keys: Sequence[str],
                 order: Order, tie_break: Sequence[str] = (),
                 keep: Column | None = None, method: str = "window",
                 stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Top-1 per key of ``new``, merged with ``previous``, top-1 again.

    Equivalent to::

        batch  = latest_per_key(new, keys, order, tie_break)
        merged = latest_per_key((batch ∪ previous).filter(keep), keys, order, tie_break)

    ``keep`` is applied after the batch winner is chosen, so a batch winner
    failing it hides the batch's runner-up (the previous row, if any, wins).
    ``previous`` is aligned to ``new``'s columns by name and type.

    ``method="window"``: one aggregation with the greatest row of the batch and
    the greatest previous one of each key, reduced map-side, so batch and
    previous rows are shuffled once; without ``previous`` the window of
    :func:`latest_per_key`.

    ``method="join"`` requires ``previous`` to hold at most one row per key
    (it is this function's own earlier output): batch winners and previous
    rows meet in a one-to-one full outer join on the keys and the greater of
    the two survives. When ``previous`` is a table bucketed by ``keys``, the
    join reuses its bucketing and only the batch is shuffled — the target is
    never re-shuffled, however large it grows. Rows with a NULL key part
    (which an equi-join cannot match) go through the window form; ``stage``
    writes the batch winners once, as both branches read them.
    """
    keys = list(keys)
    spec = _order_spec(order)
    if {d for _, d in spec} - {True}:
        raise ValueError("merge_latest supports descending orders only")
    keep = F.lit(True) if keep is None else keep
    cols = new.columns
    if method == "window":
        if previous is None:
            return latest_per_key(new, keys, order, tie_break).filter(F.coalesce(keep, F.lit(False)))
        return _merge_by_max(new, previous, keys, order, tie_break, keep)
    if method == "join":
        return _merge_by_join(new, previous, keys, order, tie_break, keep, stage)
    raise ValueError(f"unknown method {method!r}")


def _merge_by_max(new: DataFrame, previous: DataFrame, keys: list[str], order: Order,
                  tie_break: Sequence[str], keep: Column) -> DataFrame:
    cols, types = new.columns, dict(new.dtypes)
    rest = [c for c in cols if c not in keys]
    bad = [c for c in rest if not _orderable(new.schema[c].dataType)]
    if bad:
        raise ValueError(f"columns without an order can't break ties: {bad}")
    kept = F.coalesce(keep, F.lit(False))
    prev = previous.select(*[F.col(c).cast(types[c]).alias(c) for c in cols]).filter(kept)
    # null is the smallest value of a struct's field, as it is the last one of a descending order
    ranked = dict.fromkeys([*[name for name, _ in _order_spec(order)], *tie_break, *rest])
    row = F.struct(*[F.col(c) for c in ranked], kept.alias("__kept"))
    both = (new.select(*keys, row.alias("__b"), F.lit(None).cast("void").alias("__p"))
            .unionByName(prev.select(*keys, F.lit(None).cast("void").alias("__b"), row.alias("__p"))))
    best = both.groupBy(*keys).agg(F.max("__b").alias("__b"), F.max("__p").alias("__p"))
    # the batch's row counts only if it may be kept; one that may not hides the batch's other rows
    best = best.select(*keys, F.greatest(F.when(F.col("__b.__kept"), F.col("__b")), F.col("__p")).alias(_BEST))
    return _unpack(best.filter(F.col(_BEST).isNotNull()), keys, cols)


def _merge_by_join(new: DataFrame, previous: DataFrame | None, keys: list[str], order: Order,
                   tie_break: Sequence[str], keep: Column,
                   stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    cols = new.columns
    kept = F.coalesce(keep, F.lit(False))
    batch = latest_per_key(new, keys, order, tie_break).filter(kept)
    if previous is None:
        return batch
    if stage is not None:
        batch = stage(batch)
    types = dict(new.dtypes)
    prev = previous.select(*[F.col(c).cast(types[c]).alias(c) for c in cols]).filter(kept)
    bad = [c for c in cols if c not in keys and not _orderable(new.schema[c].dataType)]
    if bad:
        raise ValueError(f"method='join' needs orderable columns; not orderable: {bad}")
    full_key = F.lit(True)
    for k in keys:
        full_key = full_key & F.col(k).isNotNull()
    b = batch.filter(full_key)
    p = prev.filter(full_key)
    joined = (b.select(*keys, _ranking_struct(b, keys, order, tie_break).alias("__b"))
              .join(p.select(*keys, _ranking_struct(p, keys, order, tie_break).alias("__p")),
                    on=keys, how="full_outer"))
    best = joined.select(*keys, F.greatest(F.col("__b"), F.col("__p")).alias(_BEST))
    merged = _unpack(best, keys, cols)
    null_keyed = batch.filter(~full_key).unionByName(prev.filter(~full_key))
    return merged.unionByName(latest_per_key(null_keyed, keys, order, tie_break))


def latest_period(df: DataFrame, keys: Sequence[str], period: str, value: str,
                  out: str = "latest_period") -> DataFrame:
    """Per key, the greatest ``period`` among rows with a non-null ``value``.

    When no row of the key has a value, the greatest period of the key is
    taken. Rows with a NULL period never count. One row per key.
    """
    with_value = F.when(F.col(value).isNotNull(), F.col(period))
    return (df.groupBy(*keys)
            .agg(F.coalesce(F.max(with_value), F.max(period)).alias(out)))


def rows_of_latest_period(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Rows of ``df`` that lie in their key's latest period (see ``latest_period``).

    The per-key period comes from a partial aggregation (small: one row per
    key) and is matched back with a null-safe semi join on (keys, period).
    Unlike a per-key window, no task has to hold a whole key: AQE splits a
    skewed partition of the semi join across tasks.
    """
    marker = "__pricekit_lp"
    periods = latest_period(df, keys, period, value, out=marker)
    cond = [df[k].eqNullSafe(periods[k]) for k in keys] + [df[period] == periods[marker]]
    return df.join(periods, on=cond, how="left_semi")


def latest_row(period: str, value: str, fields: Sequence[str]) -> Column:
    """Aggregate: the row of the key's latest period, as ``struct(period, fields...)``.

    The latest period is the one of ``latest_period``. Inside it, rows with a
    non-null ``value`` come first, then the greatest ``fields`` (left to
    right, NULL last). NULL when every period of the key is NULL.

    One ``max`` over ``struct(value is not null, period, fields...)``: rows
    with a value outrank all rows without one, so the maximum lies in the
    greatest period that has a value, or — when no row has one — in the
    greatest period overall.
    """
    ranked = F.struct(F.col(value).isNotNull().alias("__has"), F.col(period).alias(period),
                      *[F.col(f).alias(f) for f in fields])
    best = F.max(F.when(F.col(period).isNotNull(), ranked))
    return F.struct(*[best[f].alias(f) for f in (period, *fields)])
