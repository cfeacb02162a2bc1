"""Keyed merges: each takes a target and new rows and returns the target's next version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrail.operators.timeline import join_same


def merge_additive(target: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add the delta's measures to the target's; keys new to the target start from zero.

    Union and one groupBy: both sides are reduced before the single shuffle, NULL keys match.
    """
    cols = [*keys, *measures]
    both = target.select(*cols).unionByName(delta.select(*cols))
    return both.groupBy(*keys).agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures))


def pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = True) -> DataFrame:
    """One row per key: the last (or first) one in ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    choose = F.max_by if last else F.min_by
    best = rows.groupBy(*keys).agg(choose(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*rows.columns)


def merge_replace(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace target rows of the same key; ``new`` holds one row per key (see ``pick``)."""
    return join_same(target, new.select(*keys), keys, "left_anti").unionByName(new)


def merge_insert_if_absent(
    target: DataFrame, new: DataFrame, keys: Sequence[str], run_time, updated: str = "update_time"
) -> DataFrame:
    """Insert keys the target lacks; of keys it has, only ``update_time`` moves to ``run_time``.

    ``new`` holds one row per key. One full outer join, so each side is shuffled once; NULL keys match.
    """
    old, fresh = (df.select(F.struct(*df.columns).alias(side)) for df, side in ((target, "_old"), (new, "_new")))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}"))
    known, given = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str, kind: T.DataType) -> Column:
        inserted = F.col(f"_new.{name}") if name in new.columns else F.lit(None).cast(kind)
        kept = F.col(f"_old.{name}")
        if name == updated:
            kept = F.when(given, F.lit(run_time)).otherwise(kept)
        return F.when(known, kept).otherwise(inserted).alias(name)

    return old.join(fresh, same, "full_outer").select(*(value(f.name, f.dataType) for f in target.schema))
