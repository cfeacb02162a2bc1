"""Rows of a timeline and their neighbours, for timelines of any length.

A timeline is every row that shares ``keys``, in the order of ``(time, seq)``; ``seq`` is unique
within the timeline. Where rows arrive in batches, ``batch`` orders before time. Every timeline is cut into cells of
``span`` seconds: rows shuffle on (keys, cell), so one key that holds a large share of the log is spread like the others,
and nothing has to be counted first. Within a cell neighbours are plain window functions; the few rows at a cell's
borders, or that lack a value from an earlier cell, are shuffled once more by the keys alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SPAN = 3600
CELL = "_cell"


@dataclass(frozen=True)
class Timeline:
    keys: tuple[str, ...]
    time: str = "epoch_s"
    seq: str = "seq"
    batch: str | None = None
    span: int = SPAN

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, self.seq) if self.batch is None else (self.batch, self.time, self.seq)

    @property
    def position(self) -> Column:
        return F.struct(*self.order)

    def celled(self, df: DataFrame) -> DataFrame:
        """With the number of each row's cell."""
        return df.withColumn(CELL, F.floor(F.col(self.time) / F.lit(self.span)))

    def inside(self) -> WindowSpec:
        """The rows of a cell in order."""
        return Window.partitionBy(*self.keys, *self.order[:-2], CELL).orderBy(*self.order)

    def across(self) -> WindowSpec:
        """The rows of the whole timeline in order; for frames that hold a few rows of each cell."""
        return Window.partitionBy(*self.keys).orderBy(*self.order)


@dataclass(frozen=True)
class Carry:
    """A column ``name`` with ``value`` of the latest row so far (this one included) that ``marks`` holds for.

    ``marks`` may use the neighbours asked for; ``known`` holds for rows that are marked whatever stands before them.
    The column is right where ``need`` (which may look at the next row), and unset or right elsewhere.
    """

    name: str
    value: Column
    marks: Column
    need: Column
    known: Column


def join_same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, cond, how).drop(*(f"_r_{c}" for c in cols))


def neighbours(
    df: DataFrame,
    line: Timeline,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    carry: Carry | None = None,
) -> DataFrame:
    """Add columns of the previous (``lag``) and next (``lead``) row: ``{new: source}``.

    A cell's first row follows the last of the cell before it, so among border rows alone neighbours are the same.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    w, first, last = line.inside(), F.col("_first"), F.col("_last")
    out = {new: F.lag(c).over(w) for new, c in lag.items()} | {new: F.lead(c).over(w) for new, c in lead.items()}
    edge = {"_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull()}
    marked, border = line.celled(df).withColumns(out | edge), first | last
    if carry:
        # a first row's own mark may depend on the row before it, and is looked at across cells
        sure = F.when(F.when(first, carry.known).otherwise(carry.marks), carry.value)
        marked = marked.withColumn(carry.name, F.last(sure, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        border = border | (F.coalesce(carry.need, F.lit(False)) & F.col(carry.name).isNull())
    w = line.across()
    stitched = {n: F.when(first, F.lag(c).over(w)).otherwise(F.col(n)) for n, c in lag.items()}
    stitched |= {n: F.when(last, F.lead(c).over(w)).otherwise(F.col(n)) for n, c in lead.items()}
    few = marked.where(border).withColumns(stitched)
    if carry:
        own = F.coalesce(F.when(last, F.col(carry.name)), F.when(first & carry.marks, carry.value))
        so_far = F.last(own, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        few = few.withColumn(carry.name, F.coalesce(carry.name, so_far))
    return marked.where(~border).unionByName(few).drop("_first", "_last", CELL)
