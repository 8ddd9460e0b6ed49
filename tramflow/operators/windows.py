"""Ordered-sequence operators: change detection, forward fill, row numbers, previous distinct.

All windows are partitioned (never one global partition) and use a ROWS frame
with a complete order, so ties cannot see each other and results are
deterministic.

``segmented_scan`` computes them for groups of any size.  A group is cut into
chunks by a column that never falls along the order.  Each chunk is scanned on
its own, in tasks of its own; one summary row per chunk is scanned per group; what
it carries across the chunk's border is joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tramflow.functions._cols import as_col
from tramflow.session import ensure_checkpoint_dir


def _w(partition_by: Sequence, order_by: Sequence):
    return Window.partitionBy(*partition_by).orderBy(*order_by)


def change_marker(value, partition_by: Sequence, order_by: Sequence) -> Column:
    """Previous value when it differs from the current one, else NULL."""
    w = _w(partition_by, order_by)
    prev = F.lag(as_col(value)).over(w)
    return F.when(as_col(value) != prev, prev)


def forward_fill(value, partition_by: Sequence, order_by: Sequence) -> Column:
    """Last non-NULL value up to and including the current row."""
    w = _w(partition_by, order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(as_col(value), ignorenulls=True).over(w)


def sequence_number(df: DataFrame, partition_by: Sequence, order_by: Sequence, out: str = "seq_nr") -> DataFrame:
    """1-based position inside each group."""
    return df.withColumn(out, F.row_number().over(_w(partition_by, order_by)))


_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class Number:
    """1-based position in the group."""

    def local(self, w: WindowSpec) -> dict[str, Column]:
        return {}

    def summary(self, c: Mapping[str, Column]) -> dict[str, Column]:
        return {"n": F.count(F.lit(1))}

    def carry(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        return {"before": F.coalesce(F.sum(c["n"]).over(w.rowsBetween(*_BEFORE)), F.lit(0))}

    def result(self, c: Mapping[str, Column], first: Column) -> Column:
        return c["before"] + F.col("_rn")


@dataclass(frozen=True)
class Previous:
    """The previous row's value, NULL in the group's first row (``lag``)."""

    value: str

    def local(self, w: WindowSpec) -> dict[str, Column]:
        return {"lag": F.lag(self.value).over(w)}

    def summary(self, c: Mapping[str, Column]) -> dict[str, Column]:
        return {"last": F.max_by(F.col(self.value), F.col("_rn"))}

    def carry(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        return {"border": F.lag(c["last"]).over(w)}

    def result(self, c: Mapping[str, Column], first: Column) -> Column:
        return F.when(first, c["border"]).otherwise(c["lag"])


@dataclass(frozen=True)
class LastValue:
    """The last non-NULL value up to and including the row."""

    value: str

    def local(self, w: WindowSpec) -> dict[str, Column]:
        return {"fill": F.last(self.value, ignorenulls=True).over(w.rowsBetween(*_SO_FAR))}

    def summary(self, c: Mapping[str, Column]) -> dict[str, Column]:
        return {"end": F.max_by(c["fill"], F.col("_rn"))}

    def carry(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        return {"before": F.last(c["end"], ignorenulls=True).over(w.rowsBetween(*_BEFORE))}

    def result(self, c: Mapping[str, Column], first: Column) -> Column:
        return F.coalesce(c["fill"], c["before"])


@dataclass(frozen=True)
class LastChange:
    """The value before the last change, NULL until the first one (W6): the last non-NULL
    of ``when(v != previous, previous)``.  A chunk's first row changes against the chunk before."""

    value: str

    def local(self, w: WindowSpec) -> dict[str, Column]:
        prev = F.lag(self.value).over(w)
        # windows can't nest: the marker is a column of its own, then filled
        return {"mark": F.when(F.col(self.value) != prev, prev)}

    def second(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        return {"fill": F.last(c["mark"], ignorenulls=True).over(w.rowsBetween(*_SO_FAR))}

    def summary(self, c: Mapping[str, Column]) -> dict[str, Column]:
        return {
            "start": F.min_by(F.col(self.value), F.col("_rn")),
            "last": F.max_by(F.col(self.value), F.col("_rn")),
            "end": F.max_by(c["fill"], F.col("_rn")),
        }

    def carry(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        prev = F.lag(c["last"]).over(w)
        return {"border": F.when(c["start"] != prev, prev)}

    def carry_second(self, c: Mapping[str, Column], w: WindowSpec) -> dict[str, Column]:
        return {"before": F.last(F.coalesce(c["end"], c["border"]), ignorenulls=True).over(w.rowsBetween(*_BEFORE))}

    def result(self, c: Mapping[str, Column], first: Column) -> Column:
        return F.coalesce(c["fill"], c["border"], c["before"])


Scan = Number | Previous | LastValue | LastChange


def segmented_scan(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence, split_by: Column, scans: Mapping[str, Scan]
) -> DataFrame:
    """``df`` with one column per scan, equal to the plain window over the whole group.

    ``split_by`` never falls along ``order_by`` (the hour or date of an ordering timestamp, a
    bucket of an ordering number) and cuts every group into chunks; NULL is a
    chunk of its own and must come first.  The rows are shuffled once, by group and chunk, and
    the join of the carried state reuses that partitioning.  Per group only its
    chunks' summaries, a row each, meet in one task.
    """
    # the group key as one struct: struct equality takes NULL fields as equal, so a plain
    # equi-join on the window's own partitioning brings the state back
    key = F.struct(*[F.col(c) for c in partition_by])
    rows = df.withColumn("_pk", key).withColumn("_chunk", F.struct(split_by.alias("c")))
    parts = ["_pk", "_chunk"]
    w = _w(parts, order_by)
    ws = Window.partitionBy("_pk").orderBy("_chunk")

    def named(at: int, columns: Mapping[str, Column]) -> dict[str, Column]:
        return {f"_{at}_{name}": column for name, column in columns.items()}

    class Of(dict):
        """Columns of one scan by their short names."""

        def __init__(self, at: int):
            self.at = at

        def __missing__(self, name: str) -> Column:
            return F.col(f"_{self.at}_{name}")

    each = list(enumerate(scans.values()))
    have = {"_rn": F.row_number().over(w)}
    for at, scan in each:
        have |= named(at, scan.local(w))
    rows = rows.withColumns(have)
    filled = {k: v for at, scan in each if isinstance(scan, LastChange) for k, v in named(at, scan.second(Of(at), w)).items()}
    rows = rows.withColumns(filled) if filled else rows

    sums: dict[str, Column] = {}
    for at, scan in each:
        sums |= named(at, scan.summary(Of(at)))
    summary = rows.groupBy(*parts).agg(*[c.alias(n) for n, c in sums.items()])
    carried: dict[str, Column] = {}
    for at, scan in each:
        carried |= named(at, scan.carry(Of(at), ws))
    summary = summary.withColumns(carried)
    late = {k: v for at, scan in each if isinstance(scan, LastChange) for k, v in named(at, scan.carry_second(Of(at), ws)).items()}
    summary = summary.withColumns(late) if late else summary

    out = rows.join(summary.select(*parts, *carried, *late), parts)
    first = F.col("_rn") == 1
    out = out.withColumns({name: scan.result(Of(at), first) for (at, scan), name in zip(each, scans, strict=True)})
    return out.drop(*parts, *have, *filled, *carried, *late)


def previous_distinct(
    df: DataFrame,
    value: str,
    partition_by: Sequence[str],
    order_by: Sequence,
    out: str = "prev_distinct",
    split_by: Column | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    """For each row, the value of the previous run of equal values.

    Equals ``last(when(v != lag(v), lag(v)), ignorenulls)`` over the group in
    order: NULL in the first run of each group.  With ``split_by`` a hot group is
    spread over many tasks (``segmented_scan`` of ``LastChange``); the result is the same.
    With ``split_rows`` only groups of more rows are cut and the others are scanned in one pass: where
    most chunks hold a row or two, their summaries would be as many as the rows.  A count by group finds
    which, so ``df`` is read twice and should lie in files.
    """
    if split_by is not None and split_rows is not None:
        key = F.struct(*[F.col(c) for c in partition_by])
        big = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > split_rows)
        ensure_checkpoint_dir(df.sparkSession)
        big = big.select(key.alias("_big")).checkpoint()  # one row at most for so many of the input
        if big.isEmpty():
            return previous_distinct(df, value, partition_by, order_by, out)
        rows = df.join(F.broadcast(big), key == F.col("_big"), "left")
        few, many = (rows.filter(c).drop("_big") for c in (F.col("_big").isNull(), F.col("_big").isNotNull()))
        return previous_distinct(few, value, partition_by, order_by, out).unionByName(
            previous_distinct(many, value, partition_by, order_by, out, split_by)
        )
    if split_by is not None:
        return segmented_scan(df, partition_by, order_by, split_by, {out: LastChange(value)})
    w = _w(partition_by, order_by)
    prev = F.lag(value).over(w)
    chg = F.when(F.col(value) != prev, prev)
    return df.withColumn("_chg", chg).withColumn(
        out, F.last("_chg", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("_chg")
