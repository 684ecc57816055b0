"""Operators over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window


def carried_forward(value: str | Column, group: list[str], order: list[Column]) -> Column:
    """The last value that isn't null up to this row."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)


def between_equal_neighbours(value: str, group: list[str], order: list[Column]) -> Column:
    """The value, or for null the nearest value before if it equals the nearest after."""
    base = Window.partitionBy(*group).orderBy(*order)
    before = F.last(value, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(value, ignorenulls=True).over(base.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(F.col(value), F.when(before == after, before))


def rank_with_ties_low(order: str, group: list[str]) -> Column:
    """How many rows of the group are at or before this one; equal rows share the larger number."""
    return F.count("*").over(Window.partitionBy(*group).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))


def places(rows: DataFrame, value: str, unique: str) -> DataFrame:
    """rows with their place (from 1) in the order of value, nulls last, and then unique.

    Numbers are numbered by shares of their range (see ``numbered``). Of other
    values, the counts of distinct ones meet in one task, and rows are numbered among those of their value.
    """
    nulls = F.col(value).isNull()
    if all(isinstance(rows.schema[c].dataType, NumericType) for c in (value, unique)):
        n = rows.agg(F.count(value).alias("__n"))
        first = numbered(rows.where(~nulls), value, unique, "place")
        last = numbered(rows.where(nulls), unique, unique, "place").crossJoin(F.broadcast(n)).withColumn("place", F.col("place") + F.col("__n")).drop("__n")
        return first.unionByName(last)
    counts = rows.groupBy(value).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(nulls, value).rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(F.col(value).alias("__v"), F.coalesce(before, F.lit(0)).alias("__base"))
    within = F.row_number().over(Window.partitionBy(value).orderBy(unique))
    marked = rows.withColumn("__k", within)
    return marked.join(base, marked[value].eqNullSafe(base["__v"])).withColumn("place", (F.col("__base") + F.col("__k")).cast("long")).drop("__v", "__base", "__k")


def runs(rows: DataFrame, group: list[str], position: str) -> DataFrame:
    """Runs of neighbouring positions: start, end, length."""
    island = F.col(position) - F.row_number().over(Window.partitionBy(*group).orderBy(position))
    marked = rows.select(*group, position).distinct().withColumn("__island", island)
    return marked.groupBy(*group, "__island").agg(F.min(position).alias("start"), F.max(position).alias("end"), F.count("*").alias("length")).drop("__island")


def rises(rows: DataFrame, group: list[str], serial: str, order: list[Column]) -> DataFrame:
    """Per group: how many serials are usable (positive), and whether they rise strictly; unknown for fewer than 2."""
    usable = rows.where(F.col(serial) > 0)
    before = F.lag(serial).over(Window.partitionBy(*group).orderBy(*order))
    marked = usable.withColumn("__bad", before >= F.col(serial))
    out = marked.groupBy(*group).agg(F.count("*").alias("usable"), F.bool_or(F.coalesce("__bad", F.lit(False))).alias("__any"))
    return out.select(*group, "usable", F.when(F.col("usable") >= 2, ~F.col("__any")).alias("rising"))


def clustered(rows: DataFrame, group: list[str], value: str, gap: float) -> DataFrame:
    """Per group, clusters of sorted values; one ends where a value lies more than ``gap`` past the cluster's first.

    Nulls and NaN belong to no cluster. Equal values are counted before the
    shuffle; a task then passes over its sorted rows once, batch by batch, and holds one cluster.
    """
    v = F.col(value).cast("double")
    counted = rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*group, v.alias("__v")).agg(F.count("*").alias("__n"))
    kinds = [f"`{g}` {counted.schema[g].dataType.simpleString()}" for g in group]
    # The window leaves the rows sorted by group and value.
    ordered = counted.select(*group, "__v", "__n", (F.row_number().over(Window.partitionBy(*group).orderBy("__v")) == 1).alias("__new"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last cluster so far: its group, number, first, last, size
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.columns[: len(group)]
            first, size, new = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__v", "__n", "__new"))
            last, base = first, 0
            if held:  # it goes before the batch like a row
                base = held[1]
                first, last, size, new = np.append(held[2], first), np.append(held[3], last), np.append(held[4], size), np.append(True, new)
            starts = cluster_starts(first, last, new, gap)
            of_group = np.cumsum(new)[starts]
            fresh = np.flatnonzero(np.append(True, of_group[1:] != of_group[:-1]))
            number = np.arange(len(starts)) - fresh[np.cumsum(np.append(False, of_group[1:] != of_group[:-1]))]
            number[of_group == 1] += base
            if held:
                own = [pa.concat_arrays([h, c.take(pa.array(starts[1:] - 1))]) for h, c in zip(held[0], own)]
            else:
                own = [c.take(pa.array(starts)) for c in own]
            facts = number, first[starts], last[np.append(starts[1:], len(first)) - 1], np.add.reduceat(size, starts)
            held = ([c.slice(len(starts) - 1) for c in own], *(x[-1] for x in facts))
            yield table([c.slice(0, len(starts) - 1) for c in own], [x[:-1] for x in facts])
        if held:
            yield table(held[0], [np.array([x]) for x in held[1:]])

    def table(own: list, facts: list) -> pa.RecordBatch:
        types = pa.int32(), pa.float64(), pa.float64(), pa.int32()
        return pa.RecordBatch.from_arrays([*own, *(pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(facts, types))], names=[*group, "cluster", "first", "last", "size"])

    return ordered.mapInArrow(scan, ", ".join([*kinds, "cluster int, first double, last double, size int"]))


def cluster_starts(first: np.ndarray, last: np.ndarray, new: np.ndarray, gap: float) -> np.ndarray:
    """Where clusters start in sorted values; ``new`` marks the first of a group, and a value may stand for those from first to last.

    A step of more than ``gap`` always starts a cluster. What lies between two such steps
    is mostly no wider than ``gap``, so one cluster; only the others are gone through one by one.
    """
    step = new.copy()
    step[0] = True
    step[1:] |= first[1:] - last[:-1] > gap
    starts = np.flatnonzero(step)
    ends = np.append(starts[1:], len(first))
    more = []
    for k in np.flatnonzero(last[ends - 1] - first[starts] > gap).tolist():
        at, end = int(starts[k]), int(ends[k])
        while True:
            past = at + max(1, int(np.searchsorted(first[at:end], first[at] + gap, "right")))
            # The sum may be rounded another way than the difference that counts.
            while past < end and first[past] - first[at] <= gap:
                past += 1
            while past > at + 1 and first[past - 1] - first[at] > gap:
                past -= 1
            if past >= end:
                break
            more.append(past)
            at = past
    return np.union1d(starts, np.array(more, starts.dtype)) if more else starts


def numbered(rows: DataFrame, value: str, unique: str, name: str = "position", parts: int = 256) -> DataFrame:
    """rows with their place (from 1) in the order of a number and then unique; nulls come first.

    The range is cut at about equal shares, so no task has more than a share,
    but for rows of one value; only the counts of the shares meet in one task.
    """
    cuts = sorted(set(rows.stat.approxQuantile(value, [i / parts for i in range(1, parts)], 1 / (4 * parts))))
    share = F.coalesce(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c < F.col(value).cast("double"))), F.lit(0))
    marked = rows.withColumn("__share", F.when(F.col(value).isNull(), -1).otherwise(share))
    counts = marked.groupBy("__share").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("__share").orderBy(value, unique))
    shares = F.broadcast(counts.select("__share", before.alias("__before")))
    return marked.withColumn("__k", within).join(shares, "__share").withColumn(name, (F.col("__before") + F.col("__k")).cast("long")).drop("__share", "__before", "__k")
