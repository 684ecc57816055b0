"""Equi joins of multisets with frequent keys, over distinct rows and their numbers of copies.

Identical rows become one row with ``copies``. A pair of such rows stands for
the product of their copies, so totals over a join need no pairs at all: to a row, all
partners of its key are one row of totals. Keys with more than one in 4,096 of
a side's distinct rows are hot; there are 4,095 at most. Their rows are dealt to blocks by a
hash, and what they meet is sent to each block, so that no task gets a
key's rows together. Only ``expanded`` makes the copies into rows again.

Null keys match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import HOT_KEYS, Workspace

#: Copies are made in runs of at most so many rows.
RUN = 4096


def counted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``columns`` (nulls are equal to each other) and ``copies``, in how many rows each is."""
    return rows.groupBy(*columns).agg(F.count("*").alias("copies"))


def key_totals(left: DataFrame, right: DataFrame, key: str, measures: list[str] = ()) -> DataFrame:
    """One row for each key that isn't null, and for each side x: ``x_distinct``, ``x_rows`` and, for each measure m, ``x_m``, its sum over the rows with copies.

    A key that a side doesn't have has 0 there; nulls of a measure count as 0. Sums must fit in a long.
    """

    def side(rows: DataFrame, x: str) -> DataFrame:
        sums = [F.sum(F.coalesce(F.col(m), F.lit(0)) * F.col("copies")).alias(f"{x}_{m}") for m in measures]
        return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"{x}_distinct"), F.sum("copies").alias(f"{x}_rows"), *sums)

    both = side(left, "left").join(side(right, "right"), key, "full")
    return both.na.fill(0, [c for c in both.columns if c != key])


def _blocks(totals: DataFrame, key: str, x: str) -> DataFrame:
    """Hot keys of side x, and into how many blocks their rows go; none has more than twice one in HOT_KEYS of the side's rows."""
    every = totals.agg(F.sum(f"{x}_distinct").alias("__all"))
    share = F.ceil(F.col(f"{x}_distinct") * HOT_KEYS / F.col("__all")).cast("int")
    return totals.crossJoin(F.broadcast(every)).where(F.col(f"{x}_distinct") * HOT_KEYS > F.col("__all")).select(key, share.alias("__blocks"))


def _dealt(rows: DataFrame, hot: DataFrame, key: str, block: str) -> DataFrame:
    """rows with the block that each belongs to: by the hash of the whole row for hot keys, 0 for others."""
    own = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.coalesce("__blocks", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hot), key, "left").withColumn(block, own).drop("__blocks")


def _sent(rows: DataFrame, hot: DataFrame, key: str, block: str) -> DataFrame:
    """rows once for every block of the other side's rows of their key."""
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__blocks", F.lit(1)) - 1))
    return rows.join(F.broadcast(hot), key, "left").withColumn(block, every).drop("__blocks")


def with_partners(rows: DataFrame, totals: DataFrame, key: str, mine: str, other: str) -> DataFrame:
    """Counted rows of side ``mine`` with the columns of ``totals`` that are of side ``other``; 0 where nothing matches.

    ``totals`` should be a written table, as it is read several times.
    """
    told = [c for c in totals.columns if c.startswith(f"{other}_")]
    hot = _blocks(totals, key, mine)
    # Rows of null keys and of keys without partners stay with zeros.
    met = _dealt(rows, hot, key, "__block").join(_sent(totals.where(F.col(f"{other}_rows") > 0).select(key, *told), hot, key, "__block"), [key, "__block"], "left")
    return met.drop("__block").na.fill(0, told)


def join_rows(copies: Column, partners: Column) -> dict[str, Column]:
    """How many rows of a join contain any of a row's copies: inner, its own side's outer join and the full outer join."""
    return {"inner": copies * partners, "outer": copies * F.greatest(partners, F.lit(1))}


def join_totals(left: DataFrame, right: DataFrame, key: str, measures: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Counted rows of each side with, over the rows of a join that contain any of their copies: inner_rows, left_rows, right_rows, full_rows, and partner_m, the sum of its partners' measure m.

    Both sides need ``key``, ``copies`` and the measures. Work and shuffles follow
    the distinct rows, not the pairs. An empty side gives zeros to the other.
    """
    work = Workspace(left.sparkSession, "counted-join")
    left, right = work.save(left, "left"), work.save(right, "right")
    totals = work.save(key_totals(left, right, key, measures), "totals")

    def side(rows: DataFrame, mine: str, other: str) -> DataFrame:
        met = with_partners(rows, totals, key, mine, other)
        n = join_rows(F.col("copies"), F.col(f"{other}_rows"))
        sums = [(F.col("copies") * F.col(f"{other}_{m}")).alias(f"partner_{m}") for m in measures]
        return met.select(*rows.columns, n["inner"].alias("inner_rows"), n["outer"].alias(f"{mine}_rows"), n["inner"].alias(f"{other}_rows"), n["outer"].alias("full_rows"), *sums)

    return side(left, "left", "right"), side(right, "right", "left")


def join_pairs(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Pairs of counted rows with equal keys: key, the other columns of left, those of right, and copies, the product of theirs.

    ``how`` is inner, left, right or full; rows of an outer side without a
    partner come with nulls for the other. Column names other than the key and copies must
    differ. A hot key's rows of both sides are cut into blocks, and every two
    blocks meet in a task of their own; all pairs are made, as they are the result.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how must be inner, left, right or full, not {how}")
    clash = (set(left.columns) & set(right.columns)) - {key, "copies"}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    work = Workspace(left.sparkSession, "counted-pairs")
    left, right = work.save(left, "left"), work.save(right, "right")
    totals = work.save(key_totals(left, right, key), "totals")
    hot_l, hot_r = _blocks(totals, key, "left"), _blocks(totals, key, "right")
    mine = [c for c in left.columns if c not in (key, "copies")], [c for c in right.columns if c not in (key, "copies")]
    l = _sent(_dealt(left.withColumnRenamed("copies", "__l"), hot_l, key, "__bl"), hot_r, key, "__br")
    r = _sent(_dealt(right.withColumnRenamed("copies", "__r"), hot_r, key, "__br"), hot_l, key, "__bl")
    out = l.join(r, [key, "__bl", "__br"]).select(key, *mine[0], *mine[1], (F.col("__l") * F.col("__r")).alias("copies"))
    for rows, own, other, sides in ((left, "left", "right", ("left", "full")), (right, "right", "left", ("right", "full"))):
        if how in sides:
            alone = with_partners(rows, totals, key, own, other).where(F.col(f"{other}_rows") == 0).select(*rows.columns)
            out = out.unionByName(alone, allowMissingColumns=True)
    return out


def expanded(rows: DataFrame) -> DataFrame:
    """Every row as often as its ``copies`` say, without that column; the copies of one row come from many tasks only if there are other rows."""
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN)))
    long = rows.where(F.col("copies") > 0).withColumn("__run", runs)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("copies") - F.col("__run") * RUN)))
    return long.withColumn("__copy", each).drop("copies", "__run", "__copy")
