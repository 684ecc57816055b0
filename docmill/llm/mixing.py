"""Mixing of overlapping sources to target weights by min-cost flow.

Documents with the same set of sources form a pattern, and only the patterns'
totals reach the driver. Each pattern offers its words once per pass, and pass
r costs r a word (so repetition costs grow convexly). A min-cost maximum flow
routes words from patterns to the quotas of their sources. Within a pattern,
documents stand in the order of a seeded hash, and the pattern's share of the
mix takes them from the front, as often as the flow says. Only documents in the
few buckets of that order where a share ends are put in order one by one; what
becomes of all others follows from their bucket.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .workspace import Workspace, bounded

WEIGHTS, BUDGET, PASSES = (3, 1, 2), 1.5, 2
#: More distinct sets of sources than this are refused; up to it, their totals are collected and broadcast.
MAX_PATTERNS = 100_000
#: Each pattern's documents fall into 2 ** BUCKET_BITS buckets by their seeded hash.
BUCKET_BITS = 12


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of total by weight, none above ``most`` times its size; what is cut is shared again by weight."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def min_cost_flow(supply: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], passes: int) -> list[dict[int, int]]:
    """Words that each pattern sends to each of its sources.

    Pattern p can send supply[p] words per pass, at cost r a word in pass r, to
    the sources members[p]; source s takes quota[s] at most. Of all maximum
    flows one of least cost is found by the primal-dual method.
    """
    n, m = len(supply), len(quota)
    source, sink = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to: list[int] = []
    cap: list[int] = []
    cost: list[int] = []

    def arc(a: int, b: int, c: int, w: int) -> None:
        for x, y, k, v in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            cap.append(k)
            cost.append(v)

    for p in range(n):
        for r in range(passes):
            arc(source, p, supply[p], r)
    first = len(to)
    for p in range(n):
        for s in members[p]:
            arc(p, n + s, supply[p] * passes, 0)
    last = len(to)
    for s in range(m):
        arc(n + s, sink, quota[s], 0)

    while True:
        far: list[int | None] = [None] * len(graph)
        far[source], queue, inside = 0, deque([source]), {source}
        while queue:
            x = queue.popleft()
            inside.discard(x)
            for e in graph[x]:
                y, d = to[e], far[x] + cost[e]
                if cap[e] and (far[y] is None or d < far[y]):
                    far[y] = d
                    if y not in inside:
                        inside.add(y)
                        queue.append(y)
        if far[sink] is None:
            break
        # Push along cheapest paths until none is left; a node on the path isn't entered twice.
        at = [0] * len(graph)
        path: list[int] = []
        on, x = {source}, source
        while True:
            if x == sink:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                cut = next(i for i, e in enumerate(path) if not cap[e])
                for e in path[cut:]:
                    on.discard(to[e])
                x = to[path[cut] ^ 1]
                del path[cut:]
            while at[x] < len(graph[x]):
                e = graph[x][at[x]]
                if cap[e] and to[e] not in on and far[to[e]] == far[x] + cost[e]:
                    break
                at[x] += 1
            else:
                if not path:
                    break
                on.discard(x)
                x = to[path.pop() ^ 1]
                at[x] += 1
                continue
            path.append(e)
            x = to[e]
            on.add(x)

    sent: list[dict[int, int]] = [{} for _ in range(n)]
    for e in range(first, last, 2):
        if cap[e ^ 1]:
            sent[to[e ^ 1]][to[e] - n] = cap[e ^ 1]
    return sent


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _membership(docs: DataFrame, source_col: str) -> Column:
    """Sorted distinct sources of a row; null is a source."""
    if docs.schema[source_col].dataType.typeName() != "array":
        return F.array(F.col(source_col))
    return F.coalesce(F.array_sort(F.array_distinct(F.col(source_col))), F.array(F.lit(None).cast("string")))


def _pattern(members: Column) -> Column:
    return F.to_json(members)


def _mark(text: Column) -> Column:
    return F.xxhash64(text)


def _rank(doc_id: Column, mark: Column, seed: int) -> Column:
    """The place in a pattern's order; the text's hash spreads rows whose id is null or repeats."""
    return F.xxhash64(F.lit(seed), doc_id.cast("string"), mark)


def _bucket(rank: Column) -> Column:
    return F.shiftrightunsigned(rank, 64 - BUCKET_BITS) if BUCKET_BITS else F.lit(0).cast("long")


def _overlap(start: Column, end: Column, c: Column, size: Column, passes: int) -> Column:
    """Words of the stretch from start to end that fall into a cut, over all passes."""
    zero = F.lit(0).cast("long")
    return sum((F.greatest(zero, F.least(end + r * size, c["hi"]) - F.greatest(start + r * size, c["lo"])) for r in range(passes)), zero)


class _Plan:
    """What a mix does: zones per pattern (broadcast), and exact shares of the rows in buckets where a share ends."""

    def __init__(self, docs: DataFrame, weights, budget: float, passes: int, seed: int, id_col: str, text_col: str, source_col: str, work: Workspace):
        spark = docs.sparkSession
        rows = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("size"), _mark(F.col(text_col)).alias("mark"), _membership(docs, source_col).alias("members"))
        rows = rows.withColumn("pattern", _pattern(F.col("members"))).withColumn("rank", _rank(F.col("doc_id"), F.col("mark"), seed)).withColumn("bucket", _bucket(F.col("rank")))
        self.rows = work.save(rows, "rows")

        found = self.rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
        if len(found) > MAX_PATTERNS:
            raise ValueError(f"over {MAX_PATTERNS} distinct sets of sources")
        found.sort(key=lambda r: r["pattern"])
        sources = sorted({s for r in found for s in r["members"]}, key=lambda s: (s is None, s or ""))
        index = {s: i for i, s in enumerate(sources)}
        members = [[index[s] for s in r["members"]] for r in found]
        sizes = [0] * len(sources)
        for r, own in zip(found, members):
            for s in own:
                sizes[s] += r["size"]
        weight = [weights(s) if callable(weights) else weights[i % len(weights)] for i, s in enumerate(sources)]
        goal = targets(sizes, weight, budget * sum(r["size"] for r in found), passes)
        sent = min_cost_flow([r["size"] for r in found], members, [round(g) for g in goal], passes)

        # Each pattern's words in the mix, 0 to F, are cut into one stretch per source.
        table = []
        for r, own, out in zip(found, members, sent):
            lo, cuts = 0, []
            for s in own:
                cuts.append((sources[s], sizes[s], goal[s], lo, lo + out.get(s, 0)))
                lo += out.get(s, 0)
            table.append((r["pattern"], r["size"], cuts))
        plan = spark.createDataFrame(table, "pattern string, pattern_size long, cuts array<struct<source:string,source_size:long,target:double,lo:long,hi:long>>")

        sums = self.rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        placed = sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).join(F.broadcast(plan), "pattern")
        placed = placed.where("words > 0")  # others hold documents without words, of which nothing can be taken
        end = F.col("base") + F.col("words")
        # A bucket lies in a cut as a whole, in some passes, or a cut's end lies within it.
        within = F.transform("cuts", lambda c: _overlap(F.col("base"), end, c, F.col("pattern_size"), passes))
        times = F.transform(within, lambda w: F.floor(w / F.col("words")).cast("int"))
        whole = F.forall(within, lambda w: w % F.col("words") == 0)
        zones = work.save(placed.select("pattern", "bucket", "base", (~whole).alias("split"), times.alias("times")), "buckets")
        even = zones.where("NOT split").groupBy("pattern", "times").agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
        split = zones.where("split").select("pattern", F.lit(None).cast("array<int>").alias("times"), F.col("bucket").alias("first"), F.col("bucket").alias("last"))
        listed = even.unionByName(split).groupBy("pattern").agg(F.collect_list(F.struct(F.col("times").isNull().alias("split"), "first", "last", "times")).alias("zones"))
        empty = F.array().cast("array<struct<split:boolean,first:bigint,last:bigint,times:array<int>>>")
        self.zones = work.save(plan.join(F.broadcast(listed), "pattern", "left").withColumn("zones", F.coalesce("zones", empty)), "zones")

        hard = self.rows.join(F.broadcast(zones.where("split").select("pattern", "bucket", "base")), ["pattern", "bucket"])
        ordered = Window.partitionBy("pattern", "bucket").orderBy("rank", "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
        hard = hard.withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(ordered), F.lit(0))).join(F.broadcast(plan), "pattern")
        taken = F.transform("cuts", lambda c: _overlap(F.col("start"), F.col("start") + F.col("size"), c, F.col("pattern_size"), passes))
        # Rows with one id and text are told apart by their number.
        equal = F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy("start"))
        self.hard = work.save(hard.select("doc_id", "mark", equal.alias("number"), "size", "cuts", taken.alias("taken")), "split-rows")

    def zoned(self, rows: DataFrame) -> DataFrame:
        """rows (pattern, bucket) with their zone: split, times, and the pattern's cuts."""
        fits = F.filter("zones", lambda z: (F.col("bucket") >= z["first"]) & (F.col("bucket") <= z["last"]))
        none = F.struct(F.lit(False).alias("split"), F.col("bucket").alias("first"), F.col("bucket").alias("last"), F.transform("cuts", lambda c: F.lit(0)).alias("times"))
        return rows.join(F.broadcast(self.zones), "pattern").withColumn("zone", F.coalesce(F.get(fits, F.lit(0)), none))


def _shares(cuts: Column, taken: Column) -> Column:
    return F.zip_with(cuts, taken, lambda c, n: F.struct(c["source"].alias("source"), c["source_size"].alias("source_size"), c["target"].alias("target"), n.cast("long").alias("taken")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] | Callable[[str | None], float] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of docs: id, size, taken, shares.

    size is the number of words, null and blank texts having none. The source
    column is a string or an array of strings, for documents in several
    sources; null is a source like others. Sources in code point order, null
    last, have ``weights`` in turn, or what a function of the source says; they
    share ``budget`` times all words, each at most ``passes`` times its size.
    shares has source, source_size, target and taken (words counted to it) for
    each source of the document; taken sums them and is at most passes * size.
    The words that a source takes equal its rounded target wherever flow allows
    it, as it always does without overlap. The last document taken of a pattern
    may be taken in part. Equal inputs and seeds give equal results; repeated
    rows each count; a null id is ordered like an id. An empty table gives an
    empty result. Other columns are ignored.
    """
    plan = _Plan(docs, weights, budget, passes, seed, id_col, text_col, source_col, Workspace(docs.sparkSession, "mixing"))
    easy = plan.zoned(plan.rows).where("NOT zone.split")
    easy = easy.select("doc_id", "size", _shares(F.col("cuts"), F.transform("zone.times", lambda n: n * F.col("size"))).alias("shares"))
    hard = plan.hard.select("doc_id", "size", _shares(F.col("cuts"), F.col("taken")).alias("shares"))
    both = easy.unionByName(hard)
    return both.select(F.col("doc_id").alias(id_col), "size", F.aggregate("shares", F.lit(0).cast("long"), lambda a, c: a + c["taken"]).alias("taken"), "shares")


def flat(mixed: DataFrame) -> DataFrame:
    """For documents with one source each: source_size, target and taken as columns instead of shares."""
    return mixed.withColumns({"source_size": F.col("shares")[0]["source_size"], "target": F.col("shares")[0]["target"]}).drop("shares")


def take(
    docs: DataFrame,
    weights: Sequence[float] | Callable[[str | None], float] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of docs that the mix takes, for documents with one source each, with size, taken, source_size and target beside their columns.

    Columns of docs with those names give way to the mix's. Every row has the
    size of its own text and the count that mix gives a row with its id and
    text; null and repeated ids are allowed. Texts aren't shuffled, but for rows
    of buckets where a share ends.
    """
    work = Workspace(docs.sparkSession, "mixing-rows")
    plan = _Plan(docs, weights, budget, passes, seed, id_col, text_col, source_col, work)
    names = ["size", "taken", "source_size", "target"]
    cols = [c for c in docs.columns if c not in names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(id_col).alias("__id"), _mark(F.col(text_col)).alias("__mark"), F.col(text_col).alias("__text"), _pattern(_membership(docs, source_col)).alias("pattern"))
    rows = rows.withColumn("bucket", _bucket(_rank(F.col("__id"), F.col("__mark"), seed)))
    rows = plan.zoned(rows)
    facts = [F.col("cuts")[0]["source_size"].alias("source_size"), F.col("cuts")[0]["target"].alias("target")]
    easy = rows.where("NOT zone.split AND exists(zone.times, n -> n > 0)").withColumn("size", words(F.col("__text"))).where("size > 0")
    easy = easy.select("row.*", "size", (F.aggregate("zone.times", F.lit(0), lambda a, n: a + n) * F.col("size")).alias("taken"), *facts)
    counts = plan.hard.select(F.col("doc_id").alias("__key"), F.col("mark").alias("__mark"), F.col("number").alias("__number"), "size", F.aggregate("taken", F.lit(0).cast("long"), lambda a, n: a + n).alias("taken"))
    counts = bounded(work.save(counts.where("taken > 0"), "split-counts"))
    equal = F.row_number().over(Window.partitionBy("__id", "__mark").orderBy(F.to_json("row")))
    hard = rows.where("zone.split").withColumn("__number", equal)
    hard = hard.join(counts, F.col("__id").eqNullSafe(F.col("__key")) & (hard["__mark"] == counts["__mark"]) & (hard["__number"] == counts["__number"]))
    return easy.unionByName(hard.select("row.*", "size", "taken", *facts))
