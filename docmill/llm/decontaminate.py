"""Benchmark decontamination by template windows, with DataFrame functions only.

A text becomes a template: numbers, units after numbers, and capitalised words
turn into typed slots, and each slot is glued to the literal word that follows
it. Punctuation is left out before that. A window is a run of WINDOW literal words with the slot types before all
but the first of them. Windows of documents and benchmark items are joined on
their hash. Where windows have slots, the values that stand in them must be
consistent along an alignment, so that a question with other numbers or names is
caught and a chance likeness isn't: see _conflict.

What is a name depends on its case. So that copies in another case are found,
there are windows of WINDOW plain words too, names and numbers included, in one
case; they count where the document's case isn't the item's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, bounded

WINDOW = 8
#: Items with fewer literal words than this can't be told from chance; those with fewer than WINDOW have one window, of all their words.
LEAST = 4
#: Benchmark windows (24 bytes each) are broadcast up to so many rows, else joined by a shuffle.
BROADCAST_ROWS = 500_000

# Units that become slots when they follow a number.
UNITS = (
    "percent mm cm m km meter meters metre metres kilometer kilometers inch inches foot feet ft yard yards mile miles "
    "mg g kg gram grams kilogram kilograms ton tons ounce ounces oz pound pounds lb lbs ml cl l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros usd eur gbp mph kmh degrees celsius fahrenheit watt watts kw kwh volts hz mb gb tb"
)
_OPEN, _CLOSE = "\u0001", "\u0002"
_GAP, _START = r"[\s\p{Z}]", r"(?<![^\s\p{Z}])"
#: Apostrophes, format characters, and a point or comma between digits; each alternative begins with a plain class, which is passed over fast.
_JOINT = r"['’‘ʼ\u00ad\u061c\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]|[.,](?<=\p{Nd}.)(?=\p{Nd})"
_NUMBER, _NAME, _UNIT = r"\p{Nd}+\p{Ll}{0,4}", r"\p{Lu}[\p{L}\p{M}]+", UNITS.replace(" ", "|")


def _bare(text: Column) -> Column:
    """The text with spaces for punctuation, symbols and controls; apostrophes, format characters and what parts a number's digits go without one."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), _JOINT, "")
    return F.regexp_replace(joined, r"[^\p{L}\p{M}\p{N}\s\p{Z}]+", " ")


def _marked(text: Column) -> Column:
    """The text in lower case without punctuation, each slot as OPEN type value CLOSE before the next word."""
    s = F.concat(_bare(text), F.lit(" "))
    s = F.regexp_replace(s, f"{_START}({_NUMBER}){_GAP}+", _OPEN + "n$1" + _CLOSE)
    s = F.regexp_replace(s, f"(?<={_CLOSE})({_UNIT}){_GAP}+", _OPEN + "u$1" + _CLOSE)
    s = F.regexp_replace(s, f"(?<![^\\s\\p{{Z}}{_CLOSE}])({_NAME}){_GAP}+", _OPEN + "p$1" + _CLOSE)
    return F.lower(s)


def _parts(s: Column) -> Column:
    return F.filter(F.split(s, _GAP + "+"), lambda w: w != "")


def _literals(bare: Column) -> Column:
    """The literal words of _marked, in one pass and without the slots."""
    slot = f"(?=[\\p{{Nd}}\\p{{Lu}}]){_START}(?:{_NUMBER}{_GAP}+(?:(?:{_UNIT}){_GAP})?|{_NAME}{_GAP})"
    return _parts(F.lower(F.regexp_replace(F.concat(bare, F.lit(" ")), slot, " ")))


def _folded(bare: Column) -> Column:
    """All words in one case; a sharp s has two letters in upper case."""
    return _parts(F.replace(F.lower(bare), F.lit("ß"), F.lit("ss")))


def _anchors(words: Column, window: int, least: int) -> Column:
    """For each window of the words: its hash, its size, and the place and hash of its two neighbouring words with the most letters."""

    def of(w: Column) -> Column:
        n = F.size(w)
        size = F.when(n < least, 0).otherwise(F.least(n, F.lit(window)))

        def made(i: Column) -> Column:
            pair = F.array_max(F.transform(F.sequence(i, i + size - 2), lambda j: F.struct((F.length(F.get(w, j)) + F.length(F.get(w, j + 1))).alias("letters"), (i - j).alias("back"))))["back"]
            return F.struct(
                F.xxhash64(F.get(w, i - pair), F.get(w, i - pair + 1)).alias("key"), (-pair).cast("int").alias("offset"), size.cast("int").alias("size"), F.xxhash64(F.slice(w, i + 1, size)).alias("hash")
            )

        return F.when(size > 1, F.transform(F.sequence(F.lit(0), n - size), made)).otherwise(F.array().cast("array<struct<key:long,offset:int,size:int,hash:long>>"))

    return _let(words, of)


def _suspects(own: DataFrame, items: DataFrame, window: int, least: int, work: Workspace) -> DataFrame:
    """Ids of documents that have the literal words of some template window in a row, or some plain window.

    No other document can have a leak; where the windows are too many to broadcast, those with the pair
    of words that some window is known by are marked. A document's neighbouring words are
    looked up in compiled code; its windows are hashed only around a pair of
    words that some window of the benchmark is known by.
    """
    found = None
    for name, words in (("literal", _literals), ("plain", _folded)):
        anchors = work.save(items.select(F.explode(_anchors(words(_bare(F.col("text"))), window, least)).alias("a")).select("a.*").distinct(), f"anchors-{name}")
        if anchors.count() > BROADCAST_ROWS:
            # Only hashes of pairs are shuffled; all windows of the documents that this marks are compared later.
            few = _let(words(_bare(F.col("text"))), lambda w: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))))
            met = own.select("doc_id", F.explode(few).alias("key")).join(anchors.select("key").distinct().hint("merge"), "key", "left_semi").select("doc_id")
            found = met if found is None else found.unionByName(met)
            continue
        anchors = F.broadcast(anchors)
        # An inner explode would have the words made once more, for a filter of empty arrays.
        pairs = own.select("doc_id", words(_bare(F.col("text"))).alias("words")).select("doc_id", "words", F.posexplode_outer("words").alias("pos", "word"))
        met = pairs.withColumn("key", F.xxhash64("word", F.get("words", F.col("pos") + 1))).join(anchors, "key")
        met = met.where((F.col("pos") >= F.col("offset")) & (F.xxhash64(F.slice("words", F.greatest(F.col("pos") - F.col("offset") + 1, F.lit(1)), F.col("size"))) == F.col("hash"))).select("doc_id")
        found = met if found is None else found.unionByName(met)
    return work.save(found.distinct(), "suspects")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body's lambdas use it."""
    return F.transform(F.array(value), body)[0]


def _tokens(marked: Column) -> Column:
    """Words that end in a literal; one that only has slots stands at the text's end."""
    return F.filter(F.split(marked, _GAP + "+"), lambda t: (t != "") & ~t.endswith(_CLOSE))


def _hashes(marked: Column) -> Column:
    """Struct of two arrays: hashes of literals alone, and of literals with the slot types before them."""

    def of(m: Column) -> Column:
        typed = F.regexp_replace(m, f"{_OPEN}(.)[^{_CLOSE}]*{_CLOSE}", f"{_OPEN}$1{_CLOSE}")
        return _let(
            _tokens(typed),
            lambda t: F.struct(
                F.transform(t, lambda w: F.xxhash64(F.substring_index(w, _CLOSE, -1))).alias("word"),
                F.transform(t, lambda w: F.xxhash64(w)).alias("full"),
            ),
        )

    return _let(marked, of)


def _windows(marked: Column, sizes: list[int], whole_below: int = 0, least: int = LEAST) -> Column:
    """Array of (pos, size, hash); with whole_below, one window of all words where there are fewer words than that."""
    empty = F.array().cast("array<struct<pos:int,size:int,hash:long>>")

    def of(x: Column, size: Column) -> Column:
        count = F.size(x["word"])
        made = F.transform(
            F.sequence(F.lit(0), count - size),
            lambda i: F.struct(i.cast("int").alias("pos"), size.cast("int").alias("size"), F.xxhash64(F.get(x["word"], i), F.slice(x["full"], i + 2, size - 1)).alias("hash")),
        )
        return F.when((size <= count) & (size > 0), made).otherwise(empty)

    if whole_below:
        return _let(_hashes(marked), lambda x: of(x, F.when(F.size(x["word"]) < least, 0).otherwise(F.least(F.size(x["word"]), F.lit(whole_below)))))
    return _let(_hashes(marked), lambda x: F.concat(*[of(x, F.lit(s)) for s in sizes]))


def _plain(text: Column) -> Column:
    """All words without punctuation, in their own case."""
    return _parts(_bare(text))


def _plain_windows(text: Column, sizes: list[int], whole_below: int = 0, least: int = LEAST) -> Column:
    """As _windows, over all words in one case; their sizes are negative, which tells them from template windows."""
    empty = F.array().cast("array<struct<pos:int,size:int,hash:long>>")

    def of(h: Column, size: Column) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.struct(i.cast("int").alias("pos"), (-size).cast("int").alias("size"), F.xxhash64(F.slice(h, i + 1, size)).alias("hash")))
        return F.when((size <= F.size(h)) & (size > 0), made).otherwise(empty)

    hashes = F.transform(_folded(_bare(text)), lambda w: F.xxhash64(w))
    if whole_below:
        return _let(hashes, lambda h: of(h, F.when(F.size(h) < least, 0).otherwise(F.least(F.size(h), F.lit(whole_below)))))
    return _let(hashes, lambda h: F.concat(*[of(h, F.lit(s)) for s in sizes]))


def _slots(tokens: Column, pos: Column, size: Column) -> Column:
    """Typed values of the slots inside a window."""
    return F.regexp_extract_all(F.array_join(F.slice(tokens, pos + 2, size - 1), " "), F.lit(f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"), F.lit(1))


def _conflict(values: Column) -> Column:
    """Whether slots contradict each other: one unit stands for two, or one name was changed to two others.

    Numbers are free, since equal ones needn't be the same quantity, and a name
    that was kept in one place says nothing against a change in another.
    """
    bound = F.filter(values, lambda v: v["a"].startswith("u") | (v["a"].startswith("p") & (v["a"] != v["b"])))
    return F.size(bound) != F.size(F.array_distinct(F.transform(bound, lambda v: v["a"])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least: int = LEAST) -> DataFrame:
    """One row per document and benchmark item that share a template window with consistent slots, or a plain window in another case.

    Returns id, item_id, windows (of the item, found), item_windows, changed
    (slots whose value differs from the item's; 0 for a literal copy), first_word
    and last_word (the literal words of the document that the match spans). Where
    only plain windows are shared, all words count, and windows are plain ones.
    Null texts count as empty and match nothing; rows with a null id on either
    side are left out. Repeated rows count once. Empty tables give an empty
    result. Other columns are ignored. Texts are read whole.

    Items with fewer than ``least`` words (2 at the least) have no window: they
    would be found in any text on their subject. Set it to 2 to have them found,
    as one window of all their words.

    Documents are neither shuffled nor collected: their pairs of words stream
    past the benchmark's, which are broadcast up to BROADCAST_ROWS, counted
    first (see _suspects). Only documents with all words of a window are marked.
    """
    work = Workspace(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col("text" if text_col not in benchmark.columns else text_col).alias("text"))
    items = items.where("item_id IS NOT NULL").distinct().withColumn("marked", _marked(F.col("text")))
    plain = items.select("item_id", _plain(F.col("text")).alias("words"), F.explode(_plain_windows(F.col("text"), [], window, least)).alias("w"))
    cased = F.array_join(F.slice("words", F.col("w.pos") + 1, -F.col("w.size")), " ")
    plain = plain.select("item_id", F.col("w.pos").alias("item_pos"), "w.size", "w.hash", F.array().cast("array<string>").alias("item_slots"), cased.alias("item_words"))
    wins = items.select("item_id", _tokens(F.col("marked")).alias("tokens"), F.explode(_windows(F.col("marked"), [], window, least)).alias("w"))
    wins = wins.select("item_id", F.col("w.pos").alias("item_pos"), "w.size", "w.hash", _slots(F.col("tokens"), F.col("w.pos"), F.col("w.size")).alias("item_slots"), F.lit(None).cast("string").alias("item_words"))
    wins = work.save(wins.unionByName(plain), "benchmark-windows")
    rows = wins.count()
    lengths = sorted(r[0] for r in wins.select("size").distinct().limit(2 * window + 2).collect())
    sizes, plain_sizes = [n for n in lengths if n > 0], [-n for n in lengths if n < 0]

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    own = own.join(bounded(_suspects(own, items, window, least, work)), "doc_id", "left_semi")
    both = [_windows(_marked(F.col("text")), sizes)] * bool(sizes) + [_plain_windows(F.col("text"), plain_sizes)] * bool(plain_sizes)
    found = own.select("doc_id", F.explode(F.concat(*both)).alias("w")).select("doc_id", F.col("w.pos").alias("pos"), "w.size", "w.hash") if both else (
        own.select("doc_id", F.lit(0).alias("pos"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("hash")).limit(0)
    )
    slim = wins.select("item_id", "item_pos", "size", "hash", (F.size("item_slots") > 0).alias("has_slots"))
    slim = F.broadcast(slim) if rows <= BROADCAST_ROWS else slim.hint("merge")
    all_hits = work.save(found.join(slim, ["hash", "size"]).select("doc_id", "item_id", "pos", "item_pos", "size", "has_slots"), "hits")
    hits = all_hits.where("size > 0")

    # Slot values, for hits that have any.
    slotted = hits.where("has_slots").drop("has_slots").distinct()
    ids = bounded(work.save(slotted.select("doc_id").distinct(), "slotted-ids"))
    texts = own.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", _tokens(_marked(F.col("text"))).alias("tokens"))
    placed = slotted.join(texts, "doc_id").select("doc_id", "item_id", "pos", "item_pos", "size", _slots(F.col("tokens"), F.col("pos"), F.col("size")).alias("slots"))
    pairs = placed.join(wins.select("item_id", "item_pos", "size", "item_slots"), ["item_id", "item_pos", "size"])
    zipped = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    filled = pairs.select("doc_id", "item_id", "pos", "item_pos", "size", zipped.alias("values"))
    plain = hits.where("NOT has_slots").drop("has_slots").distinct().withColumn("values", F.array().cast("array<struct<a:string,b:string>>"))

    every = filled.unionByName(plain).withColumn("shift", F.col("pos") - F.col("item_pos"))
    plain_pos, last = F.when(F.size("values") == 0, F.col("pos")), F.col("pos") + F.col("size") - 1
    runs = every.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set("item_pos").alias("at"), F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"), F.min("pos").alias("first"), F.max(last).alias("last"),
        F.collect_set(plain_pos - F.col("shift")).alias("plain_at"), F.min(plain_pos).alias("plain_first"), F.max(F.when(plain_pos.isNotNull(), last)).alias("plain_last"),
    )
    runs = runs.withColumn("conflict", _conflict(F.col("values"))).where("NOT conflict OR size(plain_at) > 0")
    # Of a run with a conflict, only the windows without slots count: they are verbatim, whatever stands in the slots of others.
    kept = runs.select("doc_id", "item_id", "values", *[F.when(F.col("conflict"), F.col(f"plain_{c}")).otherwise(F.col(c)).alias(c) for c in ("at", "first", "last")])
    changed = F.size(F.filter("values", lambda v: v["a"] != v["b"]))
    template = kept.withColumn("changed", changed).groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("windows"), F.min("changed").cast("long").alias("changed"),
        F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
    )
    template = work.save(template, "template-leaks")

    # Plain windows in another case than the item's, for documents that templates don't give away.
    other = work.save(all_hits.where("size < 0").drop("has_slots").distinct().join(template.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti"), "plain-hits")
    ids = bounded(work.save(other.select("doc_id").distinct(), "plain-ids"))
    texts = own.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", _plain(F.col("text")).alias("words"))
    told = other.join(wins.where("size < 0").select("item_id", "item_pos", "size", "item_words"), ["item_id", "item_pos", "size"]).join(texts, "doc_id")
    told = told.where(F.array_join(F.slice("words", F.col("pos") + 1, -F.col("size")), " ") != F.col("item_words"))
    cased = told.groupBy("doc_id", "item_id").agg(
        F.count_distinct("item_pos").alias("windows"), F.lit(0).cast("long").alias("changed"),
        F.min("pos").cast("long").alias("first_word"), F.max(F.col("pos") - F.col("size") - 1).cast("long").alias("last_word"),
    )
    totals = wins.groupBy("item_id", (F.col("size") > 0).alias("by_template")).agg(F.count("*").alias("item_windows"))
    totals = F.broadcast(totals) if rows <= BROADCAST_ROWS else totals
    out = template.withColumn("by_template", F.lit(True)).unionByName(cased.withColumn("by_template", F.lit(False)))
    return out.join(totals, ["item_id", "by_template"]).select(F.col("doc_id").alias(id_col), "item_id", "windows", "item_windows", "changed", "first_word", "last_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The rows of docs that share no window with the benchmark, with all their columns.

    A row is judged by its text, found again by a 64-bit hash; null and repeated ids make no difference.
    """
    work = Workspace(docs.sparkSession, "decontaminate-rows")
    texts = docs.select(F.xxhash64(text_col).alias(id_col), text_col)
    gone = bounded(work.save(find_leaks(texts, benchmark, window, id_col, text_col, least=least).select(F.col(id_col).alias("__text")).distinct(), "gone"))
    return docs.join(gone, F.xxhash64(docs[text_col]) == gone["__text"], "left_anti")
