import random
import re

LONG = " ".join(f"w{i % 5003}" for i in range(120_000))

#: Columns whose names operators use themselves.
CLASH = "kept string, size string, digest string, component_id string, score string, key string, salt string, part string, rep string, target string, taken string, members string"


def odd_docs(spark, extra=()):
    """Null ids and texts, empty and blank texts, a very long one, ties and repeated rows, and clashing columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "b"), (2, "the quick brown fox jumps over the lazy dog", "a"), (3, None, None), (4, "", "a"), (5, " \t\n ", "b"),
        (6, LONG, "a"), (6, LONG, "a"), (7, "one two", None), (None, "text without an id and six more words", "a"), (8, None, "c"), (9, "Line one here\nLine one here\n\nother", "c"), *extra,
    ]
    clash = tuple("x" for _ in CLASH.split(","))
    return spark.createDataFrame([r + clash for r in rows], f"doc_id long, text string, source string, {CLASH}")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return [f"v{r.randrange(vocabulary)}" for _ in range(n)]


def components(nodes, links):
    top = {x: x for x in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
