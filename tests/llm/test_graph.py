import random

from docmill.llm.graph import connected_components
from docmill.llm.workspace import Workspace

from .helpers import components


def test_against_union_find(spark):
    r = random.Random(0)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(50)] + [(5, 5), (None, 3)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "test")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = components({x for l in real for x in l}, real)
    assert got == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).count() == 0
