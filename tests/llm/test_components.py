"""Steps that components take, and components that grow by further links."""

import random

from tests.conftest import rows_of
from usagelake.llm import near
from usagelake.llm.common import Scratch
from usagelake.llm.components import components


class Counted(Scratch):
    """Keeps the names of what it stores."""

    def __init__(self, spark):
        super().__init__(spark, "counted")
        self.names = []

    def store(self, df, name, codec=None):
        self.names.append(name)
        return super().store(df, name, codec)


def plain(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


def test_settled_stars_take_no_further_round(spark, frame):
    edges = [(i, i % 4) for i in range(4, 30)] * 2
    scratch = Counted(spark)
    assert dict(rows_of(components(frame("a long, b long", *edges), scratch))) == plain(edges)
    assert len(scratch.names) == 2


def test_a_round_stores_four_tables(spark, frame):
    edges = [(i, i + 1) for i in range(40)] + [(i, j) for i in range(50, 58) for j in range(50, 58)]
    scratch = Counted(spark)
    # columns in another order, and one more
    turned = frame("b long, x string, a long", *[(b, "x", a) for a, b in edges])
    assert dict(rows_of(components(turned, scratch))) == plain(edges)
    rounds = scratch.names.count("least-small")
    assert 1 <= rounds <= 6 and len(scratch.names) == 2 + 4 * rounds


def test_components_grow_by_links(spark, frame):
    rng = random.Random(8)
    found, edges = None, []
    for turn in range(4):
        more = [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(20)]
        edges += more
        found = near._joined(found, frame("a long, b long, similarity double", *[(*e, 0.9) for e in more]), Scratch(spark, f"t{turn}"))
        got = rows_of(found)
        assert dict(got) == plain(edges) and len(got) == len(dict(got))
