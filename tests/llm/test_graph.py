import random

import pytest

from tiercast.llm.graph import components
from tiercast.operators.scratch import Scratch


def brute(edges):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in root}


def graphs():
    rnd = random.Random(1)
    yield []
    yield [(1, 1)]
    yield [(i, i + 1) for i in range(200)]
    yield [(200 - i, 199 - i) for i in range(200)] + [(7, 9), (9, 7)]
    order = list(range(150))
    rnd.shuffle(order)
    yield list(zip(order, order[1:]))
    yield [(0, i) for i in range(1, 500)] + [(1000, i) for i in range(1001, 1400)]
    yield [(500, i) for i in range(500)]
    yield [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)]


@pytest.mark.parametrize("edges", list(graphs()))
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    rows = components(frame, Scratch(spark)).collect()
    assert len(rows) == len({row.node for row in rows})
    assert {row.node: row.root for row in rows} == brute(edges)
