"""Components of chains, stars and random graphs, and how many rounds they take."""

import random

import pytest

from modelpulse.llm import components as C


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


RAND = random.Random(11)
SHAPES = {
    "ascending chain": ([(i, i + 1) for i in range(200)], 15),
    "descending chain from both ends": ([(min(i, 400 - i), min(i + 1, 399 - i) + 1000) for i in range(150)], 15),
    "star": ([(0, i) for i in range(1, 300)], 3),
    "random": ([(RAND.randrange(-500, 500), RAND.randrange(10**12)) for _ in range(40)] + [(RAND.randrange(100), RAND.randrange(100)) for _ in range(70)], 9),
    "none": ([], 0),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_components(spark, monkeypatch, shape):
    edges, most = SHAPES[shape]
    pins = []
    pin, written = C.pin, C._written
    monkeypatch.setattr(C, "pin", lambda df: pins.append(1) or pin(df))
    monkeypatch.setattr(C, "_written", lambda df: pins.append(1) or written(df))
    frame = spark.createDataFrame(edges + edges[:3], "a bigint, b bigint")
    got = {r.node: r.component for r in C.components(frame).collect()}
    assert got == {x: c for x, c in brute([e for e in edges if e[0] != e[1]]).items()}
    # One table before, and in each round the pointers, the edges and (but for the first) the labels.
    assert len(pins) <= 1 + 3 * most
