"""Connected components and people against a plain union-find."""

import random

import pytest
from pyspark.sql import functions as F

from resalelake.operators import identity
from resalelake.operators.components import components


def by_hand(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            up[high] = low
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("shape", ["random", "path", "star", "alone", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "random": [(str(rng.randrange(300)), str(rng.randrange(300))) for _ in range(220)] + [(None, "1"), ("2", None), ("z", "z"), ("5", "6"), ("5", "6")],
        "path": [(f"{k:03}", f"{k + 1:03}") for k in range(120)],
        "star": [("m", f"{k:03}") for k in range(200)],
        "alone": [("a", "a")],
        "empty": [],
    }[shape]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "x string, y string"), "x", "y").collect()
    assert {r.node: r.component for r in found} == by_hand(edges) and len(found) == len(by_hand(edges))


def test_people(spark):
    rows = [("1", "ann", None), (None, "ann", "p1"), ("2", None, "p1"), ("3", "bob", ""), ("", " ", None), (None, "cy", None), (None, None, None)]
    found = identity.people(spark.createDataFrame(rows, "id string, name string, paper string"), {k: F.trim(k) for k in ("id", "name", "paper")})
    assert {r.key: r.person_id for r in found.collect()} == {
        "id:1": "id:1", "name:ann": "id:1", "paper:p1": "id:1", "id:2": "id:1", "id:3": "id:3", "name:bob": "id:3", "name:cy": "name:cy",
    }
