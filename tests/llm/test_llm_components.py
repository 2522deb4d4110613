"""Components of small graphs, one at a time: in a larger one other edges hide a stop that comes early."""

import random

import pytest

from dimflow.llm.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def tree(seed):
    """A chain (odd seeds) or a tree of up to ten nodes."""
    rng = random.Random(seed)
    n = rng.randint(4, 10)
    x = list(range(1, n + 1))
    rng.shuffle(x)
    return list(zip(x, x[1:])) if seed % 2 else [(x[i], x[rng.randrange(i)]) for i in range(1, n)]


GRAPHS = [[(4, 3), (4, 1), (5, 3), (5, 2)], *map(tree, (15, 33, 48, 61, 1, 2))]


@pytest.mark.parametrize("edges", GRAPHS)
def test_components_of_one_small_graph(spark, edges):
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == brute(edges)
