"""How much of a table lies in the leaves that a query visits, with the query's own trees, leaves and visits."""

import inspect

import numpy as np

from vellumry.llm import rpforest

DEFAULT = {k: p.default for k, p in inspect.signature(rpforest.nearest).parameters.items()}


def visited(x, queries, visits):
    """(share of all points in visited leaves, recall of the ten nearest) on average."""
    f = rpforest.Forest(x[: DEFAULT["sample"]].astype(float), len(x), DEFAULT["trees"], DEFAULT["leaf"])
    leaves = f.leaves(x)
    share = recall = 0.0
    for i in queries:
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        best = np.argpartition(d, 10)[:10]
        seen = np.zeros(len(x), bool)
        for t, leaf in f.search(x[i].astype(float), visits):
            seen |= leaves[:, t] == leaf
        share, recall = share + seen.mean(), recall + seen[best].mean()
    return share / len(queries), recall / len(queries)


def test_share_and_recall_of_clustered_vectors():
    r = np.random.default_rng(1)
    centre = r.normal(size=(1000, 64))
    x = (centre[r.integers(1000, size=120_000)] + 0.25 * r.normal(size=(120_000, 64))).astype(np.float32)
    share, recall = visited(x, range(0, 60_000, 20_000), 400)
    assert recall > 0.98 and share < 0.1


def test_small_tables_are_read_nearly_whole():
    """Said in the README: up to some ten thousand vectors the visits reach nearly every point."""
    x = np.random.default_rng(2).normal(size=(2000, 64)).astype(np.float32)
    share, recall = visited(x, range(0, 2000, 500), DEFAULT["visits"])
    assert share > 0.9 and recall == 1.0
