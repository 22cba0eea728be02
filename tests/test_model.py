"""Split counts of the fitted trees against a walk over the trees' text."""
import random
import re
from collections import Counter

import pytest

from vigil.operators import model as mdl


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((int(a + 0.5 * b + 0.2 * rng.random() > 0.8), a if i % 7 else None, b, c, 1.0))
    df = spark.createDataFrame(rows, "label int, a double, b double, c double, same double")
    return mdl.train(df, ["a", "b", "c", "same"], trees=5, depth=4)


def test_split_counts_are_those_of_the_trees(fitted):
    names = ["a", "b", "c", "same", "a_missing", "b_missing", "c_missing", "same_missing"]
    walked = Counter(names[int(k)] for k in re.findall(r"If \(feature (\d+) ", fitted.stages[-1].toDebugString))
    got = [(r.feature, r.splits) for r in mdl.split_counts(fitted, ["a", "b", "c", "same"]).collect()]
    assert got == sorted(walked.items(), key=lambda x: (-x[1], x[0])) and sum(walked.values()) > 20
    assert "same" not in dict(got)
    assert [(r.feature, r.splits) for r in mdl.split_counts(fitted, ["a", "b", "c", "same"], top=2).collect()] == got[:2]


def test_nodes_have_the_gains_and_trees(fitted):
    nodes = mdl.tree_nodes(fitted).collect()
    assert {r.tree for r in nodes} == set(range(5)) and all(r.gain > 0 for r in nodes)
    assert len({(r.tree, r.node) for r in nodes}) == len(nodes)
