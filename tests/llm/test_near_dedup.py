"""Parts of near-duplicate detection: components, likelihood, cells."""

import random

import numpy as np

from linefold.llm import near_dedup


def roots_of(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1400)]
    star = [(i, 2000) for i in range(1900, 2100)]
    loose = [(rnd.randrange(3000, 3300), rnd.randrange(3000, 3300)) for _ in range(200)]
    links = [x for x in chain + star + loose if x[0] != x[1]]
    df = spark.createDataFrame(links + [(5, 5)], "a long, b long")
    got = near_dedup.components(df).collect()
    assert {r["id"]: r["component"] for r in got} == roots_of(links) and len(got) == len(roots_of(links))
    assert near_dedup.components(df.where("a = b")).count() == 0


def test_likelihood_peaks_where_a_grid_says():
    rnd = np.random.default_rng(3)
    m = near_dedup.REGISTERS
    for _ in range(30):
        na, nb = rnd.integers(50, 400, 2)
        equal = int(rnd.integers(40, m))
        higher = int(rnd.integers(0, m - equal + 1))
        grid = np.linspace(0, min(na, nb) / max(na, nb), 2001)[:-1]
        u, v = na / (na + nb), nb / (na + nb)
        p = lambda x: -np.log(1 - np.maximum(x, 1e-12) * (near_dedup.BASE - 1) / near_dedup.BASE) / np.log(near_dedup.BASE)
        ll = higher * np.log(p(u - v * grid)) + (m - equal - higher) * np.log(p(v - u * grid)) + equal * np.log(1 - p(u - v * grid) - p(v - u * grid))
        est = near_dedup.likelihood_estimate(equal, higher, m - equal - higher, na, nb)
        assert abs(est - grid[ll.argmax()]) < 0.002
        ok = near_dedup.likely(equal, higher, m - equal - higher, na, nb, 0.6)
        assert ok == (est >= 0.6 and min(na, nb) / max(na, nb) >= 0.85)


def test_estimates_of_pairs_at_the_threshold():
    rnd = np.random.default_rng(9)
    missed = 0
    for _ in range(200):
        x = rnd.integers(0, 2**64, 200, np.uint64)
        same = x[:180]
        y = np.concatenate([same, rnd.integers(0, 2**64, 11, np.uint64)])  # 180 of 211
        a, b = near_dedup.registers([np.unique(x), np.unique(y)])
        missed += not near_dedup.likely((a == b).sum(), (a > b).sum(), (a < b).sum(), 200, 191)
    assert missed == 0


def test_hot_bucket_spread_over_cells(spark, monkeypatch):
    """Copies of a template that are linked through one another only, many to a bucket."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(260):
        w = list(base)
        for _ in range(rnd.choice([2, 3, 5])):
            w[rnd.randrange(90)] = f"x{rnd.randrange(4)}"
        rows.append((i, " ".join(w)))
    from tests.llm.test_operators import docs_of, plain_components

    monkeypatch.setattr(near_dedup, "BLOCK", 24)
    rows_out = near_dedup.near_duplicates(docs_of(spark, rows)).collect()
    got = {r["doc_id"]: r["component_id"] for r in rows_out}
    assert len(rows_out) == len(rows) and got == {i: c for i, (_, c) in plain_components(rows).items()}
