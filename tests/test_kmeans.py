"""KMeans inside tasks and by distributed steps: one result; bounds save comparisons and change nothing."""
import numpy as np
import pytest

from tickwise.operators import cluster as CL
from tickwise.operators.lloyd import lloyd, seed_centers


def blobs(n, seed, p=3, k=5, apart=6.0):
    r = np.random.default_rng(seed)
    return r.normal(0, apart, (k, p))[r.integers(0, k, n)] + r.normal(0, 1, (n, p)), r.random((n, k))


def plain_lloyd(x, c, max_iter, tol):
    for it in range(1, max_iter + 1):
        label = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(len(c))])
        shift, c = ((new - c) ** 2).sum(), new
        if shift <= tol:
            break
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1), c, it


@pytest.mark.parametrize("seed, apart", [(1, 6.0), (2, 1.0), (3, 0.0)])
def test_bounds_change_nothing_and_save_comparisons(seed, apart):
    x, u = blobs(2000, seed, apart=apart)
    start = seed_centers(x, u, 5)
    label, d2, c, it, rests, compared = lloyd(x, start, 300, 1e-4)
    want = plain_lloyd(x, start, 300, 1e-4)
    assert (label == want[0]).all() and np.allclose(d2, want[1]) and np.allclose(c, want[2]) and it == want[3] and rests
    assert compared < 0.9 * it * len(x)


def test_ties_copies_and_empty_clusters():
    x = np.repeat(np.array([[0.0], [1.0]]), 6, axis=0)
    c = seed_centers(x, np.random.default_rng(0).random((12, 4)), 4)
    label, d2, centers, it, rests, _ = lloyd(x, c, 300, 1e-4)
    want = plain_lloyd(x, c, 300, 1e-4)
    assert (label == want[0]).all() and not d2.any() and rests and len(centers) == 4
    one = lloyd(x, c[:1], 300, 1e-4)
    assert (one[0] == 0).all() and one[2][0][0] == pytest.approx(0.5)


def test_both_ways_agree(spark):
    rows = []
    for g, n in (("a", 120), ("b", 90), ("c", 4), ("d", 5)):
        x, _ = blobs(n, ord(g))
        rows += [(g, i, *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "ticker string, date int, x double, y double, z double")

    def run(limit):
        labels, centers, summary = CL.kmeans(df, ["x", "y", "z"], k=5, group_rows=limit)
        return ({(r.ticker, r.date): r.cluster_label for r in labels.collect()}, {r.ticker: np.array(r.centers) for r in centers.collect()},
                {r.ticker: r for r in summary.collect()})

    here, steps, mixed = run(1000), run(0), run(100)
    for other in (steps, mixed):
        assert here[0] == other[0]
        for g in "abd":
            assert np.allclose(here[1][g], other[1][g])
            a, b = here[2][g], other[2][g]
            assert a.inertia == pytest.approx(b.inertia) and (a.sizes, a.n_iter, a.converged, a.n_rows) == (b.sizes, b.n_iter, b.converged, b.n_rows)
    assert here[2]["c"].status == "skipped" and sum(here[2]["a"].sizes) == 120
