import numpy as np
import pytest

from tidemark.llm import embedding_dedup as E


def brute(rows, threshold=0.93):
    """(links, component) of every vector by comparing all with all."""
    def unit(v):
        if v is None or len(v) == 0 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    linked = [[i != j and rows[i][2] is not None and rows[i][2] == rows[j][2] and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= threshold for j in range(len(rows))] for i in range(len(rows))]
    component = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if linked[i][j] and component[j] < component[i]:
                    component[i], changed = component[j], True
    return {r[0]: (sum(linked[i]), component[i]) for i, r in enumerate(rows)}


def clusters(seed, sizes, dimensions=16, noise=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dimensions)
        for _ in range(size):
            rows.append([x.item() for x in (centre + noise * rng.standard_normal(dimensions)).astype(np.float32)])
    rows += [[x.item() for x in v.astype(np.float32)] for v in rng.standard_normal((60, dimensions))]
    return [(int(i), rows[k], int(k % 2)) for k, i in enumerate(rng.permutation(len(rows)))]


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "clash") for r in rows], f"vec_id long, embedding array<{kind}>, label int, component string").repartition(3)


def answers(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("block", [512, 8])
def test_equals_brute_force(spark, block):
    """With small blocks, components are counted by their core and in tiles."""
    rows = clusters(1, (40, 12, 5, 2)) + [(1000 + i, r[1], r[2]) for i, r in enumerate(clusters(1, (40,))[:10])]
    found = E.near_vectors(table(spark, rows), E.Settings(block=block))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert answers(found) == brute(rows)


def test_loose_cluster_has_members_outside_the_core(spark):
    rows = clusters(4, (60,), noise=0.28)
    expected = brute(rows)
    assert len({n for n, _ in expected.values()}) > 5  # not all linked to all
    assert answers(E.near_vectors(table(spark, rows), E.Settings(block=8, neighbours=12))) == expected


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, None, 1), (8, [], 1), (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, -0.0], 1), (12, [1e-30, 0.0], 1), (13, [3e38, 0.0], 1), (14, [1.0, 0.0], 2)]
    assert answers(E.near_vectors(table(spark, rows))) == brute(rows)
    assert answers(E.near_vectors(table(spark, [(i, v, x) for i, v, x in rows], "double"))) == brute(rows)
    assert E.near_vectors(table(spark, [])).count() == 0


def test_recall_on_random_neighbourhoods(spark):
    rows = clusters(9, [3] * 80, dimensions=32, noise=0.1)
    expected, found = brute(rows), answers(E.near_vectors(table(spark, rows)))
    links = sum(n for n, _ in expected.values())
    assert sum(found[k][0] for k in found) >= 0.95 * links and all(found[k][0] <= expected[k][0] for k in found)


def by_matrix(rows, threshold=0.93):
    """The same as ``brute`` for vectors without oddities, by one product."""
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k for _, _, k in rows])
    hit = (x @ x.T >= threshold) & (label[:, None] == label[None])
    np.fill_diagonal(hit, False)
    component = np.array([i for i, _, _ in rows])
    while True:
        least = np.minimum(component, np.where(hit, component[None], np.iinfo(np.int64).max).min(axis=1))
        if (least == component).all():
            return {i: (int(n), int(c)) for (i, _, _), n, c in zip(rows, hit.sum(axis=1), component)}
        component = least


def test_a_clump_does_not_hide_missed_links_of_small_groups(spark):
    """With a weak search, a clump's links alone would reach the target over all links; those of the pairs must be found too."""
    rng = np.random.default_rng(21)
    clump = rng.standard_normal(24) + 0.05 * rng.standard_normal((300, 24))
    pairs = np.repeat(rng.standard_normal((250, 24)), 2, axis=0)
    pairs += 0.15 * rng.standard_normal(pairs.shape)
    vectors = np.concatenate([clump, pairs]).astype(np.float32)
    rows = [(int(i), [x.item() for x in vectors[k]], 0) for k, i in enumerate(rng.permutation(len(vectors)))]
    weak = E.Settings(orders=1, bits=10, run=8, neighbours=1, local=4, taken=1)
    expected, found = by_matrix(rows), answers(E.near_vectors(table(spark, rows), weak))
    small = [i for i, (n, _) in expected.items() if 0 < n < 10]
    assert len(small) > 300 and sum(found[i] == expected[i] for i in small) >= 0.99 * len(small)


def test_recall_is_of_vectors_and_of_each_class():
    s = E.Settings()
    assert E.recall_of([10**6] * 300 + [1] * 40, [10**6] * 300 + [0] * 40, s) == 0
    assert E.recall_of([1] * 50 + [0] * 9, [1] * 50 + [0] * 9, s) == 1 and E.recall_of([], [], s) == 1
    assert E.recall_of([1] * 95 + [2] * 5, [1] * 95 + [1] * 5, s) == pytest.approx(0.975)
    assert E.orders_for(1000, s) >= s.orders and E.orders_for(10**8, s) > 2 * E.orders_for(50_000, s)


def test_a_search_that_stays_short_fails(spark, monkeypatch):
    monkeypatch.setattr(E, "in_runs", lambda own, *_: spark.createDataFrame([], "a long, b long, cosine double, out boolean"))
    monkeypatch.setattr(E, "recall_of", lambda *_: 0.5)
    with pytest.raises(RuntimeError, match="recall of 0.5"):
        E.near_vectors(table(spark, clusters(3, (5,))), E.Settings(stalled=1))


def joined_clumps(seed, clumps, size, dimensions=16):
    """Dense clumps in a row, too far apart to be linked but for one vector of each that leans to the next."""
    rng = np.random.default_rng(seed)
    axes = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0]
    step, lean, rows = np.arccos(0.93) * 1.4, np.arccos(0.93) * 0.43, []
    for c in range(clumps):
        at = lambda angle: np.cos(angle) * axes[0] + np.sin(angle) * axes[1]
        dense = at(c * step) + 0.008 * rng.standard_normal((size - 1, dimensions))
        rows += [*dense, at(c * step + (lean if c + 1 < clumps else 0))]
    return [(int(i), [x.item() for x in np.asarray(rows[k], np.float32)], 0) for k, i in enumerate(rng.permutation(len(rows)))]


def test_dense_clumps_joined_by_few_links_are_one_component(spark):
    """Every vector has far more than a list of links in its own clump."""
    rows = joined_clumps(5, 4, 400)
    expected = by_matrix(rows)
    assert len({c for _, c in expected.values()}) == 1 and len({n for n, _ in expected.values()}) > 1
    assert answers(E.near_vectors(table(spark, rows))) == expected
