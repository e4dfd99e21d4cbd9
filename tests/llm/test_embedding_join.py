"""The range join's pivots: all links found for any number of them, and work that grows slower than the square."""

import math

import numpy as np

from corpusmill.llm.embedding_join import Forest, cells, chosen_directions, chosen_pivots, heads, near_duplicates, slack, unit

RADIUS = math.sqrt(2 - 2 * 0.95) + 1e-9


def clustered(n, rng, dims=16):
    centres = rng.normal(size=(n // 20, dims))
    return unit(centres[rng.integers(0, len(centres), n)] + 0.05 * rng.normal(size=(n, dims)))


def test_links_share_a_cell():
    rng = np.random.default_rng(0)
    x = np.concatenate([clustered(400, rng, 4), unit(rng.normal(size=(400, 4)))])
    near = x @ x.T >= 0.95
    for n in (1, 4, 16, 64):
        home, sent = cells(x, x[:n], RADIUS)
        assert all(sent[i, home[j]] for i, j in zip(*np.nonzero(near)))


def test_pivots_follow_the_data():
    rng = np.random.default_rng(1)
    work = []
    for n in (4000, 16_000):
        x = clustered(n, rng)
        p = chosen_pivots(x, n, RADIUS)
        home, sent = cells(x, p, RADIUS)
        work.append(float((sent @ np.bincount(home, minlength=len(p)).astype(float)).sum()))
        assert len(p) >= 64 and sent.sum(1).mean() <= 24
    # four times the vectors: comparisons far from sixteen times as many
    assert work[1] < 7 * work[0] < 7 * 4000**2 / 8, work
    # without clusters all cells would be near
    assert len(chosen_pivots(unit(rng.normal(size=(3000, 64))), 3000, RADIUS)) <= 4


def test_heads_lose_no_link_and_part_most_pairs():
    """Vectors without clusters are compared by far less than all their coordinates, and no link is lost by that."""
    rng = np.random.default_rng(3)
    x = unit(rng.normal(size=(3000, 64)))
    x[1500:] = unit(x[:1500] + 0.04 * rng.normal(size=(1500, 64)))
    along = chosen_directions(x, 0.95)
    assert along is not None and along.shape[1] <= 32
    h = heads(x, along)
    met, near = h @ h.T >= 0.95 - slack(64), x @ x.T >= 0.95
    assert near.sum() > 4000 and not (near & ~met).any() and (met & ~near).mean() < 0.01
    # directions of other data part fewer pairs, but lose none either
    h = heads(x, np.linalg.qr(rng.normal(size=(64, 8)))[0])
    assert not (near & ~(h @ h.T >= 0.95 - slack(64))).any()


def test_components_of_links_in_portions():
    forest = Forest(10)
    for a, b in (([7, 3], [8, 4]), ([8], [3]), ([1], [9])):
        forest.add(np.array(a), np.array(b))
        forest.join()
    assert forest.label.tolist() == [0, 1, 2, 3, 3, 5, 6, 3, 3, 1]


def test_equal_tiles_for_idle_cores(spark, monkeypatch):
    """One cell is cut into pairs of tiles that are tasks of their own, each pair of rows in one of them."""
    from corpusmill.llm import embedding_join

    monkeypatch.setattr(embedding_join, "SMALL_TILE", 64)
    rng = np.random.default_rng(4)
    x = unit(rng.normal(size=(2000, 64))).astype(np.float32)
    seen = []
    tables = embedding_join.saved
    monkeypatch.setattr(embedding_join, "saved", lambda df: seen.append(tables(df)) or seen[-1])
    near_duplicates(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")).collect()
    sent, sizes = (next(t for t in seen if c in t.columns) for c in ("vec", "h"))
    assert sent.count() == 2000 and sizes.count() == 1 and sizes.first().h ** 2 / 2 >= spark.sparkContext.defaultParallelism


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = clustered(3000, rng).astype(np.float32)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    u = unit(x)
    near = np.einsum("ik,jk->ij", u, u) >= 0.95
    label = np.arange(len(x))
    while True:
        new = np.where(near, label[None, :], len(x)).min(1)
        if (new == label).all():
            break
        label = new
    for tile in (8192, 100):
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(rows, tile=tile).collect()}
        assert got == {i: (int(near[i].sum()) - 1, int(label[i])) for i in range(len(x))}
