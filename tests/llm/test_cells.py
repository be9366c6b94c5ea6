"""Near-duplicate vectors in cells: what is sent, what is counted, and what is found."""

import numpy as np
import pytest

from fleetwatt.llm import embeddings


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def family(n, near, noise, dim=64, seed=4):
    """n vectors, `near` of them about one centre."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[:near] = rng.normal(size=dim) + rng.normal(size=(near, dim)) * noise
    return rng.permutation(x).astype(np.float32)


def cosines(raw):
    x = unit(raw.astype(np.float64))
    cos = x @ x.T
    np.fill_diagonal(cos, 0)
    return cos


def blocks(raw, search, cells, ids=None):
    """Links of all cells together, and the roots named."""
    ids, links, edges = np.arange(len(raw)) if ids is None else ids, {}, []
    for cell in np.unique(cells):
        m = (cells == cell).any(axis=1)
        out = embeddings.Block(int(cell), ids[m], np.ones(m.sum(), np.int64), None, raw[m], cells[m], search, embeddings.THRESHOLD).out()
        for i, k, r in zip(*(c.to_pylist() for c in out.columns)):
            links[i] = links.get(i, 0) + k
            edges.append((i, r))
    return links, edges


@pytest.mark.parametrize("noise", [0.1, 0.35])
def test_a_pair_counts_once_in_all_cells_and_tables(noise, monkeypatch):
    """Sparse and dense buckets; cells of few rows are compared whole, others by tables."""
    monkeypatch.setattr(embeddings, "PLAIN", 500)
    raw = family(4000, 700, noise)
    x = unit(raw.astype(np.float64))
    search = embeddings.fit(x, 200000, embeddings.THRESHOLD)
    cells = search.cells((x - search.mean) @ search.projection)
    assert cells.shape[1] == embeddings.CELLS * len(search.turns) and len(np.unique(cells)) > 10
    near = cosines(raw) >= embeddings.THRESHOLD
    links, edges = blocks(raw, search, cells)
    assert all(k <= near[i].sum() for i, k in links.items())
    assert sum(links.values()) >= 0.999 * near.sum() > 0
    # The roots hold together what is near.
    root = np.arange(len(raw))
    for _ in range(20):
        for i, r in edges:
            root[i] = root[r] = min(root[i], root[r])
    large = np.flatnonzero(near.sum(axis=1) > 5)
    assert len(set(root[large])) == 1


@pytest.mark.parametrize("n", [51000, 3_000_000, 80_000_000])
def test_the_pairs_at_the_threshold_share_a_cell_at_any_size(n):
    rng = np.random.default_rng(8)
    x, u = rng.normal(size=(2, 20000, 64))
    x = unit(x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * unit(u - (u * x).sum(axis=1, keepdims=True) * x)
    search = embeddings.fit(x[: embeddings.FIT_VECTORS], n, 0.9)
    a, b = ((v - search.mean) @ search.projection for v in (x, y))
    shared = (search.cells(a)[:, :, None] == search.cells(b)[:, None, :]).any(axis=(1, 2))
    met = np.zeros(len(x), bool)
    for (p, p_mask), (q, q_mask) in zip(embeddings._tables(a, search.widths), embeddings._tables(b, search.widths)):
        met |= ((p ^ q) & ~(p_mask | q_mask)) == 0
    met &= np.bitwise_count(embeddings._signs(a) ^ embeddings._signs(b)) <= search.apart
    assert (shared & met).mean() >= 0.998
    # Cells are as many as the vectors need: a block holds any of them.
    count = np.unique(search.cells(a)[:, : embeddings.CELLS]).size
    assert embeddings.CELLS * n / (2 * search.axes) ** len(search.turns[0]) <= embeddings.BLOCK and count > 10


def test_vectors_without_directions():
    """Two axes give no cells; all rows are one cell, and all is found."""
    raw = np.random.default_rng(2).normal(size=(3000, 2)).astype(np.float32)
    x = unit(raw.astype(np.float64))
    search = embeddings.fit(x, 10**6, 0.9)
    cells = search.cells((x - search.mean) @ search.projection)
    assert cells.shape == (3000, 1)
    near = cosines(raw) >= 0.9
    links, _ = blocks(raw, search, cells)
    assert sum(links.values()) >= 0.998 * near.sum()


def test_what_is_sent_stays_under_the_limit(spark, monkeypatch, tmp_path):
    """Four times the input: the rows of all tables with their vectors were 40 times the input."""
    n = 9000
    raw = family(n, 300, 0.2)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id bigint, embedding array<float>")
    sent, stored = [], embeddings.stored

    def counted(df, label):
        out = stored(df, label)
        if label in ("vectors", "links"):
            sent.append((label, df))
        return out

    monkeypatch.setattr(embeddings, "stored", counted)
    monkeypatch.setattr(embeddings, "AT_ONCE", 1)
    rows, linked = [], embeddings._linked

    def turn(keyed, sizes, search, threshold, tables, at, turns):
        chosen = keyed.select("cells").toArrow().column("cells").to_pylist()
        rows.append((search, tables, at, turns, len(chosen)))
        return linked(keyed, sizes, search, threshold, tables, at, turns)

    monkeypatch.setattr(embeddings, "_linked", turn)
    out = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table).collect()}
    near = cosines(raw) >= embeddings.THRESHOLD
    assert all(out[i] <= near[i].sum() for i in out) and sum(out.values()) >= 0.999 * near.sum()
    search, tables, _, turns, count = rows[0]
    assert count == n and len(tables) == 1 and turns > 1 and len(rows) == turns * max(1, len(search.turns))
    row = 4 * (64 + embeddings.CELLS * max(1, len(search.turns))) + 64
    assert n * embeddings.CELLS * row / turns <= 2.2 * n * 4 * 64
    assert [label for label, _ in sent].count("links") == len(rows)


def test_cut_cells_give_the_same(spark, monkeypatch):
    raw = family(5000, 400, 0.2)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id bigint, embedding array<float>")
    near = cosines(raw) >= embeddings.THRESHOLD
    monkeypatch.setattr(embeddings, "BLOCK", 1500)
    out = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(table).collect()}
    assert {i: k for i, (k, _) in out.items()} == dict(enumerate(near.sum(axis=1).tolist()))
    large = np.flatnonzero(near.sum(axis=1) > 5)
    assert {out[i][1] for i in large} == {large.min()}
