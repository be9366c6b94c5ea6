"""Vectors of several lengths: each length is searched, copies link in all of them."""

import numpy as np

from fleetwatt.llm import embeddings
from fleetwatt.llm.queries import QUERIES
from tests.conftest import SF_DIR


def brute(rows):
    """id: (links, component), by comparing all pairs of one length."""
    good = {i: np.array(v, float) for i, v in rows if v is not None and np.isfinite(np.array(v, float)).all() and np.any(v)}
    near = {i: set() for i, _ in rows}
    for i, v in good.items():
        for j, w in good.items():
            if i != j and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.9:
                near[i].add(j)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen))
    return out


def test_every_length_is_searched(spark):
    rng = np.random.default_rng(3)
    rows, at = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [5.0]), (3, None), (4, [0.0] * 64)], 10
    for d, families in ((64, 30), (48, 8), (3, 2)):
        for _ in range(families):
            base = rng.normal(size=d)
            for k in range(4):
                rows.append((at, [float(np.float32(x)) for x in (base if k == 3 else base + rng.normal(size=d) * 0.05)]))
                at += 1
    out = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == brute(rows)


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op8_embedding_near_dedup"](spark, SF_DIR).collect()}
    want = brute(rows)
    # Recall of links; nothing below the threshold is linked.
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert all(k == (i == c) for i, (_, c, k) in got.items())
