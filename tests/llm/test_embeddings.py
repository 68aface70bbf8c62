"""Spherical-cap filters: recall of the plan at every size and dimension, and the query against all pairs of a table with links."""

import numpy as np
import pytest

from tidewater.llm import embed_dedup, queries
from test_pairs_and_tokens import groups


def pairs_at(dim, cosine, n, shape, seed):
    rng = np.random.default_rng(seed)
    u = rng.standard_normal((n, dim))
    if shape == "few components":
        u[:, 4:] = 0
    elif shape == "one block":
        u[:, dim // 2 :] *= 1e-3
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((n, dim))
    w -= (w * u).sum(1, keepdims=True) * u
    return u, cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w, axis=1, keepdims=True)


@pytest.mark.parametrize("dim", [2, 5, 16, 64, 256])
@pytest.mark.parametrize("count", [10**4, 10**6, 10**8])
def test_recall_at_the_limit(dim, count):
    for k, shape in enumerate(["dense", "few components", "one block"]):
        u, v = pairs_at(dim, 0.9505, 100, shape, [dim, k])
        left, right = ({*zip(i.tolist(), f.tolist())} for i, f in (embed_dedup.filters(x, embed_dedup.plan(dim, count, 0.95)) for x in (u, v)))
        assert len({i for i, _ in left & right}) >= 97, shape
        assert len(left) / 100 < 400


def table(rng):
    """Vectors with families of near copies, a family whose members link only in part, chains, copies and unlinked ones."""
    base = rng.standard_normal((30, 32))
    rows = [base[k % 30] + rng.standard_normal(32) * s for k in range(400) for s in (0.05, 0.3)]
    hub = rng.standard_normal(32)
    rows += [hub + rng.standard_normal(32) * 0.3 for _ in range(300)]
    step = rng.standard_normal((2, 32))
    rows += [np.cos(t) * step[0] + np.sin(t) * step[1] for t in np.arange(0, 3, 0.2)]
    rows += [rows[3]] * 4 + list(rng.standard_normal((500, 32)))
    return [np.round(r, 6) for r in rows]


@pytest.mark.parametrize("chunk, few", [(4096, 8), (50, 2), (7, 0)])
def test_query_on_a_table_with_links(spark, tmp_path, monkeypatch, chunk, few):
    monkeypatch.setattr(embed_dedup, "CHUNK", chunk)
    monkeypatch.setattr(embed_dedup, "STRIP", 5)
    monkeypatch.setattr(embed_dedup, "FEW", few)
    rows = table(np.random.default_rng(8))
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(rows)], "vec_id long, embedding array<double>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    v = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = (np.array(rows) @ np.array(rows).T) >= 0.95 * np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    np.fill_diagonal(near, False)
    want = groups(range(len(v)), [(int(a), int(b)) for a, b in np.argwhere(near) if a < b])
    assert near.sum() > 4000 and 1 < len({want[k] for k in range(800, 1100)}) < 300
    got = {r.vec_id: r for r in queries.QUERIES["op2_embed_dedup"](spark, str(tmp_path)).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert [got[k].n_links for k in range(len(v))] == near.sum(1).tolist()


def links_of(rows, least=0.95):
    v = np.array(rows)
    near = v @ v.T >= least * np.linalg.norm(v, axis=1)[:, None] * np.linalg.norm(v, axis=1)
    np.fill_diagonal(near, False)
    return near


def test_unlinked_vectors_around_one_centre_make_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(11)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    noise = rng.standard_normal((500, 64))
    noise -= (noise @ centre)[:, None] * centre
    rows = 0.92 * centre + np.sqrt(1 - 0.92**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    rows[400:420] = rows[:20] + 0.05 * rng.standard_normal((20, 64)) / 8
    seen, plain = [], embed_dedup._verified
    monkeypatch.setattr(embed_dedup, "_verified", lambda pairs, *more: (seen.append(pairs.count()), plain(pairs, *more))[1])
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicate_vectors(df).collect()}
    assert [got[k] for k in range(500)] == links_of(rows).sum(1).tolist() and sum(got.values()) >= 40
    assert len(seen) == 2 and sum(seen) < 20 * 500, seen


def test_links_of_a_long_sparse_component_are_exact(spark):
    rng = np.random.default_rng(12)
    walk = [rng.standard_normal(24)]
    for _ in range(1299):
        step = rng.standard_normal(24)
        unit = walk[-1] / np.linalg.norm(walk[-1])
        step -= (step @ unit) * unit
        walk.append(0.962 * unit + np.sqrt(1 - 0.962**2) * step / np.linalg.norm(step))
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(walk)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(df).collect()}
    near = links_of(walk)
    assert [got[k].n_links for k in range(1300)] == near.sum(1).tolist() and {r.component_id for r in got.values()} == {0}
