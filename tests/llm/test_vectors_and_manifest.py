"""Integer vector codes, nearest neighbours and the Merkle manifest against plain versions."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from compare import both, database
from conftest import SMALL
from pyspark.sql import functions as F

from tidewater.llm import ann, merkle, queries, vector_codes


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_merkle_manifest"])
def test_same_as_sql(spark, name):
    ours, theirs = both(queries.QUERIES[name](spark, SMALL), database(SMALL), queries.SQL[name])
    assert ours == theirs and len(ours) >= 200


# --- vector codes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = sorted((r for r in rows if usable(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * x) for x in r[1]] for r in kept]
    w = len(whole[0]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [near(v[p], books[p])[1] for v in cut]
            groups = [[v[p] for v, k in zip(cut, own) if k == e] for e in range(len(books[p]))]
            books[p] = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, books[p])]
    final = [[near(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in final]
    of = {}
    for r, e in zip(kept, errors):
        of[r[2]] = of.get(r[2], 0) + e
    digest = sha(",".join(str(c) for b in books for e in b for c in e))
    return sorted((repr(r[0]), "".join(f"{k:02x}" for _, k in f), e, of[r[2]], digest) for r, f, e in zip(kept, final, errors))


@pytest.mark.parametrize("width, scale", [(1, 1.0), (3, 0.3), (5, 1e6)])
def test_codes_as_plain(spark, width, scale):
    rng = np.random.default_rng(width)
    centres = rng.standard_normal((9, 16 * width)) * scale
    rows = [(k, [float(np.float32(x)) for x in centres[k % 9] + rng.standard_normal(16 * width) * scale * 0.1], [None, 1, 2][k % 3]) for k in range(180)]
    rows += [rows[5], (7, rows[9][1], 1), (None, rows[11][1], 2), (300, [0.0] * 16 * width, None), (301, [-1e-9] * 16 * width, 1)]
    bad = [(302, None, 1), (303, [], 1), (304, [None] * 16 * width, 1), (305, [float("nan")] * 16 * width, 1), (-1, [float("inf")] * 16 * width, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({"code": F.lit("x"), "error": F.lit(1), "part": F.lit(2), "_row": F.lit(3)})
    got = vector_codes.vector_codes(df.repartition(5)).collect()
    assert sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == plain_codes(rows)


def test_codes_of_odd_tables(spark):
    shape = "vec_id long, embedding array<double>, label string"
    assert vector_codes.vector_codes(spark.createDataFrame([], shape)).count() == 0
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, "a")], shape)).count() == 0
    # too large for a code, another length, a length that 16 doesn't divide
    got = vector_codes.vector_codes(spark.createDataFrame([(1, [1.0, 2.0, 3.0], "a"), (2, [1e300, 0.0, 0.0], "a"), (3, [1.0], "a"), (4, [1e6, 1.0, 1.0], None)], shape)).collect()
    assert [(r.vec_id, r.code[:6], r.error, r.label_error) for r in sorted(got, key=lambda r: r.vec_id)] == [(1, "000000", 0, 0), (4, "010101", 0, 0)]


def test_sequency_order():
    for size in (1, 2, 4, 8, 16):
        rows = vector_codes.spectrum(np.eye(size, dtype=np.int64))
        assert (rows[:-1] != rows[1:]).sum(0).tolist() == list(range(size))


# --- nearest neighbours


def plain_neighbours(rows, picks, k=5):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and usable(v) and any(v)}
    found = {}
    for i, v in sorted(rows):
        if not picks(i):
            continue
        others = [(j, np.array(w)) for j, w in sorted(rows) if j != i and len(w) == len(v)]
        u = np.array(v)
        scored = sorted((-float(u @ w / math.sqrt(float(u @ u) * float(w @ w))), j) for j, w in others)
        found.setdefault(i, []).append([(j, -s) for s, j in scored[:k]])
    return found


def test_neighbours_of_a_small_table(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.integers(-2, 3, 6)]) for k in range(24)]
    rows += [(100 + k, rows[0][1]) for k in range(12)] + [(150, [2 * x for x in rows[0][1]]), rows[4], (50, None), (200, [0.0] * 6), (250, [float("nan")] * 6), (None, rows[1][1]), (300, [1.0, None] * 3)]
    rows += [(350, [1.0, 2.0]), (351, [2.0, 1.0]), (400, [1e300] * 3), (401, [1e300, 1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "query": F.lit(2), "ids": F.lit(3), "share": F.lit(4)})
    got = {}
    for r in ann.nearest_neighbours(df.repartition(3), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    scaled = [(i, [x / 1e300 for x in v] if v and len(v) == 3 else v) for i, v in rows]
    want = {i: f[0] for i, f in plain_neighbours(scaled, lambda i: i % 50 == 0).items()}
    assert set(got) == {i for i, f in want.items() if f} == {0, 100, 150, 350, 400}
    for i, f in got.items():
        assert [s for _, s in f] == pytest.approx([s for _, s in want[i]], abs=1e-12)
    assert [j for j, _ in got[0]] == [100, 101, 102, 103, 104] and [j for j, _ in got[100]] == [0, 101, 102, 103, 104]
    assert [j for j, _ in got[350]] == [351] and [j for j, _ in got[400]] == [401]
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_recall_with_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "COPIES", 20)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 40))
    base = [centres[k % 12] + rng.standard_normal(40) * (0.3 if k % 3 else 2.0) for k in range(3000)]
    v = np.array([*base, *[base[7]] * 1500])
    rows = [(k, [float(x) for x in r]) for k, r in enumerate(np.round(v, 5))]
    got = {}
    for r in ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 4500, 50):
        s = u @ u[q]
        s[q] = -2
        best = np.lexsort((np.arange(len(s)), -np.round(s, 12)))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hits += len({*best.tolist()} & {j for j, _ in got[q].values()})
        for j, score in got[q].values():
            assert score == pytest.approx(float(u[j] @ u[q]), abs=1e-12)
    assert len(got) == 90 and hits >= 0.97 * 450


def test_the_scan_drops_few_neighbours():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((128, 128)))[0]
    rows, asked = ann.unit(rng.standard_normal((4000, 128)) * np.geomspace(1, 0.01, 128)) @ turn, ann.unit(rng.standard_normal((100, 128)) * np.geomspace(1, 0.01, 128)) @ turn
    exact = 2 - 2 * asked @ rows.T
    limits = np.sort(exact, axis=1)[:, 5]
    of, at = ann.scan(asked, rows, limits)
    assert (exact[of, at] <= limits[of] + 1e-6).all()  # the last test is exact
    assert len(of) >= 0.98 * 600


# --- the manifest


def plain_manifest(rows):
    def leaf(r):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def climb(level):
        ways = [[] for _ in level]
        places = list(range(len(level)))
        while len(level) > 1:
            for way, at in zip(ways, places):
                run = level[at // 3 * 3 : at // 3 * 3 + 3]
                way.append((run[: at % 3], run[at % 3 + 1 :]))
            level = [sha("".join(level[k : k + 3])) for k in range(0, len(level), 3)]
            places = [at // 3 for at in places]
        return level[0], ways

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    root, above = climb([t[1] for t in trees])
    found = []
    for (own, subroot, ways), over in zip(trees, above):
        for r, way in zip(own, ways):
            way = way + over
            tampers = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            d = leaf((*r[:4], r[4].replace("\n", "") if tampers and r[4] is not None else r[4]))
            for left, right in way:
                d = sha("".join([*left, d, *right]))
            found.append((repr(r[0]), leaf(r), subroot, root, sha("".join(x for left, right in way for x in [*left, *right])), d, d == root))
    return sorted(found)


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest_as_plain(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 3**height)
    texts = ["a\nb", "", None, "grüße\n\n", "same", "x" * 3000 + "\n", "\n"]
    rows = [(k, ["hot", "b", None, "é", "", "\U0001f600", "￿"][0 if k % 2 else k % 7], [None, "en"][k % 2], k if k % 5 else None, texts[k % 7]) for k in range(100)]
    rows += [(None, "hot", "en", 1, "n\n"), (None, "hot", "en", 1, "n\n"), (None, None, None, None, None), (7, "hot", "de", 2, "z\n"), rows[3], rows[3], (1000, "lone", None, 0, "q\n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({"leaf": F.lit("l"), "tree": F.lit(1), "idx": F.lit(2), "way": F.lit(3)})
    got = merkle.merkle_manifest(df.repartition(7), queries.in_split("doc_id", 2, 0)).collect()
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got) == plain_manifest(rows)
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_one_and_of_none(spark):
    shape = "doc_id long, source string, lang string, n_chars long, text string"
    got = merkle.merkle_manifest(spark.createDataFrame([(4, None, None, None, "a\n")], shape), F.lit(None).cast("boolean")).collect()
    assert len(got) == 1 and got[0].leaf == got[0].subroot == got[0].root == got[0].folded_root and got[0].proof_sha256 == sha("") and got[0].verified
    assert merkle.merkle_manifest(spark.createDataFrame([], shape), F.lit(True)).count() == 0
