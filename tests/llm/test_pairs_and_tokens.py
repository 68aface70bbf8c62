"""Near-duplicate operators against brute force, tokenizers against their libraries, packing invariants, the pipeline."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import byte_bpe, embed_dedup, labelled, minhash, packing, pieces, queries


def groups(ids, linked):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def near(docs, width, percent):
    sets = {i: shingles(t, width) for i, t in docs}
    ids = [i for i in sets if sets[i]]
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b]))]
    return groups(sets, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]), sets


def test_minhash_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want, sets = near(docs, 3, 85)
    got = queries.QUERIES["op3_minhash"](spark, SMALL).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(sets[i]), want[i], want[i] == i) for i in sets}


def test_minhash_star_and_edges(spark):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(1, 60):  # copies that are near the origin but not near each other
        own = list(base)
        for at in rng.choice(118, 2, replace=False) + 1:
            own[at] = f"n{i}_{at}"
        docs.append((i, " ".join(own)))
    docs += [(100, "a b c d e"), (101, "A B\tC d\ne"), (102, None), (103, ""), (104, " \n"), (105, "one"), (106, "one"), (107, "x " * 40000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in [*docs, (100, "a b c d e"), (None, "one")]], "doc_id long, text string, node string")
    for width, percent in ((3, 85), (5, 80)):
        want, sets = near(docs, width, percent)
        got = minhash.near_duplicates(df, width, percent).collect()
        assert len(got) == len(docs) + 2
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(i, len(sets[i]), want[i]) for i in sets}
        assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.drop_near_copies(df).columns == df.columns


def test_minhash_family_without_origin(spark):
    """One bucket of members that are all just under the limit, but for few planted pairs: no pair of it is left out."""
    rng = np.random.default_rng(11)
    base, docs = [f"w{k}" for k in range(200)], []
    for i in range(120):
        own = list(base)
        for at in rng.choice(200, 4, replace=False):
            own[at] = f"n{i}_{at}"
        docs.append((i, " ".join(own)))
        if i % 20 == 7:
            for at in rng.choice(200, 4, replace=False):
                own[at] = f"p{i}_{at}"
            docs.append((1000 + i, " ".join(own)))
    sets = {i: shingles(t, 3) for i, t in docs}
    keys = {i: minhash.OnePermutation(1, 1).band_keys(minhash.shingle_set(t, 3))[0] for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and keys[a] == keys[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = groups(list(sets), links)
    assert 3 <= len({*want.values()} & {want[b] for _, b in links}) and max(list(keys.values()).count(k) for k in keys.values()) > 60
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85, bands=1, rows=1).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_minhash_large_family_at_the_limit(spark):
    """520 documents that all share buckets, each with 6 words of its own, and some twins that differ from one of them in 5
    more: of 135,000 pairs only the planted ones link. Members also share edits with each other, as templates do."""
    rng = np.random.default_rng(12)
    base, docs = [f"w{k}" for k in range(220)], []
    for i in range(500):
        own = list(base)
        for at in rng.choice(220, 6, replace=False):
            own[at] = f"n{i}_{at}" if at % 3 else f"slot{at}_{i % 7}"
        docs.append((i, " ".join(own)))
        if i % 25 == 7:
            for at in rng.choice(220, 5, replace=False):
                own[at] = f"p{i}_{at}"
            docs.append((1000 + i, " ".join(own)))
    sets = {i: shingles(t, 3) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = groups(list(sets), links)
    assert 15 <= len(links) and len(set(want.values())) > 300
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_minhash_repeated_ids_with_other_texts(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(5, " ".join(words)), (5, "something else"), (9, " ".join(words) + " end"), (12, "something else"), (20, "alone here now")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {(5, 58, 5), (5, 1, 5), (9, 59, 5), (12, 1, 5), (20, 1, 20)}


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, [float(x) for x in base[i % 40] + (0 if i < 40 else rng.normal(size=16) * 0.12)]) for i in range(240)]
    rows += [(500, rows[3][1]), (501, [2 * x for x in rows[3][1]]), (502, None), (503, []), (504, [0.0] * 16), (505, [float("nan")] * 16), (506, [1.0, None] * 8), (507, rows[3][1][:5])]
    v = {i: np.array(x, dtype=float) for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)}
    cos = lambda a, b: len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95
    links = [(a, b) for a in v for b in v if a < b and cos(v[a], v[b])]
    want, degree = groups([i for i, _ in rows], links), {i: 0 for i, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    df = spark.createDataFrame([(*r, 1) for r in [*rows, (None, rows[3][1])]], "vec_id long, embedding array<double>, node int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(df).collect()}
    assert len(got) == len(rows) + 1 and (got[None].component_id, got[None].kept, got[None].n_links) == (None, False, 0)
    assert {(i, r.n_links, r.component_id, r.kept) for i, r in got.items() if i is not None} == {(i, degree[i], want[i], want[i] == i) for i in want}
    assert embed_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


HARD = ["", " x", "a  b", "a\n \nb", "a\n ", "it's  we're <|endoftext|>", "é 12 345!!\n\n  z ", "漢字 kana 😀", "▁ ▁x", "   ", "\x1c \x1c a", "word " * 3000, "x" * 3000]


def test_byte_bpe_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    for text in HARD:
        assert np.frombuffer(byte_bpe.load(path).encode(text), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


def test_byte_bpe_added_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for text in [*HARD, "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>\n <|endoftext", "<|endoftext|> "]:
        assert np.frombuffer(byte_bpe.load(path).encode(text, added_tokens=True), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


def test_op8_and_pipeline_name_added_tokens(spark, tmp_path):
    docs = {1: "a <|endoftext|> b", 2: "plain"}
    spark.createDataFrame(list(docs.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(queries.QUERIES["op8_packing"](spark, str(tmp_path)).collect(), docs, t, 1)
    check_packing(corpus_pipeline.pack(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect(), docs, t, 1)


def test_pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path)
    plain = [t for t in HARD if "▁" not in t]
    assert [i.tolist() for i in own.encode_batch(plain, [0] * len(plain), 0, 0.0)] == sp.encode(plain)
    some = {}
    for seed, rate in ((0, 0.0), (1, 0.1), (2, 0.1), (1, 0.5), (1, 1.0)):
        ids = own.encode_batch(HARD, list(range(len(HARD))), seed, rate)
        assert [own.decode(i.tolist()) for i in ids] == HARD
        some[seed, rate] = [i.tolist() for i in ids]
    assert some[1, 0.1] != some[2, 0.1] and some[1, 0.1] == [i.tolist() for i in own.encode_batch(HARD, list(range(len(HARD))), 1, 0.1)]
    words = HARD.index("word " * 3000)
    assert len(some[0, 0.0][words]) <= len(some[1, 0.1][words]) < len(some[1, 0.5][words]) < len(some[1, 1.0][words])


def test_pieces_on_tables(spark):
    out = queries.QUERIES["op4_pieces"](spark, SMALL)
    assert out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count() and out.filter("not lossless or n_pieces <> size(ids)").count() == 0
    df = spark.createDataFrame([(1, "a b", 0), (None, None, 0), (1, "a b", 0)], "doc_id long, text string, ids int")
    got = pieces.encode_pieces(df, public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(r.n_pieces for r in got.collect())[0] == 0 and got.count() == 3 and pieces.encode_pieces(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    back = pieces.decode_pieces(got, public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.text for r in back.collect()} == {"a b", ""}


def check_packing(rows, docs, tokenizer, end):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, text in docs.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].window and at & (at - 1) == 0 and at <= 2048


def test_filler_is_the_longest_that_fits():
    p = packing.Packer((2048, 1024, 512, 256))
    for name, n in (("a", 1648), ("b", 300), ("c", 500), ("d", 2000), ("e", 200)):
        p.add((name, memoryview(b"\1\0\0\0" * n), n, 0))
    p.pack()
    first, second = ([(d[0], start, n) for d, start, n in pieces] for _, pieces in p.out[:2])
    assert first == [("d", 0, 2000), ("e", 0, 48)] and second == [("a", 0, 1648), ("b", 0, 300), ("e", 48, 100)]
    p.release()
    assert all(len(d[1]) == 4 * n and d[3] == start for _, pieces in p.out for d, start, n in pieces)


def test_pipeline_keeps_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit("own")).withColumn("predicted", F.col("doc_id"))
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_poor):
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns and kept.filter("score != 'own' or predicted != doc_id").isEmpty() and not kept.isEmpty()


def test_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_packing"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs)
    check_packing(rows, docs, t, 1)
    odd = {k: h for k, h in enumerate([*HARD, None])}
    df = spark.createDataFrame([(k, h, 0) for k, h in odd.items()], "doc_id long, text string, length int")
    got = packing.pack_documents(df, path, with_ids=True).collect()
    check_packing(got, odd, t, 1)
    assert all(len(r.ids) == r.length for r in got) and packing.pack_documents(df.limit(0), path).count() == 0
    assert packing.pack_documents(spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string"), path).select("sequence_id").count() >= 3


def test_step_groups_last_over_batches(spark):
    """Groups of a tier hold the asked number of sequences, however few rows a batch has; only the end of a task leaves fewer."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), step_sequences=4).select("window", "step_id", "sequence_id").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = {}
    for r in rows:
        sizes.setdefault((r.window, r.step_id), []).append(r.sequence_id)
    for window in (2048, 1024, 512, 256):
        own = [len(v) for (w, _), v in sorted(sizes.items()) if w == window]
        assert sum(n < 4 for n in own) <= 1 and max(own, default=4) <= 4, (window, own)
    assert len({s for _, s in sizes}) == len(sizes)


def test_filters_without_usable_labels(spark, tmp_path):
    good, bad = "a calm and useful text about gardens ", "vile hateful stupid insults everywhere "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * 3 + str(i)) for i in range(40)], "doc_id long, text string")
    for name, ids in (("none", []), ("others", range(1000, 1040)), ("one class", range(1, 40, 2))):
        labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in ids], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_poor):
            assert stage(spark, docs, f"{tmp_path}/{name}").count() == 40, name
    many = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    assert labelled.training_sample(docs, many, "quality", 30).count() == 30
    # one drawn id on most rows: the bound holds, and the text does not depend on the rows' order
    repeated = spark.createDataFrame([(k if k < 5 else 3, f"text {k}") for k in range(2000)], "doc_id long, text string").repartition(7)
    few = spark.createDataFrame([(k, k % 2) for k in range(5)], "doc_id long, quality int")
    drawn = labelled.training_sample(repeated, few, "quality", 5)
    assert sorted(r["_x_id"] for r in drawn.collect()) == [0, 1, 2, 3, 4] and drawn.exceptAll(labelled.training_sample(repeated.coalesce(1), few, "quality", 5)).isEmpty()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns, name
    left = {r.doc_id: r.text for r in kept.collect()}
    assert len(set(left.values())) == len(left)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == set(left)
    check_packing(packed, left, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 1)
