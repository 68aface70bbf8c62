"""Merge dropout against a plain agenda that looks at every candidate of a segment again at each step."""

import re

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from conftest import SMALL

from tidewater.llm import pieces
from tidewater.llm.shingles import mix_int

PATH = public_tokenizers.path("piece_bpe_32k.model")
M = 2**64 - 1


def plain(sp, score, text, own, seed, rate):
    """Piece ids of one text, by the definition alone."""
    out = []
    for place, segment in enumerate(re.findall(" +[^ ]*", " " + text) if text else []):
        key = mix_int((own + seed * int(pieces._K[2]) + place * int(pieces._K[0])) & M)
        spans = [(k, k + 1) for k in range(len(segment))]
        while True:
            best = None
            for i in range(len(spans) - 1):
                (s, m), (_, e) = spans[i], spans[i + 1]
                if segment[s:e] in score:
                    place_hash = (s * int(pieces._K[0]) & M) ^ (m * int(pieces._K[1]) & M) ^ (e * int(pieces._K[2]) & M)
                    if rate and (rate >= 1 or mix_int(key ^ place_hash) >> 1 < int(rate * 2**63)):
                        continue
                    if best is None or score[segment[s:e]] > best[0]:
                        best = score[segment[s:e]], i
            if best is None:
                break
            i = best[1]
            spans[i : i + 2] = [(spans[i][0], spans[i + 1][1])]
        for s, e in spans:
            t = segment[s:e]
            out += [sp.piece_to_id(t.replace(" ", "▁"))] if t in score else [sp.piece_to_id(f"<0x{b:02X}>") for b in t.encode()]
    return out


def test_dropout_equals_the_plain_agenda(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    score = {sp.id_to_piece(k).replace("▁", " "): sp.get_score(k) for k in range(sp.get_piece_size()) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))}
    rng = np.random.default_rng(4)
    texts = [r.text[:2500] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(12).collect()]
    texts += ["", " ", "a  b   c", "漢字▁ kana 😀", "".join(rng.choice(list("etaoinshr"), 65)), "".join(rng.choice(list("etaoinshrlé\n"), 300)) + " x", "the " * 300]
    own = [xxhash.xxh3_64_intdigest(str(k), 7) for k in range(len(texts))]
    for rate in (0.0, 0.1, 0.6, 1.0):
        got = pieces.load(PATH).encode_batch(texts, own, 7, rate)
        for text, key, ids in zip(texts, own, got):
            assert ids.tolist() == plain(sp, score, text, key, 7, rate), (rate, text[:40])


def test_every_occurrence_draws_anew():
    text = "segmentation " * 4000
    ids = pieces.load(PATH).encode_batch([text], [5], 1, 0.1)[0]
    seen = {}
    current = []
    for k in ids.tolist():
        piece = pieces.load(PATH).raw[k]
        if piece.startswith(b" "):
            seen[tuple(current)] = seen.get(tuple(current), 0) + 1
            current = []
        current.append(k)
    assert len(seen) > 20
    keys = np.arange(100_000, dtype=np.uint64) * pieces._K[1]
    share = pieces._skipped(keys, pieces._place(np.full(1, 2), np.full(1, 3), np.full(1, 5)), 0.1).mean()
    assert abs(share - 0.1) < 0.01


def test_long_texts_without_blanks():
    rng = np.random.default_rng(3)
    for text in ("x" * 100_000, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 200_000)), "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 200_000)))):
        ids = pieces.load(PATH).encode_batch([text], [5], 1, 0.1)[0]
        assert pieces.load(PATH).decode(ids.tolist()) == text
