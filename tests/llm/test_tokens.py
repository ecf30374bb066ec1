"""Piece encoding against its library, and packing as an exact cover of every document."""

import hashlib
import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import DOCS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stagetrail.llm import packing, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(WORDS)


@cache
def word_tokens():
    with open(WORDS, encoding="utf-8") as f:
        return packing.WordTokens(f.read())


@cache
def piece_library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as f:
        return pieces.PieceModel(f.read())


@pytest.fixture(scope="module")
def library():
    return piece_library()


ODD = [
    "", " ", "   ", "   a", "a  ", "\n", "\t x", "a" * 300, " " * 400, "x" + " " * 37 + "the", "▁▁a", "日本語 😀👩‍👧", "é", "\x00a",
    "the the\n\n the", "<s> </s> <unk>", "<0x41>", "z" * 50 + "́", " ⁇ ",
]


def test_odd_texts_encode_and_decode_as_the_library_does(coder, library):
    for text in ODD:
        ids = library.encode(text)
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids, text
        framed = [library.bos_id(), *ids, library.eos_id()]
        assert coder.decode(np.array(framed, "<u4").tobytes()) == library.decode(framed), text


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abdehinorst  .,ABT\n▁é日😀"), max_size=60) | st.text(max_size=40))
def test_any_text(text):
    with open(MODEL, "rb") as f:
        coder = pieces.load(f.read())
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == piece_library().encode(text)


def test_decoding_any_ids(coder, library):
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randrange(1, 12))]
        assert coder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_backtracking_gives_what_merging_gives(coder):
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("▁▁thereinaodsl.") for _ in range(rng.randrange(1, 25)))
        assert coder.backtrack(text) == coder.merge(text)


def test_documents_keep_every_row(spark, library):
    texts = [None, *ODD[:12], "x y " * 20000, "same", "same"]
    rows = documents(spark, texts, extra=True)
    got = {r["doc_id"]: r for r in pieces.encode_documents(rows, MODEL, digests=True).collect()}
    whole = {r["doc_id"]: r for r in pieces.encode_documents(rows, MODEL).collect()}
    for i, text in enumerate(texts):
        ids = [library.bos_id(), *library.encode(text or ""), library.eos_id()]
        assert list(whole[i]["ids"]) == ids and whole[i]["decoded"] == library.decode(ids)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    big = (1 << 60) + 1
    odd = spark.createDataFrame([(None, "a", None, None, None), (big, "b", None, None, None)], DOCS)
    assert {r["doc_id"] for r in pieces.encode_documents(odd, MODEL, digests=True).collect()} == {None, big}
    assert pieces.encode_documents(spark.createDataFrame([], DOCS), MODEL, digests=True).count() == 0


# ---- packing ----


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abEÉüß'srtlm 012²½_-.,\n\t\x0b\x1c\x85\xa0日İΣσ<|>"), max_size=25) | st.text(max_size=25), max_size=6))
def test_ids_are_the_tokenizers(texts):
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(word_tokens().encode(t), "<u4").tolist() for t in texts] == want


def test_markers_and_contractions():
    texts = ["a<|endoftext|> b<|startoftext|>", "l'eau d'retour I'LL don't", "'s 't", "Straße İstanbul ΟΔΟΣ", "İ. İ, 日本. Σ.", "é.. e\u0301. ª."]
    for text in texts:
        assert np.frombuffer(word_tokens().encode(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def check_plan(counts, capacity, **kw):
    runs = packing.plan(counts, capacity, **kw)
    placed = Counter()
    for held, times in runs:
        assert sum(held) <= capacity and times > 0 and held
        for length in held:
            placed[length] += times
    assert placed == Counter({k: n for k, n in counts.items() if n})
    return sum(times for _, times in runs)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30), st.sampled_from([0.1, 0.25, 0.4, 0.6]), st.integers(1, 40))
def test_plans_hold_every_piece_once(counts, large, groups):
    used = check_plan(counts, 64, large=large, groups=groups)
    total = sum(k * n for k, n in counts.items())
    assert -(-total // 64) <= used <= sum(counts.values())


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.2, 1.1, 60_000).astype(int), 1, 2048)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    assert check_plan(counts, 2048) <= 1.002 * lengths.sum() / 2048 + 2


def test_configurations_cover_the_demand():
    sizes, demand = [60, 45, 31, 20], [7, 9, 13, 4]
    found = packing.configurations(sizes, demand, 100)
    assert [sum(c[i] * n for c, n in found) for i in range(4)] == demand
    assert all(sum(c * s for c, s in zip(column, sizes, strict=True)) <= 100 for column, _ in found)
    # 60+31, 45+45, 31+31+31 and so on: no fewer than the total length asks for, and one above it at most.
    assert sum(n for _, n in found) <= -(-sum(s * d for s, d in zip(sizes, demand, strict=True)) // 100) + 3


def test_packed_documents(spark):
    rng = random.Random(3)
    texts = [None, "", "x"] + [" ".join(rng.choice(["tower", "of", "Glass,", "blue"]) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    texts += ["blue of"] * 40 + ["tower " * 5000]
    capacity = 128
    docs = documents(spark, texts, extra=True)
    got = packing.pack(docs, WORDS, capacity, 0.4, 20).collect()
    places = {}
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(range(len(texts)))
    for d, text in enumerate(texts):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // capacity)))
        for r in parts:
            cut = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == capacity * r["piece"] and len(cut) == r["length"] == min(capacity, len(ids) - r["start"])
            assert r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(spark.createDataFrame([], DOCS), WORDS).count() == 0
    rows = spark.createDataFrame([(None, "a", None, None, None), (None, "a", None, None, None), (5, None, None, None, None)], DOCS)
    found = packing.pack(rows, WORDS).collect()
    assert len(found) == 3 and len({(r["sequence_id"], r["offset"]) for r in found}) == 3
