"""Fingerprints, anchors, components and paragraphs against brute force."""

import random

import numpy as np
import pytest
from brute import DOCS, classes, documents, fingerprint, prose, vocabulary
from pyspark.sql import functions as F

from stagetrail.llm import common, paragraphs, simhash
from stagetrail.llm.common import components, in_cells


def near_texts(seed, n=60):
    rng = random.Random(seed)
    words = vocabulary(rng)
    texts = [None, "", "  \n\t ", "one", "one two three", "ONE two three", "x" * 5000]
    for _ in range(n // 4):
        base = prose(rng, rng.randint(5, 300), words).split()
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return texts + [texts[-1], texts[-1]]


@pytest.mark.parametrize("words", [4, 5])
def test_fingerprints(words):
    for text in near_texts(1):
        assert simhash.fingerprint(text, words) == fingerprint(text, words)


def test_fingerprint_of_a_long_text_is_counted_in_blocks(monkeypatch):
    text = prose(random.Random(2), 900, vocabulary(random.Random(3)))
    whole = simhash.fingerprint(text, 4)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(text, 4) == whole == fingerprint(text, 4)


@pytest.mark.parametrize("width", [21, 22, 32])
def test_codes_cover_within_their_radius(width):
    code = simhash.Cover(8, width)
    rng = np.random.default_rng(width)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    home = code.anchor(fps)
    for radius in (1, 2):
        flipped = fps.copy()
        for _ in range(radius):
            flipped ^= np.uint64(1) << rng.integers(8, 8 + width, 300).astype(np.uint64)
        sent = code.anchors(flipped, radius)
        assert (sent == home[:, None]).any(axis=1).all()
        assert (code.anchor(fps ^ np.uint64(1)) == home).all()  # bits outside the segment do not matter


@pytest.mark.parametrize(("max_bits", "segments"), [(4, 3), (5, 3), (4, 2)])
def test_components_by_anchors(spark, monkeypatch, max_bits, segments):
    monkeypatch.setattr(simhash, "CHUNK", 8)
    texts = near_texts(4)
    # Forced close fingerprints: the fingerprints of single shingles with known bits do not come about by chance.
    want = {i: fingerprint(t, 4) for i, t in enumerate(texts)}
    root = classes(want, lambda a, b: (want[a] ^ want[b]).bit_count() <= max_bits)
    got = simhash.simhash_components(documents(spark, texts, extra=True), 4, max_bits, segments).collect()
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in got} == want
    assert {r["doc_id"]: r["component_id"] for r in got} == root
    assert len(set(root.values())) < len(root)


def test_links_at_each_distance_are_found(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 40, dtype=np.int64)
    fps = [int(b) for b in base]
    for b in base:
        for bits in (1, 2, 3, 4, 5):
            flips = rng.choice(63, bits, replace=False)
            fps.append(int(b) ^ sum(1 << int(f) for f in flips))
    nodes = spark.createDataFrame([(f,) for f in set(fps)], "fp long")
    rows = simhash.anchored(nodes, 4, 3)
    cells = in_cells(rows, "anchor", "fp", 16)
    edges = common.per_cell(cells, "anchor", simhash._compare(4), "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    want = classes(sorted(set(fps)), lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 4)
    assert {n: got.get(n, n) for n in want} == want


def test_simhash_edge_cases(spark):
    assert simhash.simhash_components(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(3, "a b", None, None, None), (3, "a b", None, None, None), (None, "a b", None, None, None), (None, None, None, None, None)]
    got = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(3, 3), (None, 3), (None, None)}


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 301), (301, 300)]
    random.Random(1).shuffle(chain)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61))
    assert all(got[100 + i] == 101 for i in range(1, 50)) and got[200] == 101
    assert got[300] == got[301] == 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cells_let_every_pair_meet_once(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7), (3, 8), (3, 9)], "key long, m long")
    cells = in_cells(rows, "key", "m", 10).collect()
    assert not [c for c in cells if c["key"] == 2]
    met = {}
    for c in cells:
        met.setdefault((c["key"], c["lo"], c["hi"]), []).append(c["m"])
    pairs = {frozenset((a, b)) for (k, *_), ms in met.items() if k == 1 for a in ms for b in ms if a != b}
    assert len(pairs) == 50 * 49 // 2
    assert max(len(m) for m in met.values()) < 50


# ---- paragraphs ----


def jaccard(a, b, size=5):
    def shingles(words):
        return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def paragraph_texts(seed):
    rng = random.Random(seed)
    words = vocabulary(rng)
    passages = [prose(rng, rng.randint(50, 80), words).capitalize() + "." for _ in range(6)]
    texts = [None, "", "short line\nshort line"]
    for i in range(40):
        lines = [prose(rng, rng.randint(3, 60), words).capitalize() + "." for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            near = passages[i % 6].split()
            near[rng.randrange(len(near))] = "changed"
            lines.insert(rng.randrange(len(lines) + 1), passages[i % 6] if i % 2 else " ".join(near))
        texts.append("\n".join(lines))
    return texts + [texts[5]]


def test_paragraphs_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "CHUNK", 4)
    texts = paragraph_texts(1)
    spans = {
        (d, a, b - a): text[a:b].lower().split()
        for d, text in enumerate(texts)
        for a, b in paragraphs.split_paragraphs(text or "")
        if len((text or "")[a:b].split()) >= paragraphs.LEAST_WORDS
    }
    root = classes(sorted(spans), lambda x, y: jaccard(spans[x], spans[y]) >= 0.8)
    sizes = {}
    for r in root.values():
        sizes[r] = sizes.get(r, 0) + 1
    want = {p: (r[0], p == r, sizes[r]) for p, r in root.items() if sizes[r] > 1}
    docs = documents(spark, texts, extra=True)
    found = paragraphs.duplicate_paragraphs(docs)
    got = {(r["doc_id"], r["start"], r["length"]): (r["keep_doc_id"], r["kept"], r["copies"]) for r in found.collect()}
    assert got == want and len(want) > 12

    left = {r["doc_id"]: r for r in paragraphs.remove_paragraphs(docs, found).collect()}
    assert left[0]["text"] is None and left[1]["text"] == "" and left[2]["text"] == texts[2]
    for d, text in enumerate(texts):
        cuts = [p for p, (_, kept, _) in want.items() if p[0] == d and not kept]
        if not cuts:
            assert left[d]["text"] == text
        elif d in left:
            assert left[d]["n_chars"] == len(left[d]["text"]) < len(text)
            for _, a, n in cuts:
                assert text[a : a + n] not in left[d]["text"] or text.count(text[a : a + n]) > 1
    assert len(texts) - 1 not in left  # a whole copy leaves nothing


def test_split_covers_every_word_and_does_not_depend_on_what_stands_before():
    text = "Short. " + "Long " * 25 + "end. And then. Some more\nNext line " + "w " * 30 + ". Tail"
    spans = paragraphs.split_paragraphs(text)
    assert " ".join(text[a:b] for a, b in spans).split() == text.split()
    long = "Word " * 24 + "stop."
    for before in ("", "One. ", "One two three. Four. "):
        moved = before + long + " After."
        assert long in [moved[a:b] for a, b in paragraphs.split_paragraphs(moved)]


def test_paragraph_edge_cases(spark):
    assert paragraphs.duplicate_paragraphs(spark.createDataFrame([], DOCS)).count() == 0
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(None, line, None, None, None), (2, line, None, None, None), (1, line + "\n" + line, None, None, 1), (9, " ".join(["same"] * 9000), None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = paragraphs.duplicate_paragraphs(docs)
    got = sorted(((r["doc_id"], r["start"], r["kept"], r["copies"]) for r in found.collect()), key=str)
    assert got == [(1, 0, True, 4), (1, len(line) + 1, False, 4), (2, 0, False, 4), (None, 0, False, 4)]
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_paragraphs(docs, found).collect()}
    assert left == {1: line + "\n", 9: rows[3][1]}


def test_no_paragraph_is_long_enough(spark):
    assert paragraphs.duplicate_paragraphs(documents(spark, [None, "", "a b c", "x\ny", "a b c"] * 40)).count() == 0


def test_bands_reach_the_recall():
    for similarity in (0.7, 0.8, 0.9):
        bands, rows = paragraphs.tune_bands(similarity, 0.995)
        assert 1 - (1 - similarity**rows) ** bands >= 0.995


def test_other_queries_columns(spark):
    docs = documents(spark, ["a b c d e f"], extra=True)
    assert simhash.simhash_components(docs).columns == ["doc_id", "fp", "component_id"]
    assert docs.where(F.col("fp") == "x").count() == 1
