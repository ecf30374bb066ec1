"""Repeated passages spliced at a word into longer lines, with and without sentence ends."""

import random

import numpy as np
import pytest
from brute import documents, prose, vocabulary
from pyspark.sql import functions as F

from stagetrail.llm import paragraphs


def hosts(seed, sentence, size, n=60):
    """(texts, passages): passage k of `size` words stands inside line k and line n + k, after words of their own."""
    rng = random.Random(seed)
    words = vocabulary(rng, 3000)

    def line(count):
        found = prose(rng, count, words).split()
        return " ".join(w + "." if sentence and i % sentence == sentence - 1 else w for i, w in enumerate(found))

    passages = [line(size) for _ in range(n)]
    return [f"{line(rng.randint(40, 90))} {p} {line(rng.randint(40, 90))}" for p in passages * 2], passages


@pytest.mark.parametrize("size", [30, 50, 100])
@pytest.mark.parametrize("sentence", [None, 8])
def test_spliced_passages_are_found(spark, sentence, size):
    """Words found of passages spliced at a word, with and without short sentences; nothing else goes."""
    texts, passages = hosts(1, sentence, size)
    docs = documents(spark, texts, extra=True)
    found = paragraphs.duplicate_passages(docs)
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_paragraphs(docs, found).collect()}
    n = len(passages)
    assert all(left[k] == texts[k] for k in range(n))
    cut = [len(texts[n + k].split()) - len(left[n + k].split()) for k in range(n)]
    print("found", sum(c > 0 for c in cut), "of", n, "words removed", sum(cut), "of", size * n)
    # A passage of 30 words may hold no seed (one in eight words, 19 places: 0.08) and loses two words of its 30 at the ends.
    assert sum(c > 0 for c in cut) >= (0.8 if size < 50 else 0.98) * n and sum(cut) >= (0.75 if size < 50 else 0.93) * size * n
    for k in range(n):
        # What stands around stays, but for the few words of a sentence that is a near copy with its part of the passage.
        before, after = texts[n + k].split(passages[k])
        kept = left[n + k]
        lost = len(texts[n + k].split()) - len(kept.split()) - size
        assert lost <= (3 if sentence else 1) and kept.startswith(" ".join(before.split()[:-3])) and kept.endswith(" ".join(after.split()[3:]))


def test_texts_under_one_id_and_without_one(spark):
    """A cut belongs to a text, not to its id; rows without an id take part and come last."""
    rng = random.Random(5)
    words = vocabulary(rng, 3000)
    p, a, b, c = (prose(rng, 100, words) for _ in range(4))
    rows = [(1, p), (5, a + "\n" + p), (5, b), (None, c + "\n" + p), (None, b + "\n" + a), (None, c), (7, None), (None, None), (8, ""), (5, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"mark": F.lit("x"), "start": F.lit(0), "uid": F.lit(1)})
    found = paragraphs.duplicate_passages(docs)
    left = sorted(((r["doc_id"], r["text"]) for r in paragraphs.remove_paragraphs(docs, found).collect()), key=str)
    first = [r[1] for r in rows if r[0] is None and r[1] and c in r[1]]
    kept_c = [t for i, t in left if i is None and t and c in t]
    assert (1, p) in left and left.count((5, b)) == 2 and (7, None) in left and (None, None) in left and (8, "") in left
    assert [t for i, t in left if i == 5 and t != b] == [a + "\n"]
    assert len(kept_c) == 1 and kept_c[0].strip() in (c, *first) and p not in kept_c[0]
    assert not any(i is None and t and (a in t or b in t or p in t) for i, t in left)
    empty = paragraphs.duplicate_passages(docs.limit(0))
    assert empty.count() == 0 and paragraphs.remove_paragraphs(docs.limit(0), empty).count() == 0


def test_a_passage_twice_in_one_line(spark):
    rng = random.Random(8)
    words = vocabulary(rng, 3000)
    p, a, b, c = (prose(rng, 60, words) for _ in range(4))
    docs = documents(spark, [f"{a} {p} {b} {p} {c}", prose(rng, 200, words)])
    left = {r["doc_id"]: r["text"] for r in paragraphs.remove_paragraphs(docs, paragraphs.duplicate_passages(docs)).collect()}
    assert 300 - 60 <= len(left[0].split()) <= 300 - 54 and left[0].startswith(f"{a} {p} {b}") and left[0].endswith(c)


def pieces(words, classes=paragraphs.PIECES):
    hashes = paragraphs.WordHashes().of([w.encode() for w in words])
    first, _ = paragraphs.content_pieces(hashes, np.zeros(len(words), int), classes)
    return [tuple(words[a : a + paragraphs.LEAST_WORDS]) for a in first]


def test_cuts_do_not_depend_on_what_stands_around():
    rng = random.Random(2)
    words = vocabulary(rng, 3000)
    passage = prose(rng, 200, words).split()
    host = prose(rng, 70, words).split() + passage + prose(rng, 70, words).split()
    assert len(pieces(passage)) > 50 and set(pieces(passage)[1:]) <= set(pieces(host))
    assert len(pieces(["same"] * 9000)) <= 1 and pieces(["a"]) == []
    assert set(pieces(host, paragraphs.SEEDS)) <= set(pieces(host))
