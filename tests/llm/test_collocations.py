"""Collocations against counting by hand, with hot leading words and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import documents, vocabulary
from pyspark.sql import functions as F

from stagetrail.llm import collocations as op


def brute(rows, least, depth, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for d in range(1, min(depth, len(words) - i) + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + d])] += 1
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in held.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in held.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def run(df, **options):
    return sorted(tuple(r) for r in op.collocations(df, **options).collect())


def prose(seed, n):
    rng = random.Random(seed)
    words = vocabulary(rng, 25)
    fixed = [" ".join(rng.choice(words) for _ in range(k)) for k in (2, 3, 4, 5, 6, 9)]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) + rng.choice(["", "", "", ",", ". ", "\n", "\t", "  "]) for _ in range(60)]
        out.append((rng.choice(["en", "de", None]), " ".join(parts)))
    return out


@pytest.mark.parametrize("group,buckets,buffer", [(1 << 14, 24, 1 << 17), (6, 16, 50), (6, 3, 1 << 17)])
def test_against_brute_force(spark, monkeypatch, group, buckets, buffer):
    """With groups of six, leads are hot at every depth; with eight counters, every pair passes."""
    monkeypatch.setattr(op, "GROUP", group)
    monkeypatch.setattr(op, "BUCKETS_LOG2", buckets)
    monkeypatch.setattr(op, "CHUNK", min(op.CHUNK, 1 << buckets))
    monkeypatch.setattr(op, "BUFFER", buffer)
    monkeypatch.setattr(op, "BLOCK", 500)
    rows = prose(4, 90)
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    docs = docs.withColumns({c: F.lit("x") for c in ("phrase", "a", "l", "n", "lead", "known", "_l", "k", "words", "score", "chunk")})
    want = brute(rows, 5, 5, 40)
    assert len(want) > 60 and any(len(w[2].split()) == 5 for w in want)
    assert run(docs, least=5, depth=5, top=40) == want


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, "a b"), (None, "A\tb. a  b"), ("en", "x.y,z"), ("fr", " \n\r\x0b"), ("en", "é\x00 É é\x00 É"), ("und", "a b a b a b")]
    rows += [("de", "same same " * 9000)] + [("es", "p q r s t u")] * 5
    docs = spark.createDataFrame([(None, t, g) for g, t in rows], "doc_id long, text string, lang string")
    assert run(docs, least=2, depth=5, top=3) == brute(rows, 2, 5, 3)
    assert run(documents(spark, []), least=2) == []


def test_quicksort_counts_weighted_prefixes():
    rng = np.random.default_rng(2)
    table, weights = rng.integers(0, 4, (400, 4)), rng.integers(1, 6, 400)
    table = table * np.cumprod(table > 0, axis=1)
    want = Counter()
    for row, w in zip(table.tolist(), weights.tolist(), strict=True):
        for d in range(1, 5):
            if row[d - 1]:
                want[tuple(row[:d])] += w
    got = {tuple(table[r, :d].tolist()): n for r, d, n in op.quicksort(table, weights, 20)}
    assert got == {p: n for p, n in want.items() if n >= 20}


def suffixes_of(spark, monkeypatch, texts, least):
    """The suffixes that were handed on while the phrases of the texts were counted."""
    kept = []

    def stored(df, name):
        out = op_stored(df, name)
        if name == "suffixes":
            kept.extend(r["suffix"] for r in out.select("suffix").collect())
        return out

    op_stored = op.stored
    monkeypatch.setattr(op, "stored", stored)
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    op.frequent_phrases(docs, least, 5)
    return kept


def test_suffixes_end_where_no_longer_phrase_can_be_frequent(spark, monkeypatch):
    """Each of 64 triples comes about 60 times, each of 256 four-word phrases about 15 times."""
    rng = random.Random(1)
    texts = [rng.choices("abcd", k=400) for _ in range(10)]
    f = Counter(" ".join(t[i : i + d]) for t in texts for d in range(2, 6) for i in range(len(t) - d + 1))
    found = suffixes_of(spark, monkeypatch, [" ".join(t) for t in texts], 30)
    assert len(found) == len(set(found)) >= 60
    assert min(f[p] for p in found) >= 30


def test_rare_pairs_rarely_pass_for_frequent_ones(spark, monkeypatch):
    """One counter in 50 is frequent: of 5000 rare pairs about 100 share one such, about two share both."""
    monkeypatch.setattr(op, "BUCKETS_LOG2", 10)
    monkeypatch.setattr(op, "CHUNK", 1 << 10)
    texts = [". ".join(f"f{i} g{i}" for i in range(20))] * 100 + [". ".join(f"r{i} s{i}" for i in range(k, k + 50)) for k in range(0, 5000, 50)]
    found = suffixes_of(spark, monkeypatch, texts, 100)
    assert {f"f{i} g{i}" for i in range(20)} <= set(found)
    assert len(found) < 20 + 15


def test_tasks_that_read_the_texts_do_not_grow_with_the_input(spark):
    docs = spark.createDataFrame([("a b", "en")] * 400, "text string, lang string").repartition(200)
    assert op._texts(docs).rdd.getNumPartitions() <= op.TASKS_A_CORE * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("vocabulary", [400, 60])
def test_words_are_forgotten_between_batches(spark, monkeypatch, vocabulary):
    """Held suffixes are kept in a smaller vocabulary, or handed on where that is too large still."""
    monkeypatch.setattr(op, "VOCABULARY", vocabulary)
    monkeypatch.setattr(op, "ROWS_PER_BATCH", 10)
    rows = [(g, f"{t} " + " ".join(f"rare{i}x{j}" for j in range(40))) for i, (g, t) in enumerate(prose(6, 80))]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert run(docs, least=5, depth=5, top=40) == brute(rows, 5, 5, 40)


def test_only_keeps_the_words_of_a_table():
    words = op.Vocabulary("en")
    numbers = words.numbers([b"a b c d", b"e b"])
    table = np.array([[numbers[1], numbers[3], 0], [numbers[5], numbers[1], numbers[3]]])
    fresh, renumbered = words.only(table)
    assert [[fresh.words[w] for w in row] for row in renumbered.tolist()] == [[b"b", b"d", b""], [b"e", b"b", b"d"]]
    assert len(fresh.words) == 4 and fresh.lang == "en"
