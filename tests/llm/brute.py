"""Small plain-Python versions the operators are held against."""

from __future__ import annotations

import random
import re

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def classes(nodes, linked):
    """Smallest node of each node's class under the pairs that `linked` accepts."""
    nodes = list(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def fingerprint(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(rng: random.Random, n: int = 400) -> list[str]:
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def documents(spark, texts, extra=False):
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        names = ("fp", "uid", "a", "b", "k", "n", "size", "head", "component", "start", "length", "whole", "full", "host", "language", "list", "cell", "rank")
        docs = docs.withColumns({c: F.lit("x") for c in names})
    return docs
