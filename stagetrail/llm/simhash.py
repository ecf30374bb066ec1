"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import WORD, components, discard, forest, in_cells, own_exchange, per_cell, stored, texts_of

SEED = 42
BITS = 64
#: Shingles whose bits are counted at once, so that a very long text needs no more memory than this.
BLOCK = 1 << 14
#: Rows of one side of a comparison cell.
CHUNK = 4096
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, words: int) -> int:
    """64 bits; a bit is 1 if it is set in over half the hashes of the text's shingles, repeats included.

    A text with fewer words than a shingle has one shingle of all its words; null and empty texts give 0.
    """
    found = WORD.findall((text or "").translate(_LOWER))
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        stop = min(n, start + BLOCK)
        hashes = np.fromiter((digest(" ".join(found[i : i + words]).encode("utf-8", "surrogatepass"), SEED) for i in range(start, stop)), "<u8", stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp): one row per row of docs; fp is the fingerprint's bits as a signed long."""

    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return texts_of(docs).select("doc_id", marked("text").alias("fp"))


class Cover:
    """The product of perfect (7,4) Hamming codes over one segment of the 64 bits; left-over bits are kept as they are.

    Each part of seven bits lies within one bit of exactly one codeword, so the covering radius is the number of parts
    and the nearest anchor is unique.
    """

    def __init__(self, first: int, width: int):
        self.first, self.width, self.parts = first, width, width // 7
        words = [w for w in range(128) if self._syndrome(w) == 0]
        self.nearest = np.array([min(range(16), key=lambda k, x=x: (x ^ words[k]).bit_count()) for x in range(128)], np.int64)

    @staticmethod
    def _syndrome(word: int) -> int:
        out = 0
        for i in range(7):
            if word >> i & 1:
                out ^= i + 1
        return out

    def anchor(self, fps: np.ndarray) -> np.ndarray:
        """The nearest anchor of each fingerprint's segment."""
        segment = (fps >> np.uint64(self.first)) & np.uint64((1 << self.width) - 1)
        out = (segment >> np.uint64(7 * self.parts)).astype(np.int64)
        for p in range(self.parts):
            out = out << 4 | self.nearest[((segment >> np.uint64(7 * p)) & np.uint64(127)).astype(np.int64)]
        return out

    def anchors(self, fps: np.ndarray, radius: int) -> np.ndarray:
        """A row per fingerprint: every anchor within the covering radius plus `radius` whose cell reaches into its ball."""
        flips = [0] + [sum(1 << (self.first + i) for i in c) for r in range(1, radius + 1) for c in combinations(range(self.width), r)]
        return np.stack([self.anchor(fps ^ np.uint64(f)) for f in flips], axis=1)


def covers(segments: int) -> list[Cover]:
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [Cover(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def anchored(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(anchor, fp, home): each fingerprint at its nearest anchor (home) and at every other anchor it must be sent to.

    Of `segments` segments one differs in at most max_bits // segments bits. There the pair meets at the home anchor of
    one of the two, because the other lies within that many bits and so sends a copy to it.
    """
    codes, radius = covers(segments), max_bits // segments

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf["fp"].to_numpy(np.int64)
            for k, code in enumerate(codes):
                sent = code.anchors(values.view(np.uint64), radius)
                home = sent[:, 0]
                sent = np.sort(sent, axis=1)
                new = np.ones(sent.shape, bool)
                new[:, 1:] = sent[:, 1:] != sent[:, :-1]
                row, _ = np.nonzero(new)
                anchor = sent[new]
                yield pd.DataFrame({"anchor": anchor | np.int64(k) << 48, "fp": values[row], "home": anchor == home[row]})

    return fps.select("fp").mapInPandas(run, "anchor long, fp long, home boolean")


def _compare(max_bits: int):
    def compare(cell: pd.DataFrame) -> list[tuple]:
        fps = cell["fp"].to_numpy(np.int64).view(np.uint64)
        homes = np.flatnonzero(cell["home"].to_numpy(bool))
        labels = np.arange(len(fps))
        linked = False
        for start in range(0, len(homes), 256):
            block = homes[start : start + 256]
            near = np.bitwise_count(fps[block][:, None] ^ fps[None, :]) <= max_bits
            for row in np.flatnonzero(near.sum(axis=1) > 1):
                met = np.unique(labels[near[row]])
                if len(met) > 1:
                    labels[np.isin(labels, met[1:])] = met[0]
                    linked = True
        return forest(labels, fps.view(np.int64)) if linked else []

    return compare


def simhash_components(docs: DataFrame, words: int = 4, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links of max_bits or fewer bits.

    Equal fingerprints are one node whatever their number; within an anchor only a spanning forest of the links leaves
    the task, and anchors with many fingerprints are cut into cells. One row per row of docs: null texts have
    fingerprint 0, a null doc_id keeps its row and never names a component unless no other doc_id is in it, repeated
    rows share their component, an empty table gives no rows, other columns of docs are not looked at.
    """
    marked = stored(fingerprints(docs, words), "simhash")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = stored(nodes, "simhash-nodes")
    sent = stored(anchored(nodes, max_bits, segments), "simhash-anchors")
    joined = components(per_cell(in_cells(sent, "anchor", "fp", CHUNK), "anchor", _compare(max_bits), "a long, b long"))
    discard(sent)
    known = nodes.join(joined.select(own_exchange("node").alias("node"), "component"), F.col("fp") == F.col("node"), "left")
    known = stored(known.select("fp", "least", F.coalesce("component", "fp").alias("component")), "simhash-classes")
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(smallest.select(own_exchange("component").alias("root"), "component_id"), F.col("component") == F.col("root"))
    named = named.select(own_exchange("fp").alias("node"), "component_id")
    return marked.join(named, F.col("fp") == F.col("node")).select("doc_id", "fp", "component_id")
