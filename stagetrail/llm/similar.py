"""Near copies of whole documents: SimHash links and MinHash bands find candidates, exact Jaccard of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import WORD, components, discard, in_cells, own_exchange, per_cell, stored, text_key, texts_of
from stagetrail.llm.paragraphs import _band_keys, _uid, shingle_hashes
from stagetrail.llm.simhash import simhash_components

#: A pair at 0.8 shares one of 12 bands of 4 minima with probability 0.998, one at 0.3 with 0.09.
BANDS, ROWS = 12, 4
#: Fingerprints this many bits apart or fewer are linked, found by anchors in this many segments.
MAX_BITS, SEGMENTS = 7, 4
#: Documents of one side of a comparison cell.
CHUNK = 1024
#: Shingles hashed at once.
BLOCK = 1 << 15


def document_table(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, mark, uid, bands): one row per row of docs; mark is the text's digest, uid a hash of its lower-cased words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = np.random.default_rng(11).integers(1 << 32, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for pdf in batches:
            worded: list[list[str]] = []
            size, first = 0, 0
            for k, text in enumerate(pdf["text"]):
                worded.append(WORD.findall((text or "").lower()))
                size += len(worded[-1])
                if size >= BLOCK or k + 1 == len(pdf):
                    found = pdf[["doc_id", "mark"]].iloc[first : k + 1].reset_index(drop=True)
                    found["uid"] = [_uid(words) for words in worded]
                    found["bands"] = list(_band_keys(worded, shingle, factors, bands, rows))
                    yield found
                    worded, size, first = [], 0, k + 1

    marked = texts_of(docs).withColumn("mark", text_key("text"))
    return marked.mapInPandas(run, "doc_id long, mark binary, uid long, bands array<long>")


def _with_shingles(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(uid, hashes): the shingles of each wanted text, read again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first in range(0, len(pdf), 64):
                out = []
                for text in pdf["text"].iloc[first : first + 64]:
                    words = WORD.findall((text or "").lower())
                    out.append((_uid(words), shingle_hashes(words, shingle).tobytes()))
                yield pd.DataFrame(out, columns=["uid", "hashes"])

    marked = texts_of(docs).withColumn("mark", text_key("text"))
    read = marked.join(wanted.select(F.col("mark").alias("m")), F.col("mark") == F.col("m"), "left_semi").select("text")
    return read.mapInPandas(run, "uid long, hashes binary").dropDuplicates(["uid"])


def linked_fingerprints(docs: DataFrame, found: DataFrame, shingle: int) -> DataFrame:
    """(uid, key): the component of each text's SimHash, so that all texts whose fingerprints are linked meet under one key."""
    # Texts are known by their digest here, since ids may be null or repeated; a component is then named by one of them.
    digests = docs.select(F.xxhash64(text_key("text")).alias("doc_id"), "text")
    linked = simhash_components(digests, shingle, MAX_BITS, SEGMENTS).select(F.col("doc_id").alias("k"), "component_id").distinct()
    uids = found.select("uid", F.xxhash64("mark").alias("m")).distinct()
    return uids.join(linked, F.col("m") == F.col("k")).select("uid", F.xxhash64("component_id", F.lit(BANDS)).alias("key"))


def _verify(similarity: float):
    def compare(cell: pd.DataFrame) -> list[tuple]:
        """A spanning forest of the pairs at `similarity` or more; the sets stay arrays, since documents may be long."""
        ids = cell["uid"].to_numpy(np.int64)
        sets = [np.frombuffer(h, np.uint64) for h in cell["hashes"]]
        classes: list[list[int]] = []
        found = []
        for i, own in enumerate(sets):
            joined: list[list[int]] = []
            apart = []
            for members in classes:
                for j in members:
                    small, large = sorted((len(own), len(sets[j])))
                    if small >= similarity * large:
                        both = len(np.intersect1d(own, sets[j], assume_unique=True))
                        if both >= similarity * (small + large - both):
                            found.append((int(max(ids[i], ids[j])), int(min(ids[i], ids[j]))))
                            joined.append(members)
                            break
                else:
                    apart.append(members)
            classes = [*apart, [i, *(j for m in joined for j in m)]]
        return found

    return compare


def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """(doc_id, mark, uid, component_id, kept): one row per row of docs.

    Two texts are linked if they are equal in lower-cased words or their sets of word shingles have a Jaccard similarity
    of `similarity` or more; links of links form a component. Pairs are compared if their SimHash fingerprints are linked
    (`simhash_components`) or they share a MinHash band, which finds those whose fingerprints lie further apart. The row with the smallest doc_id is kept, of rows that
    share it (or have none) the one with the smallest text digest `mark`; a row with a doc_id goes before one without.

    Null and empty texts are equal; rows that share doc_id and text stay or go together; an empty table gives no rows;
    other columns of docs are not looked at.
    """
    found = stored(document_table(docs, shingle), "similar")
    keys = found.select("uid", F.explode("bands").alias("key"))
    keys = keys.unionByName(stored(linked_fingerprints(docs, found, shingle), "similar-fingerprints"))
    shared = keys.groupBy("key").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low <> high")
    shared = shared.select(own_exchange("key").alias("k"))
    # Keys of their own make distinct and minimum combine rows before they shuffle; the joins' partitions may be hot.
    met = keys.join(shared, F.col("key") == F.col("k"), "left_semi").select("uid", own_exchange("key").alias("key"))
    met = stored(met.distinct(), "similar-bands")
    wanted = met.select("uid").distinct().select(own_exchange("uid").alias("k"))
    wanted = found.select("uid", "mark").join(wanted, F.col("uid") == F.col("k"), "left_semi")
    wanted = wanted.withColumn("uid", own_exchange("uid")).groupBy("uid").agg(F.min("mark").alias("mark"))
    hashes = stored(_with_shingles(docs, wanted, shingle), "similar-shingles")
    held = hashes.select(own_exchange("uid").alias("u"), "hashes")
    cells = in_cells(met, "key", "uid", CHUNK).join(held, F.col("uid") == F.col("u")).drop("u")
    joined = components(per_cell(cells, "key", _verify(similarity), "a long, b long"))
    discard(met)
    discard(hashes)

    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    classes = found.groupBy("uid").agg(F.min(place).alias("at"))
    classes = classes.join(joined.select(own_exchange("node").alias("node"), "component"), F.col("uid") == F.col("node"), "left")
    classes = stored(classes.select("uid", "at", F.coalesce("component", "uid").alias("component")), "similar-classes")
    first = classes.groupBy("component").agg(F.min("at").alias("first")).select(own_exchange("component").alias("root"), "first")
    named = classes.join(first, F.col("component") == F.col("root")).select(own_exchange("uid").alias("u"), "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    return found.join(named, F.col("uid") == F.col("u")).select(
        "doc_id", "mark", "uid", F.col("first.doc_id").alias("component_id"), kept.alias("kept")
    )
