"""Substring dedup: paragraphs that repeat, exactly or nearly, found by MinHash banding and verified by exact Jaccard."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import WORD, components, discard, in_cells, own_exchange, per_cell, stored, texts_of

#: A sentence of this many words stands alone as a paragraph; runs of shorter ones stay together.
LONG_SENTENCE = 12
#: Paragraphs of fewer words are never removed.
LEAST_WORDS = 12
#: A line of this many words is also searched for passages inside it.
LONG_RUN = 24
#: Pieces start at words whose hash falls in PIECES of CLASSES classes, seeds in SEEDS of them.
PIECES, SEEDS, CLASSES = 12, 3, 24
#: What the first reading finds.
PARAGRAPH, LINE, SEED = 0, 1, 2
#: Different words whose hashes a task remembers.
KNOWN_WORDS = 1 << 18
#: Paragraphs of one side of a comparison cell.
CHUNK = 1024
#: Texts in one Arrow row group of Python results.
BATCH = 64
_SENTENCE_END = re.compile(r"(?<=[.!?…])[\x20\x09-\x0D]+")


def tune_bands(similarity: float, recall: float, most_rows: int = 8, weak: float = 0.5) -> tuple[int, int]:
    """(bands, rows): the fewest bands that find a pair at `similarity` with probability `recall`.

    Of settings with rows >= 2 the one with the fewest signatures wins that lets through at most 95 % of pairs at the
    similarity `weak`; every candidate is verified, so the choice touches recall and cost only.
    """
    for rows in range(2, most_rows + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if 1 - (1 - weak**rows) ** bands <= 0.95:
            return bands, rows
    return bands, rows


def split_paragraphs(text: str, long_sentence: int = LONG_SENTENCE) -> list[tuple[int, int]]:
    """(start, stop) of each paragraph: lines, cut before and after every sentence of `long_sentence` words or more.

    The cuts depend only on the sentence itself, so a passage copied into another text is cut there as here.
    """
    found: list[tuple[int, int]] = []
    at = 0
    for line in text.split("\n"):
        stop = at + len(line)
        if line.count(" ") < long_sentence:
            found.append((at, stop))
        else:
            open_at, begin = at, at
            for m in [*_SENTENCE_END.finditer(text, at, stop), None]:
                end, following = (m.start(), m.end()) if m else (stop, stop)
                if text.count(" ", begin, end) + 1 >= long_sentence:
                    if open_at < begin:
                        found.append((open_at, begin))
                    found.append((begin, end))
                    open_at = following
                begin = following
            if open_at < stop:
                found.append((open_at, stop))
        at = stop + 1
    return found


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word, 3)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lower_words(text: str) -> list[bytes]:
    """The words of a text in lower case; bytes are split at the six ASCII white-space characters only, as WORD does."""
    return text.lower().encode("utf-8", "surrogatepass").split()


def _word_uids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of words; the runs follow one another."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    place = (np.arange(len(hashes)) - np.repeat(starts, sizes)).astype(np.uint64)
    mixed = (hashes ^ ((place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(29)
    return (np.add.reduceat(mixed * np.uint64(0xD6E8FEB86659FD93), starts) + sizes.astype(np.uint64)).view(np.int64)


def content_pieces(hashes: np.ndarray, lines: np.ndarray, classes: int, size: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(first, uid) of the pieces of `size` words that start where the word's own hash says so, within a line.

    The choice depends on the word and the one before it, not on punctuation or what else stands around, so a copied
    passage is cut alike in every host. Of equal words in a row only the first can start a piece.
    """
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chosen = hashes % np.uint64(CLASSES) < classes
    chosen[1:] &= (hashes[1:] != hashes[:-1]) | (lines[1:] != lines[:-1])
    first = np.flatnonzero(chosen[: len(hashes) - size + 1] & (lines[: len(hashes) - size + 1] == lines[size - 1 :]))
    uid = np.full(len(first), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(size):
        uid = (uid ^ hashes[first + j]) * np.uint64(0xFF51AFD7ED558CCD)
        uid ^= uid >> np.uint64(32)
    return first, uid.view(np.int64)


def _shingles(words: list[str], size: int) -> list[str]:
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words make one shingle."""
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(s.encode("utf-8", "surrogatepass")) for s in _shingles(words, size)], np.uint64))


def _uid(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"), 1) - (1 << 63)


def _band_keys(paragraphs: list[list[str]], size: int, factors: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraph, band): the band's number and minima mixed to a long, for many paragraphs at once."""
    digest, found, starts = xxhash.xxh3_64_intdigest, [], []
    for words in paragraphs:
        starts.append(len(found))
        found += [digest(s.encode("utf-8", "surrogatepass")) for s in _shingles(words, size)]
    hashes = np.array(found, np.uint64)
    keys = np.empty((len(paragraphs), bands), np.int64)
    for band in range(bands):
        key = np.full(len(paragraphs), band, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(rows):
            mixed = hashes * factors[band * rows + r]
            mixed ^= mixed >> np.uint64(29)
            key = (key ^ np.minimum.reduceat(mixed, starts)) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(32)
        keys[:, band] = key.view(np.int64)
    return keys


def _mark() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark): a row is known by doc_id and mark, so that texts that share an id, or have none, stay apart.

    Ids go to Python as texts, because pandas has no null among integers.
    """
    return texts_of(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text", _mark().alias("mark"))


def _place() -> F.Column:
    """The order of paragraphs: by doc_id, rows without one last, then the text's hash, then the place in it."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "start", "length")


def _same_row(id_column: str, mark_column: str) -> F.Column:
    return F.col("doc_id").eqNullSafe(F.col(id_column)) & (F.col("mark") == F.col(mark_column))


def mixed_shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` words from every place on, of the words' own hashes."""
    found = np.full(max(0, len(hashes) - size + 1), 0x9E3779B97F4A7C15, np.uint64)
    for j in range(size):
        found = (found ^ hashes[j : len(hashes) - size + 1 + j]) * np.uint64(0xFF51AFD7ED558CCD)
        found ^= found >> np.uint64(32)
    return found


def _keys(hashes: np.ndarray, sizes: np.ndarray, shingle: int, factors: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraph, band): the band's number and minima mixed to a long; the paragraphs' words follow one another."""
    every = mixed_shingles(hashes, shingle)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    within = np.ones(len(hashes), bool)
    for j in range(1, shingle):
        within[starts[1:] - j] = False
    own = every[within[: len(every)]]
    firsts = np.concatenate([[0], np.cumsum(sizes - shingle + 1)[:-1]]).astype(np.int64)
    keys = np.empty((len(sizes), bands), np.int64)
    for band in range(bands):
        key = np.full(len(sizes), band, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(rows):
            mixed = own * factors[band * rows + r]
            mixed ^= mixed >> np.uint64(29)
            key = (key ^ np.minimum.reduceat(mixed, firsts)) * np.uint64(0xFF51AFD7ED558CCD)
            key ^= key >> np.uint64(32)
        keys[:, band] = key.view(np.int64)
    return keys


def read_once(docs: DataFrame, bands: int, rows: int, shingle: int, least_words: int) -> DataFrame:
    """(kind, doc_id, mark, start, length, words, uid, line, bands): paragraphs, long lines, and seeds, each text read once.

    mark is a hash of the whole text, uid one of the lower-cased words of the paragraph, line or seed; equal uids are
    exact copies. Seeds, pieces at one in eight words of long lines, have only the uid of their line; a seed that its line
    has twice has another one, so that it counts as shared.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = np.random.default_rng(7).integers(1 << 32, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        known = WordHashes()
        for pdf in batches:
            for first in range(0, len(pdf), BATCH):
                part = pdf.iloc[first : first + BATCH]
                found: list[tuple] = []
                lines: list[tuple] = []
                words: list[bytes] = []
                for k, text in enumerate(part["text"]):
                    text = text or ""
                    line_at, line_words = 0, len(words)
                    for start, stop in split_paragraphs(text):
                        if start > line_at and text[start - 1] == "\n":
                            lines.append((k, line_at, line_words, len(words)))
                            line_at, line_words = start, len(words)
                        own = lower_words(text[start:stop])
                        if len(own) >= least_words:
                            found.append((k, start, stop - start, len(own), len(words)))
                        words += own
                    lines.append((k, line_at, line_words, len(words)))
                if not words:
                    continue
                hashes = known.of(words)
                if found:
                    k, start, length, size, at = (np.array(c, np.int64) for c in zip(*found, strict=True))
                    own = hashes[np.repeat(at - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
                    out = pd.DataFrame({"kind": PARAGRAPH, **_ids(part, k), "start": start, "length": length, "words": size, "line": None})
                    out["uid"] = _word_uids(own, size)
                    out["bands"] = list(_keys(own, size, shingle, factors, bands, rows))
                    yield out
                k, start, begin, end = np.array([r for r in lines if r[3] - r[2] >= LONG_RUN], np.int64).reshape(-1, 4).T
                if not len(k):
                    continue
                size = end - begin
                own = hashes[np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
                uid = _word_uids(own, size)
                yield pd.DataFrame({"kind": LINE, **_ids(part, k), "start": start, "length": None, "words": size, "uid": uid, "line": None, "bands": None})
                number = np.repeat(np.arange(len(size)), size)
                at, seed = content_pieces(own, number, SEEDS)
                out = pd.DataFrame({"number": number[at], "uid": seed})
                out["line"] = uid[out.pop("number")] + pd.DataFrame({"number": number[at], "uid": seed}).duplicated()
                yield out.assign(kind=SEED, doc_id=None, mark=None, start=None, length=None, words=None, bands=None)

    schema = "kind int, doc_id long, mark long, start int, length int, words int, uid long, line long, bands array<long>"
    return _marked(docs).mapInPandas(run, schema)


class LongLines:
    """The words of some lines of some texts one after another: hash, number of the line, number of the text, place."""

    def __init__(self, texts: Iterable[str], starts: Iterable, known: WordHashes) -> None:
        words: list[bytes] = []
        found: list[tuple] = []
        self.spans: list[tuple[int, int]] = []
        for k, (text, wanted) in enumerate(zip(texts, starts, strict=True)):
            for start in sorted(wanted.tolist()) if wanted is not None else ():
                stop = text.find("\n", start)
                line = text[start : stop if stop >= 0 else len(text)]
                own = lower_words(line)
                words += own
                found.append((len(own), k))
                self.spans += [(start + a, start + b) for a, b in (m.span() for m in WORD.finditer(line))]
        sizes, owners = np.array(found, np.int64).reshape(-1, 2).T
        self.hashes = known.of(words)
        self.lines, self.owners = (np.repeat(x, sizes) for x in (np.arange(len(sizes)), owners))


def _ids(pdf: pd.DataFrame, rows: np.ndarray) -> dict:
    """doc_id and mark of the rows; pandas takes a null among integers only with a mask."""
    none = pdf["doc_id"].isna().to_numpy()
    ids = pdf["doc_id"].where(~none, "0").astype(np.int64).to_numpy()
    return {"doc_id": pd.arrays.IntegerArray(ids[rows], none[rows]), "mark": pdf["mark"].to_numpy()[rows]}


def read_again(docs: DataFrame, wanted: DataFrame, lines: DataFrame, shingle: int) -> DataFrame:
    """Rows (uid, hashes): the shingles of each wanted paragraph; rows (doc_id, mark, start, length, uid, parents): the
    pieces of the lines that share a seed, parents being the starts of the paragraphs they lie in.

    The only step that moves texts.
    """
    spans = wanted.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("uid", "start", "length")).alias("spans"))
    starts = lines.groupBy("doc_id", "mark").agg(F.collect_set("start").alias("lines"))
    keys = [F.col("doc_id").alias("d"), F.col("mark").alias("m")]
    asked = spans.select(*keys, "spans", F.lit(None).cast("array<int>").alias("lines"))
    asked = asked.unionByName(starts.select(*keys, F.lit(None).cast("array<struct<uid:long,start:int,length:int>>").alias("spans"), "lines"))
    asked = asked.groupBy("d", "m").agg(F.max("spans").alias("spans"), F.max("lines").alias("lines"))
    asked = stored(asked.select(own_exchange("d").alias("d"), own_exchange("m").alias("m"), "spans", "lines"), "asked")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for pdf in batches:
            for first in range(0, len(pdf), BATCH):
                part = pdf.iloc[first : first + BATCH]
                sets = []
                for text, spans in zip(part["text"], part["spans"], strict=True):
                    for s in spans if spans is not None else ():
                        hashes = known.of(lower_words(text[s["start"] : s["start"] + s["length"]]))
                        sets.append((s["uid"], np.unique(mixed_shingles(hashes, shingle)).tobytes()))
                if sets:
                    found = pd.DataFrame(sets, columns=["uid", "hashes"])
                    yield found.assign(doc_id=None, mark=None, start=None, length=None, parents=None)
                lines = LongLines(part["text"], part["lines"], known)
                at, uid = content_pieces(lines.hashes, lines.lines, PIECES)
                if not len(at):
                    continue
                owners, places = lines.owners[at], np.array(lines.spans, np.int64)
                start, stop = places[at, 0], places[at + LEAST_WORDS - 1, 1]
                begins = [np.array([a for a, _ in split_paragraphs(text)], np.int64) + (k << 32) for k, text in enumerate(part["text"])]
                begins = np.concatenate(begins)
                low = np.searchsorted(begins, start + (owners << 32), "right") - 1
                high = np.searchsorted(begins, stop - 1 + (owners << 32), "right")
                begins &= 0xFFFFFFFF
                found = pd.DataFrame({"uid": uid, **_ids(part, owners), "start": start, "length": stop - start})
                found["parents"] = [begins[a:b] for a, b in zip(low, high, strict=True)]
                found["hashes"] = None
                yield found

    read = texts_of(docs).withColumn("mark", _mark()).join(asked, _same_row("d", "m"))
    read = read.select(F.col("doc_id").cast("string").alias("doc_id"), "mark", "text", "spans", "lines")
    return read.mapInPandas(run, "uid long, hashes binary, doc_id long, mark long, start int, length int, parents array<int>")


def _verify(similarity: float):
    def compare(cell: pd.DataFrame) -> list[tuple]:
        """A spanning forest of the pairs at `similarity` or more; pairs already connected are not compared again."""
        ids = cell["uid"].to_numpy(np.int64)
        sets = [set(np.frombuffer(h, np.uint64).tolist()) for h in cell["hashes"]]
        classes: list[list[int]] = []
        found = []
        for i, own in enumerate(sets):
            joined: list[list[int]] = []
            apart = []
            for members in classes:
                for j in members:
                    small, large = (len(own), len(sets[j])) if len(own) < len(sets[j]) else (len(sets[j]), len(own))
                    if small >= similarity * large:
                        both = len(own & sets[j])
                        if both >= similarity * (small + large - both):
                            found.append((int(max(ids[i], ids[j])), int(min(ids[i], ids[j]))))
                            joined.append(members)
                            break
                else:
                    apart.append(members)
            classes = [*apart, [i, *(j for m in joined for j in m)]]
        return found

    return compare


def _shared_lines(reading: DataFrame) -> DataFrame:
    """(doc_id, mark, start): the first place of each long line that shares a seed with a line of other words."""
    seeds = reading.where(F.col("kind") == SEED).select("uid", "line")
    shared = seeds.groupBy("uid").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low <> high")
    shared = stored(shared.select("uid"), "seeds").select(own_exchange("uid").alias("u"))
    met = seeds.join(shared, F.col("uid") == F.col("u"), "left_semi").select(own_exchange("line").alias("line")).distinct()
    lines = reading.where(F.col("kind") == LINE).drop("line").join(met, F.col("uid") == F.col("line"), "left_semi")
    return lines.groupBy(own_exchange("uid").alias("uid")).agg(F.min(_place()).alias("at")).select("at.doc_id", "at.mark", "at.start")


def duplicate_paragraphs(docs: DataFrame, **options) -> DataFrame:
    """The rows of `duplicate_passages` for whole paragraphs only."""
    return duplicate_passages(docs, inside=False, **options)


def duplicate_passages(
    docs: DataFrame,
    similarity: float = 0.8,
    shingle: int = 5,
    recall: float = 0.995,
    least_words: int = LEAST_WORDS,
    inside: bool = True,
) -> DataFrame:
    """(doc_id, mark, start, length, words, component, copies, exact, keep_doc_id, kept): every passage that has a copy.

    A paragraph is a line, or a long sentence or run of short ones within a long line. Two are linked if they are equal
    in lower-cased words or their sets of five-word shingles have a Jaccard similarity of 0.8 or more; links of links
    form a component, whose first paragraph (smallest doc_id, then mark, then start) is kept; exact ones have the same
    words as it. Paragraphs without a copy, and those shorter than `least_words`, are not listed. start counts characters
    of the text, mark is a hash of it.

    A passage inside another line is part of a paragraph that has no copy. Lines of LONG_RUN words or more that share a
    seed with a line of other words, or have it twice, are searched again, the first of equal lines only: a seed is a run of
    12 words that starts at one in eight words, chosen by the word itself, a piece starts at every other word; equal pieces (in lower-cased words) are copies, the first of which is kept. Pieces that
    touch a paragraph that goes as a near copy are left, because its words need not stand elsewhere. Pieces overlap, so a
    passage is found but for the words before its first start and after its last piece, two on the average. A piece goes
    only for one that stands before it, so every word stays somewhere.

    Null and empty texts have no paragraphs. A row is known by doc_id and mark: rows that share both are treated alike,
    other texts under the same id, or without an id, are documents of their own; those without one come last. An empty
    table gives no rows; other columns are ignored.
    """
    if least_words < shingle:
        raise ValueError("a paragraph needs the words of a shingle")
    bands, rows = tune_bands(similarity, recall)
    reading = stored(read_once(docs, bands, rows, shingle, least_words), "first-reading")
    first = F.min(_place())
    paragraphs = reading.where(F.col("kind") == PARAGRAPH)
    keys = paragraphs.select("uid", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low <> high")
    shared = shared.select(own_exchange("key").alias("k"))
    # Keys of their own make distinct and minimum combine rows before they shuffle; the joins' partitions may be hot.
    met = keys.join(shared, F.col("key") == F.col("k"), "left_semi").select("uid", own_exchange("key").alias("key"))
    met = stored(met.distinct(), "paragraph-bands")
    found = stored(paragraphs.drop("kind", "line", "bands"), "paragraphs")
    lines = stored(_shared_lines(reading.where(F.lit(inside))), "seed-lines")
    discard(reading)
    wanted = met.select("uid").distinct().select(own_exchange("uid").alias("k"))
    wanted = found.select("uid", "doc_id", "mark", "start", "length").join(wanted, F.col("uid") == F.col("k"), "left_semi")
    wanted = wanted.withColumn("uid", own_exchange("uid")).groupBy("uid").agg(first.alias("at")).select("uid", "at.*")
    again = stored(read_again(docs, wanted, lines, shingle), "second-reading")
    hashes = again.where("hashes is not null").dropDuplicates(["uid"])
    held = hashes.select(own_exchange("uid").alias("u"), "hashes")
    cells = in_cells(met, "key", "uid", CHUNK).join(held, F.col("uid") == F.col("u")).drop("u")
    joined = components(per_cell(cells, "key", _verify(similarity), "a long, b long"))
    discard(met)

    classes = found.groupBy("uid").agg(F.count("*").alias("n"), first.alias("at"))
    classes = classes.join(joined.select(own_exchange("node").alias("node"), "component"), F.col("uid") == F.col("node"), "left")
    classes = stored(classes.select("uid", "n", "at", F.coalesce("component", "uid").alias("component")), "paragraph-classes")
    groups = classes.groupBy("component").agg(F.sum("n").alias("copies"), F.min(F.struct("at", "uid")).alias("first")).where("copies > 1")
    groups = groups.select(own_exchange("component").alias("root"), "copies", F.col("first.at").alias("keep"), F.col("first.uid").alias("like"))
    named = classes.join(groups, F.col("component") == F.col("root"))
    named = named.select(own_exchange("uid").alias("u"), "component", "copies", "keep", (F.col("uid") == F.col("like")).alias("exact"))
    kept = _place().eqNullSafe(F.col("keep"))
    whole = found.join(named, F.col("uid") == F.col("u")).select(
        "doc_id", "mark", "start", "length", "words", "component", "copies", "exact", F.col("keep.doc_id").alias("keep_doc_id"), kept.alias("kept")
    )
    if not inside:
        return whole

    whole = stored(whole, "passages")
    discard(found)
    pieces = again.where("hashes is null").withColumn("words", F.lit(LEAST_WORDS))
    gone = whole.where("not kept and not exact").groupBy("doc_id", "mark").agg(F.collect_set("start").alias("gone"))
    gone = gone.select(own_exchange("doc_id").alias("d"), own_exchange("mark").alias("m"), "gone")
    shared = stored(pieces.groupBy("uid").agg(F.count("*").alias("n")).where("n > 1").select("uid"), "pieces")
    pieces = pieces.join(shared.select(own_exchange("uid").alias("u")), F.col("uid") == F.col("u"), "left_semi").join(gone, _same_row("d", "m"), "left")
    pieces = pieces.where(F.col("gone").isNull() | ~F.arrays_overlap("parents", "gone"))
    pieces = stored(pieces.select("doc_id", "mark", "start", "length", "words", own_exchange("uid").alias("component")), "pieces-met")
    discard(again)
    groups = pieces.groupBy("component").agg(F.count("*").alias("copies"), first.alias("keep")).where("copies > 1")
    named = pieces.join(groups.select(own_exchange("component").alias("c"), "copies", "keep"), F.col("component") == F.col("c"))
    return whole.unionByName(named.select(*whole.columns[:7], F.lit(True).alias("exact"), F.col("keep.doc_id").alias("keep_doc_id"), kept.alias("kept")))


def remove_paragraphs(docs: DataFrame, duplicates: DataFrame) -> DataFrame:
    """docs without the paragraphs and pieces of `duplicates` that are not kept, n_chars set anew if there is such a column.

    A cut belongs to the rows with its doc_id and mark (a hash of the text): another text under the same id, or without
    one, is left alone. A document left with no word although it had some is dropped; all others stay, unchanged if
    nothing is removed, null and empty texts too. Repeated rows are cut alike; an empty table gives no rows; all columns
    of docs are kept as they are.
    """
    cut = duplicates.where("not kept").groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("_cut"))

    @F.pandas_udf("string")
    def without(text: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, cuts, strict=True):
            if t is None or spans is None:
                out.append(None)
                continue
            at, kept = 0, []
            for s in spans:
                kept.append(t[at : s["start"]])
                at, before = max(at, s["start"] + s["length"]), at
                if at == before:
                    continue
                if t[at : at + 1] == "\n" and (not s["start"] or t[s["start"] - 1] == "\n"):
                    at += 1
            out.append("".join([*kept, t[at:]]))
        return pd.Series(out)

    columns = docs.columns
    cut = stored(cut, "paragraph-cuts").select(own_exchange("doc_id").alias("_cut_id"), own_exchange("mark").alias("_cut_mark"), "_cut")
    own = docs["doc_id"].cast("long").eqNullSafe(F.col("_cut_id")) & (_mark() == F.col("_cut_mark"))
    joined = docs.join(cut, own, "left")
    joined = joined.withColumn("_short", without(F.when(F.col("_cut").isNotNull(), F.col("text")), "_cut"))
    left = joined.where(F.col("_cut").isNull() | (F.length(F.regexp_replace("_short", r"[\x20\x09-\x0D]+", "")) > 0))
    left = left.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.col("_short")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return left.select(columns)
