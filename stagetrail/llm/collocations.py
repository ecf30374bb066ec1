"""Phrases that occur together: suffixes routed by leading words, counted by multikey quicksort, scored exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagetrail.llm.common import ROWS_PER_BATCH, discard, own_text, stored

#: Bytes that end a piece, and those between words.
PIECE_ENDS, SPACES = b".,;:!?\n\v\f\r", b"\x20\t"
#: Counters of one kind; each task holds one byte for each, the driver one bit. Kinds: word pairs, pairs by another hash,
#: triples, and phrases of four to COUNTED words together.
BUCKETS_LOG2, KINDS, COUNTED = 24, 4, 5
#: Tasks a core that read the texts: each hands on its own counters and its own count of every frequent suffix.
TASKS_A_CORE = 2
#: Counters in one row of the shuffle.
CHUNK = 1 << 14
#: Words a task knows at once before it hands on their counts.
VOCABULARY = 1 << 17
#: Words looked at together, and suffixes sorted together.
BLOCK, BUFFER = 1 << 18, 1 << 17
#: Different suffixes a task adds up before it hands them on.
HELD = 1 << 19
#: Suffixes with the same leading words that one task may get.
GROUP = 1 << 14

_CLEAN = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")
_END, _NONE = 0, -1


class Vocabulary(dict):
    """Words of one language numbered as they come; 0 is the end of a piece."""

    def __init__(self, lang: str) -> None:
        super().__init__({b"\n": _END, b"": _NONE})
        self.lang = lang
        self.words: list[bytes] = [b""]
        self.hashes: list[int] = [0]
        self.seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
        self._array = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return number

    def numbers(self, texts: list[bytes]) -> np.ndarray:
        """The words of the texts, with an end after every piece."""
        tokens = b"\n".join([*texts, b""]).lower().translate(_CLEAN).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
        return found[found != _NONE]

    def buckets(self, numbers: np.ndarray, log2: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """(size, the counter of the `size` words from each place on, -1 where a piece ends in between) for each size.

        There are 2^log2 counters of each kind, one kind after the other; pairs have one of either kind.
        """
        if len(self._array) < len(self.words):
            self._array = np.array(self.hashes, np.uint64)
        h, whole = self._array[numbers], numbers != _END
        mixed, mask, kind = h * np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << log2) - 1), 0
        for j in range(1, longest):
            places = max(0, len(numbers) - j)
            mixed, whole = mixed[:places], whole[:places] & (numbers[j:] != _END)
            mixed ^= h[j:] * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xFF51AFD7ED558CCD)
            for k in range(1, 3 if j == 1 else 2):
                at = (mixed >> np.uint64(64 - k * log2) & mask).astype(np.int32) + np.int32(min(kind, KINDS - 1) << log2)
                yield j + 1, np.where(whole, at, np.int32(-1))
                kind += 1

    def only(self, table: np.ndarray) -> tuple[Vocabulary, np.ndarray]:
        """A vocabulary of only the words of the table, and the table in its numbers."""
        fresh, used = Vocabulary(self.lang), np.unique(table)
        number = np.zeros(len(self.words), table.dtype)
        for w in used[used != _END].tolist():
            number[w] = fresh[self.words[w]]
        return fresh, number[table]


def _blocks(batches: Iterator[pa.RecordBatch], known: dict[str, Vocabulary]) -> Iterator[tuple[str, np.ndarray]]:
    """(language, numbers of words) of texts of one language, some at a time; a text is never cut."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) // 6
            if sizes[lang] >= BLOCK:
                yield lang, known.setdefault(lang, Vocabulary(lang)).numbers(held.pop(lang))
                del sizes[lang]
        for lang, texts in held.items():
            yield lang, known.setdefault(lang, Vocabulary(lang)).numbers(texts)


def _texts(docs: DataFrame) -> DataFrame:
    """(lang, text) in a number of tasks that the cores set, not the size of the input: a task's memory is bounded anyway."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return texts.coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def _counters(depth: int) -> int:
    return min(KINDS, max(2, depth)) << BUCKETS_LOG2


def _leading(docs: DataFrame, least: int, depth: int) -> DataFrame:
    """Rows (lang, word, n) of words, and rows (chunk, counters) of one kind after the other, from one reading of the texts."""
    schema = "lang string, word binary, n long, chunk int, counters binary"
    limit, size = min(least, 255), _counters(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Vocabulary] = {}
        counts: dict[str, np.ndarray] = {}
        counters = np.zeros(size, np.uint8)

        def words() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                held = np.flatnonzero(n[1:]) + 1
                own = [known[lang].words[i] for i in held]
                nothing = pa.nulls(len(own))
                columns = [pa.array([lang] * len(own), pa.string()), pa.array(own, pa.binary()), pa.array(n[held], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, nothing.cast(pa.int32()), nothing.cast(pa.binary())], ["lang", "word", "n", "chunk", "counters"])
            known.clear()
            counts.clear()

        for lang, numbers in _blocks(batches, known):
            own = known[lang]
            n = np.bincount(numbers, minlength=len(own.words))
            before = counts.get(lang)
            if before is not None:
                n[: len(before)] += before
            counts[lang] = n
            for _, at in own.buckets(numbers, BUCKETS_LOG2, min(depth, COUNTED)):
                at, times = np.unique(at[at >= 0], return_counts=True)
                counters[at] = np.minimum(counters[at] + np.minimum(times, limit), limit)
            if sum(len(v.words) for v in known.values()) > VOCABULARY:
                yield from words()
        yield from words()
        for first in range(0, len(counters), CHUNK * 64):
            rows = [(c, counters[c * CHUNK : (c + 1) * CHUNK]) for c in range(first // CHUNK, min(first // CHUNK + 64, len(counters) // CHUNK))]
            rows = [(c, x.tobytes()) for c, x in rows if x.any()]
            nothing = pa.nulls(len(rows))
            columns = [nothing.cast(pa.string()), nothing.cast(pa.binary()), nothing.cast(pa.int64())]
            columns += [pa.array([c for c, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n", "chunk", "counters"])

    return _texts(docs).mapInArrow(run, schema)


def _frequent_buckets(leading: DataFrame, least: int, depth: int) -> bytes:
    """One bit per counter that reached `least`: 2^BUCKETS_LOG2 / 8 bytes a kind, whatever the input."""
    limit = min(least, 255)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(CHUNK, np.uint16)
        for batch in batches:
            found = []
            for chunk, counters in zip(batch.column("chunk").to_pylist(), batch.column("counters").to_pylist(), strict=True):
                if chunk != at and at is not None:
                    found.append((at, np.packbits(total >= limit).tobytes()))
                    total[:] = 0
                at = chunk
                np.minimum(total + np.frombuffer(counters, np.uint8), limit, out=total)
            yield _bits(found)
        if at is not None:
            yield _bits([(at, np.packbits(total >= limit).tobytes())])

    def _bits(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["chunk", "bits"])

    rows = leading.where("chunk is not null").select("chunk", "counters").repartition("chunk").sortWithinPartitions("chunk")
    bits = bytearray(_counters(depth) // 8)
    for r in rows.mapInArrow(run, "chunk int, bits binary").collect():
        bits[r["chunk"] * CHUNK // 8 : (r["chunk"] + 1) * CHUNK // 8] = r["bits"]
    return bytes(bits)


def _added_up(table: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of table, and the sum of each one's n."""
    order = np.lexsort(table.T[::-1])
    table = table[order]
    first = np.flatnonzero(np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)]))
    return table[first], np.add.reduceat(n[order], first)


def _suffixes(docs: DataFrame, bits: bytes, depth: int) -> DataFrame:
    """(lang, suffix, n): up to `depth` words from every place on, as far as every counted phrase in them can be frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    longest = min(depth, COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        known: dict[str, Vocabulary] = {}
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def suffixes() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                words = known[lang].words
                table, n = _added_up(*map(np.concatenate, zip(*parts, strict=True)))
                for a in range(0, len(n), BLOCK):
                    found = [b" ".join([words[w] for w in row if w]) for row in table[a : a + BLOCK].tolist()]
                    columns = [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array(n[a : a + BLOCK], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "suffix", "n"])
            held.clear()

        def add_up() -> None:
            for lang, parts in held.items():
                held[lang] = [_added_up(*map(np.concatenate, zip(*parts, strict=True)))]

        for lang, numbers in _blocks(batches, known):
            passes = [np.ones(len(numbers) + depth, bool) for _ in range(longest + 1)]
            for size, at in known[lang].buckets(numbers, BUCKETS_LOG2, longest):
                passes[size][: len(at)] &= (at >= 0) & (packed[at >> 3] >> (7 - (at & 7)) & 1 > 0)
                passes[size][len(at) :] = False
            starts = np.flatnonzero(passes[2])
            if len(starts):
                padded = np.concatenate([numbers, np.zeros(depth, numbers.dtype)])
                table = np.zeros((len(starts), depth), np.int32)
                open_ = np.ones(len(starts), bool)
                table[:, 0] = numbers[starts]
                for j in range(1, depth):
                    for size in range(2, min(j + 1, longest) + 1):
                        open_ &= passes[size][starts + j + 1 - size]
                    table[:, j] = np.where(open_, padded[starts + j], 0)
                held.setdefault(lang, []).append(_added_up(table, np.ones(len(table), np.int64)))
            if sum(len(n) for parts in held.values() for _, n in parts) > HELD:
                add_up()
                if sum(len(n) for parts in held.values() for _, n in parts) > HELD // 2:
                    yield from suffixes()
            if sum(len(v.words) for v in known.values()) > VOCABULARY:
                # Most words are in no suffix that is held: those are forgotten, what is held stays.
                add_up()
                for k in set(known) - set(held):
                    del known[k]
                for k, [(table, n)] in held.items():
                    known[k], table = known[k].only(table)
                    held[k] = [(table, n)]
                if sum(len(v.words) for v in known.values()) > VOCABULARY // 2:
                    yield from suffixes()
                    known.clear()
        yield from suffixes()

    found = _texts(docs).mapInArrow(run, "lang string, suffix binary, n long")
    return found.select("lang", F.col("suffix").cast("string").alias("suffix"), "n").groupBy("lang", "suffix").agg(F.sum("n").alias("n"))


def quicksort(words: np.ndarray, weights: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(row, depth, total) of every prefix of `depth` numbers whose rows weigh `least` or more; row is one that has it.

    Three-way partitions of pointers by one number at a time: the equal part is a prefix and goes on with the next
    number; parts that weigh less than `least` hold no such prefix and are left. 0 ends a row.
    """
    found: list[tuple[int, int, int]] = []
    todo = [(np.arange(len(words)), 0)]
    while todo:
        rows, at = todo.pop()
        keys = words[rows, at]
        pivot = keys[len(keys) // 2]
        for part in (keys < pivot, keys > pivot):
            if part.any() and weights[rows[part]].sum() >= least:
                todo.append((rows[part], at))
        same = rows[keys == pivot]
        total = int(weights[same].sum())
        if total >= least and pivot:
            found.append((int(same[0]), at + 1, total))
            if at + 1 < words.shape[1]:
                todo.append((same, at + 1))
    return found


def _sorted_counts(routed: DataFrame, least: int, depth: int) -> DataFrame:
    """(lang, phrase, words, a) from suffixes routed by (lang, lead); lead has `known` words, shorter phrases are counted already."""

    def count(rows: list[tuple]) -> pa.RecordBatch:
        langs: dict[str, int] = {}
        numbers: dict[bytes, int] = {}
        table = np.zeros((len(rows), depth + 1), np.int64)
        split = [suffix.split(b" ") for _, _, suffix, _, _ in rows]
        for i, (lang, _, _, _, _) in enumerate(rows):
            table[i, 0] = langs.setdefault(lang, len(langs) + 1)
            for j, w in enumerate(split[i]):
                table[i, j + 1] = numbers.setdefault(w, len(numbers) + 1)
        found = quicksort(table, np.array([r[3] for r in rows], np.int64), least)
        found = [(rows[i][0], b" ".join(split[i][: d - 1]), d - 1, n) for i, d, n in found if d - 1 >= max(2, rows[i][4])]
        kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64())
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("lang", "lead", "suffix", "n", "known")), strict=True)
            if len(held) >= BUFFER:
                stop = len(held) - 1
                while stop and held[stop - 1][:2] == held[-1][:2]:
                    stop -= 1
                if stop:
                    yield count(held[:stop])
                    held = held[stop:]
        if held:
            yield count(held)

    dealt = routed.repartition("lang", "lead").sortWithinPartitions("lang", "lead")
    dealt = dealt.select("lang", "lead", F.col("suffix").cast("binary").alias("suffix"), "n", "known")
    found = dealt.mapInArrow(run, "lang string, phrase binary, words int, a long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def frequent_phrases(docs: DataFrame, least: int = 100, depth: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals): (lang, phrase, words, a) of 2 to `depth` words with a >= least; (lang, phrase, a) of all
    words; (lang, n)."""
    leading = stored(_leading(docs, least, depth), "leading-words")
    words = leading.where("chunk is null").groupBy("lang", F.col("word").cast("string").alias("phrase")).agg(F.sum("n").alias("a"))
    words = stored(words, "words")
    bits = _frequent_buckets(leading, least, depth)
    discard(leading)
    rest = stored(_suffixes(docs, bits, depth), "suffixes")

    group = max(GROUP, least)
    phrases: DataFrame | None = None
    counted: list[DataFrame] = []
    for known in range(2, depth + 1):
        rest = rest.withColumns({"lead": F.substring_index("suffix", " ", known), "known": F.lit(known)})
        hot = rest.groupBy("lang", "lead").agg(F.count("*").alias("rows"), F.sum("n").alias("a")).where(F.col("rows") > group)
        hot = stored(hot, "hot-leads")
        here = rest
        more = known < depth and hot.head() is not None
        if more:
            # Too many suffixes for one task: the count of the lead is known, its suffixes go by one more word.
            named = hot.select(F.col("lang").alias("_l"), own_text("lead").alias("_k"))
            same = (F.col("lang") == F.col("_l")) & (own_text("lead") == F.col("_k"))
            here = rest.join(named, same, "left_anti")
            counted.append(hot.select("lang", F.col("lead").alias("phrase"), F.lit(known).alias("words"), "a"))
            longer = F.length("suffix") > F.length("lead")
            rest = stored(rest.join(named, same, "left_semi").where(longer).select("lang", "suffix", "n"), "suffixes")
        found = _sorted_counts(here, least, depth)
        phrases = found if phrases is None else phrases.unionByName(found)
        if not more:
            break
    for part in counted:
        phrases = phrases.unionByName(part)
    return stored(phrases, "phrases"), words, words.groupBy("lang").agg(F.sum("a").alias("n"))


def collocations(docs: DataFrame, least: int = 100, depth: int = 5, top: int = 2000, cover: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language by score.

    Texts are lower-cased (A-Z) and split at `.,;:!?` and line ends into pieces, those at blanks and tabs into words. A
    phrase of 2 to `depth` words that occurs a >= least times within pieces is cut in two at each place; with l and r
    occurrences of the parts and n words of the language the lowest floor(1000 * a * n / (l * r)) is its score, ties to
    the first place. Phrases inside a longer one that occurs at least `cover` percent as often are left out. Order:
    score, then a, both descending, then the phrase's bytes. All numbers are exact.

    A null lang is `und`, null and empty texts have no words, every row counts (repeated ones too), an empty table gives
    no rows, other columns are ignored.
    """
    phrases, words, totals = frequent_phrases(docs, least, depth)
    parts = words.where(F.col("a") >= least).select("lang", "phrase", "a").unionByName(phrases.select("lang", "phrase", "a"))
    parts = stored(parts.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("a").alias("_a")), "parts")
    inner = phrases.where("words > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("inner"))
    inner = inner.groupBy(F.col("lang").alias("_l"), F.col("inner").alias("_i")).agg(F.max("a").alias("longer"))
    kept = phrases.join(inner, (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("_i")), "left")
    kept = kept.where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).select("lang", "phrase", "words", "a")

    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    for side, name in (("left", "l"), ("right", "r")):
        held = parts.withColumnRenamed("_a", name)
        cuts = cuts.join(held, (own_text("lang") == F.col("_l")) & (own_text(side) == F.col("_p"))).drop("_l", "_p")
    cuts = cuts.join(totals.select(F.col("lang").alias("_l"), "n"), own_text("lang") == F.col("_l")).drop("_l")
    score = F.expr("(1000 * (cast(a as decimal(19)) * cast(n as decimal(19)))) div (cast(l as decimal(19)) * cast(r as decimal(19)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("at")).select("lang", "phrase", "a", "n", "at.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
