"""Packing of tokenised documents into sequences: linear grouping, few-size configurations, substitution, best fit."""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stagetrail.llm.common import stored, texts_of

CAPACITY = 2048
#: Lengths above this share of the capacity are grouped and placed by configurations; the rest are best-fitted.
LARGE = 0.4
GROUPS = 600
#: Strings remembered per worker, and the longest that is.
REMEMBERED, LONGEST_REMEMBERED = 150_000, 48
#: Shares into which the pieces of one length are cut to number them.
SHARES = 64

# Texts of these characters only are lower-cased and split here as the tokenizer's own normaliser and pattern do; the
# blank-separated strings of others go through the whole tokenizer, which never joins two of them.
_PLAIN = re.compile("[\t\n\r\x20-~¡-ɏ]*")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
_BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
_MARKERS = re.compile(r"<\|(?:start|end)oftext\|>")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next free one."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


class Remembered(dict):
    """Ids by string, computed when first asked for; when full, strings not asked for since it was last full are forgotten."""

    def __init__(self, compute: Callable[[str], bytes]):
        self.compute, self.older = compute, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.compute(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


class RememberedWords(Remembered):
    """Normalised strings: a word with a stop after it needs no entry of its own, as the two are never joined."""

    def __missing__(self, key: str) -> bytes:
        if key[-1] in ".," and key[:-1].isalpha():
            return self[key[:-1]] + self[key[-1]]
        return super().__missing__(key)


class WordTokens:
    """Ids of texts by the tokenizers library, asked once per distinct word."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.plain = RememberedWords(self._chunk)
        self.odd = Remembered(lambda chunk: _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids))

    def _chunk(self, chunk: str) -> bytes:
        parts = _PARTS.findall(chunk)
        return self._part(chunk) if len(parts) == 1 else b"".join([self.plain[p] for p in parts])

    def _part(self, part: str) -> bytes:
        """Ids of what the pattern does not split further, by the library's merges alone."""
        if not part.isascii():
            part = "".join([self.letters[b] for b in part.encode()])
        return _packed([t.id for t in self.model.tokenize(part)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if _PLAIN.fullmatch(text) and not _MARKERS.search(text):
            return b"".join(map(self.plain.__getitem__, text.lower().split()))
        return b"".join(map(self.odd.__getitem__, _BLANKS.findall(text)))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_loaded: dict[str, WordTokens] = {}


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids, then the end id, cut only beyond the capacity."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if tokenizer_path not in _loaded:
            _loaded[tokenizer_path] = WordTokens(definition.value)
        tokens, end, size = _loaded[tokenizer_path], np.array([end_id], "<u4").tobytes(), 4 * capacity
        for texts in batches:
            out = []
            for text in texts:
                ids = tokens.encode(text or "") + end
                cuts = [ids[at : at + size] for at in range(0, len(ids), size)]
                out.append([(k, k * capacity, len(cut) // 4, zlib.crc32(cut)) for k, cut in enumerate(cuts)])
            yield pd.Series(out)

    cut = F.pandas_udf(run, "array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    return texts_of(docs).select("doc_id", F.explode(cut("text")).alias("cut")).select("doc_id", "cut.*")


# ---- the plan: made from the number of pieces of each length, at most `capacity` numbers however many pieces ----


def linear_groups(counts: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths, largest first, in groups of about equal numbers of pieces; a length is never split over two groups."""
    total, out, filled = sum(counts.values()), [], 0
    for length in sorted(counts, reverse=True):
        if not out or filled >= len(out) * total / groups:
            out.append([])
        out[-1].append(length)
        filled += counts[length]
    return out


def best_configuration(sizes: list[int], worth: np.ndarray, most: list[int], capacity: int) -> list[int]:
    """How many of each size fit one sequence for the greatest worth (bounded knapsack)."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), np.int16)
    for i, size in enumerate(sizes):
        if worth[i] <= 0:
            continue
        base = best.copy()
        for k in range(1, min(most[i], capacity // size) + 1):
            value = base[: capacity + 1 - k * size] + k * worth[i]
            better = value > best[k * size :] + 1e-12
            best[k * size :][better] = value[better]
            taken[i, k * size :][better] = k
    room, out = capacity, [0] * len(sizes)
    for i in range(len(sizes) - 1, -1, -1):
        out[i] = int(taken[i, room])
        room -= out[i] * sizes[i]
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations and their numbers that cover the demand: column generation, rounded down, the rest greedily."""
    n = len(sizes)
    columns = [[capacity // sizes[i] if i == j else 0 for j in range(n)] for i in range(n)]
    inverse = np.diag([1.0 / c[i] for i, c in enumerate(columns)])
    need = np.array(demand, float)
    many = [capacity // s for s in sizes]
    for _ in range(60 * n):
        duals = inverse.sum(axis=0)
        column = best_configuration(sizes, duals, many, capacity)
        if float(np.dot(duals, column)) <= 1 + 1e-7:
            break
        way, amount = inverse @ np.array(column, float), inverse @ need
        ratio = np.where(way > 1e-12, np.maximum(amount, 0) / np.where(way > 1e-12, way, 1), np.inf)
        out = int(ratio.argmin())
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        columns[out] = column
    used: list[tuple[list[int], int]] = []
    left = list(demand)
    for column, amount in zip(columns, inverse @ need, strict=True):
        whole = min([int(amount + 1e-9), *(left[i] // c for i, c in enumerate(column) if c)])
        if whole > 0:
            used.append((column, whole))
            left = [x - whole * c for x, c in zip(left, column, strict=True)]
    while any(left):
        column = best_configuration(sizes, np.array([s * (s + capacity) for s in sizes], float), left, capacity)
        times = min(left[i] // c for i, c in enumerate(column) if c)
        used.append((column, times))
        left = [x - times * c for x, c in zip(left, column, strict=True)]
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large: float = LARGE, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for pieces of at most `capacity` tokens.

    Large lengths are rounded up to the longest of their group, the few sizes are packed by configurations, and each
    slot of a group then takes the group's actual pieces, longest first. Small ones go where they fit best. Sequences
    of one content are handled as one run, so the work and the result depend on the number of lengths, not of pieces.
    """
    runs: list[tuple[tuple[int, ...], int]] = []
    counts = {k: n for k, n in histogram.items() if n}
    if counts.get(capacity):
        runs.append(((capacity,), counts.pop(capacity)))
    big = {k: n for k, n in counts.items() if k > capacity * large}
    small = {k: n for k, n in counts.items() if k <= capacity * large}
    open_runs: list[tuple[tuple[int, ...], int]] = []
    if big:
        grouped = linear_groups(big, groups)
        demand = [sum(big[k] for k in g) for g in grouped]
        queues = [[[k, big[k]] for k in g] for g in grouped]
        for column, times in configurations([g[0] for g in grouped], demand, capacity):
            slots = [i for i, c in enumerate(column) for _ in range(c)]
            # Slots of one group take pieces one after the other, each for as many sequences as its length lasts.
            segments = [[] for _ in slots]
            for s, i in enumerate(slots):
                wanted = times
                while wanted:
                    length, n = queues[i][0]
                    take = min(n, wanted)
                    segments[s].append([length, take])
                    wanted -= take
                    if take == n:
                        queues[i].pop(0)
                    else:
                        queues[i][0][1] -= take
            while times:
                step = min(s[0][1] for s in segments)
                open_runs.append((tuple(s[0][0] for s in segments), step))
                times -= step
                for s in segments:
                    s[0][1] -= step
                    if not s[0][1]:
                        s.pop(0)
    return runs + best_fit(open_runs, small, capacity)


def best_fit(open_runs: list[tuple[tuple[int, ...], int]], small: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Small pieces, longest first, each into the fullest sequence that still has room; new ones when none has."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for held, times in open_runs:
        rooms.setdefault(capacity - sum(held), []).append((held, times))
    order = sorted(rooms)

    def put(room: int, run: tuple[tuple[int, ...], int]) -> None:
        if room not in rooms:
            rooms[room] = []
            order.insert(bisect_left(order, room), room)
        rooms[room].append(run)

    for length in sorted(small, reverse=True):
        n = small[length]
        while n:
            at = bisect_left(order, length)
            if at == len(order):
                rooms[capacity] = [((), -(-n // (capacity // length)))]
                order.append(capacity)
                continue
            room = order[at]
            held, times = rooms[room].pop()
            fit = min(room // length, n)
            whole = min(times, n // fit)
            if whole < times:
                rooms[room].append((held, times - whole))
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            put(room - fit * length, (held + (length,) * fit, whole))
            n -= whole * fit
    return [run for found in rooms.values() for run in found if run[0]]


def slots(runs: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """(length, first, number, sequence, offset): the first-th and following pieces of a length and where they go."""
    rows, next_rank, sequence = [], {}, 0
    for held, times in runs:
        offset = 0
        for length in held:
            first = next_rank.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            next_rank[length] = first + times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "number", "sequence", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, large: float = LARGE, groups: int = GROUPS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece's place in a gapless sequence.

    Only the number of pieces of each length (at most `capacity` rows) goes to the driver; the plan made of it is a
    table of runs of sequences with equal content. Pieces of one length are interchangeable: they are numbered in
    shares, so a length that a third of all pieces have is numbered by many tasks, and number and length give the place.

    Null and empty texts are packed as their end id; a null doc_id keeps its row; repeated rows are packed each; an
    empty table gives no rows; other columns are ignored. Equal lengths are taken in the order of share and doc_id.
    """
    cut = stored(pieces(docs, tokenizer_path, capacity), "pack-pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = slots(plan(histogram, capacity, large, groups))
    spark = docs.sparkSession

    share = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SHARES * int(spark.conf.get("spark.sql.shuffle.partitions")))).alias("share")
    dealt = cut.withColumn("share", share)
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.Window.partitionBy("length").orderBy("share").rowsBetween(W.Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "share", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(W.Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("inside", inside).join(sizes, ["length", "share"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside")).alias("rank"))

    lengths, firsts = placed["length"].to_numpy(np.int64), placed["first"].to_numpy(np.int64)
    bound = int(firsts.max()) + 1 if len(firsts) else 1
    table = spark.sparkContext.broadcast((lengths * bound + firsts, firsts, placed["sequence"].to_numpy(np.int64), placed["offset"].to_numpy(np.int64)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, sequence, offset = table.value
        rank = rank.to_numpy(np.int64)
        # A length's last run may reach beyond the bound of first numbers; the place is still that run's.
        at = np.searchsorted(keys, length.to_numpy(np.int64) * bound + np.minimum(rank, bound - 1), side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank - first[at], "offset": offset[at]})

    return ranked.withColumn("place", place("length", "rank")).select("doc_id", "piece", "start", "length", "ids_crc32", "place.*")
