"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import texts_of

SPACE = "▁"
#: Segments remembered per worker, and the longest that is.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 48


def _one_mark_per_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one-mark-per-byte", _one_mark_per_byte)


class PieceModel:
    """A byte-fallback BPE model with the identity normaliser, a dummy prefix and kept white space.

    encode: a text is cut where no piece spans two neighbouring characters; each segment is encoded by taking the
    longest piece at each position (one Aho-Corasick pass), checking that it may follow its neighbour, trying shorter
    ones otherwise, and stepping back past positions from which nothing led on, which a bitfield remembers. Two pieces
    may be neighbours if merging the characters of both anew gives the same two pieces; a sequence whose neighbours all
    may is the one that merging gives.
    """

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bos, self.eos, self.unknown = library.bos_id(), library.eos_id(), library.unk_id()
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif library.is_control(i):
                self.bytes_of.append(b"")
            elif library.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[piece], self.scores[piece] = i, library.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.raw = frozenset(self.byte_ids)
        self.joined = {a + b for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        # Cutting before each run of spaces is the common case and needs no look at single characters.
        self.by_word = not any(b == SPACE and a != SPACE for a, b in self.joined)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if self.merge(piece) == [piece]:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.compatible = lru_cache(1 << 18)(self._compatible)
        self.part = lru_cache(REMEMBERED)(self._part)
        self.segment = lru_cache(REMEMBERED)(self._segment)

    def merge(self, text: str) -> list[str]:
        """Plain merging: the pair of the highest score first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        agenda: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                both = parts[left] + parts[right]
                score = self.scores.get(both)
                if score is not None:
                    heapq.heappush(agenda, (-score, left, both))

        for i in range(len(parts) - 1):
            offer(i)
        while agenda:
            _, left, both = heapq.heappop(agenda)
            right = after[left]
            if parts[left] is None or right >= len(parts) or parts[left] + parts[right] != both:
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in parts if p is not None]

    def _compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both anew gives both; if no piece spans the gap, nothing can differ."""
        heads = [right[:j] for j in range(1, len(right) + 1)]
        ids = self.ids
        if not any(left[i:] + head in ids for i in range(len(left)) for head in heads):
            return True
        return self.merge(left + right) == [left, right]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a segment; characters without a piece stand alone."""
        n = len(text)
        lengths: list[list[int]] = [[] for _ in range(n)]
        for end, size in self.automaton.iter(text):
            lengths[end - size + 1].append(size)
        failed = bytearray(n // 8 + 1)
        path: list[str] = []
        tried: list[int] = []  # how many of the lengths at its start each piece of the path has used
        at, skip = 0, 0
        while at < n:
            options = lengths[at]  # shortest first, as the pass yields them by their end
            if not options:
                options.append(1)
            used = skip
            while used < len(options):
                size = options[-1 - used]
                used += 1
                end = at + size
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                piece = text[at:end]
                if not path or self.compatible(path[-1], piece):
                    path.append(piece)
                    tried.append(used)
                    at, skip = end, 0
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                skip = tried.pop()
                at -= len(path.pop())
        return path

    def _part(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.backtrack(text):
            found = self.ids.get(piece)
            ids += [found] if found is not None else [self.byte_ids[b] for b in piece.encode("utf-8")]
        return np.array(ids, "<u4").tobytes()

    def _segment(self, text: str) -> bytes:
        """Ids of a segment, cut further where no piece holds two neighbouring characters."""
        joined, out, start = self.joined, [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in joined:
                out.append(text[start:i])
                start = i
        out.append(text[start:])
        return b"".join([self.part(p) if len(p) <= LONGEST_REMEMBERED else self._part(p) for p in out])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end ids."""
        if not text:
            return b""
        whole = SPACE + text.replace(" ", SPACE)
        segments = self.words.findall(whole) if self.by_word else [whole]
        return b"".join([self.segment(s) if len(s) <= LONGEST_REMEMBERED else self._segment(s) for s in segments])

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD one by one, begin and end ids nothing.

        The dummy prefix goes: one space at the start of the first piece, unless that piece is a byte.
        """
        table, numbers = self.bytes_of, np.frombuffer(ids, "<u4").tolist()
        found = b"".join([table[i] for i in numbers])
        first = next((i for i in numbers if table[i]), None)
        if first is not None and first not in self.raw:
            found = found.removeprefix(b" ") if first != self.unknown else found
        return found.decode("utf-8", "one-mark-per-byte")


@lru_cache(2)
def load(model: bytes) -> PieceModel:
    return PieceModel(model)


def encode_documents(docs: DataFrame, model_path: str, digests: bool = False) -> DataFrame:
    """(doc_id, ids, decoded) of every row of docs, with begin and end ids; whole texts.

    With `digests` the columns are n_tokens, ids_sha256 (of the little-endian 32-bit ids) and decoded_sha256 instead,
    computed in the same task so that ids and texts need not leave it. The model file is read by the driver and sent
    along, at well under a megabyte for a 32k vocabulary. Null counts as empty; one row per row of docs, repeated or
    not; an empty table gives no rows; other columns are ignored.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = load(model.value)
        first, last = np.array([coder.bos], "<u4").tobytes(), np.array([coder.eos], "<u4").tobytes()

        def digest(text: str | None) -> tuple[int, str, str]:
            ids = first + coder.encode(text or "") + last
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(ids).encode()).hexdigest()

        def both(text: str | None) -> tuple[np.ndarray, str]:
            ids = first + coder.encode(text or "") + last
            return np.frombuffer(ids, "<u4").astype(np.int64), coder.decode(ids)

        for texts in batches:
            yield pd.DataFrame([(digest if digests else both)(t) for t in texts], columns=names)

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    coded = F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<long>, decoded string")
    return texts_of(docs).select("doc_id", coded("text").alias("coded")).select("doc_id", "coded.*")
