"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import ROWS_PER_BATCH

#: Bytes the network reads at once, in both directions; longer texts are read in consecutive windows.
WINDOW = 64
HIDDEN = 8
#: The training sample's bound: documents of each language, and windows of each document.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 1500, 4
STEPS, TRAIN_BATCH, RATE = 400, 512, 0.01
#: Windows run through the network together.
BATCH = 2048
#: Texts run through it together.
TEXTS = 256
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


class ByteGru:
    """One gated recurrent layer in each direction and a softmax over both states at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11):
        draw = np.random.default_rng(seed).normal
        self.languages, self.hidden = languages, hidden
        self.p = {}
        for way in "fb":
            self.p["E" + way] = draw(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p["U" + way] = draw(0, hidden**-0.5, (3 * hidden, hidden)).astype(np.float32)
        self.p["V"] = draw(0, 0.1, (len(languages), 2 * hidden)).astype(np.float32)
        self.p["c"] = np.zeros((len(languages), 1), np.float32)

    def _states(self, x: np.ndarray, live: np.ndarray | None, way: str, keep: list | None = None) -> np.ndarray:
        """States at each byte of windows x (time, window); where `live` is 0 the state stays zero."""
        h, half = self.hidden, np.float32(0.5)
        scale = np.ones(3 * h, np.float32)
        scale[: 2 * h] = half  # the logistic function is a tanh of half its argument
        table, inner = self.p["E" + way] * scale, self.p["U" + way] * scale[:, None]
        state = np.zeros((h, x.shape[1]), np.float32)
        out = np.empty((len(x), h, x.shape[1]), np.float32)
        for t in range(len(x)) if way == "f" else range(len(x) - 1, -1, -1):
            given, own = table.take(x[t], axis=0).T, inner @ state
            gates = given[: 2 * h] + own[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            fresh = own[2 * h :] * gates[h:]
            fresh += given[2 * h :]
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((t, state.copy(), gates, fresh, own[2 * h :]))
            state -= fresh
            state *= gates[:h]
            state += fresh
            if live is not None:
                state *= live[t]
            out[t] = state
        return out

    def probabilities(self, x: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """(language, time, window): the distribution over languages at every byte."""
        both = np.concatenate([self._states(x, live, "f"), self._states(x, live, "b")], axis=1)
        return self._softmax(both)

    def _softmax(self, both: np.ndarray) -> np.ndarray:
        flat = both.transpose(1, 0, 2).reshape(2 * self.hidden, -1)
        logits = self.p["V"] @ flat + self.p["c"]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits.reshape(len(self.languages), both.shape[0], both.shape[2])

    def gradients(self, x: np.ndarray, live: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the live bytes of windows, and its gradients by backpropagation through time."""
        h, steps = self.hidden, {"f": [], "b": []}
        both = np.concatenate([self._states(x, live, w, steps[w]) for w in "fb"], axis=1)
        prob = self._softmax(both)
        n = live.sum()
        loss = -float((np.log(prob[label, :, np.arange(len(label))] + 1e-9) * live.T).sum() / n)
        delta = prob.copy()
        delta[label, :, np.arange(len(label))] -= 1
        delta *= live / n
        flat = both.transpose(1, 0, 2).reshape(2 * h, -1)
        delta = delta.reshape(len(self.languages), -1)
        grad = {"V": delta @ flat.T, "c": delta.sum(axis=1, keepdims=True)}
        back = (self.p["V"].T @ delta).reshape(2 * h, *x.shape)
        for k, way in enumerate("fb"):
            inner, g_inner = self.p["U" + way], np.zeros_like(self.p["U" + way])
            given = np.empty((len(x), 3 * h, x.shape[1]), np.float32)
            carry = np.zeros((h, x.shape[1]), np.float32)
            for t, before, gates, fresh, own in reversed(steps[way]):
                z, r = gates[:h], gates[h:]
                d = (back[k * h : (k + 1) * h, t] + carry) * live[t]
                d_fresh = d * (1 - z) * (1 - fresh * fresh)
                d_z, d_r = d * (before - fresh) * z * (1 - z), d_fresh * own * r * (1 - r)
                given[t, :h], given[t, h : 2 * h], given[t, 2 * h :] = d_z, d_r, d_fresh
                d_inner = np.concatenate([d_z, d_r, d_fresh * r])
                g_inner += d_inner @ before.T
                carry = d * z + inner.T @ d_inner
            grad["U" + way] = g_inner
            rows, places = given.transpose(1, 0, 2).reshape(3 * h, -1), x.reshape(-1)
            grad["E" + way] = np.stack([np.bincount(places, r, 256) for r in rows], axis=1).astype(np.float32)
        return loss, grad

    def fit(self, x: np.ndarray, live: np.ndarray, label: np.ndarray, steps: int = STEPS, batch: int = TRAIN_BATCH, seed: int = 5) -> ByteGru:
        """Adam over random batches with equally many windows of each language; x and live are (time, window)."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        each = max(1, batch // len(of))
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, each) for rows in of])
            _, grad = self.gradients(x[:, pick], live[:, pick], label[pick])
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                self.p[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean distribution over all bytes of each text, and how many of its bytes each language is the label of."""
        sums = np.zeros((len(texts), len(self.languages)))
        votes = np.zeros((len(texts), len(self.languages)), np.int64)
        whole, owners, tails = [], [], []
        for i, text in enumerate(texts):
            n = len(text) // WINDOW
            if n:
                whole.append(np.frombuffer(text, np.uint8, n * WINDOW).reshape(n, WINDOW))
                owners.append(np.full(n, i))
            if len(text) > n * WINDOW:
                tails.append((i, text[n * WINDOW :]))
        if whole:
            self._add(np.concatenate(whole), None, np.concatenate(owners), sums, votes)
        if tails:
            x = np.frombuffer(b"".join(t.ljust(WINDOW, b"\0") for _, t in tails), np.uint8).reshape(-1, WINDOW)
            live = np.arange(WINDOW) < np.array([len(t) for _, t in tails])[:, None]
            self._add(x, live, np.array([i for i, _ in tails]), sums, votes)
        return sums / np.maximum(np.array([len(t) for t in texts])[:, None], 1), votes

    def _add(self, x: np.ndarray, live: np.ndarray | None, owner: np.ndarray, sums: np.ndarray, votes: np.ndarray) -> None:
        for a in range(0, len(x), BATCH):
            part = np.ascontiguousarray(x[a : a + BATCH].T).astype(np.intp)
            alive = None if live is None else live[a : a + BATCH].T.astype(np.float32)
            prob = self.probabilities(part, alive)
            label = prob.argmax(axis=0)
            if alive is not None:
                prob *= alive
                label[alive == 0] = -1
            np.add.at(sums, owner[a : a + BATCH], prob.sum(axis=1, dtype=np.float64).T)
            counts = np.stack([(label == k).sum(axis=0) for k in range(len(self.languages))], axis=1)
            np.add.at(votes, owner[a : a + BATCH], counts)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4; such rows are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, steps: int = STEPS) -> ByteGru | None:
    """The network fitted on windows of a bounded sample of labelled documents outside the held-out quarter.

    The sample takes each language's documents by a hash of their id at the rate that gives `docs_per_language`, and
    from each at most WINDOWS_PER_DOC windows at places the hash chooses, so what reaches the driver is bounded by the
    number of languages. None if there is no labelled document.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.col("text").cast("string"), "utf-8").alias("bytes"), "lang")
    known = known.where(~held_out() & F.col("lang").isNotNull() & (F.octet_length("bytes") > 0))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    place = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(1 << 30))
    rate = F.element_at(F.create_map(*[F.lit(v) for k in languages for v in (k, int(min(1.0, docs_per_language / counts[k]) * (1 << 30)))]), F.col("lang"))
    sample = known.withColumn("place", place).where(F.col("place") < rate).orderBy("place", "doc_id").limit(2 * docs_per_language * len(languages))
    starts = F.array(*[F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.octet_length("bytes") - WINDOW + 1, F.lit(1))) for k in range(WINDOWS_PER_DOC)])
    windows = sample.select("place", "doc_id", "lang", "bytes", F.explode(F.array_distinct(starts)).alias("start"))
    windows = windows.select("lang", "place", "doc_id", "start", F.expr(f"substring(bytes, cast(start as int) + 1, {WINDOW})").alias("window"))
    rows = sorted(tuple(r) for r in windows.collect())
    x = np.frombuffer(b"".join(bytes(r[4]).ljust(WINDOW, b"\0") for r in rows), np.uint8).reshape(-1, WINDOW).T.astype(np.intp)
    live = (np.arange(WINDOW)[:, None] < np.array([len(r[4]) for r in rows])).astype(np.float32)
    label = np.array([languages.index(r[0]) for r in rows])
    return ByteGru(languages).fit(np.ascontiguousarray(x), live, label, steps)


def identify(docs: DataFrame, model: ByteGru | None, column: str = "language") -> DataFrame:
    """docs and a struct column of lang_pred, score and share: the language of each whole text.

    Every byte is labelled; score is the mean probability of the predicted language over all bytes, share the part of
    the bytes it is the label of. A text that is null or has no letter gets `und` with score 0, and so do all if nothing
    could be learnt. Every row and column is kept; a column that already has the struct's name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for texts in batches:
            out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "share": 0.0}, index=range(len(texts)))
            for a in range(0, len(texts), TEXTS):
                part = texts.iloc[a : a + TEXTS]
                spoken = [i for i, t in enumerate(part) if t is not None and net is not None and _LETTER.search(t)]
                if spoken:
                    mean, votes = net.pooled([part.iloc[i].encode("utf-8", "replace") for i in spoken])
                    best, rows = mean.argmax(axis=1), np.arange(len(spoken))
                    at = [a + i for i in spoken]
                    out.loc[at, "lang_pred"] = [net.languages[k] for k in best]
                    out.loc[at, "score"] = np.clip(mean[rows, best], 0, 1)
                    out.loc[at, "share"] = votes[rows, best] / votes.sum(axis=1)
            yield out

    guess = F.pandas_udf(predict, "lang_pred string, score double, share double")
    return docs.withColumn(column, guess(F.col("text").cast("string")))


def predict_languages(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, steps: int = STEPS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, share) for every row of docs; the network never sees lang of held-out rows."""
    model = train(docs, docs_per_language, steps)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "language.*")
