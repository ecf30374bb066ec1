"""Severity of toxicity by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import WORD, texts_of

#: Features are hashed to this many places.
PLACES = 1 << 18
#: Beginnings of words that are features beside the word itself.
STEMS = (4, 6)
#: The training sample's bound, for each grade of the label.
DOCS_PER_LABEL = 2500
#: Severity grades: 0 is clean, toxic documents are 1, 2, ... by how much of their wording is toxic.
GRADES = 4
STEPS, RATE, DECAY = 200, 0.05, 2e-3
#: Features of fewer than this share of the sampled documents (and of fewer than two) get no weight.
LEAST_SHARE = 0.005
#: A document counts as toxic if its grade is above 0 with more than this probability.
DECISION = 0.35
REMEMBERED = 400_000
TEXTS = 128


@lru_cache(REMEMBERED)
def _features(word: str) -> tuple[int, ...]:
    plain = word.lower().strip(".,;:!?\"'()[]{}*_-")
    if not plain:
        return ()
    digest = xxhash.xxh3_64_intdigest
    names = [plain + " ", *{plain[:k] for k in STEMS if len(plain) >= k}]
    return tuple(digest(n.encode("utf-8", "surrogatepass"), len(n)) % PLACES for n in names)


def features(text: str | None) -> np.ndarray:
    """Sorted places of a text's words and word beginnings; each counts once."""
    found: set[int] = set()
    for word in set(WORD.findall(text or "")):
        found.update(_features(word))
    return np.array(sorted(found), np.int32)


class CumulativeLink:
    """P(grade > k) = logistic(w x - threshold k): one weight vector for all ordered thresholds."""

    def __init__(self, grades: int, places: int = PLACES):
        self.weights = np.zeros(places)
        self.first, self.gaps = 0.0, np.zeros(max(0, grades - 2))  # thresholds are first and softly positive steps

    @property
    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(self.gaps)))])

    def above(self, scores: np.ndarray) -> np.ndarray:
        """(document, threshold): the probability that the grade is beyond each threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -30, 30)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.above(scores).sum(axis=1)

    def fit(self, rows: list[np.ndarray], grade: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> CumulativeLink:
        """Weighted maximum likelihood with weight decay, by Adam over all rows; deterministic."""
        common = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=len(self.weights)) >= max(2, LEAST_SHARE * len(rows))
        rows = [r[common[r]] for r in rows]
        used, place = np.unique(np.concatenate([*rows, np.zeros(0, np.int32)]), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        value = np.zeros(len(used))
        levels = len(self.gaps) + 1
        beyond = (grade[:, None] > np.arange(levels)).astype(float)
        state = [np.zeros(len(used) + levels) for _ in range(2)]
        weight = weight / weight.sum()
        for step in range(1, steps + 1):
            scores = np.bincount(owner, value[place], len(rows))
            up = self.above(scores)
            # The chance of grade k is the difference of neighbouring curves; its gradient by each curve's argument.
            edges = np.concatenate([np.ones((len(rows), 1)), up, np.zeros((len(rows), 1))], axis=1)
            chance = np.maximum(np.take_along_axis(edges, grade[:, None], 1) - np.take_along_axis(edges, grade[:, None] + 1, 1), 1e-9)
            own = np.zeros((len(rows), levels))
            for k in range(levels):
                slope = up[:, k] * (1 - up[:, k])
                own[:, k] = np.where(grade == k + 1, slope, 0) - np.where(grade == k, slope, 0)
            own *= weight[:, None] / chance
            d_score = -own.sum(axis=1)
            d_threshold = own.sum(axis=0)
            g_value = np.bincount(place, d_score[owner], len(used)) + DECAY * value
            g_first = d_threshold.sum()
            soft = 1 / (1 + np.exp(-self.gaps))
            g_gaps = np.array([d_threshold[k + 1 :].sum() for k in range(levels - 1)]) * soft
            grad = np.concatenate([g_value, [g_first], g_gaps])
            state[0] += 0.1 * (grad - state[0])
            state[1] += 0.01 * (grad * grad - state[1])
            move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-10)
            value -= move[: len(used)]
            self.first -= move[len(used)]
            self.gaps -= move[len(used) + 1 :]
        self.weights[used] = value
        return self


def _grades(rows: list[np.ndarray], toxic: np.ndarray, grades: int) -> np.ndarray:
    """Grades from a yes/no label: toxic rows are ranked by their number of tell-tale features, in equal parts.

    A feature is tell-tale if it is in three toxic rows or more and at least nine in ten rows with it are toxic (rows
    weighted so that both labels count alike).
    """
    where = [np.bincount(np.concatenate([r for r, t in zip(rows, toxic, strict=True) if t == k] or [np.zeros(0, np.int32)]), minlength=PLACES) for k in (0, 1)]
    share = [w / max(1, (toxic == k).sum()) for k, w in enumerate(where)]
    telling = (where[1] >= 3) & (share[1] >= 9 * share[0])
    hits = np.array([int(telling[r].sum()) for r in rows])
    grade = np.zeros(len(rows), int)
    bad = np.flatnonzero(toxic == 1)
    if len(bad):
        cuts = np.quantile(hits[bad], np.arange(1, grades - 1) / (grades - 1))
        grade[bad] = 1 + (hits[bad, None] > cuts).sum(axis=1)
    return grade


def train(docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL, grades: int = GRADES) -> CumulativeLink | None:
    """The regression fitted on a bounded sample of labelled documents; None without both labels.

    Each label's documents are taken by a hash of doc_id at the rate that gives `docs_per_label`; their features, at
    most PLACES numbers a document, are extracted where the texts are and only they reach the driver. Labels other than
    0 and 1 are ignored; of several labels of a document the largest counts.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    place = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30))
    rate = {k: int(min(1.0, docs_per_label / n) * (1 << 30)) for k, n in counts.items()}
    chosen = known.where(place < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0])).withColumn("place", place)
    chosen = chosen.orderBy("place", "doc_id").limit(4 * docs_per_label)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), TEXTS):
                part = pdf.iloc[a : a + TEXTS]
                yield pd.DataFrame({"doc_id": part["doc_id"], "toxic": part["toxic"], "found": [features(t).tobytes() for t in part["text"]]})

    sample = texts_of(docs).join(chosen.select(F.col("doc_id").alias("id"), "toxic"), F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "text")
    rows = sorted((r["doc_id"], r["toxic"], bytes(r["found"])) for r in sample.mapInPandas(extract, "doc_id long, toxic int, found binary").collect())
    found, toxic = [np.frombuffer(r[2], np.int32) for r in rows], np.array([r[1] for r in rows])
    if len(set(toxic.tolist())) < 2:
        return None
    # Rows are weighted so that the labels count as often as they occur among all labelled documents.
    weight = np.where(toxic == 1, counts[1] / (toxic == 1).sum(), counts[0] / (toxic == 0).sum())
    return CumulativeLink(grades).fit(found, _grades(found, toxic, grades), weight)


def severity(docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL, grades: int = GRADES) -> DataFrame:
    """(doc_id, expected_severity, grade, toxic) of every row of docs, from its whole text.

    expected_severity is the mean of the predicted distribution over grades 0 .. grades - 1, grade the number of thresholds
    passed with a probability of more than DECISION, toxic whether it is above 0. Texts without a word, null ones too, have
    severity and grade 0, and so do all if nothing can be learnt (no row of one of the labels). One row per row of docs;
    an empty table gives no rows; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, docs_per_label, grades))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = model.value
        for texts in batches:
            if fitted is None:
                yield pd.DataFrame({"expected_severity": 0.0, "grade": 0, "toxic": False}, index=range(len(texts)))
                continue
            found = [features(t) for t in texts]
            above = fitted.above(np.array([fitted.weights[f].sum() for f in found]))
            above[[len(f) == 0 for f in found]] = 0
            grade = (above > DECISION).sum(axis=1)
            yield pd.DataFrame({"expected_severity": above.sum(axis=1), "grade": grade, "toxic": grade > 0})

    judge = F.pandas_udf(run, "expected_severity double, grade int, toxic boolean")
    return texts_of(docs).select("doc_id", judge("text").alias("judged")).select("doc_id", "judged.*")
