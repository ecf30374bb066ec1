"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Everything that touches rows is a Column expression; the driver fits the model on one count per pattern of votes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Where the given form could be tried from every place of a long run, or take one step of the
#: stack for each repetition, an equal form says where a match may start and gives nothing back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What is looked for inside base matches that fail, where two numbers stand side by side.
INSIDE = {
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{16,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
}
#: Forms the base patterns do not know at all, looked for in the whole text.
BESIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+(])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: Gazetteers: what a number or address of a kind begins or ends with.
GAZETTEER = {
    "email": r"(?i)[.\x20)\]](?:com|org|net|edu|gov|info|biz|io|de|fr|es|it|uk|eu|nl|ch|at|us|ca|mx|jp)$",
    "ip": r"^(?!0|10\.|127\.|192\.168\.|22[4-9]\.|23[0-9]\.|24[0-9]\.|25[0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6011|62|65)",
    "phone": r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
}
#: Context: words shortly before a span that speak for its kind, and such that speak for other numbers.
NEAR = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|correo|courriel|kontakt)",
    "ip": r"(?i)(?:\bip\b|address|host|server|adresse|servidor)",
    "card": r"(?i)(?:card|visa|credit|karte|carte|tarjeta)",
    "phone": r"(?i)(?:\btel|phone|call|fax|mobile|anruf|appel|llam)",
}
ELSE = r"(?i)(?:token|key|sha|hash|version|build|isbn|order|serial|id)[\x20=:\"'#]*$"
BEFORE = 32
#: Elements summed one by one when places are computed; larger runs are summed by blocks.
BLOCK = 64
LABELERS = ("regex", "check", "gazetteer", "context", "neighbours")
FEATURES = ("check", "gazetteer", "context", "neighbours", "blanks", "marks")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named in it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, v: total + v)


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, value, before, after>> of a pattern's matches, in code points.

    The parts between the matches and the matches add up to the places. Sums go by blocks, so that the work stays in
    proportion to the matches times BLOCK.
    """

    def spans(cut: Column) -> Column:
        def placed(sizes: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: _sum(F.slice(sizes, b * BLOCK + 1, BLOCK)))

            def summed(totals: Column) -> Column:
                def at(bases: Column) -> Column:
                    def span(value: Column, i: Column) -> Column:
                        block = F.floor(i / BLOCK).cast("int")
                        stop = F.get(bases, block) + _sum(F.slice(sizes, block * BLOCK + 1, i - block * BLOCK + 1))
                        return F.struct(
                            (stop - F.length(value)).alias("start"),
                            stop.alias("stop"),
                            value.alias("value"),
                            F.right(F.get(cut["gaps"], i), F.lit(BEFORE)).alias("before"),
                            F.left(F.get(cut["gaps"], i + 1), F.lit(1)).alias("after"),
                        )

                    return F.transform(cut["found"], span)

                return _let(F.transform(totals, lambda _, b: _sum(F.slice(totals, 1, b))), at)

            return _let(blocks, summed)

        sizes = F.transform(cut["found"], lambda value, i: F.length(F.get(cut["gaps"], i)) + F.length(value))
        return F.when(F.size(cut["found"]) > 0, _let(sizes, placed)).otherwise(F.array().cast(SPANS))

    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return _let(cut, spans)


SPANS = "array<struct<start:int,stop:int,value:string,before:string,after:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether 16 to 19 digits pass Luhn's sum."""

    def total(digits: Column) -> Column:
        def doubled(i: Column) -> Column:
            n = F.substring(digits, -i, F.lit(1)).cast("int")
            return F.when(i % 2 == 1, n).when(n > 4, n * 2 - 9).otherwise(n * 2)

        return F.when(F.length(digits).between(16, 19), _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), doubled)))

    return F.coalesce(_let(_digits(value), total) % 10 == 0, F.lit(False))


def valid(kind: str, value: Column) -> Column:
    """Whether a base match of the kind counts."""
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    no = ~yes if no is None else no
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _candidate(kind: str, span: Column, regex: bool | Column, start: Column | None = None) -> Column:
    """The span with its labelers' votes, -1, 0 or 1, and two features of its form."""
    value, before = span["value"], span["before"]
    check = value.rlike(r"[.\x20)\]][A-Za-z]{2,}$") if kind == "email" else valid(kind, value)
    stuck = before.rlike(r"[A-Za-z0-9_\"'=/#]$") | span["after"].rlike(r"[A-Za-z0-9_\"'=/#]")
    base = F.lit(0) if start is None else start
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        (base + span["start"]).cast("int").alias("start"),
        (base + span["stop"]).cast("int").alias("stop"),
        F.lit(regex).cast("int").alias("regex"),
        _vote(check).alias("check"),
        _vote(value.rlike(GAZETTEER[kind]), F.lit(False) if kind in ("email", "phone") else None).alias("gazetteer"),
        _vote(before.rlike(NEAR[kind]), before.rlike(ELSE)).alias("context"),
        _vote(~stuck).alias("neighbours"),
        value.contains(" ").cast("int").alias("blanks"),
        value.rlike(r"[-().\[]").cast("int").alias("marks"),
    )


_CANDIDATES = "array<struct<kind:int,start:int,stop:int,regex:int,check:int,gazetteer:int,context:int,neighbours:int,blanks:int,marks:int>>"


def candidate_spans(text: Column) -> Column:
    """All base spans of a text (regex is 1) and the further candidates of each kind (regex is 0)."""
    nothing = F.array().cast(_CANDIDATES)

    def of_base(kind: str) -> Column:
        def split(spans: Column) -> Column:
            # A failing match goes on as its parts; one whole part may fail too and is still a candidate to be voted on.
            good = F.transform(F.filter(spans, lambda s: valid(kind, s["value"])), lambda s: _candidate(kind, s, True))
            if kind not in INSIDE:
                return good

            def parts(s: Column) -> Column:
                def part(t: Column) -> Column:
                    first, last = t["start"] == 0, t["stop"] == F.length(s["value"])
                    around = F.struct(
                        t["start"].alias("start"),
                        t["stop"].alias("stop"),
                        t["value"].alias("value"),
                        F.when(first, s["before"]).otherwise(t["before"]).alias("before"),
                        F.when(last, s["after"]).otherwise(t["after"]).alias("after"),
                    )
                    return _candidate(kind, around, False, s["start"])

                return F.transform(located(s["value"], INSIDE[kind]), part)

            return F.concat(good, F.flatten(F.transform(F.filter(spans, lambda s: ~valid(kind, s["value"])), parts)))

        return _let(located(text, BASE[kind]), split)

    def of_beside(kind: str) -> Column:
        return F.transform(located(text, BESIDE[kind]), lambda s: _candidate(kind, s, False))

    digit = text.rlike("[0-9]")
    obfuscated = text.contains("[at]") | text.contains("(at)")
    groups = [
        (text.contains("@"), of_base("email")),
        (digit, of_base("ip")),
        (digit, of_base("card")),
        (text.contains("+"), of_base("phone")),
        (obfuscated, of_beside("email")),
        (digit, of_beside("phone")),
    ]
    return F.concat(*[F.when(test, found).otherwise(nothing).cast(_CANDIDATES) for test, found in groups])


class VoteModel:
    """Reliabilities of the labelers by expectation-maximisation, and one logistic classifier a kind trained on its labels."""

    #: Prior: each labeler's vote is right nine times in ten, worth so many candidates.
    RIGHT, WORTH = 0.9, 20.0

    def __init__(self) -> None:
        self.reliability: dict[tuple[int, str], dict[int, tuple[float, float]]] = {}
        self.weights: dict[int, list[float]] = {}

    def _prior(self, vote: int, true: int) -> float:
        if vote == 0:
            return 0.5 * self.WORTH
        return (self.RIGHT if (vote > 0) == bool(true) else 1 - self.RIGHT) * 0.5 * self.WORTH

    def fit(self, counts: dict[tuple, int], rounds: int = 30) -> VoteModel:
        """counts: number of candidates by (kind, votes of LABELERS, blanks, marks)."""
        for kind in range(len(KINDS)):
            own = {k[1:]: n for k, n in counts.items() if k[0] == kind}
            self.weights[kind] = self._classifier(self._labels(kind, own, rounds))
        return self

    def _labels(self, kind: int, own: dict[tuple, int], rounds: int) -> list[tuple[tuple, float, float]]:
        """(pattern, candidates, probability that they are what they seem)."""
        width = len(LABELERS)
        belief = {p: 1 / (1 + math.exp(-sum(p[:width]))) for p in own}
        for _ in range(rounds):
            share = [self.WORTH / 2, self.WORTH / 2]
            votes: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for p, n in own.items():
                for true, part in ((0, (1 - belief[p]) * n), (1, belief[p] * n)):
                    share[true] += part
                    for j in range(width):
                        votes[j, p[j]][true] += part
            for j, name in enumerate(LABELERS):
                totals = [sum(votes[j, v][true] + self._prior(v, true) for v in (-1, 0, 1)) for true in (0, 1)]
                self.reliability[kind, name] = {
                    v: tuple((votes[j, v][true] + self._prior(v, true)) / totals[true] for true in (0, 1)) for v in (-1, 0, 1)
                }
            for p in own:
                odds = math.log(share[1] / share[0])
                for j, name in enumerate(LABELERS):
                    no, yes = self.reliability[kind, name][p[j]]
                    odds += math.log(yes / no)
                belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        return [(p, float(n), belief[p]) for p, n in own.items()]

    def _classifier(self, labels: list[tuple[tuple, float, float]], steps: int = 300) -> list[float]:
        """Weights of an intercept and FEATURES; two imagined patterns, all for and all against, keep them in order."""
        rows = [((1.0, *map(float, p[1:])), n, y) for p, n, y in labels]
        rows += [((1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0), 5.0, 0.99), ((1.0, -1.0, -1.0, -1.0, -1.0, 0.0, 0.0), 5.0, 0.01)]
        rows += [((1.0, -1.0, 0.0, 0.0, 1.0, 0.0, 0.0), 5.0, 0.01), ((1.0, 1.0, 0.0, 0.0, -1.0, 0.0, 0.0), 5.0, 0.1)]
        # Counts are damped, so that a common pattern does not silence the rest.
        rows = [(x, math.sqrt(n), y) for x, n, y in rows]
        total = sum(n for _, n, _ in rows)
        w = [0.0] * (len(FEATURES) + 1)
        for _ in range(steps):
            slope = [0.01 * v for v in w]
            for x, n, y in rows:
                z = max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))
                error = (1 / (1 + math.exp(-z)) - y) * n / total
                for j, v in enumerate(x):
                    slope[j] += error * v
            w = [a - 0.5 * s for a, s in zip(w, slope, strict=True)]
        return w

    def probability(self, span: Column) -> Column:
        def score(kind: int) -> Column:
            z = F.lit(self.weights[kind][0])
            for weight, name in zip(self.weights[kind][1:], FEATURES, strict=True):
                z = z + weight * span[name]
            return z

        z = F.when(span["kind"] == 0, score(0)).when(span["kind"] == 1, score(1)).when(span["kind"] == 2, score(2)).otherwise(score(3))
        return 1 / (1 + F.exp(-z))


def find_private(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base, spans) of every row of docs.

    base holds the spans (kind, start, stop) of the base patterns whose check holds: parts of an address up to 255, 16 to
    19 digits that pass Luhn's sum, 8 to 15 digits of a phone. Further candidates are parts of base matches that fail,
    where numbers stand side by side, and written-out or national forms. On every candidate five labelers vote: the base
    pattern, the check, a gazetteer of endings and prefixes, words shortly before, and the neighbouring characters. Candidates
    are counted by pattern of votes (at most 4 x 3^5 x 4 patterns); expectation-maximisation on these counts weighs the
    labelers of each kind, and a logistic classifier without the base pattern's vote is fitted to the result. spans
    holds the base spans, which always stay, and candidates of at least `threshold`, by kind and start. n_... count base
    spans. Places count code points.

    Null counts as empty, empty texts have no spans; every row is answered, repeated ones and those without a doc_id too;
    an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), candidate_spans(text).alias("found")), "private-candidates")
    pattern = ["kind", *LABELERS, "blanks", "marks"]
    counted = found.where(F.size("found") > 0).select(F.inline("found")).groupBy(*pattern).agg(F.count("*").alias("n"))
    model = VoteModel().fit({tuple(r[c] for c in pattern): r["n"] for r in counted.collect()})

    def place(s: Column) -> Column:
        return F.struct(s["kind"], s["start"], s["stop"])

    base = F.filter("found", lambda s: s["regex"] == 1)
    added = F.filter("found", lambda s: (s["regex"] == 0) & (model.probability(s) >= threshold))
    out = found.select(
        "doc_id",
        F.array_sort(F.transform(base, place)).alias("base"),
        F.array_sort(F.transform(F.concat(base, added), place)).alias("spans"),
        F.size(added).cast("long").alias("n_added"),
    )

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return out.select("doc_id", *map(count, range(len(KINDS))), "n_added", "base", "spans")


def spans_text(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """The spans of `find_private` as texts, the base ones as a digest."""
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        "n_added",
    )
