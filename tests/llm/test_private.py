"""Personal data: base spans against plain Python, added spans against planted ones."""

import hashlib
import random
import re

import pytest
from brute import DOCS, prose, vocabulary
from pyspark.sql import functions as F

from stagetrail.llm import private, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((kind, m.start(), m.end()))
    return found


def card(rng, n=16):
    head = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(head + c for c in "0123456789" if luhn(head + c))


def run(spark, texts, extra=False):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    if extra:
        docs = docs.withColumns({c: F.lit("x") for c in ("found", "spans", "base", "kind", "start", "n_email", "regex", "value")})
    return {r["doc_id"]: r for r in private.digests(private.find_private(docs)).collect()}


def check(got, texts):
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        want = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (text or "")[:200]
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in got[i]["spans"].split(",") if s)]
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s[0]), s[1]))


def odd_texts():
    rng = random.Random(1)
    alphabet = ["a", "b.", "@", "é", "_", "-", ".", "+", " ", "1", "22", "255", "256", "0300", "(", ")", "a@b.c", "x@y", "1.2.3.4", "\n", "😀", "4111 1111 1111 1111", "+1 (2"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]


def test_base_spans_of_odd_texts(spark):
    texts = [None, "", " ", "a@b.cc_d@e.f", "a@b.c..d@e.f", "x@y.z-@q.r", "1.2.3.4.5.6.7.8", "999.1.1.1", "00255.1.1.1", "1.1.1.0000256", "+1", "+12", "+1 2", *odd_texts()]
    check(run(spark, texts, extra=True), texts)


def test_long_texts(spark):
    rng = random.Random(2)
    many = " ".join(f"u{i}@mail.org {i % 256}.1.2.3, {card(rng)}; +1 (555) 555-{i % 10000:04d}." for i in range(3000))
    texts = ["a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" + "b." * 100_000, "+" + "1" * 100_000, "+1" + "(" * 100_000, "4 " * 100_000, "a.b" * 60_000 + "@c.d", many, "é😀" * 50_000 + many[:500]]
    check(run(spark, texts), texts)


def test_numbers_side_by_side_are_added(spark):
    """Phone before card, card before address, card before card: the base patterns take both as one match and drop it."""
    rng = random.Random(3)
    words = vocabulary(rng, 300)
    texts, planted = [], []
    for i in range(600):
        phone, number, other = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}", card(rng), card(rng)
        address = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        parts = [[phone], [number], [address], [phone, number], [number, other], [phone, address], [number, address], [f"a{i}@mail.example.com"]][i % 8]
        before = prose(rng, 8, words) + " "
        texts.append(before + " ".join(parts) + ". " + prose(rng, 5, words))
        at, own = len(before), []
        for p in parts:
            own.append(("phone" if p[0] == "+" else "email" if "@" in p else "ip" if "." in p else "card", at, at + len(p)))
            at += len(p) + 1
        planted.append(own)
    clean = [prose(rng, 60, words) + f" in {rng.randint(1900, 2030)}, {rng.randint(1, 99)} of {rng.randint(100, 99999)}." for _ in range(300)]
    clean += [f'token = "{rng.getrandbits(160):040x}" ' + prose(rng, 9, words) for _ in range(200)]
    got = run(spark, texts + clean)
    check(got, texts + clean)
    spans = [{(k, int(a), int(b)) for k, a, b in (s.split(":") for s in got[i]["spans"].split(",") if s)} for i in range(len(got))]
    hits = sum(s in spans[i] for i, own in enumerate(planted) for s in own)
    print("found", hits, "of", sum(map(len, planted)), "added", sum(got[i]["n_added"] for i in range(len(texts))), "in clean", sum(map(len, spans[len(texts) :])))
    assert hits >= 0.98 * sum(map(len, planted))
    assert sum(bool(s) for s in spans[len(texts) :]) <= 0.01 * len(clean)
    assert sum(len(spans[i] - set(own)) for i, own in enumerate(planted)) <= 0.1 * len(texts)


def test_model_learns_which_labelers_to_trust():
    """A labeler that says the opposite of all others loses its weight; one that agrees with the truth gains."""
    rng = random.Random(4)
    counts = {}
    for _ in range(4000):
        true = rng.random() < 0.6
        def says(right, true=true):
            return (1 if true else -1) * (1 if rng.random() < right else -1)
        key = (2, int(true and rng.random() < 0.8), says(0.97), says(0.9), says(0.5), says(0.85), 0, 0)
        counts[key] = counts.get(key, 0) + 1
    model = private.VoteModel().fit(counts)
    def gap(name):
        votes = model.reliability[2, name]
        return votes[1][1] - votes[1][0]
    assert gap("check") > 0.85 and gap("gazetteer") > 0.7 and abs(gap("context")) < 0.15
    w = dict(zip(private.FEATURES, model.weights[2][1:], strict=True))
    assert w["check"] > w["neighbours"] > abs(w["context"])


def test_empty_table_and_repeated_rows(spark):
    assert private.find_private(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a@b.org", None, None, None)] * 3 + [(None, None, None, None, None), (7, "a@b.org", "x", "y", 1)]
    got = private.digests(private.find_private(spark.createDataFrame(rows, DOCS))).collect()
    assert sorted((r["doc_id"] or 0, r["n_email"], r["spans"]) for r in got) == [(0, 0, ""), *[(0, 1, "email:0:7")] * 3, (7, 1, "email:0:7")]


def test_no_python_on_executors(spark):
    plan = private.find_private(spark.createDataFrame([(1, "a@b.org", "", "", 1)], DOCS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op11_private(spark, folder).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
