"""The registered queries over the small tables, and the pipeline stage by stage, against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import DOCS, classes, fingerprint
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from check import TABLES, normal
from stagetrail.llm import language, queries
from stagetrail.llm.paragraphs import LEAST_WORDS, LONG_RUN, PIECES, SEEDS, WordHashes, content_pieces, split_paragraphs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_registration():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    cur = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(cur.fetchall(), columns)


def test_pieces(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in queries.op5_pieces(spark, FOLDER).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_simhash(spark, texts):
    want = {i: fingerprint(t, 4) for i, t in texts.items()}
    root = classes(sorted(want), lambda a, b: (want[a] ^ want[b]).bit_count() <= 4)
    got = queries.op7_simhash(spark, FOLDER).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{v:016x}" for i, v in want.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == root


def test_severity_and_language_cover_every_document(spark, texts):
    assert {r["doc_id"] for r in queries.op1_toxicity(spark, FOLDER).collect()} == set(texts)
    assert {r["doc_id"] for r in queries.op9_language(spark, FOLDER).collect()} == set(texts)


# ---- the pipeline ----


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, as the check writes and rereads them."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        assert name == "packing" or before.columns == after.columns
        assert name == "packing" or [f.dataType for f in before.schema] == [f.dataType for f in after.schema]


def test_language_stage_keeps_clean_documents(stages):
    before, after = map(of, stages["language"])
    gone = set(before) - set(after)
    assert {i: before[i] for i in after} == after
    assert all(i in gone for i, t in before.items() if not re.search(r"[^\W\d_]", t or ""))
    assert len(gone) <= 0.02 * len(before) + sum(not re.search(r"[^\W\d_]", t or "") for t in before.values())


def test_exact_stage(stages):
    before, after = map(of, stages["exact_dedup"])
    assert after == {max(i for i, u in before.items() if u == t): t for t in before.values()}


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").lower())


def shingles(w, size=5):
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}


def linked(sets, similarity=0.8):
    """Pairs of keys whose sets have the similarity, among those that share something."""
    holders, found = {}, set()
    for p, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(p)
    for ps in holders.values():
        for i, p in enumerate(ps):
            for q in ps[:i]:
                if (q, p) not in found and len(sets[p] & sets[q]) >= similarity * len(sets[p] | sets[q]):
                    found.add((q, p))
    return found


def roots(keys, pairs):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for p, q in pairs:
        a, b = sorted((find(p), find(q)))
        root[b] = a
    return {k: find(k) for k in keys}


def test_near_stage(stages):
    """Against all pairs: the smallest doc_id stays of texts linked by a Jaccard similarity of 0.8 of five-word shingles."""
    before, after = map(of, stages["near_dedup"])
    sets = {i: shingles(words_of(t), corpus_pipeline.WORDS) for i, t in before.items()}
    root = roots(sets, linked(sets, corpus_pipeline.SIMILARITY))
    assert after == {i: before[i] for i in set(root.values())}


def test_substring_stage(stages):
    """Against all pairs of paragraphs and all equal pieces of lines that share a seed: whatever stands after the first of its kind is cut out."""
    before, after = map(of, stages["substring_dedup"])
    sets, keys = {}, {}
    for d, t in before.items():
        for a, b in split_paragraphs(t):
            if len(words_of(t[a:b])) >= LEAST_WORDS:
                sets[d, a, b] = shingles(words_of(t[a:b]))
                keys.setdefault(" ".join(words_of(t[a:b])), []).append((d, a, b))
    same = {(ps[0], p) for ps in keys.values() for p in ps[1:]}
    root = roots(sets, linked(sets) | same)
    gone = {p for p in sets if root[p] != p}
    inexact = {p for p in gone if words_of(before[p[0]][p[1] : p[2]]) != words_of(before[root[p][0]][root[p][1] : root[p][2]])}
    lines, seeds, known = {}, {}, WordHashes()
    for d, t in sorted(before.items()):
        a = 0
        for line in t.split("\n"):
            at = [m.span() for m in re.finditer("[^\x20\x09-\x0d]+", line)]
            words = tuple(words_of(line))
            if len(at) >= LONG_RUN and words not in lines:
                hashes = known.of([w.encode() for w in words])
                lines[words] = (hashes, [(d, a + at[i][0], a + at[i + LEAST_WORDS - 1][1]) for i in range(len(at) - LEAST_WORDS + 1)])
                for i in content_pieces(hashes, np.zeros(len(words), int), SEEDS)[0].tolist():
                    seeds.setdefault(tuple(words[i : i + LEAST_WORDS]), []).append(words)
            a += len(line) + 1
    pieces = {}
    for words in {w for ws in seeds.values() if len(ws) > 1 for w in ws}:
        hashes, places = lines[words]
        for i in content_pieces(hashes, np.zeros(len(words), int), PIECES)[0].tolist():
            p = places[i]
            if not any(g[0] == p[0] and g[1] < p[2] and p[1] < g[2] for g in inexact):
                pieces.setdefault(tuple(words[i : i + LEAST_WORDS]), []).append(p)
    gone |= {p for ps in pieces.values() for p in sorted(ps)[1:]}
    for d, text in before.items():
        cut = sorted((a, b) for (i, a, b) in gone if i == d)
        at, left = 0, []
        for a, b in cut:
            left.append(text[at:a])
            at = max(at, b)
        left = "".join([*left, text[at:]])
        assert words_of(after.get(d, "")) == words_of(left) and (cut or after[d] == text)


def test_packing_stage(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before.collect()}
    fill = {}
    for r in rows:
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in fill.values():
        assert [o for o, _ in sorted(held)] == list(np.cumsum([0] + [n for _, n in sorted(held)])[:-1])
    total = sum(r["length"] for r in rows)
    assert len(fill) <= 1.02 * total / 2048 + 3


def test_run_is_the_stages_in_order(spark, stages):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").collect())
    assert got == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages["packing"][1].collect())


def test_stages_on_empty_and_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c", "en", None, None), (2, "a b c", "en", None, None), (3, "a b c", None, "s", 5)], DOCS)
    odd = odd.withColumns({c: F.lit("x") for c in ("language", "fp", "start", "_guess", "keep_id", "share")})
    for k, docs in enumerate((empty, odd)):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, FOLDER).write.parquet(str(tmp_path / f"{k}-{name}"))
    assert spark.read.parquet(str(tmp_path / "1-exact_dedup")).where("doc_id = 3").count() == 1
    assert language.UNKNOWN not in corpus_pipeline.STAGES[0]
