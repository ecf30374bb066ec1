"""The operators' queries over whole tables, and the oracle SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.llm import lines
from stagetrail.llm.centroids import cluster_vectors
from stagetrail.llm.collocations import collocations
from stagetrail.llm.common import table
from stagetrail.llm.exact import exact_groups
from stagetrail.llm.language import predict_languages
from stagetrail.llm.nearest import nearest_neighbours
from stagetrail.llm.packing import pack
from stagetrail.llm.paragraphs import duplicate_passages
from stagetrail.llm.pieces import encode_documents
from stagetrail.llm.private import digests, find_private
from stagetrail.llm.simhash import simhash_components
from stagetrail.llm.toxicity import severity
from stagetrail.llm.urls import judge_urls

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Host, path and verdict of the listed URLs.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return severity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_passages(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"), PIECE_MODEL, digests=True)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(table(spark, folder, "documents"), words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), WORD_TOKENIZER)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return predict_languages(table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_site_lines(table(spark, folder, "pages"))


def op11_private(spark: SparkSession, folder: str) -> DataFrame:
    return digests(find_private(table(spark, folder, "documents")))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"), clusters=40, rounds=5, dims=64, scale=256, seed="2:")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"), least=100, depth=5, top=2000)


_URL_PARTS = """
    SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT *, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
          FROM pages)"""


def _replaced(text: str) -> str:
    for pattern, by in ((lines.COMMENT, "''"), (lines.HIDDEN, "''"), (lines.BLOCK_TAG, "chr(10)"), (lines.TAG, "''")):
        text = f"regexp_replace({text}, '{pattern}', {by}, 'g')"
    return text


def _centroids_sql(clusters: int = 40, rounds: int = 5) -> str:
    """The rounds written out one after another; sums of integers this small are exact as doubles."""
    parts = [
        """kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = 64 AND len(embedding) = 64)""",
        f"""c0 AS MATERIALIZED (
    SELECT k, v FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM kept) WHERE k < {clusters})""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
    SELECT row, min({{'d': list_inner_product(kept.v, kept.v) - 2 * list_inner_product(kept.v, c.v) + list_inner_product(c.v, c.v), 'k': k}}) AS best
    FROM kept, c{i} AS c GROUP BY row)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(m.v, c.v) AS v
    FROM c{i} AS c LEFT JOIN (
        SELECT k, list(floor(total / n) ORDER BY j) AS v
        FROM (SELECT best.k AS k, j, sum(x) AS total, count(*) AS n
              FROM (SELECT row, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept) JOIN a{i} USING (row) GROUP BY best.k, j)
        GROUP BY k) AS m ON c.k = m.k)"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} AS c ON best.k = c.k"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_nearest_neighbours, op3_substring_dedup, op4_url_filter, op5_pieces,
        op6_exact_dedup, op7_simhash, op8_packing, op9_language, op10_line_dedup,
        op11_private, op12_centroids, op13_collocations,
    )
}

ORACLES = {
    "op4_url_filter": f"""
WITH parts AS ({_URL_PARTS}),
numbered AS (SELECT page_id, host, path, row_number() OVER () AS row FROM parts),
rules(r_host, r_path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
fits AS (
    SELECT row, r_host || r_path AS rule, verdict,
           row_number() OVER (PARTITION BY row ORDER BY length(r_host || r_path) DESC, r_host || r_path DESC) AS place
    FROM numbered JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM numbered LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (row)""",
    "op6_exact_dedup": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)""",
    "op10_line_dedup": f"""
WITH parts AS ({_URL_PARTS}),
parsed AS (
    SELECT page_id, host, row_number() OVER () AS row,
           list_filter(list_transform(string_split({_replaced("coalesce(html, '')")}, chr(10)),
                                      lambda x: regexp_replace(x, '{lines.EDGES}', '', 'g')), lambda x: x <> '') AS found
    FROM parts),
totals AS (SELECT host, count(*) AS total FROM parsed GROUP BY host),
common AS (
    SELECT host, list(line) AS common
    FROM (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(found)) AS line FROM parsed) GROUP BY host, line)
    JOIN totals USING (host) WHERE n - 1 > (total - 1) * {lines.RATIO} GROUP BY host),
cut AS (
    SELECT page_id, host, found, CASE WHEN common IS NULL THEN found
           ELSE list_filter(found, lambda x: NOT list_contains(common, x)) END AS kept
    FROM parsed LEFT JOIN common USING (host))
SELECT page_id, host, CAST(len(found) AS BIGINT) AS lines, CAST(len(found) - len(kept) AS BIGINT) AS dropped,
       coalesce(array_to_string(kept, chr(10)), '') AS text
FROM cut""",
    "op12_centroids": _centroids_sql(),
    "op13_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded),
spans AS (SELECT lang, w, i, unnest(generate_series(1, least(5, len(w) - i + 1))) AS d FROM places),
counts AS MATERIALIZED (
    SELECT lang, array_to_string(w[i : i + d - 1], ' ') AS phrase, d, count(*) AS f FROM spans GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE d = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, phrase, d, f AS a FROM counts WHERE d > 1 AND f >= 100),
inner_ AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM candidates AS c JOIN candidates AS o ON o.lang = c.lang AND o.d > c.d AND 100 * o.a >= 100 * c.a
    WHERE contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS left_, array_to_string(w[k + 1 : d], ' ') AS right_
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(generate_series(1, d - 1)) AS k
          FROM candidates ANTI JOIN inner_ USING (lang, phrase))),
scored AS (
    SELECT cuts.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts JOIN counts AS x ON x.lang = cuts.lang AND x.phrase = left_
    JOIN counts AS y ON y.lang = cuts.lang AND y.phrase = right_ JOIN totals ON totals.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
}
