"""URL rules: a blocked Bloom filter passes possible hits to an exact join that removes false positives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A block is four longs; a key sets PROBES of its 256 bits.
WORDS, PROBES, BITS_PER_KEY = 4, 6, 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: F.Column) -> F.Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: F.Column) -> F.Column:
    """After the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: F.Column) -> F.Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _block(key: F.Column, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _with_masks(keys: DataFrame, blocks: int) -> DataFrame:
    own = F.xxhash64("key", F.lit(1))
    bits = {f"b{i}": F.shiftrightunsigned(own, 8 * i).bitwiseAND(F.lit(64 * WORDS - 1)) for i in range(PROBES)}
    marked = keys.withColumns({"block": _block(F.col("key"), blocks), **bits})

    def mask(word: int) -> F.Column:
        sets = [f"if(shiftright(b{i}, 6) = {word}, shiftleft(1L, cast(b{i} & 63 as int)), 0L)" for i in range(PROBES)]
        return F.expr(" | ".join(sets))

    return marked.withColumns({f"m{w}": mask(w) for w in range(WORDS)}).drop(*bits)


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the blocked Bloom filter of the strings in `key`."""
    merged = [F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)]
    return _with_masks(keys.select("key"), blocks).groupBy(F.col("block").alias("filter_block")).agg(*merged)


def possible(keys: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """Rows of `keys` whose every bit is set in their block; about one row in thousands that is not listed passes too."""
    tested = _with_masks(keys, blocks).join(filter_blocks, F.col("block") == F.col("filter_block"))
    hit = reduce(lambda a, b: a & b, [F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}") for w in range(WORDS)])
    return tested.where(hit).select(keys.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", otherwise: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of pages.

    `rules` lists canonical URLs as (host, path, verdict); the path is empty or starts with `/`. A rule fits its host and
    all subdomains if the url's path starts with the rule's; the longest rule (host and path together) wins, at equal
    length the larger string. A URL that no rule fits gets `otherwise` and a null rule. If a rule is listed with several
    verdicts, the smallest string holds (allow before block).

    Distinct (host, path) pairs are turned into the rules that could fit them: every suffix of the host at a dot that has
    no more labels than the longest rule's host, with every prefix of the path that has the length of some rule's path. The filter removes nearly all of them, block by
    block, and the exact join the rest of the false ones. Rules with a null are ignored; null urls have an empty host
    and path; repeated rows are judged alike; an empty table of pages or rules works; other columns are ignored.
    """
    listed = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
    listed = listed.groupBy(F.concat("host", "path").alias("key"), F.length("path").alias("size")).agg(F.min("verdict").alias("verdict"))
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect())  # no more than a URL has characters
    most = rules.dropna().agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1  # no host has more labels than characters
    blocks = max(1, -(-listed.count() * BITS_PER_KEY // (64 * WORDS)))

    parts = pages.select(F.col(id_column), url_host(F.col("url").cast("string")).alias("host"), url_path(F.col("url").cast("string")).alias("path"))
    labels = F.split("host", r"\.")
    first = F.greatest(F.size(labels) - (most - 1), F.lit(1))
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    pairs = parts.select("host", "path").distinct()
    pairs = pairs.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
    keys = pairs.select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
    keys = keys.select("host", "path", F.concat("suffix", "prefix").alias("key"))
    hits = possible(keys, bloom_blocks(listed, blocks), blocks)
    exact = hits.join(listed.select(F.col("key").alias("rule"), "verdict"), F.col("key") == F.col("rule"))
    best = exact.groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(F.max(F.struct(F.length("rule"), "rule", "verdict")).alias("best"))
    best = best.select(F.concat("h", F.lit("")).alias("h"), F.concat("p", F.lit("")).alias("p"), "best.rule", "best.verdict")
    judged = parts.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return judged.select(id_column, "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
