"""Scanning, redacting and projecting untrusted text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail.constants import (
    BLOCK_MARKER,
    BLOCK_MARKER_REPLACEMENT,
    INVISIBLE_CHARS,
    LOG_MAX_CHARS,
    PII_RULES,
    SCAN_RULES,
    SCAN_WORDS,
)
from stagetrail.functions.text import computed_once, is_plain, java_regex, matches, nfkc, non_empty
from stagetrail.functions.urls import first_safe_url

_INVISIBLE = f"[{INVISIBLE_CHARS}]"
_DIGIT_RUN = r"\p{Nd}(?:[ -]?\p{Nd}){3}"


def without_invisible(col: Column) -> Column:
    return F.when(F.rlike(col, F.lit(_INVISIBLE)), F.regexp_replace(col, f"{_INVISIBLE}+", "")).otherwise(col)


def _near(folded: Column, word: str) -> Column:
    plain = word.replace(r"\b", "")
    found = F.contains(folded, F.lit(plain))
    return found if plain == word else found & matches(folded, word)


def _rule_hit(text: Column, folded: Column, name: str, pattern: str) -> Column:
    """Test a rule only on texts that contain one of its words."""
    hit = matches(text, pattern)
    words = SCAN_WORDS.get(name, ()) if (name, pattern) in SCAN_RULES else ()
    return reduce(or_, [_near(folded, w) for w in words]) & hit if words else hit


def scan_untrusted(
    df: DataFrame,
    col: str,
    max_chars: int | None = None,
    rules: Sequence[tuple[str, str]] = SCAN_RULES,
    prefix: str = "",
) -> DataFrame:
    """Add ``text, hits, truncated, ok`` (optionally prefixed) for one text column.

    Normalise, drop invisible characters, then test the rules on what is left: the whole
    text, or its first ``max_chars`` characters where a caller has such a limit. Substring search is far cheaper than
    the rules, so each rule runs only where one of its words occurs.
    """
    text, hits, truncated, ok = (prefix + n for n in ("text", "hits", "truncated", "ok"))
    # One pass finds the few texts that normalising or stripping could change at all.
    scanned = df.withColumn("_raw", F.coalesce(df[col], F.lit("")))
    scanned = scanned.withColumn("_odd", F.when(~is_plain(F.col("_raw")), F.col("_raw")))
    scanned = scanned.withColumn("_normal", nfkc(F.col("_odd")))
    scanned = scanned.withColumn("_visible", without_invisible(F.col("_normal")))
    scanned = scanned.withColumn("_stripped", F.coalesce("_visible", "_raw"))
    shorter = F.coalesce(F.octet_length("_visible") != F.octet_length("_normal"), F.lit(False))
    if max_chars is None:
        cut, was_cut = F.col("_stripped"), F.lit(False)
    else:
        was_cut = F.char_length("_stripped") > max_chars
        cut = F.when(was_cut, F.left("_stripped", F.lit(max_chars))).otherwise(F.col("_stripped"))
    scanned = scanned.withColumns({"_cut": cut, "_shorter": shorter, "_was_cut": was_cut})
    # The rules' case folding takes both Turkish letters for an i.
    scanned = scanned.withColumn("_folded", F.lower(F.replace(F.replace("_cut", F.lit("İ"), F.lit("i")), F.lit("ı"), F.lit("i"))))
    found = [F.when(F.col("_shorter"), F.lit("invisible_chars"))]
    found += [F.when(_rule_hit(F.col("_cut"), F.col("_folded"), name, p), F.lit(name)) for name, p in rules]
    scanned = computed_once(scanned.withColumn("_hits", F.array_compact(F.array(*found))), "_hits")
    kept = [c for c in df.columns if c not in (text, hits, truncated, ok)]
    return scanned.select(
        *kept,
        F.col("_cut").alias(text),
        F.col("_hits").alias(hits),
        F.col("_was_cut").alias(truncated),
        (F.size("_hits") == 0).alias(ok),
    )


def redact(col: Column, rules: Sequence[tuple[str, str]] = PII_RULES) -> Column:
    """Replace personal data by ``<name>``, rule after rule.

    The given rules need an ``@`` or four digits in a row, so most texts are only searched.
    """
    out = F.coalesce(col, F.lit(""))
    if tuple(rules) != PII_RULES:
        return _replaced(out, rules)
    mail, digits = PII_RULES[:1], PII_RULES[1:]
    out = F.when(F.contains(out, F.lit("@")), _replaced(out, mail)).otherwise(out)
    return F.when(F.rlike(out, F.lit(_DIGIT_RUN)), _replaced(out, digits)).otherwise(out)


def _replaced(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for name, pattern in rules:
        col = F.regexp_replace(col, java_regex(pattern), f"<{name}>")
    return col


def log_safe(col: Column, limit: int = LOG_MAX_CHARS) -> Column:
    return F.left(redact(without_invisible(F.coalesce(col, F.lit("")))), F.lit(limit))


def neutralize_markers(col: Column) -> Column:
    """Block markers inside data lose their meaning."""
    return F.regexp_replace(col, java_regex(BLOCK_MARKER), BLOCK_MARKER_REPLACEMENT)


def joined_fields(fields: Sequence[Column], lists: Sequence[Column] = ()) -> Column:
    """Non-empty parts of a record as one text."""
    parts = F.array(*[non_empty(c) for c in fields])
    for extra in lists:
        parts = F.concat(parts, F.coalesce(extra, F.array().cast("array<string>")))
    return F.array_join(F.filter(parts, lambda p: p != ""), " \n")


def private_rules(markers: Sequence[str], rules: Sequence[tuple[str, str]] = SCAN_RULES) -> tuple[tuple[str, str], ...]:
    """The rules with names of private folders, files or tables added to ``path_exfil``."""
    more = "|".join(re.escape(m) for m in markers)
    return tuple((n, f"{p[:-1]}|{more})" if n == "path_exfil" and more else p) for n, p in rules)


def record_hits(
    df: DataFrame,
    fields: Sequence[str],
    lists: Sequence[str] = (),
    out: str = "hits",
    rules: Sequence[tuple[str, str]] = SCAN_RULES,
) -> DataFrame:
    """Sorted distinct rule hits over several fields of a record, each read whole."""
    joined = df.withColumn("_joined", joined_fields([df[c] for c in fields], [df[c] for c in lists]))
    scanned = scan_untrusted(joined, "_joined", rules=rules, prefix="_scan_")
    return scanned.withColumn(out, F.array_sort(F.array_distinct("_scan_hits"))).select(*df.columns, out)


def hit_summary(scanned: DataFrame, hits: str = "hits") -> DataFrame:
    return scanned.select(F.explode(hits).alias("hit")).groupBy("hit").agg(F.count(F.lit(1)).alias("n"))


def _filled(variant: Column) -> Column:
    empty = F.to_json(variant).isin("null", "[]", "{}", '""', "false", "0")
    return variant.isNotNull() & ~F.coalesce(empty, F.lit(False))


def intake_links(updates: DataFrame, allowed_chats: DataFrame | Sequence[int], max_chars: int | None = None) -> DataFrame:
    """Chat updates to ``(update_id, chat_id, url, text, truncated)``.

    Unknown senders, media messages and messages without a safe URL are dropped. The
    whole text is scanned and kept only when nothing is found in it; ``max_chars`` cuts what is kept.
    """
    has_message = F.col("message").isNotNull() & (F.to_json("message") != "{}")
    messages = updates.select(
        "update_id", F.when(has_message, F.col("message")).otherwise(F.col("edited_message")).alias("m")
    )
    rows = messages.select(
        "update_id",
        F.col("m.chat.id").alias("chat_id"),
        F.coalesce(non_empty(F.col("m.text")), non_empty(F.col("m.caption")), F.lit("")).alias("body"),
        F.when(F.size("m.entities") > 0, F.col("m.entities")).otherwise(F.col("m.caption_entities")).alias("marks"),
        (_filled(F.col("m.photo")) | _filled(F.col("m.document"))).alias("media"),
    ).filter(~F.col("media"))
    if isinstance(allowed_chats, DataFrame):
        senders = allowed_chats.select(F.col(allowed_chats.columns[0]).alias("chat_id")).distinct()
        rows = rows.join(senders, "chat_id", "left_semi")
    else:
        rows = rows.filter(F.col("chat_id").isin(*allowed_chats))
    linked = computed_once(rows.withColumn("url", first_safe_url(F.col("body"), F.col("marks"))), "url")
    scanned = scan_untrusted(linked.filter(F.col("url").isNotNull()), "body")
    text, truncated = F.col("text"), F.col("truncated")
    if max_chars is not None:
        text, truncated = F.left(text, F.lit(max_chars)), F.char_length(text) > max_chars
    return scanned.select("update_id", "chat_id", "url", F.when(F.col("ok"), non_empty(text)).alias("text"), truncated.alias("truncated"))
