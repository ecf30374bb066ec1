"""Exact dedup by progressive refinement: length, then a hash of the text's beginning, then a hash of all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import discard, own_exchange, own_text, stored

#: Characters the second step looks at; the third compares whole texts, so this bounds work, not results.
PREFIX = 64


def exact_groups(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of docs; of equal texts the largest doc_id stays.

    1. Texts are grouped by byte length; 2. those that share it by a hash of their first characters; 3. only documents
    that share both are grouped by the digest of the whole text (SHA-256), which every row carries out of the same pass.
    Every step shuffles a few numbers or the digest per row, never a text, and no group of copies meets in one task.

    Null counts as empty. A null doc_id takes part as the smallest. Rows that share a doc_id and a text stay or go
    together. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size, head = F.octet_length(text).cast("long").alias("size"), F.xxhash64(F.substring(text, 1, prefix)).alias("head")
    slim = stored(docs.select(F.col("doc_id").cast("long"), size, head), "exact-slim")
    sizes = slim.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select(own_exchange("size").alias("k"))
    # A key of its own makes the count combine rows before it shuffles; the join's partitions by length may be hot.
    alike = slim.join(sizes, F.col("size") == F.col("k"), "left_semi").select(own_exchange("size").alias("size"), "head")
    heads = alike.groupBy("size", "head").agg(F.count("*").alias("n")).where("n > 1")
    heads = heads.select(own_exchange("size").alias("k"), own_exchange("head").alias("h"))
    refined = slim.join(heads, (F.col("size") == F.col("k")) & (F.col("head") == F.col("h")), "left")
    refined = stored(refined.select("doc_id", "size", "head", F.col("k").isNotNull().alias("open")), "exact-open")
    discard(slim)

    ids = refined.where("open").select(F.col("doc_id").alias("i"), F.col("size").alias("k"), F.col("head").alias("h"), "open").distinct()
    whole = docs.select(F.col("doc_id").cast("long"), size, head, F.sha2(text, 256).alias("text_sha256"))
    survives = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("k")) & (F.col("head") == F.col("h"))
    read = whole.join(ids, survives, "left").select("doc_id", "text_sha256", F.col("open").isNotNull().alias("open"))
    read = stored(read, "exact-full")
    alone = read.where("not open").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    open_ = read.where("open")
    groups = open_.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select(own_text("text_sha256").alias("f"), "keep_id", "group_size")
    grouped = open_.join(groups, F.col("text_sha256") == F.col("f")).select("doc_id", "keep_id", "group_size", "text_sha256")
    return alone.unionByName(grouped).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
