"""Extraction replies to clean records, review routing and found events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail import constants as C
from stagetrail.functions.identity import event_id, strict_json
from stagetrail.functions.text import blank_to_null, java_regex, matches, non_empty, strip
from stagetrail.functions.titles import keywords, title_family

def with_reply_object(df: DataFrame, reply: str, out: str = "doc") -> DataFrame:
    """Add the JSON object inside a free-text reply as a variant, NULL when there is none.

    A fenced block wins; otherwise the outermost braces are taken.
    """
    fence = java_regex(C.REPLY_FENCE)
    rows = df.withColumn("_reply", strip(F.coalesce(df[reply], F.lit(""))))
    fenced = F.contains("_reply", F.lit("```")) & F.rlike("_reply", F.lit(fence))
    rows = rows.withColumn("_body", F.when(fenced, strip(F.regexp_extract("_reply", fence, 1))).otherwise(F.col("_reply")))
    rows = rows.withColumns(
        {"_first": F.locate("{", F.col("_body")), "_last": F.char_length("_body") - F.locate("}", F.reverse("_body")) + 1}
    )
    braces = (F.col("_first") > 1) & F.contains("_body", F.lit("}")) & (F.col("_last") > F.col("_first"))
    cut = F.when(braces, F.substr(F.col("_body"), F.col("_first"), F.col("_last") - F.col("_first") + 1))
    rows = rows.withColumn("_json", cut.otherwise(F.col("_body")))
    rows = rows.withColumn("_parsed", strict_json(F.col("_json")))
    is_object = F.startswith(F.schema_of_variant("_parsed"), F.lit("OBJECT"))
    return rows.select(*[c for c in df.columns if c != out], F.when(is_object, F.col("_parsed")).alias(out))


def contact(text: Column) -> Column:
    """Of a stripped text: a whole e-mail, phone or URL as it is, else the first one found inside, else NULL."""
    whole = reduce(lambda a, b: a | b, [matches(text, p) for p in C.CONTACT_WHOLE])
    branch = F.when(whole, text)
    for pattern in C.CONTACT_SEARCH:
        found = F.regexp_extract(text, java_regex(pattern), 0)
        branch = branch.when(matches(text, pattern), F.rtrim(found, F.lit(C.CONTACT_TAIL)))
    return branch


def normalize_records(df: DataFrame, col: str = "doc", max_items: int | None = None, max_chars: int | None = None) -> DataFrame:
    """Add ``record`` (struct, NULL when invalid) and ``invalid`` (first bad field) for a variant column.

    A NULL variant is invalid as a whole. Members of the wrong type make the record
    invalid; blanks become NULL; unusable contacts, list items and confidence keys
    are dropped without failing it. ``max_items`` requirements of ``max_chars`` characters
    are kept if a caller limits them.
    """
    names = (*C.RECORD_FIELDS, "language", "confidence", "field_confidence")
    texts = ("title", "company", "location", "contact")
    get = lambda n, t: F.try_variant_get(F.col(f"_v_{n}"), "$", t)
    kind = {n: F.col(f"_k_{n}") for n in names}
    rows = df.withColumns({f"_v_{n}": F.try_variant_get(df[col], f"$.{n}", "variant") for n in names})
    rows = rows.withColumns({f"_k_{n}": F.schema_of_variant(f"_v_{n}") for n in names})

    number = kind["confidence"].isin("STRING", "BOOLEAN", "BIGINT", "DOUBLE", "FLOAT") | F.startswith(
        kind["confidence"], F.lit("DECIMAL")
    )
    items = get("requirements", "array<variant>")
    rows = rows.withColumns(
        {
            **{f"_t_{n}": blank_to_null(get(n, "string")) for n in texts},
            "_items": items if max_items is None else F.slice(items, 1, max_items),
            "_scores": F.transform_values(
                get("field_confidence", "map<string,variant>"), lambda _k, v: F.try_variant_get(v, "$", "double")
            ),
            "_language": get("language", "string"),
            "_confidence": F.when(kind["confidence"].isNull(), F.lit(0.0)).when(number, get("confidence", "double")),
        }
    )
    said = F.transform("_items", lambda v: F.when(F.schema_of_variant(v) == "STRING", strip(F.try_variant_get(v, "$", "string"))))
    requirements = F.filter(said, lambda t: t != "")
    if max_chars is not None:
        requirements = F.transform(requirements, lambda t: F.left(t, F.lit(max_chars)))
    known = F.map_filter("_scores", lambda k, _v: k.isin(*C.RECORD_FIELDS, "language"))
    clamped = F.transform_values(known, lambda _k, v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))

    bad = [
        *((n, ~kind[n].isin("STRING", "VOID")) for n in texts),
        ("requirements", ~F.startswith(kind["requirements"], F.lit("ARRAY")) & (kind["requirements"] != "VOID")),
        ("language", (kind["language"] != "VOID") & ~F.coalesce(F.col("_language").isin(*C.RECORD_LANGUAGES), F.lit(False))),
        ("confidence", ~F.coalesce(F.col("_confidence").between(0.0, 1.0), F.lit(False))),
        ("field_confidence", ~F.startswith(kind["field_confidence"], F.lit("OBJECT"))),
        ("field_confidence", F.exists(F.map_values("_scores"), lambda v: v.isNull())),
    ]
    invalid = F.when(df[col].isNull(), F.lit("document"))
    for name, broken in bad:
        invalid = invalid.when(broken, F.lit(name))
    record = F.struct(
        F.col("_t_title").alias("title"),
        F.col("_t_company").alias("company"),
        F.coalesce(requirements, F.array().cast("array<string>")).alias("requirements"),
        F.col("_t_location").alias("location"),
        contact(F.col("_t_contact")).alias("contact"),
        F.col("_language").alias("language"),
        F.col("_confidence").alias("confidence"),
        F.coalesce(clamped, F.create_map().cast("map<string,double>")).alias("field_confidence"),
    )
    checked = rows.withColumn("invalid", invalid)
    whole = F.when(F.col("invalid").isNull(), record).alias("record")
    return checked.select(*[c for c in df.columns if c not in ("invalid", "record")], "invalid", whole)


def review_reasons(record: Column, hits: Column) -> Column:
    """Why a record needs a human; an invalid one is reported as just that."""
    reasons = F.array_compact(
        F.array(
            F.when(record["confidence"] < C.REVIEW_CONFIDENCE, F.lit("low_confidence")),
            F.when(record["title"].isNull(), F.lit("missing_title")),
            F.when(record["company"].isNull(), F.lit("missing_company")),
            F.when(F.size(hits) > 0, F.lit("injection_hits")),
        )
    )
    return F.when(record.isNull(), F.array(F.lit("validation_failed"))).otherwise(reasons)


def safe_file_ref(file_id: Column) -> Column:
    """Relative reference that cannot climb out of its root."""
    parts = F.split(F.replace(file_id, F.lit("\\"), F.lit("/")), "/")
    return F.coalesce((file_id != "") & (F.element_at(parts, 1) != "") & ~F.array_contains(parts, ".."), F.lit(False))


def image_found_events(records: DataFrame, title_chars: int | None = None) -> DataFrame:
    """Found event per record ``(sha256, queued_at, record)``; queue time makes the id repeatable."""
    title = F.coalesce("record.title", F.lit(""))
    if title_chars is not None:
        title = F.left(title, F.lit(title_chars))
    job_id = F.concat(F.lit(C.IMAGE_JOB_PREFIX), F.left("sha256", F.lit(12)))
    payload = F.struct(
        non_empty(F.col("record.company")).alias("company"),
        non_empty(title).alias("title"),
        non_empty(F.col("record.location")).alias("location"),
        F.lit(C.IMAGE_ORIGIN).alias("origin"),
    )
    rows = records.withColumn("_ts", F.col("queued_at").try_cast("timestamp"))
    return rows.select(
        event_id(job_id, F.lit("found"), F.col("_ts")).alias("event_id"),
        job_id.alias("job_id"),
        F.lit("found").alias("event_type"),
        F.col("_ts").alias("ts"),
        F.lit(None).cast("string").alias("cv_version"),
        title_family(title).alias("title_family"),
        keywords(title).alias("keywords"),
        F.lit("image").alias("source_type"),
        F.parse_json(F.to_json(payload)).alias("payload"),
        F.lit(None).cast("timestamp").alias("exported_at"),
    )
