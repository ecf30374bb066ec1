"""Lifecycle events made from the ``events`` table, and the views over them."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.constants import TITLE_FAMILIES
from stagetrail.operators import quality
from stagetrail.operators.dedup import duplicate_groups, table_counts
from stagetrail.operators.derive import derive_events, outcome_events
from stagetrail.operators.reconcile import dropped_jobs, events_by_type, reconcile
from stagetrail.operators.sync import decide, decision_counts, next_fingerprints, to_append
from stagetrail.functions.identity import event_id
from stagetrail.plans import funnel, views
from stagetrail.plans.sync_run import run_sync, start_sync
from stagetrail.sources.key_index import KeyIndex
from stagetrail.session import run_folder
from stagetrail.sources.event_table import duplicate_report, read_events, table_rows, write_clustered
from stagetrail.streaming.stability import stable_files
from stagetrail.workload.registry import Tables, query

NOW = datetime(2024, 1, 31)
CUTOFF = datetime(2024, 1, 20, 12)
EARLY = datetime(2024, 1, 10)
# In the adapter the event id fixes these columns, as real ids do.
COVERS = ("job_id", "event_type", "ts")

_STAGE = {"view": "found", "click": "applied", "purchase": "reply", "error": "reject", "signup": "draft_created"}
_REEXPORTED = ("applied", "reply")


def single_exports(t: Tables) -> DataFrame:
    """Each event exported once: an entity is a user on a day."""
    k = F.get_json_object("props", "$.k").cast("int")
    stage = F.create_map(*[F.lit(x) for pair in _STAGE.items() for x in pair])
    family = F.element_at(F.array(*[F.lit(f) for f in TITLE_FAMILIES]), (k % 8 + 1).cast("int"))
    return t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("job_id"),
        stage[F.col("event_type")].alias("event_type"),
        "ts",
        F.concat(F.lit("cv-"), (k % 5).cast("string")).alias("cv_version"),
        family.alias("title_family"),
        F.split(family, "_").alias("keywords"),
        F.lit("text").alias("source_type"),
        F.format_string('{"company":"c%d","title":"t%d"}', k, "user_id").alias("payload"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("exported_at"),
    )


def _again(once: DataFrame) -> DataFrame:
    """The later export of applied and reply events, with changed content."""
    later = once.filter(F.col("event_type").isin(*_REEXPORTED))
    return later.withColumns(
        {
            "payload": F.replace("payload", F.lit('"title":"t'), F.lit('"title":"v2 t')),
            "exported_at": F.col("exported_at") + F.expr("INTERVAL 1 DAY"),
        }
    )


def life(t: Tables) -> DataFrame:
    """Event table with some events exported twice; one scan feeds both exports."""
    once = single_exports(t)
    copies = F.when(F.col("event_type").isin(*_REEXPORTED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = once.withColumn("_copy", F.explode(copies))
    second = F.col("_copy") == 1
    return both.withColumns(
        {
            "payload": F.when(second, F.replace("payload", F.lit('"title":"t'), F.lit('"title":"v2 t'))).otherwise(
                F.col("payload")
            ),
            "exported_at": F.col("exported_at") + F.make_dt_interval(F.col("_copy")),
        }
    ).drop("_copy")


def dedup(t: Tables) -> DataFrame:
    return views.events_dedup(life(t), COVERS)


def latest(t: Tables) -> DataFrame:
    return views.jobs_latest(dedup(t))


_FAMILIES_SQL = "[" + ", ".join(f"'{f}'" for f in TITLE_FAMILIES) + "]"
SINGLE_SQL = f"""
single AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS job_id,
         CASE event_type WHEN 'view' THEN 'found' WHEN 'click' THEN 'applied' WHEN 'purchase' THEN 'reply'
              WHEN 'error' THEN 'reject' WHEN 'signup' THEN 'draft_created' END AS event_type,
         ts, 'cv-' || CAST(k % 5 AS VARCHAR) AS cv_version,
         list_extract({_FAMILIES_SQL}, k % 8 + 1) AS title_family,
         '{{"company":"c' || CAST(k AS VARCHAR) || '","title":"t' || CAST(user_id AS VARCHAR) || '"}}' AS payload,
         'c' || CAST(k AS VARCHAR) AS company, 't' || CAST(user_id AS VARCHAR) AS title,
         ts + INTERVAL 1 HOUR AS exported_at
  FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events))"""
LIFE_SQL = (
    SINGLE_SQL
    + """,
life AS (
  SELECT * FROM single
  UNION ALL
  SELECT event_id, job_id, event_type, ts, cv_version, title_family, replace(payload, '"title":"t', '"title":"v2 t'),
         company, 'v2 ' || title, exported_at + INTERVAL 1 DAY
  FROM single WHERE event_type IN ('applied', 'reply')),
dedup AS (
  SELECT * FROM life QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY exported_at DESC) = 1)"""
)
LATEST_SQL = (
    LIFE_SQL
    + """,
firsts AS (
  SELECT job_id, min(ts) FILTER (event_type = 'found') AS first_found_ts,
         min(ts) FILTER (event_type = 'applied') AS applied_ts,
         min(ts) FILTER (event_type = 'reply') AS reply_ts, max(ts) AS last_event_ts
  FROM dedup GROUP BY job_id),
lasts AS (
  SELECT * FROM dedup QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_id DESC) = 1),
jobs_latest AS (
  SELECT f.*, l.event_type AS last_event_type, l.title_family, l.cv_version, l.company, l.title
  FROM firsts f JOIN lasts l USING (job_id)),
days AS (
  SELECT job_id, first_found_ts, applied_ts, reply_ts,
         CAST(trunc((epoch_us(reply_ts) - epoch_us(applied_ts)) / 86400000000.0) AS BIGINT) AS days_to_reply
  FROM jobs_latest WHERE applied_ts IS NOT NULL AND reply_ts IS NOT NULL)"""
)


def _rr_sql(group: str) -> str:
    z2 = "(1.96::DOUBLE * 1.96::DOUBLE)"
    centre = f"(n_replied::DOUBLE + {z2} / 2.0::DOUBLE) / (n_applied::DOUBLE + {z2})"
    margin = (
        f"1.96::DOUBLE / (n_applied::DOUBLE + {z2}) * sqrt(n_replied::DOUBLE * (n_applied::DOUBLE - n_replied::DOUBLE)"
        f" / n_applied::DOUBLE + {z2} / 4.0::DOUBLE)"
    )
    return f"""WITH {LIFE_SQL},
applied AS (SELECT job_id, {group} FROM dedup WHERE event_type = 'applied'),
replied AS (SELECT DISTINCT job_id FROM dedup WHERE event_type = 'reply'),
base AS (
  SELECT a.{group}, count(DISTINCT a.job_id) AS n_applied,
         count(DISTINCT CASE WHEN r.job_id IS NOT NULL THEN a.job_id END) AS n_replied
  FROM applied a LEFT JOIN replied r USING (job_id) GROUP BY a.{group})
SELECT {group}, n_applied, n_replied, n_replied::DOUBLE / n_applied::DOUBLE AS rate,
       greatest(0.0::DOUBLE, {centre} - {margin}) AS wilson_low,
       least(1.0::DOUBLE, {centre} + {margin}) AS wilson_high,
       CASE WHEN n_applied < 30 THEN 'insufficient_n' ELSE 'ok' END AS flag
FROM base"""


@query(
    "events_dedup",
    f"""WITH {LIFE_SQL}
SELECT event_id, job_id, event_type, ts, cv_version, title_family, payload, exported_at FROM dedup""",
)
def events_dedup(t: Tables) -> DataFrame:
    return views.events_dedup(life(t)).drop("keywords", "source_type")


@query("jobs_latest", f"WITH {LATEST_SQL} SELECT * FROM jobs_latest")
def jobs_latest(t: Tables) -> DataFrame:
    return latest(t)


@query("days_to_reply", f"WITH {LATEST_SQL} SELECT * FROM days")
def days_to_reply(t: Tables) -> DataFrame:
    return views.days_to_reply(latest(t))


@query("rr_by_family", _rr_sql("title_family"))
def rr_by_family(t: Tables) -> DataFrame:
    return views.response_rate_view(life(t), "title_family", COVERS)


@query("rr_by_cv", _rr_sql("cv_version"))
def rr_by_cv(t: Tables) -> DataFrame:
    return views.response_rate_view(life(t), "cv_version", COVERS)


@query(
    "registered_views",
    f"""{_rr_sql("title_family")} ORDER BY rate DESC""",
)
def registered_views(t: Tables) -> DataFrame:
    views.register_views(t.spark, life(t), COVERS, prefix="life_")
    return t.spark.sql("SELECT * FROM life_response_rate_by_title_family ORDER BY rate DESC")


@query(
    "views_of_foreign_ids",
    f"""WITH {LIFE_SQL.split("dedup AS")[0].rstrip().rstrip(",")},
foreign_ids AS (
  SELECT CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN NULL ELSE CAST(CAST(event_id AS BIGINT) % 997 AS VARCHAR) END AS event_id,
         job_id, event_type, ts, cv_version, title_family, payload, exported_at FROM life)
SELECT * FROM foreign_ids QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY exported_at DESC NULLS LAST, cv_version DESC,
  event_type DESC, job_id DESC, title_family DESC, ts DESC, payload DESC) = 1""",
)
def views_of_foreign_ids(t: Tables) -> DataFrame:
    """Ids made elsewhere: one id may carry several instants, and rows without an id are one group."""
    number = F.col("event_id").cast("long")
    named = F.when(number % 11 == 0, F.lit(None)).otherwise((number % 997).cast("string"))
    views.register_views(t.spark, life(t).drop("keywords", "source_type").withColumn("event_id", named), prefix="foreign_")
    return t.spark.sql("SELECT * FROM foreign_events_dedup")


@query(
    "funnel_scorecards",
    f"""WITH {LATEST_SQL} SELECT count(DISTINCT job_id) AS jobs, count(applied_ts) AS applied,
count(reply_ts) AS replied FROM jobs_latest""",
)
def funnel_scorecards(t: Tables) -> DataFrame:
    return funnel.scorecards(latest(t))


@query(
    "funnel_of_family",
    f"""WITH {LATEST_SQL} SELECT count(DISTINCT job_id) AS jobs, count(applied_ts) AS applied,
count(reply_ts) AS replied FROM jobs_latest WHERE title_family IN ('data_analyst', 'ml_engineer')""",
)
def funnel_of_family(t: Tables) -> DataFrame:
    return funnel.scorecards(funnel.of_families(latest(t), ["data_analyst", "ml_engineer"]))


@query(
    "last_event_counts",
    f"WITH {LATEST_SQL} SELECT last_event_type, count(*) AS n FROM jobs_latest GROUP BY last_event_type",
)
def last_event_counts(t: Tables) -> DataFrame:
    return funnel.by_last_event(latest(t))


@query(
    "weekly_found",
    f"""WITH {LATEST_SQL} SELECT CAST(date_trunc('week', first_found_ts) AS DATE) AS week, count(*) AS n
FROM jobs_latest GROUP BY 1""",
)
def weekly_found(t: Tables) -> DataFrame:
    return funnel.weekly_found(latest(t))


@query(
    "reply_buckets",
    f"""WITH {LATEST_SQL} SELECT CASE WHEN days_to_reply <= 3 THEN '0-3' WHEN days_to_reply <= 7 THEN '4-7'
WHEN days_to_reply <= 14 THEN '8-14' ELSE '15+' END AS bucket, count(*) AS n FROM days GROUP BY 1""",
)
def reply_buckets(t: Tables) -> DataFrame:
    return funnel.reply_buckets(views.days_to_reply(latest(t)))


@query("reply_median", f"WITH {LATEST_SQL} SELECT median(days_to_reply) AS median_days FROM days")
def reply_median(t: Tables) -> DataFrame:
    return funnel.reply_median(views.days_to_reply(latest(t)))


@query(
    "dup_groups",
    f"WITH {LIFE_SQL} SELECT event_id, count(*) AS n FROM life GROUP BY event_id HAVING count(*) > 1 ORDER BY n DESC",
)
def dup_groups(t: Tables) -> DataFrame:
    return duplicate_groups(life(t))


@query(
    "duplicate_report",
    f"""WITH {LIFE_SQL} SELECT count(*) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS extra_rows
FROM (SELECT count(*) AS n FROM life GROUP BY event_id HAVING count(*) > 1)""",
)
def duplicates(t: Tables) -> DataFrame:
    return duplicate_report(life(t))


@query(
    "table_counts",
    f"""WITH {LIFE_SQL} SELECT count(*) AS total_rows, count(DISTINCT event_id) AS distinct_ids,
count(DISTINCT job_id) AS distinct_jobs, count(*) - count(DISTINCT event_id) AS duplicates FROM life""",
)
def counts(t: Tables) -> DataFrame:
    return table_counts(life(t))


# -- data quality ---------------------------------------------------------------


def gaps(t: Tables) -> DataFrame:
    """Life with missing cells and types outside the closed list."""
    k = F.get_json_object("payload", "$.company")
    return life(t).withColumns(
        {
            "job_id": F.when(k != "c7", F.col("job_id")),
            "event_type": F.when(k == "c8", F.lit("ghosted")).when(k != "c9", F.col("event_type")),
            "exported_at": F.when(F.col("event_type") != "reject", F.col("exported_at")),
        }
    )


GAPS_SQL = (
    LIFE_SQL
    + """,
gaps AS (
  SELECT event_id, ts, CASE WHEN company <> 'c7' THEN job_id END AS job_id,
         CASE WHEN company = 'c8' THEN 'ghosted' WHEN company <> 'c9' THEN event_type END AS event_type,
         CASE WHEN event_type <> 'reject' THEN exported_at END AS exported_at
  FROM life),
recent AS (SELECT * FROM gaps WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY)"""
)


def _null_rate(col: str) -> str:
    return f"""SELECT 'null_rate_{col}' AS check_name, v AS value, 0.5::DOUBLE AS threshold,
CASE WHEN v > 0.5 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT count(*) FILTER ({col} IS NULL)::DOUBLE / count(*) AS v FROM recent)"""


_KNOWN = "('found','draft_created','applied','reply','interview','reject','offer','withdrawn','closed')"
_NULLS_SQL = "\nUNION ALL ".join(_null_rate(c) for c in quality.NULL_RATE_COLUMNS)
_FRESH_SQL = """SELECT 'freshness_hours_since_export' AS check_name, v AS value, 48.0::DOUBLE AS threshold,
CASE WHEN v > 48 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT trunc((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(exported_at))) / 3600000000.0)::DOUBLE AS v FROM gaps)"""
_UNKNOWN_SQL = f"""SELECT 'unknown_event_type_count' AS check_name, v AS value, 0.0::DOUBLE AS threshold,
CASE WHEN v > 0 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT count(*) FILTER (event_type NOT IN {_KNOWN})::DOUBLE AS v FROM gaps)"""
_DUP_SQL = """SELECT 'duplicate_event_id' AS check_name, v AS value, 0.0::DOUBLE AS threshold,
CASE WHEN v > 0 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT (count(*) - count(DISTINCT event_id))::DOUBLE AS v FROM gaps)"""
_INFO_SQL = """SELECT 'row_count' AS check_name, count(*)::DOUBLE AS value, NULL::DOUBLE AS threshold, 'info' AS status FROM gaps
UNION ALL SELECT 'distinct_jobs', count(DISTINCT job_id)::DOUBLE, NULL::DOUBLE, 'info' FROM gaps"""


@query("dq_null_rates", f"WITH {GAPS_SQL} {_NULLS_SQL}")
def dq_null_rates(t: Tables) -> DataFrame:
    return quality.null_rates(gaps(t), NOW)


@query("dq_freshness", f"WITH {GAPS_SQL} {_FRESH_SQL}")
def dq_freshness(t: Tables) -> DataFrame:
    return quality.freshness(gaps(t), NOW)


@query("dq_unknown_types", f"WITH {GAPS_SQL} {_UNKNOWN_SQL}")
def dq_unknown_types(t: Tables) -> DataFrame:
    return quality.unknown_types(gaps(t))


@query("dq_duplicate_ids", f"WITH {GAPS_SQL} {_DUP_SQL}")
def dq_duplicate_ids(t: Tables) -> DataFrame:
    return quality.duplicate_ids(gaps(t))


@query(
    "dq_report",
    f"WITH {GAPS_SQL} " + "\nUNION ALL ".join([_DUP_SQL, _UNKNOWN_SQL, _NULLS_SQL, _FRESH_SQL, _INFO_SQL]),
)
def dq_report(t: Tables) -> DataFrame:
    return quality.quality_report(gaps(t), NOW)


@query(
    "dq_legacy_table",
    f"""WITH {GAPS_SQL} {_DUP_SQL}
UNION ALL SELECT 'schema_legacy', NULL::DOUBLE, NULL::DOUBLE, 'warn'
UNION ALL {_INFO_SQL}""",
)
def dq_legacy_table(t: Tables) -> DataFrame:
    return quality.quality_report(gaps(t).select("event_id", "job_id"), NOW)


@query(
    "heartbeats",
    """WITH newest AS (
  SELECT event_type AS component, max(date_trunc('second', ts)) AS newest FROM events GROUP BY event_type),
aged AS (SELECT component, CAST((epoch_us(TIMESTAMP '2024-01-30 23:59:00') - epoch_us(newest)) // 1000000 AS BIGINT) AS age_seconds
  FROM newest)
SELECT component, age_seconds, CASE WHEN age_seconds <= 180 THEN 'ok' ELSE 'fail' END AS status FROM aged""",
)
def heartbeats(t: Tables) -> DataFrame:
    beats = t.events.select(F.col("event_type").alias("component"), F.col("ts").cast("string").alias("utc"))
    return quality.heartbeat_health(beats, datetime(2024, 1, 30, 23, 59))


# -- sync ---------------------------------------------------------------------------


def snapshot(t: Tables) -> DataFrame:
    """What a run derives now: applied and reply events carry their changed content."""
    once = single_exports(t)
    changed = F.col("event_type").isin(*_REEXPORTED)
    v2 = F.replace("payload", F.lit('"title":"t'), F.lit('"title":"v2 t'))
    return once.withColumn("payload", F.when(changed, v2).otherwise(F.col("payload"))).withColumn(
        "exported_at", F.lit(None).cast("timestamp_ntz")
    )


def catalog(t: Tables) -> DataFrame:
    """What the table holds: exports up to the cutoff, changed content only for early events."""
    rows = life(t).filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    second = F.startswith(F.get_json_object("payload", "$.title"), F.lit("v2"))
    return rows.filter(~second | (F.col("ts") < F.lit(EARLY).cast("timestamp_ntz")))


def saved_fingerprints(t: Tables) -> DataFrame:
    """Fingerprints a former run saved, for early events only."""
    from stagetrail.functions.identity import fingerprint

    old = single_exports(t).filter(F.col("ts") < F.lit(EARLY).cast("timestamp_ntz"))
    return old.select("event_id", fingerprint(old).alias("fingerprint"))


SYNC_SQL = (
    LIFE_SQL
    + """,
snap AS (
  SELECT event_id, job_id, event_type, ts,
         CASE WHEN event_type IN ('applied', 'reply') THEN replace(payload, '"title":"t', '"title":"v2 t') ELSE payload END AS payload,
         payload AS payload_v1
  FROM single),
cat AS (
  SELECT * FROM life WHERE ts < TIMESTAMP '2024-01-20 12:00:00'
    AND (title NOT LIKE 'v2%' OR ts < TIMESTAMP '2024-01-10')),
cat_latest AS (
  SELECT event_id, payload AS table_payload FROM cat
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY exported_at DESC) = 1),
logical AS (SELECT DISTINCT job_id, event_type, 1 AS known FROM cat),
decided AS (
  SELECT s.event_id, s.job_id, s.event_type, s.ts, s.payload,
         CASE WHEN c.event_id IS NULL AND g.known IS NOT NULL THEN 'skipped_logical_duplicate'
              WHEN c.event_id IS NULL THEN 'new'
              WHEN c.table_payload = s.payload THEN 'unchanged' ELSE 'updated' END AS decision,
         CASE WHEN c.event_id IS NULL AND g.known IS NOT NULL THEN 'skipped_logical_duplicate'
              WHEN c.event_id IS NULL THEN 'new'
              WHEN s.ts < TIMESTAMP '2024-01-10' AND s.payload_v1 <> s.payload THEN 'updated'
              ELSE 'already_in_table' END AS preview
  FROM snap s LEFT JOIN cat_latest c USING (event_id)
  LEFT JOIN logical g ON g.job_id = s.job_id AND g.event_type = s.event_type)"""
)
_COUNTERS_SQL = """SELECT count(*) AS derived_total, count(*) FILTER ({c} = 'new') AS new,
count(*) FILTER ({c} = 'updated') AS updated, count(*) FILTER ({c} = 'unchanged') AS unchanged,
count(*) FILTER ({c} = 'already_in_table') AS already_in_table,
count(*) FILTER ({c} = 'skipped_logical_duplicate') AS skipped_logical_duplicate FROM decided"""


@query("sync_decisions", f"WITH {SYNC_SQL} SELECT event_id, job_id, event_type, decision FROM decided")
def sync_decisions(t: Tables) -> DataFrame:
    return decide(snapshot(t), catalog(t)).select("event_id", "job_id", "event_type", "decision")


@query("sync_indexed", f"WITH {SYNC_SQL} SELECT event_id, job_id, event_type, decision FROM decided")
def sync_indexed(t: Tables) -> DataFrame:
    """The same decisions over a table in files, its keys looked up in the side tables."""
    root = run_folder(t.spark, "sync-indexed")
    write_clustered(table_rows(catalog(t), F.col("exported_at").cast("timestamp")), f"{root}/table", "errorifexists")
    table, index = read_events(t.spark, f"{root}/table"), KeyIndex(f"{root}/index")
    index.rebuild(table)
    table_rows(snapshot(t), F.lit(None).cast("timestamp")).write.parquet(f"{root}/rows")
    decided = decide(t.spark.read.parquet(f"{root}/rows"), table, index=index)
    return decided.select("event_id", "job_id", "event_type", "decision")


@query("sync_counters", f"WITH {SYNC_SQL} {_COUNTERS_SQL.format(c='decision')}")
def sync_counters(t: Tables) -> DataFrame:
    return decision_counts(decide(snapshot(t), catalog(t)))


@query("sync_preview_counters", f"WITH {SYNC_SQL} {_COUNTERS_SQL.format(c='preview')}")
def sync_preview_counters(t: Tables) -> DataFrame:
    return decision_counts(decide(snapshot(t), catalog(t), saved_fingerprints(t), compare_table=False))


@query(
    "sync_append",
    f"""WITH {SYNC_SQL} SELECT event_id, job_id, event_type, ts, payload FROM decided
WHERE decision IN ('new', 'updated')""",
)
def sync_append(t: Tables) -> DataFrame:
    return to_append(decide(snapshot(t), catalog(t))).select("event_id", "job_id", "event_type", "ts", "payload")


@query(
    "sync_saved_state",
    f"""WITH {SYNC_SQL}
SELECT event_id, sha256(CAST(to_json({{'cv_version': s.cv_version, 'event_id': event_id, 'event_type': s.event_type, 'job_id': s.job_id,
  'keywords': string_split(s.title_family, '_'), 'payload': d.payload, 'source_type': 'text', 'title_family': s.title_family,
  'ts': strftime(s.ts, '%Y-%m-%dT%H:%M:%SZ')}}) AS VARCHAR)) AS fingerprint
FROM decided d JOIN single s USING (event_id) JOIN snap USING (event_id)
WHERE NOT (s.ts < TIMESTAMP '2024-01-10' AND snap.payload_v1 = snap.payload)""",
)
def sync_saved_state(t: Tables) -> DataFrame:
    """The fingerprints a run has to save: those of early events are saved already unless their content changed."""
    return next_fingerprints(decide(snapshot(t), catalog(t)), saved_fingerprints(t))


@query(
    "event_ids",
    f"""WITH {SINGLE_SQL} SELECT event_id AS source_id,
sha256(job_id || '|' || event_type || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS event_id FROM single""",
)
def event_ids(t: Tables) -> DataFrame:
    once = single_exports(t)
    return once.select(
        F.col("event_id").alias("source_id"),
        event_id(F.col("job_id"), F.col("event_type"), F.col("ts")).alias("event_id"),
    )


@query(
    "events_by_type",
    f"WITH {LIFE_SQL} SELECT event_type, count(*) AS n FROM life GROUP BY event_type",
)
def by_type(t: Tables) -> DataFrame:
    return events_by_type(life(t))


# -- files that stopped changing ------------------------------------------------------


@query(
    "stable_files",
    """WITH listing AS (
  SELECT 'user/' || CAST(user_id AS VARCHAR) AS path, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS scan,
         count(*) AS size FROM events GROUP BY 1, 2),
marked AS (
  SELECT *, CASE WHEN lag(scan) OVER w = scan - 1 AND lag(size) OVER w = size THEN 0 ELSE 1 END AS fresh
  FROM listing WINDOW w AS (PARTITION BY path ORDER BY scan)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY path ORDER BY scan ROWS UNBOUNDED PRECEDING) AS run FROM marked),
placed AS (SELECT *, row_number() OVER (PARTITION BY path, run ORDER BY scan) AS nth FROM runs)
SELECT path, scan, size FROM placed WHERE nth % 2 = 0""",
)
def stable(t: Tables) -> DataFrame:
    listing = t.events.groupBy(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("path"),
        F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("scan"),
    ).agg(F.count(F.lit(1)).alias("size"))
    scans = listing.withColumn("mtime", F.lit(None).cast("timestamp"))
    return stable_files(scans).select("path", "scan", "size")


# -- ledger jobs out of orders -----------------------------------------------------------

_TITLES = {
    "1-URGENT": "Pricing Analyst (SQL), Python",
    "2-HIGH": "Machine Learning Engineer (Python, Spark)",
    "3-MEDIUM": "Mobile Developer, Java",
    "4-NOT SPECIFIED": "BI Modeller, Looker",
    "5-LOW": "Garden Designer",
}
RUN_TS = datetime(2024, 2, 1, 8, 30)
SEEN_TS = datetime(2024, 1, 15)


def ledger(t: Tables) -> DataFrame:
    """One job per order; open orders lack a found time, finished ones have sent and reply times."""
    o = t.orders
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shifted = lambda days: iso(F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAYS"))
    status = F.col("o_orderstatus")
    titles = F.create_map(*[F.lit(x) for pair in _TITLES.items() for x in pair])
    customer = F.col("o_custkey").cast("string")
    return o.select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("job_id"),
        titles[F.col("o_orderpriority")].alias("title"),
        F.concat(F.lit("Customer "), customer).alias("company"),
        F.when(status == "F", F.lit("Closed")).when(status == "O", F.lit("submitted")).alias("status"),
        F.when(status != "P", iso("o_orderdate")).alias("created_at_utc"),
        F.when(status == "F", shifted(3)).alias("sent_at_utc"),
        F.when((status == "F") & (F.col("o_totalprice") > 200000), shifted(10)).alias("reply_seen_at_utc"),
        F.concat(F.lit("https://me@Host"), customer, F.lit(".Example.com:8443/a?b=c")).alias("source_url"),
        F.when(status == "O", F.concat(F.lit("/cv/"), customer, F.lit(".pdf"))).alias("cv_pdf"),
        F.when(status == "F", F.lit("CV-20240101-Data_Scientist")).alias("cv_basename"),
        F.lower("o_orderpriority").alias("origin"),
    )


def ledger_seen(t: Tables) -> DataFrame:
    """First-seen state of a former run that knew the expensive orders."""
    old = t.orders.filter(F.col("o_totalprice") > 300000)
    return old.select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.explode(F.array(F.lit("found"), F.lit("applied"))).alias("bucket"),
        F.lit(SEEN_TS).cast("timestamp").alias("ts"),
    )


def outcomes(t: Tables) -> DataFrame:
    """Manual outcome rows: returned lines are rejections, some of orders nobody knows."""
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return returned.select(
        F.concat(F.lit("order-"), (F.col("l_orderkey") * 2).cast("string")).alias("job_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("offer")).otherwise(F.lit("reject")).alias("event_type"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ts"),
    )


JOBS_SQL = """
jobs AS (
  SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS job_id, o_orderstatus AS st, o_totalprice AS price,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'data_analyst' WHEN '2-HIGH' THEN 'ml_engineer'
              WHEN '3-MEDIUM' THEN 'software_engineer' WHEN '4-NOT SPECIFIED' THEN 'bi_analyst' ELSE 'other' END AS title_family,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'sql,python' WHEN '2-HIGH' THEN 'python,spark'
              WHEN '3-MEDIUM' THEN 'java' WHEN '4-NOT SPECIFIED' THEN 'bi,looker' ELSE '' END AS keywords,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Pricing Analyst (SQL), Python'
              WHEN '2-HIGH' THEN 'Machine Learning Engineer (Python, Spark)'
              WHEN '3-MEDIUM' THEN 'Mobile Developer, Java' WHEN '4-NOT SPECIFIED' THEN 'BI Modeller, Looker'
              ELSE 'Garden Designer' END AS title,
         CASE o_orderstatus WHEN 'O' THEN 'cv-' || substr(sha256(CAST(o_custkey AS VARCHAR) || '.pdf'), 1, 8)
              WHEN 'F' THEN 'cv-20240101-data_scientist' END AS cv_version,
         lower(o_orderpriority) AS origin, CAST(o_custkey AS VARCHAR) AS cust, o_orderdate AS od FROM orders),
ctx AS (
  SELECT *, '{"company":"Customer ' || cust || '","origin":"' || origin || '","source_host":"host' || cust
         || '.example.com","title":"' || title || '"}' AS payload,
         CASE WHEN price > 300000 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-02-01 08:30:00' END AS seen
  FROM jobs),
staged AS (
  SELECT *, 'found' AS event_type, CASE WHEN st <> 'P' THEN od ELSE seen END AS ts FROM ctx
  UNION ALL SELECT *, 'applied', CASE WHEN st = 'F' THEN od + INTERVAL 3 DAY ELSE seen END FROM ctx WHERE st IN ('F', 'O')
  UNION ALL SELECT *, 'reply', od + INTERVAL 10 DAY FROM ctx WHERE st = 'F' AND price > 200000
  UNION ALL SELECT *, 'closed', TIMESTAMP '2024-02-01 08:30:00' FROM ctx WHERE st = 'F'),
oc AS (
  SELECT 'order-' || CAST(l_orderkey * 2 AS VARCHAR) AS job_id,
         CASE WHEN l_linestatus = 'O' THEN 'offer' ELSE 'reject' END AS event_type,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ts FROM lineitem WHERE l_returnflag = 'R')"""
_EVENT_SQL = """sha256(job_id || '|' || event_type || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS event_id,
job_id, event_type, ts, cv_version, title_family, keywords, payload"""


def _flat(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "job_id",
        "event_type",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "cv_version",
        "title_family",
        F.array_join("keywords", ",").alias("keywords"),
        F.to_json("payload").alias("payload"),
    )


@query("derived_events", f"WITH {JOBS_SQL} SELECT {_EVENT_SQL} FROM staged")
def derived(t: Tables) -> DataFrame:
    return _flat(derive_events(ledger(t), RUN_TS, first_seen=ledger_seen(t)).events)


@query(
    "outcome_events",
    f"""WITH {JOBS_SQL},
joined AS (
  SELECT o.job_id, o.event_type, o.ts, c.cv_version, coalesce(c.title_family, 'other') AS title_family,
         coalesce(c.keywords, '') AS keywords, coalesce(c.payload, '{{}}') AS payload
  FROM oc o LEFT JOIN ctx c USING (job_id))
SELECT {_EVENT_SQL} FROM joined""",
)
def outcomes_of_jobs(t: Tables) -> DataFrame:
    return _flat(outcome_events(ledger(t), outcomes(t)))


@query(
    "first_seen_state",
    f"""WITH {JOBS_SQL},
need AS (
  SELECT job_id, 'found' AS bucket, seen AS ts FROM ctx WHERE st = 'P'
  UNION ALL SELECT job_id, 'applied', seen FROM ctx WHERE st = 'O'
  UNION ALL SELECT job_id, 'closed', TIMESTAMP '2024-02-01 08:30:00' FROM ctx WHERE st = 'F'),
old AS (
  SELECT job_id, b.bucket, TIMESTAMP '2024-01-15' AS ts FROM ctx, (VALUES ('found'), ('applied')) b(bucket) WHERE price > 300000)
SELECT * FROM old UNION ALL SELECT * FROM need WHERE (job_id, bucket) NOT IN (SELECT job_id, bucket FROM old)""",
)
def first_seen_state(t: Tables) -> DataFrame:
    state = derive_events(ledger(t), RUN_TS, first_seen=ledger_seen(t)).first_seen
    return state.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def line_events(t: Tables) -> DataFrame:
    """A found event per order line."""
    return t.lineitem.select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("job_id"), F.lit("found").alias("event_type")
    )


@query(
    "reconcile",
    """WITH found AS (SELECT DISTINCT l_orderkey FROM lineitem),
both_sides AS (SELECT o_orderkey, l_orderkey FROM orders FULL JOIN found ON o_orderkey = l_orderkey)
SELECT count(DISTINCT o_orderkey) AS jobs_in_ledger, count(l_orderkey) AS jobs_with_found_event,
       count(*) FILTER (l_orderkey IS NULL) AS dropped_jobs,
       count(DISTINCT o_orderkey) = count(l_orderkey) AS reconciled FROM both_sides""",
)
def reconciled(t: Tables) -> DataFrame:
    return reconcile(ledger(t), line_events(t))


@query(
    "dropped_jobs",
    """SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS job_id, 'missing_found_event' AS reason FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def dropped(t: Tables) -> DataFrame:
    return dropped_jobs(ledger(t), line_events(t))


@query(
    "ledger_rates",
    """WITH n AS (SELECT count(*) AS jobs_total, count(*) FILTER (o_orderstatus = 'O') AS applied_count,
  count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 200000) AS reply_count FROM orders)
SELECT *, round_even(applied_count / jobs_total, 4) AS apply_rate,
       round_even(reply_count / applied_count, 4) AS reply_rate_of_applied FROM n""",
)
def rates(t: Tables) -> DataFrame:
    from stagetrail.plans.insights import ledger_rates

    return ledger_rates(ledger(t))


@query(
    "ledger_histograms",
    f"""WITH {JOBS_SQL}
SELECT 'status' AS dimension, CASE st WHEN 'F' THEN 'closed' WHEN 'O' THEN 'submitted' ELSE 'unknown' END AS value,
       count(*) AS n FROM jobs GROUP BY 2
UNION ALL SELECT 'title_family', title_family, count(*) FROM jobs GROUP BY 2
UNION ALL SELECT 'origin', origin, count(*) FROM jobs GROUP BY 2""",
)
def histograms(t: Tables) -> DataFrame:
    from stagetrail.plans.insights import ledger_histograms

    return ledger_histograms(ledger(t))


# -- a whole sync over files ------------------------------------------------------------

_SYNC_SQL = """
steps(step, changed) AS (VALUES ('1 dry_run', 0), ('2 preview', 0), ('3 apply', 0), ('4 repeat', 0), ('5 changed', 1)),
per_job AS (
  SELECT o_orderkey, o_custkey % 10 = 0 AS touched,
         CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 + CAST(o_totalprice > 200000 AS INTEGER) END AS n FROM orders),
sums AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(coalesce(sum(n) FILTER (touched), 0) AS BIGINT) AS touched, count(*) AS jobs FROM per_job)
SELECT step, n AS derived_total, CASE WHEN step < '4' THEN n ELSE 0 END AS new, CASE WHEN changed = 1 THEN touched ELSE 0 END AS updated,
       CASE WHEN step < '4' THEN 0 WHEN changed = 1 THEN n - touched ELSE n END AS unchanged, CAST(0 AS BIGINT) AS skipped,
       jobs AS jobs_in_ledger, true AS reconciled, CAST(0 AS BIGINT) AS dropped,
       CASE WHEN step >= '3' THEN CASE WHEN changed = 1 THEN n + touched ELSE n END ELSE 0 END AS table_rows FROM steps, sums"""


def _ledgers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The orders as jobs with days of one month, so that the table has few day folders, and again with changed companies."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("job_id"), F.lit(20)).cast("int"))
    times = {"created_at_utc": 0, "sent_at_utc": 3, "reply_seen_at_utc": 10}
    jobs = ledger(t).withColumns({c: F.when(F.col(c).isNotNull(), F.date_format(F.date_add(day, n), "yyyy-MM-dd")) for c, n in times.items()})
    company = F.when(F.regexp_extract("company", "([0-9]+)$", 1).cast("int") % 10 == 0, F.concat("company", F.lit(" (new)")))
    return jobs, jobs.withColumn("company", F.coalesce(company, "company"))


@query("sync_run_report", f"WITH {_SYNC_SQL.strip()}")
def sync_run_report(t: Tables) -> DataFrame:
    """Dry run, preview, apply, a later repeat and changed companies, from a ledger written one job per line."""
    root = run_folder(t.spark, "sync-report")
    jobs, changed = _ledgers(t)
    jobs.write.json(f"{root}/jobs.json")
    changed.write.json(f"{root}/jobs_b.json")
    out = []
    for step, name, mode, at in (
        ("1 dry_run", "jobs", "dry_run", RUN_TS),
        ("2 preview", "jobs", "preview", RUN_TS),
        ("3 apply", "jobs", "apply", RUN_TS),
        ("4 repeat", "jobs", "apply", RUN_TS + timedelta(hours=1)),
        ("5 changed", "jobs_b", "apply", RUN_TS + timedelta(hours=2)),
    ):
        report = run_sync(t.spark, f"{root}/{name}.json", f"{root}/table", f"{root}/state", at, mode, layout="lines")
        d, r = report.decisions, report.reconciliation
        rows = read_events(t.spark, f"{root}/table").count()
        counts = (d["derived_total"], d["new"], d["updated"], d["unchanged"], d["skipped_logical_duplicate"])
        out.append((step, *counts, r["jobs_in_ledger"], r["reconciled"], report.dropped.count(), rows))
        report.discard()
    names = "derived_total long, new long, updated long, unchanged long, skipped long, jobs_in_ledger long"
    return t.spark.createDataFrame(out, f"step string, {names}, reconciled boolean, dropped long, table_rows long")


@query(
    "sync_triggered",
    f"""WITH {_SYNC_SQL.strip()[: _SYNC_SQL.strip().index("SELECT step")]}
SELECT run, n AS derived_total, CASE run WHEN 1 THEN n ELSE 0 END AS new, CASE run WHEN 2 THEN touched ELSE 0 END AS updated,
       CASE run WHEN 1 THEN 0 ELSE n - touched END AS unchanged, n + touched AS table_rows FROM sums, (VALUES (1), (2)) r(run)""",
)
def sync_triggered(t: Tables) -> DataFrame:
    """Two scheduled runs over a folder in which snapshots arrive: each takes what is new, and names that do not fit are left."""
    root = run_folder(t.spark, "triggered")
    jobs, changed = _ledgers(t)

    def arrive(rows: DataFrame, name: str) -> None:
        # A snapshot is one file with a job a line; it is written beside the folder and moved there when it is whole.
        rows.coalesce(1).write.json(f"{root}/parts/{name}")
        files = t.spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(t.spark._jsc.hadoopConfiguration())
        at = t.spark._jvm.org.apache.hadoop.fs.Path
        files.mkdirs(at(f"{root}/snapshots"))
        part = next(f.getPath() for f in files.listStatus(at(f"{root}/parts/{name}")) if f.getPath().getName().startswith("part-"))
        files.rename(part, at(f"{root}/snapshots/{name}"))

    for name, rows in (("jobs_1.json", jobs), ("jobs.json.bak", jobs), ("jobs_2.json", changed)):
        arrive(rows, name)
        if name.endswith(".json"):
            start_sync(t.spark, f"{root}/snapshots", f"{root}/table", f"{root}/state", f"{root}/c", f"{root}/reports", layout="lines").awaitTermination()
    count = F.lit(read_events(t.spark, f"{root}/table").count()).cast("long").alias("table_rows")
    runs = t.spark.read.parquet(f"{root}/reports")
    run = F.regexp_extract("path", "jobs_([0-9])", 1).cast("int").alias("run")
    return runs.select(run, "derived_total", "new", "updated", "unchanged", count)
