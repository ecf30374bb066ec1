"""Sources, sinks and streams over files that Spark writes from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.operators.contracts import check_messages
from stagetrail.operators.hooks import add_title_guess
from stagetrail.plans.insights import ledger_histograms
from stagetrail.session import run_folder
from stagetrail.sources.event_table import append_events, read_events, rewrite_deduplicated, swap_in, write_ndjson
from stagetrail.sources.ledger import read_outcomes, snapshot_refused
from stagetrail.sources.messages import read_chat_updates, read_labelled, read_messages, write_report
from stagetrail.streaming.intake import first_deliveries
from stagetrail.streaming.listener import start_listener
from stagetrail.workload.lifecycle import LIFE_SQL, ledger, life, single_exports
from stagetrail.workload.registry import Tables, query
from stagetrail.workload.texts import chat_updates

STAMP = datetime(2024, 3, 1)


def _in_a_month(events: DataFrame) -> DataFrame:
    """The events on twenty days, so that a table of day folders stays small."""
    day = "timestampadd(DAY, CAST(pmod(xxhash64(event_id), 20) AS INT), TIMESTAMP '2024-01-01 10:00:00')"
    return events.withColumn("ts", F.expr(day))


@query(
    "ndjson_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, 'cv-' || (CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) % 5) AS cv_version,
'text' AS source_type, 12 AS fields FROM events""",
)
def ndjson_events(t: Tables) -> DataFrame:
    """Load files read back line by line: every key is there, in files of a bounded number of rows."""
    root = run_folder(t.spark, "ndjson")
    events = single_exports(t).withColumns({"note": F.lit(None).cast("string"), "batch": F.lit(None).cast("int")}).drop("exported_at")
    write_ndjson(events.withColumn("exported_at", F.lit(None).cast("timestamp")), f"{root}/load")
    lines = t.spark.read.text(f"{root}/load").select(F.from_json("value", "map<string,string>").alias("m"))
    return lines.select("m.event_id", "m.cv_version", "m.source_type", F.size("m").alias("fields"))


@query(
    "appended_table",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, 1 AS copies, TIMESTAMP '2024-03-02' AS exported_at FROM events""",
)
def appended_table(t: Tables) -> DataFrame:
    """Two appends of the same events, rewritten without duplicates and swapped in."""
    root = run_folder(t.spark, "appended")
    events = _in_a_month(single_exports(t))
    for day in (STAMP, datetime(2024, 3, 2)):
        append_events(events, f"{root}/table", day, dry_run=False)
    rewrite_deduplicated(t.spark, f"{root}/table", f"{root}/clean")
    swap_in(t.spark, f"{root}/table", f"{root}/clean", f"{root}/before")
    kept = read_events(t.spark, f"{root}/table").groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("copies"), F.max("exported_at").alias("at"))
    return kept.select("event_id", "copies", F.col("at").cast("timestamp_ntz").alias("exported_at"))


@query(
    "labelled_rows",
    """SELECT 's' || p_partkey AS ad_id, 'in/' || p_partkey || '.png' AS image_file, p_name || ', "new"' AS title, p_brand AS company,
CASE WHEN p_size < 10 THEN NULL ELSE 'SQL|Spark' END AS requirements FROM part WHERE p_size % 5 <> 0""",
)
def labelled_rows(t: Tables) -> DataFrame:
    """A CSV with a byte-order mark, quoted texts, missing columns, and rows without an image, which do not count."""
    root, key = run_folder(t.spark, "labelled"), F.col("p_partkey").cast("string")
    rows = t.part.select(
        F.concat(F.lit("s"), key).alias("﻿ad_id"),
        F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("in/"), key, F.lit(".png"))).alias("image_file"),
        F.concat("p_name", F.lit(', "new"')).alias("title"),
        F.col("p_brand").alias("company"),
        F.when(F.col("p_size") >= 10, F.lit("SQL|Spark")).alias("requirements"),
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/gold")
    return read_labelled(t.spark, f"{root}/gold").select("ad_id", "image_file", "title", "company", "requirements")


@query(
    "outcome_file",
    """SELECT 'order-' || l_orderkey AS job_id, 'reject' AS event_type, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def outcome_file(t: Tables) -> DataFrame:
    """Outcome rows out of a CSV; other kinds and rows with an empty cell are left out."""
    root = run_folder(t.spark, "outcomes")
    kind = F.when(F.col("l_returnflag") == "R", F.lit(" reject ")).when(F.col("l_returnflag") == "A", F.lit("applied"))
    rows = t.lineitem.select(F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("job_id"), kind.alias("event_type"), F.lit("2024-01-05").alias("ts"))
    rows.write.option("header", True).csv(f"{root}/outcomes.csv")
    return read_outcomes(t.spark, f"{root}/outcomes.csv").groupBy("job_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "report_file",
    """SELECT 'origin' AS dimension, lower(o_orderpriority) AS value, count(*) AS n FROM orders GROUP BY 2""",
)
def report_file(t: Tables) -> DataFrame:
    """A report as one JSON file, read back."""
    root = run_folder(t.spark, "report")
    write_report(ledger_histograms(ledger(t)).filter("dimension = 'origin'"), f"{root}/report")
    return t.spark.read.json(f"{root}/report").select("dimension", "value", "n")


_PATHS_SQL = r"""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '/ledger/jobs.json' WHEN 1 THEN '/ledger/jobs_' || p_size || '.json'
  WHEN 2 THEN '/ledger/jobs.json.bak' WHEN 3 THEN '/Vault/jobs.json' WHEN 4 THEN 'C:\ledger\jobs_b.json' WHEN 5 THEN '/ledger/' || p_brand || '.json'
  WHEN 6 THEN '/ledger/jobs.json/' ELSE '/ledger/jobs_' || replace(p_name, ' ', '_') || '.json' END AS name FROM part"""


@query(
    "refused_snapshots",
    f"""SELECT p_partkey, name, lower(name) NOT LIKE '%vault%' AND regexp_full_match(
  regexp_extract(rtrim(replace(name, chr(92), '/'), '/'), '[^/]*$'), 'jobs(_\\w+)?\\.json') AS accepted FROM ({_PATHS_SQL})""",
)
def refused_snapshots(t: Tables) -> DataFrame:
    """Which of the paths, one per part, a sync would take."""
    one_of = F.pmod("p_partkey", F.lit(8))
    names = {
        0: F.lit("/ledger/jobs.json"),
        1: F.concat(F.lit("/ledger/jobs_"), "p_size", F.lit(".json")),
        2: F.lit("/ledger/jobs.json.bak"),
        3: F.lit("/Vault/jobs.json"),
        4: F.lit("C:\\ledger\\jobs_b.json"),
        5: F.concat(F.lit("/ledger/"), "p_brand", F.lit(".json")),
        6: F.lit("/ledger/jobs.json/"),
        7: F.concat(F.lit("/ledger/jobs_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".json")),
    }
    path = F.coalesce(*[F.when(one_of == k, name) for k, name in names.items()])
    return t.part.select("p_partkey", path.alias("name")).withColumn("accepted", ~snapshot_refused(F.col("name"), ["vault"]))


@query(
    "listener_links",
    """SELECT rtrim(p.url, '/') AS url, count(*) AS n FROM conversations c JOIN pages p ON p.page_id = c.conv_id
WHERE c.role <> 'system' AND p.url LIKE 'https://%' AND length(p.url) <= 2000 GROUP BY 1""",
)
def listener_links(t: Tables) -> DataFrame:
    """Chat updates read as a stream, published as tasks, and read back; every acceptable update is there once."""
    root = run_folder(t.spark, "listener")
    chat_updates(t).write.option("ignoreNullFields", True).json(f"{root}/updates")
    start_listener(read_chat_updates(t.spark, f"{root}/updates", streaming=True), [1], f"{root}/tasks", f"{root}/c").awaitTermination()
    tasks = check_messages(read_messages(t.spark, f"{root}/tasks")).filter("reason IS NULL")
    return tasks.groupBy(F.col("task.payload.url").alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "first_deliveries",
    """SELECT sha256(text) AS dedupe_key, 1 AS n FROM documents GROUP BY text""",
)
def first_delivery_stream(t: Tables) -> DataFrame:
    """Documents as a stream: one row per content within the retention of the queue."""
    root = run_folder(t.spark, "deliveries")
    t.documents.select(F.sha2("text", 256).alias("dedupe_key"), F.lit(STAMP).cast("timestamp").alias("at")).write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema("dedupe_key string, at timestamp").parquet(f"{root}/in")
    writer = first_deliveries(stream, "at").writeStream.format("parquet").option("path", f"{root}/out")
    writer.option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{root}/out").groupBy("dedupe_key").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query(
    "title_guesses",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'data_engineer' WHEN p_name LIKE '%red%' THEN 'research' ELSE 'other' END AS title_family FROM part""",
)
def title_guesses(t: Tables) -> DataFrame:
    """A callable is asked about titles no rule knew; what it makes up counts as other."""
    known = F.when(F.col("p_size") % 3 == 0, F.lit("data_engineer"))
    jobs = t.part.select("p_partkey", F.col("p_partkey").cast("string").alias("job_id"), F.col("p_name").alias("title"), known.alias("title_family"))
    return add_title_guess(jobs, lambda title: " Research " if "red" in title else "astronaut").select("p_partkey", "title_family")


@query(
    "table_of_life",
    f"""WITH {LIFE_SQL} SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM life GROUP BY 1""",
)
def table_of_life(t: Tables) -> DataFrame:
    """The event table written by day and scanned again."""
    root = run_folder(t.spark, "life")
    append_events(_in_a_month(life(t)), f"{root}/table", STAMP, dry_run=False)
    return read_events(t.spark, f"{root}/table").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))
