"""Derivation, sync, views, quality and reports on small fixtures."""

import json
import random
import re
import shutil
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import JOBS, write_ledger
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stagetrail.operators import quality
from stagetrail.operators.dedup import duplicate_groups, keep_latest, table_counts
from stagetrail.operators.derive import derive_events
from stagetrail.operators.percentiles import median, nearest_rank
from stagetrail.operators.rates import response_rate
from stagetrail.operators.sync import decide, logical_keys, next_fingerprints
from stagetrail.plans import funnel, views
from stagetrail.plans.insights import ledger_histograms, ledger_rates
from stagetrail.plans.sync_run import run_backfill, run_sync, start_sync
from stagetrail.schemas import FINGERPRINT_SCHEMA, FIRST_SEEN_SCHEMA
from stagetrail.session import spread
from stagetrail.sources import event_table, ledger
from stagetrail.sources.messages import write_report
from stagetrail.sources.state import VersionedState

NOW = datetime(2025, 4, 1, 12)


@pytest.fixture()
def jobs(spark, tmp_path):
    return ledger.read_ledger(spark, write_ledger(tmp_path, JOBS))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_events_of_every_stage(jobs):
    events = derive_events(jobs, NOW).events.collect()
    assert Counter(e["event_type"] for e in events) == {"found": 9, "draft_created": 1, "applied": 5, "reply": 2, "closed": 1}
    first = next(e for e in events if e["job_id"] == "k-10")
    assert json.loads(str(first["payload"].toJson())) == {
        "company": "Blue Kiln", "title": "Forecasting Analyst (Excel, SQL)", "location": "Porto",
        "source_host": "board.example.org", "match_score": 0.25, "origin": "feed",
    }
    assert first["keywords"] == ["excel", "sql"] and first["title_family"] == "data_analyst"
    blob = " ".join(str(e.asDict()) + (e["payload"].toJson() if e["payload"] else "") for e in events)
    for secret in ("do not share", "full advert", "hr@", "/srv/", "https://"):
        assert secret not in blob


def test_first_seen_is_sticky(spark, jobs):
    first = derive_events(jobs, NOW)
    state = spark.createDataFrame(first.first_seen.collect(), FIRST_SEEN_SCHEMA)
    assert rows(state, "job_id", "bucket") == [("k-14", "applied"), ("k-14", "found"), ("k-15", "closed")]
    again = derive_events(jobs, NOW + timedelta(days=30), first_seen=state)
    assert rows(first.events, "event_id") == rows(again.events, "event_id")
    assert again.first_seen.count() == 3


def test_outcomes_join_the_last_row(spark, jobs, tmp_path):
    doubled = JOBS + [{"job_id": "k-10", "title": "Chef"}]
    jobs = ledger.read_ledger(spark, write_ledger(tmp_path, doubled, "jobs_b.json"))
    csv = tmp_path / "outcomes.csv"
    csv.write_text(
        "job_id,event_type,ts\n k-10 ,interview,2025-03-22T10:00:00Z\nk-10,invalid,2025-03-22T10:00:00Z\n"
        "zz,reject,2025-03-23\nk-12,offer,never\n,offer,2025-03-23\n"
    )
    outcomes = ledger.read_outcomes(spark, str(csv))
    got = derive_events(jobs, NOW, outcomes).events.filter(F.col("event_type").isin("interview", "reject", "offer"))
    assert rows(got, "job_id", "event_type", "title_family") == [("k-10", "interview", "other"), ("zz", "reject", "other")]


def test_title_fallback_only_fills_gaps(spark):
    df = spark.createDataFrame([("a", "Mystery Role"), ("b", "Data Engineer"), ("c", "Chef")], "job_id string, title string")
    guess = lambda t: " Research " if "Mystery" in t else "astronaut"
    got = derive_events(df, NOW, title_fallback=guess).events
    assert rows(got, "job_id", "title_family") == [("a", "research"), ("b", "data_engineer"), ("c", "other")]


def test_ledger_reading_is_lenient(spark, tmp_path):
    (tmp_path / "mixed.json").write_text(json.dumps({"jobs": [{"id": 7, "title": "x"}, 3, None, "t", {"status": "sent"}]}))
    (tmp_path / "broken.json").write_text("{not json")
    (tmp_path / "other.json").write_text(json.dumps({"rows": []}))
    (tmp_path / "lines.json").write_text('{"id": 1}\n[1]\noops\n{"id": 2}\n')
    read = lambda name: ledger.read_ledger(spark, str(tmp_path / name))
    assert rows(read("mixed.json").filter("id IS NOT NULL"), "id", "title") == [("7", "x")]
    assert read("mixed.json").count() == 2
    assert [read(n).count() for n in ("broken.json", "other.json", "missing.json")] == [0, 0, 0]
    assert ledger.read_outcomes(spark, str(tmp_path / "none.csv")).count() == 0
    lines = ledger.job_columns(ledger.read_job_lines(spark, str(tmp_path / "lines.json")))
    assert rows(lines, "id") == [("1",), ("2",)]


@pytest.mark.parametrize("path", ["/x/other.json", "/secret/jobs.json", "/x/jobs.json.bak"])
def test_refused_snapshots(path):
    with pytest.raises(ledger.RefusedSnapshot):
        ledger.refuse_snapshot(path, ["secret"])
    ledger.refuse_snapshot("/x/jobs_2024.json")


def test_refused_snapshots_of_a_column(spark):
    """The rule over a column is the rule for one argument."""
    paths = ["/x/jobs.json", "/x/jobs_2024.json", "jobs.json", "/x/jobs_.json", "/x/my_jobs.json", "/x/jobs.json.bak", "/Secret/jobs.json", "/x/jobs.json/", "/x/jobs.json/.",
             "c:\\x\\jobs_a.json", "", "/", "/x/jobs_é.json", "/x/jobs_a-b.json", "/x/jobs.json\n", "/x/JOBS.json", "file:/x/jobs_1.json"]

    def refused(path):
        try:
            ledger.refuse_snapshot(path, ["secret"])
        except ledger.RefusedSnapshot:
            return True
        return False

    df = spark.createDataFrame([(i, p) for i, p in enumerate([*paths, None])], "i int, source_file string")
    got = [r["x"] for r in sorted(df.select("i", ledger.snapshot_refused(F.col("source_file"), ["secret"]).alias("x")).collect())]
    assert got == [*map(refused, paths), True] and got[:4] == [False, False, False, True]
    assert sorted(r["i"] for r in ledger.from_allowed(df, ["secret"]).collect()) == [i for i, p in enumerate(paths) if not refused(p)]



def test_sync_cycle(spark, tmp_path):
    path = write_ledger(tmp_path, JOBS)
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    run = lambda mode, at: run_sync(spark, path, table, state, at, mode)
    dry = run("dry_run", NOW)
    assert dry.reconciliation["reconciled"] and dry.rows_to_append == 18 and dry.dropped.count() == 0
    assert run("preview", NOW).rows_to_append == 18
    applied = run_backfill(spark, path, table, state, NOW, mode="apply")
    assert applied.export["rows"] == 18
    saved = lambda: VersionedState(f"{state}/fingerprints", FINGERPRINT_SCHEMA, ("event_id",))._all(spark).groupBy("version").count()
    assert rows(saved(), "version", "count") == [(0, 18)]
    later = NOW + timedelta(days=2)
    again = run("apply", later)
    assert again.decisions["unchanged"] == 18 and again.rows_to_append == 0

    changed = [dict(j) for j in JOBS]
    changed[0]["company"] = "Red Kiln"
    changed[6]["created_at_utc"] = "2025-02-21T17:00:00Z"
    changed.append({"job_id": "k-99", "title": "Chef"})
    path = write_ledger(tmp_path, changed)
    assert run("preview", later).decisions["updated"] == 1
    third = run("apply", later)
    want = {"derived_total": 19, "new": 1, "updated": 1, "unchanged": 16, "already_in_table": 0, "skipped_logical_duplicate": 1}
    assert third.decisions == want
    # Only changed fingerprints are saved: the run that changed nothing saved none, and the last one those of three events.
    assert rows(saved(), "version", "count") == [(0, 18), (2, 3)]
    assert not [p for p in Path(third.scratch.removeprefix("file:")).iterdir() if p.name != "dropped"]
    third.discard()
    assert not Path(third.scratch.removeprefix("file:")).exists()
    events = event_table.read_events(spark, table)
    assert table_counts(events).first().asDict() == {"total_rows": 20, "distinct_ids": 19, "distinct_jobs": 10, "duplicates": 1}
    assert event_table.duplicate_report(events).first().asDict() == {"duplicate_groups": 1, "extra_rows": 1}
    counts = event_table.rewrite_deduplicated(spark, table, str(tmp_path / "clean"))
    assert counts == {"total_rows": 19, "distinct_event_id": 19, "duplicates": 0}
    since = event_table.read_events(spark, table, datetime(2025, 2, 20))
    assert since.filter("ts < '2025-02-20'").count() == 0
    assert re.search(r"PartitionFilters: \[[^]]*event_date", since._jdf.queryExecution().toString())


def test_snapshots_that_arrive_are_synced_once(spark, tmp_path):
    """A scheduled run takes what is new, once; a name that does not fit and a restart without news change nothing."""
    folder, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    folder.mkdir()
    write_ledger(folder, JOBS, "jobs_1.json")
    write_ledger(folder, JOBS + [{"job_id": "k-50", "title": "Spy"}], "other.json")
    run = lambda: start_sync(spark, str(folder), table, state, str(tmp_path / "c"), str(tmp_path / "r")).awaitTermination()
    run()
    run()
    assert event_table.read_events(spark, table).count() == 18
    write_ledger(folder, [*JOBS, {"job_id": "k-99", "title": "Chef"}], "jobs_2.json")
    run()
    reports = spark.read.parquet(str(tmp_path / "r")).orderBy("path").collect()
    assert [(r["path"][-6:], r["new"], r["unchanged"]) for r in reports] == [("1.json", 18, 0), ("2.json", 1, 18)]
    assert event_table.read_events(spark, table).count() == 19


def test_lines_layout_and_a_run_that_died(spark, tmp_path):
    lines = tmp_path / "jobs_lines.json"
    lines.write_text("\n".join(json.dumps(j) for j in JOBS))
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    run = lambda at: run_sync(spark, str(lines), table, state, at, "apply", layout="lines")
    assert run(NOW).decisions["new"] == 18
    # As if the run had died before the fingerprints were saved: a later repeat changes nothing.
    shutil.rmtree(f"{state}/fingerprints")
    assert run(NOW + timedelta(days=3)).decisions["unchanged"] == 18
    assert event_table.read_events(spark, table).count() == 18


def test_old_layout_read_from_files(spark, tmp_path):
    path = str(tmp_path / "old")
    old = spark.createDataFrame([("x1", "k-10", datetime(2025, 2, 1)), ("x2", "k-11", datetime(2025, 2, 1))], "event_id string, job_id string, ts timestamp")
    old.withColumn("event_date", F.to_date("ts")).write.partitionBy("event_date").parquet(path)
    ledger_path = write_ledger(tmp_path, JOBS)
    for mode in ("preview", "apply"):
        found = run_sync(spark, ledger_path, path, str(tmp_path / "state"), NOW, mode).decisions
        assert (found["skipped_logical_duplicate"], found["new"]) == (2, 16)
    assert "event_type" not in event_table.read_events(spark, str(tmp_path / "old" / "event_date=2025-02-01"), as_stored=True).columns
    stored = event_table.read_events(spark, path, as_stored=True).drop("event_type")
    assert [r["status"] for r in quality.quality_report(stored, NOW).filter("check_name = 'schema_legacy'").collect()] == ["warn"]


def test_sync_reads_only_what_it_must(spark, tmp_path):
    table = str(tmp_path / "table")
    run_sync(spark, write_ledger(tmp_path, JOBS), table, str(tmp_path / "state"), NOW, "apply")
    rows_path = str(tmp_path / "rows")
    event_table.read_events(spark, table).limit(3).write.parquet(rows_path)
    plan = decide(spark.read.parquet(rows_path), event_table.read_events(spark, table))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("dynamicpruning") >= 1 or "event_date" in plan
    keys = logical_keys(event_table.read_events(spark, table), spark.read.parquet(rows_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in keys and keys.index("Aggregate") < keys.index("LeftSemi")


def test_table_is_named_swapped_and_reset(spark, tmp_path):
    path, events = str(tmp_path / "t"), derive_events(ledger.read_ledger(spark, write_ledger(tmp_path, JOBS)), NOW).events
    for _ in range(2):
        event_table.append_events(events, path, NOW, dry_run=False)
    event_table.create_table(spark, "life_events", path)
    assert spark.table("life_events").count() == 36
    event_table.rewrite_deduplicated(spark, path, str(tmp_path / "clean"))
    event_table.swap_in(spark, path, str(tmp_path / "clean"), str(tmp_path / "before"))
    assert event_table.read_events(spark, path).count() == 18 and event_table.read_events(spark, str(tmp_path / "before")).count() == 36
    with pytest.raises(FileExistsError):
        event_table.swap_in(spark, path, str(tmp_path / "before"), str(tmp_path / "before"))
    with pytest.raises(FileNotFoundError):
        event_table.swap_in(spark, path, str(tmp_path / "none"), str(tmp_path / "other"))
    event_table.create_table(spark, "life_events", path, replace=True)
    assert spark.table("life_events").count() == 18
    event_table.reset_table(spark, path, str(tmp_path / "last"))
    assert event_table.read_events(spark, path).count() == 0
    spark.sql("DROP TABLE life_events")


def test_legacy_table_counts_as_found(spark):
    derived = spark.createDataFrame(
        [("a", "1", "found"), ("b", "1", "reply"), ("c", "2", "found")], "event_id string, job_id string, event_type string"
    )
    for name, kind in {"ts": "timestamp", "cv_version": "string", "title_family": "string", "keywords": "array<string>",
                       "source_type": "string", "payload": "string"}.items():
        derived = derived.withColumn(name, F.lit(None).cast(kind))
    legacy = spark.createDataFrame([("old", "1")], "event_id string, job_id string")
    got = decide(derived, legacy, compare_table=False)
    assert rows(got, "event_id", "decision") == [("a", "skipped_logical_duplicate"), ("b", "new"), ("c", "new")]


def test_versioned_state(spark, tmp_path):
    state = VersionedState(str(tmp_path / "s"), FIRST_SEEN_SCHEMA, ("job_id", "bucket"))
    frame = lambda day: spark.createDataFrame([("a", "found", datetime(2025, 1, day))], FIRST_SEEN_SCHEMA)
    assert state.read(spark).count() == 0 and state.next_version(spark) == 0
    state.write(frame(1), 0)
    state.write(frame(2), 1)
    assert rows(state.read(spark), "ts") == [(datetime(2025, 1, 2),)]
    assert rows(state.read(spark, before=1), "ts") == [(datetime(2025, 1, 1),)]
    state.fold(spark, 2)
    assert rows(state.read(spark), "ts") == [(datetime(2025, 1, 2),)] and state.next_version(spark) == 2
    state.write(frame(3), 2)
    assert [rows(state.read(spark, before=n), "ts") for n in (1, 2, 3)] == [[(datetime(2025, 1, d),)] for d in (1, 2, 3)]
    with pytest.raises(AnalysisException):
        state.write(frame(4), 2)
    state.write(frame(4), 2, replace=True)
    state.fold(spark, 3, F.col("ts") > datetime(2025, 1, 9))
    assert state.read(spark).count() == 0


def hot_events(spark, n=3000):
    """A third of the rows repeat one event, another third belong to one job."""
    rnd = random.Random(1)
    kinds = ["found", "applied", "reply"]
    out = []
    for i in range(n):
        if i % 3 == 0:
            out.append(("hot", "j-hot", "applied", i, "fam0"))
        elif i % 3 == 1:
            out.append((f"e{i}", "j-busy", rnd.choice(kinds), i, f"fam{rnd.randrange(3)}"))
        else:
            out.append((f"e{i}", f"j{rnd.randrange(400)}", rnd.choice(kinds), i, f"fam{rnd.randrange(3)}"))
    df = spark.createDataFrame(out, "event_id string, job_id string, event_type string, s int, title_family string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s"))
    return df.select("event_id", "job_id", "event_type", at.alias("ts"), "title_family", at.alias("exported_at")), out


def test_skewed_keys_against_brute_force(spark):
    events, raw = hot_events(spark)
    last = {}
    for e in raw:
        last[e[0]] = max(last.get(e[0], e), e, key=lambda x: x[3])
    dedup = keep_latest(events)
    assert rows(dedup, "event_id", "job_id") == sorted((e[0], e[1]) for e in last.values())
    assert [tuple(r) for r in duplicate_groups(events).collect()] == [("hot", 1000)]

    replied = {e[1] for e in last.values() if e[2] == "reply"}
    want = {}
    for e in last.values():
        if e[2] == "applied":
            want.setdefault(e[4], set()).add(e[1])
    got = {r["title_family"]: (r["n_applied"], r["n_replied"]) for r in response_rate(dedup, "title_family").collect()}
    assert got == {g: (len(js), len(js & replied)) for g, js in want.items()}


def test_keep_latest_limits_before_the_exchange(spark):
    events, _ = hot_events(spark, 30)
    plan = keep_latest(events, covers=("event_type",)).filter("event_type = 'reply'")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "WindowGroupLimit" in physical and "Partial" in physical
    assert physical.index("Window ") < physical.index("reply")


def test_ties_are_settled_by_content(spark):
    at = datetime(2025, 1, 1)
    data = [("x", f"v{i}", at) for i in range(9)]
    schema = "event_id string, payload string, exported_at timestamp"
    picks = {keep_latest(spark.createDataFrame(random.Random(s).sample(data, 9), schema)).first()["payload"] for s in range(3)}
    assert picks == {"v8"}


def test_views_and_funnel(spark, jobs, tmp_path):
    events = event_table.table_rows(derive_events(jobs, NOW).events, F.lit(NOW).cast("timestamp"))
    views.register_views(spark, events)
    latest = spark.table("jobs_latest")
    assert latest.count() == 9
    row = latest.filter("job_id = 'k-13'").first()
    assert row["last_event_type"] == "reply" and row["title"] == "Vision Researcher"
    days = spark.table("days_to_reply")
    assert rows(days, "job_id", "days_to_reply") == [("k-13", 5), ("k-18", 12)]
    assert funnel.scorecards(latest).first().asDict() == {"jobs": 9, "applied": 5, "replied": 2}
    assert rows(funnel.reply_buckets(days), "bucket", "n") == [("4-7", 1), ("8-14", 1)]
    assert funnel.reply_median(days).first()["median_days"] == 8.5
    assert sum(r["n"] for r in funnel.weekly_found(latest).collect()) == 9
    by_cv = {r["cv_version"]: r["n_applied"] for r in spark.table("response_rate_by_cv_version").collect()}
    assert by_cv[None] == 3 and len(by_cv) == 3
    assert ledger_rates(jobs).first().asDict() == {
        "jobs_total": 9, "applied_count": 4, "reply_count": 2, "apply_rate": 0.4444, "reply_rate_of_applied": 0.5,
    }
    hist = ledger_histograms(jobs)
    assert {r["value"]: r["n"] for r in hist.filter("dimension = 'origin'").collect()} == {"feed": 1, "unknown": 8}
    write_report(hist, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == hist.count()
    event_table.write_ndjson(events, str(tmp_path / "nd"), 10)
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "nd")).collect()]
    assert len(lines) == 18 and all("cv_version" in line for line in lines)


def test_quality(spark):
    at = lambda d: datetime(2025, 4, 1) - timedelta(days=d)
    data = [("a", "1", "found", at(1), at(0)), ("a", None, "odd", at(2), None), ("b", None, None, at(20), at(3)), ("c", "2", "found", None, None)]
    events = spark.createDataFrame(data, "event_id string, job_id string, event_type string, ts timestamp, exported_at timestamp")
    got = {r["check_name"]: (r["value"], r["status"]) for r in quality.quality_report(events, NOW, unbounded_nulls=True).collect()}
    assert got["duplicate_event_id"] == (1.0, "fail") and got["unknown_event_type_count"] == (1.0, "fail")
    assert got["null_rate_job_id"] == (0.5, "ok") and got["null_rate_ts"] == (0.0, "ok") and got["null_rate_ts_all"] == (0.25, "ok")
    assert got["freshness_hours_since_export"] == (12.0, "ok") and got["row_count"] == (4.0, "info")
    assert got["distinct_jobs"] == (2.0, "info")
    empty = {r["check_name"]: (r["value"], r["status"]) for r in quality.quality_report(events.limit(0), NOW).collect()}
    assert empty["null_rate_ts"] == (None, "ok") and empty["freshness_hours_since_export"] == (None, "ok")
    legacy = [r["check_name"] for r in quality.quality_report(events.select("event_id", "job_id"), NOW).collect()]
    assert legacy == ["duplicate_event_id", "schema_legacy", "row_count", "distinct_jobs"]
    beats = spark.createDataFrame(
        [("l", "2025-04-01T11:58:00Z"), ("l", "x"), ("p", "2025-04-01T11:00:00Z"), ("q", None)], "component string, utc string"
    )
    health = {r["component"]: (r["age_seconds"], r["status"]) for r in quality.heartbeat_health(beats, NOW).collect()}
    assert health == {"l": (120, "ok"), "p": (3600, "fail"), "q": (None, "fail")}


@pytest.mark.parametrize("seed", [1, 2])
def test_order_statistics_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = [("hot", rnd.choice([1.0, 2.0, rnd.random()])) for _ in range(2000)] + [("one", 5.0)]
    data += [(f"g{rnd.randrange(4)}", rnd.lognormvariate(0, 3)) for _ in range(1000)] + [("hot", None)]
    df = spark.createDataFrame(data, "g string, v double")
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    rank = lambda vs, q: sorted(vs)[max(0, -(-int(q * 100) * len(vs) // 100) - 1)]
    got = {r["g"]: (r["p50"], r["p95"]) for r in nearest_rank(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    assert got == {g: (rank(vs, 0.5), rank(vs, 0.95)) for g, vs in groups.items()}
    from statistics import median as exact

    assert {r["g"]: r["median"] for r in median(df, "v", ["g"]).collect()} == {g: exact(vs) for g, vs in groups.items()}
    everything = [v for vs in groups.values() for v in vs]
    assert median(df, "v").first()["median"] == exact(everything)
    assert median(df.limit(0), "v").count() == 0


def test_a_sync_leaves_no_shuffle_files(spark, tmp_path):
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("/shuffle_")

    (tmp_path / "jobs.json").write_text("\n".join(f'{{"id": "j{i}", "title": "Data Engineer", "created_at": "2024-01-0{i % 9 + 1}"}}' for i in range(200)))
    before = shuffles()
    for _ in range(2):
        run_sync(spark, str(tmp_path / "jobs.json"), str(tmp_path / "t"), str(tmp_path / "s"), datetime(2024, 2, 1), "apply", layout="lines")
    assert shuffles() <= before


def test_known_fingerprints_are_left_out_by_id_and_value(spark):
    decided = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", None), (None, "1")], "event_id string, fingerprint string")
    known = spark.createDataFrame([("a", "2"), ("b", "0"), (None, "1")], "event_id string, fingerprint string")
    got = {tuple(r) for r in next_fingerprints(decided, known).collect()}
    assert got == {("b", "1"), ("c", None), (None, "1")}


def test_a_small_file_is_many_tasks_rows(spark, tmp_path):
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "t"))
    sizes = spread(spark.read.parquet(str(tmp_path / "t"))).rdd.glom().map(len).collect()
    assert sum(sizes) == 2000 and len(sizes) >= 4 * spark.sparkContext.defaultParallelism and max(sizes) < 200
