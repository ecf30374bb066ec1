"""Retries as timers of keyed state."""

import json
import time

from helpers import column
from pyspark.sql import functions as F

from stagetrail import constants as C
from stagetrail.streaming.intake import by_call, by_response
from stagetrail.streaming.retries import TimedIntake


def task(spark, url, number=0, **changed):
    key = column(spark, [url], lambda c: F.sha2(F.concat(F.lit(f"{C.LINK_SOURCE}|url|"), c), 256))[0]
    own = {"schema": C.TASK_SCHEMA, "task_id": f"0f0f0f0f-0000-4000-8000-{number:012d}", "type": C.LINK_TASK, "source": C.LINK_SOURCE,
           "payload": {"url": url, "file_id": None, "version": None, "text": None}, "dedupe_key": key, "created_at": f"2025-01-02T03:04:{number % 60:02d}Z"}
    return own | changed


def deliver(folder, name, tasks):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(t if isinstance(t, str) else json.dumps(t) for t in tasks) + "\n")


def run(spark, tmp_path, intake, seconds=120):
    query = intake.start(spark.readStream.schema("value string").text(str(tmp_path / "in")), str(tmp_path / "c"), seconds=0)
    try:
        assert intake.drain(spark, query, seconds)
        return query.recentProgress
    finally:
        query.stop()


def answers(spark, codes):
    return by_response(spark.createDataFrame([(k, c, True, None) for k, c in codes.items()], "dedupe_key string, status_code int, ok boolean, error_type string"))


def results(spark, intake):
    return {r["dedupe_key"]: (r["action"], r["attempts"], r["detail"]) for r in intake.results(spark).collect()}


def test_retries_settle_or_end(spark, tmp_path):
    a, b, d = (task(spark, f"https://{n}.example/1") for n in "abd")
    deliver(tmp_path / "in", "0.txt", [a, {**a, "task_id": task(spark, "x", 7)["task_id"]}, b, b, "garbage", {**a, "x": 1}, d])
    down = TimedIntake(str(tmp_path / "s"), {C.LINK_TASK: answers(spark, {a["dedupe_key"]: 200, b["dedupe_key"]: 503, d["dedupe_key"]: 404})}, delays=(0.2, 1))
    run(spark, tmp_path, down)
    # b arrived twice, so three retries make five attempts.
    assert results(spark, down) == {a["dedupe_key"]: ("done", 0, None), b["dedupe_key"]: ("failed", 5, "max_attempts"), d["dedupe_key"]: ("done", 0, None)}
    acted = [tuple(r) for r in down.actions(spark).groupBy("action").count().orderBy("action").collect()]
    assert acted == [("done", 2), ("failed", 1), ("handle", 6), ("quarantined", 2)]
    assert sorted(r["detail"] for r in down.actions(spark).where("action = 'quarantined'").collect()) == ["<root>: additionalProperties", "not json"]

    # The state survives a restart: what is done is known, what failed is handled again because it is delivered again.
    deliver(tmp_path / "in", "1.txt", [a, b])
    up = TimedIntake(str(tmp_path / "s"), {C.LINK_TASK: answers(spark, {b["dedupe_key"]: 200})}, delays=(0.2, 1))
    run(spark, tmp_path, up)
    time.sleep(1)
    assert results(spark, up)[b["dedupe_key"]][0] in ("done", "failed")
    assert [r["detail"] for r in up.actions(spark).where("action = 'known'").collect()] == ["done"]
    assert up.actions(spark).where("action = 'handle'").count() == 7


def test_the_store_does_not_depend_on_the_session(spark, tmp_path):
    name, hdfs = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, hdfs)
    try:
        a = task(spark, "https://a.example/1")
        deliver(tmp_path / "in", "0.txt", [a])
        intake = TimedIntake(str(tmp_path / "s"), {C.LINK_TASK: answers(spark, {a["dedupe_key"]: 200})})
        run(spark, tmp_path, intake)
        assert results(spark, intake) == {a["dedupe_key"]: ("done", 0, None)}
        assert spark.conf.get(name) == hdfs
    finally:
        spark.conf.set(name, before)


def test_a_batch_touches_what_is_due(spark, tmp_path):
    """Of a hundred settled identities none is read again for the one that waits."""
    calls = tmp_path / "calls"

    def call(task):
        with open(calls, "a") as f:
            f.write(task["payload"]["url"] + "\n")
        if task["payload"]["url"].endswith("/7") and calls.read_text().count("example/7\n") < 3:
            raise RuntimeError("down")
        return "done"

    urls = [f"https://a.example/{i}" for i in range(100)]
    keys = column(spark, urls, lambda c: F.sha2(F.concat(F.lit(f"{C.LINK_SOURCE}|url|"), c), 256))
    base = task(spark, "https://a.example/0")
    deliver(tmp_path / "in", "0.txt", [{**base, "payload": {**base["payload"], "url": u}, "dedupe_key": k} for u, k in zip(urls, keys, strict=True)])
    intake = TimedIntake(str(tmp_path / "s"), {C.LINK_TASK: by_call(call)}, delays=(0.1, 1))
    run(spark, tmp_path, intake)
    assert len(calls.read_text().split()) == 102
    assert results(spark, intake)[keys[7]] == ("done", 2, None)
    later = intake.actions(spark).where("action = 'handle'").groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in later] == [100, 1, 1]


def test_settled_identities_expire(spark, tmp_path):
    a = task(spark, "https://a.example/1")
    intake = TimedIntake(str(tmp_path / "s"), {C.LINK_TASK: answers(spark, {a["dedupe_key"]: 200})}, retention_days=30 / 86400)
    deliver(tmp_path / "in", "0.txt", [a])
    run(spark, tmp_path, intake)
    time.sleep(31)
    deliver(tmp_path / "in", "1.txt", [a])
    run(spark, tmp_path, intake)
    assert intake.actions(spark).where("action = 'known'").isEmpty() and intake.actions(spark).where("action = 'handle'").count() == 2
