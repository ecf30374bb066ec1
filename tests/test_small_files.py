"""A folder of many small files: few tasks, and no file is opened for nothing."""

from datetime import datetime

from stagetrail.plans import watch
from stagetrail.session import OPEN_COST, small_files
from stagetrail.sources.messages import read_listing


def test_many_small_files_are_few_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text("x")
    before = spark.conf.get(OPEN_COST, None)
    with small_files(spark):
        few = read_listing(spark, str(tmp_path)).rdd.getNumPartitions()
    assert few <= spark.sparkContext.defaultParallelism + 1 and spark.conf.get(OPEN_COST, None) == before


def test_a_scan_without_stable_files_opens_none(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "bus" / "inbox"
    inbox.mkdir(parents=True)
    (inbox / "a.txt").write_text("one")
    opened, read = [], watch.read_inbox
    monkeypatch.setattr(watch, "read_inbox", lambda *a, **kw: opened.append(1) or read(*a, **kw))
    scan = lambda n: watch.watch_folder(spark, str(inbox), str(tmp_path / "bus"), str(tmp_path / "s"), str(tmp_path / "o"), n, datetime(2025, 1, 1)).count()
    assert [(scan(n), len(opened)) for n in range(4)] == [(0, 0), (1, 1), (0, 1), (1, 2)]
