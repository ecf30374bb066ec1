"""The keyed state's processor by itself: which answers it gives, and how often it asks the store."""

from pyspark.sql import Row

from stagetrail.streaming.retries import _Retries


class Store:
    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema, ttl):  # noqa: N802
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 1000


def row(kind, task=None, created_at=None, task_id=None, status=None, detail=None, attempt=None):
    return Row(dedupe_key="k", kind=kind, task=task, created_at=created_at, task_id=task_id, status=status, detail=detail, attempt=attempt)


def test_an_identity_from_delivery_to_failure():
    store = Store()
    retries = _Retries(3, (2, 60), 1000)
    retries.init(store)
    say = lambda *rows: [tuple(r) for r in retries.handleInputRows(("k",), iter(rows), store)]
    later, first = row("task", "later", "2025-01-02", "t2"), row("task", "first", "2025-01-01", "t9")
    assert say(later, first, row("invalid", "bad", detail="not json")) == [("k", "quarantined", 0, 0, "bad", "not json"), ("k", "handle", 1, 0, "first", None)]
    assert store.calls == 2  # one question and one answer for all its rows
    assert say(later) == [] and store.value == ("open", 1, 0, 3, "first")
    store.value = ("open", 1, 0, 1, "first")
    assert say(row("outcome", status="transient", attempt=1)) == [] and store.timers == [3000]
    assert say(row("outcome", status="done", attempt=1)) == []  # that attempt is not open any more
    assert say(later) == [("k", "handle", 2, 1, "later", None)] and store.timers == []
    assert say(row("outcome", status="transient", attempt=2)) == [] and store.timers == [5000]
    assert [tuple(r) for r in retries.handleExpiredTimer(("k",), store, None)] == [("k", "handle", 3, 2, "later", None)]
    assert say(row("outcome", status="transient", attempt=3)) == [("k", "failed", 3, 3, "later", "max_attempts")]
    assert say(later) == [("k", "handle", 4, 3, "later", None)]
    assert say(row("outcome", status="done", attempt=4)) == [("k", "done", 4, 3, "later", None)]
    assert say(later) == [("k", "known", 4, 3, None, "done")]
