"""Shorthands for small frames."""

from __future__ import annotations


def column(spark, values, expression, kind="string"):
    """Evaluate a Column function over a list of values, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


# A ledger with every stage a job can be in; the first row also carries what must never leave it.
JOBS = [
    {"job_id": "k-10", "title": "Forecasting Analyst (Excel, SQL)", "company": "Blue Kiln", "location": "Porto", "status": "new",
     "created_at_utc": "2025-02-03T06:15:00Z", "source_url": "https://Board.example.org:8443/p/10?x=1", "origin": "feed",
     "match_score": 0.25, "notes": "do not share", "job_text": "the full advert", "reply_from": "hr@example.org"},
    {"id": "k-11", "title": "Warehouse Planner", "found_at_utc": "2025-02-03T07:00:00"},
    {"job_id": "k-12", "title": "ETL Maintainer, Kafka", "status": "email_sent", "added_at_utc": "2025-02-04T10:30:00Z",
     "email_sent_at_utc": "2025-02-06T09:00:00+02:00", "cv_docx": "/srv/papers/anna.docx"},
    {"job_id": "k-13", "title": "Vision Researcher", "status": "form_submitted", "created_at_utc": "2025-02-05T12:00:00Z",
     "form_submitted_at_utc": "2025-02-07T12:00:00Z", "reply_seen_at_utc": "2025-02-12T18:00:00Z", "cv_basename": "cv-20250202-vision"},
    {"job_id": "k-14", "title": "iOS Developer", "status": "submitted"},
    {"job_id": "k-15", "title": "Tableau Builder", "status": "closed", "created_at_utc": "2025-02-08T08:00:00Z",
     "sent_at_utc": "2025-02-09T08:00:00Z"},
    {"job_id": "k-16", "title": "LLM Engineer, AWS", "created_at_utc": "2025-02-21T16:45:00Z", "source_type": "image/webp"},
    {"job_id": "k-17", "title": "Mobile Developer", "created_at_utc": "2025-02-22T05:00:00Z", "draft_created_at_utc": "2025-02-23T05:00:00Z"},
    {"job_id": "k-18", "title": "Data Science Fellow", "status": "sent", "created_at_utc": "2025-02-24T11:00:00Z",
     "sent_at_utc": "2025-02-25T11:00:00Z", "reply_seen_at_utc": "2025-03-09T12:00:00Z"},
]


def write_ledger(folder, jobs, name="jobs.json"):
    import json

    path = folder / name
    path.write_text(json.dumps({"jobs": jobs}, ensure_ascii=False), encoding="utf-8")
    return str(path)
