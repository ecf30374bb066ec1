"""Schemas compiled to Column rules, against plain Python on many documents."""

import itertools
import json
import re

import pytest
from helpers import column
from pyspark.sql import functions as F

from stagetrail import constants as C
from stagetrail.operators import contracts
from stagetrail.operators.json_contract import Contract, UnknownKeyword, check_documents, load_contract

# A second contract, with other keywords and names that need quoting in a path.
ORDER = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "an order",
    "type": "object",
    "required": ["no", "lines"],
    "properties": {
        "no": {"type": "integer", "minimum": 1, "maximum": 999},
        "state": {"enum": ["open", "closed", None, 3, True]},
        "share": {"type": ["number", "null"], "exclusiveMinimum": 0, "exclusiveMaximum": 1},
        "lines": {"type": "array", "minItems": 1, "maxItems": 3},
        "a.b c": {"type": "object", "additionalProperties": False, "required": ["x"], "properties": {"x": {"type": "string", "minLength": 2, "maxLength": 4}, "y": {"type": "boolean"}}},
    },
    "if": {"properties": {"state": {"const": "closed"}}, "required": ["state"]},
    "then": {"required": ["share"], "properties": {"share": {"type": "number"}}},
    "else": {"properties": {"no": {"maximum": 500}}},
}


def kind(v):
    return {str: "string", type(None): "null", bool: "boolean", dict: "object", list: "array", int: "integer", float: "number"}[type(v)]


def errors(v, s, path=(), conditional=0):
    """(path, conditional, order, keyword) of every broken rule."""
    number = kind(v) in ("integer", "number")
    for order, (k, w) in enumerate(s.items()):
        broken = {
            "type": lambda: kind(v) not in ([w] if isinstance(w, str) else w) and not (kind(v) == "integer" and "number" in ([w] if isinstance(w, str) else w)),
            "const": lambda: json.dumps(v) != json.dumps(w),
            "enum": lambda: json.dumps(v) not in map(json.dumps, w),
            "required": lambda: kind(v) == "object" and any(n not in v for n in w),
            "additionalProperties": lambda: kind(v) == "object" and any(n not in s["properties"] for n in v),
            "minLength": lambda: kind(v) == "string" and len(v) < w,
            "maxLength": lambda: kind(v) == "string" and len(v) > w,
            "pattern": lambda: kind(v) == "string" and not re.search(w, v),
            "minimum": lambda: number and v < w,
            "maximum": lambda: number and v > w,
            "exclusiveMinimum": lambda: number and v <= w,
            "exclusiveMaximum": lambda: number and v >= w,
            "minItems": lambda: kind(v) == "array" and len(v) < w,
            "maxItems": lambda: kind(v) == "array" and len(v) > w,
        }.get(k, lambda: False)()
        if broken:
            yield path, conditional, order, k
    if kind(v) == "object":
        for n, inner in s.get("properties", {}).items():
            if n in v:
                yield from errors(v[n], inner, (*path, n), conditional)
    for part in s.get("allOf", ()):
        yield from errors(v, part, path, conditional)
    if "if" in s:
        branch = "else" if list(errors(v, s["if"], path)) else "then"
        if branch in s:
            yield from errors(v, s[branch], path, 1)


def first(v, s):
    found = sorted(errors(v, s))
    return f"{'/'.join(found[0][0]) or '<root>'}: {found[0][3]}" if found else None


def checked(spark, texts, schema):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.try_parse_json("t").alias("doc"))
    return [r["reason"] for r in sorted(check_documents(df, schema).select("i", "reason").collect())]


def test_second_schema_against_plain_python(spark):
    absent = object()
    choices = {
        "no": [absent, 5, 0, 700, 1000, "5", 1.5],
        "state": ["open", "closed", 4, absent, None, True],
        "share": [absent, 0.5, 1, None],
        "lines": [[1], [], [1, 2, 3, 4], "x"],
        "a.b c": [absent, {"x": "ok"}, {"x": "o"}, {"x": "long text", "z": 1}, {}],
    }
    docs = [{k: v for k, v in zip(choices, c, strict=True) if v is not absent} for c in itertools.product(*choices.values())]
    docs += [[], "x", 7, None, True, {}, {"no": 5, "lines": [1], "other": 1}]
    got = checked(spark, [json.dumps(d) for d in docs], ORDER)
    want = [first(d, ORDER) for d in docs]
    assert got == want and len(set(want)) > 12 and want.count(None) > 10


def test_text_that_is_no_document(spark):
    assert checked(spark, ["{", "", "{}"], {"type": "object"}) == ["not json", "not json", None]


def test_task_contract_from_a_file(spark, tmp_path):
    """The document that is read at run time is the one that decides."""
    path = tmp_path / "task.json"
    path.write_text(json.dumps(contracts.task_contract(), indent=2))
    task = {"schema": C.TASK_SCHEMA, "task_id": "0f0f0f0f-0000-4000-8000-000000000000", "type": C.LINK_TASK, "source": C.LINK_SOURCE,
            "payload": {"url": "https://a.example/x", "file_id": None, "version": None, "text": None}, "created_at": "2025-01-02T03:04:05Z"}
    key = column(spark, ["https://a.example/x"], lambda c: F.sha2(F.concat(F.lit(f"{C.LINK_SOURCE}|url|"), c), 256))[0]
    sent = [json.dumps(task | {"dedupe_key": key}), json.dumps(task | {"dedupe_key": "0" * 64}), json.dumps(task | {"dedupe_key": key, "note": 1}), "{"]
    rows = spark.createDataFrame(list(enumerate(sent)), "i int, value string")
    reasons = lambda schema: [r["reason"] for r in sorted(contracts.check_messages(rows, schema=schema).select("i", "reason").collect())]
    want = [None, "dedupe_key: does not match payload identity", "<root>: additionalProperties", "not json"]
    assert reasons(load_contract(spark, str(path))) == want == reasons(None)
    looser = contracts.task_contract() | {"additionalProperties": True}
    path.write_text(json.dumps(looser))
    assert reasons(load_contract(spark, str(path)))[2] is None
    stricter = contracts.task_contract()
    stricter["properties"]["payload"]["properties"]["url"]["maxLength"] = 5
    assert reasons(stricter)[0] == "payload/url: maxLength"


@pytest.mark.parametrize("schema", [{"type": "object", "patternProperties": {}}, {"properties": {"a": {"format": "email"}}}, {"enum": [[1]]}])
def test_keywords_that_would_be_ignored_are_refused(schema):
    with pytest.raises(UnknownKeyword):
        Contract(schema)
