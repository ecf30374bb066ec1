"""A JSON Schema document compiled to Column rules over a VARIANT.

Every rule is ``path: keyword`` with a predicate that is true when the document breaks it. Rules come in the order the first
error is chosen: the root, then members by path; within a member in the order of the schema, conditional ones last.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.functions.text import matches

DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$"
#: Keywords that say nothing about validity.
ANNOTATIONS = ("$schema", "$id", "$comment", "title", "description", "examples", "default")
#: Types of a schema as prefixes of what Spark calls the type of a VARIANT.
KINDS = {
    "string": ("STRING",),
    "null": ("VOID",),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
}
Path = tuple[str, ...]


def load_contract(spark: SparkSession, path: str) -> dict:
    """A schema document from any store Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


class UnknownKeyword(ValueError):
    """A schema keyword that would be ignored if it were not refused."""


@dataclass(frozen=True)
class Member:
    """A place in the document: its columns are named by its number, so that names in the schema may be anything."""

    path: Path
    number: int

    @property
    def kind(self) -> Column:
        return F.col(f"_kind_{self.number}")

    @property
    def text(self) -> Column:
        return F.col(f"_text_{self.number}")

    @property
    def keys(self) -> Column:
        return F.col(f"_keys_{self.number}")

    @property
    def value(self) -> Column:
        return F.col(f"_member_{self.number}")

    def is_a(self, *types: str) -> Column:
        """Whether the member is there and has one of the types; false, never NULL, if it is not there."""
        starts = [F.startswith(self.kind, F.lit(prefix)) for t in types for prefix in KINDS[t]]
        found = starts[0]
        for s in starts[1:]:
            found = found | s
        return F.coalesce(found, F.lit(False))


@dataclass
class Contract:
    """``rules`` of a schema, and the columns they look at."""

    schema: Mapping
    members: dict[Path, Member] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._name((), self.schema)
        own = sorted(self._rules((), self.schema, None), key=lambda r: (r[0], r[1]))
        self.rules: list[tuple[str, Column]] = [(f"{'/'.join(path) or '<root>'}: {keyword}", broken) for path, _, keyword, broken in own]

    def _name(self, path: Path, schema: Mapping) -> None:
        self.members.setdefault(path, Member(path, len(self.members)))
        for name, inner in schema.get("properties", {}).items():
            self._name((*path, name), inner)
        for part in (*schema.get("allOf", ()), *(schema[k] for k in ("if", "then", "else") if k in schema)):
            self._name(path, part)

    def _rules(self, path: Path, schema: Mapping, when: Column | None) -> Iterator[tuple[Path, int, str, Column]]:
        """(path, 1 if conditional, keyword, whether it is broken)."""
        here = self.members[path]
        for keyword, wanted in schema.items():
            if keyword in ANNOTATIONS or keyword in ("then", "else"):
                continue
            if keyword == "properties":
                for name, inner in wanted.items():
                    yield from self._rules((*path, name), inner, when)
            elif keyword == "allOf":
                for part in wanted:
                    yield from self._rules(path, part, when)
            elif keyword == "if":
                holds = ~self._any(self._rules(path, wanted, None))
                for branch, test in (("then", holds), ("else", ~holds)):
                    if branch in schema:
                        yield from self._rules(path, schema[branch], test if when is None else when & test)
            else:
                broken = F.coalesce(self._broken(here, keyword, wanted), F.lit(False))
                yield path, int(when is not None), keyword, broken if when is None else when & broken

    @staticmethod
    def _any(rules: Iterator[tuple]) -> Column:
        found = F.lit(False)
        for *_, broken in rules:
            found = found | broken
        return found

    def _broken(self, here: Member, keyword: str, wanted) -> Column:
        there = here.kind.isNotNull()
        if keyword == "type":
            return there & ~here.is_a(*([wanted] if isinstance(wanted, str) else wanted))
        if keyword in ("const", "enum"):
            return there & ~self._one_of(here, [wanted] if keyword == "const" else wanted)
        if keyword == "required":
            return here.is_a("object") & (F.size(F.array_except(_texts(wanted), here.keys)) > 0)
        if keyword == "additionalProperties" and wanted is False:
            return here.is_a("object") & (F.size(F.array_except(here.keys, _texts(self._known(here.path)))) > 0)
        if keyword == "additionalProperties" and wanted is True:
            return F.lit(False)
        if keyword in ("minLength", "maxLength"):
            size = F.char_length(here.text)
            return size < wanted if keyword == "minLength" else size > wanted
        if keyword == "pattern":
            return ~matches(here.text, wanted)
        if keyword == "format" and wanted == "date-time":
            return ~F.rlike(here.text, F.lit(DATE_TIME)) | (here.text.isNotNull() & here.text.try_cast("timestamp").isNull())
        if keyword in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            number = F.when(here.is_a("number"), F.try_variant_get(here.value, "$", "double"))
            low = number < wanted if keyword == "minimum" else number <= wanted
            high = number > wanted if keyword == "maximum" else number >= wanted
            return low if keyword in ("minimum", "exclusiveMinimum") else high
        if keyword in ("minItems", "maxItems"):
            size = F.size(F.when(here.is_a("array"), F.try_variant_get(here.value, "$", "array<variant>")))
            return here.is_a("array") & (size < wanted if keyword == "minItems" else size > wanted)
        raise UnknownKeyword(f"{'/'.join(here.path) or '<root>'}: {keyword} = {wanted!r}")

    def _known(self, path: Path) -> list[str]:
        """Members that the object at the path names itself; those of conditions do not count."""
        schema = self.schema
        for name in path:
            schema = schema["properties"][name]
        return list(schema.get("properties", {}))

    @staticmethod
    def _one_of(here: Member, allowed: list) -> Column:
        texts = [a for a in allowed if isinstance(a, str)]
        found = F.coalesce(here.text.isin(*texts), F.lit(False)) if texts else F.lit(False)
        for value in allowed:
            if value is None:
                found = found | here.is_a("null")
            elif isinstance(value, bool):
                found = found | (here.is_a("boolean") & (F.try_variant_get(here.value, "$", "boolean") == value))
            elif isinstance(value, int | float):
                found = found | (here.is_a("number") & (F.try_variant_get(here.value, "$", "double") == float(value)))
            elif not isinstance(value, str):
                raise UnknownKeyword(f"{here.path}: enum of {type(value).__name__}")
        return F.coalesce(found, F.lit(False))

    def read_members(self, df: DataFrame, doc: str = "doc") -> DataFrame:
        """Types, texts and keys of all members as flat columns.

        Flat, because the optimiser copies the parts of a struct into every rule that uses them; a plain column is
        computed once. Only columns that a rule of their member can look at are made.
        """
        at = {m.number: "$" + "".join(f"['{name}']" for name in m.path) for m in self.members.values()}
        found = df.withColumns({f"_member_{n}": F.try_variant_get(doc, path, "variant") for n, path in at.items()})
        found = found.withColumns({f"_kind_{n}": F.schema_of_variant(f"_member_{n}") for n in at})
        text = {f"_text_{n}": F.when(F.col(f"_kind_{n}") == "STRING", F.try_variant_get(f"_member_{n}", "$", "string")) for n in at}
        parents = {m.path[:-1] for m in self.members.values() if m.path} | {()}
        keys = {f"_keys_{m.number}": F.map_keys(F.try_variant_get(f"_member_{m.number}", "$", "map<string,variant>")) for p, m in self.members.items() if p in parents}
        return found.withColumns({**text, **keys})

    def text(self, *path: str) -> Column:
        """The text of a member after ``read_members``; NULL if it is not a string."""
        return self.members[path].text

    def first_error(self) -> Column:
        """The first broken rule of a document after ``read_members``; NULL if it keeps all of them."""
        return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in self.rules], F.lit(None).cast("string"))


def _texts(names) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def check_documents(df: DataFrame, schema: Mapping, doc: str = "doc") -> DataFrame:
    """df and ``reason``: the first rule of any schema that the VARIANT column breaks, ``not json`` if it is NULL."""
    contract = Contract(schema)
    reason = F.when(F.col(doc).isNull(), F.lit("not json")).otherwise(contract.first_error())
    return contract.read_members(df, doc).withColumn("reason", reason).select(*df.columns, "reason")
