"""Tables declared by a JSON or YAML-like specification."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tidemark.functions.jsondoc import unwrap_id
from tidemark.sources import topics
from tidemark.sources.envelope import parse_json

_TOKEN = re.compile(r"`[^`]*`|[<>,()]|[^\s<>,()`]+")


def spark_type(declared: str) -> str:
    """A declared column type as Spark DDL.

    ``ROW<a T, b U>`` becomes ``struct<a: T, b: U>``; ``TIMESTAMP_LTZ(p)``
    becomes ``timestamp``. Everything else is spelled alike.
    """
    tokens = _TOKEN.findall(declared)
    out: list[str] = []
    in_row: list[bool] = []
    expect_name = False
    skip_precision = False
    for token in tokens:
        word = token.upper()
        if skip_precision and token in "()" or skip_precision and token.isdigit():
            skip_precision = token != ")"
            continue
        skip_precision = False
        if token == "<":
            in_row.append(out[-1] == "struct")
            expect_name = in_row[-1]
            out.append("<")
        elif token == ">":
            in_row.pop()
            out.append(">")
        elif token == ",":
            expect_name = bool(in_row) and in_row[-1]
            out.append(", ")
        elif expect_name:
            out.append(f"`{token.strip('`')}`: ")
            expect_name = False
        elif word == "ROW":
            out.append("struct")
        elif word.startswith("TIMESTAMP"):
            out.append("timestamp")
            skip_precision = True
        else:
            out.append(token.lower())
    return "".join(out)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Mapping[str, str]
    options: Mapping[str, str]
    comment: str = ""

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {spark_type(kind)}" for name, kind in self.columns.items())


def load_spec(text: str) -> TableSpec:
    """Parse the JSON form: identifier, columns with type texts, options, comment."""
    table = json.loads(text)["table"]
    identifier = table["identifier"]
    name = ".".join(identifier[part] for part in ("catalog", "database", "table") if identifier.get(part))
    columns = {c["name"]: c["type"] for c in table["schema"]["columns"]}
    return TableSpec(name, columns, table.get("options", {}), table.get("comment", ""))


def compact_spec(declaration: Mapping[str, object]) -> TableSpec:
    """The flat form: ``name`` and reader options side by side, ``schema`` as lines ``name TYPE``."""
    lines = str(declaration.get("schema") or "").splitlines()
    columns = dict(line.strip().split(None, 1) for line in lines if line.strip())
    options = {k: "" if v is None else str(v) for k, v in declaration.items() if k not in ("name", "schema")}
    return TableSpec(str(declaration["name"]), columns, options)


def kafka_reader_options(spec: TableSpec) -> dict[str, str]:
    """Options of a topic table in the names that Spark's Kafka source uses."""
    client = {
        name.removeprefix("properties."): value
        for name, value in spec.options.items()
        if name.startswith("properties.")
    }
    servers = client.pop("bootstrap.servers")
    group = client.pop("group.id", None)
    starting = {"earliest-offset": "earliest", "latest-offset": "latest"}[
        spec.options.get("scan.startup.mode", "earliest-offset")
    ]
    return topics.topic_options(servers, spec.options["topic"], group, client, starting)


def decode(spec: TableSpec, records: DataFrame) -> DataFrame:
    """Log records as the columns of the table; what cannot be parsed becomes null."""
    return parse_json(records, spec.ddl, malformed=None).select("event.*")


def open_table(spark: SparkSession, spec: TableSpec, streaming: bool = True) -> DataFrame:
    """A topic table as DataFrame, registered under its own short name as a view."""
    options = kafka_reader_options(spec)
    reader = topics.stream_topic if streaming else topics.replay_topic
    table = decode(spec, reader(spark, options))
    table.createOrReplaceTempView(spec.name.rsplit(".", 1)[-1])
    return table


def array_paths(kind: DataType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Every array inside a type, outer ones first, by the names that lead to it; rows between have no step of their own."""
    if isinstance(kind, ArrayType):
        return [path, *array_paths(kind.elementType, path)]
    if isinstance(kind, StructType):
        return [found for field in kind for found in array_paths(field.dataType, (*path, field.name))]
    return []


def _leaves(kind: DataType, value: Column, path: tuple[str, ...]) -> list[Column]:
    """The plain values of nested rows as columns named by their path; arrays are left out."""
    if isinstance(kind, StructType):
        return [leaf for f in kind for leaf in _leaves(f.dataType, value.getField(f.name), (*path, f.name))]
    return [] if isinstance(kind, ArrayType) else [value.alias("_".join(path))]


def unnest(rows: DataFrame, path: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array at ``path``, with the plain values of every row around it.

    The declared type leads the way: rows are entered by name, every array on the way is exploded and adds its
    position as ``<path>_pos``. Outer semantics: what has no elements (a null or empty array) keeps one row with nulls.
    Columns are named by their path joined with ``_``; arrays beside the path are left out, see ``array_paths``.
    """
    here, kind, value = (), rows.schema, None
    frame, kept, steps = rows, [], list(path)
    while True:
        inside = [f for f in kind] if isinstance(kind, StructType) else []
        for field in inside:
            source = F.col(f"`{field.name}`") if value is None else value.getField(field.name)
            if not steps or field.name != steps[0] or isinstance(field.dataType, ArrayType):
                kept += _leaves(field.dataType, source, (*here, field.name))
        if not steps:
            break
        step = steps.pop(0)
        found = [f for f in inside if f.name == step]
        if not found:
            raise ValueError(f"no field {step!r} at {'.'.join(here) or 'the top'}")
        value = F.col(f"`{step}`") if value is None else value.getField(step)
        here, kind = (*here, step), found[0].dataType
        while isinstance(kind, ArrayType):
            name = "_".join(here)
            frame = frame.select("*", F.posexplode_outer(value).alias(f"{name}_pos", f"__{name}"))
            kept.append(F.col(f"`{name}_pos`"))
            value, kind = F.col(f"`__{name}`"), kind.elementType
            if not isinstance(kind, (StructType, ArrayType)):
                kept.append(value.alias(name))
            here = (*here, "item") if isinstance(kind, ArrayType) else here
    return frame.select(*kept)


def points_rows(records: DataFrame, ddl: str) -> DataFrame:
    """Id, keyword and points of a small change event."""
    parsed = parse_json(records, ddl, malformed=None)
    document = F.col("event.fullDocument")
    return parsed.filter(document.isNotNull()).select(
        unwrap_id(document["_id"]).alias("id"),
        document["keyword"].alias("keyword"),
        document["points"].alias("points"),
    )
