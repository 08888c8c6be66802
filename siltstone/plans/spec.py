"""Declarative description of one log source.

A ``Flow`` holds three layers: ``Ingest`` (raw files to bronze), ``SilverSpec``
(typed columns) and ``GoldSpec`` (one event class each).  Specs are plain Python
values; ``Flow.from_dict`` builds the same values from a nested mapping, so a flow
can also be written as YAML or JSON.  Expressions may be SQL strings or ``Column``s.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

Expression = str | Column
NOT_SET = object()


class SpecError(ValueError):
    """A flow description that cannot be turned into a plan."""


def unquote(name: str) -> str:
    """Column name without one pair of surrounding backticks."""
    return name[1:-1] if len(name) > 1 and name[0] == name[-1] == "`" else name


@dataclass(frozen=True, eq=False)
class Field:
    """One output field; a dotted ``name`` is a struct member.

    The value is taken from ``expr``, else ``literal``, else ``source``.
    """

    name: str
    expr: Expression | None = None
    literal: Any = NOT_SET
    source: str | None = None

    def __post_init__(self) -> None:
        if not self.name or any(not part for part in self.name.split(".")):
            raise SpecError(f"bad field name: {self.name!r}")
        if self.expr is None and self.literal is NOT_SET and self.source is None:
            raise SpecError(f"field {self.name!r} needs expr, literal or from")

    @classmethod
    def from_dict(cls, conf: Mapping[str, Any]) -> Field:
        if "name" not in conf:
            raise SpecError(f"field without a name: {dict(conf)}")
        return cls(
            name=conf["name"],
            expr=conf.get("expr"),
            literal=conf.get("literal", NOT_SET),
            source=conf.get("from"),
        )


def fields(columns: Mapping[str, Any]) -> tuple[Field, ...]:
    """Fields from ``{name: value}``: a Column is used as is, all else is a literal."""
    return tuple(
        Field(name, expr=value) if isinstance(value, Column) else Field(name, literal=value)
        for name, value in columns.items()
    )


@dataclass(frozen=True, eq=False)
class LookupSource:
    """Static side of a lookup: a table, a file set, or a DataFrame."""

    path: str | None = None
    kind: str = "table"
    format: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    frame: DataFrame | None = None


@dataclass(frozen=True, eq=False)
class Lookup:
    """A join with a static side.

    ``unique`` checks that its keys do not repeat, with a Spark job over the side while
    the plan is built.  ``salt`` deals the rows of a hot main key over so many tasks, if
    the side is too large to be broadcast.  ``hot_keys`` finds out which main keys are
    hot, with a job over the main side's key columns, and salts those alone; on a stream,
    whose keys are not known beforehand, it changes nothing.
    """

    source: LookupSource
    on: tuple[tuple[str, str], ...]
    name: str = "unnamed"
    how: str = "left"
    select: tuple[str, ...] = ()
    prefix: str = ""
    broadcast: bool = False
    unique: bool = False
    salt: int = 0
    hot_keys: bool = False

    def __post_init__(self) -> None:
        if not self.on:
            raise SpecError(f"lookup {self.name!r} needs at least one join condition")
        if self.how not in ("left", "inner", "right", "full"):
            raise SpecError(f"lookup {self.name!r}: unsupported join type {self.how!r}")

    @classmethod
    def from_dict(cls, conf: Mapping[str, Any]) -> Lookup:
        name = conf.get("name", "unnamed")
        source = conf.get("source") or {}
        if not source.get("path"):
            raise SpecError(f"lookup {name!r} needs a source path")
        join = conf.get("join") or {}
        # YAML 1.1 reads a bare `on` key as the boolean True.
        conditions = join.get("on") or join.get(True) or []
        if isinstance(conditions, str):
            conditions = [conditions]
        return cls(
            source=LookupSource(
                path=source["path"],
                kind=source.get("type", "table"),
                format=source.get("format"),
                options=source.get("options") or {},
                schema=source.get("schema"),
            ),
            on=tuple(_key_pair(name, c) for c in conditions),
            name=name,
            how=join.get("type", "left"),
            select=tuple(unquote(c) for c in conf.get("select") or ()),
            prefix=conf.get("prefix") or "",
            broadcast=bool(conf.get("broadcast", False)),
            unique=bool(conf.get("unique", False)),
            salt=int(conf.get("salt", 0)),
            hot_keys=bool(conf.get("hotKeys", False)),
        )


def _key_pair(lookup: str, condition: Any) -> tuple[str, str]:
    """``"main.a = lookup.b"``, ``"a"`` or ``{left: a, right: b}`` as (main, lookup)."""
    if isinstance(condition, Mapping):
        left, right = condition.get("left"), condition.get("right")
        if not (left or right):
            raise SpecError(f"lookup {lookup!r}: bad join condition {condition!r}")
        return unquote(left or right), unquote(right or left)
    left, equals, right = (part.strip() for part in str(condition).partition("="))
    if not left or (equals and not right):
        raise SpecError(f"lookup {lookup!r}: bad join condition {condition!r}")
    if not equals:
        return unquote(left), unquote(left)
    return unquote(left.removeprefix("main.")), unquote(right.removeprefix("lookup."))


@dataclass(frozen=True, eq=False)
class Ingest:
    """Raw files to one bronze table."""

    name: str
    inputs: tuple[str, ...] = ()
    format: str = "json"
    multiline: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    schema_hints: str | None = None
    single_variant: bool = False
    pre: tuple[tuple[Expression, ...], ...] = ()
    lookups: tuple[Lookup, ...] = ()
    post: tuple[Expression, ...] = ()
    drop: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ("time",)

    @property
    def payload(self) -> str:
        return "data" if self.single_variant else "value"

    # Key names of the mapping form are fixed values: existing flow files use them.
    @classmethod
    def from_dict(cls, flow_name: str, reader: Mapping[str, Any], conf: Mapping[str, Any]) -> Ingest:
        if "format" not in reader:
            raise SpecError(f"flow {flow_name!r}: the reader needs a format")
        extra = dict(reader.get("cloudFiles") or {})
        extra.pop("schemaHintsFile", None)
        schema = reader.get("schema") or extra.pop("schema", None)
        extra.pop("schema", None)
        hints = extra.pop("schemaHints", None)
        return cls(
            name=conf.get("name") or flow_name,
            inputs=tuple(reader.get("inputs") or ()),
            format=str(reader["format"]).lower(),
            multiline=str(reader.get("multiline", "false")).lower() == "true",
            options={**extra, **(reader.get("options") or {})},
            schema=schema,
            schema_hints=hints,
            single_variant=bool(conf.get("loadAsSingleVariant", False)),
            pre=_passes(conf.get("preTransform") or ()),
            lookups=tuple(Lookup.from_dict(c) for c in conf.get("lookups") or ()),
            post=tuple(conf.get("postTransform") or ()),
            drop=tuple(unquote(c) for c in conf.get("drop") or ()),
            cluster_by=tuple(conf.get("clusterBy", ("time",)) or ()),
        )


def _passes(conf: Iterable[Any]) -> tuple[tuple[Expression, ...], ...]:
    """A list of lists is several select passes; a flat list is one pass."""
    conf = list(conf)
    if any(isinstance(item, (list, tuple)) for item in conf):
        if not all(isinstance(item, (list, tuple)) for item in conf):
            raise SpecError("preTransform mixes expressions and lists of expressions")
        return tuple(tuple(item) for item in conf)
    return (tuple(conf),) if conf else ()


@dataclass(frozen=True, eq=False)
class SilverSpec:
    """One parsed table."""

    name: str
    input: str | None = None
    lookups: tuple[Lookup, ...] = ()
    filter: Expression | None = None
    temporary: tuple[Field, ...] = ()
    fields: tuple[Field, ...] = ()
    preserve: bool = False
    omit: tuple[str, ...] = ()
    post_filter: Expression | None = None
    cluster_by: tuple[str, ...] = ("time",)

    @classmethod
    def from_dict(cls, flow_name: str, conf: Mapping[str, Any]) -> SilverSpec:
        utils = conf.get("utils") or {}
        carried = utils.get("unreferencedColumns") or {}
        return cls(
            name=conf.get("name") or flow_name,
            input=conf.get("input"),
            lookups=tuple(Lookup.from_dict(c) for c in conf.get("lookups") or ()),
            filter=conf.get("filter"),
            temporary=tuple(Field.from_dict(c) for c in utils.get("temporaryFields") or ()),
            fields=tuple(Field.from_dict(c) for c in conf.get("fields") or ()),
            preserve=bool(carried.get("preserve", False)),
            omit=tuple(unquote(c) for c in carried.get("omitColumns") or ()),
            post_filter=conf.get("postFilter"),
            cluster_by=tuple(conf.get("clusterBy", ("time",)) or ()),
        )


@dataclass(frozen=True, eq=False)
class GoldSpec:
    """One mapping from a parsed table to an event class."""

    name: str
    input: str
    filter: Expression | None = None
    explode: str | None = None
    temporary: tuple[Field, ...] = ()
    fields: tuple[Field, ...] = ()
    post_filter: Expression | None = None
    catalog: str | None = None
    database: str | None = None
    cluster_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.name or not self.input:
            raise SpecError(f"a gold mapping needs a name and an input: {self.name!r}")

    @classmethod
    def from_dict(cls, conf: Mapping[str, Any]) -> GoldSpec:
        return cls(
            name=conf.get("name", ""),
            input=conf.get("input", ""),
            filter=conf.get("filter"),
            explode=unquote(conf["explode"]) if conf.get("explode") else None,
            temporary=tuple(
                Field.from_dict(c) for c in (conf.get("utils") or {}).get("temporaryFields") or ()
            ),
            fields=tuple(Field.from_dict(c) for c in conf.get("fields") or ()),
            post_filter=conf.get("postFilter"),
            catalog=conf.get("catalog"),
            database=conf.get("database"),
            cluster_by=tuple(conf.get("clusterBy") or ()),
        )


@dataclass(frozen=True, eq=False)
class Flow:
    """All layers of one log source."""

    name: str
    ingest: Ingest
    silver: tuple[SilverSpec, ...] = ()
    gold: tuple[GoldSpec, ...] = ()
    provider: str = ""
    log_name: str = ""
    version: str = "1.0"

    def __post_init__(self) -> None:
        names = [s.name for s in self.silver]
        if len(set(names)) != len(names):
            raise SpecError(f"flow {self.name!r}: silver names repeat: {names}")
        for mapping in self.gold:
            if "." not in mapping.input and mapping.input not in names:
                raise SpecError(
                    f"flow {self.name!r}: {mapping.name!r} reads unknown table {mapping.input!r}; known: {names}"
                )

    @classmethod
    def from_dict(cls, conf: Mapping[str, Any]) -> Flow:
        for key in ("name", "autoloader"):
            if not conf.get(key):
                raise SpecError(f"flow description lacks {key!r}")
        name = conf["name"]
        flow = cls(
            name=name,
            ingest=Ingest.from_dict(name, conf["autoloader"], conf.get("bronze") or {}),
            silver=tuple(
                SilverSpec.from_dict(name, c) for c in (conf.get("silver") or {}).get("transform") or ()
            ),
            gold=tuple(GoldSpec.from_dict(c) for c in conf.get("gold") or ()),
            provider=conf.get("provider") or name,
            log_name=conf.get("logName") or name,
            version=str(conf.get("version", "1.0")),
        )
        _reject_unfinished(conf)
        return flow


_UNFINISHED = re.compile(r"\b(TODO|FIXME|PLACEHOLDER)\b|<[A-Z][A-Z_]+>")


def _reject_unfinished(node: Any, path: str = "") -> None:
    """Raise when a description still holds text its author meant to replace."""
    if isinstance(node, Mapping):
        for key, value in node.items():
            _reject_unfinished(value, f"{path}.{key}" if path else str(key))
    elif isinstance(node, (list, tuple)):
        for position, value in enumerate(node):
            _reject_unfinished(value, f"{path}[{position}]")
    elif isinstance(node, str) and not path.startswith(("title", "description", "autoloader.inputs")):
        found = _UNFINISHED.search(node)
        if found:
            raise SpecError(f"{path}: unfinished text {found.group(0)!r}")


def load_flow(path: str) -> Flow:
    """Read a flow from a ``.json`` or YAML file."""
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            conf = json.load(handle)
        else:
            try:
                import yaml
            except ImportError as missing:
                raise SpecError("YAML flows need the PyYAML package; write JSON instead") from missing
            conf = yaml.safe_load(handle)
    if not conf:
        raise SpecError(f"{path} is empty")
    return Flow.from_dict(conf)
