"""Column builders that turn vendor values into event-class values.

All are compositions of built-in functions; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import codes

ENRICHMENT = "struct<name:string,value:string,data:variant,desc:string>"
OBSERVABLE = "struct<name:string,type:string,value:string>"


# -- building blocks ---------------------------------------------------------------


def lookup(key: Column, table: Mapping[Any, Any], default: Any = None) -> Column:
    """Value of ``key`` in a small fixed table; the key is evaluated once."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    found = F.create_map(*pairs)[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def column_of(table: Mapping[Any, tuple], position: int) -> dict[Any, Any]:
    """One value column of a table whose values are tuples."""
    return {key: values[position] for key, values in table.items()}


def first_match(rules: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule that holds; a rule that is NULL does not hold."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain if default is None else chain.otherwise(default)


def missing_as_null(value: Column, marker: str = "-") -> Column:
    """The marker a format uses for 'no value' becomes NULL.

    ``value`` is named twice, so it should be a column or struct member.  ``nullif``
    would define it as a common expression of its own, and the optimizer then merges the
    projections around it and computes shared inputs once per field.
    """
    return F.when(value != marker, value)


def record(members: Mapping[str | tuple[str, ...], str], data: str | Column = "data") -> Column:
    """All wanted members of a variant record as one struct, read in a single pass.

    ``members`` maps a path to a type; a dotted path descends, a tuple holds keys that
    have dots themselves.  A member that is absent, or not of its type, is NULL, just as
    with one ``try_variant_get`` per member, at a fraction of the time.
    """
    tree: dict[str, Any] = {}
    for path, kind in members.items():
        *parents, leaf = path.split(".") if isinstance(path, str) else path
        branch = tree
        for key in parents:
            branch = branch.setdefault(key, {})
        branch[leaf] = kind
    return F.try_variant_get(data, "$", _shape(tree))


def _shape(tree: Mapping[str, Any]) -> str:
    members = (f"`{key}`:{_shape(kind) if isinstance(kind, Mapping) else kind}" for key, kind in tree.items())
    return f"struct<{','.join(members)}>"


def member(path: str | tuple[str, ...], of: str = "record") -> Column:
    """A member of a struct that ``record`` made."""
    column = F.col(of)
    for key in path.split(".") if isinstance(path, str) else path:
        column = column.getField(key)
    return column


def text(path: str, data: str | Column = "data") -> Column:
    return F.try_variant_get(data, path, "string")


def number(path: str, kind: str = "int", data: str | Column = "data") -> Column:
    return F.try_variant_get(data, path, kind)


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def sentence(*parts: Any) -> Column:
    """Concatenation of text and columns; a (column, default) pair is never NULL."""
    pieces = []
    for part in parts:
        if isinstance(part, tuple):
            pieces.append(F.coalesce(part[0].cast("string"), F.lit(part[1])))
        else:
            pieces.append(part if isinstance(part, Column) else F.lit(part))
    return F.concat(*pieces)


# -- severity, status, type --------------------------------------------------------


def syslog_severity(digit: Column) -> Column:
    return lookup(digit.try_cast("int"), codes.SYSLOG_SEVERITY, 99)


def word_severity(word: Column) -> Column:
    return lookup(word, codes.WORD_SEVERITY, 0)


def severity_name(severity_id: Column) -> Column:
    return lookup(severity_id, codes.SEVERITY_NAMES, "Other")


def status_name(status_id: Column) -> Column:
    return lookup(status_id, codes.STATUS_NAMES, "Unknown")


def action_name(action_id: Column) -> Column:
    return lookup(action_id, codes.ACTION_NAMES, "Unknown")


def disposition_name(disposition_id: Column) -> Column:
    return lookup(disposition_id, codes.DISPOSITION_NAMES, "Unknown")


def type_uid(class_uid: Column | int, activity_id: Column) -> Column:
    class_uid = class_uid if isinstance(class_uid, Column) else F.lit(class_uid)
    return (class_uid * 100 + activity_id).cast("bigint")


def type_name(class_name: str, activity_name: Column) -> Column:
    return F.concat(F.lit(f"{class_name}: "), activity_name)


def class_columns(event_class: str) -> dict[str, Column]:
    """The four columns that name a class and its category."""
    class_uid, class_name, category_uid = codes.CLASSES[event_class]
    return {
        "category_uid": F.lit(category_uid),
        "category_name": F.lit(codes.CATEGORIES[category_uid]),
        "class_uid": F.lit(class_uid),
        "class_name": F.lit(class_name),
    }


# -- network -----------------------------------------------------------------------


def is_private(address: Column) -> Column:
    """Whether an IPv4 address lies in 10/8, 172.16/12 or 192.168/16."""
    return (
        address.startswith("10.")
        | address.startswith("192.168.")
        | address.rlike(r"^172\.(1[6-9]|2[0-9]|3[01])\.")
    )


def direction_id(here: Column, there: Column, declared: Column | None = None) -> Column:
    """1 inbound, 2 outbound, 3 lateral, 0 unknown; a declared direction wins.

    ``here`` and ``there`` tell whether source and target are private; each is read
    once, so that the outcome of ``is_private`` needs no row of its own to hold it.
    """
    ends = F.coalesce(here.cast("int") * 2 + there.cast("int"), F.lit(0))
    return ends if declared is None else first_match([(declared == "ingress", 1), (declared == "egress", 2)], ends)


def direction_name(direction: Column) -> Column:
    return lookup(direction, codes.DIRECTION_NAMES, "Unknown")


def protocol_name(protocol_number: Column) -> Column:
    return lookup(protocol_number, codes.PROTOCOL_NAMES)


def protocol_number(name: Column, table: Mapping[str, int] = codes.TRANSPORT_NUMBERS) -> Column:
    return lookup(F.lower(name), table)


def flow_uid(*parts: Column) -> Column:
    """Stable id of a flow: SHA-256 over its parts, a missing part being empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


# -- DNS ---------------------------------------------------------------------------


def _rcode(code: Column, position: int) -> Column:
    ranges = [(code.between(low, high), name) for low, high, name in codes.DNS_RCODE_RANGES]
    return F.coalesce(lookup(code, column_of(codes.DNS_RCODES, position)), first_match(ranges), F.lit("Other"))


def dns_rcode_name(code: Column) -> Column:
    return _rcode(code, 0)


def dns_rcode_detail(code: Column) -> Column:
    return _rcode(code, 1)


def dns_status(code: Column) -> Column:
    return first_match([(code == 0, "Success"), (code.between(1, 65534), "Failure")], "Unknown")


def dns_status_id(code: Column) -> Column:
    return first_match([(code == 0, 1), (code.isNull(), 0)], 2)


def dns_answers(records: Column) -> Column:
    """Answer structs from a list of string maps; NULL when there is none."""
    answer = F.transform(
        records,
        lambda record: F.struct(
            record["class"].alias("class"),
            null_of("int").alias("packet_uid"),
            record["type"].alias("type"),
            null_of("array<int>").alias("flag_ids"),
            null_of("array<string>").alias("flags"),
            record["rdata"].alias("rdata"),
            record["ttl"].try_cast("int").alias("ttl"),
        ),
    )
    return F.when(F.size(records) > 0, answer)


# -- arrays of observables and enrichments -------------------------------------------


def _observable(name: str, kind: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), value.cast("string").alias("value"))


def observables(items: Iterable[tuple[str, str, Column]]) -> Column:
    """(name, type, value) structs, leaving out those without a value.

    Arrays of one or none are joined, as functions with a lambda are not compiled.
    """
    none = F.array().cast(f"array<{OBSERVABLE}>")
    made = (F.when(value.cast("string").isNotNull(), F.array(_observable(name, kind, value))).otherwise(none) for name, kind, value in items)
    return F.concat(*made)


def observables_of(name: str, kind: str, values: Column) -> Column:
    """One observable per non-null element of an array; never NULL."""
    present = F.filter(values, lambda v: v.isNotNull())
    made = F.transform(present, lambda v: _observable(name, kind, v))
    return F.coalesce(made, F.array().cast(f"array<{OBSERVABLE}>"))


def _enrichment(name: str, value: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        value.cast("string").alias("value"),
        null_of("variant").alias("data"),
        null_of("string").alias("desc"),
    )


def enrichments(items: Iterable[tuple[str, Column]], keep_null: bool = False) -> Column:
    made = F.array(*(_enrichment(*item) for item in items))
    return made if keep_null else F.filter(made, lambda x: x["value"].isNotNull())


def enrichments_of(name: str, values: Column) -> Column:
    """One enrichment per non-null element of an array; never NULL."""
    present = F.filter(values, lambda v: v.isNotNull())
    made = F.transform(present, lambda v: _enrichment(name, v))
    return F.coalesce(made, F.array().cast(f"array<{ENRICHMENT}>"))


# -- raw record, leftovers, metadata ---------------------------------------------------


def raw_record(payload: Column) -> Column:
    """The untouched record with its origin, as one variant object."""
    return F.to_variant_object(F.struct(payload.alias("payload"), F.col("source"), F.col("sourcetype")))


def unmapped(members: Mapping[str, Column] | Iterable[str]) -> Column:
    """Vendor fields without a place in the class, as one variant object."""
    if not isinstance(members, Mapping):
        members = {name: F.col(name) for name in members}
    return F.to_variant_object(F.struct(*(column.alias(name) for name, column in members.items())))


def metadata(
    product: str,
    vendor: str,
    provider: str,
    log_name: str,
    log_format: str,
    version: str = "1.0",
    **members: Column,
) -> dict[str, Column]:
    """The ``metadata`` struct as dotted fields."""
    fixed = {
        "version": "1.7.0",
        "product.name": product,
        "product.vendor_name": vendor,
        "log_provider": provider,
        "log_name": log_name,
        "log_format": log_format,
        "log_version": f"{provider}@{log_name}:version@{version}",
    }
    return {
        **{f"metadata.{name}": F.lit(value) for name, value in fixed.items()},
        **{f"metadata.{name}": column for name, column in members.items()},
    }


def user(prefix: str, uid: Column, name: Column, **members: Column) -> dict[str, Column]:
    """A user struct as dotted fields; type id 1 is a person."""
    return {
        f"{prefix}.uid": uid,
        f"{prefix}.name": name,
        **{f"{prefix}.{key}": column for key, column in members.items()},
        f"{prefix}.type_id": F.lit(1),
    }


# -- arrays of typed things, time, syslog text ------------------------------------------


def first_of_type(items: Column, kind: str) -> Column:
    """First struct whose ``type`` is ``kind``; NULL when there is none."""
    return F.get(F.filter(items, lambda item: item["type"] == kind), F.lit(0))


def epoch_time(seconds: Column) -> Column:
    return seconds.try_cast("timestamp")


def event_time(*seconds: Column) -> Column:
    """First usable epoch, else the time of processing."""
    return F.coalesce(*(epoch_time(s) for s in seconds), F.current_timestamp())


# The form of an IOS syslog line, its parts, and its time.
IOS_LINE = r"^(\d+):\s+(\w+\s+\d+\s+\d+\s+\d+:\d+:\d+):\s+%(\w+)-(\d+)-(\w+):\s(.+)$"
IOS_PARTS = ("seq_no", "timestamp", "facility", "severity", "mnemonic", "description")
IOS_TIME = r"(\w+\s+\d+\s+\d+\s+\d+:\d+:\d+)"
_BREAK = "\u0001"


def ios_parts(line: Column) -> Column:
    """The six parts of an IOS syslog line as an array; NULL when it is no such line.

    The first five parts are word characters, so the break sign can only reappear in
    the sixth, which the split limit keeps whole.
    """
    joined = F.regexp_replace(line, IOS_LINE, _BREAK.join(f"${i}" for i in range(1, 7)))
    return F.when(line.rlike(IOS_LINE), F.split(joined, _BREAK, 6))


def ios_part(line: Column, name: str) -> Column:
    """One part of an IOS syslog line alone; NULL when it is no such line."""
    return F.get(F.regexp_extract_all(line, F.lit(IOS_LINE), F.lit(IOS_PARTS.index(name) + 1)), F.lit(0))


def ios_time(line: Column) -> Column:
    """Time of an IOS line; a one-digit day is padded with a second blank."""
    found = F.regexp_extract(line, IOS_TIME, 1)
    return F.try_to_timestamp(F.regexp_replace(found, r"\s+", " "), F.lit("MMM d yyyy HH:mm:ss"))
