"""Field lists to output columns: literals, references and nested structs."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.plans.spec import NOT_SET, Expression, Field, SpecError

log = logging.getLogger(__name__)


def as_column(expression: Expression) -> Column:
    return expression if isinstance(expression, Column) else F.expr(expression)


def value_of(field: Field) -> Column:
    if field.expr is not None:
        return as_column(field.expr)
    if field.literal is not NOT_SET:
        return F.lit(field.literal)
    return F.expr(field.source)


def output_columns(field_list: Iterable[Field]) -> list[Column]:
    """Plain columns first, then one struct per dotted root in first-seen order.

    A field may read an earlier output by name (lateral column alias); when an input
    column has that name too, Spark takes the input column.
    """
    plain: dict[str, Column] = {}
    nested: dict[str, dict] = {}
    for field in field_list:
        head, _, rest = field.name.partition(".")
        if not rest:
            if head in plain:
                raise SpecError(f"field {head!r} is mapped twice")
            plain[head] = value_of(field)
        else:
            _place(nested.setdefault(head, {}), rest, field)
    clash = plain.keys() & nested.keys()
    if clash:
        raise SpecError(f"both a value and a struct: {sorted(clash)}")
    return [column.alias(name) for name, column in plain.items()] + [
        _struct(members).alias(name) for name, members in nested.items()
    ]


def _place(tree: dict, path: str, field: Field) -> None:
    head, _, rest = path.partition(".")
    if rest:
        branch = tree.setdefault(head, {})
        if not isinstance(branch, dict):
            raise SpecError(f"{field.name!r}: {head!r} is both a value and a struct")
        _place(branch, rest, field)
    elif head in tree:
        raise SpecError(f"{field.name!r} is mapped twice or is both a value and a struct")
    else:
        tree[head] = value_of(field)


def _struct(tree: dict) -> Column:
    return F.struct(
        *(
            (_struct(member) if isinstance(member, dict) else member).alias(name)
            for name, member in tree.items()
        )
    )


def captured_names(df: DataFrame, field_list: Iterable[Field]) -> list[str]:
    """Output names that a later field reads but that an input column shadows."""
    inputs = {name.lower() for name in df.columns}
    made: list[str] = []
    captured: list[str] = []
    for field in field_list:
        text = str(field.expr if field.expr is not None else field.source or "")
        words = {word.lower() for word in re.findall(r"[A-Za-z_]\w*", text)}
        captured += [n for n in made if n.lower() in inputs and n.lower() in words and n not in captured]
        if "." not in field.name and field.name.lower() not in {n.lower() for n in made}:
            made.append(field.name)
    return captured


def select_fields(df: DataFrame, field_list: Iterable[Field], keep: Iterable[str] = ()) -> DataFrame:
    """``keep`` columns followed by the mapped fields; a repeated output name raises."""
    field_list, keep = list(field_list), list(keep)
    roots = list(dict.fromkeys(f.name.partition(".")[0] for f in field_list))
    repeated = {name.lower() for name in keep} & {name.lower() for name in roots}
    if repeated:
        raise SpecError(f"output columns repeat a carried column: {sorted(repeated)}")
    for name in captured_names(df, field_list):
        log.info("field %r shares its name with an input column; the input column is read", name)
    return df.select(*(quoted(name) for name in keep), *output_columns(field_list))


def quoted(name: str) -> Column:
    """Reference to a top-level column whose name may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")
