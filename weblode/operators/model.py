"""Mapping of saved records to a typed decision model, compiled to one projection."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.config import MISSING, DecisionModel, ModelFeature
from weblode.functions.core import MOST_BRANCHES, first_of
from weblode.functions.dictionary import first_key
from weblode.functions.text import digits_only
from weblode.operators.records import scalar

# The Spark type of each index type; others are kept as text.
INDEX_TYPES = {
    "text": "string",
    "keyword": "string",
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "date": "date",
    "boolean": "boolean",
}


def present(value: Column) -> Column:
    """NULL for the text that stands for a missing value."""
    return F.when(value.cast("string") != MISSING, value)


def or_default(value: Column, default: str | None) -> Column:
    return value if default is None else F.coalesce(value, F.lit(default).cast("string"))


def canonical_key(value: Column, lookup: Mapping[str, object]) -> Column:
    """First lookup key contained in the value, NULL if there is none."""
    if len(lookup) > MOST_BRANCHES:
        return first_key(value, {key: key for key in lookup}, None)
    return first_of((value.contains(key), key) for key in lookup)


def enumeration(value: Column, lookup: Mapping[str, object], default: str | None) -> Column:
    """What the first contained key stands for, else the default."""
    if len(lookup) > MOST_BRANCHES and all(t is None or isinstance(t, str) for t in lookup.values()):
        return first_key(value, lookup, default)
    texts = {k: t if t is None or isinstance(t, str) else F.lit(t).cast("string") for k, t in lookup.items()}
    return first_of(((value.contains(key), target) for key, target in texts.items()), default)


def whole_number(value: Column) -> Column:
    """The digits read as one integer; sign and decimal point are lost."""
    return digits_only(value).try_cast("bigint")


def amount(value: Column) -> Column:
    """The digits read as one number; sign and decimal point are lost."""
    return digits_only(value).try_cast("double")


def value_list(values: list[Column]) -> Column:
    """The values before the first missing one."""
    held = F.array(*[v.cast("string") for v in values])
    gap = F.array_position(F.transform(held, lambda v: v.isNull()), True)
    return F.slice(held, F.lit(1), F.when(gap > 0, gap - 1).otherwise(F.size(held)).cast("int"))


def comparison(rules: list[Mapping], value_of) -> Column:
    """Texts of the rules in order: the one for true or for false; a missing field gives none."""
    texts = []
    for rule in rules:
        if rule["op"] != "gte":
            continue
        field = value_of(rule["field"]).try_cast("bigint")
        texts.append(
            F.when(field >= F.lit(rule["value"]), F.lit(rule["trueBody"])).when(
                field < F.lit(rule["value"]), F.lit(rule["falseBody"])
            )
        )
    return F.trim(F.concat_ws(" ", *texts))


def typed_projection(records: DataFrame, model: DecisionModel) -> list[Column]:
    """One column per model feature, in the model's order.

    An enumerated feature replaces the raw value by its key for the features after it.
    """
    current: dict[str, Column] = {}

    def value_of(name: str) -> Column:
        if name not in current:
            current[name] = present(scalar(records, name))
        return current[name]

    out = []
    for feature in model.features:
        if feature.datatype == "artificial":
            continue
        value = _derived(feature, value_of) if feature.derived else _mapped(feature, value_of)
        if feature.datatype == "enumeration" and not feature.derived:
            raw = value_of(feature.name).cast("string")
            current[feature.name] = F.coalesce(canonical_key(raw, feature.lookup), raw)
        if feature.operation == "mapping" and feature.derived:
            out.append(value.alias(feature.name))
        elif feature.schema_type != "artificial":
            kind = INDEX_TYPES.get(feature.schema_type, "string")
            out.append(value.try_cast(kind).alias(feature.name))
    return out


def _mapped(feature: ModelFeature, value_of) -> Column:
    value = value_of(feature.name)
    if feature.datatype == "enumeration":
        return enumeration(value.cast("string"), feature.lookup, feature.default)
    if feature.datatype == "int":
        return or_default(whole_number(value).cast("string"), feature.default)
    if feature.datatype == "currency":
        return or_default(amount(value).cast("string"), feature.default)
    return or_default(value.cast("string"), feature.default)


def _derived(feature: ModelFeature, value_of) -> Column:
    lookup = json.loads(feature.lookup) if isinstance(feature.lookup, str) else feature.lookup
    if feature.operation == "mapping" and feature.format == "list":
        return value_list([value_of(name) for name in lookup])
    if feature.operation == "comparison" and feature.schema_type == "text":
        return comparison(lookup, value_of)
    return F.lit(None).cast("string")


def to_model(records: DataFrame, model: DecisionModel, key: str = "url") -> DataFrame:
    """Records as the model wants them, with the id they are indexed by."""
    columns = typed_projection(records, model)
    named = {f.name for f in model.features}
    own_key = [] if key in named else [scalar(records, key).alias(key)]
    return records.select(*own_key, *columns)
