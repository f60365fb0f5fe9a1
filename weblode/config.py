"""Plan inputs: site configuration and decision model, read once on the driver and validated."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# The keys a site's configuration must have.
SITE_KEYS = (
    "seed",
    "permitted_urls_rules",
    "denied_urls_rules",
    "render_html",
    "keep_parameters",
    "keep_parameters_for_indexing",
    "page_counter",
    "start_page_counter_from",
    "equal_crawled_features",
    "decision_model",
    "allArray",
    "csv_fields",
    "features",
)

# The text that stands for a missing value in saved records.
MISSING = "N/A"


class ConfigError(ValueError):
    """A configuration that cannot be turned into a plan."""


def _need(raw: Mapping, key: str, where: str):
    if key not in raw:
        raise ConfigError(f"{where}: key {key!r} is missing")
    return raw[key]


@dataclass(frozen=True)
class Anchor:
    """A neighbouring element that marks the wanted one."""

    tag: str = ""
    css_class: str = ""
    property_value: str = ""
    content: tuple[str, ...] = ()
    index: int = 1

    @classmethod
    def parse(cls, raw: Mapping | None) -> Anchor | None:
        """None if nothing is to be looked for."""
        if not raw or not any(raw.get("content") or ()):
            return None
        return cls(
            raw.get("tag") or "",
            raw.get("cssClass") or "",
            raw.get("propertyValue") or "",
            tuple(c for c in raw["content"] if c),
            int(raw.get("index") or 1),
        )

    @property
    def steps(self) -> int:
        return max(self.index - 2, 0)


@dataclass(frozen=True)
class Feature:
    name: str
    tag: str = ""
    css_class: str = ""
    property_value: str = ""
    metadata_format: str = ""
    html_allowed: bool = False
    static_value: str = ""
    datatype: str = ""
    expected_values: Mapping[str, str] = field(default_factory=dict)
    extraction_patterns: tuple[str, ...] = ()
    removal_patterns: tuple[str, ...] = ()
    infix: Anchor | None = None
    prefix: Anchor | None = None
    postfix: Anchor | None = None

    @classmethod
    def parse(cls, name: str, raw: Mapping) -> Feature:
        where = f"feature {name!r}"
        if raw.get("staticValue"):
            return cls(name, static_value=str(raw["staticValue"]))
        keywords = raw.get("searchKeywords") or {}
        return cls(
            name,
            _need(raw, "tag", where) or "",
            _need(raw, "cssClass", where) or "",
            raw.get("propertyValue") or "",
            raw.get("metadataFormat") or "",
            bool(raw.get("htmlAllowed")),
            "",
            raw.get("datatype") or "",
            dict(raw.get("expectedValues") or {}),
            tuple(raw.get("extraction_patterns") or ()),
            tuple(raw.get("removal_patterns") or ()),
            Anchor.parse(keywords.get("infix")),
            Anchor.parse(keywords.get("prefix")),
            Anchor.parse(keywords.get("postfix")),
        )

    @property
    def reads_json(self) -> bool:
        return self.metadata_format == "json" and bool(self.property_value)

    @property
    def anchors(self) -> tuple[Anchor, ...]:
        return tuple(a for a in (self.infix, self.prefix, self.postfix) if a)


@dataclass(frozen=True)
class Site:
    name: str
    seed: str
    permitted: tuple[str, ...]
    denied: tuple[str, ...]
    keep_parameters: bool
    keep_parameters_for_indexing: bool
    page_counter: tuple[str, ...]
    start_counter: int
    identity: tuple[str, ...]
    decision_model: str
    all_array: bool
    csv_fields: tuple[str, ...]
    features: tuple[Feature, ...]

    @classmethod
    def parse(cls, name: str, raw: Mapping) -> Site:
        values = {key: _need(raw, key, f"site {name!r}") for key in SITE_KEYS}
        features = tuple(Feature.parse(n, f) for n, f in values["features"].items())
        identity = tuple(values["equal_crawled_features"])
        known = {"url", *(f.name for f in features)}
        if not identity:
            raise ConfigError(f"site {name!r}: equal_crawled_features is empty")
        for column in (*identity, *values["csv_fields"]):
            if column not in known:
                raise ConfigError(f"site {name!r}: {column!r} is not a feature")
        return cls(
            name,
            values["seed"],
            tuple(values["permitted_urls_rules"]),
            tuple(values["denied_urls_rules"]),
            bool(values["keep_parameters"]),
            bool(values["keep_parameters_for_indexing"]),
            tuple(values["page_counter"]),
            int(values["start_page_counter_from"]),
            identity,
            values["decision_model"],
            bool(values["allArray"]),
            tuple(values["csv_fields"]),
            features,
        )


@dataclass(frozen=True)
class ModelFeature:
    name: str
    datatype: str
    schema_type: str
    default: str | None = None
    derived: bool = False
    operation: str = ""
    format: str = ""
    lookup: object = None

    @classmethod
    def parse(cls, name: str, raw: Mapping) -> ModelFeature:
        where = f"model feature {name!r}"
        mapping = _need(raw, "schemaMapping", where)
        script = mapping.get("mappingScript") or {}
        return cls(
            name,
            _need(_need(raw, "scoreCalculation", where), "datatype", where),
            _need(mapping, "schemaDataType", where),
            mapping.get("defaultValue"),
            bool(mapping.get("isDrived")),
            script.get("operation") or "",
            script.get("format") or "",
            script.get("lookup"),
        )


@dataclass(frozen=True)
class DecisionModel:
    name: str
    features: tuple[ModelFeature, ...]

    @classmethod
    def parse(cls, name: str, raw: Mapping) -> DecisionModel:
        return cls(name, tuple(ModelFeature.parse(n, f) for n, f in raw.items()))


def read_json(spark: SparkSession, path: str) -> dict:
    """A small configuration file, from any file system Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_site(spark: SparkSession, path: str, name: str) -> Site:
    return Site.parse(name, _need(read_json(spark, path), name, path))


def load_model(spark: SparkSession, path: str, name: str) -> DecisionModel:
    return DecisionModel.parse(name, _need(read_json(spark, path), name, path))
