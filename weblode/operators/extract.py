"""Feature extraction: which element of a page a feature is read from, and how."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.config import Anchor, Feature
from weblode.functions import dom, values
from weblode.functions.core import any_contains, blank_to_null, let

# The column with what JSON features read from each element, and a feature's place in it.
JsonRead = tuple[Column, int]


def has_body(nodes: Column) -> Column:
    return F.exists(nodes, lambda n: n["tag"] == "body")


def titles(nodes: Column) -> Column:
    """Text of every title element, in document order."""
    return F.transform(dom.elements(nodes, "title"), lambda t: dom.raw_text(nodes, t))


def elements_table(pages: DataFrame, selectors: Sequence[tuple[str, str | None]], *keys: str) -> DataFrame:
    """One row per element that a (tag, class) selector picks: selector, position, text, attributes."""

    def shaped(tag, css_class):
        return F.transform(
            dom.elements(F.col("nodes"), tag, css_class),
            lambda e: F.struct(
                F.lit(f"{tag}.{css_class}" if css_class else tag).alias("selector"),
                e["pos"].alias("pos"),
                dom.text_of(F.col("nodes"), e).alias("text"),
                e["attrs"].alias("attrs"),
            ),
        )

    found = F.concat(*[shaped(*s) for s in selectors])
    return pages.select(*keys, F.explode(found).alias("e")).select(*keys, "e.*")


def single_value(nodes: Column, element: Column, property_value: str) -> Column:
    """Attribute of the element if one is named (NULL if it lacks it), else its text."""
    if property_value:
        # The attribute is text of its own: markup in it goes, as it goes from an element.
        return dom.strip_tags(element["attrs"][property_value])
    return dom.text_of(nodes, element)


def anchor_holds(html: Column, found: Column, anchor: Anchor) -> tuple[Column, Column]:
    """Whether the anchor found is the wanted one: by attribute, and by content.

    With a property the attribute must equal, or else contain, one of the contents;
    without one the anchor's source must contain it.
    """
    if anchor.property_value:
        probe = found["attrs"][anchor.property_value]
        return F.coalesce(probe.isin(*anchor.content), F.lit(False)), any_contains(probe, anchor.content)
    return F.lit(False), any_contains(dom.markup_of(html, found), anchor.content)


def anchored(
    html: Column,
    nodes: Column,
    element: Column,
    candidates: Column,
    anchor: Anchor,
    side: str,
    feature: Feature,
    type_value: Callable[[Column], Column],
) -> Column:
    """The value an anchor on one side of the element gives, NULL if it is not there."""
    find = {"infix": dom.inside, "prefix": dom.before, "postfix": dom.after}[side]
    steps = {"infix": 0, "prefix": -anchor.steps, "postfix": anchor.steps}[side]

    def value(target):
        def decide(found):
            by_attribute, by_content = anchor_holds(html, found, anchor)
            plain = dom.markup_of(html, target) if feature.html_allowed else type_value(dom.text_of(nodes, target))
            if feature.property_value and anchor.property_value:
                named = type_value(target["attrs"][feature.property_value])
                return F.when(by_attribute, named).when(by_content, plain)
            return F.when(by_attribute | by_content, plain)

        return let(find(candidates, target), decide)

    return let(dom.moved(nodes, element, steps), value) if steps else value(element)


def json_paths_of(features: Sequence[Feature]) -> dict[tuple[str, str | None], list[str]]:
    """The JSON paths that features read, by the elements they read them from."""
    paths: dict[tuple[str, str | None], list[str]] = {}
    for f in features:
        if f.reads_json and not f.static_value:
            among = paths.setdefault((f.tag, f.css_class), [])
            if f.property_value not in among:
                among.append(f.property_value)
    return paths


def with_json(parsed: DataFrame, features: Sequence[Feature]) -> tuple[DataFrame, Callable[[Feature], JsonRead | None]]:
    """Pages with what all JSON features read, each element parsed once; and where a feature finds its value."""
    paths = json_paths_of(features)
    names = {selector: f"page_json_{i}" for i, selector in enumerate(paths)}
    html, nodes = F.col("html"), F.col("nodes")
    read = [
        dom.json_values(html, dom.elements(nodes, *selector), among).alias(names[selector]) for selector, among in paths.items()
    ]

    def place(feature):
        selector = (feature.tag, feature.css_class)
        if not feature.reads_json or feature.static_value:
            return None
        return F.col(names[selector]), paths[selector].index(feature.property_value)

    return parsed.select("*", *read), place


def feature_text(
    feature: Feature, html: Column, nodes: Column, countries: Sequence[tuple[str, str]] = (), json: JsonRead | None = None
) -> Column:
    """The typed text of a feature on one page.

    Exactly one matching element is used directly. Otherwise every element is tried in document
    order, on each one embedded JSON, then infix, prefix and postfix anchors; the first value that
    is not empty wins. A feature read from JSON is tried that way for any number of elements; ``json``
    tells where ``with_json`` has read it, without it the elements are parsed for this feature alone.
    """

    def type_value(text):
        # Typing may look at the text many times; it is extracted once.
        return let(
            text,
            lambda t: values.typed(
                t, feature.datatype, feature.expected_values, feature.extraction_patterns, countries
            ),
        )

    def first_of_many(found, sides):
        def tries(element, json_text=None):
            options = [] if json_text is None else [type_value(json_text)]
            for side, anchor, candidates in sides:
                options.append(
                    anchored(html, nodes, element, candidates, anchor, side, feature, type_value)
                )
            return F.coalesce(*[blank_to_null(o) for o in options])

        # Once there is a value, no further element is tried.
        nothing = F.lit(None).cast("string")
        if not feature.reads_json:
            return F.aggregate(found, nothing, lambda value, element: F.coalesce(value, tries(element)))
        read, at = json or (dom.json_values(html, found, [feature.property_value]), 0)
        if not sides:
            return F.aggregate(read, nothing, lambda value, r: F.coalesce(value, tries(None, F.get(r, F.lit(at)))))
        pairs = F.zip_with(found, read, lambda e, r: F.struct(e.alias("element"), F.get(r, F.lit(at)).alias("json")))
        return F.aggregate(pairs, nothing, lambda value, p: F.coalesce(value, tries(p["element"], p["json"])))

    def with_candidates(found, pending, bound):
        if not pending:
            return first_of_many(found, bound)
        side, anchor = pending[0]
        return let(
            dom.elements(nodes, anchor.tag, anchor.css_class),
            lambda c: with_candidates(found, pending[1:], [*bound, (side, anchor, c)]),
        )

    sides = [(s, a) for s in ("infix", "prefix", "postfix") if (a := getattr(feature, s))]
    no_value = F.lit(None).cast("string")

    def chosen(found):
        many = with_candidates(found, sides, []) if sides or feature.reads_json else no_value
        if feature.reads_json:
            return many

        def only(element):
            if feature.html_allowed:
                return dom.markup_of(html, element)
            return type_value(single_value(nodes, element, feature.property_value))

        one = let(F.get(found, F.lit(0)), only)
        return F.when(F.size(found) == 1, one).otherwise(many)

    if feature.reads_json and json and not sides:
        return first_of_many(None, [])
    return let(dom.elements(nodes, feature.tag, feature.css_class), chosen)


def feature_value(
    feature: Feature, html: Column, nodes: Column, countries=(), as_array: bool = False, json: JsonRead | None = None
) -> Column:
    """Everything that is done to one feature of one page."""
    if feature.static_value:
        return F.lit(feature.static_value)
    return values.finished(
        feature_text(feature, html, nodes, countries, json),
        feature.datatype,
        feature.removal_patterns,
        feature.extraction_patterns,
        as_array,
    )


def needed_nodes(features: Sequence[Feature]) -> tuple[set[str] | None, set[str]]:
    """Element names the features look at, and those whose text they read; None for all nodes."""
    live = [f for f in features if not f.static_value]
    tags = {f.tag for f in live} | {a.tag for f in live for a in f.anchors}
    if "" in tags or any(a.steps for f in live for a in f.anchors):
        return None, set()
    return tags | {"body"}, {f.tag for f in live}
