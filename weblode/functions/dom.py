"""Document nodes as an array column, and the expressions that read it.

A page stays one row: its nodes are an array in document order, so selection, neighbour search and
text are all row-local and need no shuffle. ``explode_nodes`` gives the flat node table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.functions import html_nodes
from weblode.functions.core import let

cloudpickle.register_pickle_by_value(html_nodes)


def dom_nodes(html: Column, tags: Iterable[str] | None = None, text_tags: Iterable[str] = ()) -> Column:
    """The page's nodes. With ``tags`` only those elements are written out, and text only inside
    ``text_tags``; positions are those of the whole document either way."""
    keep = None if tags is None else frozenset(tags) | frozenset(text_tags)
    keep_text = None if tags is None else frozenset(text_tags)

    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return html_nodes.read_batches(batches, keep, keep_text)

    # Declared non-deterministic so that no filter or projection makes Spark parse a page twice.
    reader = F.arrow_udf(read, f"array<{html_nodes.NODE_DDL}>").asNondeterministic()
    return reader(html)


def with_nodes(pages: DataFrame, tags=None, text_tags=(), html: str = "html") -> DataFrame:
    return pages.select("*", dom_nodes(F.col(html), tags, text_tags).alias("nodes"))


def explode_nodes(pages: DataFrame, *keys: str) -> DataFrame:
    """One row per node: position, extent, kind, tag, classes, attributes, text."""
    n = pages.select(*keys, F.explode("nodes").alias("n"))
    return n.select(
        *keys,
        "n.pos",
        "n.end_pos",
        "n.kind",
        "n.tag",
        F.when(F.col("n.class_attr") != "", F.split("n.class_attr", " "))
        .otherwise(F.array().cast("array<string>"))
        .alias("classes"),
        "n.attrs",
        "n.text",
        "n.start",
        "n.stop",
    )


def matches(node: Column, tag: str, css_class: str | None) -> Column:
    """Element of that name whose class list holds the class, or equals it as a whole.

    An empty name stands for any element, an empty class for elements that have none,
    and None for any class.
    """
    found = node["kind"] == "element"
    if tag:
        found = found & (node["tag"] == tag)
    if css_class is None:
        return found
    if css_class == "":
        return found & (F.coalesce(node["class_attr"], F.lit("")) == "")
    return found & (
        (node["class_attr"] == css_class) | F.array_contains(F.split(node["class_attr"], " "), css_class)
    )


def elements(nodes: Column, tag: str, css_class: str | None = None) -> Column:
    return F.filter(nodes, lambda n: matches(n, tag, css_class))


def raw_text(nodes: Column, node: Column) -> Column:
    """All text inside the node; script and style text only if the node is such an element."""
    opaque = F.coalesce(node["tag"].isin(*sorted(html_nodes.OPAQUE)), F.lit(False))
    inside = F.slice(nodes, node["ix"] + 1, node["last"] - node["ix"])
    texts = F.filter(inside, lambda n: (n["kind"] == "text") | (opaque & (n["kind"] == "raw")))
    joined = F.array_join(F.transform(texts, lambda n: n["text"]), "")
    return F.when(node["kind"] == "element", joined).otherwise(node["text"])


def text_of(nodes: Column, node: Column) -> Column:
    """Text with empty lines removed."""
    return F.regexp_replace(F.regexp_replace(raw_text(nodes, node), r"\n+", "\n"), r"^\n|\n\z", "")


def strip_tags(value: Column) -> Column:
    """Text without markup and empty lines, for values that are not nodes."""
    bare = F.regexp_replace(value, r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\n+", "\n"), r"^\n|\n\z", "")


def markup_of(html: Column, node: Column) -> Column:
    """The node's source."""
    return F.substring(html, node["start"] + 1, node["stop"] - node["start"])


def count_before(candidates: Column, ix: Column) -> Column:
    """How many candidates stand before a place; they are in document order, so halving finds it."""

    def halve(range_, _):
        low, high = range_["low"], range_["high"]
        middle = F.shiftright(low + high, 1)
        earlier = F.get(candidates, middle)["ix"] < ix
        return F.struct(
            F.when((low < high) & earlier, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & ~earlier, middle).otherwise(high).alias("high"),
        )

    size = F.size(candidates)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), size.alias("high"))
    return F.when(size > 0, F.aggregate(steps, start, halve, lambda range_: range_["low"])).otherwise(F.lit(0))


def before(candidates: Column, node: Column) -> Column:
    """Nearest earlier candidate; an enclosing element counts as earlier."""
    return F.get(candidates, count_before(candidates, node["ix"]) - 1)


def after(candidates: Column, node: Column) -> Column:
    """Nearest later candidate; an enclosed element counts as later."""
    return F.get(candidates, count_before(candidates, node["ix"] + 1))


def inside(candidates: Column, node: Column) -> Column:
    """First candidate within the node."""
    return let(after(candidates, node), lambda c: F.when(c["ix"] <= node["last"], c))


def moved(nodes: Column, node: Column, steps: int) -> Column:
    """The node so many places later (earlier if negative); NULL off the document."""
    return F.get(nodes, node["ix"] - 1 + F.lit(steps)) if steps else node


def embedded_json(html: Column, node: Column) -> Column:
    """The node's source with every tag turned into a space, parsed; NULL if it is not JSON."""
    return F.try_parse_json(F.regexp_replace(markup_of(html, node), r"<[^\n]*?>", " "))


def json_paths(document: Column, paths: Sequence[str]) -> Column:
    """What dotted paths lead to, as an array in their order; segments that are absent are skipped, NULL if none is present.

    The paths are walked as one tree: a step that several of them begin with is taken once.
    """
    order = []

    def follow(current, hit, depth, among):
        """The values of the paths that have come this far together; those that end here come first."""
        ended = [i for i in among if len(segments[i]) == depth]
        order.extend(ended)
        value = F.when(hit, F.try_variant_get(current, "$", "string"))
        found = [F.array(*[value] * len(ended))] if ended else []
        steps = {}
        for i in among:
            if len(segments[i]) > depth:
                steps.setdefault(segments[i][depth], []).append(i)
        found.extend(taken(current, hit, depth, segment, onward) for segment, onward in steps.items())
        return F.concat(*found) if len(found) > 1 else found[0]

    def taken(current, hit, depth, segment, onward):
        def state(step):
            return F.struct(F.coalesce(step, current).alias("at"), (hit | step.isNotNull()).alias("hit"))

        step = F.try_variant_get(current, f"$['{segment}']", "variant")
        return let(let(step, state), lambda s: follow(s["at"], s["hit"], depth + 1, onward))

    segments = [path.split(".") for path in paths]
    values = let(document, lambda d: follow(d, F.lit(False), 0, range(len(segments))))
    if order == sorted(order):
        return values
    return let(values, lambda v: F.array(*[F.get(v, F.lit(order.index(i))) for i in range(len(segments))]))


def json_path(document: Column, path: str) -> Column:
    """What one dotted path leads to."""
    return F.get(json_paths(document, [path]), F.lit(0))


def json_values(html: Column, found: Column, paths: Sequence[str]) -> Column:
    """For each element an array of what the paths lead to in its JSON, parsed once."""
    return F.transform(found, lambda element: json_paths(embedded_json(html, element), paths))
