"""URL expressions: validity, parameter removal, relative resolution, clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblode.functions.core import let

# RFC 3986 appendix B with the scheme restricted to its legal characters.
SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
SPLIT = rf"(?s)^(?:({SCHEME}):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# Group 2 is the authority; group 3 the path without the parameters of its last segment.
BASE = rf"(?s)^(?:({SCHEME}):)?(?://([^/?#]*))?((?:[^?#]*/)?[^?#;/]*).*$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, rf"^({SCHEME}):", 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, rf"^(?:{SCHEME}:)?//([^/?#]*)", 1)


def is_valid(url: Column) -> Column:
    """Scheme and authority are both present."""
    return url.rlike(rf"^{SCHEME}://[^/?#]")


def strip_parameters(url: Column) -> Column:
    """``scheme://authority/path``: path parameters, query and fragment are dropped."""
    return F.concat(scheme(url), F.regexp_replace(url, BASE, "://$2$3"))


def clean_entities(url: Column) -> Column:
    """Remove what a doubly escaped ``&amp;`` leaves behind."""
    return F.replace(url, F.lit("amp;"), F.lit(""))


def counter_url(template: Column, counter: Column) -> Column:
    return F.replace(template, F.lit("{counter}"), counter.cast("string"))


def _parts(url: Column) -> Column:
    def group(i):
        return F.regexp_extract(url, SPLIT, i)

    return F.struct(
        F.lower(group(1)).alias("scheme"),
        group(2).alias("netloc"),
        group(3).alias("path"),
        group(4).alias("query"),
        group(5).alias("fragment"),
    )


def _merge_paths(base_path: Column, path: Column) -> Column:
    """Resolve ``path`` against ``base_path`` and remove its dot segments."""
    rooted = path.startswith("/")
    folder = F.regexp_extract(base_path, r"(?s)^(.*/)?", 0)
    joined = F.when(rooted, path).otherwise(
        # Empty inner segments vanish when two paths are merged.
        F.regexp_replace(F.concat(F.lit("/"), folder, path), "/{2,}", "/")
    )

    def step(kept, segment):
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    def resolved(segments):
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        ends_in_dot = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.when(ends_in_dot, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    return F.when(~F.contains(joined, F.lit("/.")), joined).otherwise(
        F.regexp_replace(let(F.split(joined, "/"), resolved), "^/*", "/")
    )


def resolve(href: Column, base: Column) -> Column:
    """The absolute form of ``href`` as found on the page at ``base``."""
    ref = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def general(r):
        return let(_parts(base), lambda b: let(_parts(r), lambda p: _resolve_parts(p, b)))

    def chosen(r):
        # Root-relative links are the common case and need no path arithmetic.
        plain = r.rlike("^/[^/]") & ~F.contains(r, F.lit("/.")) & ~r.rlike("[?#]")
        return F.when(plain, F.concat(scheme(base), F.lit("://"), netloc(base), r)).otherwise(general(r))

    return let(ref, chosen)


def _resolve_parts(p: Column, b: Column) -> Column:
    own_scheme = F.when(p["scheme"] == "", b["scheme"]).otherwise(p["scheme"])
    foreign = own_scheme != b["scheme"]
    no_path = p["path"] == ""
    path = (
        F.when(foreign | (p["netloc"] != ""), p["path"])
        .when(no_path, b["path"])
        .otherwise(_merge_paths(b["path"], p["path"]))
    )
    query = F.when(no_path & (p["netloc"] == "") & ~foreign & (p["query"] == ""), b["query"]).otherwise(p["query"])
    authority = F.when(foreign | (p["netloc"] != ""), p["netloc"]).otherwise(b["netloc"])
    return F.concat(
        own_scheme,
        F.lit(":"),
        F.when(authority != "", F.concat(F.lit("//"), authority)).otherwise(F.lit("")),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(p["fragment"] != "", F.concat(F.lit("#"), p["fragment"])).otherwise(F.lit("")),
    )
