"""URL expressions: parts, relative resolution, attachment names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edictum.functions.text import let

# scheme, authority, path, query, fragment (RFC 3986, appendix B)
_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = range(1, 6)
# Nothing to resolve and nothing to normalise: a lower-case scheme, an authority, no empty ? or #.
_ABSOLUTE = r"^[a-z][a-z0-9+.\-]*://[^?#]+(?:\?[^#]+)?(?:#.+)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, "(?s)" + _PARTS, group)


def url_host(url: Column) -> Column:
    """Authority part (host and port)."""
    return _part(url, _AUTHORITY)


def url_path(url: Column, root: bool = False) -> Column:
    """Path part; ``root=True`` turns an empty path into ``/``."""
    path = _part(url, _PATH)
    return F.when(path == "", F.lit("/")).otherwise(path) if root else path


def _remove_dot_segments(segments: Column) -> Column:
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)),
    )
    ends_open = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_open, F.array_append(folded, F.lit(""))).otherwise(folded)


def _merge_paths(base_path: Column, path: Column) -> Column:
    """Path of a reference that has one, seen from the base path."""
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    # Empty segments inside a merged path vanish; a rooted reference keeps its own.
    relative = let(
        F.split(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path), "/", -1),
        lambda segments: F.filter(
            segments, lambda s, i: (s != "") | (i == 0) | (i == F.size(segments) - 1)
        ),
    )
    segments = F.when(F.startswith(path, F.lit("/")), F.split(path, "/", -1)).otherwise(relative)
    joined = let(
        let(segments, _remove_dot_segments),
        lambda parts: F.array_join(parts, "/"),
    )
    return let(joined, lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)))


def _parts(url: Column) -> Column:
    return F.struct(*[_part(url, g).alias(f"p{g}") for g in range(1, 6)])


def _root(base: Column) -> Column:
    """Parts of a base, its scheme in lower case."""
    return F.struct(F.lower(_part(base, _SCHEME)).alias("p1"), *[_part(base, g).alias(f"p{g}") for g in range(2, 6)])


def _resolve(root: Column, href: Column) -> Column:
    """Resolution in full, for a reference that is not plainly absolute; ``root`` holds the parts of the base."""

    def build(own: Column) -> Column:
        scheme = F.when(own["p1"] == "", root["p1"]).otherwise(F.lower(own["p1"]))
        bare = (own["p3"] == "") & (own["p2"] == "")
        host = F.when(own["p2"] == "", root["p2"]).otherwise(own["p2"])
        path = (
            F.when(own["p2"] != "", own["p3"])
            .when(bare, root["p3"])
            .otherwise(_merge_paths(root["p3"], own["p3"]))
        )
        query = F.when(bare & (own["p4"] == ""), root["p4"]).otherwise(own["p4"])
        joined = F.concat(
            scheme,
            F.lit("://"),
            host,
            path,
            F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
            F.when(own["p5"] != "", F.concat(F.lit("#"), own["p5"])).otherwise(F.lit("")),
        )
        return F.when(scheme == root["p1"], joined).otherwise(href)

    return let(_parts(href), build)


def _reference(base: Column, href: Column, resolved) -> Column:
    """``href`` on the page ``base``; ``resolved`` gives the URL of one that is not plainly absolute."""
    clean = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return let(
        clean,
        lambda h: F.when(h.rlike(_ABSOLUTE) | (base == ""), h).when(h == "", base).otherwise(resolved(h)),
    )


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on the page ``base``.

    Blanks and controls before it and line breaks and tabs within do not count.
    """
    return let(base, lambda b: _reference(b, href, lambda h: let(_root(b), lambda root: _resolve(root, h))))


def resolve_urls(base: Column, hrefs: Column) -> Column:
    """The same for all of a page's references: the base is taken apart once."""
    known = F.struct(base.alias("url"), _root(base).alias("root"))
    return let(known, lambda b: F.transform(hrefs, lambda href: _reference(b["url"], href, lambda h: _resolve(b["root"], h))))


def attachment_name(url: Column) -> Column:
    """Display name: the URL-decoded last path segment, ``file`` if there is none."""
    last = F.element_at(F.split(url, "/", -1), -1)
    return F.coalesce(F.nullif(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), F.lit("")), F.lit("file"))
