"""URL parts and link resolution as native column expressions.

Spark's parse_url raises on a malformed URL, and links found in the wild are often
malformed, so the generic RFC 3986 pattern is used instead: it matches every string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3986 appendix B with a checked scheme.
# Groups: 1 scheme, 2 "//netloc", 3 netloc, 4 path, 5 query.
URL = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
# Link prefixes that never lead to a page, characters that are no part of a
# URL, and the path pattern of pages worth saving.
SKIPPED_PREFIXES = ("#", "javascript:", "mailto:", "tel:")
URL_JUNK = r"^[\x00-\x20]+|[\t\r\n]+"
DEFAULT_PATH_PATTERN = r"^/\w+/\d+/\S+/?$"


def _clean(url: Column) -> Column:
    """Without leading blanks and control characters and without any tab or line break."""
    return F.regexp_replace(url, URL_JUNK, "")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL, group)


def url_scheme(url: Column) -> Column:
    return F.lower(_part(_clean(url), 1))


def url_netloc(url: Column) -> Column:
    """Host with case, port and user info kept."""
    return _part(_clean(url), 3)


def url_path(url: Column) -> Column:
    """Path without the `;parameters` of its last segment."""
    return F.regexp_replace(_part(_clean(url), 4), r"(?s);[^/]*\z", "")


def url_defrag(url: Column) -> Column:
    """Everything before the first '#'. Slash, query, scheme and case stay significant."""
    return F.substring_index(url, "#", 1)


# What a slug leaves out, and the slug of the root.
NOT_IN_SLUG, EMPTY_SLUG = "[^a-z0-9]+", "index"


def href_followable(href: Column) -> Column:
    """False for in-page anchors and script, mail and phone links. Case-sensitive."""
    keep = F.lit(True)
    for prefix in SKIPPED_PREFIXES:
        keep = keep & ~F.startswith(href, F.lit(prefix))
    return keep


def path_matches(url: Column, pattern: str = DEFAULT_PATH_PATTERN) -> Column:
    """The URL's path matches `pattern` from its first character on.

    (?U) gives the character classes their Unicode meaning and (?d) leaves the line feed
    as the only line end, so `$` and `.` keep the meaning the pattern's author expects.
    """
    return url_path(url).rlike(f"(?Ud)^(?:{pattern})")


def url_slug(url: Column) -> Column:
    """Lower-case path with every run outside [a-z0-9] as one '-'; 'index' if nothing is left."""
    path = F.lower(F.trim(url_path(url), F.lit("/")))
    slug = F.regexp_replace(path, NOT_IN_SLUG, "-")
    return F.when(slug == "", F.lit(EMPTY_SLUG)).otherwise(slug)


def _fold_dots(path: Column) -> Column:
    """Apply '.' and '..' segments."""
    folded = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, seg: F.when(
            seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    ends_in_dots = path.rlike(r"(?:^|/)\.\.?\z")
    joined = F.array_join(
        F.when(ends_in_dots, F.concat(folded, F.array(F.lit("")))).otherwise(folded), "/"
    )
    return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(
        F.concat(F.lit("/"), joined)
    )


def _absolute_path(path: Column) -> Column:
    # Only a path that holds "/." can have dot segments; the fold is skipped for the rest.
    return F.when(F.contains(path, F.lit("/.")), _fold_dots(path)).otherwise(path)


def _after(text: Column, mark: str) -> Column:
    """From the first `mark` on, '' if there is none or nothing follows it."""
    at = F.instr(text, mark)
    return F.when((at > 0) & (at < F.length(text)), F.substr(text, at)).otherwise(F.lit(""))


def base_parts(url: Column) -> Column:
    """The parts of a page's URL that its links are resolved against. Compute it once per
    page, ahead of a loop over its links."""
    url = _clean(url)
    query = _part(url, 5)
    folder = F.regexp_extract(_part(url, 4), r"(?s)^(.*/)?[^/]*\z", 1)
    return F.struct(
        url_defrag(url).alias("url"),
        url_scheme(url).alias("scheme"),
        F.concat(url_scheme(url), F.lit("://"), url_netloc(url)).alias("site"),
        F.when(folder == "", F.lit("/")).otherwise(folder).alias("folder"),
        _part(url, 4).alias("path"),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)).alias("query"),
    )


def resolve_against(base: Column, href: Column) -> Column:
    """Absolute URL, without fragment, of `href` on a page with `base_parts` `base`.

    Null when the host has an unpaired bracket. A link with a scheme of its own is
    returned as it is.
    """
    return _resolve(base, href, _clean(href))


def resolve_all(base: Column, hrefs: Column) -> Column:
    """`resolve_against` over the list of a page's links, each cleaned once."""
    both = F.transform(hrefs, lambda h: F.struct(h.alias("raw"), _clean(h).alias("clean")))
    return F.transform(both, lambda h: _resolve(base, h["raw"], h["clean"]))


def _resolve(base: Column, raw: Column, href: Column) -> Column:
    # Branches are ordered by how common they are: a rooted link, by far the most frequent
    # kind, is resolved without pattern matching.
    target = url_defrag(href)
    path, query = F.substring_index(target, "?", 1), _after(target, "?")
    scheme, authority, netloc = _part(href, 1), _part(href, 2), _part(href, 3)
    rooted = F.startswith(href, F.lit("/")) & ~F.startswith(href, F.lit("//"))
    foreign = (scheme != "") & (F.lower(scheme) != base["scheme"])
    broken = F.contains(netloc, F.lit("[")) != F.contains(netloc, F.lit("]"))
    local = _part(href, 4)
    relative = F.regexp_replace(F.concat(base["folder"], local), "/{2,}", "/")
    return (
        F.when(raw == "", base["url"])
        .when(rooted, F.concat(base["site"], _absolute_path(path), query))
        .when((authority != "") & broken, F.lit(None).cast("string"))
        .when(foreign, url_defrag(raw))
        .when(netloc != "", F.concat(base["scheme"], F.lit(":"), authority, local, query))
        .when((local == "") & (query == ""), F.concat(base["site"], base["path"], base["query"]))
        .when(local == "", F.concat(base["site"], base["path"], query))
        .when(F.startswith(local, F.lit("/")), F.concat(base["site"], _absolute_path(local), query))
        .otherwise(F.concat(base["site"], _absolute_path(relative), query))
    )


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of `href` as found on the page with the absolute URL `base`."""
    return resolve_against(base_parts(base), href)
