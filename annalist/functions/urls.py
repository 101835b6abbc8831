"""URL expressions. A URL that cannot be parsed gives null, never an error."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def _let(value: Column, use) -> Column:
    """use(value) with value worked out once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scheme(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, _SCHEME, 1), F.lit("")))


def _authority(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def host(url: Column) -> Column:
    """Lower-case host without user and port; null where there is none."""
    bare = F.regexp_replace(F.regexp_replace(_authority(url), r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.nullif(bare, F.lit("")))


def port(url: Column) -> Column:
    """The port, or the scheme's usual one; null where it is no number up to 65535."""
    text = F.regexp_extract(_authority(url), r":([^:\]@]*)$", 1)
    usual = F.when(scheme(url) == "https", 443).when(scheme(url) == "http", 80)
    number = F.when(text.rlike(r"^[0-9]{1,5}\z"), text.cast("int"))
    return F.when(text == "", usual).when(number <= 65535, number)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def https_origin(url: Column) -> Column:
    """struct(scheme, host, port) of an https URL with a host and no user part, else null."""
    ok = (scheme(url) == "https") & host(url).isNotNull() & ~_authority(url).contains("@") & port(url).isNotNull()
    return F.when(ok, F.struct(scheme(url).alias("scheme"), host(url).alias("host"), port(url).alias("port")))


def same_origin(url: Column, base: str) -> Column:
    """Whether an https URL has the origin of base (false, not null, for anything else)."""
    return F.coalesce(https_origin(url) == https_origin(F.lit(base)), F.lit(False))


def without_dots(p: Column) -> Column:
    """A path without . and .. segments; a .. above the root is dropped, a last one of either leaves a folder."""
    step = lambda seen, x: F.when(x == "..", F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(1)))).when(x == ".", seen).otherwise(F.concat(seen, F.array(x)))
    walked = F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), step)
    last = F.when(p.rlike(r"(?:^|/)\.{1,2}$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return _let(F.array_join(F.concat(walked, last), "/"), lambda out: F.when(p.startswith("/") & ~out.startswith("/"), F.concat(F.lit("/"), out)).otherwise(out))


def resolve(url: Column, base: str) -> Column:
    """Absolute URLs as they are; //host, /path, ?query and relative paths against base, these two without . and .. segments."""
    page = re.match(r"[^?#]*", base)[0]
    root = (re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/]*", page) or [""])[0]
    folder = page[len(root) :].rpartition("/")[0] + "/"
    own, rest = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(url.rlike(_SCHEME), url)
        .when(url.startswith("//"), F.concat(F.lit(root.partition("//")[0]), url))
        .when(url.rlike(r"^[?#]") | (url == ""), F.concat(F.lit(page), url))
        .otherwise(F.concat(F.lit(root), without_dots(F.when(url.startswith("/"), own).otherwise(F.concat(F.lit(folder), own))), rest))
    )


def normalize(url: Column, base: str | None = None) -> Column:
    """Outer blanks off, resolved, scheme and authority in lower case, runs of / as one, no trailing / but that of the root, no query or fragment."""

    def tidy(whole: Column) -> Column:
        own = F.regexp_replace(F.regexp_replace(path(whole), "/{2,}", "/"), "(?<=.)/$", "")
        return F.concat(scheme(whole), F.lit("://"), F.lower(_authority(whole)), F.when(own == "", "/").otherwise(own))

    bare = F.regexp_replace(url, r"(?U)^\s+|\s+$", "")
    return _let(_let(bare, lambda u: resolve(u, base)), tidy) if base else _let(bare, tidy)


def canonical(url: Column, base: str | None = None) -> Column:
    """The page a URL stands for: normalized, without a .md ending of its path."""
    return F.regexp_replace(normalize(url, base), r"^([^/]*//[^/]*/.*)\.md$", "$1")


def source_id(url: Column, prefix: str = "docs") -> Column:
    """prefix:path of a canonical URL, prefix:index for the root."""
    own = F.regexp_replace(path(canonical(url)), "^/", "")
    return F.concat(F.lit(f"{prefix}:"), F.when(own == "", "index").otherwise(own))


def source_url(identity: Column, base: str) -> Column:
    """The URL of an identity made by source_id."""
    own = F.regexp_replace(identity, "^[^:]*:", "")
    return F.when(own == "index", base.rstrip("/")).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), own))


def label(url: Column) -> Column:
    """A URL fit for messages: scheme, host and path, without user, query and fragment."""
    return F.concat(F.coalesce(scheme(url), F.lit("")), F.lit("://"), F.coalesce(host(url), F.lit("")), path(url))


def exclusion_reason(url: Column, base: str, index: str | None = None) -> Column:
    """Why a link is not a page of base: non-https, external-host or discovery-index; null when it is one."""
    return (
        F.when(~same_origin(url, base), F.when(scheme(url).eqNullSafe(F.lit("https")), "external-host").otherwise("non-https"))
        .when(canonical(url) == F.lit(index or ""), "discovery-index")
    )


def next_page(link: Column, allowed: str) -> Column:
    """The rel="next" target of a Link header, if it starts with an allowed prefix; else null."""
    parts = F.split(link, r",\s*(?=<)")
    nexts = F.filter(parts, lambda p: p.rlike(r";\s*rel=\"?next\"?(?:\s|;|$)"))
    target = F.regexp_extract(F.get(nexts, F.lit(0)), r"^<([^>]*)>", 1)
    return F.when((F.size(nexts) > 0) & target.startswith(allowed), target)
