"""URL filter with redirect equivalence.

Explicit rules decide a URL by host and path. Every other URL takes the decision of its
aliases: URLs joined by redirect and canonical-link edges form components, found by
distributed connected components. A component with an explicitly allowed URL is allowed,
else one with a blocked URL is blocked, else the default holds.

Edges of a page: its first canonical link, its first meta refresh target, and the redirect
every site is taken to make to a URL's plain form (https, no fragment, no tracking
parameters, no trailing slash, `index.html` or `.html`). Links in comments, scripts and
styles are none. A link's character references are decoded, its fragment goes, and it is
resolved against the page's `base` or URL, with `.` and `..` taken out of its path. URLs that
are no page of the table count too.

Defined cases: a null URL or one without `://` has empty host and path, no aliases and the
default verdict; null markup has no edges; repeated rows give repeated results; an empty
table gives an empty result; an empty rule list leaves everything at the default.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harkline.llm.components import connected_components
from harkline.session import written


class Rule(NamedTuple):
    """A rule fits its host, all subdomains of it, and paths that start with its path."""

    action: str  # allow or block
    host: str
    path: str


ALLOW, BLOCK = "allow", "block"

#: Query parameters that tell where a visitor came from, not what the page is.
TRACKING = r"utm_[a-z]+|ref|gclid|fbclid"

#: Markup that holds no links of the page.
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</(script|style)\s*>|\z)"
#: A quoted or bare value.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
_CANONICAL = r"""(?is)\srel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical[\s/>])"""
_REFRESH = r"""(?is)\shttp-equiv\s*=\s*["']?refresh\b"""
_REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'>]*)"""
#: Character references decoded in links, `&` last.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&#38;": "&", "&#x26;": "&", "&amp;": "&"}


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    """What stands after the first `://`; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def plain_form(url: Column) -> Column:
    """The URL that all spellings of a URL lead to; null without `://`."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)?", 1)
    query = F.regexp_replace(query, rf"([?&])(?:{TRACKING})=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(query, "&&+", "&"), r"\?&", "?")
    query = F.regexp_replace(query, "[?&]$", "")
    path = F.regexp_replace(path_of(url), r"(/index\.html?|\.html?|/)$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(F.lit("https://"), host_of(url), path, query))


def _tag(html: Column, name: str, fits: str | None = None) -> Column:
    """The first tag of that name, of those that fit; null without one."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)(<{name}\b[^>]*>)"), F.lit(1))
    return F.get(F.filter(tags, lambda t: t.rlike(fits)) if fits else tags, F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, character references decoded; empty without one."""
    pattern = rf"(?is)\s{name}{_VALUE}"
    return _decoded(F.concat(*[F.regexp_extract(F.coalesce(tag, F.lit("")), pattern, k) for k in (1, 2, 3)]))


def _decoded(value: Column) -> Column:
    for reference, character in _REFERENCES.items():
        value = F.replace(value, F.lit(reference), F.lit(character))
    return F.trim(value)


def _without_dots(path: Column) -> Column:
    """A path without its `.` and `..` segments."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    # the first part is what stands before the first slash, and stays
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    open_end = path.rlike(r"/\.\.?$")
    return F.concat(F.array_join(kept, "/"), F.when(open_end, F.lit("/")).otherwise(F.lit("")))


def resolved(link: Column, base: Column) -> Column:
    """A link as a whole URL without fragment; null for an empty link, one of another kind, or a base without `://`."""
    link, base = F.regexp_extract(link, "^[^#]*", 0), F.regexp_extract(base, "^[^#]*", 0)
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(_after_scheme(base), r"^[^/?#]*", 0))
    path = F.regexp_extract(link, r"^[^?]*", 0)
    query = F.regexp_extract(link, r"\?.*$", 0)
    folder = F.regexp_extract(path_of(base), r"^(.*/)?", 0)
    whole = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    return (
        F.when((link == "") | (F.instr(base, "://") == 0), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(F.instr(link, "://") > 0, link))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("?"), F.concat(site, path_of(base), link))
        .otherwise(F.concat(site, _without_dots(F.when(link.startswith("/"), path).otherwise(whole)), query))
    )


def rule_of(url: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits; null if none does. Allow wins a tie."""
    host, path = host_of(url), path_of(url)
    name = action = None
    for rule in sorted(rules, key=lambda r: (-len(r.host + r.path), r.action)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)) if name is None else name.when(fits, F.lit(rule.host + rule.path))
        action = F.when(fits, F.lit(rule.action)) if action is None else action.when(fits, F.lit(rule.action))
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, action)


def judge(pages: DataFrame, rules: list[Rule], default: str = ALLOW) -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict` and `by` (rule, alias or default) of every page."""
    url = F.col("url").cast("string")
    def node(text: Column) -> Column:
        """128 bits: among 10^11 URLs one hash of 64 would join some hundred that are not the same."""
        both = [F.lpad(F.hex(F.xxhash64(*x)), 16, "0") for x in ((text,), (F.lit(1), text))]
        return F.when(F.instr(text, "://") > 0, F.concat(*both))

    # a step for each thing that the next one uses more than once
    markup = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), _NO_MARKUP, " ")
    tags = pages.select("page_id", url.alias("url"), markup.alias("markup")).select(
        "page_id", "url", _attribute(_tag(F.col("markup"), "base"), "href").alias("base"),
        _attribute(_tag(F.col("markup"), "link", _CANONICAL), "href").alias("canonical"),
        _attribute(_tag(F.col("markup"), "meta", _REFRESH), "content").alias("refresh"),
    )
    url = F.col("url")
    based = tags.select("page_id", "url", F.coalesce(resolved(F.col("base"), url), url).alias("base"), "canonical", "refresh")
    refresh = F.trim(F.regexp_extract("refresh", _REFRESH_URL, 1))
    linked = based.select(
        "page_id", "url",
        F.array(plain_form(url), resolved(F.col("canonical"), F.col("base")), resolved(refresh, F.col("base"))).alias("links"),
    )
    rule, action = rule_of(url, rules)
    ends = F.transform("links", lambda t: F.struct(node(t).alias("node"), rule_of(t, rules)[1].alias("action")))
    parsed = linked.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), rule.alias("rule"), action.alias("action"),
        node(url).alias("node"), F.filter(ends, lambda e: e["node"].isNotNull()).alias("ends"),
    )
    parsed = written(parsed, "url-pages")
    edges = parsed.select("node", F.explode("ends").alias("end"))
    roots = connected_components(edges.select(F.col("node").alias("a"), F.col("end.node").alias("b")), "url-links")

    acted = (
        parsed.select("node", "action").unionAll(edges.select("end.node", "end.action"))
        .where("action is not null").distinct()
    )
    decided = (
        acted.join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.when(F.max(F.col("action") == ALLOW), ALLOW).otherwise(BLOCK).alias("inherited"))
    )
    rooted = parsed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    judged = rooted.join(decided, "root", "left")
    by = F.when(F.col("action").isNotNull(), "rule").when(F.col("inherited").isNotNull(), "alias").otherwise("default")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("action", "inherited", F.lit(default)).alias("verdict"), by.alias("by")
    )
