"""URL filters with redirect equivalence.

A rule (``host/path``) fits its host and all subdomains where the url's path starts with
the rule's path; the longest fitting rule decides. Urls that no rule fits follow their
aliases: redirect (``meta refresh``) and canonical-link targets in the page (relative ones
resolved against the page's url or its ``base``), and the url without scheme, tracking parameters and fragment, are edges of a graph; a block of any
member reaches the whole connected component, unless a member is explicitly allowed.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and
no aliases (verdict allow); null html has no links; repeated pages and urls are judged each
for itself, with the same verdict; self-links and links to unknown pages do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import checkpointed, fresh
from encore.llm.components import components

# The rules of the query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)"
#: Targets of links that name the same page.
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*[0-9.]*\s*[;,]?\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _A, _Z), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null. The rules become one
    CASE expression, tried from the longest; they are a short list given by the caller."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = (host == F.lit(name)) | F.endswith(host, F.lit(f".{name}"))
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits & F.startswith(path, F.lit(slash + rest)), hit).otherwise(out)
    return out


def alias_key(url: Column) -> Column:
    """The url as aliases share it: lower-case host without ``www.``, path without a final
    slash, query without tracking parameters; no scheme, no fragment. Null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    bare = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), r"/+$", ""))
    return F.when(F.contains(url, F.lit("://")), F.concat(bare, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    up = lambda done: F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
    step = lambda done, x: F.when(x == ".", done).when(x == "..", up(done)).otherwise(F.concat(done, F.array(x)))
    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value as a lambda's argument: the plan holds it once, however
    often ``use`` names it. Written out, nested ones multiply to megabytes of plan on the driver."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _target(link: Column, url: Column) -> Column:
    """Absolute form of a link found on ``url``. A scheme counts at the start of the link only;
    null for schemes without a host (``mailto:``)."""

    def joined(link: Column, url: Column) -> Column:
        origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
        folder = F.regexp_extract(F.concat(F.lit("/"), path_of(url)), r"(?s)^/(.*/|)", 1)
        return (
            F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
            .when(F.startswith(link, F.lit("?")), F.concat(origin, path_of(url), link))
            .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_replace(url, "(?s)#.*", ""), link))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
        )

    def plain(whole: Column) -> Column:
        return F.concat(F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1), _without_dots(path_of(whole)), F.regexp_extract(whole, r"(?s)^[^?#]*(.*)$", 1))

    return _bound(F.regexp_replace(link, "&amp;", "&"), lambda to: _bound(url, lambda on: _bound(joined(to, on), plain)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct edges (``a``, ``b``) between a page's alias key and the keys of the pages that
    it redirects to or names as canonical. Only pages with such a link yield rows."""
    links = F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(REFRESH), F.lit(1)))
    # The markers are looked for first: the patterns run on pages that have one.
    marked = pages.where(F.contains(F.lower(html), F.lit("canonical")) | F.contains(F.lower(html), F.lit("http-equiv")))
    base = _bound(F.regexp_extract(html, BASE, 1), lambda base: F.when(base != "", _target(base, F.col(url))))
    found = marked.select(F.col(url).alias("url"), F.coalesce(base, F.col(url)).alias("base"), F.explode(links).alias("link"))
    return (
        found.select(alias_key(F.col("url")).alias("a"), _bound(_target(F.col("link"), F.col("base")), alias_key).alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """The pages (all columns but ``html``) with ``host``, ``path``, ``rule``, ``verdict`` and
    ``component`` (the smallest alias key of the page's component; null without ``://``).

    Shuffles: the edges (pages with links only), and one partial aggregate of decisions per
    component, joined back by component. A component may hold a third of all pages: its
    decisions are counted map-side and read back from the checkpoint folder, so that both sides
    of the join come from exchanges and adaptive execution can split the component's pages.
    """
    packed = fresh(pages, "_page")
    rest = [c for c in pages.columns if c != html]
    base = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias(packed),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), alias_key(F.col(url)).alias("key"),
    )
    base = base.withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    comps = components(alias_edges(pages, url, html))
    # Keys without links are their own component, so only linked ones need the join.
    base = base.join(comps.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    decided = (
        base.where("own is not null and component is not null")
        .groupBy("component")
        .agg(F.max(F.col("own.verdict") == "allow").alias("allowed"), F.max(F.col("own.verdict") == "block").alias("blocked"))
    )
    # An aggregate below the join would already be dealt by component, with no exchange to split.
    decided = checkpointed(decided)
    spread = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    out = base.join(decided, "component", "left")
    names = {"host", "path", "rule", "verdict", "component"}
    return out.select(
        *[F.col(packed).getField(c).alias(c) for c in rest if c not in names],
        "host", "path", F.col("own.rule").alias("rule"), F.coalesce(F.col("own.verdict"), spread).alias("verdict"), "component",
    )
