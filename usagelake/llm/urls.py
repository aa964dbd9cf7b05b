"""URL filters over redirect equivalence: block decisions reach all aliases of a page, explicit allows come first.

Only DataFrame functions. Aliases are joined by the links that a page declares (canonical link, refresh redirect), by
further redirects the caller knows, and by spelling (scheme, case of the host, fragment, tracking parameters, a slash
at the end). Components are found over the declared links alone, between spellings' common forms, so pages without
links cost one aggregation.

Verdict: the longest rule that fits the url itself; without one, allow if an alias is explicitly allowed, else block if
an alias is blocked, else allow.

Defined results: a null url, or one without ://, has an empty host and path, no rule and no aliases, and is allowed.
Null or empty html declares nothing. Repeated rows are judged alike; a null page_id stays. An empty table gives an
empty result. Columns other than page_id, url and html are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch
from usagelake.llm.components import components

#: (verdict, host, path): fits the host and its subdomains where the url's path begins with the path.
Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters that don't change what a page shows.
TRACKING = r"(?i)(?<=[?&])(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&#]*&?"


def _rest(url: Column) -> Column:
    """What follows the first ://, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = _rest(url)
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def common_form(url: Column) -> Column:
    """Host, path without a slash at the end, and the query without tracking parameters; null without ://."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), r"[?&]$", "")
    return F.when(_rest(url).isNotNull(), F.concat(host_of(url), F.regexp_replace(path_of(url), r"/+$", ""), query))


def rule_of(url: Column, rules: Sequence[Rule]) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, or null; of equal lengths the last in order of text."""
    host, path = host_of(url), path_of(url)
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in rules
    ]
    none = F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(none, *fits))


def declared_links(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and refresh redirects in `pages` (url, html); relative targets are resolved."""
    html = F.col("html")
    canonical = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b[^>]*>"), F.lit(0)),
        lambda tag: F.regexp_extract(tag, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    refresh = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0)),
        lambda tag: F.regexp_extract(tag, r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    found = pages.select("url", F.explode(F.concat(canonical, refresh)).alias("to")).where("to <> '' AND url IS NOT NULL")
    origin = F.regexp_extract("url", r"^[^/?#]*://[^/?#]*", 0)
    scheme = F.regexp_extract("url", r"^([^/?#]*:)//", 1)
    folder = F.regexp_extract("url", r"^[^/?#]*://[^?#]*/", 0)
    target = (
        F.when(F.col("to").contains("://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(origin, F.col("to")))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(origin), folder).otherwise(F.concat(origin, F.lit("/"))), F.col("to")))
    )
    return found.select("url", target.alias("target"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict. `redirects` has more links (url, target)."""
    scratch = Scratch(pages.sparkSession, "urls")
    links = declared_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = scratch.store(links, "links")
    edges = links.select(common_form(F.col("url")).alias("a"), common_form(F.col("target")).alias("b"))
    aliases = components(edges, scratch).select(F.col("id").alias("alias"), "component")
    url = F.col("url")
    known = pages.select("url").union(links.select("url")).union(links.select("target")).select(
        common_form(url).alias("form"), rule_of(url, rules)["verdict"].alias("own")).where("own IS NOT NULL")
    by_form = known.groupBy("form").agg(F.max(F.col("own") == "allow").alias("allows"), F.max(F.col("own") == "block").alias("blocks"))
    in_class = by_form.join(aliases, F.col("form") == F.col("alias"), "left").select(
        F.coalesce("component", "form").alias("class"), "allows", "blocks")
    classes = in_class.groupBy("class").agg(F.max("allows").alias("allows"), F.max("blocks").alias("blocks"))
    classes = scratch.store(classes, "classes")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), rule_of(url, rules).alias("own"),
                        common_form(url).alias("form"))
    placed = rows.join(aliases, F.col("form") == F.col("alias"), "left").withColumn("its", F.coalesce("component", "form"))
    judged = placed.join(classes, F.col("its") == F.col("class"), "left")
    inherited = F.when(F.coalesce("allows", F.lit(False)), "allow").when(F.coalesce("blocks", F.lit(False)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", inherited).alias("verdict"))
