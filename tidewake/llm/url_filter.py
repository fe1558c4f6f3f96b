"""URL verdicts by rules, spread over redirect and canonical-link aliases. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.llm import common as C

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"

#: (host, path, verdict)
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; '' without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """What makes two URLs the same page: host, path and query; null without ://."""
    return F.when(url.contains("://"), F.concat(host_of(url), path_of(url), F.regexp_extract(url, _URL, 3)))


def matched(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(out)
    return out


def matched_by_table(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """For rule tables of any size: adds the struct ``m`` by an equi-join on the suffixes of the host.

    pages: key, host, path; rules: host, path, verdict.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), "verdict")
    hits = pages.select("key", "path", F.explode(suffixes).alias("suffix")).join(r, "suffix").where(F.startswith(F.col("path"), F.col("rule_path")))
    best = hits.groupBy("key").agg(F.max_by(F.struct(F.concat("suffix", "rule_path").alias("rule"), "verdict"), F.length(F.concat("suffix", "rule_path"))).alias("m"))
    return pages.join(best, "key", "left")


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def without_dots(path: Column) -> Column:
    """A path from its leading / on, without . and .. segments."""
    parts = F.split(path, "/")
    walked = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array(F.lit("")),
        lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(x))),
    )
    joined = F.array_join(walked, "/")
    return F.when(F.element_at(parts, -1).isin(".", "..") | (joined == ""), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolved(url: Column, target: Column) -> Column:
    """The address that a link's target names on the page ``url``; null for the page itself and for schemes without ://."""
    split = r"(?s)^([^?#]*)(.*)$"
    rooted = F.regexp_extract(target, split, 1)
    base = F.regexp_replace(path_of(url), "[^/]*$", "")
    merged = F.when(rooted.startswith("/"), rooted).otherwise(F.concat(F.when(base == "", "/").otherwise(base), rooted))
    site = F.concat(F.lit("http://"), host_of(url))
    return (
        F.when(target.rlike(_SCHEME + "//"), target)
        .when(target.rlike(_SCHEME) | target.startswith("#"), None)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("?"), F.concat(site, path_of(url), target))
        .otherwise(F.concat(site, without_dots(merged), F.regexp_extract(target, split, 2)))
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """(url, target): the canonical links and refresh redirects of each page, relative targets resolved against its url."""
    inside = lambda tag, value: F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda x: F.regexp_extract(x, value, 1))
    canonical = inside(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    refresh = inside(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)")
    out = pages.where("url is not null and html is not null and contains(url, '://')").select("url", F.explode(F.array_distinct(F.concat(canonical, refresh))).alias("target")).where("target <> ''")
    return out.select("url", resolved(F.col("url"), F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))).alias("target")).where("target is not null")


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, links: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, component: allow or block for every page row.

    A page's own rule decides. Without one, its alias component decides: pages joined by redirects and canonical
    links (``links``: url, target; taken from the html unless given). If any URL of the component is explicitly
    allowed the component is allowed; else if any is blocked it is blocked. All else is allowed. A null url, or one
    without ://, has an empty host and path, no rule and no aliases. Repeated rows give repeated results.
    """
    rules = RULES if rules is None else rules
    links = alias_links(pages) if links is None else links
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    judged = judged.withColumn("m", matched(F.col("host"), F.col("path"), rules))
    edges = C.written(links.select(F.col("url").alias("a"), F.col("target").alias("b")).distinct(), "links")
    ends = edges.select(F.col("a").alias("url")).union(edges.select("b")).where(url.contains("://")).distinct()
    named = edges.select(node_of(F.col("a")).alias("src"), node_of(F.col("b")).alias("dst"))
    parts = C.connected_components(named)
    own = ends.select(node_of(url).alias("node"), matched(host_of(url), path_of(url), rules)["verdict"].alias("v"))
    says = own.join(parts, "node").groupBy("component").agg(F.bool_or(F.col("v") == "allow").alias("allowed"), F.bool_or(F.col("v") == "block").alias("blocked"))
    spread = parts.join(says, "component").select("node", "component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("spread"))
    out = judged.join(spread, "node", "left")
    return out.select("page_id", "host", "path", F.col("m.rule").alias("rule"), F.coalesce("m.verdict", "spread", F.lit("allow")).alias("verdict"), "component")
