"""Operator 5: URL rules, and block decisions carried over to redirect and canonical-link aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slumptrace.llm.common import Staging, ascii_lower, components

# The rules of the query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as ``struct(verdict, rule)``; null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def canonical_form(url: Column) -> Column:
    """The address that usual server redirects lead to: no scheme, ``www.`` or ``m.``, no default page suffix, final
    slash, fragment or tracking parameter."""
    path = F.regexp_replace(path_of(url), r"(/index)?\.html?$|/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_\w+|ref|fbclid|gclid)=")))
    return F.concat(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), path,
                    F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def page_edges(pages: DataFrame, forms: bool = True) -> DataFrame:
    """Alias edges ``(from_url, to_url)``: declared canonical links, refresh redirects, and a URL's canonical form.

    Relative targets are resolved against the host when they begin with ``/``; other relative ones are no edge. Pages
    whose URL is null or has no ``://`` have no edge, whatever they declare. Canonical forms (:func:`canonical_form`)
    are a rule of this operator: URLs of one form are taken to redirect to it, though no page says so. Without
    ``forms`` only what pages declare counts.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    link = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    targets = F.array(
        F.regexp_extract(link, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1),
        F.regexp_extract(refresh, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    absolute = F.transform(targets, lambda t: F.when(
        t.startswith("/") & ~t.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*", 0), t)).otherwise(t))
    declared = pages.select(url.alias("from_url"), F.explode(absolute).alias("to_url")).where(
        "from_url like '%://%' and to_url like '%://%'")
    if not forms:
        return declared.where("from_url <> to_url").distinct()
    usual = pages.select(url.alias("from_url"), canonical_form(url).alias("to_url")).where("from_url like '%://%'")
    both = declared.union(declared.select("to_url", canonical_form(F.col("to_url")))).union(usual)
    return both.where("from_url <> to_url").distinct()


def judge(
    pages: DataFrame, edges: DataFrame, staging: Staging | None = None, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """Judge every page: ``page_id, host, path, rule, verdict, component``.

    URLs are nodes. A page with a rule of its own keeps that verdict. Others take their component's: allow if any
    alias is explicitly allowed, else block if any is blocked, else allow. Components are found over 64-bit hashes
    of distinct URLs. Null and malformed URLs have no rule and no alias and are allowed; repeated rows are judged
    alike; an empty table gives no rows.
    """
    spark = pages.sparkSession
    staging = staging or Staging(spark, "aliases")
    url = F.coalesce("url", F.lit(""))
    links = edges.select(F.xxhash64("from_url").alias("src"), F.xxhash64("to_url").alias("dst"))
    groups = staging.keep(components(links, staging), "groups")
    # A page without a URL is no node, whatever edges say and whichever canonical form it looks like.
    node = F.when(url.contains("://"), F.xxhash64(url))
    judged = pages.select("page_id", node.alias("node"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("hit", matching_rule(F.col("host"), F.col("path"), rules))
    # One row for each distinct URL, so that a URL on many pages counts once.
    named = judged.groupBy("node").agg(F.max("hit.verdict").alias("own"))
    ends = edges.select(F.explode(F.array("from_url", "to_url")).alias("u")).distinct()
    ends = ends.select(F.xxhash64("u").alias("node"), matching_rule(host_of(F.col("u")), path_of(F.col("u")), rules)["verdict"].alias("own"))
    owners = named.union(ends).groupBy("node").agg(F.max("own").alias("own")).where("own is not null")
    decided = staging.keep(
        groups.join(owners, "node").groupBy("component").agg(
            F.when(F.max((F.col("own") == "allow").cast("int")) == 1, "allow").otherwise("block").alias("given")), "decided")
    placed = staging.keep(groups.join(decided, "component", "left"), "placed")
    return judged.join(placed, "node", "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", "given", F.lit("allow")).alias("verdict"), "component")
