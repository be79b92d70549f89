"""URL filters: rules by host and path, and block decisions shared by redirect aliases. Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm.common import join_small, materialize
from pairwright.llm.components import components

# Query parameters that name a campaign or a referrer, not a page (fixed values, with their ``=``).
TRACKING = r"utm_[a-z]+|gclid|fbclid|msclkid|ref"
# Query parameters by which a page sends its reader on.
FORWARDING = r"url|u|redirect|redirect_uri|redirect_url|dest|destination|target"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The form in which equal addresses agree: no scheme, fragment, tracking parameter, final slash or ``.html``.

    Null without ``://``. This is what servers redirect between by habit; host and other parameters are kept.
    """
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"(?i)^({TRACKING})=")), "&")
    path = F.regexp_replace(path_of(url), r"(/index\.html?|\.html?|/)$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def absolute(link: Column, base: Column) -> Column:
    """A link as a whole address, seen from ``base``; null for an empty one."""
    scheme = F.regexp_extract(base, r"^(?s:(.*?))://", 1)
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    root = F.concat(scheme, F.lit("://"), host_of(base))
    return (F.when(F.coalesce(link, F.lit("")) == "", F.lit(None).cast("string"))
            .when(F.instr(link, "://") > 0, link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def link_targets(url: Column, html: Column) -> Column:
    """Addresses that a page declares to be the same: canonical link, og:url, meta refresh, forwarding parameter."""
    page = F.coalesce(html, F.lit(""))
    tags = F.regexp_extract_all(page, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1)
    marked = F.filter(tags, lambda t: t.rlike(r"(?i)\brel\s*=\s*[\"']?canonical\b|property\s*=\s*[\"']?og:url\b|http-equiv\s*=\s*[\"']?refresh\b"))
    links = F.transform(marked, lambda t: F.when(
        t.rlike(r"(?i)http-equiv\s*=\s*[\"']?refresh\b"), F.regexp_extract(t, r"(?i)\burl\s*=\s*['\"]?([^\s'\">]+)", 1)).otherwise(
        F.regexp_extract(t, r"(?i)\b(?:href|content)\s*=\s*[\"']?([^\s\"'>]+)", 1)))
    sent = F.try_url_decode(F.regexp_extract(url, rf"(?i)[?&](?:{FORWARDING})=(https?(?::|%3A)[^&#]+)", 1))
    return F.filter(F.array_append(F.transform(links, lambda x: absolute(x, url)), sent), lambda x: F.coalesce(x, F.lit("")) != "")


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules given as (verdict, host and path): rule, verdict, rule_host, rule_path."""
    rows = [(text, verdict, text.split("/", 1)[0], "/" + text.split("/", 1)[1] if "/" in text else "") for verdict, text in rules]
    return spark.createDataFrame(rows, "rule string, verdict string, rule_host string, rule_path string")


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, rules: for each distinct ``host``, the rules of the host and its parent domains, longest first.

    A host has few labels, so its suffixes are listed and looked up by an equi-join.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = hosts.select("host", F.explode(suffixes).alias("rule_host"))
    found = listed.join(rules, "rule_host").groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "verdict", "rule_path")).alias("rules"))
    return found.select("host", F.reverse(F.array_sort("rules")).alias("rules"))


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add rule and rule_verdict to rows with host and path: of the rules that fit, the longest (null without one)."""
    own = materialize(rules_of_hosts(urls.select("host").distinct(), rules), "host-rules")
    joined = join_small(urls, own, ["host"])
    fit = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), 0)
    return joined.select(*urls.columns, fit["rule"].alias("rule"), fit["verdict"].alias("rule_verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, decided_by for each row of ``pages``.

    A page's rule decides it. Pages without a rule take the verdict of their
    class of addresses: pages are joined by their canonical form, by the links
    they declare and by ``edges`` (src, dst: known redirects); in a class,
    an address with an allow rule clears it, else one with a block rule blocks
    it, else it is allowed. decided_by is rule, alias or default. A url that
    is null or has no ``://`` has no host, path or aliases. Repeated rows are
    judged alike; an empty table gives no rows.

    Components run over distinct addresses that have another one beside
    them, so copies of a page and single pages cost nothing there.
    """
    rows = materialize(pages.select(
        F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("_node"),
        F.array_distinct(F.filter(F.transform(link_targets(F.col(url), F.col(html)), lambda x: F.struct(canonical(x).alias("node"), host_of(x).alias("host"), path_of(x).alias("path"))),
                                  lambda x: x["node"].isNotNull())).alias("_links")), "urls")
    judged = materialize(with_rule(rows, rules), "judged-urls")
    pairs = judged.select(F.col("_node").alias("u"), F.explode("_links").alias("x")).select("u", F.col("x.node").alias("v"), F.col("x.host").alias("host"), F.col("x.path").alias("path"))
    if edges is not None:
        known = edges.select(F.col("src").cast("string").alias("s"), F.col("dst").cast("string").alias("d"))
        side = lambda a, b: known.select(canonical(F.col(a)).alias("u"), canonical(F.col(b)).alias("v"), host_of(F.col(b)).alias("host"), path_of(F.col(b)).alias("path"))
        pairs = pairs.unionByName(side("s", "d")).unionByName(side("d", "s"))
    pairs = materialize(pairs.filter("u IS NOT NULL AND v IS NOT NULL").distinct(), "alias-links")
    classes = materialize(components(pairs.select("u", "v")), "alias-classes")
    # What rules say of each address: of pages by their own host and path, of link targets by theirs.
    said = judged.filter("rule IS NOT NULL AND _node IS NOT NULL").select(F.col("_node").alias("node"), "rule_verdict")
    targets = with_rule(pairs.select(F.col("v").alias("node"), "host", "path"), rules).filter("rule IS NOT NULL").select("node", "rule_verdict")
    # One verdict for each address; then one for each class. allow < block, so the minimum is the verdict.
    of_nodes = said.unionByName(targets).groupBy("node").agg(F.min("rule_verdict").alias("shared"))
    roots = of_nodes.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_roots = roots.groupBy("root").agg(F.min("shared").alias("shared"))
    every = of_nodes.select("node").unionByName(classes.select("node")).distinct().join(classes, "node", "left")
    verdicts = materialize(every.select("node", F.coalesce("root", "node").alias("root")).join(of_roots, "root").select(F.col("node").alias("_node"), "shared"), "alias-verdicts")
    joined = join_small(judged, verdicts, ["_node"])
    verdict = F.coalesce("rule_verdict", "shared", F.lit("allow"))
    by = F.when(F.col("rule").isNotNull(), "rule").when(F.col("shared").isNotNull(), "alias").otherwise("default")
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), by.alias("decided_by"))
