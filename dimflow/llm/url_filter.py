"""URL filter: block and allow rules, carried to aliases over redirect and canonical-link edges.

A rule fits a host and its subdomains, if the path starts with the rule's; the longest
rule wins, allow before block at equal length. Urls are nodes of a graph; edges join a
url with its redirect target, with the canonical link or the refresh target its page
names, and with its own plain form (no fragment, no tracking parameters, no closing
slash). Connected components of that graph are computed as distributed joins. A url
without a rule takes the verdict of its component: allow if any member is explicitly
allowed, else block if any is blocked, else allow. A url's own rule always decides.

Defined results: a null url, or one without "://", has an empty host and path, no rule
and no aliases, and is allowed. A relative target is resolved against its page, or the
base that it names; a null or empty one, or one of another kind than a page, makes no
edge, and what stands in a comment names nothing. Repeated rows are judged alike. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.components import connected_components
from dimflow.session import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that don't change what a url shows.
TRACKING = r"utm_[a-z]+|fbclid|gclid"


def _rest(url: Column) -> Column:
    """What follows the first "://", or null."""
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _query(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)


def node(url: Column) -> Column:
    """A url without scheme and fragment, its host in lower case; null if it is no absolute url."""
    return F.when(_rest(url).isNotNull(), F.concat(host(url), path(url), _query(url)))


def plain(url: Column) -> Column:
    """The node of a url's plain form."""
    kept = F.regexp_replace(_query(url), rf"(?<=[?&])(?:{TRACKING})=[^&]*(?:&|$)", "")
    kept = F.regexp_replace(kept, r"[?&]$", "")
    trimmed = F.regexp_replace(path(url), r"(?<=.)/$", "")
    return F.when(_rest(url).isNotNull(), F.concat(host(url), trimmed, kept))


def _flat(at: Column) -> Column:
    """A path without . and .. segments."""
    steps = F.split(at, "/")
    up = F.element_at(steps, -1).isin(".", "..")

    def walk(kept: Column, step: Column) -> Column:
        back = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))  # the part before the first slash stays
        return F.when(step == ".", kept).when(step == "..", back).otherwise(F.array_append(kept, step))

    kept = F.aggregate(steps, F.array().cast("array<string>"), walk)
    flat = F.concat(F.array_join(kept, "/"), F.when(up, "/").otherwise(""))
    return F.when(at.rlike(r"(^|/)\.\.?(/|$)"), flat).otherwise(at)


def _resolved(page: Column, target: Column) -> Column:
    """An absolute url for a target found on a page; null for one of another kind, such as mailto:."""
    target = F.replace(F.trim(target), F.lit("&amp;"), F.lit("&"))
    scheme = F.substring_index(page, "://", 1)
    site = F.concat(scheme, F.lit("://"), host(page))
    folder = F.regexp_replace(path(page), "[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    own, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"[?#].*$", 0)
    return (
        F.when(F.coalesce(target, F.lit("")) == "", F.lit(None).cast("string"))
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, _flat(own), rest))
        .when(target.startswith("#"), F.concat(F.regexp_extract(page, "^[^#]*", 0), target))
        .when(target.startswith("?"), F.concat(site, path(page), target))
        .otherwise(F.concat(site, _flat(F.concat(folder, own)), rest))
    )


def _attribute(tag: Column, name: str) -> Column:
    quoted = rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, quoted, k) for k in (1, 2, 3)])


def page_targets(pages: DataFrame) -> DataFrame:
    """`url`, `target`: what a page names as its canonical link or refreshes to, resolved against its base."""
    rows = pages.select("url", F.regexp_replace("html", r"(?s)<!--.*?(?:-->|$)", "").alias("html"))
    base = F.regexp_extract("html", r"(?is)<base\b[^>]*\bhref\b[^>]*>", 0)
    link = F.regexp_extract("html", r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract("html", r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    rows = rows.select("url", _attribute(base, "href").alias("base"), link.alias("link"), refresh.alias("refresh"))
    moved = F.regexp_extract(_attribute(F.col("refresh"), "content"), r"(?is)\burl\s*=\s*[\"']?([^\"']*)", 1)
    # Each explode ends an expression: put into one another, they would grow beyond all bounds.
    named = F.array(_attribute(F.col("link"), "href"), moved)
    rows = rows.select("url", F.explode(F.transform(named, lambda x: F.struct(F.col("base").alias("base"), x.alias("named")))).alias("x"))
    rows = rows.select("url", "x.base", "x.named").filter("named <> ''")
    base = F.coalesce(_resolved(F.col("url"), F.col("base")), F.col("url"))
    rows = rows.select("url", "named", F.explode(F.array(base)).alias("page"))
    return rows.select("url", F.explode(F.array(_resolved(F.col("page"), F.col("named")))).alias("target")).filter("target is not null")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """`host`, `path`, `rule`, `rule_verdict` of the distinct pairs of host and path in `urls` that a rule fits."""
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.concat("host", "path").alias("rule"),
        (F.col("verdict") == "allow").alias("allow"),
    )
    keys = urls.select("host", "path").filter("host <> ''").distinct()
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    keys = keys.withColumn("rule_host", F.explode(suffixes))
    fits = keys.join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "allow", "rule")).alias("best"))
    return best.select(
        "host", "path", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("rule_verdict")
    )


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """`a`, `b`: nodes that show the same page."""
    own = pages.select(node(F.col("url")).alias("a"), plain(F.col("url")).alias("b"))
    named = page_targets(pages)
    edges = own.union(named.select(node(F.col("url")), node(F.col("target"))))
    edges = edges.union(named.select(node(F.col("target")), plain(F.col("target"))))
    if redirects is not None:
        edges = edges.union(redirects.select(node(F.col("source")), node(F.col("target"))))
    return edges.filter("a <> b").distinct()


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """`page_id`, `url`, `host`, `path`, `rule`, `verdict` and `alias` (whether the verdict came from an alias)."""
    edges = stage_table(alias_edges(pages, redirects), "aliases")
    seed = 0
    while True:  # nodes are numbered by hash; should two share one, by another
        ids = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ids = stage_table(ids.withColumn("id", F.xxhash64("node", F.lit(seed))), "nodes")
        if ids.groupBy("id").count().filter("count > 1").isEmpty():
            break
        seed += 1
    numbered = edges.select(F.xxhash64("a", F.lit(seed)).alias("a"), F.xxhash64("b", F.lit(seed)).alias("b"))
    parts = connected_components(numbered).withColumnRenamed("node", "id")
    members = ids.join(parts, "id").select(
        "node", "component", host(F.concat(F.lit("x://"), "node")).alias("host"), path(F.concat(F.lit("x://"), "node")).alias("path")
    )
    members = stage_table(members, "members")
    urls = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    fits = stage_table(match_rules(urls.select("host", "path").union(members.select("host", "path")), rules), "rules")
    said = members.join(fits, ["host", "path"]).groupBy("component").agg(
        F.when(F.bool_or(F.col("rule_verdict") == "allow"), "allow").otherwise("block").alias("spread")
    )
    spread = members.join(said, "component").select("node", "spread")
    out = urls.withColumn("node", node(F.col("url"))).join(fits, ["host", "path"], "left").join(spread, "node", "left")
    return out.select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "spread", F.lit("allow")).alias("verdict"),
        (F.col("rule").isNull() & F.col("spread").isNotNull()).alias("alias"),
    )
