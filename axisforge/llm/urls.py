"""URL filters: rules by host and path, and block decisions that spread over redirects and canonical links."""

from __future__ import annotations

import html as markup
import re
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axisforge.llm.common import components, table, without, written

#: Rules up to this number are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Parameters that only say where a visitor came from.
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid"
#: Seconds after which a refresh is no redirect.
AT_ONCE = 10


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What names a resource: the url less its fragment, its host lower-cased; null if it has no host."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)), F.lit("://"), host_of(url), rest))


def resolved(url: str | None, base: str | None, target: str | None) -> str | None:
    """The address that target, as it stands in an attribute, has on the page url with the given base; null if it has none."""
    decode = lambda t: re.sub(r"&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);", lambda m: markup.unescape(m[0]), t)
    try:
        for part in (base, target):
            part = decode(part or "").strip()
            # What has a host of its own stays as it is written.
            url = part if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", part) else urljoin(url or "", part)
    except ValueError:
        return None
    return url


def usual_form(url: Column) -> Column:
    """The address that a site redirects variants of url to: https, no default port, no www., no tracking parameters, no slash at the end of a path."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.(?=[^.]+\.[^.])", "")
    path = F.regexp_replace(path_of(url), r"(?<=.)/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(rf"(?i)^({TRACKING})(=|$)"))
    http = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)).isin("http", "https")
    whole = F.concat(F.lit("https://"), host, F.when(path == "", "/").otherwise(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(http & (host != ""), whole)


def html_links(pages: DataFrame) -> DataFrame:
    """Edges (url, target) that pages themselves declare: all canonical links, and redirects by a meta refresh within AT_ONCE seconds.

    Character references are decoded and relative targets resolved, against <base href> where a page has one.
    """
    html = F.col("html")
    tag = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    refresh = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*[\"']?\s*(\d+)(?:\.\d*)?\s*[;,]\s*url\s*=\s*['\"]?([^\"'\s>]+)"
    has = F.lower(html)
    found = pages.where(has.contains("canonical") | has.contains("refresh"))
    base = r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    moved = F.arrays_zip(F.regexp_extract_all(html, F.lit(refresh), F.lit(1)).alias("after"), F.regexp_extract_all(html, F.lit(refresh), F.lit(2)).alias("to"))
    at_once = F.transform(F.filter(moved, lambda m: m["after"].cast("double") <= AT_ONCE), lambda m: m["to"])
    targets = F.concat(F.regexp_extract_all(html, F.lit(tag), F.lit(1)), at_once)
    links = found.select("url", F.regexp_extract(html, base, 1).alias("base"), F.explode(targets).alias("target")).where("target <> ''")
    return links.select("url", F.udf(resolved, "string")("url", "base", "target").alias("target"))


def with_rule(frame: DataFrame, rules: DataFrame) -> DataFrame:
    """frame (host, path, ...) with rule and ruling, null where none fits; the longest rule wins.

    rules: host, path, verdict (allow or block). A rule fits its host and all subdomains if
    the path starts with the rule's; of equal lengths the rule that allows wins. Each row
    looks up the last labels of its host, as many as any rule has, in the rules by host: no
    row of frame moves where the rules are broadcast.
    """
    labels = F.split("host", r"\.")
    by = rules.select("host", "path", "verdict").distinct()
    n, deepest = by.agg(F.count(F.lit(1)), F.max(F.size(labels))).first()
    one = F.struct(F.col("path").alias("p"), (F.col("verdict") == "allow").alias("allow"), F.concat("host", "path").alias("rule"))
    by = by.groupBy(F.col("host").alias("_af_h")).agg(F.collect_list(one).alias("_af_r"))
    names, found = frame.columns, []
    for k in range(1, (deepest or 0) + 1):
        side = by.where(F.size(F.split("_af_h", r"\.")) == k).select(F.col("_af_h").alias(f"_af_h{k}"), F.col("_af_r").alias(f"_af_r{k}"))
        end = F.when(F.size(labels) >= k, F.array_join(F.slice(labels, -k, k), "."))
        frame = frame.join(F.broadcast(side) if n <= BROADCAST_RULES else side, end == F.col(f"_af_h{k}"), "left")
        found.append(F.coalesce(f"_af_r{k}", F.array().cast(by.schema["_af_r"].dataType)))
    if not found:
        return frame.withColumn("rule", F.lit(None).cast("string")).withColumn("ruling", F.lit(None).cast("string"))
    fits = F.filter(F.concat(*found), lambda r: F.col("path").startswith(r.p))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.length(r.rule).alias("n"), r.allow.alias("allow"), r.rule.alias("rule"))))
    return frame.withColumn("_af_best", best).select(*[F.col(f"`{c}`") for c in names], F.col("_af_best.rule").alias("rule"), F.when(F.col("_af_best.allow"), "allow").when(~F.col("_af_best.allow"), "block").alias("ruling"))


def url_verdicts(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, variants: bool = True) -> DataFrame:
    """The columns of pages but html, with host, path, rule and verdict.

    A url's own rule decides. One without a rule is blocked if an address that is equivalent
    to it is blocked by a rule, and allowed otherwise. Redirects and canonical links make
    addresses equivalent, in connected components found by distributed star contraction:
    `links` (url, target), those in the pages' html, and, with `variants`, the redirect of
    each address to its usual form (see usual_form). An explicit allow rule precedes what
    aliases say, for its own address.

    A null url, or one without a host, fits no rule, has no aliases and is allowed. Urls and
    html of any length are read whole. Repeated pages get the same verdict; empty tables give
    empty results; columns with the names of the results are replaced.
    """
    names = [c for c in without(pages, "host", "path", "rule", "verdict").columns if c != "html"]
    url = F.col("url")
    rows = pages.select(*[F.col(f"`{c}`") for c in names], host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("_af_address"))
    rows = written(with_rule(rows, rules), "url-rows")
    edges = [links.select("url", "target")] if links is not None else []
    if "html" in pages.columns:
        edges.append(html_links(pages))
    edges = [e.select(address(url).alias("a"), address(F.col("target")).alias("b")) for e in edges]
    if variants:
        ends = [e.select(F.explode(F.array("a", "b")).alias("a")) for e in edges]
        seen = rows.select(F.col("_af_address").alias("a"))
        for e in ends:
            seen = seen.unionByName(e)
        edges.append(seen.select("a", usual_form(F.col("a")).alias("b")))
    cols = [F.col(f"`{c}`") for c in names]
    if not edges:
        return rows.select(*cols, "host", "path", "rule", F.coalesce("ruling", F.lit("allow")).alias("verdict"))
    every = edges[0]
    for e in edges[1:]:
        every = every.unionByName(e)
    same = written(components(every), "url-aliases")
    # Aliases need not be pages themselves: a rule on any address in a component counts.
    known = with_rule(same.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")), rules)
    blocked = known.where("ruling = 'block'").select("component").distinct()
    aliases = known.where("ruling is null").join(blocked, "component", "left_semi").select(F.col("node").alias("_af_node"))
    # Only addresses without a rule of their own ask their aliases.
    ruled = rows.where("ruling is not null").withColumn("verdict", F.col("ruling"))
    asked = rows.where("ruling is null").join(aliases, F.col("_af_address") == F.col("_af_node"), "left")
    asked = asked.withColumn("verdict", F.when(F.col("_af_node").isNotNull(), "block").otherwise("allow")).drop("_af_node")
    return ruled.unionByName(asked).select(*cols, "host", "path", "rule", "verdict")


#: The rules that the query states.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_redirect_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url", "html"), rules).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH RECURSIVE r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, url, html, COALESCE(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') AS host, COALESCE(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    lower(regexp_extract(url, '^(.*?)://', 1, 's')) || '://' || lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')) || regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1, 's') AS address FROM pages),
x AS (SELECT address, regexp_extract(tag, 'href\s*=\s*["'']?([^"''\s>]+)', 1, 'i') AS target FROM (SELECT address, unnest(regexp_extract_all(html, '<link[^>]*rel\s*=\s*["'']?canonical[^>]*>', 0, 'is')) AS tag FROM u)
    UNION ALL SELECT address, regexp_extract(tag, 'url\s*=\s*["'']?([^"''\s>]+)', 1, 'i') FROM (SELECT address, unnest(regexp_extract_all(html, '<meta[^>]*http-equiv\s*=\s*["'']?refresh[^>]*>', 0, 'is')) AS tag FROM u)),
f AS (SELECT DISTINCT address, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.([^.]+\.[^.])', '\1') AS h, CASE WHEN length(path) > 1 THEN regexp_replace(path, '^(.)(.*?)/+$', '\1\2') WHEN path = '' THEN '/' ELSE path END AS p,
    list_filter(string_split(regexp_extract(url, '^.*?://[^?#]*\?([^#]*)', 1, 's'), '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|gclid|fbclid|msclkid)(=|$)', 'i')) AS q FROM u WHERE address LIKE 'http://%' OR address LIKE 'https://%'),
n AS (SELECT address, 'https://' || h || p || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS target FROM f),
e AS (SELECT a, b FROM (SELECT address AS a, target AS b FROM x WHERE target <> '' UNION SELECT address, target FROM n) UNION SELECT b, a FROM (SELECT address AS a, target AS b FROM x WHERE target <> '' UNION SELECT address, target FROM n)),
reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
nodes AS (SELECT DISTINCT a AS address, regexp_extract(a, '^.*?://([^/?#]*)', 1, 's') AS host, regexp_extract(a, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM reach),
best AS (SELECT page_id, host, path, address, (SELECT arg_max(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule FROM u),
ruled AS (SELECT best.*, (SELECT v FROM r WHERE h || p = rule) AS ruling FROM best),
named AS (SELECT address, (SELECT arg_max(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule FROM nodes),
blocked AS (SELECT DISTINCT reach.a FROM reach JOIN named ON reach.b = named.address JOIN r ON r.h || r.p = named.rule AND r.v = 'block')
SELECT page_id, host, path, rule, COALESCE(ruling, CASE WHEN address IN (SELECT a FROM blocked) THEN 'block' END, 'allow') AS verdict FROM ruled
"""
