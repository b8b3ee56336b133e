"""URL filter with redirect equivalence.

Explicit rules (host, path prefix, allow or block) fit their host and all its subdomains; the longest rule
that fits decides. Redirects and canonical links make urls aliases: distributed connected components over
these edges carry decisions from urls with a rule to those without. An alias set with an explicit allow is
allowed; else one with a block is blocked; all others are allowed.

Edges come from the pages themselves (``<link rel="canonical">`` and ``<meta http-equiv="refresh">``), from
any edge table, and from the redirects that servers make as a rule: scheme, leading ``www.`` or ``m.``,
trailing slash, ``.html``, fragment and ``utm_`` queries lead to one form of the url.

Cases: a null url or one without ``://`` has empty host and path, no rule, no aliases and is allowed; repeated
urls and page ids are judged row by row; null html holds no link; an empty table gives an empty result; no
rules allow everything. Only the named columns are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_small, materialise, table
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path prefix, decision)
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def settled(url: Column) -> Column:
    """The form of a url that a server's usual redirects lead to; null without ``://``."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(\.html|/)$", "")
    query = F.regexp_replace(F.regexp_extract(url, _URL, 3), r"^\?utm_.*$", "")
    return F.when(url.contains("://"), F.concat(F.lit("//"), host, path, query))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) urls of canonical links and refreshes in pages."""
    text = F.col(html)
    canonical = F.regexp_extract(text, r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical["']?[^>]*\bhref\s*=\s*["']([^"']+)["']""", 1)
    reverse = F.regexp_extract(text, r"""(?is)<link\b[^>]*\bhref\s*=\s*["']([^"']+)["'][^>]*\brel\s*=\s*["']?canonical["']?""", 1)
    refresh = F.regexp_extract(text, r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh["']?[^>]*\bcontent\s*=\s*["'][^"']*url\s*=\s*([^"'>\s]+)""", 1)
    some = pages.where(text.contains("canonical") | text.contains("refresh") | text.contains("Refresh") | text.contains("REFRESH") | text.contains("CANONICAL") | text.contains("Canonical"))
    return some.select(F.col(url).alias("src"), F.explode(F.array(canonical, reverse, refresh)).alias("dst")).where("src IS NOT NULL AND dst LIKE '%://%'")


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule_host string, rule_path string, decision string")


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, rule, decision) of distinct urls that a rule fits; the longest rule, then the smallest string.

    An equi-join on host suffixes. Rules are broadcast where their counted rows are few, else shuffled.
    """
    labels = F.split(host_of(F.col("u")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = urls.select(F.col(url).alias("u")).where("u IS NOT NULL").distinct().select("u", path_of(F.col("u")).alias("p"), F.explode(suffixes).alias("rule_host"))
    fits = join_small(each, rules, "rule_host", "inner", rules.count(), 100_000).where(F.startswith("p", "rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = fits.groupBy("u").agg(F.min(F.struct((-F.char_length(rule)).alias("n"), rule.alias("rule"), F.col("decision").alias("decision"))).alias("b"))
    return best.select(F.col("u").alias("url"), "b.rule", "b.decision")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, *, page_id: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, alias_of (smallest url of the alias set; null where there is none)."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    urls = materialise(rows.select("url").where("url IS NOT NULL").distinct(), "urls")
    links = urls.select(F.col("url").alias("src"), settled(F.col("url")).alias("dst"))
    # a form of only one url links nothing
    shared = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("dst")
    links = links.join(shared, "dst").select("src", "dst")
    for more in ([page_edges(pages, url, html)] if html else []) + ([edges.select("src", "dst")] if edges is not None else []):
        links = links.union(more)
    components = connected_components(links)
    rule = materialise(match_rules(urls, rules), "url-rules")
    member = components.join(rule.withColumnRenamed("url", "node"), "node", "left")
    decided = member.groupBy("component").agg(F.max(F.col("decision") == "allow").alias("allow"), F.max(F.col("decision") == "block").alias("block"))
    spread = components.join(decided, "component").select(F.col("node").alias("url"), F.col("component").alias("alias_of"), F.when(F.coalesce("allow", F.lit(False)), "allow").when(F.coalesce("block", F.lit(False)), "block").alias("spread"))
    per_url = urls.join(rule, "url", "left").join(spread, "url", "left")
    verdict = F.coalesce("decision", "spread", F.lit("allow"))
    return rows.join(per_url, "url", "left").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule", verdict.alias("verdict"), "alias_of")


def op1_url_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_frame(spark, RULES)).drop("alias_of")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{d}')" for h, p, d in RULES)
OP1_SQL = rf"""
WITH u AS (SELECT page_id, url, coalesce(translate(regexp_extract(url, '{_URL}', 1), '{UPPER}', '{LOWER}'), '') AS host,
                  coalesce(regexp_extract(url, '{_URL}', 2), '') AS path, coalesce(regexp_extract(url, '{_URL}', 3), '') AS query FROM pages),
k AS (SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)$', '') || regexp_replace(query, '^\?utm_.*$', '') END AS k FROM u),
r(h, p, d) AS (VALUES {_RULES_SQL}),
m AS (SELECT page_id, url, h || p AS rule, d, row_number() OVER (PARTITION BY page_id, url ORDER BY length(h || p) DESC, h || p) AS n
      FROM k JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
f AS (SELECT k.*, m.rule, m.d FROM k LEFT JOIN m ON m.page_id = k.page_id AND m.url = k.url AND m.n = 1),
g AS (SELECT k, bool_or(d = 'allow') AS a, bool_or(d = 'block') AS b FROM f WHERE k IS NOT NULL GROUP BY k)
SELECT page_id, host, path, rule,
       coalesce(d, CASE WHEN a THEN 'allow' WHEN b THEN 'block' ELSE 'allow' END) AS verdict
FROM f LEFT JOIN g ON g.k = f.k
"""
