"""Registered queries of links: resources, sources of papers, canonical addresses, domains and probes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import links
from lodestack.plans.papers import quoted
from lodestack.sources.tables import read

SQL: dict = {}

# The pages link to words of their own; the word decides which address or category it stands for.
ADDRESSES = (
    ("^/([a-d][a-z]*)$", "https://github.com/org-$1/repo.git"),
    ("^/(e[a-z]*)$", "https://www.GitHub.com/$1/code/blob/main/docs/$1.PDF"),
    ("^/(f[a-z]*)$", "https://github.com/$1"),
    ("^/(g[a-z]*)$", "https://github.com/topics/$1"),
    ("^/(h[a-z]*)$", "https://huggingface.co/collections/$1/set-1"),
    ("^/(i[a-z]*)$", "https://huggingface.co/collections/$1"),
    ("^/(l[a-z]*)$", "https://huggingface.co/datasets/$1/corpus"),
    ("^/([mn][a-z]*)$", "https://huggingface.co/papers/$1"),
    ("^/(o[a-z]*)$", "https://huggingface.co/$1/model"),
    ("^/([pq][a-z]*)$", "http://arxiv.org/pdf/2401.01234v2.pdf#$1"),
    ("^/([rs][a-z]*)$", "https://openreview.net/forum?id=$1&noteId=x"),
    ("^/(t[a-z]*)$", "https://example.org/project/$1"),
    ("^/([u-z][a-z]*)$", "https://site.org/files/$1.PDF?dl=1"),
)
CATEGORIES = (("^/[a-c].*$", "cs.CV"), ("^/[de].*$", "cs.CLX"), ("^/[h-l].*$", "stat.ML"), ("^/[m-o].*$", "stat.AP"), ("^/t.*$", "cs.AI"), ("^/[u-w].*$", "math.OC"))
HREF = 'href="(/[^"#]*)"'


def targets(spark, d):
    return read(spark, d, "pages").select("page_id", "url", F.regexp_extract_all("html", F.lit(HREF), F.lit(1)).alias("hrefs"))


def addresses(spark, d):
    """(page_id, ord, address): every link of every page."""
    out = targets(spark, d).select("page_id", F.regexp_extract("url", "^https?://[^/?#]+", 0).alias("site"), F.posexplode("hrefs").alias("ord", "address"))
    address = F.col("address")
    for pattern, made in ADDRESSES:
        address = F.regexp_replace(address, pattern, made)
    return out.select("page_id", "ord", F.when(address.startswith("/"), F.concat("site", address)).otherwise(address).alias("address"))


def _made() -> str:
    address = "h[i]"
    for pattern, made in ADDRESSES:
        address = f"regexp_replace({address}, '{pattern}', '{made.replace('$1', chr(92) + '1')}')"
    return f"""WITH t AS (SELECT page_id, url, regexp_extract_all(html, {quoted(HREF)}, 1) AS h FROM pages),
 x AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') AS site, unnest(range(1, len(h) + 1)) AS i, h FROM t),
 a AS (SELECT page_id, (i - 1)::INTEGER AS ord, CASE WHEN starts_with(m, '/') THEN concat(site, m) ELSE m END AS address FROM (SELECT page_id, site, i, {address} AS m FROM x)),
 p AS (SELECT *, regexp_replace(lower(regexp_extract(address, '^[a-z]+://([^/?#:]+)', 1)), '^www[.]', '') AS host, list_filter(string_split(regexp_extract(address, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '') AS p FROM a)"""


MADE = _made()


def _in(values) -> str:
    return f"({', '.join(quoted(v) for v in values)})"


RESOURCES = f"""{MADE}, r AS (SELECT page_id, ord, address, split_part(k, ' ', 1) AS kind, split_part(k, ' ', 2) AS repo FROM (SELECT *, CASE
 WHEN host = 'github.com' AND len(p) >= 2 AND lower(p[1]) NOT IN {_in(links.GITHUB_PAGES)} THEN concat('github ', p[1], '/', regexp_replace(p[2], '[.]git$', ''))
 WHEN host = 'huggingface.co' AND len(p) >= 3 AND lower(p[1]) = 'collections' THEN concat('hf_collection ', p[2], '/', p[3])
 WHEN host = 'huggingface.co' AND len(p) >= 3 AND p[1] IN ('datasets', 'spaces') THEN concat('hf ', p[2], '/', p[3])
 WHEN host = 'huggingface.co' AND len(p) >= 2 AND lower(p[1]) NOT IN {_in(links.HF_PAGES)} THEN concat('hf ', p[1], '/', p[2])
 WHEN host = 'huggingface.co' AND lower(p[1]) IN ('papers', 'models', 'collections') THEN 'ignored'
 WHEN host <> '' AND host NOT IN {_in(links.PAPER_HOSTS)} AND regexp_matches(address, '{links.ARTIFACT}') THEN 'project_page' ELSE 'ignored' END AS k FROM p))"""


def resources(spark, d):
    """Kind and repository of every link."""
    return addresses(spark, d).withColumn("r", links.resource(F.col("address"))).select("page_id", "ord", "address", "r.kind", "r.repo")


SQL["b20_resource_kind"] = f"{RESOURCES} SELECT * FROM r"


def sources(spark, d):
    return addresses(spark, d).select("page_id", "ord", links.source_kind(F.col("address")).alias("kind"))


SQL["b21_source_kind"] = f"{MADE} SELECT page_id, ord, CASE WHEN host LIKE '%arxiv.org' THEN 'arxiv' WHEN host = 'openreview.net' THEN 'openreview' WHEN regexp_matches(address, '(?i)^[a-z]+://[^/?#]+/[^?#]*[.]pdf/*([?#]|$)') THEN 'direct-pdf' ELSE 'native' END AS kind FROM p"


def normal_urls(spark, d):
    return addresses(spark, d).select("page_id", "ord", links.normal_url(F.col("address")).alias("n")).select("page_id", "ord", "n.url", "n.reason")


SQL["b22_normal_url"] = f"""{MADE}, k AS (SELECT *, CASE WHEN regexp_matches(address, '(?i)^https?://(www[.])?github[.]com/[^/]+/[^/]+/(blob|raw)/[^/]+/.*[.]pdf$') THEN 1 WHEN regexp_matches(address, '^https?://openreview[.]net/[^?]*[?](.*&)?id=') THEN 2
  WHEN regexp_matches(address, '^https?://arxiv[.]org/(abs|pdf)/[0-9.]+') THEN 3 ELSE 4 END AS k FROM p)
SELECT page_id, ord, CASE k WHEN 1 THEN regexp_replace(address, '(?i)^https?://(?:www[.])?github[.]com/([^/]+)/([^/]+)/(?:blob|raw)/', 'https://raw.githubusercontent.com/\\1/\\2/')
  WHEN 2 THEN concat('https://openreview.net/pdf?id=', regexp_extract(address, '[?&]id=([^&#]*)', 1)) WHEN 3 THEN concat('https://arxiv.org/abs/', regexp_extract(address, '/([0-9]+[.][0-9]+)', 1)) ELSE address END AS url,
 CASE k WHEN 1 THEN concat('github_', p[3], '_pdf') WHEN 2 THEN 'openreview_canonical_pdf' WHEN 3 THEN 'arxiv_canonical_abs' ELSE '' END AS reason FROM k"""


def domains(spark, d):
    """Domain of each page by the categories its links stand for."""
    def category(h):
        for pattern, name in CATEGORIES:
            h = F.regexp_replace(h, pattern, name)
        return h

    return targets(spark, d).select("page_id", links.domain(F.transform("hrefs", category)).alias("domain"))


def _domains() -> str:
    category = "x"
    for pattern, name in CATEGORIES:
        category = f"regexp_replace({category}, '{pattern}', '{name}')"
    rules = " ".join(f"WHEN {' OR '.join(f'starts_with(c, {quoted(p)})' for p in prefixes)} THEN '{name}'" for prefixes, name in links.DOMAINS)
    return f"""WITH c AS (SELECT page_id, unnest(h) AS x, unnest(range(len(h))) AS i FROM (SELECT page_id, regexp_extract_all(html, {quoted(HREF)}, 1) AS h FROM pages)),
 k AS (SELECT page_id, i, CASE {rules} END AS domain FROM (SELECT page_id, i, {category} AS c FROM c))
SELECT page_id, coalesce(arg_min(domain, i) FILTER (WHERE domain IS NOT NULL), 'general') AS domain FROM pages LEFT JOIN k USING (page_id) GROUP BY 1"""


SQL["b23_domain"] = _domains()


def probes(spark, d):
    """Resources to probe: the first link of each (kind, repository), eight of a kind."""
    known = resources(spark, d).where("kind <> 'ignored'").withColumn("repo", F.when(F.col("repo") == "", F.col("address")).otherwise(F.col("repo")))
    first = known.groupBy("kind", "repo").agg(F.min_by(F.struct("page_id", "ord", "address"), F.struct("page_id", "ord")).alias("f")).select("kind", "repo", "f.*")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("page_id", "ord"))
    return first.withColumn("place", place).where("place <= 8").select("kind", "repo", "address", "page_id", "place")


SQL["m07_probes"] = f"""{RESOURCES}, k AS (SELECT *, CASE repo WHEN '' THEN address ELSE repo END AS name FROM r WHERE kind <> 'ignored'),
 f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY kind, name ORDER BY page_id, ord) = 1)
SELECT kind, name AS repo, address, page_id, row_number() OVER (PARTITION BY kind ORDER BY page_id, ord)::INTEGER AS place FROM f QUALIFY place <= 8"""

QUERIES = {"b20_resource_kind": resources, "b21_source_kind": sources, "b22_normal_url": normal_urls, "b23_domain": domains, "m07_probes": probes}
