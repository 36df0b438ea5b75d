"""Links to code, models and papers as column expressions: kinds, repositories and canonical addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First path parts that are no owners; hosts of papers; words of artifact pages; domains of categories.
GITHUB_PAGES = ("features", "topics", "collections", "marketplace", "pricing", "about", "login", "search")
HF_PAGES = ("api", "blog", "collections", "datasets", "docs", "models", "papers", "settings", "spaces")
PAPER_HOSTS = ("arxiv.org", "export.arxiv.org", "doi.org", "dx.doi.org")
ARTIFACT = "(?i)project|code|artifact|software|release|demo|model|dataset"
DOMAINS = (
    (("cs.CV", "eess.IV"), "computer-vision"),
    (("cs.CL",), "llm"),
    (("cs.RO",), "robotics"),
    (("cs.CR",), "alignment"),
    (("cs.LG", "stat.ML", "cs.AI"), "machine-learning"),
    (("math.OC",), "optimization"),
    (("stat.",), "statistics"),
)


def host(url: Column) -> Column:
    """Host in lower case without www., '' for what is no address."""
    return F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), r"^www\.", "")


def parts(url: Column) -> Column:
    return F.filter(F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/"), lambda p: p != "")


def resource(url: Column) -> Column:
    """(kind, repo): github, hf, hf_collection or project_page with the repository, else ignored."""
    h, p = host(url), parts(url)

    def at(i):
        return F.coalesce(F.get(p, F.lit(i)), F.lit(""))

    def named(kind, *repo):
        return F.struct(F.lit(kind).alias("kind"), (F.concat_ws("/", *repo) if repo else F.lit("")).alias("repo"))

    hf, first = h == "huggingface.co", F.lower(at(0))
    page = (h != "") & ~h.isin(*PAPER_HOSTS) & url.rlike(ARTIFACT)
    return (
        F.when((h == "github.com") & (F.size(p) >= 2) & ~first.isin(*GITHUB_PAGES), named("github", at(0), F.regexp_replace(at(1), r"\.git$", "")))
        .when(hf & first.isin("papers", "models"), named("ignored"))
        .when(hf & (first == "collections"), F.when(F.size(p) >= 3, named("hf_collection", at(1), at(2))).otherwise(named("ignored")))
        .when(hf & (F.size(p) >= 3) & at(0).isin("datasets", "spaces"), named("hf", at(1), at(2)))
        .when(hf & (F.size(p) >= 2) & ~first.isin(*HF_PAGES), named("hf", at(0), at(1)))
        .when(page, named("project_page")).otherwise(named("ignored"))
    )


def source_kind(url: Column) -> Column:
    """arxiv, openreview, direct-pdf or native, by host and path."""
    h, path = host(url), F.lower(F.array_join(parts(url), "/"))
    return F.when(h.endswith("arxiv.org"), "arxiv").when(h == "openreview.net", "openreview").when(path.endswith(".pdf"), "direct-pdf").otherwise("native")


def normal_url(url: Column) -> Column:
    """(url, reason): raw addresses of PDFs in repositories and canonical addresses of papers; others stay, without a reason."""
    h, p = host(url), parts(url)
    marker = F.coalesce(F.get(p, F.lit(2)), F.lit(""))
    raw = F.concat(F.lit("https://raw.githubusercontent.com/"), F.array_join(F.concat(F.slice(p, 1, 2), F.slice(p, 4, F.greatest(F.size(p), F.lit(1)))), "/"))
    note = F.try_parse_url(url, F.lit("QUERY"), F.lit("id"))
    paper = F.regexp_extract(F.array_join(p, "/"), r"^(?:abs|pdf)/([0-9.]+?)(?:v[0-9]+)?(?:\.pdf)?$", 1)

    def to(address, reason):
        return F.struct(address.alias("url"), reason.alias("reason"))

    return (
        F.when((h == "github.com") & (F.size(p) >= 5) & marker.isin("blob", "raw") & F.lower(F.element_at(p, -1)).endswith(".pdf"), to(raw, F.concat(F.lit("github_"), marker, F.lit("_pdf"))))
        .when((h == "openreview.net") & note.isNotNull(), to(F.concat(F.lit("https://openreview.net/pdf?id="), note), F.lit("openreview_canonical_pdf")))
        .when((h == "arxiv.org") & (paper != ""), to(F.concat(F.lit("https://arxiv.org/abs/"), paper), F.lit("arxiv_canonical_abs")))
        .otherwise(to(url, F.lit("")))
    )


def domain(categories: Column) -> Column:
    """Domain of the first category that begins with a known prefix, else general."""
    def of(c):
        out = F.lit(None).cast("string")
        for prefixes, name in reversed(DOMAINS):
            known = F.lit(False)
            for p in prefixes:
                known = known | c.startswith(p)
            out = F.when(known, name).otherwise(out)
        return out

    return F.coalesce(F.get(F.filter(F.transform(categories, of), lambda x: x.isNotNull()), F.lit(0)), F.lit("general"))
