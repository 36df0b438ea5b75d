"""Registered queries of corpus checks, quality aggregates and Markdown structure."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import markdown, text
from lodestack.operators import order
from lodestack.plans.columns import DOCS
from lodestack.sources.tables import conversations_markdown, corpus, read

SQL: dict = {}


# --- Markdown ------------------------------------------------------------------------------
def section_rows(spark, d):
    """(conv_id, ord, title, content): sections of each conversation's Markdown."""
    s = conversations_markdown(spark, d).select("conv_id", F.explode(markdown.sections(F.col("markdown"))).alias("s"))
    return s.select("conv_id", "s.ord", "s.title", "s.content")


TRIM = "trim(text, ' '||chr(10)||chr(9))"
SQL["e13_section_split"] = f"SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS ord, role AS title, {TRIM} AS content FROM conversations"


def typed_sections(spark, d):
    """The first section of each kind; kinds are the headings."""
    w = Window.partitionBy("conv_id", "title").orderBy("ord")
    s = section_rows(spark, d).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return s.select(F.concat(F.lit("raw_section:conv-"), F.col("conv_id").cast("string"), F.lit(":"), F.col("title")).alias("section_id"), "conv_id", F.col("title").alias("kind"), "content")


SQL["i01_section_extraction"] = f"SELECT concat('raw_section:conv-', conv_id, ':', role) AS section_id, conv_id, role AS kind, arg_min({TRIM}, turn) AS content FROM conversations GROUP BY conv_id, role"


def kind_counts(spark, d):
    return typed_sections(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("sections"))


SQL["d14_section_counts"] = "SELECT role AS kind, count(DISTINCT conv_id) AS sections FROM conversations GROUP BY 1"


def eligible(spark, d):
    """Sections of chosen kinds with at least twenty characters."""
    return typed_sections(spark, d).where(F.col("kind").isin("user", "assistant") & (F.length(F.trim("content")) >= 20)).select("section_id", F.length("content").cast("long").alias("chars"))


SQL["b07_section_eligibility"] = f"SELECT * FROM (SELECT concat('raw_section:conv-', conv_id, ':', role) AS section_id, length(arg_min({TRIM}, turn)) AS chars FROM conversations WHERE role IN ('user','assistant') GROUP BY conv_id, role) WHERE chars >= 20"


def kind_filter(spark, d):
    """Sections of one kind with counts before and after."""
    s = typed_sections(spark, d)
    w = Window.partitionBy("conv_id")
    s = s.withColumn("original", F.count(F.lit(1)).over(w)).withColumn("kept", F.count_if(F.col("kind") == "assistant").over(w))
    return s.where("kind = 'assistant'").select("conv_id", "section_id", "kept", "original")


SQL["b11_kind_filter"] = "SELECT conv_id, concat('raw_section:conv-', conv_id, ':assistant') AS section_id, 1::BIGINT AS kept, count(DISTINCT role) AS original FROM conversations GROUP BY conv_id HAVING bool_or(role = 'assistant')"


def snapshot_spans(spark, d):
    """Record and section spans where no source text is at hand."""
    r = corpus(spark, d).where("trim(text) <> ''").select(F.concat(F.lit("snapshot:chunks:"), F.col("doc_id").cast("string")).alias("span_id"), F.lit("record.snapshot").alias("span_kind"), F.lit("compiled").alias("source_role"), F.md5("text").alias("text_hash"))
    s = typed_sections(spark, d).where("trim(content) <> ''").select(F.concat(F.lit("raw-section:"), "section_id").alias("span_id"), F.lit("raw.section").alias("span_kind"), F.lit("raw").alias("source_role"), F.md5("content").alias("text_hash"))
    return r.unionByName(s)


SQL["i03_snapshot_spans"] = f"SELECT concat('snapshot:chunks:', doc_id) AS span_id, 'record.snapshot' AS span_kind, 'compiled' AS source_role, md5(text) AS text_hash FROM documents WHERE trim(text) <> '' UNION ALL SELECT concat('raw-section:raw_section:conv-', conv_id, ':', role), 'raw.section', 'raw', md5(arg_min({TRIM}, turn)) FROM conversations GROUP BY conv_id, role HAVING trim(arg_min({TRIM}, turn)) <> ''"


def heading_audit(spark, d):
    """Issues of headings by document: duplicates of a kind, and kinds that are missing."""
    s = section_rows(spark, d).groupBy("conv_id", "title").agg(F.count(F.lit(1)).alias("n"))
    dup = s.where("n > 1").select("conv_id", F.lit("duplicate").alias("issue"), F.col("title").alias("kind"))
    have = s.groupBy("conv_id").agg(F.collect_set("title").alias("have"))
    gone = have.select("conv_id", F.explode(F.array_except(F.array(F.lit("user"), F.lit("assistant"), F.lit("system")), "have")).alias("kind"))
    return dup.unionByName(gone.select("conv_id", F.lit("missing").alias("issue"), "kind"))


HEAD = "SELECT conv_id, 'duplicate' AS issue, role AS kind FROM conversations GROUP BY conv_id, role HAVING count(*) > 1 UNION ALL SELECT conv_id, 'missing', k FROM (SELECT DISTINCT conv_id FROM conversations) c, (VALUES ('user'),('assistant'),('system')) t(k) WHERE NOT EXISTS (SELECT 1 FROM conversations x WHERE x.conv_id = c.conv_id AND x.role = k)"
SQL["k05_heading_audit"] = HEAD


def audit_counters(spark, d):
    a = heading_audit(spark, d)
    return a.groupBy("issue", "kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("docs"))


SQL["d15_audit_counters"] = f"SELECT issue, kind, count(*) AS n, count(DISTINCT conv_id) AS docs FROM ({HEAD}) GROUP BY ALL"


def structured(spark, d):
    """Documents without all canonical headings, and which are missing."""
    have = section_rows(spark, d).groupBy("conv_id").agg(F.collect_set("title").alias("have"))
    return have.select("conv_id", F.array_join(F.array_except(F.array(F.lit("assistant"), F.lit("system"), F.lit("user")), "have"), ",").alias("missing")).where("missing <> ''")


SQL["k06_structured_headings"] = "SELECT conv_id, concat_ws(',', CASE WHEN NOT bool_or(role='assistant') THEN 'assistant' END, CASE WHEN NOT bool_or(role='system') THEN 'system' END, CASE WHEN NOT bool_or(role='user') THEN 'user' END) AS missing FROM conversations GROUP BY 1 HAVING missing <> ''"


def note_contract(spark, d):
    """The first rule that a turn breaks as a note body."""
    t = F.col("text")
    code = F.when(F.trim(t) == "", "empty").when(t.rlike("(?m)^(title|source):"), "metadata_line").when(t.rlike("https?://"), "url").when(F.length(t) < 40, "too_short").otherwise("ok")
    return read(spark, d, "conversations").select("conv_id", "turn", code.alias("code"))


SQL["k08_note_contract"] = "SELECT conv_id, turn, CASE WHEN trim(text) = '' THEN 'empty' WHEN regexp_matches(text, '(?m)^(title|source):') THEN 'metadata_line' WHEN regexp_matches(text,'https?://') THEN 'url' WHEN length(text) < 40 THEN 'too_short' ELSE 'ok' END AS code FROM conversations"


def method_atoms(spark, d):
    """Conversations whose assistant section has eighty characters or more, as method rows."""
    s = typed_sections(spark, d).where("kind = 'assistant' AND length(content) >= 80")
    return s.select(F.concat(F.lit("method:conv-"), F.col("conv_id").cast("string")).alias("atom_id"), text.first_sentences(F.col("content"), 200).alias("method"))


SQL["j03_method_atoms"] = f"SELECT concat('method:conv-', conv_id) AS atom_id, rtrim(left(trim(regexp_replace(c,'[ \\t\\n\\r]+',' ','g')),200)) AS method FROM (SELECT conv_id, arg_min({TRIM}, turn) AS c FROM conversations WHERE role = 'assistant' GROUP BY 1) WHERE length(c) >= 80"


# --- secrets and characters ----------------------------------------------------------------
def secret_hits(spark, d):
    """Assigned secrets: the name, with the value masked but for its length."""
    hits = F.regexp_extract_all("text", F.lit(text.ASSIGNED_SECRET), F.lit(2))
    return corpus(spark, d).select("doc_id", F.explode(hits).alias("v")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"), F.max(F.length("v")).alias("longest"))


SEC = "'(?i)(api[_-]?key|token|password|secret)\\s*[:=]\\s*[\"'']?([A-Za-z0-9_\\-]{28,})'"
SQL["k02_secret_hits"] = f"SELECT doc_id, count(*) AS hits, max(length(v))::INTEGER AS longest FROM (SELECT doc_id, unnest(regexp_extract_all(text, {SEC}, 2)) AS v FROM documents) GROUP BY 1"


def strict_scan(spark, d):
    """Hits of each strict pattern, masked; documents carry keys of five kinds behind their text."""
    digest = F.md5(F.col("doc_id").cast("string"))
    keys = (F.concat(F.lit("sk-"), digest), F.concat(F.lit("ghp_"), digest), F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 16))), F.concat(F.lit("eyJ"), digest, F.lit("."), digest, F.lit("."), digest), F.concat(F.lit("Bearer "), digest))
    docs = corpus(spark, d).select("doc_id", F.concat_ws(" ", "text", F.get(F.array(*keys), (F.col("doc_id") % 8).cast("int"))).alias("t"))
    hits = F.array(*[F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in text.STRICT_SECRETS])
    found = docs.select("doc_id", F.posexplode(hits).alias("pattern", "m")).select("doc_id", "pattern", F.explode("m").alias("m"))
    return found.select("doc_id", "pattern", F.concat(F.substring("m", 1, 4), F.lit("***")).alias("masked"))


_SCANS = " UNION ALL ".join(f"SELECT doc_id, {i}::INTEGER AS pattern, unnest(regexp_extract_all(t, '{p}')) AS m FROM k" for i, p in enumerate(text.STRICT_SECRETS))
SQL["k03_strict_scan"] = f"""WITH m AS (SELECT doc_id, text, md5(doc_id::VARCHAR) AS h FROM documents), k AS (SELECT doc_id, concat_ws(' ', text, CASE doc_id % 8 WHEN 0 THEN 'sk-' || h
 WHEN 1 THEN 'ghp_' || h WHEN 2 THEN 'AKIA' || upper(left(h, 16)) WHEN 3 THEN concat('eyJ', h, '.', h, '.', h) WHEN 4 THEN 'Bearer ' || h END) AS t FROM m)
SELECT doc_id, pattern, left(m, 4) || '***' AS masked FROM ({_SCANS})"""


def control_scan(spark, d):
    """Control characters of whole texts with line, column and code point, at most fifty a document; a bell stands behind every comma."""
    t = read(spark, d, "documents").select("doc_id", F.replace("text", F.lit(", "), F.lit(",\x07 ")).alias("t"))
    lines = t.select("doc_id", F.posexplode(F.split("t", "\n")).alias("l", "line"))
    chars = lines.select("doc_id", "l", F.explode(text.places(F.col("line"), r"[\x01-\x09\x0B-\x1F]")).alias("m"))
    w = Window.partitionBy("doc_id").orderBy("l", "m.start")
    hit = chars.withColumn("_n", F.row_number().over(w)).where("_n <= 50")
    return hit.select("doc_id", (F.col("l") + 1).alias("line"), (F.col("m.start") + 1).alias("col"), F.ascii("m.value").alias("code"))


SQL["k04_control_scan"] = """WITH t AS (SELECT doc_id, string_split(replace(text, ', ', ',' || chr(7) || ' '), chr(10)) AS t FROM documents),
l AS (SELECT doc_id, unnest(t) AS s, unnest(range(1, len(t) + 1)) AS line FROM t),
c AS (SELECT doc_id, line, s, unnest(list_filter(range(1, length(s) + 1), lambda i: ascii(s[i]) BETWEEN 1 AND 31)) AS col FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line, col) AS k FROM c)
SELECT doc_id, line::INTEGER AS line, col::INTEGER AS col, ascii(s[col])::INTEGER AS code FROM n WHERE k <= 50"""


def corpus_checks(spark, d):
    """One row a finding: check, severity, path, detail."""
    c = corpus(spark, d)
    long = c.where("n_chars > 20000").select(F.lit("length").alias("check"), F.lit("advisory").alias("severity"), "path", F.col("n_chars").cast("string").alias("detail"))
    empty = c.where("length(trim(text)) < 20").select(F.lit("short").alias("check"), F.lit("error").alias("severity"), "path", F.lit("").alias("detail"))
    wrong = c.where("n_chars <> length(text)").select(F.lit("n_chars").alias("check"), F.lit("error").alias("severity"), "path", F.length("text").cast("string").alias("detail"))
    return long.unionByName(empty).unionByName(wrong)



SQL["k01_corpus_checks"] = DOCS + "SELECT 'length' AS check, 'advisory' AS severity, path, n_chars::VARCHAR AS detail FROM d WHERE n_chars > 20000 UNION ALL SELECT 'short', 'error', path, '' FROM d WHERE length(trim(text)) < 20 UNION ALL SELECT 'n_chars', 'error', path, length(text)::VARCHAR FROM d WHERE n_chars <> length(text)"


def counters(spark, d):
    """By site: the pages, their links, the number of pages that its addresses state, and whether it drifts from the pages there are."""
    p = read(spark, d, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("site"), F.coalesce("html", F.lit("")).alias("html"), F.regexp_extract("url", "[?&]page=([0-9]{1,9})", 1).try_cast("long").alias("page"))
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    have = p.groupBy("site").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.size(links)).alias("links"), F.coalesce(F.max("page"), F.lit(0)).alias("stated"))
    return have.withColumn("drift", F.col("stated") != F.col("pages"))


SQL["d24_corpus_counters"] = """WITH p AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS site, regexp_extract_all(coalesce(html, ''), 'href="([^"]*)"', 1) AS l, TRY_CAST(regexp_extract(url, '[?&]page=([0-9]{1,9})', 1) AS BIGINT) AS page FROM pages)
SELECT *, stated <> pages AS drift FROM (SELECT site, count(*) AS pages, sum(len(l))::BIGINT AS links, coalesce(max(page), 0) AS stated FROM p GROUP BY 1)"""


# --- aggregates of measurements ------------------------------------------------------------
def latency(spark, d):
    """Nearest-rank and interpolated percentiles of a value by type."""
    e = read(spark, d, "events").where("value IS NOT NULL")
    counts = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    found = order.percentiles(e, ["event_type"], "value", {"p95": (0.95, False), "p95_linear": (0.95, True), "p50": (0.5, True)})
    return counts.join(found, "event_type").select("event_type", "n", "p95", F.round("p95_linear", 6).alias("p95_linear"), F.round("p50", 6).alias("p50"))


SQL["d20_latency"] = "SELECT event_type, count(*) AS n, quantile_disc(value, 0.95) AS p95, round(quantile_cont(value, 0.95),6) AS p95_linear, round(median(value),6) AS p50 FROM events WHERE value IS NOT NULL GROUP BY 1"


def quality_totals(spark, d):
    e = read(spark, d, "events")
    return e.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.avg(F.when(F.col("event_type") == "purchase", 1.0 / (1 + F.col("event_id") % 5))), 6).alias("mrr"), F.round(F.avg((F.col("event_type") != "error").cast("double")), 6).alias("success"), F.count_if(F.col("event_type") == "error").alias("failures"))


SQL["d17_quality_totals"] = "SELECT count(*) AS rows, round(avg(value),6) AS mean, round(avg(1.0::DOUBLE/(1+event_id%5)) FILTER (WHERE event_type='purchase'),6) AS mrr, round(avg((event_type<>'error')::INTEGER),6) AS success, count(*) FILTER (WHERE event_type='error') AS failures FROM events"


def quality_groups(spark, d):
    """Totals overall, by goal and by partition in one pass."""
    e = read(spark, d, "events").select("value", F.when(F.col("event_id") % 3 == 0, "coverage").otherwise("focused").alias("goal"), F.when(F.col("event_id") % 4 == 0, "holdout").otherwise("calibration").alias("part"))
    out = e.groupingSets([[], [F.col("goal")], [F.col("part")]], F.col("goal"), F.col("part")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean"))
    return out.select(F.coalesce("goal", F.lit("all")).alias("goal"), F.coalesce("part", F.lit("all")).alias("part"), "n", "mean")


SQL["d18_quality_groups"] = "SELECT coalesce(goal,'all') AS goal, coalesce(part,'all') AS part, count(*) AS n, round(avg(value),6) AS mean FROM (SELECT value, CASE WHEN event_id%3=0 THEN 'coverage' ELSE 'focused' END AS goal, CASE WHEN event_id%4=0 THEN 'holdout' ELSE 'calibration' END AS part FROM events) GROUP BY GROUPING SETS ((),(goal),(part))"


def repetitions(spark, d):
    """Repeated runs folded: extremes, all and any, and whether all gave one fingerprint."""
    e = read(spark, d, "events")
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("runs"), F.max("value").alias("worst"), F.min("value").alias("best"), F.bool_and(F.col("event_type") != "error").alias("passed"), (F.countDistinct("event_type") == 1).alias("deterministic"))


SQL["d19_repetitions"] = "SELECT user_id, count(*) AS runs, max(value) AS worst, min(value) AS best, bool_and(event_type <> 'error') AS passed, count(DISTINCT event_type) = 1 AS deterministic FROM events GROUP BY 1"


def paired(spark, d):
    """Baseline and candidate runs by id: ratio within 1.2 or 25 above."""
    e = read(spark, d, "events")
    a = e.where("event_id % 2 = 0").select((F.col("event_id") / 2).cast("long").alias("row"), F.col("value").alias("baseline"))
    b = e.where("event_id % 2 = 1").select(((F.col("event_id") - 1) / 2).cast("long").alias("row"), F.col("value").alias("candidate"))
    return a.join(b, "row").select("row", "baseline", "candidate", (F.col("candidate") <= F.greatest(F.round(F.col("baseline") * 1.2, 9), F.col("baseline") + 25)).alias("ok"))


PAIRS = "SELECT a.event_id // 2 AS row, a.value AS baseline, b.value AS candidate, b.value <= greatest(round(a.value*1.2::DOUBLE,9), a.value+25) AS ok FROM events a JOIN events b ON b.event_id = a.event_id + 1 WHERE a.event_id % 2 = 0"
SQL["c15_paired_rows"] = PAIRS


def gates(spark, d):
    """One row of gates: candidate p95 against baseline, share of pairs that hold, no failing critical row."""
    p = paired(spark, d)
    sides = p.select(F.explode(F.array(F.struct(F.lit("base").alias("side"), F.col("baseline").alias("value")), F.struct(F.lit("cand").alias("side"), F.col("candidate").alias("value")))).alias("x")).select("x.*")
    p95 = order.percentiles(sides, ["side"], "value", {"p95": (0.95, False)})
    p95 = p95.agg(F.max(F.when(F.col("side") == "base", F.col("p95"))).alias("base_p95"), F.max(F.when(F.col("side") == "cand", F.col("p95"))).alias("cand_p95"))
    share = p.agg(F.round(F.avg(F.col("ok").cast("double")), 6).alias("pair_share"))
    g = p95.crossJoin(share)  # one row each
    return g.withColumn("latency_ok", F.col("cand_p95") <= F.greatest(F.col("base_p95") * 1.2, F.col("base_p95") + 25)).withColumn("pairs_ok", F.col("pair_share") >= 0.9)


SQL["l05_gates"] = f"SELECT *, cand_p95 <= greatest(base_p95*1.2, base_p95+25) AS latency_ok, pair_share >= 0.9 AS pairs_ok FROM (SELECT quantile_disc(baseline,0.95) AS base_p95, quantile_disc(candidate,0.95) AS cand_p95, round(avg(ok::INTEGER),6) AS pair_share FROM ({PAIRS}))"


def pending(spark, d):
    """Ledger roll-up of label rows: actionable, terminal and review entries, and what to do."""
    n = read(spark, d, "labels").agg(F.count_if(F.expr("quality = 1 AND toxic = 0")).alias("terminal"), F.count_if(F.expr("quality = 0 AND toxic = 0")).alias("actionable"), F.count_if(F.expr("toxic = 1")).alias("review"))
    reasons = F.array_join(F.filter(F.array(F.when(F.col("actionable") > 0, "actionable"), F.when(F.col("review") > 0, "review")), lambda x: x.isNotNull()), ",")
    return n.select("*", F.when(F.col("actionable") > 0, "run").when(F.col("review") > 0, "review").otherwise("idle").alias("decision"), reasons.alias("reasons"))


SQL["d22_pending_status"] = "SELECT *, CASE WHEN actionable > 0 THEN 'run' WHEN review > 0 THEN 'review' ELSE 'idle' END AS decision, concat_ws(',', CASE WHEN actionable > 0 THEN 'actionable' END, CASE WHEN review > 0 THEN 'review' END) AS reasons FROM (SELECT count(*) FILTER (WHERE quality=1 AND toxic=0) AS terminal, count(*) FILTER (WHERE quality=0 AND toxic=0) AS actionable, count(*) FILTER (WHERE toxic=1) AS review FROM labels)"


def resources(spark, d):
    """Pages by host suffix and scheme: how many of them hold an article."""
    p = read(spark, d, "pages")
    host = F.try_parse_url("url", F.lit("HOST"))
    kind = F.concat_ws(" ", F.substring_index(host, ".", -1), F.substring_index("url", ":", 1))
    whole = F.contains("html", F.lit("<article>")) & (F.length("html") >= 2000)
    return p.groupBy(kind.alias("kind")).agg(F.count_if(whole).alias("verified"), F.count_if(~whole).alias("unverified"))


SQL["d23_resource_status"] = """SELECT concat_ws(' ', regexp_extract(url, '^[a-z]+://[^/?#:]*[.]([^/?#:.]+)', 1), split_part(url, ':', 1)) AS kind,
 count(*) FILTER (WHERE contains(html, '<article>') AND length(html) >= 2000) AS verified, count(*) FILTER (WHERE NOT (contains(html, '<article>') AND length(html) >= 2000)) AS unverified FROM pages GROUP BY 1"""


def first_pass(spark, d):
    """Per conversation: no role appears for the first time after another one was repeated."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = read(spark, d, "conversations").withColumn("new", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")) == 1)
    t = t.withColumn("begun", F.coalesce(F.max(~F.col("new")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    return t.groupBy("conv_id").agg((~F.bool_or(F.col("new") & F.col("begun"))).alias("ok"))


SQL["e09_first_pass"] = "SELECT conv_id, NOT bool_or(new AND coalesce(begun,false)) AS ok FROM (SELECT *, max(NOT new) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begun FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1 AS new FROM conversations)) GROUP BY 1"


def suite_rows(spark, d):
    """Broken rules of query-suite rows: focused wants one source, coverage two to top_k, critical rows are holdout, anchors differ."""
    b = read(spark, d, "benchmark")
    words = F.regexp_extract_all("text", F.lit("[a-z]{2,}"), F.lit(0))
    lines = F.size(F.split("text", r"\."))
    row = b.select(
        "item_id", F.when(F.col("text").rlike("^[A-M]"), "focused").otherwise("coverage").alias("goal"), (lines - 1).alias("least"), F.contains("text", F.lit(",")).alias("critical"),
        (F.length("text") > 200).alias("holdout"), F.slice(words, 1, 12).alias("anchors"), F.lit(3).alias("top_k"),
    )
    rules = F.array(
        F.when((F.col("goal") == "focused") & (F.col("least") != 1), "sources"), F.when((F.col("goal") == "coverage") & ~F.col("least").between(2, F.col("top_k")), "sources"),
        F.when(F.col("critical") != F.col("holdout"), "critical"), F.when(F.size(F.array_distinct("anchors")) < F.size("anchors"), "anchors"),
    )
    return row.select("item_id", F.array_join(F.filter(rules, lambda x: x.isNotNull()), ",").alias("errors"))


SQL["b18_suite_rows"] = """SELECT item_id, concat_ws(',', CASE WHEN regexp_matches(text, '^[A-M]') THEN CASE WHEN n <> 1 THEN 'sources' END WHEN n < 2 OR n > 3 THEN 'sources' END, CASE WHEN contains(text, ',') <> (length(text) > 200) THEN 'critical' END,
 CASE WHEN len(list_distinct(a)) < len(a) THEN 'anchors' END) AS errors FROM (SELECT item_id, text, length(text) - length(replace(text, '.', '')) AS n, regexp_extract_all(text, '[a-z]{2,}')[1:12] AS a FROM benchmark)"""


def response_prints(spark, d):
    """Fingerprints of responses without their timing fields."""
    e = read(spark, d, "events")
    card = F.struct(F.col("event_type").alias("a"), F.get_json_object("props", "$.k").cast("int").alias("k"), "user_id")
    return e.select("event_id", F.sha2(F.to_json(card), 256).alias("print"))


SQL["h34_response_fingerprint"] = "SELECT event_id, sha256(concat('{\"a\":\"', event_type, '\",\"k\":', json_extract_string(props,'$.k'), ',\"user_id\":', user_id, '}')) AS print FROM events"


def capped(spark, d):
    """The first three lines of each document, as cards."""
    c = corpus(spark, d).select("doc_id", F.posexplode(F.slice(F.split("text", "\n"), 1, 3)).alias("ord", "line"))
    return c.select("doc_id", "ord", F.substring("line", 1, 80).alias("card"))


SQL["f06_card_caps"] = "SELECT doc_id, (p-1)::INTEGER AS ord, left(l,80) AS card FROM (SELECT doc_id, unnest(x) AS l, unnest(range(1,len(x)+1)) AS p FROM (SELECT doc_id, list_slice(string_split(text,chr(10)),1,3) AS x FROM documents))"

QUERIES = {
    "e13_section_split": section_rows, "i01_section_extraction": typed_sections, "d14_section_counts": kind_counts, "b07_section_eligibility": eligible, "b11_kind_filter": kind_filter,
    "i03_snapshot_spans": snapshot_spans, "k05_heading_audit": heading_audit, "d15_audit_counters": audit_counters,
    "k06_structured_headings": structured, "k08_note_contract": note_contract, "j03_method_atoms": method_atoms, "k02_secret_hits": secret_hits, "k03_strict_scan": strict_scan,
    "k04_control_scan": control_scan, "k01_corpus_checks": corpus_checks, "d24_corpus_counters": counters, "d20_latency": latency, "d17_quality_totals": quality_totals, "d18_quality_groups": quality_groups,
    "d19_repetitions": repetitions, "c15_paired_rows": paired, "l05_gates": gates, "d22_pending_status": pending, "d23_resource_status": resources, "e09_first_pass": first_pass, "b18_suite_rows": suite_rows,
    "h34_response_fingerprint": response_prints, "f06_card_caps": capped,
}
