"""Operators on small tables: selection, differences, Markdown, excerpts, neighbours."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lodestack.functions import excerpt, ids, links, markdown, tex, text, vectors
from lodestack.operators import diff, knn, planner, search

ORDER = ("query_id", "record_type", "record_id", "source_key", "score", "source_rank", "start_line", "is_primary", "evidence_kind", "evidence_group", "top_k")
SCHEMA = "query_id long, record_type string, record_id string, source_key string, score double, source_rank int, start_line int, is_primary boolean, evidence_kind string, evidence_group string, top_k int"


def cards(seed, n_queries=25):
    rng = random.Random(seed)
    out = []
    for q in range(n_queries):
        rank = {s: i + 1 for i, s in enumerate(rng.sample("abcde", 5))}
        for i in range(rng.randint(0, 14)):
            s = rng.choice("abcde")
            kind = rng.choice(["raw_section", "raw.section", "compiled_chunk", "table.row", "heading", "entity"])
            primary = kind not in ("heading", "entity") or rng.random() < 0.2
            out.append((q, "r", f"id{i:02d}", s, rng.choice([0.9, 0.7, 0.5, 0.3]), rank[s], rng.randint(0, 3), primary, kind, rng.choice(["section:summary", "section:results", "g1", "g2"]), rng.randint(3, 3) + q % 4))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (-r["score"], r["source_rank"], r["source_key"], r["start_line"], r["record_id"]))


def one_by_one(rows, top_k):
    """The focused rules as a loop over all cards of a query."""
    taken, count, prose, groups = [], {}, {}, {}
    for tier in (True, False):
        mine = [r for r in in_order(rows) if r["is_primary"] == tier]
        raw = {r["source_key"] for r in mine if r["evidence_kind"] in ("raw_section", "raw.section")}
        later = {1: [], 2: [], 3: []}
        for r in mine:
            s, is_prose = r["source_key"], r["evidence_kind"] in planner.PROSE
            if len(taken) == top_k:
                break
            if count.get(s, 0) == 3:
                continue
            if r["evidence_kind"] == "compiled_chunk" and s in raw:
                later[2].append(r)
            elif r["evidence_group"] in groups.setdefault(s, set()):
                later[3].append(r)
            elif is_prose and prose.get(s, 0) >= 2:
                later[1].append(r)
            else:
                taken.append(r)
                count[s] = count.get(s, 0) + 1
                prose[s] = prose.get(s, 0) + is_prose
                groups[s].add(r["evidence_group"])
        for r in later[1] + later[2] + later[3]:
            s = r["source_key"]
            if len(taken) < top_k and count.get(s, 0) < 3:
                taken.append(r)
                count[s] = count.get(s, 0) + 1
                prose[s] = prose.get(s, 0) + (r["evidence_kind"] in planner.PROSE)
    return [r["record_id"] for r in taken]


def source_by_source(rows, top_k):
    """The coverage rules as a loop: a card of each new source, then a second one."""
    taken, count = [], {}
    for tier in (True, False):
        mine = [r for r in in_order(rows) if r["is_primary"] == tier]
        for s in dict.fromkeys(r["source_key"] for r in mine):
            if count.get(s) or len(taken) == top_k:
                continue
            own = [r for r in mine if r["source_key"] == s]
            taken.append(next((r for r in own if r["evidence_group"] == "section:summary"), own[0]))
            count[s] = 1
        for r in mine:
            if len(taken) < top_k and r not in taken and count[r["source_key"]] < 2:
                taken.append(r)
                count[r["source_key"]] += 1
    return [r["record_id"] for r in taken]


@pytest.mark.parametrize("select,loop", [(planner.select_focused, one_by_one), (planner.select_coverage, source_by_source)])
def test_selection_equals_the_loop(spark, select, loop):
    rows = cards(11)
    got = {}
    for r in select(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "position").collect():
        got.setdefault(r.query_id, []).append(r.record_id)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(dict(zip(ORDER, r, strict=True)))
    assert got == {q: loop(rs, rs[0]["top_k"]) for q, rs in by.items()}


def test_a_lone_candidate_that_covers_the_query_scores_one(spark):
    row = spark.createDataFrame([(1, 1, 1.0, "raw_section", True, 2)], "route_rank int, source_rank int, quality double, evidence_kind string, is_primary boolean, n_terms int")
    assert planner.scored(row, F.lit(1.0)).first().score == 1.0


def test_apply_equals_rebuild_and_no_change_is_empty(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    b = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "k long, v string")
    assert diff.apply_diff(a, b, "k", "v").exceptAll(b).isEmpty() and b.exceptAll(diff.apply_diff(a, b, "k", "v")).isEmpty()
    assert diff.keyed_diff(a, a, "k", "v").isEmpty()


MD = "intro\n## Motivation\nwhy\n### deep\nmore\n# Top\nstill\n## Results and future work ##\nyes\n\n### Method: x\nhow"


def test_sections(spark):
    got = spark.createDataFrame([(MD,), ("",), (None,)], "t string").select(markdown.sections(F.col("t")).alias("s")).collect()
    assert [(s.level, s.title, s.content) for s in got[0].s] == [(2, "Motivation", "why\n### deep\nmore\n# Top\nstill"), (2, "Results and future work", "yes\n\n### Method: x\nhow")]
    assert got[1].s == [] and got[2].s is None


def test_sections_with_line_ends_of_both_kinds(spark):
    text = "##no\r\n## a ##\r\nx\r\n\r\n#### in\n# top\n### b\r\n## c\r\r\ny\r"
    got = spark.createDataFrame([(text,)], "t string").select(markdown.sections(F.col("t")).alias("s")).first().s
    assert [tuple(s) for s in got] == [(0, 2, "a", "x\n\n#### in\n# top\n### b"), (1, 2, "c", "y\r")]


def test_front_matter(spark):
    doc = "---\ntitle: \"A: b\"\ntags: [x, 'y']\nsources:\n  - p/q.md\n  - \"r\"\n# c\nempty:\ntitle: last\n---\nbody"
    m = spark.createDataFrame([(doc,)], "t string").select(markdown.front_matter(F.col("t")).alias("m"), markdown.body(F.col("t")).alias("b")).first()
    assert m.m == {"title": ["last"], "tags": ["x", "y"], "sources": ["p/q.md", "r"], "empty": []} and m.b == "body"


def test_front_matter_of_many_lines(spark):
    doc = "\n".join([
        "---", "folded: >", "  one", "  two", "", "  three", "", "kept: |-", "    a", "      b # c", "", "    # d", "'quoted key': \"x \\\"y\\\" \\\\n: z\" # gone", "single: 'it''s: # kept'", "plain: a # gone", "url: http://x.org/#a",
        "map:", "  inner: 1", "  deep:", "    leaf: [a, \"b\"]", "  after: 2", "top:", "- i", "-   \"j # k\"", "bare", "none: # nothing", "time: 12:30:00", "end: e", "last: |", "  z", "", "---", "rest",
    ])
    m = spark.createDataFrame([(doc,), ("no front",), ("---\n---\n",), (None,)], "t string").select(markdown.front_matter(F.col("t")).alias("m")).collect()
    assert m[0].m == {
        "folded": ["one two\nthree"], "kept": ["a\n  b # c\n\n# d"], "quoted key": ['x "y" \\n: z'], "single": ["it's: # kept"], "plain": ["a"], "url": ["http://x.org/#a"], "map": [], "map.inner": ["1"], "map.deep": [],
        "map.deep.leaf": ["a", "b"], "map.after": ["2"], "top": ["i", "j # k"], "none": [], "time": ["12:30:00"], "end": ["e"], "last": ["z"],
    }
    assert m[1].m == {} and m[2].m == {} and m[3].m is None


@pytest.mark.parametrize("query,terms", [
    ("The 1,234 cats of A x", ["the", "1234", "cats", "of"]), ("知识图谱 检索增强生成", ["知识图谱", "检索", "索增", "增强", "强生", "生成"]), ("", []), ("aa AA aa", ["aa"])])
def test_query_terms(spark, query, terms):
    assert spark.createDataFrame([(query,)], "q string").select(text.query_terms(F.col("q")).alias("t")).first().t == terms


def test_ids(spark):
    paths = ["index.md", "raw/clip/2401/a-b.md", "concepts/foo.md", "_meta/x.md", "other/y.md"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(ids.canonical_id(F.col("p")).alias("c"), ids.doc_type(F.col("p")).alias("t")).collect()
    assert [r.c for r in got] == ["compiled:index", "raw_clip:a-b", "compiled:concept:foo", "meta:x", "wiki:other/y"]
    assert [r.t for r in got] == ["compiled_index", "raw_note", "compiled_concept", "meta_map", "wiki_markdown"]


def test_relation_keys_reject_the_separator(spark):
    r = spark.createDataFrame([("a", "b", "k"), ("a<SEP>", "b", "k"), ("a", "b", "")], "s string, t string, k string")
    assert [x.r for x in r.select(ids.relation_key(F.col("s"), F.col("t"), F.col("k")).alias("r")).collect()] == ["a<SEP>b<SEP>k", None, None]


def test_mutual_graph_of_five_sections(spark):
    rows = [(0, 0, 6, [1.0, 0.0, 0.0]), (1, 1, 6, [0.99, 0.1, 0.0]), (2, 0, 7, [1.0, 0.01, 0.0]), (3, 2, 8, [0.98, 0.0, 0.1]), (4, 3, 7, [0.0, 0.0, 1.0])]
    frame = spark.createDataFrame(rows, "id long, source long, kind int, v array<double>")
    limits = {(6, 6): (1, 0.9), (6, 8): (1, 0.9), (8, 6): (1, 0.9), (6, 7): (1, 0.9), (7, 6): (1, 0.9)}
    got = {(e.src_id, e.tgt_id, e.pair_kind) for e in knn.mutual_edges(knn.rank_lists(frame, limits, block=2)).collect()}
    assert got == {(0, 1, "6:6"), (0, 3, "6:8"), (1, 2, "6:7")}


def test_blocks_do_not_change_neighbours(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    q = e.where("id % 40 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    one, many = ({(r.query_id, r.id, r.rank) for r in knn.top_k(q, e, 5, block=b).collect()} for b in (10_000, 37))
    assert one == many


def test_vectors(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0], [1.0, 0.0]), (None, [1.0, 0.0])]
    got = spark.createDataFrame(rows, "a array<double>, b array<double>").select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.valid(F.col("a"), 2).alias("v")).collect()
    assert [(r.c, r.v) for r in got] == [(1.0, True), (0.0, False), (0.0, False), (0.0, False)]


def test_excerpt_prefers_the_window_with_the_answer():
    body = "filler " * 100 + "the cache size is 64 entries " + "filler " * 100
    part, begin = excerpt.excerpt(body, ["cache", "size"], 80)
    assert "size is 64" in part and body[begin : begin + 80] == part
    assert excerpt.numeric_cue("has 64", ["size"]) == 2 and excerpt.numeric_cue("has 63", ["size"]) == 1 and excerpt.numeric_cue("64", ["x"]) == 0
    assert excerpt.math_cue("$x < y$", {"x"}, "when is x below y") == 4 and excerpt.math_cue("none", {"x"}, "x") == 0
    assert excerpt.excerpt("short", ["x"], 80) == ("short", 0)


def test_fusion_does_not_depend_on_order(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, doc_id long, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id long, doc_id long, rank int")
    assert search.fused(a, b).exceptAll(search.fused(b, a)).isEmpty()
    assert [r.doc_id for r in search.fused(a, b).orderBy("rank").collect()] == [11, 10, 12]


def test_excerpt_keys_in_order():
    filler = "\n".join(["lorem ipsum dolor sit amet"] * 20)
    two = f"{filler}\ncache alpha\n{filler}\ncache size alpha\n{filler}"
    part, begin = excerpt.excerpt(two, ["cache", "size"], 60)
    assert "cache size" in part and two[begin : begin + len(part)] == part  # more distinct terms before an earlier start
    twice = f"{filler}\nalpha cache\n{filler}\nalpha cache\n{filler}"
    assert excerpt.excerpt(twice, ["cache"], 60)[1] < twice.rindex("cache") - 60  # of equal windows the earliest
    head = f"cache size intro\n{filler}\ncache size\n{filler}"
    assert excerpt.excerpt(head, ["cache", "size"], 60)[1] == 0  # two terms in the first line draw the opening
    long = "x" * 300 + " cache " + "y" * 300
    part, begin = excerpt.excerpt(long, ["cache"], 50)
    assert len(part) == 50 and "cache" in part and long[begin : begin + 50] == part  # inside a line that is longer than the window
    formula = f"{filler}\nbound of T cache\n{filler}\nso cache $T < 3$ holds\n{filler}"
    assert "$T < 3$" in excerpt.excerpt(formula, ["bound", "cache"], 60, "when is T below the cache bound")[0]  # answer cue before terms
    note = f"[LLM_WIKI_RAW_SECTION]\ncache: x\n{filler}\n## Section Content\n{filler}\nthe cache\n{filler}"
    assert excerpt.excerpt(note, ["cache"], 60)[1] > note.index("## Section Content")  # header lines do not rank
    assert excerpt.excerpt(filler, ["absent"], 60) == (filler[:60], 0) and excerpt.excerpt("", ["x"], 60) == ("", 0)


def test_line_run_is_the_best_of_all_runs():
    rnd = random.Random(5)
    for _ in range(200):
        sizes = [rnd.randint(1, 9) for _ in range(rnd.randint(1, 12))]
        found = [set(rnd.sample("abc", rnd.randint(0, 2))) for _ in sizes]
        ends, most = list(itertools.accumulate(sizes)), rnd.randint(1, 25)
        runs = [(len(set().union(*found[i : j + 1])), -i, sum(sizes[i : j + 1]), j) for i in range(len(sizes)) for j in range(i, len(sizes)) if sum(sizes[i : j + 1]) <= most]
        got = excerpt.line_run(ends, found, most)
        if runs:
            best = max(r[0] for r in runs)
            assert len(set().union(*found[got[0] : got[1] + 1])) == best
        else:
            assert got is None


def test_tex_of_sources(spark):
    source = "\n".join([
        r"\documentclass{x}", r"\newcommand{\net}{Net  One}", r"\begin{document}", r"\author{A {B", r" C} D}", r"\section{Main results} % note", r"50\% of \net{} and \networks",
        r"\begin{theorem}[Big]", r"\label{thm:a} x", r"\end{theorem}", "", r"\begin{proof}y\end{proof}", r"\begin{align*}a\label{eq:1}\end{align*}", r"\begin{table*}\caption{T {\bf one}}\end{table*}",
        r"\section{References}", "old", r"\appendix", "more", r"\end{document}",
    ])
    row = spark.createDataFrame([(source,), ("",), (None,)], "t string")
    t = F.col("t")
    got = row.select(*[tex.cards(t, k).alias(k) for k in tex.PATTERNS], tex.reading_view(t).alias("view"), tex.plain(tex.expanded(tex.uncommented(t))).alias("words")).collect()
    c = got[0]
    assert [(x.title, x.line_start, x.line_end) for x in c.section] == [("Main results", 6, 15), ("References", 15, 19)]
    assert [(x.label, x.title, x.line_start, x.line_end) for x in c.statement] == [("thm:a", "Big", 8, 12)]
    assert [(x.name, x.excerpt, x.proof) for x in c.statement] == [("theorem", "thm:a x", "y")]
    assert [(x.name, x.excerpt) for x in c.equation] == [("align", "a")] and [x.excerpt for x in c.section][1] == "old more document"
    assert [x.label for x in c.equation] == ["eq:1"] and [x.title for x in c.table] == ["T one"] and c.figure == []
    assert c.view.startswith("\\section{Main results}\n50\\% of") and "old" not in c.view and c.view.endswith("\\appendix\nmore") and "A {B" not in c.view
    assert "50\\% of Net One and" in c.words and "note" not in c.words
    assert got[1].section == [] and got[1].view == "" and got[1].words == ""


def test_links_and_paths(spark):
    urls = {
        "https://github.com/o/r.git": ("github", "o/r"), "https://github.com/search/r": ("ignored", ""), "https://huggingface.co/spaces/a/b": ("hf", "a/b"), "https://huggingface.co/collections/a": ("ignored", ""),
        "https://x.org/code": ("project_page", ""), "https://arxiv.org/abs/code": ("ignored", ""), "no address": ("ignored", ""), "": ("ignored", ""),
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", links.resource(F.col("u")).alias("r")).collect()
    assert {r.u: tuple(r.r) for r in rows} == urls
    refs = {("a/b/", "../t"): "a/t", ("a/", "../../t"): "", ("a/", "raw/./x//y"): "raw/x/y", ("", "t/../../u"): "", ("a/", "t/../u"): "a/u"}
    rows = spark.createDataFrame([k for k in refs], "f string, r string").select("f", "r", ids.resolved_path(F.col("f"), F.col("r")).alias("p")).collect()
    assert {(r.f, r.r): r.p for r in rows} == refs


def test_reading_view_of_nested_braces():
    cases = {
        "\\author{A {B {C\n{x}} y\n} z}\nkept {\n\\title{T}\\date{\n}\nb": "kept {\nb",
        "\\begin{document}\na\n\\begin{authorlist*}\n\\item {\n\\end{authorlist*}\nb % c\n\\% d \\\\% e": "a\nb\n\\% d \\\\",
        "\\section{ References }\nold\n\\section{Appendix A}\nnew\n\\begin{thebibliography}{9}\nx\n\\end{thebibliography}\nafter\n\\end{document}": "\\section{Appendix A}\nnew\nafter",
        "\\authors\n\\subtitle{S}\n\\inputs{x}\n\\input{x}\n\\defx\n\\mytitle{\n\\} {\n}\n}\n\n\n\nend": "\\inputs{x}\n\\defx\n\nend",
        "\\begin{references}\n\\appendix\n\\end{references}\nz\n\\bibliography{b}": "z",
        "": "",
    }
    assert {source: tex.view_of(source) for source in cases} == cases


def test_sanitised_entities(spark):
    cases = {" &eacute;&#x41;&#65; ": "éAA", "&amp;lt;": "&lt;", "&#xD800;&#0;&copy x": "��© x", "a\x01b\x7f": "ab", "&nosuch; &": "&nosuch; &", "plain": "plain", "": "", None: None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", text.sanitised(F.col("t")).alias("clean")).collect()
    assert {r.t: r.clean for r in rows} == cases


def test_page_queries_equal_their_sql_on_references_that_are_cut_or_unknown_to_it(spark, tmp_path):
    import duckdb

    from lodestack import catalog

    html = ["<footer>x &amp</b> &quot;y&quot; &ampz; &#39 &copy &amp;lt; the &nosuch; & ", "<html><footer><title>Bee &quot;x&quot; &lt; &amp</title><h1>Bee &quot;x&quot; &lt; &amp</h1></html>", "<footer><title>Ee &copy; &amp;amp; y</title><p>A line &#65; of text &amp</p>"]
    spark.createDataFrame([(i, f"https://x.org/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("h07_sanitise", "m06_page_title"):
        want = duck.sql(catalog.oracle_sql()[name]).df()
        got = catalog.queries()[name](spark, str(tmp_path)).toPandas()[list(want.columns)]
        assert sorted(got.astype(str).itertuples(index=False, name=None)) == sorted(want.astype(str).itertuples(index=False, name=None))
    # the operator itself decodes them all, as the standard library does
    one = spark.createDataFrame([("a &amp</b> &quot;b&quot; &copy",)], "t string").select(text.sanitised(F.col("t")))
    assert one.first()[0] == 'a &</b> "b" ©'


def test_slugs_name_each_step_once(spark):
    import re

    rng = random.Random(5)
    texts = ["", "---", " -a", "ä" * 200 + "Z", *("".join(rng.choice("aB9一ä -/\n") for _ in range(rng.randint(0, 300))) for _ in range(60))]

    def want(t, most):
        whole = re.sub("[^0-9A-Za-z一-鿿]+", "-", t).strip("-").lower() or "item"
        return whole[:most].strip("-") or "item"

    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", ids.slug(F.col("t"), 40).alias("s"))
    assert [r.s for r in frame.collect()] == [want(t, 40) for t in texts] + [None]
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 5


def test_brief_cards_are_the_cards_without_their_texts(spark):
    source = r"\section{A \emph{b}} x \begin{theorem}[T]\label{t}y\end{theorem}\begin{proof}z\end{proof}" + "\n" + r"\begin{table}\caption{Score {of} a}\label{u}1 & 2\end{table}\begin{figure}\caption{c}\end{figure}\begin{equation}q\label{e}\end{equation}\subsection{Results}"
    frame = spark.createDataFrame([(source * 3,), ("",), (None,)], "t string")
    for kind in tex.PATTERNS:
        whole, brief = (frame.select(tex.cards(F.col("t"), kind, b).alias("c")) for b in (False, True))
        keys = ("kind", "place", "name", "label", "title")
        assert [[tuple(x[k] for k in keys) for x in r.c or ()] for r in whole.collect()] == [[tuple(x[k] for k in keys) for x in r.c or ()] for r in brief.collect()]
        assert all(x.excerpt is None and x.line_end is None for r in brief.collect() for x in r.c or ())


def test_told_cards_make_their_papers_once(spark, sf):
    from lodestack.plans import papers

    assert papers.told_cards(spark, sf)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_lines_count_the_front_matter_once_for_a_note(spark):
    from lodestack.plans import notes

    md = "---\ntitle: x\n---\na\n\n| b |"
    rows = notes.lines_of(spark.createDataFrame([(1, "p", "raw", md), (2, "q", "raw", "one")], "doc_id long, path string, role string, md string"))
    assert sorted((r.doc_id, r.n, r.line) for r in rows.collect()) == [(1, 4, "a"), (1, 5, ""), (1, 6, "| b |"), (2, 1, "one")]
    above, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
    assert "length(" not in above and "length(" in below


def test_heading_kinds_make_their_key_once(spark):
    titles = ["Method: x", "> **Results** and future work", "Open questions", "nothing", "TLDR limitation", None]
    frame = spark.createDataFrame([(t,) for t in titles], "t string").select(F.array_join(markdown.heading_kinds(F.col("t")), ",").alias("k"))
    assert [r.k for r in frame.collect()] == ["methodology", "results,future", "questions", "", "summary,limitations", ""]
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 4


def test_unescaping_sends_only_references_to_python(spark):
    import html

    rng = random.Random(3)
    bits = ["&", "amp", ";", "#", "38", "x26", "&copy", "&#10;", "&NewLine;", "&notit;", "&nosuch;", " ", "\n", "é", "😀", "lt", "&&amp;", "z" * 40]
    texts = ["", "&", "none", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(120))]
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select(text.unescaped(F.col("t")).alias("u"))
    assert [r.u for r in frame.collect()] == [html.unescape(t) for t in texts] + [None]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "decode(CASE WHEN" in plan and "regexp_extract_all" in plan.split("decode(", 2)[-1].split("\n")[0]


def test_front_matter_sends_only_the_front_to_python(spark):
    texts = ["---\na: 1\n---\n" + "x" * 5000, "---\u00a0\nb: [c, d]\n---\x1c\nrest", "---\na: 1\n---x\nb: 2\n---", "no front " + "x" * 5000, "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.m for r in frame.select(markdown.front_matter(F.col("t")).alias("m")).collect()] == [None if t is None else markdown.front_of(t) for t in texts]
    sent = frame.select(F.length(markdown.front("t")).alias("n")).collect()
    assert [r.n for r in sent] == [13, 20, 22, 0, 0, None]


def test_cards_look_for_each_environment_once(spark):
    """Matches are made once a kind and told from their openings; runs of blanks, not single ones, are rewritten."""
    from lodestack.functions import tex, text

    frame = spark.createDataFrame([("x\\begin{lemma}a  b\\end{lemma}\n y \\begin{claim*}c\\end{claim*} \\begin{lemma}open",), ("",), (None,)], "t string")
    cards = frame.select(tex.cards(F.col("t"), "statement").alias("c"))
    assert [[(x.place, x.name, x.excerpt, x.line_start) for x in r.c or ()] for r in cards.collect()] == [[(1, "lemma", "a b", 1), (2, "claim", "c", 2)], [], []]
    assert cards._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
    blanks = spark.createDataFrame([(" a b\t c\n\nd\u00a0 e\x0b",)], "t string").select(text.squeeze(F.col("t")).alias("s"))
    assert blanks.first().s == "a b c d\u00a0 e"
    many = spark.createDataFrame([("\\begin{table}x\\end{table}\n" * 45,)], "t string").select(tex.cards(F.col("t"), "table").alias("c")).first().c
    assert [(x.place, x.line_start) for x in many] == [(i, i) for i in range(1, 41)]


def test_plain_words_cut_comments_once(spark, sf):
    from lodestack.plans import papers

    assert papers.plain_words(spark, sf)._jdf.queryExecution().optimizedPlan().toString().count("%[^") == 1


def test_embedding_text_of_odd_texts_equals_its_sql(spark, tmp_path):
    import duckdb

    from lodestack.plans import columns

    texts = ["", None, " \n\t", "　", " a  b　 ", "a\x0bb\x0c\n c", "\x0b", "\r\n- a\r", "x" * 5999 + " y", "x" * 5999 + "  y", "\U0001f600 " * 4000, "a.md"]
    rows = [(i, t, (None, "en", "")[i % 3], (None, "src")[i % 2], 0) for i, t in enumerate(texts)]
    at = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(at)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{at}/*.parquet'")
    got = {r.doc_id: r.embedding_text for r in columns.QUERIES["h23_embedding_text"](spark, str(tmp_path)).collect()}
    assert got == dict(con.sql(columns.SQL["h23_embedding_text"]).fetchall())
