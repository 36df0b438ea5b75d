"""Main files of TeX projects against plain rules."""

import random
import re

from lodestack.operators.main_file import main_files

PARTS = (
    "\\begin{document}", "\\begin{abstract}", "\\Abstract ", "\\maketitle", "\\title{A b}", "\\title[x]{ }", "\\title {\\bf x}", "\\section*{One}\n", "\\subsection{Two}\n",
    "\\input{a}", "\\include {b}", "plain words of prose " * 5, "plain words of prose " * 12, "% remark \\section{no}\n", "\\emph[o]{gone} ", "方法 和 words ", "\\end{document}",
)
NAMES = ("main.tex", "a/paper.tex", "x_main.tex", "main_v2.tex", "main/x.tex", "remain.tex", "intro.tex", "appendix/main.tex", "macros.tex", "Sub/MS.tex", "z.tex", "b.tex")


def plainly(path, tex):
    low, name = path.lower(), path.lower().split("/")[-1]
    main = name in ("main.tex", "paper.tex", "article.tex", "ms.tex", "manuscript.tex") or name.endswith("_main.tex") or name.startswith("main_") or "/main" in low
    support = any(w in low for w in ("defs", "macro", "preamble", "supplement", "appendix"))
    prose = re.sub(r"%.*", " ", tex)
    prose = re.sub(r"\\begin\{[^{}]+\}|\\end\{[^{}]+\}", " ", prose)
    prose = re.sub(r"\\[A-Za-z]+\*?(\[[^\]]*\])?(\{[^{}]*\})?", " ", prose)
    prose = min(20000, len(re.sub(r"[^A-Za-z0-9一-鿿]+", " ", prose).strip()))
    sections, includes = len(re.findall(r"\\(?:sub)*section\*?\{", tex)), len(re.findall(r"\\(?:input|include)\s*\{", tex))
    document, made = "\\begin{document}" in tex, "\\maketitle" in tex
    abstract, title = bool(re.search(r"\\begin\{abstract\}|\\abstract\b", tex, re.I)), bool(re.search(r"\\title\s*(\[[^\]]*\]\s*)?\{\s*[^\s{}]", tex))
    score = prose // 80 + 20 * sections + 15 * includes + 100 * document + 80 * abstract + 20 * made + 20 * title
    body = prose >= 120 and (document or abstract or sections >= 2)
    usable = (body and (score >= 120 or main)) or (main and includes > 0 and (document or title))
    pool = 2 if support else 0 if main or document or abstract or title else 1
    return usable, (pool, -score, -prose, path)


def test_main_files_like_plain_rules(spark):
    draw = random.Random(11)
    rows = [(f"p{p}", name, "".join(draw.choice(PARTS) for _ in range(draw.randrange(0, 14)))) for p in range(60) for name in draw.sample(NAMES, draw.randrange(1, 5))]
    rows += [("plain", "intro.tex", "\\section{a} " * 6 + PARTS[12]), ("plain", "appendix/main.tex", "\\begin{document}" + PARTS[12])]
    want = {}
    for project, path, tex in rows:
        usable, key = plainly(path, tex)
        if usable:
            best, n = want.get(project, (key, 0))
            want[project] = (min(best, key), n + 1)
    odd = [(None, "main.tex", "x" * 500), ("p", None, "x"), ("null", "main.tex", None), ("long", "main.tex", "word " * 100000 + "\\section{a}\\section{b}")]
    got = {r.project: r for r in main_files(spark.createDataFrame(rows + odd, "project string, path string, tex string")).collect()}
    assert got.pop("long").prose == 20000
    assert {k: (("preferred_main", "non_support", "all_usable").index(r.pool), -r.score, -r.prose, r.path) for k, r in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: r.usable_files for k, r in got.items()} == {k: v[1] for k, v in want.items()}
    assert {r.pool for r in got.values()} == {"preferred_main", "non_support", "all_usable"}
    assert main_files(spark.createDataFrame([], "project string, path string, tex string")).count() == 0
