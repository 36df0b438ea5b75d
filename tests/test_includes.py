"""The include walk against a recursive depth-first loop."""

import random
import re

import pytest

from lodestack.operators import includes

FILES = "project string, path string, tex string"


def depth_first(files, root):
    """Units in order, cycles and unresolved names, as a reader with a stack meets them."""
    units, told, visited, stack = [], [], set(), []

    def visit(path, parent, role):
        if path in stack or path in visited:
            return
        visited.add(path)
        stack.append(path)
        units.append(("unit", path, parent, role, len(units)))
        child = role
        for place, m in enumerate(re.finditer(r"\\appendix\b|\\(?:input|include)\s*\{([^{}]+)\}", files[path])):
            if m[0].startswith("\\appendix"):
                child = "appendix"
                continue
            name = re.sub(r"^(\./)+", "", m[1].strip())
            if re.match("^[a-zA-Z][a-zA-Z0-9+.-]*://", name):
                told.append(("include_unresolved", path, m[1], "remote_url", place))
                continue
            if name.startswith("/") or ".." in name.split("/"):
                told.append(("include_unresolved", path, m[1], "path_traversal", place))
                continue
            file = name if name.lower().endswith(".tex") else name + ".tex"
            found = next((f for f in (path.rpartition("/")[0] + "/" + file if "/" in path else file, file) if f in files), None)
            if found is None:
                told.append(("include_unresolved", path, m[1], "unsupported_extension" if "." in name.rpartition("/")[2].lstrip(".") and not name.lower().endswith(".tex") else "missing_source", place))
            elif found in stack:
                told.append(("cycle", path, found, "", place))
            else:
                visit(found, path, child)
        stack.pop()

    visit(root, "", "body")
    return sorted(units + told)


def check(spark, projects):
    rows = [(p, path, tex) for p, files in projects.items() for path, tex in files.items()]
    frame = spark.createDataFrame(rows, FILES)
    roots = spark.createDataFrame([(p, "main.tex") for p in projects], "project string, path string")
    got = {}
    for r in includes.walk(frame, roots).collect():
        got.setdefault(r.project, []).append((r.kind, r.path, r.other, r.role, r.number))
    assert {p: sorted(x) for p, x in got.items()} == {p: depth_first(files, "main.tex") for p, files in projects.items()}


def test_a_diamond_whose_deep_path_comes_first(spark):
    deep = {"main.tex": r"\input{a} \input{d} \appendix \include{e}", "a.tex": r"\input{b}", "b.tex": r"\input{c}\input{main}", "c.tex": r"\input{d}", "d.tex": r"\include{a} \appendix\input{f.tex}", "e.tex": r"\input{f}\input{x}", "f.tex": ""}
    names = {"main.tex": r"\input{ sub/one } \input{../up} \input{http://x.org/a} \input{fig.eps} \input{/abs} \input{v1.2} \include {sub/one}", "sub/one.tex": r"\input{two}\input{main}\input{./two.tex}", "sub/two.tex": "", "two.tex": r"\input{never}", "v1.2.tex": r"\appendixes \input{gone}"}
    check(spark, {"deep": deep, "names": names, "alone": {"main.tex": ""}})


@pytest.mark.parametrize("seed", [1, 2])
def test_random_projects(spark, seed):
    rng = random.Random(seed)
    projects = {}
    for p in range(12):
        names = ["main", *"abcdefgh"]
        projects[f"p{p}"] = {f"{n}.tex": "".join(rng.choice(["\\appendix ", "\\input{%s}", "\\include{%s}"]).replace("%s", rng.choice([*names, "zz"])) for _ in range(rng.randint(0, 4))) for n in names}
    check(spark, projects)


def test_a_chain_of_many_files_takes_few_jobs(spark):
    n = 300
    chain = {"main.tex": r"\input{f0}", **{f"f{i}.tex": rf"\input{{f{i + 1}}}\input{{f{i // 2}}}" for i in range(n)}, f"f{n}.tex": r"\input{main}"}
    rows = spark.createDataFrame([("p", path, tex) for path, tex in chain.items()], FILES)
    spark.sparkContext.setJobGroup("chain", "")
    got = includes.walk(rows, spark.createDataFrame([("p", "main.tex")], "project string, path string")).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [r.path for r in sorted(got, key=lambda r: r.number) if r.kind == "unit"] == list(chain)
    assert sum(r.kind == "cycle" for r in got) == n + 1
    assert len(jobs) < 60
