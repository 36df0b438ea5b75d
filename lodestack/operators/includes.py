r"""Files that TeX sources include, followed from their main files.

Commands \input and \include are read from the texts, in order; what follows \appendix in a file belongs
to the appendix, and so does all that is included from there. Reading, looking up names and telling
what was met are joins over all files. The order of a depth-first walk can't be found in
parallel, and its paths are nearly as long as a project has files: each project's includes go to one
task for it, as numbers, each pair of files once; a file's place in the walk and the last
place below it then tell which files are on its trail.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.sources.tables import stored

EVENTS = r"\\appendix\b|\\(?:input|include)\s*\{([^{}]+)\}"


def events(files: DataFrame) -> DataFrame:
    """(project, path, place, include, appendix): include commands of files (project, path, tex) in order, place counting \\appendix too."""
    whole, name = (F.regexp_extract_all("tex", F.lit(EVENTS), F.lit(g)) for g in (0, 1))
    first = F.array_position(F.transform("whole", lambda e: F.when(e.startswith("\\appendix"), 1).otherwise(0)), 1)
    rows = files.select("project", "path", whole.alias("whole"), name.alias("name")).withColumn("first", first)
    rows = rows.select("project", "path", "first", F.posexplode("name").alias("place", "include")).where("include <> ''")
    return rows.select("project", "path", "place", "include", ((F.col("first") > 0) & (F.col("place") >= F.col("first"))).alias("appendix"))


def _with_suffix(name: Column) -> Column:
    """A file name as TeX looks it up: .tex is added unless it is there."""
    return F.when(F.lower(name).endswith(".tex"), name).otherwise(F.concat(name, F.lit(".tex")))


def resolved(found: DataFrame, files: DataFrame) -> DataFrame:
    """`found` with target (a path of the project, null if there is none) and reason: remote_url, path_traversal, unsupported_extension or missing_source.

    A name is looked for beside the including file, then at the root of the project.
    """
    name = F.regexp_replace(F.trim("include"), r"^(?:\./)+", "")
    parts = F.split("name", "/")
    refused = F.when(F.col("name").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), "remote_url").when(F.col("name").startswith("/") | F.array_contains(parts, ".."), "path_traversal")
    suffix = F.regexp_extract("name", r"[^/]\.([^./]+)$", 1)
    missing = F.when((suffix != "") & (F.lower(suffix) != "tex"), "unsupported_extension").otherwise("missing_source")
    rows = found.withColumn("name", name).withColumn("refused", refused)
    rows = rows.withColumn("near", F.concat(F.regexp_extract("path", "^(?:.*/)?", 0), _with_suffix(F.col("name")))).withColumn("far", _with_suffix(F.col("name")))
    known = files.select("project", F.col("path").alias("there"))
    for side in ("near", "far"):
        there = known.select(F.col("project").alias(f"_{side}p"), F.col("there").alias(f"_{side}"))
        rows = rows.join(there, (F.col("project") == F.col(f"_{side}p")) & (F.col(side) == F.col(f"_{side}")), "left")
    target = F.when(F.col("refused").isNull(), F.coalesce("_near", "_far"))
    return rows.select("project", "path", "place", "include", "appendix", target.alias("target"), F.when(target.isNull(), F.coalesce("refused", missing)).alias("reason"))


def _visited(roots: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """Files of one project in the order in which a depth-first walk from each root meets them."""
    edges = edges.sort_values(["source", "place"])
    nodes = np.unique(np.concatenate([roots["id"], edges["source"], edges["target"]]).astype("int64"))
    begins = np.searchsorted(nodes.searchsorted(edges["source"]), np.arange(len(nodes) + 1)).tolist()
    targets, appendix = nodes.searchsorted(edges["target"]).tolist(), edges["appendix"].tolist()
    out = []
    for root in nodes.searchsorted(roots["id"]).tolist():
        number, last, later, parent = np.full(len(nodes), -1), np.zeros(len(nodes), "int64"), np.zeros(len(nodes), bool), np.full(len(nodes), -1)
        following, stack, met = begins[:-1], [root], 1
        number[root] = 0
        while stack:
            at = stack[-1]
            edge = following[at]
            if edge == begins[at + 1]:
                last[at] = met - 1
                stack.pop()
                continue
            following[at] += 1
            there = targets[edge]
            if number[there] < 0:
                number[there], later[there], parent[there] = met, later[at] or appendix[edge], nodes[at]
                stack.append(there)
                met += 1
        seen = number >= 0
        out.append(pd.DataFrame({"root_id": nodes[root], "id": nodes[seen], "parent_id": parent[seen], "appendix": later[seen], "number": number[seen], "last": last[seen]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["root_id", "id", "parent_id", "appendix", "number", "last"])


def closure(roots: DataFrame, edges: DataFrame, files: DataFrame) -> DataFrame:
    """(project, root, path, role, parent, number, last): every file met from the main files (project, path) of `files`.

    number is a file's place in the walk from its root, last the last place among the files met below it.
    """
    names = stored(files.select("project", "path").distinct().withColumn("id", F.monotonically_increasing_id()))
    source, target = (names.select("project", F.col("path").alias(k), F.col("id").alias(f"{k}_id")) for k in ("path", "target"))
    pairs = edges.where("target IS NOT NULL").groupBy("project", "path", "target").agg(F.min(F.struct("place", "appendix")).alias("e"))
    pairs = pairs.join(source, ["project", "path"]).join(target, ["project", "target"]).select("project", F.col("path_id").alias("source"), F.col("target_id").alias("target"), "e.place", "e.appendix")
    begin = roots.select("project", "path").distinct().join(names, ["project", "path"]).select("project", "id")

    def visit(roots: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        return _visited(roots, edges)

    met = begin.groupBy("project").cogroup(pairs.groupBy("project")).applyInPandas(visit, "root_id long, id long, parent_id long, appendix boolean, number long, last long")
    root, parent = (names.select(F.col("id").alias(f"{k}_id"), F.col("path").alias(k)) for k in ("root", "parent"))
    return met.join(names, "id").join(root, "root_id").join(parent, "parent_id", "left").select(
        "project", "root", "path", F.when(F.col("appendix"), "appendix").otherwise("body").alias("role"), F.coalesce("parent", F.lit("")).alias("parent"), "number", "last",
    )


def walk(files: DataFrame, roots: DataFrame) -> DataFrame:
    """(project, root, kind, path, other, role, number): units in the order of the walk, then what went wrong.

    A unit's other is the file that includes it, its number its place in the walk (from 0); a cycle's other is
    the file met again; an include_unresolved has the name as it stands, and the reason as role. number of
    these is the place in the file. Files that no main file meets are not told.
    """
    edges = stored(resolved(events(files), files))
    units = stored(closure(roots, edges, files))
    told = units.select("project", "root", F.lit("unit").alias("kind"), "path", F.col("parent").alias("other"), "role", "number")
    met = units.select("project", "root", "path", "number").join(edges, ["project", "path"])
    again = units.select("project", "root", F.col("path").alias("target"), F.col("number").alias("_first"), F.col("last").alias("_last"))
    cycles = met.join(again, ["project", "root", "target"]).where("number BETWEEN _first AND _last")
    cycles = cycles.select("project", "root", F.lit("cycle"), "path", "target", F.lit(""), F.col("place").cast("long"))
    lost = met.where("target IS NULL").select("project", "root", F.lit("include_unresolved"), "path", "include", "reason", F.col("place").cast("long"))
    return told.union(cycles).union(lost).toDF("project", "root", "kind", "path", "other", "role", "number")
