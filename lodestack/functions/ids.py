"""Identifiers, paths and hashes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folders of compiled pages and their types; section, source and record codes; entity types by id prefix.
COMPILED_TYPES = {"entities": "entity", "concepts": "concept", "comparisons": "comparison", "queries": "query"}
RECORD_CODES = {"chunk": 1, "entity": 2, "relationship": 3, "section": 4}
SOURCE_CODES = {"compiled": 1, "raw": 2, "generated": 3, "debug": 4}
SECTION_CODES = {
    "none": 0, "summary": 1, "abstract": 2, "motivation": 3, "methodology": 4, "results": 5,
    "future": 6, "limitations": 7, "questions": 8, "other": 99,
}
ENTITY_PREFIXES = {
    "compiled:": "LLM_WIKI_PAGE", "raw_section:": "LLM_WIKI_RAW_SECTION", "raw_clip:": "LLM_WIKI_RAW", "raw:": "LLM_WIKI_RAW",
    "tag:": "LLM_WIKI_TAG", "method_atom:": "LLM_WIKI_METHOD_ATOM", "method:": "LLM_WIKI_METHOD_ATOM",
}
ROOTS = ("raw", "entities", "concepts", "comparisons", "queries", "_meta")  # folders that a reference may begin at
SEPARATOR = "<SEP>"


def code_of(name: Column, codes: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])[name]


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def _folder(path: Column) -> tuple[Column, Column, Column]:
    parts = F.split(path, "/")
    return F.size(parts), parts[0], F.get(parts, F.lit(1))


def _compiled(first: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in COMPILED_TYPES.items() for x in kv])[first]


def canonical_id(path: Column) -> Column:
    n, first, second = _folder(path)
    kind = _compiled(first)
    return (
        F.when(path == "index.md", "compiled:index")
        .when((n >= 3) & (first == "raw") & (second == "clip"), F.concat(F.lit("raw_clip:"), stem(path)))
        .when((n >= 2) & kind.isNotNull(), F.concat(F.lit("compiled:"), kind, F.lit(":"), stem(path)))
        .when((n >= 2) & (first == "_meta"), F.concat(F.lit("meta:"), stem(path)))
        .otherwise(F.concat(F.lit("wiki:"), F.regexp_replace(path, r"\.md$", "")))
    )


def doc_type(path: Column) -> Column:
    n, first, second = _folder(path)
    kind = _compiled(first)
    return (
        F.when(path == "index.md", "compiled_index")
        .when((n >= 3) & (first == "raw") & (second == "clip"), "raw_note")
        .when((n >= 2) & kind.isNotNull(), F.concat(F.lit("compiled_"), kind))
        .when((n >= 2) & (first == "_meta"), "meta_map")
        .otherwise("wiki_markdown")
    )


def role_of_type(kind: Column) -> Column:
    return (
        F.when(kind == "raw_note", "raw").when(kind == "meta_map", "meta_map").when(kind.startswith("compiled"), "compiled")
        .when(kind.startswith("raw_section"), "raw").otherwise("wiki")
    )


def role_of_path(path: Column) -> Column:
    compiled = path == "index.md"
    for folder in COMPILED_TYPES:
        compiled = compiled | path.startswith(folder + "/")
    return F.when(path.startswith("_meta/"), "meta_map").when(path.startswith("raw/"), "raw").when(compiled, "compiled").otherwise("unknown")


def entity_type(node: Column) -> Column:
    out = F.when(F.lit(False), "")
    for prefix, kind in ENTITY_PREFIXES.items():
        out = out.when(node.startswith(prefix), kind)
    return out.otherwise("LLM_WIKI_NODE")


def slug(text: Column, most: int = 80) -> Column:
    """Lower-case runs of letters, digits and CJK joined by dashes, cut to `most`; 'item' if nothing is left."""
    # the first `most` characters that stay decide, so that the rest of a long text is not rewritten; each step is named once, so that none runs twice
    opening = F.regexp_extract(text, f"^(?:[^0-9A-Za-z一-鿿]*+[0-9A-Za-z一-鿿]){{0,{most}}}", 0)
    dashed = F.lower(F.regexp_replace(F.regexp_replace(opening, "[^0-9A-Za-z一-鿿]+", "-"), "^-+|-+$", ""))
    cut = F.regexp_replace(F.substring(F.regexp_replace(dashed, "^$", "item"), 1, most), "^-+|-+$", "")
    return F.regexp_replace(cut, "^$", "item")


def sha(text: Column, digits: int = 64) -> Column:
    return F.substring(F.sha2(text, 256), 1, digits)


def md5_id(text: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.md5(text))


def generated_name(identifier: Column, most: int = 120) -> Column:
    return F.concat(slug(F.replace(identifier, F.lit(":"), F.lit("_")), most), F.lit("-"), sha(identifier, 12), F.lit(".md"))


def index_doc_id(kind: Column, identifier: Column) -> Column:
    """kind__base64url(identifier) without padding, or kind__sha256[:32] where that is longer than 64."""
    encoded = F.rtrim(F.translate(F.base64(identifier.cast("binary")), "+/=\r\n", "-_"))
    whole = F.concat(kind, F.lit("__"), encoded)
    return F.when(F.length(whole) <= 64, whole).otherwise(F.concat(kind, F.lit("__"), sha(identifier, 32)))


def relation_key(source: Column, target: Column, keywords: Column) -> Column:
    """The three parts joined by the reserved separator; null where a part holds it or keywords are empty."""
    bad = F.lit(False)
    for part in (source, target, keywords):
        bad = bad | F.contains(part, F.lit(SEPARATOR))
    return F.when(~bad & (F.coalesce(keywords, F.lit("")) != ""), F.concat_ws(SEPARATOR, source, target, keywords))


def relation_id(source: Column, target: Column, keywords: Column) -> Column:
    return md5_id(relation_key(source, target, keywords), "rel-")


def basename(path: Column) -> Column:
    """Last part of a path without [tags] before the suffix; unknown_source where there is none."""
    name = F.trim(F.element_at(F.split(F.regexp_replace(F.trim(F.coalesce(path, F.lit(""))), r"\\", "/"), "/"), -1))
    name = F.regexp_replace(name, r"\.\[[^\]]+\](?=\.)", "")
    return F.when(F.lower(name).isin("", "unknown_source", "no-file-path", "none", "null"), "unknown_source").otherwise(name)


def source_key(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def resolved_path(folder: Column, ref: Column) -> Column:
    """ref from a folder (or from the root, if it begins at one of ROOTS) as a path below the root; '' if it leads above.

    '..' goes up, '.' and empty parts vanish.
    """
    up = F.lit("..")
    parts = F.split(F.concat(F.when(F.split(ref, "/")[0].isin(*ROOTS), "").otherwise(folder), ref), "/")

    def step(acc, x):
        higher = F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.array(up))
        return F.when(F.array_contains(acc, up), acc).when(x == "..", higher).when(x.isin("", "."), acc).otherwise(F.array_append(acc, x))

    found = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.when(F.array_contains(found, up), "").otherwise(F.array_join(found, "/"))
