"""Registered queries of records, snapshots, differences and coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestack.functions import ids, vectors
from lodestack.operators import diff, order, records, relocation, search, vector_fill
from lodestack.plans.columns import CID, DOCS, TYPE
from lodestack.sources.tables import conversations_markdown, corpus, read, scratch, stored

SQL: dict = {}


def records_of(spark, d):
    """One record for each document: id, type by language, hashes."""
    c = corpus(spark, d)
    kind = F.when(F.col("lang") == "en", "chunk").when(F.col("lang") == "fr", "entity").when(F.col("lang") == "de", "relationship").otherwise("section")
    return c.select(
        kind.alias("record_type"), ids.canonical_id(F.col("path")).alias("record_id"), "doc_id", "path", "source", F.md5("text").alias("content_hash"),
        F.md5(F.concat_ws("|", "path", "source")).alias("metadata_hash"),
    )


KIND = "CASE lang WHEN 'en' THEN 'chunk' WHEN 'fr' THEN 'entity' WHEN 'de' THEN 'relationship' ELSE 'section' END"
REC = DOCS + f", rec AS (SELECT {KIND} AS record_type, {CID} AS record_id, doc_id, path, source, md5(text) AS content_hash, md5(concat_ws('|',path,source)) AS metadata_hash, text FROM d) "


def native_records(spark, d):
    return records_of(spark, d).select("record_type", "record_id", "content_hash", "metadata_hash")


SQL["j07_native_records"] = SQL["a13_index_scan"] = REC + "SELECT record_type, record_id, content_hash, metadata_hash FROM rec"


def snapshot(spark, d):
    """Records, vectors and edges written as one snapshot of partitioned tables, then counted from what was written."""
    at = scratch(spark)
    records_of(spark, d).write.partitionBy("record_type").parquet(f"{at}/records")
    v = read(spark, d, "embeddings")
    v.where(vectors.valid(F.col("embedding"))).select("vec_id", "embedding", F.col("label").alias("kind")).write.parquet(f"{at}/vectors")
    written = spark.read.parquet(f"{at}/records").groupBy("record_type").agg(F.count(F.lit(1)).alias("rows"))
    return written.unionByName(spark.read.parquet(f"{at}/vectors").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("vector").alias("record_type"), "rows"))


SQL["a11_snapshot"] = REC + "SELECT record_type, count(*) AS rows FROM rec GROUP BY 1 UNION ALL SELECT 'vector', count(*) FROM embeddings"


def jsonl(spark, d):
    """conversations written as JSON lines with sorted keys and read again under a schema; bad rows are an error."""
    at = scratch(spark)
    c = read(spark, d, "conversations")
    c.select(*sorted(c.columns)).write.json(at)
    return spark.read.schema(c.schema).option("mode", "FAILFAST").json(at).groupBy("role").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars"))


SQL["a02_jsonl"] = "SELECT role, count(*) AS rows, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1"


def strict_jsonl(spark, d):
    """Lines of JSON artifacts that are no objects, by file and line: a file holds the properties of a day's events; words of digits spoil some."""
    line = F.regexp_replace("props", ": 7", ": 07")  # no number has a leading zero
    line = F.regexp_replace(F.regexp_replace(line, r"4\}$", "4"), r"^(\{.*: 5.*\})$", "[$1]")
    e = read(spark, d, "events").select("ts", "event_id", F.date_format("ts", "yyyy-MM-dd").alias("file"), line.alias("line"))
    lines = order.running_number(e, ["file"], ["ts", "event_id"], "line_no")
    parsed = F.from_json("line", "k INT, _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    reason = F.when(F.trim("line").startswith("["), "not_an_object").when(parsed["_corrupt_record"].isNotNull(), "not_json")
    return lines.select("file", "line_no", reason.alias("reason")).where("reason IS NOT NULL")


SQL["a03_strict_jsonl"] = r"""SELECT file, line_no, CASE WHEN NOT json_valid(line) THEN 'not_json' ELSE 'not_an_object' END AS reason FROM (
 SELECT strftime(ts, '%Y-%m-%d') AS file, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS line_no, regexp_replace(regexp_replace(regexp_replace(props, ': 7', ': 07'), '4\}$', '4'), '^(\{.*: 5.*\})$', '[\1]') AS line FROM events)
WHERE NOT json_valid(line) OR json_type(CASE WHEN json_valid(line) THEN line ELSE '{}' END) <> 'OBJECT'"""


def manifest_load(spark, d):
    """Manifest objects of chunk records parsed as maps and exploded: one object for a language's rows of 1000 ids, so that none grows with the corpus."""
    c = corpus(spark, d).groupBy("lang", F.floor(F.col("doc_id") / 1000).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("chunk-"), F.col("doc_id").cast("string")), F.struct("source", "n_chars"))))).alias("manifest"))
    parsed = F.from_json("manifest", "map<string, struct<source: string, n_chars: long>>")
    return c.select("lang", F.explode(parsed).alias("key", "r")).select("lang", "key", "r.source", "r.n_chars")


SQL["a04_manifest_load"] = "SELECT lang, concat('chunk-', doc_id) AS key, source, n_chars FROM documents"


def corpus_scan(spark, d):
    """Documents written as Markdown rows under their folders and read back, each path once, indexes and maps first."""
    at = scratch(spark)
    c = corpus(spark, d)
    c.select(F.regexp_extract("path", "^([^/]+)", 1).alias("folder"), "path", "text").write.partitionBy("folder").parquet(at)
    back = spark.read.parquet(at).dropDuplicates(["path"])
    place = F.when(F.col("folder") == "_meta", 0).when(F.col("folder") == "raw", 2).otherwise(1)
    return back.select("path", ids.doc_type(F.col("path")).alias("doc_type"), place.alias("place"), ids.sha(F.col("text")).alias("sha256"))


SQL["a01_corpus_scan"] = DOCS + f"SELECT path, {TYPE} AS doc_type, CASE split_part(path,'/',1) WHEN '_meta' THEN 0 WHEN 'raw' THEN 2 ELSE 1 END AS place, sha256(text) AS sha256 FROM d"


def embedding_read(spark, d):
    """Vectors cast to float, invalid ones left out."""
    e = read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<float>").alias("v"))
    return e.where(vectors.valid(F.col("v"))).select("vec_id", F.size("v").alias("dim"), F.round(vectors.norm(F.col("v")), 4).alias("norm"))


SQL["a05_embedding_read"] = "SELECT vec_id, len(embedding)::INTEGER AS dim, round(sqrt(list_inner_product(embedding::DOUBLE[],embedding::DOUBLE[])),4) AS norm FROM embeddings"


def upserted(spark, d):
    """A vector table with some rows replaced and some added, by key."""
    e = read(spark, d, "embeddings").select("vec_id", "label")
    more = e.where("vec_id % 4 = 0").select("vec_id", (F.col("label") + 100).alias("label")).unionByName(e.where("vec_id % 10 = 0").select((F.col("vec_id") + 1000000).alias("vec_id"), "label"))
    return diff.upsert(e, more, ["vec_id"]).select("vec_id", F.col("label").cast("int").alias("label"))


for _n in ("a06_embedding_upsert", "a09_bulk_upsert"):
    SQL[_n] = "SELECT vec_id, (CASE WHEN vec_id % 4 = 0 THEN label+100 ELSE label END)::INTEGER AS label FROM embeddings UNION ALL SELECT vec_id + 1000000, label::INTEGER FROM embeddings WHERE vec_id % 10 = 0"


def cache_write(spark, d):
    """A vector cache keyed by hash: valid vectors, the last of equal keys, with a checksum."""
    e = read(spark, d, "embeddings").where(vectors.valid(F.col("embedding"), 64))
    keyed = e.select(F.md5((F.col("vec_id") % 300).cast("string")).alias("vector_hash"), "vec_id", F.size("embedding").alias("dim"))
    return diff.latest(keyed, ["vector_hash"], [F.col("vec_id")])


SQL["a07_cache_write"] = "SELECT md5((vec_id % 300)::VARCHAR) AS vector_hash, max(vec_id) AS vec_id, 64::INTEGER AS dim FROM embeddings GROUP BY vec_id % 300"


def deleted(spark, d):
    r = records_of(spark, d)
    return diff.delete(r, r.join(read(spark, d, "documents").where(F.col("text").rlike(GONE)), "doc_id", "left_semi").select("record_type", "record_id"), ["record_type", "record_id"]).groupBy("record_type").agg(F.count(F.lit(1)).alias("rows"))


SQL["a10_keyed_delete"] = REC + "SELECT record_type, count(*) AS rows FROM rec WHERE NOT regexp_matches(coalesce(text, ''), '^[A-D]') GROUP BY 1"


def rendered(spark, d):
    """Turns as bracketed section documents: header lines, then the body."""
    c = read(spark, d, "conversations")
    return c.select("conv_id", "turn", F.concat_ws("\n", F.lit("[LLM_WIKI_RAW_SECTION]"), F.concat(F.lit("section_id: s"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")), F.concat(F.lit("section_kind: "), F.col("role")), F.lit("[/LLM_WIKI_RAW_SECTION]"), F.lit(""), F.col("text")).alias("doc"))


SQL["a17_render"] = "SELECT conv_id, turn, concat('[LLM_WIKI_RAW_SECTION]', chr(10), 'section_id: s', conv_id, '-', turn, chr(10), 'section_kind: ', role, chr(10), '[/LLM_WIKI_RAW_SECTION]', chr(10), chr(10), text) AS doc FROM conversations"


def generated_scan(spark, d):
    """Ids of rendered documents, read from their header lines."""
    return rendered(spark, d).select("conv_id", "turn", F.trim(F.regexp_extract("doc", r"(?m)^section_id:\s*(.+)$", 1)).alias("section_id"))


SQL["a08_generated_scan"] = "SELECT conv_id, turn, concat('s', conv_id, '-', turn) AS section_id FROM conversations"


# --- knowledge graph -----------------------------------------------------------------------
def _chunks(spark, d):
    return records.chunks(read(spark, d, "documents").select(F.col("source").alias("source_id"), F.col("text").alias("content"), F.col("doc_id").alias("ord")))


def chunk_rows(spark, d):
    return _chunks(spark, d).select("chunk_id", F.array_join("sources", ",").alias("sources"), "last_source")


CLEAN = "trim(replace(replace(replace(replace(replace(trim(text),'&lt;','<'),'&gt;','>'),'&quot;','\"'),'&#39;',''''),'&amp;','&'))"
SQL["d05_chunk_dedupe"] = f"SELECT concat('chunk-', md5(c)) AS chunk_id, array_to_string(list_sort(list(DISTINCT source)),',') AS sources, arg_max(source, doc_id) AS last_source FROM (SELECT *, {CLEAN} AS c FROM documents) WHERE c <> '' GROUP BY c"


def entity_rows(spark, d):
    """Entities by name, the last of a name; names are languages and sources."""
    r = read(spark, d, "documents").select(F.concat(F.lit("tag:"), F.col("source")).alias("entity"), F.col("lang").alias("description"), F.col("doc_id").alias("ord"))
    return records.last_wins(r, ["entity"]).select("entity", "description", ids.entity_type(F.col("entity")).alias("entity_type"))


SQL["d06_last_wins"] = "SELECT concat('tag:', source) AS entity, arg_max(lang, doc_id) AS description, 'LLM_WIKI_TAG' AS entity_type FROM documents GROUP BY source"


def default_rows(spark, d):
    r = read(spark, d, "pages").select((F.col("page_id") % 40).alias("node"), "url", F.col("page_id").alias("ord"))
    return records.first_wins(r, ["node"]).select("node", "url")


SQL["d07_first_wins"] = "SELECT page_id % 40 AS node, arg_min(url, page_id) AS url FROM pages GROUP BY 1"


def relationships(spark, d):
    """Document-to-tag relationships with typed keys, their source resolved to a chunk."""
    c = corpus(spark, d)
    r = c.select(ids.canonical_id(F.col("path")).alias("src_id"), F.concat(F.lit("tag:"), F.col("lang")).alias("tgt_id"), F.lit("HAS_TAG").alias("keywords"), F.when(F.col("doc_id") % 6 == 0, "nowhere").otherwise(F.col("source")).alias("source_id"), F.lit(0.7).alias("weight"))
    out = records.resolved(r, records.source_map(_chunks(spark, d)))
    return out.select(ids.relation_key(F.col("src_id"), F.col("tgt_id"), F.col("keywords")).alias("key"), "src_id", "tgt_id", "chunk_id", "weight")


MAP = f", ch AS (SELECT c, list(DISTINCT source) AS s FROM (SELECT *, {CLEAN} AS c FROM documents) WHERE c <> '' GROUP BY c), mp AS (SELECT source, max(concat('chunk-', md5(c))) AS chunk_id FROM (SELECT c, unnest(s) AS source FROM ch) GROUP BY 1) "
REL = DOCS + MAP + f", rel AS (SELECT concat_ws('<SEP>', {CID}, concat('tag:',lang), 'HAS_TAG') AS key, {CID} AS src_id, concat('tag:',lang) AS tgt_id, coalesce(mp.chunk_id,'UNKNOWN') AS chunk_id, 0.7::DOUBLE AS weight FROM d LEFT JOIN mp ON mp.source = CASE WHEN doc_id % 6 = 0 THEN 'nowhere' ELSE d.source END) "
SQL["c01_source_resolution"] = SQL["j04_kg_payload"] = REL + "SELECT * FROM rel"


def manifest(spark, d):
    """Chunk, entity and relationship records of a manifest, each with its record hash."""
    ch = _chunks(spark, d).select(F.lit("chunk").alias("record_type"), F.col("chunk_id").alias("key"), F.md5("content").alias("record_hash"))
    en = entity_rows(spark, d).select(F.lit("entity").alias("record_type"), F.col("entity").alias("key"), F.md5(F.concat_ws("|", "description", "entity_type")).alias("record_hash"))
    re = relationships(spark, d).select(F.lit("relationship").alias("record_type"), "key", F.md5(F.concat_ws("|", "src_id", "tgt_id", "chunk_id")).alias("record_hash"))
    return ch.unionByName(en).unionByName(re)


MAN = REL + f""", man AS (SELECT 'chunk' AS record_type, concat('chunk-', md5(c)) AS key, md5(c) AS record_hash FROM ch
 UNION ALL SELECT 'entity', concat('tag:', source), md5(concat_ws('|', arg_max(lang, doc_id), 'LLM_WIKI_TAG')) FROM documents GROUP BY source UNION ALL SELECT 'relationship', key, md5(concat_ws('|', src_id, tgt_id, chunk_id)) FROM rel) """
SQL["j05_manifest"] = MAN + "SELECT * FROM man"


def manifest_summary(spark, d):
    unknown = relationships(spark, d).agg(F.count_if(F.col("chunk_id") == "UNKNOWN").alias("n")).select(F.lit("unknown_source").alias("item"), "n")
    return manifest(spark, d).groupBy(F.col("record_type").alias("item")).agg(F.count(F.lit(1)).alias("n")).unionByName(unknown)


SQL["d04_manifest_summary"] = MAN + "SELECT record_type AS item, count(*) AS n FROM man GROUP BY 1 UNION ALL SELECT 'unknown_source', count(*) FILTER (WHERE chunk_id = 'UNKNOWN') FROM rel"


def edge_table(spark, d):
    """Edges of relationships by (type, source, target); of equal keys the largest key wins, keywords do not count."""
    r = relationships(spark, d).select(F.lit("relationship").alias("edge_type"), "src_id", "tgt_id", "key", "weight")
    more = r.withColumn("key", F.concat(F.col("key"), F.lit("2"))).withColumn("weight", F.lit(0.5))
    return records.last_wins(r.unionByName(more), ["edge_type", "src_id", "tgt_id"], "key")


SQL["j06_edge_table"] = REL + "SELECT 'relationship' AS edge_type, src_id, tgt_id, concat(max(key),'2') AS key, 0.5::DOUBLE AS weight FROM rel GROUP BY src_id, tgt_id"


# --- vectors beside records ----------------------------------------------------------------
def _sections(spark, d):
    return read(spark, d, "documents").select("doc_id", "lang", F.md5("text").alias("text_hash"))


def with_embedding(spark, d):
    """Documents beside their vectors; what has none is reported."""
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.size("embedding").alias("dim"))
    return _sections(spark, d).join(e, "doc_id", "left").select("doc_id", F.coalesce("dim", F.lit(0)).alias("dim"), F.col("dim").isNull().alias("missing"))


SQL["c02_section_embedding"] = "SELECT doc_id, coalesce(len(embedding),0)::INTEGER AS dim, vec_id IS NULL AS missing FROM documents LEFT JOIN embeddings ON vec_id = doc_id"


def cache_hits(spark, d):
    """Vectors found in a cache by hash and contract: some were stored by another model, some have changed under their digest."""
    digit = F.floor(F.abs(F.col("embedding")[0].cast("double")) * 10000) % 10
    e = read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"), digit.alias("digit"), vector_fill.checksum(F.col("embedding")).alias("sum"))
    cache = e.where("digit <> 3").select(F.col("sum").alias("vector_hash"), F.when(F.col("digit") == 4, "m2").otherwise("m1").alias("model"), F.size("e").alias("dim"), F.col("sum").alias("checksum"), F.when(F.col("digit") == 5, F.reverse("e")).otherwise(F.col("e")).alias("v"))
    records = e.select("vec_id", F.col("sum").alias("vector_hash"), F.lit("m1").alias("model"), F.size("e").alias("dim"))
    return vector_fill.lookup(records, cache).select("vec_id", "state")


SQL["c03_cache_join"] = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS e, floor(abs(embedding[1]::DOUBLE) * 10000)::BIGINT % 10 AS g FROM embeddings),
h AS (SELECT *, md5(array_to_string(list_transform(e, lambda x: round(x * 1000000)::BIGINT), ',')) AS hash FROM e),
c AS (SELECT hash, md5(array_to_string(list_transform(CASE WHEN g = 5 THEN list_reverse(e) ELSE e END, lambda x: round(x * 1000000)::BIGINT), ',')) = hash AS fine FROM h WHERE g NOT IN (3, 4))
SELECT vec_id, CASE WHEN count(fine) = 0 THEN 'miss' WHEN bool_or(fine) THEN 'hit' ELSE 'corrupt' END AS state FROM h LEFT JOIN c USING (hash) GROUP BY vec_id"""


def missing_vectors(spark, d):
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return _sections(spark, d).join(e, "doc_id", "left_anti").groupBy("lang").agg(F.count(F.lit(1)).alias("missing"))


SQL["c04_missing_vectors"] = "SELECT lang, count(*) AS missing FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) GROUP BY 1"


def coverage_audit(spark, d):
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(1).alias("has"))
    return _sections(spark, d).join(e, "doc_id", "left").groupBy("lang").agg(F.count(F.lit(1)).alias("records"), F.count("has").alias("vectors"), F.count_if(F.col("has").isNull()).alias("missing"))


SQL["c05_coverage_audit"] = "SELECT lang, count(*) AS records, count(vec_id) AS vectors, count(*) - count(vec_id) AS missing FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1"


def contracts(spark, d):
    e = read(spark, d, "embeddings").select(F.lit("m1").alias("model"), F.size("embedding").alias("dim"), F.concat(F.lit("v"), (F.col("label") % 3).cast("string")).alias("version"))
    return e.groupBy("model", "dim", "version").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "version")


SQL["d13_contract_inventory"] = "SELECT 'm1' AS model, len(embedding)::INTEGER AS dim, concat('v', label % 3) AS version, count(*) AS n FROM embeddings GROUP BY ALL"


def _texts(spark, d):
    """Documents as records: the hash of the text says what the cache held before (the first hexadecimal digit: 0 to 5, 6 by another model)."""
    return read(spark, d, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"), F.md5(F.coalesce("text", F.lit(""))).alias("vector_hash"))


def _cached(spark, rows, at):
    """A cache at a folder: hash vectors of some texts, of one more model and, for the digit 5, without their last component."""
    held = rows.where("vector_hash < '7' AND text <> ''").dropDuplicates(["vector_hash"])
    v = vector_fill.embedded(held, vector_fill.hash_embedder(), 8).select("vector_hash", F.when(F.col("vector_hash") >= "6", "m0").otherwise("m1").alias("model"), F.lit(8).alias("dim"), vector_fill.checksum(F.col("v")).alias("checksum"), F.when(F.col("vector_hash").between("5", "6"), F.slice("v", 1, 7)).otherwise(F.col("v")).alias("v"))
    v.write.parquet(at)


def cache_reuse(spark, d):
    """By language, records whose vector can be reused: same text, same contract, right digest."""
    rows, at = _texts(spark, d), scratch(spark)
    _cached(spark, rows, at)
    asked = rows.select("lang", "vector_hash", F.lit("m1").alias("model"), F.lit(8).alias("dim"))
    return vector_fill.lookup(asked, spark.read.schema(vector_fill.CACHE).parquet(at)).groupBy("lang", "state").agg(F.count(F.lit(1)).alias("n"))


STATE = "CASE WHEN t = '' OR h >= '6' THEN 'miss' WHEN h >= '5' THEN 'corrupt' ELSE 'hit' END"
HASHED = "x AS (SELECT doc_id, lang, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h FROM documents)"
SQL["i17_cache_reuse"] = f"WITH {HASHED} SELECT lang, {STATE} AS state, count(*) AS n FROM x GROUP BY ALL"


def short_embedder(texts):
    """The hash embedder as a faulty provider: no whole vector for texts with a pipe, none at all for batches with a double exclamation mark."""
    if any("!!" in t for t in texts):
        raise RuntimeError("refused")
    return [v[:5] if "|" in t else v for t, v in zip(texts, vector_fill.hash_embedder()(texts), strict=True)]


def filled(spark, d):
    """Missing vectors embedded and written; what the provider fails at is told, and a second run has only that left."""
    rows, at = _texts(spark, d), scratch(spark)
    _cached(spark, rows, at)
    first = stored(vector_fill.fill(rows, at, short_embedder, "m1", 8))
    second = vector_fill.fill(rows, at, short_embedder, "m1", 8).select("vector_hash", F.col("how").alias("again"))
    held = spark.read.schema(vector_fill.CACHE).parquet(at).where("model = 'm1' AND size(v) = 8").groupBy("vector_hash").agg(F.round(F.max(F.col("v")[7]), 6).alias("last"), F.count(F.lit(1)).alias("copies"))
    out = rows.select("doc_id", "vector_hash").join(first, "vector_hash").join(second, "vector_hash").join(held, "vector_hash", "left")
    return out.select("doc_id", "how", "failure", "again", F.coalesce("last", F.lit(-9.0)).alias("last"), F.coalesce("copies", F.lit(0)).alias("copies"))


SQL["i18_fill_missing"] = f"""WITH {HASHED}, y AS (SELECT doc_id, {STATE} = 'hit' AS held, CASE WHEN t = '' THEN 'empty' WHEN contains(t, '!!') THEN 'error' WHEN contains(t, '|') THEN 'dimension' ELSE '' END AS f,
 round(('0x' || substr(sha256(t), 29, 4))::BIGINT / 32768.0::DOUBLE - 1, 6) AS v FROM x)
SELECT doc_id, CASE WHEN held THEN 'reused' WHEN f = '' THEN 'embedded' ELSE 'failed' END AS how, CASE WHEN held THEN '' ELSE f END AS failure, CASE WHEN held OR f = '' THEN 'reused' ELSE 'failed' END AS again,
 CASE WHEN held OR f = '' THEN v ELSE -9 END AS last, CASE WHEN held OR f = '' THEN 1 ELSE 0 END::BIGINT AS copies FROM y"""


# --- differences ---------------------------------------------------------------------------
FRESH, GONE, CHANGED = "[0-9]{4}", "^[A-D]", "[.] I"  # texts that only the newer version has, that only the older one has, that differ


def _versions(spark, d):
    """Two versions of the documents: by their texts some changed, some gone, some new."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("t"), diff.fingerprint(F.col("text")).alias("print"))
    after = docs.where(~F.col("t").rlike(GONE)).withColumn("print", F.when(F.col("t").rlike(CHANGED), F.sha2("print", 256)).otherwise(F.col("print")))
    return docs.where(~F.col("t").rlike(FRESH)).drop("t"), after.drop("t")


VERSIONS = f"""WITH v AS (SELECT *, regexp_matches(coalesce(text, ''), '{FRESH}') AS fresh, regexp_matches(coalesce(text, ''), '{GONE}') AS gone, regexp_matches(coalesce(text, ''), '{CHANGED}') AS differs FROM documents),
c AS (SELECT doc_id, CASE WHEN fresh THEN 'added' WHEN gone THEN 'deleted' ELSE 'updated' END AS change FROM v WHERE NOT (fresh AND gone) AND (fresh OR gone OR differs)) """


SQL["d03_count_audit"] = VERSIONS + "SELECT * FROM (SELECT source, lang, count(*) FILTER (WHERE NOT fresh) AS expected, count(*) FILTER (WHERE NOT gone) AS found FROM v GROUP BY 1, 2) WHERE expected <> found"


def changes(spark, d):
    return diff.keyed_diff(*_versions(spark, d), "doc_id", "print")


SQL["g01_keyed_diff"] = VERSIONS + "SELECT * FROM c"


def change_summary(spark, d):
    c = changes(spark, d).agg(*[F.count_if(F.col("change") == x).alias(x) for x in ("added", "updated", "deleted")])
    return c.withColumn("changed", F.col("added") + F.col("updated") + F.col("deleted") > 0)


SQL["g02_delta_summary"] = VERSIONS + "SELECT count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'updated') AS updated, count(*) FILTER (WHERE change = 'deleted') AS deleted, count(*) > 0 AS changed FROM c"


def prints(spark, d):
    return read(spark, d, "documents").select("doc_id", diff.fingerprint(F.col("text"), F.col("source")).alias("print"))


SQL["g03_fingerprints"] = "SELECT doc_id, sha256(concat_ws(chr(31), text, source)) AS print FROM documents"


def applied(spark, d):
    """The old version brought up to date by the difference; it equals a full rebuild."""
    before, after = _versions(spark, d)
    return diff.apply_diff(before, after, "doc_id", "print").select("doc_id", "lang", "print")


SQL["g04_incremental_apply"] = VERSIONS + "SELECT doc_id, lang, CASE WHEN differs THEN sha256(sha256(text)) ELSE sha256(text) END AS print FROM v WHERE NOT gone"


def source_difference(spark, d):
    """Beginnings of texts, by source, that the older version has and the newer one lost."""
    texts = read(spark, d, "documents").select("doc_id", F.substring(F.coalesce("text", F.lit("")), 1, 1).alias("initial"))
    before, after = (v.join(texts, "doc_id").select("source", "initial") for v in _versions(spark, d))
    return before.subtract(after)


SQL["g07_source_difference"] = VERSIONS + "SELECT source, left(coalesce(text, ''), 1) AS initial FROM v WHERE NOT fresh EXCEPT SELECT source, left(coalesce(text, ''), 1) FROM v WHERE NOT gone"


def ledger(spark, d):
    """A ledger of users: old fields overlaid by those of later events, keys of either side kept."""
    e = read(spark, d, "events")
    old = diff.latest(e.where("event_id % 2 = 0"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "value")
    new = diff.latest(e.where("event_id % 2 = 1 AND user_id % 3 <> 0"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type")
    return diff.overlay(old, new, "user_id")


LEDGER = """a AS (SELECT user_id, arg_max(event_type, row(ts,event_id)) AS event_type, arg_max(value, row(ts,event_id)) AS value FROM events WHERE event_id % 2 = 0 GROUP BY 1),
b AS (SELECT user_id, arg_max(event_type, row(ts,event_id)) AS event_type FROM events WHERE event_id % 2 = 1 AND user_id % 3 <> 0 GROUP BY 1),
lg AS (SELECT coalesce(b.user_id, a.user_id) AS user_id, coalesce(b.event_type, a.event_type) AS event_type, a.value FROM a FULL JOIN b ON a.user_id = b.user_id)"""
SQL["g08_ledger_upsert"] = f"WITH {LEDGER} SELECT * FROM lg"


def ledger_clear(spark, d):
    """The ledger without finished users; what is left is dirty if any entry is actionable."""
    gone = read(spark, d, "events").where("event_type = 'purchase'").select("user_id").distinct()
    left = diff.delete(ledger(spark, d), gone, ["user_id"])
    return left.agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.col("event_type") == "error").alias("actionable"), F.coalesce(F.bool_or(F.col("event_type") == "error"), F.lit(False)).alias("dirty"))


SQL["g09_ledger_clear"] = f"WITH {LEDGER}, l AS (SELECT * FROM lg WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')) SELECT count(*) AS entries, count(*) FILTER (WHERE event_type = 'error') AS actionable, coalesce(bool_or(event_type = 'error'), false) AS dirty FROM l"


def freshness(spark, d):
    """missing, mismatch or stale for inputs whose recorded fingerprints do not fit."""
    before, after = _versions(spark, d)
    a, b = before.select("doc_id", F.col("print").alias("recorded")), after.select(F.col("doc_id").alias("_id"), F.col("print").alias("current"))
    code = F.when(F.col("recorded").isNull(), "missing").when(F.col("current").isNull(), "stale").when(F.col("recorded") != F.col("current"), "mismatch")
    return a.join(b, a["doc_id"] == b["_id"], "full_outer").select(F.coalesce("doc_id", "_id").alias("doc_id"), code.alias("code")).where("code IS NOT NULL")


SQL["g12_freshness"] = VERSIONS + "SELECT doc_id, CASE change WHEN 'added' THEN 'missing' WHEN 'deleted' THEN 'stale' ELSE 'mismatch' END AS code FROM c"


def file_prints(spark, d):
    """Size and hash of each input as a file: a small file for a source's rows of 1000 ids, read by the binary reader."""
    at = scratch(spark)
    docs = read(spark, d, "documents").groupBy("source", F.floor(F.col("doc_id") / 1000).alias("part")).agg(F.array_join(F.array_sort(F.collect_list(F.lpad(F.col("doc_id").cast("string"), 12, "0"))), ",").alias("value"))
    docs.repartition("source", "part").write.partitionBy("source", "part").text(at)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(at)
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("long").alias("part")
    return files.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("source"), part, F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


SQL["g13_file_fingerprints"] = "SELECT source, part, length(v) + 1 AS size, sha256(concat(v, chr(10))) AS sha256 FROM (SELECT source, (doc_id // 1000)::BIGINT AS part, string_agg(lpad(doc_id::VARCHAR, 12, '0'), ',' ORDER BY doc_id) AS v FROM documents GROUP BY 1, 2)"


# --- counts and audits ---------------------------------------------------------------------
def type_counts(spark, d):
    """Records by type, types without any included."""
    kinds = spark.createDataFrame([(k,) for k in [*ids.RECORD_CODES, "none"]], "record_type string")
    n = records_of(spark, d).groupBy("record_type").agg(F.count(F.lit(1)).alias("n"))
    return kinds.join(n, "record_type", "left").select("record_type", F.coalesce("n", F.lit(0)).alias("n"))


SQL["d01_count_by_type"] = REC + "SELECT k AS record_type, count(rec.record_type) AS n FROM (VALUES ('chunk'),('entity'),('relationship'),('section'),('none')) t(k) LEFT JOIN rec ON rec.record_type = k GROUP BY 1"


def table_counts(spark, d):
    parts = [read(spark, d, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in ("documents", "pages", "conversations", "embeddings")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL["d02_table_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("documents", "pages", "conversations", "embeddings"))


def count_audit(spark, d):
    """Sources and languages whose count in the newer version is not that of the older one."""
    want, got = (v.groupBy("source", "lang").agg(F.count(F.lit(1)).alias(n)) for v, n in zip(_versions(spark, d), ("expected", "found"), strict=True))
    return want.join(got, ["source", "lang"], "full_outer").na.fill(0, ["expected", "found"]).where("expected <> found").select("source", "lang", "expected", "found")




def build_gate(spark, d):
    """By source and language whether a build may be used: each record has its vector, and none breaks the rules of texts (length as stated, 20 characters at least)."""
    e = read(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(1).alias("has"))
    t = F.coalesce("text", F.lit(""))
    broken = (F.length(F.trim(t)) < 20) | (F.coalesce("n_chars", F.lit(-1)) != F.length(t))
    n = read(spark, d, "documents").join(e, "doc_id", "left").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("expected"), F.count("has").alias("inserted"), F.count_if(broken).alias("failures"))
    return n.withColumn("ok", (F.col("inserted") == F.col("expected")) & (F.col("failures") == 0))


SQL["k11_build_gate"] = """SELECT *, inserted = expected AND failures = 0 AS ok FROM (SELECT source, lang, count(*) AS expected, count(vec_id) AS inserted,
 count(*) FILTER (WHERE length(trim(coalesce(text, ''))) < 20 OR coalesce(n_chars, -1) <> length(coalesce(text, ''))) AS failures FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY 1, 2)"""


def artifact_join(spark, d):
    """Newest text of each role beside what was stored before the conversation's last turn: missing, stale or ok."""
    turns = read(spark, d, "conversations").select("conv_id", "role", "turn", F.md5("text").alias("hash"))
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    want = turns.groupBy("conv_id", "role").agg(F.max_by("hash", "turn").alias("hash"))
    have = turns.join(last, "conv_id").where("turn < last").groupBy("conv_id", "role").agg(F.max_by("hash", "turn").alias("stored"))
    code = F.when(F.col("stored").isNull(), "missing").when(F.col("stored") != F.col("hash"), "stale").otherwise("ok")
    return want.join(have, ["conv_id", "role"], "left").select("conv_id", "role", code.alias("code"))


SQL["c16_artifact_join"] = """SELECT conv_id, role, CASE WHEN stored IS NULL THEN 'missing' WHEN stored <> newest THEN 'stale' ELSE 'ok' END AS code
FROM (SELECT conv_id, role, arg_max(text, turn) AS newest, arg_max(text, turn) FILTER (WHERE turn < last) AS stored
      FROM (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations) GROUP BY 1, 2)"""


def artifact_gate(spark, d):
    n = artifact_join(spark, d).groupBy().agg(*[F.count_if(F.col("code") == c).alias(c) for c in ("missing", "stale", "ok")])
    return n.withColumn("passed", (F.col("missing") == 0) & (F.col("stale") == 0))


SQL["k09_artifact_gate"] = f"""SELECT *, missing = 0 AND stale = 0 AS passed
FROM (SELECT count(*) FILTER (WHERE code = 'missing') AS missing, count(*) FILTER (WHERE code = 'stale') AS stale, count(*) FILTER (WHERE code = 'ok') AS ok
      FROM ({SQL["c16_artifact_join"]}))"""


def path_coverage(spark, d):
    """Per document: sections stored against expected ones, and whether all are there."""
    c = read(spark, d, "conversations")
    want = c.groupBy("conv_id").agg(F.countDistinct("role").alias("expected"), F.count(F.lit(1)).alias("turns"))
    have = c.where("role <> 'system'").groupBy("conv_id").agg(F.countDistinct("role").alias("sections"))
    return want.join(have, "conv_id", "left").na.fill(0).withColumn("ok", F.col("sections") >= F.col("expected"))


SQL["c17_path_coverage"] = "SELECT *, sections >= expected AS ok FROM (SELECT conv_id, count(DISTINCT role) AS expected, count(*) AS turns, count(DISTINCT role) FILTER (WHERE role <> 'system') AS sections FROM conversations GROUP BY 1)"


def workspace_gate(spark, d):
    """One row: paths, those that lack sections, sections expected and stored, and whether the workspace may be published."""
    n = path_coverage(spark, d).agg(F.count(F.lit(1)).alias("paths"), F.count_if(~F.col("ok")).alias("lacking"), F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"), F.coalesce(F.sum("sections"), F.lit(0)).alias("sections"))
    return n.withColumn("passed", (F.col("paths") > 0) & (F.col("lacking") == 0))


SQL["k10_workspace_gate"] = f"SELECT count(*) AS paths, count(*) FILTER (WHERE NOT ok) AS lacking, sum(expected)::BIGINT AS expected, sum(sections)::BIGINT AS sections, count(*) > 0 AND bool_and(ok) AS passed FROM ({SQL['c17_path_coverage']})"


def turn_blocks(turns):
    """(span_id, source_id, start, block): each turn as it stands in a document of these turns, and its heading alone."""
    block = F.concat(F.lit("## "), F.col("role"), F.lit("\n"), F.coalesce("text", F.lit("")))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.select("conv_id", "turn", block.alias("block")).withColumn("start", F.coalesce(F.sum(F.size(F.split("block", "\n", -1))).over(before), F.lit(0)) + 1)
    whole = rows.select(F.concat_ws(":", "turn", F.lit("turn")).alias("span_id"), F.col("conv_id").alias("source_id"), "start", "block")
    return whole.unionByName(rows.select(F.concat_ws(":", "turn", F.lit("heading")).alias("span_id"), F.col("conv_id").alias("source_id"), "start", F.split("block", "\n")[0].alias("block")))


def relocated(spark, d):
    """Spans stored of conversations without their system turns, found again in what stood before the last turn; conversations of two turns are gone."""
    turns = read(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    spans = turn_blocks(turns.where("role <> 'system'"))
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    part = F.concat(F.lit("## "), "role", F.lit("\n"), F.coalesce("text", F.lit("")))
    parts = turns.join(last, "conv_id").where("turn < last AND last > 1").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", part.alias("part")))).alias("p"))
    sources = parts.select(F.col("conv_id").alias("source_id"), F.array_join("p.part", "\n").alias("text"))
    return relocation.relocated(spans, sources).select(F.col("source_id").alias("conv_id"), "span_id", "state", F.coalesce("line", F.lit(0)).alias("line"))


SQL["i15_relocation"] = """WITH t AS (SELECT conv_id, turn, role, concat('## ', role, chr(10), text) AS block, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
s AS (SELECT conv_id, turn, string_split(block, chr(10)) AS l, coalesce(sum(len(string_split(block, chr(10)))) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS start FROM t WHERE role <> 'system'),
p AS (SELECT conv_id, concat(turn, ':turn') AS span_id, start, l FROM s UNION ALL SELECT conv_id, concat(turn, ':heading'), start, l[1:1] FROM s),
c AS (SELECT conv_id, string_split(string_agg(block, chr(10) ORDER BY turn), chr(10)) AS now FROM t WHERE turn < last AND last > 1 GROUP BY 1),
m AS (SELECT p.*, c.now, list_filter(range(1, len(now) + 1), lambda i: now[i:i + len(l) - 1] = l) AS hits FROM p LEFT JOIN c USING (conv_id)),
o AS (SELECT *, CASE WHEN now IS NULL THEN 'missing' WHEN list_contains(hits, start) THEN 'current' WHEN len(hits) = 1 THEN 'relocated' WHEN len(hits) > 1 THEN 'ambiguous' ELSE 'stale' END AS state FROM m)
SELECT conv_id, span_id, state, CASE state WHEN 'current' THEN start WHEN 'relocated' THEN hits[1] ELSE 0 END::INTEGER AS line FROM o"""


def allocated(rows, taken, parts=None):
    """(day, id, number): a number within its day for every row (day, id, wanted); taken: (day, number).

    A wanted number that is not taken goes to the first row that asks for it; all other rows follow
    the largest number of the day in the order of their ids.
    """
    asks = rows.where("wanted IS NOT NULL").join(taken.select("day", F.col("number").alias("wanted")).distinct(), ["day", "wanted"], "left_anti")
    granted = stored(asks.groupBy("day", "wanted").agg(F.min("id").alias("id")).select("day", "id", F.col("wanted").cast("long").alias("number")))
    most = taken.select("day", "number").unionByName(granted.select("day", "number")).groupBy("day").agg(F.max("number").alias("most"))
    rest = order.running_number(rows.select("day", "id").join(granted, ["day", "id"], "left_anti"), ["day"], ["id"], parts=parts)
    rest = rest.join(most, "day", "left").select("day", "id", (F.col("number") + F.coalesce("most", F.lit(0))).alias("number"))
    return granted.unionByName(rest)


def sequence_paths(spark, d):
    """Paths by day: purchases have taken the number in their properties, clicks ask for one, all others follow the largest."""
    e = read(spark, d, "events").select(F.col("event_id").alias("id"), F.date_format("ts", "yyMMdd").alias("day"), "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    taken = e.where("event_type = 'purchase' AND k IS NOT NULL").select("day", F.col("k").alias("number"))
    rows = e.where("event_type <> 'purchase'").select("day", "id", F.when(F.col("event_type") == "click", F.col("k")).alias("wanted"))
    return allocated(rows, taken).select(F.col("id").alias("event_id"), F.concat("day", F.format_string("%02d", "number")).alias("name"))


SQL["e10_path_sequence"] = """WITH e AS (SELECT event_id, strftime(ts,'%y%m%d') AS day, event_type, (props->>'k')::BIGINT AS k FROM events),
t AS (SELECT DISTINCT day, k FROM e WHERE event_type = 'purchase' AND k IS NOT NULL),
g AS (SELECT day, k, min(event_id) AS event_id FROM e WHERE event_type = 'click' AND k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.day = e.day AND t.k = e.k) GROUP BY 1, 2),
m AS (SELECT day, max(k) AS most FROM (SELECT day, k FROM t UNION ALL SELECT day, k FROM g) GROUP BY 1),
r AS (SELECT event_id, day, row_number() OVER (PARTITION BY day ORDER BY event_id) AS n FROM e WHERE event_type <> 'purchase' AND event_id NOT IN (SELECT event_id FROM g))
SELECT event_id, concat(day, printf('%02d', k)) AS name FROM g UNION ALL SELECT event_id, concat(day, printf('%02d', n + coalesce(most, 0))) FROM r LEFT JOIN m USING (day)"""


def owners(spark, d):
    """The first item of each source publishes; later ones name it as their owner."""
    docs = read(spark, d, "documents").select("doc_id", "source")
    first = docs.groupBy("source").agg(F.min("doc_id").alias("owner"))
    return docs.join(first, "source").select("doc_id", "owner", (F.col("doc_id") == F.col("owner")).alias("publishes"))


SQL["e11_batch_owner"] = "SELECT doc_id, min(doc_id) OVER (PARTITION BY source) AS owner, doc_id = min(doc_id) OVER (PARTITION BY source) AS publishes FROM documents"


def existing_note(spark, d):
    """For each source of a document that holds a benchmark passage, its first note in path order."""
    notes = corpus(spark, d).where("source IS NOT NULL").groupBy("source").agg(F.min("path").alias("first_path"), F.count(F.lit(1)).alias("notes"))
    held = search.passages(read(spark, d, "documents"), read(spark, d, "benchmark").select("item_id", F.col("text").alias("passage")))
    asked = held.join(read(spark, d, "documents").select("doc_id", "source"), "doc_id").select("item_id", "source").distinct()
    return asked.join(notes, "source").select("item_id", "source", "first_path", "notes")


SQL["c13_existing_note"] = DOCS + "SELECT DISTINCT item_id, d.source, first_path, notes FROM benchmark b JOIN d ON contains(d.text, b.text) JOIN (SELECT source, min(path) AS first_path, count(*) AS notes FROM d GROUP BY 1) n ON n.source = d.source"

QUERIES = {
    "j07_native_records": native_records, "a13_index_scan": native_records, "a11_snapshot": snapshot, "a02_jsonl": jsonl, "a03_strict_jsonl": strict_jsonl, "a04_manifest_load": manifest_load,
    "a01_corpus_scan": corpus_scan, "a05_embedding_read": embedding_read, "a06_embedding_upsert": upserted, "a09_bulk_upsert": upserted, "a07_cache_write": cache_write, "a10_keyed_delete": deleted,
    "a17_render": rendered, "a08_generated_scan": generated_scan, "d05_chunk_dedupe": chunk_rows, "d06_last_wins": entity_rows, "d07_first_wins": default_rows, "c01_source_resolution": relationships,
    "j04_kg_payload": relationships, "j05_manifest": manifest, "d04_manifest_summary": manifest_summary, "j06_edge_table": edge_table, "c02_section_embedding": with_embedding, "c03_cache_join": cache_hits,
    "c04_missing_vectors": missing_vectors, "c05_coverage_audit": coverage_audit, "d13_contract_inventory": contracts, "i17_cache_reuse": cache_reuse, "i18_fill_missing": filled,
    "g01_keyed_diff": changes, "g02_delta_summary": change_summary, "g03_fingerprints": prints, "g04_incremental_apply": applied, "g07_source_difference": source_difference, "g08_ledger_upsert": ledger,
    "g09_ledger_clear": ledger_clear, "g12_freshness": freshness, "g13_file_fingerprints": file_prints, "d01_count_by_type": type_counts, "d02_table_counts": table_counts, "d03_count_audit": count_audit,
    "k11_build_gate": build_gate, "c16_artifact_join": artifact_join, "k09_artifact_gate": artifact_gate, "c17_path_coverage": path_coverage, "k10_workspace_gate": workspace_gate, "i15_relocation": relocated,
    "e10_path_sequence": sequence_paths, "e11_batch_owner": owners, "c13_existing_note": existing_note,
}
