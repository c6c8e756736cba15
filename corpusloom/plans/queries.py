"""Every operator as a query over the driver's tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import answers, calendar, cells, identity, text, timeline
from corpusloom.operators import assemble, boundaries, geo, planning, quality, resolve, schedule, stats, timelines
from corpusloom.plans import bindings as b
from corpusloom.plans.bindings import BENCHMARK, FINGERPRINT, JOBS, KNOWN, LABELLED, MOMENTS, PARSED, PARTS, POLYGONS, SENTENCES, TEXTS, VERDICTS
from corpusloom.session import configured, shared_folder
from corpusloom.sources import marks, parts, pulls, readers
from corpusloom.streaming import flush, ingest, plan_builder, progress, resolution

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
CHUNK = 200


def query(sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = (f"WITH {', '.join(ctes)}\n" if ctes else "") + sql
        return f

    return add


# sources


@query("SELECT doc_id, sentence_index, text_sha256, language, unsplit FROM sentences", SENTENCES)
def sentence_explode(s, d):
    return b.sentences(s, d).select("doc_id", "sentence_index", "text_sha256", "language", "unsplit")


def _shards(s: SparkSession, d: str) -> DataFrame:
    """Documents as a website shard: two fields, of which one is split, unsplit, absent or empty by the document's number."""
    docs = b.table(s, d, "documents").select(F.col("source").alias("source_file"), F.col("doc_id").cast("string").alias("polygon_id"), "doc_id", "text", "lang")
    status = lambda n: F.element_at(F.array(*[F.lit(x) for x in ("success", "unsupported_language", "absent", "empty_text")]), (F.floor(F.col("doc_id") / n) % 4 + 1).cast("int"))
    lines = F.split("text", "\n")
    group = lambda f, n: [F.col("text").alias(f"{f}_text"), F.col("lang").alias(f"{f}_language"), lines.alias(f"{f}_sentences"), status(n).alias(f"{f}_sentence_status")]
    return docs.select("source_file", "polygon_id", *group("website", 1), *group("contact_website", 3))


_FIELDS = "fields AS (SELECT doc_id, text, lang, field, CASE field WHEN 'website' THEN doc_id % 4 ELSE (doc_id // 3) % 4 END AS st FROM documents, (VALUES ('website'), ('contact_website')) f(field))"


@query("SELECT CAST(doc_id AS VARCHAR) AS polygon_id, field, st = 1 AS unsplit, count(*) AS n, CAST(max(i) AS BIGINT) AS last, sha256(string_agg(sha, ',' ORDER BY i)) AS digest FROM (SELECT doc_id, field, st, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i, sha256(unnest(string_split(text, chr(10)))) AS sha FROM fields WHERE st = 0 UNION ALL SELECT doc_id, field, st, 0, sha256(text) FROM fields WHERE st = 1) GROUP BY ALL", _FIELDS)
def unpivot_fields(s, d):
    x = readers.read_website(_shards(s, d)).withColumn("sha", F.sha2("text", 256))
    g = x.groupBy("polygon_id", "field", "unsplit").agg(F.count(F.lit(1)).alias("n"), F.max("sentence_index").cast("bigint").alias("last"), F.array_sort(F.collect_list(F.struct("sentence_index", "sha"))).alias("l"))
    return g.select("polygon_id", "field", "unsplit", "n", "last", F.sha2(F.array_join("l.sha", ","), 256).alias("digest"))


@query("SELECT CASE doc_id % 3 WHEN 0 THEN 'split' WHEN 1 THEN 'unsupported_language' ELSE 'not_detected' END AS status, CAST(sum(CASE WHEN doc_id % 3 = 0 THEN len(string_split(text, chr(10))) ELSE 1 END) AS BIGINT) AS sentences FROM documents GROUP BY 1")
def status_guard_counts(s, d):
    docs = b.table(s, d, "documents")
    state = F.element_at(F.array(F.lit("split"), F.lit("unsupported_language"), F.lit("not_detected")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = docs.select(F.col("source").alias("source_file"), F.col("doc_id").cast("string").alias("description_identity"), state.alias("tag_key"), F.col("text").alias("original_text"), F.col("lang").alias("language_code"), state.alias("split_status"), F.split("text", "\n").alias("sentences"))
    return readers.read_description(rows).groupBy(F.col("tag_key").alias("status")).agg(F.count(F.lit(1)).alias("sentences"))


@query("SELECT source AS source_file, lang = 'es' AS unsplit, count(*) AS n, count(DISTINCT sha256(text)) AS texts FROM documents GROUP BY ALL")
def wiki_reader(s, d):
    rows = b.table(s, d, "documents").select(F.col("source").alias("source_file"), F.col("doc_id").cast("string").alias("sentence_id"), "text", F.col("lang").alias("language"), F.when(F.col("lang") == "es", "unsupported_language").otherwise("split").alias("segmentation_status"))
    return readers.with_identity(readers.read_wiki(rows), "wiki").groupBy("source_file", "unsplit").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text_sha256").alias("texts"))


# planning


@query("SELECT text_sha256, file_idx FROM texts", SENTENCES, TEXTS)
def text_dedup_first_file(s, d):
    return planning.unique_texts(b.sentences(s, d)).select("text_sha256", "file_idx")


@query("SELECT file_idx, count(*) AS sentences, count(*) FILTER (unsplit) AS unsplit, (SELECT count(*) FROM texts t WHERE t.file_idx = s.file_idx) AS new_unique FROM sentences s GROUP BY file_idx", SENTENCES, TEXTS)
def per_file_scan_counts(s, d):
    x = b.sentences(s, d)
    return planning.scan_counts(x, planning.unique_texts(x))


@query("SELECT count(DISTINCT file_idx) AS files, count(*) AS sentences, count(*) FILTER (unsplit) AS unsplit, (SELECT count(*) FROM texts) AS unique_texts, (SELECT count(DISTINCT substr(text_sha256, 1, 2)) FROM texts) AS chunks FROM sentences", SENTENCES, TEXTS)
def plan_report(s, d):
    x = b.sentences(s, d)
    t = planning.unique_texts(x)
    return planning.plan_report(planning.scan_counts(x, t), t.withColumn("chunk_id", F.substring("text_sha256", 1, 2)))


@query("SELECT DISTINCT sha256(w) AS text_sha256 FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE NOT regexp_matches(w, '\\p{L}')")
def letterless_rule(s, d):
    """Over words: the documents' sentences all have letters."""
    words = b.table(s, d, "documents").select(F.explode(F.split("text", " ")).alias("text")).distinct()
    rule, _ = resolve.split_by_rule(words.withColumn("text_sha256", F.sha2("text", 256)))
    return rule.select("text_sha256")


@query("SELECT text_sha256 FROM texts WHERE length(regexp_replace(text, '[^\\p{L}]', '', 'g')) >= 2", SENTENCES, TEXTS)
def readable_filter(s, d):
    return planning.unique_texts(b.sentences(s, d)).filter(text.readable(F.col("text"))).select("text_sha256")


@query("SELECT doc_id, sentence_index, label_id FROM sentences", SENTENCES)
def label_ids(s, d):
    return b.sentences(s, d).select("doc_id", "sentence_index", "label_id")


@query(f"SELECT text_sha256, substr(sha256(text_sha256 || chr(31) || '{FINGERPRINT}'), 1, 32) AS generation_id FROM texts", SENTENCES, TEXTS)
def generation_ids(s, d):
    return planning.unique_texts(b.sentences(s, d)).select("text_sha256", identity.generation_id(F.col("text_sha256"), F.lit(FINGERPRINT)).alias("generation_id"))


_FILE_ORDER = "ordered AS (SELECT *, row_number() OVER (ORDER BY file_idx, text_sha256) - 1 AS ordinal FROM texts)"


@query("SELECT text_sha256, ordinal, ordinal // 200 AS grp FROM ordered", SENTENCES, TEXTS, _FILE_ORDER)
def file_order_chunks(s, d):
    x = planning.file_ordinal(planning.unique_texts(b.sentences(s, d)))
    return x.select("text_sha256", F.col("ordinal").cast("bigint").alias("ordinal"), F.floor(F.col("ordinal") / CHUNK).alias("grp"))


_CHUNKS = f"chunks AS (SELECT ordinal // 200 AS seq, substr(sha256('{FINGERPRINT}' || chr(31) || string_agg(text_sha256, chr(31) ORDER BY text_sha256)), 1, 24) AS chunk_id, count(*) AS size, CAST(sum(length(text)) AS BIGINT) AS prompt_tokens, min_by(file_idx, struct_pack(a := length(text), b := text_sha256)) AS ord_file FROM ordered GROUP BY 1)"


def _chunks(s: SparkSession, d: str) -> DataFrame:
    x = planning.file_ordinal(planning.unique_texts(b.sentences(s, d)))
    x = x.withColumn("prompt_tokens", F.length("text")).withColumn("ord_rank", F.lit(0)).withColumn("ord_file", F.col("file_idx"))
    return planning.chunked(x, CHUNK, F.lit(FINGERPRINT))


@query("SELECT chunk_id, 0 AS ord_rank, ord_file, size, prompt_tokens, seq FROM chunks", SENTENCES, TEXTS, _FILE_ORDER, _CHUNKS)
def chunk_ids(s, d):
    return planning.plan_lines(_chunks(s, d))


@query("SELECT chunk_id, 0 AS ord_rank, ord_file, size, prompt_tokens, seq FROM chunks WHERE seq % 3 <> 0 AND size = 200", SENTENCES, TEXTS, _FILE_ORDER, _CHUNKS)
def plan_append(s, d):
    lines = planning.plan_lines(_chunks(s, d))
    held = lines.filter(F.col("size") == CHUNK)  # the partial tail is held back
    return planning.new_lines(held, lines.filter("seq % 3 = 0"))


_STATE = "state AS (SELECT text_sha256, file_idx, substr(text_sha256, 1, 2) AS chunk_id, CAST('0x' || substr(text_sha256, 3, 1) AS INTEGER) > 0 OR CAST('0x' || substr(text_sha256, 1, 1) AS INTEGER) < 8 AS done FROM texts)"


def _state(s: SparkSession, d: str) -> DataFrame:
    digit = lambda at: F.conv(F.substring("text_sha256", at, 1), 16, 10).cast("int")
    return planning.unique_texts(b.sentences(s, d)).select("text_sha256", "file_idx", F.substring("text_sha256", 1, 2).alias("chunk_id"), ((digit(3) > 0) | (digit(1) < 8)).alias("done"))


@query("SELECT chunk_id FROM state GROUP BY chunk_id HAVING NOT bool_and(done)", SENTENCES, TEXTS, _STATE)
def open_chunks(s, d):
    return planning.open_chunks(_state(s, d))


@query("SELECT chunk_id, count(*) AS size, min(file_idx) AS ord_file, CAST(0 AS BIGINT) AS prompt_tokens FROM small WHERE chunk_id NOT IN (SELECT chunk_id FROM small WHERE file_idx % 2 = 0) GROUP BY chunk_id", SENTENCES, TEXTS, _STATE, "small AS (SELECT substr(text_sha256, 1, 3) AS chunk_id, file_idx FROM state)")
def recover_plan_lines(s, d):
    x = _state(s, d).withColumn("chunk_id", F.substring("text_sha256", 1, 3))
    return planning.recovered_lines(x, x.filter("file_idx % 2 = 0"))


@query("SELECT CASE WHEN chunk_id IN (SELECT chunk_id FROM state GROUP BY chunk_id HAVING NOT bool_and(done)) THEN NULL ELSE chunk_id END AS chunk_id, count(*) AS n FROM state GROUP BY 1", SENTENCES, TEXTS, _STATE)
def release_unfinished(s, d):
    x = _state(s, d)
    freed, _ = planning.released(x, x.select("chunk_id").distinct())
    return freed.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT text_sha256, file_idx FROM texts WHERE file_idx < 13", SENTENCES, TEXTS)
def scanned_prefix(s, d):
    files = b.files(s, d).withColumn("scanned", ~F.col("file_idx").isin(13, 17))
    return planning.scanned_prefix(planning.unique_texts(b.sentences(s, d)), files).select("text_sha256", "file_idx")


@query("SELECT count(*) AS pending, count(CASE WHEN substr(text_sha256, 4, 1) <> '0' THEN 1 END) AS with_cell FROM state WHERE NOT done AND substr(chunk_id, 1, 1) = 'f'", SENTENCES, TEXTS, _STATE)
def pending_counts(s, d):
    x = _state(s, d).withColumn("chunk_id", F.when(~F.col("chunk_id").startswith("f"), F.col("chunk_id"))).withColumn("cell", F.when(F.substring("text_sha256", 4, 1) != "0", F.lit("c")))
    return planning.pending_counts(x)


@query(f"SELECT chunk_id FROM chunks WHERE seq % 4 = 1", SENTENCES, TEXTS, _FILE_ORDER, _CHUNKS)
def chunk_id_mismatches(s, d):
    x = _chunks(s, d)
    damaged = x.filter(~((F.pmod("group", F.lit(4)) == 1) & (F.col("ordinal") % CHUNK == 0)))
    return planning.mismatched_chunks(damaged, F.lit(FINGERPRINT))


@query("SELECT text_sha256, file_idx, done OR text_sha256 IN (SELECT text_sha256 FROM parts WHERE replica = 1 AND row_index % 2 = 0) AS done FROM state", SENTENCES, TEXTS, _STATE, PARTS)
def mark_done(s, d):
    return planning.mark_done(_state(s, d), b.parts(s, d).filter("replica = 1 and row_index % 2 = 0")).select("text_sha256", "file_idx", "done")


_CELLS = "celled AS (SELECT text_sha256, text, min_by(CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 37 AS VARCHAR) END, struct_pack(a := file_idx, b := doc_id, c := sentence_index)) FILTER (doc_id % 4 <> 0) AS cell FROM sentences WHERE NOT unsplit GROUP BY ALL)"
_ROUNDS = "rounded AS (SELECT text_sha256, cell, CASE WHEN cell IS NOT NULL THEN row_number() OVER (PARTITION BY cell ORDER BY text_sha256) - 1 END AS r, CASE WHEN cell IS NULL THEN '' ELSE substr(sha256(cell), 1, 16) END AS key FROM celled), spread AS (SELECT text_sha256, cell, key, coalesce(r, CAST('0x' || substr(text_sha256, 1, 12) AS BIGINT) % ((SELECT coalesce(max(r), 0) FROM rounded) + 1)) AS round FROM rounded)"


def _celled(s: SparkSession, d: str) -> DataFrame:
    x = b.sentences(s, d).filter("not unsplit")
    placed = x.filter("doc_id % 4 <> 0").select("text_sha256", (F.col("doc_id") % 37).cast("string").alias("cell"), "file_idx", F.col("doc_id").alias("row_index"), F.lit(0).alias("field_position"), "sentence_index")
    return planning.unique_texts(x).join(planning.first_cells(placed), "text_sha256", "left")


@query("SELECT text_sha256, round, key FROM spread", SENTENCES, _CELLS, _ROUNDS)
def uniform_order_rounds(s, d):
    return planning.rounds(_celled(s, d)).select("text_sha256", "round", "key")


@query("SELECT text_sha256, row_number() OVER (ORDER BY round, key, text_sha256) - 1 AS ordinal FROM spread", SENTENCES, _CELLS, _ROUNDS)
def uniform_chunks(s, d):
    return planning.uniform_ordinal(_celled(s, d)).select("text_sha256", F.col("ordinal").cast("bigint").alias("ordinal"))


@query("SELECT text_sha256, cell FROM celled WHERE cell IS NOT NULL", SENTENCES, _CELLS)
def first_cells(s, d):
    return _celled(s, d).filter("cell is not null").select("text_sha256", "cell")


@query("SELECT chunk_id, min(p) AS dataset_position, CAST(min_by(seq, struct_pack(a := p, b := seq)) AS BIGINT) AS seq FROM (SELECT o_orderkey % 500 AS chunk_id, o_custkey % 3 AS p, o_orderkey AS seq FROM orders) GROUP BY 1")
def merged_plans(s, d):
    x = b.table(s, d, "orders").select((F.col("o_orderkey") % 500).alias("chunk_id"), (F.col("o_custkey") % 3).alias("dataset_position"), F.col("o_orderkey").alias("seq"))
    return planning.merged_plans(x)


# resolution


@query("SELECT text_sha256, part_key, row_index, decision, parse_mode, failure_reason FROM parsed", SENTENCES, PARTS, PARSED)
def parse_verdict(s, d):
    x = b.parts(s, d).withColumn("v", answers.parse_generation(F.col("raw_output"), F.col("truncated")))
    return x.select("text_sha256", "part_key", "row_index", "v.*")


@query("SELECT a, x, lim, CASE WHEN x IS NULL AND a >= lim OR x IS NOT NULL AND a + x > lim THEN true ELSE false END AS too_long FROM (SELECT l_orderkey AS a, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS x, l_partkey AS lim FROM lineitem)")
def parse_too_long(s, d):
    x = b.table(s, d, "lineitem").select(F.col("l_orderkey").alias("a"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("x"), F.col("l_partkey").alias("lim"))
    raw = F.concat(F.lit(answers.TOO_LONG), F.col("a").cast("string"), F.coalesce(F.concat(F.lit("+"), F.col("x").cast("string")), F.lit("")), F.when(F.col("x").isNull(), ">=").otherwise(">"), F.col("lim").cast("string"))
    return x.withColumn("too_long", answers.is_too_long(raw))


@query("SELECT event_id, 'failed' AS decision, CASE WHEN value > 20 THEN 'length' WHEN event_id % 3 = 0 THEN 'stop' ELSE 'unknown' END AS finish_reason, CAST(event_id % 7 AS INTEGER) AS generated_tokens, CAST(nullif(event_id % 5, 0) AS INTEGER) AS verify_steps FROM events")
def engine_records(s, d):
    """Engine completions: a finish reason as an object, a text, or missing."""
    e = b.table(s, d, "events")
    finish = F.when(F.col("value") > 20, F.lit('{"type": "length"}')).when(F.col("event_id") % 3 == 0, F.lit('"stop"')).otherwise(F.lit("null"))
    raw = F.format_string('{"text": "t%d", "meta_info": {"finish_reason": %s, "completion_tokens": %d, "spec_verify_ct": %d}}', "event_id", finish, F.col("event_id") % 7, F.col("event_id") % 5)
    x = e.select("event_id", answers.from_engine(F.sha2(F.col("event_id").cast("string"), 256), raw, F.lit(1)).alias("g"))
    v = answers.parse_generation(F.col("g.raw_output"), F.col("g.truncated"))
    return x.select("event_id", v["decision"].alias("decision"), "g.finish_reason", "g.generated_tokens", "g.verify_steps")


@query("SELECT text_sha256, chunk_id, part, row_index, raw_output FROM (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chunk_id, part, row_index) AS k FROM parts) WHERE k = 1", SENTENCES, PARTS)
def canonical_generation(s, d):
    return resolve.canonical_generations(b.parts(s, d)).select("text_sha256", "chunk_id", "part", "row_index", "raw_output")


@query("SELECT * FROM verdicts", SENTENCES, PARTS, PARSED, VERDICTS)
def verdict_min_part(s, d):
    return resolve.verdicts(b.parts(s, d))


_FOUND = "found AS (SELECT chunk_id, text_sha256, part AS part_id FROM parts WHERE row_index % 3 <> 0 UNION ALL SELECT chunk_id, '~' || substr(text_sha256, 1, 6), part FROM parts WHERE row_index = 2)"


def _found(s: SparkSession, d: str) -> DataFrame:
    p = b.parts(s, d)
    own = p.filter("row_index % 3 <> 0").select("chunk_id", "text_sha256", F.col("part").alias("part_id"))
    return own.unionByName(p.filter("row_index = 2").select("chunk_id", F.concat(F.lit("~"), F.substring("text_sha256", 1, 6)).alias("text_sha256"), F.col("part").alias("part_id")))


@query(
    "SELECT chunk_id, CASE WHEN done = 0 THEN 'pending' WHEN done < n THEN 'partial' ELSE 'complete' END AS state, missing, owners, foreign_texts FROM (SELECT coalesce(e.chunk_id, o.chunk_id) AS chunk_id, count(e.text_sha256) AS n, count(e.text_sha256) FILTER (o.owner IS NOT NULL) AS done, coalesce(string_agg(e.text_sha256, ',' ORDER BY e.text_sha256) FILTER (o.owner IS NULL), '') AS missing, coalesce(string_agg(e.text_sha256 || '=' || o.owner, ',' ORDER BY e.text_sha256) FILTER (o.owner IS NOT NULL), '') AS owners, coalesce(string_agg(o.text_sha256, ',' ORDER BY o.text_sha256) FILTER (e.text_sha256 IS NULL), '') AS foreign_texts FROM keyed e FULL JOIN (SELECT chunk_id, text_sha256, min(part_id) AS owner FROM found GROUP BY ALL) o ON e.chunk_id = o.chunk_id AND e.text_sha256 = o.text_sha256 GROUP BY 1)",
    SENTENCES, PARTS, _FOUND,
)
def chunk_progress(s, d):
    expected = b.parts(s, d).select("chunk_id", "text_sha256").distinct().withColumn("position", F.col("text_sha256"))
    x = resolve.chunk_progress(expected, _found(s, d))
    owners = F.array_join(F.transform(F.map_entries("owners"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return x.select("chunk_id", "state", F.array_join("missing", ",").alias("missing"), owners.alias("owners"), F.array_join("foreign", ",").alias("foreign_texts"))


@query("SELECT chunk_id, count(DISTINCT text_sha256) AS done FROM found GROUP BY 1", SENTENCES, PARTS, _FOUND)
def done_per_chunk(s, d):
    return resolve.done_per_chunk(_found(s, d))


@query("SELECT DISTINCT text_sha256 FROM found", SENTENCES, PARTS, _FOUND)
def generated_texts(s, d):
    m = _found(s, d).groupBy("part_id").agg(F.sort_array(F.collect_set("text_sha256")).alias("text_sha256s"))
    return resolve.generated_texts(m)


@query("SELECT text_sha256, substr(text_sha256, 1, 2) AS chunk_id FROM texts WHERE text_sha256 NOT IN (SELECT text_sha256 FROM found WHERE text_sha256 > '4')", SENTENCES, TEXTS, PARTS, _FOUND)
def missing_texts(s, d):
    wanted = planning.unique_texts(b.sentences(s, d)).select("text_sha256", F.substring("text_sha256", 1, 2).alias("chunk_id"))
    return resolve.missing_texts(wanted, _found(s, d).filter("text_sha256 > '4'"))


@query("SELECT part_key, row_index, text_sha256 FROM parts", SENTENCES, PARTS)
def union_of_parts(s, d):
    p = b.parts(s, d).withColumn("part_key", F.concat_ws("/", "part_key", "text_sha256")).select("part_key", "row_index", "text_sha256")
    out = resolve.union_of_parts(p.filter("row_index < 16"), p.filter("row_index >= 8"))
    return out.select(F.substring_index("part_key", "/", 2).alias("part_key"), "row_index", "text_sha256")


_PUBLISHED = "published AS (SELECT substr(sha256(text_sha256), 1, 32) AS generation_id, 'batch-' || lpad(CAST(doc_id % 23 AS VARCHAR), 3, '0') AS file_name, doc_id * 10000 + sentence_index AS row_index FROM sentences)"


@query("SELECT file_name, count(*) AS n, count(*) FILTER (k = 1) AS kept, count(*) FILTER (k = 1) < count(*) AS changed, count(*) FILTER (k = 1) = 0 AS emptied FROM (SELECT *, row_number() OVER (PARTITION BY generation_id ORDER BY file_name, row_index) AS k FROM published) GROUP BY 1", SENTENCES, _PUBLISHED)
def repair_dedupe(s, d):
    x = b.sentences(s, d).select(F.substring(F.sha2("text_sha256", 256), 1, 32).alias("generation_id"), F.concat(F.lit("batch-"), F.lpad((F.col("doc_id") % 23).cast("string"), 3, "0")).alias("file_name"), (F.col("doc_id") * 10000 + F.col("sentence_index")).alias("row_index"))
    kept, files = resolve.deduped_generations(x)
    n = x.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    k = kept.groupBy("file_name").agg(F.count(F.lit(1)).alias("kept"))
    return n.join(files, "file_name").join(k, "file_name", "left").withColumn("kept", F.coalesce("kept", F.lit(0).cast("bigint")))


# assembly


def labelled(s: SparkSession, d: str) -> DataFrame:
    return assemble.label_rows(b.sentences(s, d), b.known(resolve.verdicts(b.parts(s, d))), F.lit(FINGERPRINT), True)


_ALL = (SENTENCES, PARTS, PARSED, VERDICTS, KNOWN, LABELLED)


@query("SELECT label_id, text_sha256, decision, parse_mode, failure_reason, generation_id, language FROM labelled", *_ALL)
def labels_pending(s, d):
    return labelled(s, d).select("label_id", "text_sha256", "decision", "parse_mode", "failure_reason", "generation_id", "language")


@query("SELECT label_id, CASE WHEN unsplit THEN 'skipped_unsplit' ELSE v.decision END AS decision, CASE WHEN NOT unsplit THEN v.parse_mode END AS parse_mode FROM sentences LEFT JOIN verdicts v USING (text_sha256)", SENTENCES, PARTS, PARSED, VERDICTS)
def labels_join(s, d):
    return assemble.label_rows(b.sentences(s, d), resolve.verdicts(b.parts(s, d)), F.lit(FINGERPRINT), False).select("label_id", "decision", "parse_mode")


@query("SELECT source_file, count(*) FILTER (NOT unsplit AND decision <> 'pending') AS known, count(*) FILTER (NOT unsplit) AS sendable, coalesce(bool_and(decision <> 'pending') FILTER (NOT unsplit), true) AS complete FROM labelled GROUP BY 1", *_ALL)
def file_coverage(s, d):
    return assemble.coverage(labelled(s, d))


@query("SELECT source_file, last, (last = 0 AND known >= 1) OR known - last >= greatest(1, CAST(ceil(CAST(0.01 AS DOUBLE) * sendable) AS BIGINT)) AS publish FROM (SELECT source_file, file_idx % 2 * (count(*) FILTER (NOT unsplit AND decision <> 'pending') - file_idx // 4) AS last, count(*) FILTER (NOT unsplit AND decision <> 'pending') AS known, count(*) FILTER (NOT unsplit) AS sendable FROM labelled GROUP BY source_file, file_idx)", *_ALL)
def partial_threshold(s, d):
    x = assemble.coverage(labelled(s, d)).join(b.files(s, d), "source_file")
    x = x.withColumn("last", F.col("file_idx") % 2 * (F.col("known") - F.floor(F.col("file_idx") / 4)))
    return x.select("source_file", "last", assemble.worth_publishing(F.col("known"), F.col("sendable"), F.col("last")).alias("publish"))


@query("SELECT text AS sentence, decision AS label, language, source_file AS region FROM labelled WHERE decision <> 'pending' AND length(regexp_replace(text, '[^\\p{L}]', '', 'g')) >= 2", *_ALL)
def viewer_table(s, d):
    return assemble.viewer_table(labelled(s, d).withColumn("source_file", F.concat(F.lit("v1/data/"), "source_file", F.lit(".parquet"))))


@query("SELECT DISTINCT l.text_sha256, l.generation_id, l.file_idx FROM labelled l JOIN texts t ON l.text_sha256 = t.text_sha256 AND l.file_idx = t.file_idx WHERE l.generation_id IS NOT NULL", *_ALL, TEXTS)
def owned_generations(s, d):
    x = labelled(s, d)
    return assemble.owned_generations(x, planning.unique_texts(b.sentences(s, d)))


@query(f"SELECT substr(sha256(p.text_sha256 || chr(31) || '{FINGERPRINT}'), 1, 32) AS generation_id, p.text_sha256, p.raw_output FROM (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chunk_id, part, row_index) AS k FROM parts) p WHERE k = 1 AND p.text_sha256 IN (SELECT text_sha256 FROM labelled WHERE decision = 'failed')", *_ALL)
def generations_table(s, d):
    wanted = labelled(s, d).filter("decision = 'failed'")
    return assemble.generations_table(resolve.canonical_generations(b.parts(s, d)), wanted, F.lit(FINGERPRINT)).select("generation_id", "text_sha256", "raw_output")


@query("SELECT i.doc_id, count(*) AS n, count(*) FILTER (l.decision = 'yes') AS yes, count(g.raw_output) AS outputs FROM documents i JOIN labelled l USING (doc_id) LEFT JOIN (SELECT DISTINCT ON (text_sha256) text_sha256, raw_output FROM parts ORDER BY text_sha256, chunk_id, part, row_index) g ON l.text_sha256 = g.text_sha256 AND l.generation_id IS NOT NULL GROUP BY 1", *_ALL)
def recipe_join(s, d):
    rows = labelled(s, d).select("doc_id", "text_sha256", "decision", "generation_id")
    held = assemble.generations_table(resolve.canonical_generations(b.parts(s, d)), rows, F.lit(FINGERPRINT)).select("generation_id", "raw_output")
    sql = assemble.RECIPE.format(input="{i}", labels="{l}", generations="{g}", keys="doc_id")
    x = s.sql(sql, i=b.table(s, d, "documents").select("doc_id"), l=rows, g=held)
    return x.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("decision") == "yes").alias("yes"), F.count("raw_output").alias("outputs"))


@query("SELECT s_name AS file FROM supplier WHERE s_suppkey % 3 <> 0")
def missing_viewers(s, d):
    x = b.table(s, d, "supplier")
    ledger = x.select(F.concat(F.lit("labels/"), "s_name").alias("path")).unionByName(x.filter("s_suppkey % 3 = 0").select(F.concat(F.lit("viewer/"), "s_name").alias("path")))
    return assemble.missing_viewers(ledger)


# geography


_PLACED = "placed AS (SELECT l.*, p.cell FROM labelled l LEFT JOIN polygon_cells p ON p.polygon_id = printf('p%05d', l.doc_id % 500))"


def placed(s: SparkSession, d: str) -> DataFrame:
    x = labelled(s, d).withColumn("polygon_id", F.format_string("p%05d", F.col("doc_id") % 500))
    return geo.website_cells(x, b.polygons(s, d), geo.grid_cell)


_GEO = (*_ALL, POLYGONS, _PLACED)


#: Events as answers at places all over the world, whole thousandths of a degree.
_SPOTS = "spots AS (SELECT event_id, (event_id * 7919 % 359999) / 1000 - 180 AS lon, (event_id * 104729 % 179999) / 1000 - 90 AS lat, value > 50 AS yes FROM events)"


def _sphere_sql(order: int = cells.ORDER) -> str:
    """The cell of each spot, step by step."""
    n = 1 << order
    digits = " || ".join(f"CAST((y >> {k}) % 2 * 2 + (x >> {k}) % 2 AS VARCHAR)" for k in reversed(range(order)))
    return f"""points AS (SELECT event_id, yes, sin(radians(lat)) AS z, (CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) / 90 AS t FROM spots),
lines AS (SELECT *, CAST(floor({n} * (t + 0.5::DOUBLE) - {n} * 0.75::DOUBLE * z) AS BIGINT) AS a, CAST(floor({n} * (t + 0.5::DOUBLE) + {n} * 0.75::DOUBLE * z) AS BIGINT) AS b, least(3, CAST(floor(t) AS BIGINT)) AS q, {n} * sqrt(3 * (1 - abs(z))) AS r FROM points),
caps AS (SELECT *, least({n - 1}, CAST(floor((t - q) * r) AS BIGINT)) AS c, least({n - 1}, CAST(floor((1 - (t - q)) * r) AS BIGINT)) AS e, abs(z) <= 2.0::DOUBLE / 3.0::DOUBLE AS belt FROM lines),
faced AS (SELECT event_id, yes, CASE WHEN belt THEN CASE WHEN a // {n} = b // {n} THEN a // {n} % 4 + 4 WHEN a // {n} < b // {n} THEN a // {n} ELSE b // {n} + 8 END WHEN z >= 0 THEN q ELSE q + 8 END AS face,
  CASE WHEN belt THEN b % {n} WHEN z >= 0 THEN {n - 1} - e ELSE c END AS x, CASE WHEN belt THEN {n - 1} - a % {n} WHEN z >= 0 THEN {n - 1} - c ELSE e END AS y FROM caps),
celled AS (SELECT event_id, yes, substr('{cells.FACES}', CAST(face + 1 AS BIGINT), 1) || {digits} AS cell FROM faced)"""


def _spots(s: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    x = b.table(s, d, "events").select(k, ((k * 7919 % 359999) / 1000 - 180).alias("lon"), ((k * 104729 % 179999) / 1000 - 90).alias("lat"), (F.col("value") > 50).alias("yes"))
    return x.select("event_id", "yes", cells.sphere_cell()(F.col("lon"), F.col("lat")).alias("cell"))


@query("SELECT event_id, cell FROM celled", _SPOTS, _sphere_sql())
def sphere_cells(s, d):
    return _spots(s, d).select("event_id", "cell")


@query("SELECT CAST(o AS INTEGER) AS \"order\", substr(cell, 1, o + 1) AS cell, count(*) FILTER (yes) AS yes, count(*) FILTER (NOT yes) AS no FROM celled, (VALUES (0), (2), (4), (6)) r(o) GROUP BY 1, 2", _SPOTS, _sphere_sql())
def rolled_up_cells(s, d):
    """Cells and those that hold them: a cell's counts are its children's sums."""
    rows = _spots(s, d).withColumn("decision", F.when(F.col("yes"), "yes").otherwise("no"))
    return geo.rolled_up(geo.binned(rows), [0, 2, 4, 6])


@query("SELECT cell, count(*) FILTER (decision = 'yes') AS yes, count(*) FILTER (decision = 'no') AS no FROM placed WHERE decision IN ('yes', 'no') AND cell IS NOT NULL GROUP BY cell", *_GEO)
def cell_binning(s, d):
    return geo.binned(placed(s, d))


@query("SELECT count(*) AS labelled, count(cell) AS located FROM placed WHERE decision IN ('yes', 'no')", *_GEO)
def located_counts(s, d):
    return geo.located(placed(s, d))


@query("SELECT *, CASE WHEN yes + no >= 10 THEN yes / (yes + no) END AS share FROM (SELECT cell, count(*) FILTER (decision = 'yes') AS yes, count(*) FILTER (decision = 'no') AS no FROM placed WHERE decision IN ('yes', 'no') AND cell IS NOT NULL GROUP BY cell)", *_GEO)
def cell_shares(s, d):
    """Per-file cells, merged."""
    x = placed(s, d)
    per_file = x.filter("decision in ('yes', 'no') and cell is not null").groupBy("source_file", "cell").agg(F.count_if(F.col("decision") == "yes").alias("yes"), F.count_if(F.col("decision") == "no").alias("no"))
    return geo.cell_shares(geo.merged_cells(per_file))


@query("SELECT count(*) AS sentences, count(*) FILTER (decision = 'yes') / count(*) AS share FROM placed WHERE decision IN ('yes', 'no') AND cell IS NOT NULL", *_GEO)
def global_share(s, d):
    return geo.global_share(geo.binned(placed(s, d)))


_LINKS = "links AS (SELECT doc_id AS document_id, printf('p%05d', (doc_id * k + 3) % 500) AS polygon_id FROM documents, (VALUES (1), (7), (11)) v(k))"


def _links(s: SparkSession, d: str) -> DataFrame:
    x = b.table(s, d, "documents").select(F.col("doc_id").alias("document_id"), F.explode(F.array(F.lit(1), F.lit(7), F.lit(11))).alias("k"))
    return x.select("document_id", F.format_string("p%05d", (F.col("document_id") * F.col("k") + 3) % 500).alias("polygon_id"))


@query("SELECT document_id, min_by(cell, polygon_id) AS cell FROM links JOIN polygon_cells USING (polygon_id) GROUP BY 1", POLYGONS, _LINKS)
def first_linked_polygon(s, d):
    return geo.document_cells(_links(s, d), b.polygons(s, d), geo.grid_cell)


@query("SELECT l.label_id, c.cell FROM labelled l LEFT JOIN (SELECT document_id, min_by(cell, polygon_id) AS cell FROM links JOIN polygon_cells USING (polygon_id) GROUP BY 1) c ON c.document_id = l.doc_id WHERE l.sentence_index = 0", *_ALL, POLYGONS, _LINKS)
def wiki_cells(s, d):
    x = labelled(s, d).filter("sentence_index = 0").select("label_id", F.col("doc_id").cast("string").alias("sentence_id"))
    rows = b.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("sentence_id"), F.col("doc_id").alias("document_id"), F.col("doc_id").alias("row_index"))
    return geo.wiki_cells(x, rows, _links(s, d), b.polygons(s, d), geo.grid_cell).select("label_id", "cell")


@query("SELECT text_sha256, cell FROM sentences s JOIN polygon_cells p ON p.polygon_id = printf('p%05d', s.doc_id % 500) WHERE NOT unsplit", SENTENCES, POLYGONS)
def website_text_cells(s, d):
    x = b.sentences(s, d).withColumn("polygon_id", F.format_string("p%05d", F.col("doc_id") % 500))
    return geo.website_text_cells(x, b.polygons(s, d), geo.grid_cell).select("text_sha256", "cell")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN CAST((c_nationkey % 9 + c_nationkey % 9 + 2) / 2 AS BIGINT) || '/' || CAST((c_custkey % 6 + c_custkey % 6 + 4) / 2 AS BIGINT) END AS cell FROM customer")
def description_cells(s, d):
    c = b.table(s, d, "customer")
    box = c.select(F.lit("way").alias("osm_type"), F.col("c_custkey").alias("osm_id"), (F.col("c_nationkey") % 9).cast("double").alias("bbox_min_x"), (F.col("c_custkey") % 6).cast("double").alias("bbox_min_y"), (F.col("c_nationkey") % 9 + 2).cast("double").alias("bbox_max_x"), F.when(F.col("c_custkey") % 7 != 0, (F.col("c_custkey") % 6 + 4).cast("double")).alias("bbox_max_y"), F.col("c_custkey").alias("row_index"))
    of = c.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").cast("string").alias("description_identity"), F.lit("way").alias("osm_type"), F.col("c_custkey").alias("osm_id"), F.col("c_custkey").alias("row_index"))
    labels = c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("description_identity"))
    return geo.description_cells(labels, of, box, geo.grid_cell).select("id", "cell")


# statistics


@query("SELECT source_file, decision, count(*) AS rows FROM labelled GROUP BY ALL", *_ALL)
def decision_counts(s, d):
    return stats.decision_counts(labelled(s, d), "source_file")


@query("SELECT failure_reason, count(*) AS rows FROM labelled WHERE decision = 'failed' AND failure_reason <> '' GROUP BY 1", *_ALL)
def failure_counts(s, d):
    return stats.failure_counts(labelled(s, d))


_COUNTS = ", ".join(f"count(*) FILTER (decision = '{x}') AS {x}" for x in stats.DECISIONS)


@query(f"SELECT source_file, {_COUNTS}, count(*) FILTER (decision IN ('yes', 'no')) AS labelled, count(cell) FILTER (decision IN ('yes', 'no')) AS located FROM placed GROUP BY 1", *_GEO)
def file_stats(s, d):
    return stats.file_stats(placed(s, d))


@query(f"SELECT count(DISTINCT source_file) AS files, {_COUNTS}, count(*) FILTER (decision IN ('yes', 'no')) AS labelled, count(cell) FILTER (decision IN ('yes', 'no')) AS located FROM placed", *_GEO)
def totals(s, d):
    return stats.totals(stats.file_stats(placed(s, d)))


_GPUS = ("NVIDIA L40S", "A100-SXM4-40GB", "nvidia  A40", "Tesla V100-PCIE")


@query("SELECT ['l40s', 'a100_sxm4_40gb', 'a40', 'tesla_v100_pcie'][o_custkey % 4 + 1] AS gpu, count(*) AS rows FROM orders GROUP BY 1")
def gpu_key_counts(s, d):
    name = F.element_at(F.array(*[F.lit(x) for x in _GPUS]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return stats.rows_per(b.table(s, d, "orders"), text.gpu_key(name), "gpu")


@query("SELECT s_name AS path FROM supplier WHERE s_suppkey % 4 = 0 OR s_suppkey % 5 = 0")
def files_to_count(s, d):
    x = b.table(s, d, "supplier").select(F.col("s_name").alias("path"), "s_suppkey")
    counted = x.filter("s_suppkey % 4 <> 0").select("path", (F.col("s_suppkey") % 5 == 0).alias("refreshed"), F.lit(None).cast("string").alias("cells"))
    return stats.files_to_count(x.select("path"), counted, True)


@query("SELECT event_type AS gpu, avg(CAST(event_id % 10 AS DOUBLE)) AS sentences_per_second FROM events GROUP BY 1")
def throughput(s, d):
    return stats.throughput(b.table(s, d, "events").select(F.col("event_type").alias("gpu"), (F.col("event_id") % 10).cast("double").alias("sentences_per_second")))


_USEFUL = "count(*) AS jobs, CAST(sum(s) AS DOUBLE) / CAST(sum(walltime_s) AS DOUBLE) AS useful_fraction, count(*) FILTER (early) / count(*) AS stopped_early, 1.0::DOUBLE - count(*) FILTER (early) / count(*) AS ran_to_checkpoint FROM (SELECT CASE WHEN gpu_key <> '' THEN gpu_key ELSE gpu END AS gpu, walltime_s, epoch(ended) - epoch(started) AS s, n % 2 <> 0 AND walltime_s - (epoch(ended) - epoch(started)) - 60 > CAST(0.1 AS DOUBLE) * walltime_s AS early FROM jobs WHERE n > 1)"


@query(f"SELECT gpu, {_USEFUL} GROUP BY GROUPING SETS ((gpu), ())", JOBS)
def useful_fraction(s, d):
    return stats.useful_fraction(b.jobs(s, d))


@query("SELECT o_orderpriority AS dataset, count(*) AS chunks, count(*) FILTER (o_orderstatus = 'F') AS chunks_complete, CAST(sum(o_custkey) AS BIGINT) AS texts, CAST(coalesce(sum(o_custkey) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS texts_complete, (SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem JOIN orders q ON l_orderkey = q.o_orderkey WHERE q.o_orderpriority = o.o_orderpriority)) AS live_jobs FROM orders o GROUP BY 1")
def status_counts(s, d):
    return _status(s, d).drop("rate", "eta_hours")


def _status(s: SparkSession, d: str) -> DataFrame:
    o = b.table(s, d, "orders")
    lines = o.select(F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").alias("chunk_id"), F.col("o_custkey").alias("size"))
    jobs = b.table(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.collect_set("l_orderkey").alias("chunks")).withColumn("gpu_key", (F.col("id") % 4).cast("string"))
    profiles = s.range(3).select(F.col("id").cast("string").alias("gpu_key"), ((F.col("id") + 1) * 2).cast("double").alias("sentences_per_second"))
    return stats.dataset_status(lines, o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("chunk_id")), jobs, profiles)


@query("SELECT dataset, (texts - done) / rate / 3600 AS eta_hours FROM (SELECT o_orderpriority AS dataset, sum(o_custkey) AS texts, sum(o_custkey) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY 1) JOIN (SELECT dataset, sum(CASE sk % 4 WHEN 3 THEN CAST(1.4 AS DOUBLE) ELSE (sk % 4 + 1) * 2 END) AS rate FROM (SELECT DISTINCT o_orderpriority AS dataset, l_suppkey AS sk FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1) USING (dataset)")
def status_eta(s, d):
    return _status(s, d).select("dataset", F.round("eta_hours", 6).alias("eta_hours"))


ORACLE["status_eta"] = "SELECT dataset, round(eta_hours, 6) AS eta_hours FROM (" + ORACLE["status_eta"] + ")"


@query("SELECT o_orderstatus AS state, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey % 2 = 0 GROUP BY 1")
def live_assignments(s, d):
    o = b.table(s, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "submitting").when(F.col("o_orderstatus") == "O", "submitted").otherwise("ended").alias("state"), (F.col("o_custkey") % 2).cast("string").alias("fp"))
    return stats.live(o, F.lit("0")).groupBy(F.when(F.col("state") == "submitting", "F").otherwise("O").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'end' WHEN c_custkey % 2 = 0 THEN 'adopt' ELSE 'keep' END AS action, count(*) AS n FROM customer GROUP BY 1")
def reconcile_jobs(s, d):
    c = b.table(s, d, "customer")
    mine = c.select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_custkey")).alias("job_id"))
    jobs = c.filter("c_custkey % 3 <> 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("job_id"))
    return stats.reconciled(mine, jobs).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS completed, count(*) FILTER (row_index % 4 = 0) AS rule_decided, CAST(sum(row_index) AS BIGINT) AS tokens, count(*) FILTER (decision = 'failed') AS failed FROM parsed", SENTENCES, PARTS, PARSED)
def run_counters(s, d):
    x = b.parts(s, d).withColumn("v", answers.parse_generation(F.col("raw_output"), F.col("truncated"))).select(F.when(F.col("row_index") % 4 == 0, "rule:no_letters").otherwise("stop").alias("finish_reason"), F.col("row_index").alias("generated_tokens"), "v.decision")
    return stats.run_counters(x)


@query("SELECT event_type, count(*) AS completed, count(*) FILTER (value > 20) AS failed, count(*) FILTER (value > 20) / count(*) > CAST(0.05 AS DOUBLE) AS alert FROM events GROUP BY 1")
def failed_rate_alerts(s, d):
    x = b.table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("completed"), F.count_if(F.col("value") > 20).alias("failed"))
    return x.withColumn("alert", timeline.failed_rate_alert(F.col("completed"), F.col("failed")))


@query("SELECT o_orderpriority AS dataset, count(*) > 0 AND count(*) FILTER (o_orderstatus <> 'P') = count(*) AND min(o_orderkey) % 2 = 1 AS done FROM orders GROUP BY 1")
def publish_done(s, d):
    g = b.table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.count(F.lit(1)).alias("files_total"), F.count_if(F.col("o_orderstatus") != "P").alias("files_complete"), F.min("o_orderkey").alias("k"))
    x = g.withColumn("mirrored", F.col("k") % 2 == 1).withColumn("unscanned", F.lit(0)).withColumn("stopped", F.lit(None).cast("string")).withColumn("revision", F.lit("r"))
    return stats.publish_done(x, F.lit("r")).select("dataset", "done")


@query("SELECT s_nationkey AS cluster, min(w) AS \"window\" FROM (SELECT s_nationkey, s_suppkey AS w, CAST(s_suppkey % 50 AS DOUBLE) AS rate, max(CAST(s_suppkey % 50 AS DOUBLE)) OVER () AS top FROM supplier) WHERE rate >= top * (1.0::DOUBLE - CAST(0.03 AS DOUBLE)) GROUP BY 1 ORDER BY 2 LIMIT 1")
def calibration_best(s, d):
    x = b.table(s, d, "supplier").select(F.col("s_nationkey").alias("cluster"), F.col("s_suppkey").alias("window"), (F.col("s_suppkey") % 50).cast("double").alias("rate"))
    return stats.calibration_pick(x).join(x, ["window", "rate"]).select("cluster", "window")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS versions, max_by(value, event_id) AS value, min(event_id) AS first_seq FROM events GROUP BY 1")
def ledger_last_wins(s, d):
    from corpusloom.sources.ledgers import last_wins

    x = b.table(s, d, "events").select("user_id", "value", F.col("event_id").alias("seq"))
    return last_wins(x, "user_id").select("user_id", "versions", "value", "first_seq")


# quality


_CELLS_OF = "count(*) FILTER (expected = 'yes' AND {p} = 'yes') AS tp, count(*) FILTER (expected = 'yes' AND {p} = 'no') AS fn, count(*) FILTER (expected = 'no' AND {p} = 'no') AS tn, count(*) FILTER (expected = 'no' AND {p} = 'yes') AS fp, count(*) FILTER ({p} IS NULL) AS failed"
_RATIO = "CASE WHEN {1} = 0 THEN 0.0::DOUBLE ELSE CAST({0} AS DOUBLE) / CAST({1} AS DOUBLE) END"
_SCORES = f"""*, {_RATIO.format("(tp + tn)", "(tp + fn + tn + fp + failed)")} AS accuracy, CASE WHEN p + r = 0 THEN 0 ELSE 2.0::DOUBLE * p * r / (p + r) END AS f1, p AS precision, r AS recall, (r + {_RATIO.format("tn", "(tn + fp)")}) / 2 AS balanced_accuracy,
  {_RATIO.format("(tp * tn - fp * fn)", "sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn))")} AS mcc, {_RATIO.format("failed", "(tp + fn + tn + fp + failed)")} AS failed_rate"""
_PR = f"{_RATIO.format('tp', '(tp + fp)')} AS p, {_RATIO.format('tp', '(tp + fn)')} AS r"


def _scored(p: str) -> str:
    return f"(SELECT {_SCORES} FROM (SELECT *, {_PR} FROM (SELECT language, {_CELLS_OF.format(p=p)} FROM bench GROUP BY 1)))"


@query(f"SELECT language, {_CELLS_OF.format(p='predicted')} FROM bench GROUP BY 1", BENCHMARK)
def confusion(s, d):
    return quality.confusion(b.benchmark_rows(s, d), "language")


@query(f"SELECT language, {', '.join(f'round({c}, 12) AS {c}' for c in quality.SCORES)} FROM {_scored('predicted')}", BENCHMARK)
def scores(s, d):
    return quality.scores(quality.confusion(b.benchmark_rows(s, d), "language")).select("language", *[F.round(c, 12).alias(c) for c in quality.SCORES])


@query(f"SELECT {', '.join(f'round(avg({c}), 10) AS {c}' for c in quality.SCORES)} FROM {_scored('predicted')}", BENCHMARK)
def macro_scores(s, d):
    return quality.macro_scores(b.benchmark_rows(s, d)).select(*[F.round(c, 10).alias(c) for c in quality.SCORES])


@query("SELECT cap, count(*) FILTER (generated_tokens > cap) / count(*) AS rate FROM bench, (VALUES (500), (1000), (2000), (4000)) c(cap) GROUP BY 1", BENCHMARK)
def budget_truncation(s, d):
    return quality.truncation_rates(b.benchmark_rows(s, d), [500, 1000, 2000, 4000])


def _pairs(s: SparkSession, d: str) -> DataFrame:
    x = b.benchmark_rows(s, d)
    return quality.complete_pairs(x.drop("candidate"), x.select("item_id", F.col("candidate").alias("predicted")))


@query("SELECT count(*) FILTER (predicted IS NOT DISTINCT FROM candidate) / count(*) AS agreement FROM bench", BENCHMARK)
def agreement(s, d):
    return quality.agreement(_pairs(s, d))


@query(f"SELECT a.language, {', '.join(f'round(b.{c} - a.{c}, 12) AS delta_{c}' for c in ('f1', 'mcc', 'failed_rate', 'accuracy'))} FROM {_scored('predicted')} a JOIN {_scored('candidate')} b USING (language)", BENCHMARK)
def gate_point_deltas(s, d):
    return quality.point_deltas(_pairs(s, d)).select("language", *[F.round(c, 12).alias(c) for c in ("delta_f1", "delta_mcc", "delta_failed_rate", "delta_accuracy")])


@query(
    f"""SELECT {', '.join(f'round(avg(delta_{c}), 10) AS delta_{c}' for c in ('f1', 'mcc', 'failed_rate', 'accuracy'))}, (SELECT count(*) FILTER (predicted IS NOT DISTINCT FROM candidate) / count(*) FROM bench) AS agreement,
  min_by(language, struct_pack(d := delta_f1, l := language)) AS worst_language, round(min(delta_f1), 10) AS worst_language_delta_f1
FROM (SELECT a.language, {', '.join(f'b.{c} - a.{c} AS delta_{c}' for c in ('f1', 'mcc', 'failed_rate', 'accuracy'))} FROM {_scored('predicted')} a JOIN {_scored('candidate')} b USING (language))""",
    BENCHMARK,
)
def gate_points(s, d):
    x = quality.gate_points(_pairs(s, d))
    return x.select(*[F.round(c, 10).alias(c) if "delta" in c else F.col(c) for c in x.columns])


@query()
def gate(s, d):
    """The bounds are random and have no SQL form; tests hold them against a plain bootstrap."""
    return quality.gate_over_strata(_pairs(s, d))


@query()
def gate_at_scale(s, d):
    """The bounds alone."""
    return quality.bootstrap_bounds(_pairs(s, d))


@query()
def budget_simulation(s, d):
    return quality.simulate_budgets(b.benchmark_rows(s, d), [500, 1000, 2000, 4000])


# schedule and calendar


@query("SELECT n_name AS cluster, CAST(sum(CASE WHEN a + c > 0 THEN (a + f) * g // nullif(a + f + c, 0) ELSE 0 END) AS BIGINT) AS free FROM (SELECT s_nationkey, s_suppkey % 24 AS a, s_suppkey % 5 AS f, s_suppkey % 7 + 1 AS c, s_suppkey % 4 + 1 AS g FROM supplier) JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def free_gpus(s, d):
    k = F.col("s_suppkey")
    x = b.table(s, d, "supplier").join(b.table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return schedule.free_gpus(x.select(F.col("n_name").alias("cluster"), (k % 24).alias("free_slots"), (k % 5).alias("freeable_slots"), (k % 7 + 1).alias("busy_slots"), (k % 4 + 1).alias("gpus_per_node")), True)


_SLOTS = "slots AS (SELECT s_nationkey AS site, s_suppkey AS cluster, s_suppkey % 5 AS free, CASE WHEN s_suppkey % 6 > 0 THEN CAST(s_suppkey % 6 * 1800 AS DOUBLE) END AS walltime_s, CAST(s_suppkey % 9 + 1 AS DOUBLE) AS rate, s_suppkey % 2 = 0 AS besteffort, s_suppkey % 3 = 0 AS room FROM supplier), offered AS (SELECT *, CASE WHEN free <= 0 THEN 1 ELSE free END AS free_nodes, CASE WHEN free <= 0 THEN 900.0 ELSE 0.0 END AS wait_s FROM slots WHERE walltime_s IS NOT NULL AND (free > 0 OR (room AND NOT besteffort)))"


def _slots(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    x = b.table(s, d, "supplier").select(F.col("s_nationkey").alias("site"), k.alias("cluster"), (k % 5).alias("free"), F.when(k % 6 > 0, (k % 6 * 1800).cast("double")).alias("walltime_s"), (k % 9 + 1).cast("double").alias("rate"), (k % 2 == 0).alias("besteffort"), (k % 3 == 0).alias("queue_room"))
    return schedule.slots(x, 900.0)


@query("SELECT site, cluster, free_nodes, row_number() OVER (ORDER BY u DESC, site, cluster) - 1 AS rank FROM (SELECT *, rate * greatest(0.0, walltime_s - 480.0) / (1.0 + wait_s / 3600.0) AS u FROM offered) WHERE u > 0", _SLOTS)
def rank_slots(s, d):
    return schedule.ranked_slots(_slots(s, d), 480.0).select("site", "cluster", F.col("free_nodes").cast("bigint").alias("free_nodes"), F.col("rank").cast("bigint").alias("rank"))


@query("SELECT o_orderpriority AS dataset, o_orderkey AS chunk_id, CAST(used AS BIGINT) AS used FROM (SELECT *, sum(o_custkey) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS used, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)) WHERE k = 1 OR used <= 20000")
def greedy_prefix(s, d):
    o = b.table(s, d, "orders").select(F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").alias("chunk_id"), F.col("o_custkey").alias("size"), F.col("o_orderkey").alias("seq"))
    taken = b.table(s, d, "lineitem").filter("l_linenumber = 7").select(F.col("l_orderkey").alias("chunk_id"))
    return schedule.greedy_prefix(o, taken, F.lit(20000), by="dataset").select("dataset", "chunk_id", "used")


@query()
def launch_plan(s, d):
    """Each choice depends on those before, so the driver decides over a few slots; tests hold it against a plain loop."""
    plan = schedule.LaunchPlan(12, 4)
    ranked = schedule.enough_slots(schedule.ranked_slots(_slots(s, d), 480.0), plan.most_total, plan.most_per_site).orderBy("rank").collect()
    lines = b.table(s, d, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").toLocalIterator()
    plan = plan.fill([(str(r.site), str(r.cluster), int(r.free_nodes), float(r.useful)) for r in ranked], ((str(r[0]), int(r[1])) for r in lines), [])
    return s.createDataFrame([(x.index, x.site, x.cluster, len(x.chunks)) for x in plan], "index int, site string, cluster string, chunks int")


@query("SELECT event_id, CASE WHEN a > 0 THEN a WHEN c > 0 THEN c END AS first, CAST(a > 0 AS BIGINT) + CAST(c > 0 AND c <> a AS BIGINT) AS rungs FROM (SELECT event_id, least(f, w) AS a, least(g, f, w) AS c FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id % 7 ELSE 4 END AS f, CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE coalesce(CASE WHEN event_id % 3 = 0 THEN 2 END, 4) END AS g, event_id % 6 AS w FROM events))")
def walltime_ladder(s, d):
    k = F.col("event_id")
    ladder = schedule.walltime_ladder(k % 6, k % 2 == 0, F.lit(4).cast("bigint"), k % 7, k % 5, F.when(k % 3 == 0, F.lit(2).cast("bigint")))
    return b.table(s, d, "events").select("event_id", F.get(ladder, F.lit(0)).alias("first"), F.size(ladder).cast("bigint").alias("rungs"))


@query("SELECT s_suppkey AS id, list_has_any(q, ['production', 'abaca']) AS production, list_has_any(q, ['production', 'abaca', 'default']) AS submittable, CASE WHEN maj < 8 THEN 'compute capability ' || maj || '.' || mn || ' < 8.0' WHEN mem < 16384 THEN mem || ' MiB < 16384 MiB' END AS reason FROM (SELECT s_suppkey, [['production'], ['default', 'testing'], ['testing'], ['abaca', 'default']][s_suppkey % 4 + 1] AS q, s_suppkey % 4 + 6 AS maj, s_suppkey % 10 AS mn, s_suppkey % 7 * 4096 AS mem FROM supplier)")
def gpu_eligibility(s, d):
    k = F.col("s_suppkey")
    lists = [["production"], ["default", "testing"], ["testing"], ["abaca", "default"]]
    x = b.table(s, d, "supplier").select(k.alias("id"), F.element_at(F.array(*[F.array(*[F.lit(q) for q in xs]) for xs in lists]), (k % 4 + 1).cast("int")).alias("queues"), (k % 4 + 6).alias("major"), (k % 10).alias("minor"), (k % 7 * 4096).alias("memory"))
    return x.select("id", schedule.is_production(F.col("queues")).alias("production"), schedule.is_submittable(F.col("queues")).alias("submittable"), schedule.ineligibility(F.col("memory"), F.col("major"), F.col("minor")).alias("reason"))


_EASTER = "cal AS (SELECT CAST(unnest(generate_series(DATE '2023-12-01', DATE '2025-02-28', INTERVAL 1 DAY)) AS DATE) AS day), work AS (SELECT day, isodow(day) < 6 AND NOT (month(day) * 100 + day(day)) IN (101, 501, 508, 714, 815, 1101, 1111, 1225) AND day NOT IN (DATE '2024-04-01', DATE '2024-05-09', DATE '2024-05-20') AS working FROM cal)"


@query("SELECT day, working FROM work", _EASTER)
def calendar_days(s, d):
    return calendar.calendar(s, "2023-12-01", "2025-02-28")


@query("SELECT event_id, coalesce(w.working, false) AND hour(submitted) >= 9 AND hour(submitted) < 19 AS daytime, epoch(CASE WHEN hour(submitted) < 9 AND coalesce(w.working, false) THEN CAST(submitted AS DATE) + INTERVAL 9 HOUR ELSE (SELECT min(day) FROM work n WHERE n.working AND n.day > CAST(submitted AS DATE)) + INTERVAL 9 HOUR END)::BIGINT AS next_start FROM moments LEFT JOIN work w ON w.day = CAST(submitted AS DATE)", _EASTER, MOMENTS)
def calendar_daytime(s, d):
    x = boundaries.with_day_starts(b.moments(s, d).select("event_id", "submitted"), "submitted")
    return x.select("event_id", "daytime", F.unix_timestamp("next_day_start").alias("next_start"))


@query("SELECT event_id, EXISTS (SELECT 1 FROM work w, (VALUES (9), (19)) e(h) WHERE w.working AND w.day + to_hours(e.h) > m.start AND w.day + to_hours(e.h) < m.\"end\" AND NOT (e.h = 19 AND w.day = CAST(m.submitted AS DATE) AND hour(m.submitted) >= 17)) AS crosses FROM moments m", _EASTER, MOMENTS)
def boundary_crossing(s, d):
    return boundaries.crossings(b.moments(s, d)).select("event_id", "crosses")


@query("SELECT event_id, CASE WHEN dt AND epoch(start) - epoch(submitted) > 600 THEN 'would start late' WHEN x THEN 'would cross a day/night boundary' ELSE 'ok' END AS reason FROM (SELECT event_id, submitted, start, EXISTS (SELECT 1 FROM work w WHERE w.working AND w.day = CAST(submitted AS DATE)) AND hour(submitted) >= 9 AND hour(submitted) < 19 AS dt, EXISTS (SELECT 1 FROM work w, (VALUES (9), (19)) e(h) WHERE w.working AND w.day + to_hours(e.h) > m.start AND w.day + to_hours(e.h) < m.\"end\" AND NOT (e.h = 19 AND w.day = CAST(m.submitted AS DATE) AND hour(m.submitted) >= 17)) AS x FROM moments m)", _EASTER, MOMENTS)
def job_verdicts(s, d):
    return boundaries.verdicts(b.moments(s, d)).select("event_id", "reason")


@query("SELECT event_id, event_id % 3 = 0 AND epoch(start) - epoch(submitted) > 7200 AS zombie, event_id % 2 = 0 AND event_id % 3 = 0 AND epoch(start) - epoch(submitted) >= 1200 AS stale FROM moments", MOMENTS)
def stale_jobs(s, d):
    x = b.moments(s, d).withColumn("state", F.when(F.col("event_id") % 3 == 0, "Waiting").otherwise("Running")).withColumn("queue", F.when(F.col("event_id") % 2 == 0, "besteffort").otherwise("default"))
    return x.select("event_id", calendar.is_zombie(F.col("state"), F.col("submitted"), F.col("start")).alias("zombie"), calendar.is_stale_besteffort(F.col("queue"), F.col("state"), F.col("submitted"), F.col("start")).alias("stale"))


@query("SELECT l_orderkey, l_linenumber, (m // 60) || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') AS walltime, CASE WHEN l_suppkey % 2 = 0 THEN 'signal SIGUSR2' WHEN l_partkey >= l_orderkey - 360 THEN 'deadline' END AS stop FROM (SELECT *, l_partkey * 7 // 60 AS m FROM lineitem)")
def deadlines(s, d):
    x = b.table(s, d, "lineitem")
    stop = timeline.stop_reason(F.col("l_partkey"), F.col("l_orderkey"), F.when(F.col("l_suppkey") % 2 == 0, "SIGUSR2"))
    return x.select("l_orderkey", "l_linenumber", timeline.walltime_text(F.col("l_partkey") * 7).alias("walltime"), stop.alias("stop"))


@query("SELECT p FROM (SELECT 'w/' || ['code', 'cache', 'logs', 'work'][p_partkey % 4 + 1] || '/' || CASE p_partkey % 4 WHEN 1 THEN 'venv-' ||(p_partkey % 3) WHEN 3 THEN 'parts/' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS p, p_partkey AS k, p_size AS age FROM part) WHERE CASE k % 4 WHEN 0 THEN k % 8 <> 0 WHEN 1 THEN k % 3 <> 1 WHEN 2 THEN age > 7 ELSE k % 5 = 0 END")
def cleanup_candidates(s, d):
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("code", "cache", "logs", "work")]), (k % 4 + 1).cast("int"))
    rest = F.when(k % 4 == 1, F.concat(F.lit("venv-"), (k % 3).cast("string"))).when(k % 4 == 3, F.concat(F.lit("parts/"), k.cast("string"))).otherwise(k.cast("string"))
    x = b.table(s, d, "part")
    paths = x.select(F.concat(F.lit("w/"), kind, F.lit("/"), rest).alias("path"), F.col("p_size").alias("age_days"))
    keep = x.filter("p_partkey % 8 = 0").select(k.cast("string").alias("commit"))
    synced = x.filter("p_partkey % 5 = 0").select(k.cast("string").alias("part"))
    return schedule.removable(paths, keep, "1", synced, "w/").select(F.col("path").alias("p"))


def flagship(s: SparkSession, d: str) -> DataFrame:
    """Sentences, unique texts, verdicts, labels, decisions by file: the whole way."""
    return stats.file_stats(placed(s, d))


# streams


def _streamed(s: SparkSession, rows: DataFrame, name: str, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Writes the rows as files, takes these in as a stream in batches of four files, and returns the last version of each key."""
    root = shared_folder(s, name)
    rows.repartition(8).write.parquet(f"{root}/in")
    stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    ingest.run_available(build(stream), ingest.checkpoint_for(root, name), ingest.versions_to(f"{root}/out")).awaitTermination()
    return ingest.latest(s, f"{root}/out", key)


@query("SELECT chunk_id, count(DISTINCT text_sha256) AS done FROM parts GROUP BY 1", SENTENCES, PARTS)
def stream_progress(s, d):
    rows = b.parts(s, d).select("chunk_id", "text_sha256")
    return _streamed(s, rows, "progress", "chunk_id", lambda x: ingest.progress_stream(x.dropDuplicates(["chunk_id", "text_sha256"])))


@query("SELECT text_sha256, decision, parse_mode, failure_reason, part_key FROM verdicts", SENTENCES, PARTS, PARSED, VERDICTS)
def stream_resolution(s, d):
    rows = b.parts(s, d).select("text_sha256", "raw_output", "truncated", "part_key", "row_index")
    return _streamed(s, rows, "resolution", "text_sha256", ingest.verdict_stream)


# parts that are written, pulled and caught up with


def _appended(s: SparkSession, d: str, root: str) -> DataFrame:
    """Writes the results as parts under root, with their manifests; returns the results."""
    rows = b.parts(s, d).select("text_sha256", "raw_output", "truncated", "chunk_id", F.lit(FINGERPRINT).alias("config_fingerprint"))
    parts.append_results(rows, root)
    return rows


@query("SELECT chunk_id, count(*) AS n, count(DISTINCT text_sha256) AS texts, CAST(sum(length(raw_output)) AS BIGINT) AS chars, count(*) FILTER (truncated) AS truncated, count(DISTINCT text_sha256) AS named, 0::BIGINT AS corrupt FROM parts GROUP BY chunk_id", SENTENCES, PARTS)
def appended_parts(s, d):
    """Parts and manifests are committed in two phases and read back, each part once and verified."""
    root = shared_folder(s, "parts")
    _appended(s, d, root)
    back = parts.scan_parts(s, root, "text_sha256 string, raw_output string, truncated boolean, chunk_id string")
    chunk = F.coalesce("chunk_id", F.element_at(F.split("part_key", "/"), 2)).alias("chunk_id")
    sums = back.groupBy(chunk).agg(
        F.count("row_index").alias("n"), F.countDistinct("text_sha256").alias("texts"), F.sum(F.char_length("raw_output")).alias("chars"), F.count_if("truncated").alias("truncated"), F.count_if("corrupt").alias("corrupt")
    )
    named = parts.read_manifests(s, f"{root}/*/*/*.json").groupBy("chunk_id").agg(F.countDistinct("text_sha256").alias("named"))
    return sums.join(named, "chunk_id")


def _stateful(s: SparkSession) -> dict[str, str]:
    """Settings of the stateful streams here: there are 256 chunks, so a few partitions of state do."""
    return progress.ROCKSDB | {"spark.sql.shuffle.partitions": str(min(16, int(s.conf.get("spark.sql.shuffle.partitions"))))}


#: Every third chunk is planned with one text more than there are results.
_PLANNED = "planned AS (SELECT chunk_id, count(DISTINCT text_sha256) AS done, count(DISTINCT text_sha256) + CASE WHEN CAST('0x' || chunk_id AS INTEGER) % 3 = 0 THEN 1 ELSE 0 END AS size FROM parts GROUP BY chunk_id)"


@query("SELECT chunk_id, done, done >= size AS complete, CASE WHEN done >= size THEN 0 ELSE done END AS held FROM planned", SENTENCES, PARTS, _PLANNED)
def bounded_pulls(s, d):
    """Manifests are pulled a hundred at a time, each pull a run of its own from the checkpoint; the state of complete chunks is let go."""
    root = shared_folder(s, "pulls")
    rows = _appended(s, d, f"{root}/parts")
    more = (F.conv("chunk_id", 16, 10).cast("int") % 3 == 0).cast("bigint")
    rows.groupBy("chunk_id").agg(F.countDistinct("text_sha256").alias("n")).select("chunk_id", (F.col("n") + more).alias("size")).write.parquet(f"{root}/lines")
    lines = s.read.parquet(f"{root}/lines")
    with configured(s, _stateful(s)):
        pull = pulls.Pull()
        while not pull.number or not pull.settled():
            stream = pulls.manifest_pulls(s, f"{root}/parts/{FINGERPRINT}", f"{root}/log", limits=pulls.Limits(files=100, reconcile=1e9))
            ingest.run_available(progress.chunk_progress(stream, lines), f"{root}/checkpoint", ingest.versions_to(f"{root}/out")).awaitTermination()
            pull = pulls.last_pull(f"{root}/log")
        got = ingest.latest(s, f"{root}/out", "chunk_id").join(progress.held(s, f"{root}/checkpoint"), "chunk_id", "left")
        got.select("chunk_id", "done", "complete", F.coalesce("held", F.lit(0)).alias("held")).write.parquet(f"{root}/progress")
    return s.read.parquet(f"{root}/progress")


@query("SELECT text_sha256, decision, parse_mode, failure_reason, row_index FROM (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY part_key, row_index) AS r FROM parsed) WHERE r = 1", SENTENCES, PARTS, PARSED)
def levelled_resolution(s, d):
    """Eight batches, in two runs, into levels of runs; the rows carry their own keys here."""
    root = shared_folder(s, "levels")
    rows = b.parts(s, d).select("text_sha256", "raw_output", "truncated", "part_key", "row_index")
    rows.write.option("compression", "zstd").parquet(f"{root}/rows")
    rows = s.read.parquet(f"{root}/rows")
    store = resolution.ResolutionStore(s, f"{root}/store", buckets=4, fanout=3)
    for half in (0, 1):
        rows.filter(F.pmod(F.xxhash64("text_sha256", "row_index"), F.lit(2)) == half).repartition(4).write.mode("append").parquet(f"{root}/in")
        stream = s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        ingest.run_available(stream, f"{root}/checkpoint", store.sink(), "append").awaitTermination()
    return store.verdicts().drop("part_key")


@query("SELECT chunk_id, 0 AS ord_rank, ord_file, size, prompt_tokens, seq FROM chunks", SENTENCES, TEXTS, _FILE_ORDER, _CHUNKS)
def grown_plan(s, d):
    """The plan of chunk_ids(), grown in three appends with the tail held back until the end."""
    root = shared_folder(s, "plan")
    builder = plan_builder.PlanBuilder(s, root, CHUNK, F.lit(FINGERPRINT))
    unique = planning.unique_texts(b.sentences(s, d)).select("text_sha256", "file_idx", F.length("text").alias("prompt_tokens"), F.lit(0).alias("ord_rank"), F.col("file_idx").alias("ord_file"))
    unique.write.option("compression", "zstd").parquet(f"{root}/unique")
    unique = s.read.parquet(f"{root}/unique")  # each append reads its files' texts several times
    last = b.files(s, d).agg(F.max("file_idx")).first()[0] or 0
    for k in range(3):
        builder.append(unique.filter((F.col("file_idx") * 3 >= k * (last + 1)) & (F.col("file_idx") * 3 < (k + 1) * (last + 1))), k)
        builder.emit(final=k == 2, per=100)
    return planning.plan_lines(builder.emitted())


@query("SELECT chunk_id, count(*) // 20 * 20 AS out, count(*) % 20 AS held, count(*) // 20 AS flushes FROM parts GROUP BY chunk_id HAVING count(*) >= 20", SENTENCES, PARTS)
def flushed_parts(s, d):
    """Results go out by twenty a chunk, over two batches; what isn't full waits."""
    root = shared_folder(s, "flush")
    rows = b.parts(s, d).select("text_sha256", "raw_output", "chunk_id", F.lit(FINGERPRINT).alias("config_fingerprint"))
    rows.repartition(4).write.parquet(f"{root}/in")
    with configured(s, _stateful(s)):
        stream = flush.flushed(s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in"), ["chunk_id"], rows=20, seconds=None)
        ingest.run_available(stream, f"{root}/checkpoint", flush.parts_sink(f"{root}/out", f"{root}/ledger"), "append").awaitTermination()
        progress.held(s, f"{root}/checkpoint", "waiting").write.parquet(f"{root}/held")
    out = parts.read_valid_parts(s, f"{root}/out", "chunk_id string, flush long").groupBy("chunk_id").agg(F.count(F.lit(1)).alias("out"), F.max("flush").alias("flushes"))
    return out.join(s.read.parquet(f"{root}/held"), "chunk_id", "left").select("chunk_id", "out", F.coalesce("held", F.lit(0)).alias("held"), "flushes")


#: Events as reports of jobs: the wall clock is set now and then.
_REPORTS = """
reports AS (SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS job, ts + to_hours(CAST(event_id % 7 - 3 AS BIGINT)) AS wall, epoch_us(ts) AS mono, CASE event_type WHEN 'signup' THEN 'engine_ready' WHEN 'error' THEN 'signal' ELSE 'result' END AS kind, event_id FROM events),
anchors AS (SELECT job, min(struct_pack(m := mono, w := wall)) AS a, min(mono) FILTER (kind = 'engine_ready') AS ready, min(mono) FILTER (kind = 'result') AS first, max(mono) FILTER (kind = 'result') AS last, max(mono) AS final,
  CAST(max(CASE WHEN event_id % 3 <> 0 THEN event_id % 100 END) AS INTEGER) AS env_ready_seconds, max(event_id % 9 * 600) AS walltime_s, max(event_id % 5000) AS assigned_texts FROM reports GROUP BY job)"""
_STAMP = "strftime(a.w + to_microseconds({} - a.m), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS {}"
_STAMPS = ", ".join(_STAMP.format(c, n) for n, c in (("started_at", "a.m"), ("engine_ready_at", "ready"), ("first_result_at", "first"), ("last_result_at", "last"), ("ended_at", "final")))


@query(f"SELECT job, {_STAMPS}, env_ready_seconds, walltime_s, assigned_texts FROM anchors", _REPORTS)
def job_timelines(s, d):
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    kind = F.when(F.col("event_type") == "signup", "engine_ready").when(F.col("event_type") == "error", "signal").otherwise("result")
    x = b.table(s, d, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("job"), F.timestamp_micros(F.unix_micros(ts) + (k % 7 - 3) * 3_600_000_000).alias("wall"), (F.unix_micros(ts) / 1e6).alias("mono"), kind.alias("kind"),
        F.when(k % 3 != 0, (k % 100).cast("string")).otherwise("?").alias("env_ready"), (k % 9 * 600).alias("walltime_s"), (k % 5000).alias("assigned_texts"),
    )
    return timelines.timeline_records(x)


@query("SELECT source_file, file_idx // 8 AS run, count(*) AS sentences FROM sentences GROUP BY ALL", SENTENCES)
def resumed_runs(s, d):
    """Eight files a run, each run behind the marks of the one before."""
    root = shared_folder(s, "runs")
    work, n, run = b.files(s, d).withColumnRenamed("source_file", "path"), 1, 0
    job = marks.FileMarks(s, root, "count")
    while n:
        n = job.run(work, lambda some, run=run: b.sentences(s, d).join(some.select(F.col("path").alias("source_file")), "source_file").groupBy("source_file").agg(F.count(F.lit(1)).alias("sentences")).withColumn("run", F.lit(run).cast("bigint")).write.parquet(f"{root}/out/{run}"), 8)
        run += 1
    return s.read.option("recursiveFileLookup", "true").parquet(f"{root}/out").select("source_file", "run", "sentences")


@query("SELECT 'labels/' || s_name AS path, s_suppkey AS rows FROM supplier WHERE s_suppkey % 3 <> 0")
def reset_counts(s, d):
    kind = F.when(F.col("s_suppkey") % 3 == 0, "generations/").otherwise("labels/")
    return marks.without_generation_counts(b.table(s, d, "supplier").select(F.concat(kind, "s_name").alias("path"), F.col("s_suppkey").alias("rows")))


@query("SELECT user_id, CAST(day AS VARCHAR) AS day, CASE gpu WHEN 'click' THEN 96 ELSE 64 END AS max_running_requests, CASE gpu WHEN 'click' THEN 0.9 ELSE 0.75 END::DOUBLE AS mem_fraction_static, CAST(NULL AS INTEGER) AS cuda_graph_max_bs, CASE gpu WHEN 'click' THEN 5.5 WHEN 'view' THEN 3.6 ELSE 1.4 END::DOUBLE AS sentences_per_second, gpu = 'click' AS calibrated FROM jobs", JOBS)
def profile_defaults(s, d):
    schema = "gpu string, gpu_key string, max_running_requests int, mem_fraction_static double, cuda_graph_max_bs int, sentences_per_second double, calibrated boolean"
    profiles = s.createDataFrame([("c", "click", 96, 0.9, None, 5.5, True), ("v", "view", None, None, None, 3.6, None)], schema)
    x = b.jobs(s, d).select("user_id", F.col("day").cast("string").alias("day"), F.col("gpu").alias("gpu_key"))
    return stats.with_profiles(x, profiles).drop("gpu_key")


# records and waits


@query("SELECT language, item_id, expected, predicted AS reference, candidate FROM bench", BENCHMARK)
def complete_pairs(s, d):
    return _pairs(s, d)


@query("SELECT doc_id, sha256(text) AS text_sha256, '</think>no' AS raw_output, CAST(doc_id % 97 + 1 AS INTEGER) AS prompt_tokens, CAST(0 AS INTEGER) AS generated_tokens, 'rule:no_letters' AS finish_reason, false AS truncated FROM documents")
def rule_decided(s, d):
    x = b.table(s, d, "documents").select("doc_id", answers.rule_decided(F.sha2("text", 256), F.col("doc_id") % 97 + 1).alias("g"))
    return x.select("doc_id", "g.text_sha256", "g.raw_output", "g.prompt_tokens", "g.generated_tokens", "g.finish_reason", "g.truncated")


_ASKED = "asked AS (SELECT o_orderkey AS k, o_custkey % 900 AS p, o_orderkey % 500 AS x, o_custkey % 700 AS lim, o_orderkey % 3 AS kind FROM orders)"


@query("SELECT k, CASE kind WHEN 0 THEN CASE WHEN p > 0 AND lim > 0 AND p >= lim THEN p END WHEN 1 THEN CASE WHEN p > 0 AND x > 0 AND lim > 0 AND p + x > lim AND p < lim THEN p END END AS prompt, CASE WHEN kind = 1 AND p > 0 AND x > 0 AND lim > 0 AND p + x > lim AND p < lim THEN x END AS extra FROM asked", _ASKED)
def context_overflow(s, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    p, x, lim = c % 900, k % 500, c % 700
    alone = F.format_string("The input (%d tokens) is longer than the model's context length (%d tokens).", p, lim)
    both = F.format_string("Requested token count exceeds the model's maximum context length of %d tokens. You requested a total of %d tokens: %d tokens from the input messages and %d tokens for the completion.", lim, p + x, p, x)
    said = F.when(k % 3 == 0, alone).when(k % 3 == 1, both).otherwise("out of memory")
    return b.table(s, d, "orders").select(k.alias("k"), answers.context_overflow(said).alias("o")).select("k", "o.prompt", "o.extra")


@query("SELECT event_id, after, least(CASE WHEN after IS NOT NULL THEN after + 1.0 + 0.5 ELSE 2.0 * pow(2.0, attempt - 1) * 0.75 END, 300.0) AS delay, attempt >= 10 OR 1000.0 + least(CASE WHEN after IS NOT NULL THEN after + 1.0 + 0.5 ELSE 2.0 * pow(2.0, attempt - 1) * 0.75 END, 300.0) > 1200.0 AS over FROM (SELECT event_id, event_id % 12 + 1 AS attempt, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 400 AS DOUBLE) WHEN 1 THEN event_id % 50 + 0.5::DOUBLE END AS after FROM events)")
def retry_after(s, d):
    k = F.col("event_id")
    header = F.when(k % 3 == 0, F.concat(F.lit(" "), (k % 400).cast("string"))).when(k % 3 == 1, F.concat((k % 50).cast("string"), F.lit(".5 "))).otherwise("Wed, 21 Oct 2015 07:28:00 GMT")
    attempt, after = k % 12 + 1, timeline.retry_after(header)
    delay = timeline.next_delay(attempt, after, F.lit(0.5))
    return b.table(s, d, "events").select("event_id", after.alias("after"), delay.alias("delay"), timeline.give_up(attempt, F.lit(1000.0), delay).alias("over"))
