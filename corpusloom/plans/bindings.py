"""The driver's tables as the relations that the operators work on, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.identity import label_id, text_sha256

FINGERPRINT = "0123456789abcdef"
#: Raw outputs, by a hex digit.
TEMPLATES = (
    "reasoning says yes and no</think>yes", "x</think>\n\nno", "x</think>\"no\"", "a</think>b</think>no", "x</think>**Yes**.", "x</think>yes, it shows fields", "x</think>The answer is no.", "still thinking about yes",
    "x</think>   ", "x</think>The answer is yes or no.", "x</think>oui", "x</think>maybe", "luf_failure:input_too_long:131072>=131072", "luf_failure:input_too_long:127000+4096>131072", "luf_failure:input_too_long:126976+4096>131072", "</think>NO!",
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def files(spark: SparkSession, d: str) -> DataFrame:
    """source_file, file_idx: the sources, in order."""
    one = table(spark, d, "documents").select(F.col("source").alias("source_file")).distinct()
    return one.withColumn("file_idx", (F.row_number().over(Window.orderBy("source_file")) - 1).cast("bigint"))  # a row for each file


def sentences(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents; Spanish stands for a language without segmentation."""
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("source_file"), F.col("lang").alias("language"), (F.col("lang") == "es").alias("unsplit"), F.posexplode(F.split("text", "\n")).alias("sentence_index", "text"))
    rows = rows.withColumn("sentence_index", F.col("sentence_index").cast("bigint")).withColumn("text_sha256", text_sha256(F.col("text")))
    rows = rows.withColumn("label_id", label_id(F.lit("documents"), ["doc_id", "sentence_index"]))
    return rows.join(F.broadcast(files(spark, d)), "source_file")


SENTENCES = """
files AS (SELECT source AS source_file, row_number() OVER (ORDER BY source) - 1 AS file_idx FROM (SELECT DISTINCT source FROM documents)),
raw_sentences AS (SELECT doc_id, source AS source_file, lang AS language, lang = 'es' AS unsplit, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS sentence_index FROM documents),
sentences AS (SELECT r.*, f.file_idx, sha256(r.text) AS text_sha256, sha256('documents' || chr(31) || 'doc_id=' || r.doc_id || chr(31) || 'sentence_index=' || r.sentence_index) AS label_id FROM raw_sentences r JOIN files f USING (source_file))"""
TEXTS = "texts AS (SELECT text_sha256, min(file_idx) AS file_idx, any_value(text) AS text FROM sentences WHERE NOT unsplit GROUP BY text_sha256)"


def parts(spark: SparkSession, d: str) -> DataFrame:
    """Two result parts for each unique text, with answers that may differ."""
    one = sentences(spark, d).filter("not unsplit").select("text_sha256").distinct()
    rows = one.select("text_sha256", F.substring("text_sha256", 1, 2).alias("chunk_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("replica"))
    digit = lambda at: F.conv(F.substring("text_sha256", at, 1), 16, 10).cast("int")
    pick = F.when(F.col("replica") == 0, digit(3)).otherwise(digit(4))
    part = F.substring(F.sha2(F.concat("chunk_id", F.lit(":"), F.pmod(digit(5) + F.col("replica"), F.lit(2)).cast("string")), 256), 1, 16)
    rows = rows.withColumn("raw_output", F.element_at(F.array(*[F.lit(t) for t in TEMPLATES]), pick + 1)).withColumn("truncated", (pick + digit(6)) % 11 == 0)
    rows = rows.withColumn("part", part).withColumn("part_key", F.concat_ws("/", "chunk_id", "part"))
    return rows.withColumn("row_index", (F.col("replica") * 16 + digit(7)).cast("bigint"))


_DIGIT = "CAST('0x' || substr(text_sha256, {0}, 1) AS INTEGER)"
_TEMPLATES = "[" + ", ".join("'" + t.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for t in TEMPLATES) + "]"
PARTS = f"""
keyed AS (SELECT DISTINCT text_sha256, substr(text_sha256, 1, 2) AS chunk_id FROM sentences WHERE NOT unsplit),
picked AS (SELECT *, CASE replica WHEN 0 THEN {_DIGIT.format(3)} ELSE {_DIGIT.format(4)} END AS pick FROM keyed, (VALUES (0), (1)) r(replica)),
parts AS (SELECT text_sha256, chunk_id, replica, {_TEMPLATES}[pick + 1] AS raw_output, (pick + {_DIGIT.format(6)}) % 11 = 0 AS truncated,
  substr(sha256(chunk_id || ':' || (({_DIGIT.format(5)} + replica) % 2)), 1, 16) AS part, chunk_id || '/' || substr(sha256(chunk_id || ':' || (({_DIGIT.format(5)} + replica) % 2)), 1, 16) AS part_key, CAST(replica * 16 + {_DIGIT.format(7)} AS BIGINT) AS row_index FROM picked)"""
#: Verdicts of ASCII outputs.
PARSED = """
answers AS (SELECT *, regexp_replace(regexp_replace(split_part(raw_output, '</think>', -1), '^[\\s]+', ''), '[\\s]+$', '') AS answer FROM parts),
marked AS (SELECT *, regexp_extract(raw_output, '^luf_failure:input_too_long:(\\d+)(?:\\+(\\d+))?(>=|>)(\\d+)$', ['a', 'x', 'op', 'b']) AS m FROM answers),
coded AS (SELECT *, CASE
  WHEN m.op = '>' AND TRY_CAST(m.a AS BIGINT) + coalesce(TRY_CAST(nullif(m.x, '') AS BIGINT), 0) > TRY_CAST(m.b AS BIGINT) OR m.op = '>=' AND m.x = '' AND TRY_CAST(m.a AS BIGINT) >= TRY_CAST(m.b AS BIGINT) THEN 'failed//input_too_long'
  WHEN truncated THEN 'failed//truncated'
  WHEN NOT contains(raw_output, '</think>') THEN 'failed//unclosed_think'
  WHEN answer = '' THEN 'failed//empty'
  WHEN regexp_matches(answer, '(?i)^[^a-z0-9_]*(yes|no)[^a-z0-9_]*$') THEN lower(regexp_extract(answer, '(?i)(yes|no)', 1)) || '/exact/'
  WHEN regexp_matches(answer, '(?i)^[^a-z0-9_]*(yes|no)(?:[^a-z0-9_]|$)') THEN lower(regexp_extract(answer, '(?i)(yes|no)', 1)) || '/leading/'
  WHEN len(list_distinct(regexp_extract_all(lower(answer), '\\b(yes|no)\\b'))) = 1 THEN regexp_extract(lower(answer), '\\b(yes|no)\\b', 1) || '/last/'
  WHEN len(list_distinct(regexp_extract_all(lower(answer), '\\b(yes|no)\\b'))) = 2 THEN 'failed//ambiguous'
  WHEN answer = 'oui' THEN 'failed//non_english_token' ELSE 'failed//no_label' END AS code FROM marked),
parsed AS (SELECT text_sha256, chunk_id, part, part_key, row_index, raw_output, truncated, split_part(code, '/', 1) AS decision, nullif(split_part(code, '/', 2), '') AS parse_mode, nullif(split_part(code, '/', 3), '') AS failure_reason FROM coded)"""
VERDICTS = "verdicts AS (SELECT text_sha256, min_by(decision, k) AS decision, min_by(struct_pack(m := parse_mode), k).m AS parse_mode, min_by(struct_pack(f := failure_reason), k).f AS failure_reason, min(k.p) AS part_key FROM (SELECT *, struct_pack(p := part_key, r := row_index) AS k FROM parsed) GROUP BY text_sha256)"
#: Every third text has no verdict yet.
KNOWN = "known AS (SELECT * FROM verdicts WHERE CAST('0x' || substr(text_sha256, 9, 1) AS INTEGER) % 3 <> 0)"


def known(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter(F.conv(F.substring("text_sha256", 9, 1), 16, 10).cast("int") % 3 != 0)


LABELLED = f"""
labelled AS (SELECT s.*, CASE WHEN s.unsplit THEN 'skipped_unsplit' WHEN k.decision IS NULL THEN 'pending' ELSE k.decision END AS decision,
  CASE WHEN NOT s.unsplit THEN k.parse_mode END AS parse_mode, CASE WHEN s.unsplit THEN 'unsplit_upstream' ELSE k.failure_reason END AS failure_reason,
  CASE WHEN NOT s.unsplit AND k.decision IS NOT NULL THEN substr(sha256(s.text_sha256 || chr(31) || '{FINGERPRINT}'), 1, 32) END AS generation_id
  FROM sentences s LEFT JOIN known k USING (text_sha256))"""


def polygons(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as polygons; every eleventh lacks a latitude."""
    e = table(spark, d, "embeddings")
    lon, lat = F.floor(F.get("embedding", F.lit(0)).cast("double") * 100) % 20, F.floor(F.get("embedding", F.lit(1)).cast("double") * 100) % 10
    return e.select(F.format_string("p%05d", "vec_id").alias("polygon_id"), lon.cast("double").alias("lon"), F.when(F.col("vec_id") % 11 != 0, lat.cast("double")).alias("lat"), F.col("vec_id").alias("row_index"))


POLYGONS = """
polygons AS (SELECT printf('p%05d', vec_id) AS polygon_id, CAST(CAST(floor(CAST(embedding[1] AS DOUBLE) * 100) AS BIGINT) % 20 AS DOUBLE) AS lon,
  CASE WHEN vec_id % 11 <> 0 THEN CAST(CAST(floor(CAST(embedding[2] AS DOUBLE) * 100) AS BIGINT) % 10 AS DOUBLE) END AS lat, vec_id AS row_index FROM embeddings),
polygon_cells AS (SELECT polygon_id, CAST(lon AS BIGINT) || '/' || CAST(lat AS BIGINT) AS cell FROM polygons WHERE lat IS NOT NULL AND lon IS NOT NULL)"""


def benchmark_rows(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents as benchmark items with two runs' answers."""
    docs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("language"), "n_chars")
    x = table(spark, d, "labels").join(docs, "doc_id")
    answer = lambda c: F.when(c, "yes").otherwise("no")
    return x.select(
        "language", F.col("doc_id").alias("item_id"), answer(F.col("quality") == 1).alias("expected"),
        F.when(F.col("doc_id") % 17 != 0, answer(F.col("toxic") == 0)).alias("predicted"), F.when(F.col("n_chars") % 13 != 0, answer(F.col("n_chars") % 5 > 0)).alias("candidate"), F.col("n_chars").cast("int").alias("generated_tokens"),
    )


BENCHMARK = """
bench AS (SELECT lang AS language, doc_id AS item_id, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS expected, CASE WHEN doc_id % 17 <> 0 THEN CASE WHEN toxic = 0 THEN 'yes' ELSE 'no' END END AS predicted,
  CASE WHEN n_chars % 13 <> 0 THEN CASE WHEN n_chars % 5 > 0 THEN 'yes' ELSE 'no' END END AS candidate, n_chars AS generated_tokens FROM labels JOIN documents USING (doc_id))"""


def jobs(spark: SparkSession, d: str) -> DataFrame:
    """A job for each user and day of events."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    g = e.groupBy("user_id", "day").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.min_by("event_type", "event_id").alias("gpu"), F.count(F.lit(1)).alias("n"))
    seconds = F.unix_timestamp(F.col("b").cast("timestamp")) - F.unix_timestamp(F.col("a").cast("timestamp"))
    return g.select(
        "user_id", "day", "gpu", F.when(F.col("user_id") % 3 == 0, F.upper("gpu")).otherwise("").alias("gpu_key"), (seconds + 3600).alias("walltime_s"), iso("a").alias("started_at"), iso("a").alias("engine_ready_at"),
        F.when(F.col("n") > 1, iso("b")).otherwise("").alias("last_result_at"), iso("b").alias("ended_at"), F.lit(60.0).alias("env_ready_seconds"), F.when(F.col("n") % 2 == 0, "SIGUSR2").alias("stopped"), "n",
    )


JOBS = """
job_days AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b, min_by(event_type, event_id) AS gpu, count(*) AS n FROM events GROUP BY ALL),
jobs AS (SELECT user_id, day, gpu, CASE WHEN user_id % 3 = 0 THEN upper(gpu) ELSE '' END AS gpu_key, CAST(floor(epoch(b)) - floor(epoch(a)) AS BIGINT) + 3600 AS walltime_s, date_trunc('second', a) AS started, date_trunc('second', b) AS ended, n FROM job_days)"""


def moments(spark: SparkSession, d: str) -> DataFrame:
    """Events as submissions: local times, a start some hours later, a walltime."""
    e = table(spark, d, "events").select("event_id", F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("submitted"))
    start = F.timestamp_seconds(F.unix_timestamp("submitted") + (F.col("event_id") % 40) * 900)
    return e.withColumn("start", start).withColumn("walltime_s", (F.col("event_id") % 9 + 1) * 3600).withColumn("end", F.timestamp_seconds(F.unix_timestamp("start") + F.col("walltime_s")))


MOMENTS = "moments AS (SELECT event_id, submitted, submitted + to_seconds((event_id % 40) * 900) AS start, (event_id % 9 + 1) * 3600 AS walltime_s, submitted + to_seconds((event_id % 40) * 900 + (event_id % 9 + 1) * 3600) AS \"end\" FROM (SELECT event_id, date_trunc('minute', ts) AS submitted FROM events))"
