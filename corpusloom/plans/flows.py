"""The capabilities that a user calls: plan, process, resolve, publish, report. Each is a composition of operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.answers import from_engine, rule_decided
from corpusloom.functions.text import render_prompt
from corpusloom.operators import assemble, geo, planning, quality, resolve, stats
from corpusloom.sources import ledgers
from corpusloom.sources.readers import Source, with_identity

#: Prompts to token ids, and token ids to the engine's JSON; both in order, a batch at a time.
Encode = Callable[[list[str]], list[list[int]]]
Generate = Callable[[list[list[int]]], list[str]]


def encoded(texts: DataFrame, template: str, encode: Encode) -> DataFrame:
    """texts with input_ids and prompt_tokens."""

    @F.arrow_udf("array<int>")
    def ids(prompts: pa.Array) -> pa.Array:
        return pa.array(encode(prompts.to_pylist()), pa.list_(pa.int32()))

    out = texts.withColumn("input_ids", ids(render_prompt(template, F.col("text"))))
    return out.withColumn("prompt_tokens", F.size("input_ids"))


def plan(spark: SparkSession, rows: DataFrame, source: Source, known_lines: DataFrame, template: str, encode: Encode, fingerprint: Column, size: int, final: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q1. rows: a source's input with source_file and file_idx. Returns chunks, new plan lines, scan counts."""
    files = rows.select("source_file", "file_idx").distinct()
    sentences = with_identity(source.read(rows.drop("file_idx")), source.name).join(files, "source_file")
    texts = planning.unique_texts(sentences)
    ordered = encoded(planning.file_ordinal(texts), template, encode)
    chunks = planning.chunked(ordered.withColumn("ord_rank", F.lit(source.rank)).withColumn("ord_file", F.col("file_idx")), size, fingerprint, final)
    return chunks, planning.new_lines(planning.plan_lines(chunks), known_lines), planning.scan_counts(sentences, texts)


def replan(texts: DataFrame, lines: DataFrame, generated: DataFrame, placed: DataFrame, fingerprint: Column, size: int, released_before: bool = False) -> tuple[DataFrame, DataFrame]:
    """Q2. Frees open chunks and deals their texts out again, evenly over the map. Returns chunks and the lines kept."""
    marked = planning.mark_done(texts, generated)
    freed, kept = planning.released(marked, lines, released_before)
    ordered = planning.uniform_ordinal(planning.pending(freed).drop("cell").join(planning.first_cells(placed), "text_sha256", "left"))
    return planning.chunked(ordered.drop("chunk_id"), size, fingerprint), kept


def plan_benchmark(items: DataFrame, template: str, encode: Encode, fingerprint: Column, size: int) -> tuple[DataFrame, DataFrame]:
    """Q3. The benchmark's distinct sentences as chunks before all others, and the text of each item."""
    keyed = items.withColumn("text_sha256", F.sha2("sentence", 256))
    texts = keyed.groupBy("text_sha256").agg(F.any_value("sentence").alias("text")).withColumn("file_idx", F.lit(0))
    ordered = encoded(planning.file_ordinal(texts), template, encode).withColumn("ord_rank", F.lit(-1)).withColumn("ord_file", F.lit(0))
    return planning.chunked(ordered, size, fingerprint), keyed.select("item_id", "text_sha256")


def process(chunk: DataFrame, done: DataFrame, generate: Generate) -> DataFrame:
    """Q4. Results of a chunk's texts that have none. Texts without letters are decided by rule and never reach the model."""
    rule, asked = resolve.split_by_rule(resolve.missing_texts(chunk, done))

    @F.arrow_udf("string")
    def answer(ids: pa.Array) -> pa.Array:
        return pa.array(generate(ids.to_pylist()), pa.string())

    by_rule = rule.select(rule_decided(F.col("text_sha256"), F.col("prompt_tokens")).alias("g"))
    by_model = asked.select(from_engine(F.col("text_sha256"), answer(F.col("input_ids")), F.col("prompt_tokens")).alias("g"))
    return by_rule.unionByName(by_model).select("g.*")


def publish(sentences: DataFrame, verdicts: DataFrame, texts: DataFrame, canonical: DataFrame, last: DataFrame, dataset: str, fingerprint: Column, revision: Column) -> dict[str, DataFrame]:
    """Q6, Q7. The tables of the files that are complete, or worth a partial version; `last`: source_file and known at its last one."""
    rows = assemble.label_rows(sentences, verdicts, fingerprint, allow_pending=True)
    cover = assemble.coverage(rows).join(last.select("source_file", F.col("known").alias("last")), "source_file", "left").withColumn("last", F.coalesce("last", F.lit(0)))
    due = cover.filter(F.col("complete") | assemble.worth_publishing(F.col("known"), F.col("sendable"), F.col("last")))
    shown = rows.join(due.select("source_file", "complete"), "source_file")
    complete = shown.filter("complete")
    owned = assemble.owned_generations(complete, texts)
    return {
        "labels": assemble.labels_table(shown, dataset, fingerprint, revision),
        "viewer": assemble.viewer_table(shown),
        "generations": assemble.generations_table(canonical, owned, fingerprint),
        "coverage": due,
    }


def statistics(labels: DataFrame, generations: DataFrame, gpu: Column) -> dict[str, DataFrame]:
    """Q8, Q9. What a report needs of the published tables."""
    files = stats.file_stats(labels)
    return {"files": files, "totals": stats.totals(files), "failures": stats.failure_counts(labels), "gpus": stats.rows_per(generations, gpu, "gpu"), "cells": geo.merged_cells(geo.binned(labels))}


def compare(reference: DataFrame, verdicts: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """Q10. The gate between published predictions and ours. items: item_id, text_sha256."""
    ours = items.join(verdicts, "text_sha256").select("item_id", F.when(F.col("decision").isin("yes", "no"), F.col("decision")).alias("predicted"))
    pairs = quality.complete_pairs(reference, ours)
    return {"gate": quality.gate_over_strata(pairs), "reference": quality.macro_scores(pairs, "reference"), "candidate": quality.macro_scores(pairs, "candidate")}


def recipe(spark: SparkSession, inputs: DataFrame, labels: DataFrame, generations: DataFrame, keys: list[str]) -> DataFrame:
    """Q14. The published join. Keys that don't name one label multiply rows by design."""
    sql = assemble.RECIPE.format(input="{i}", labels="{l}", generations="{g}", keys=", ".join(keys))
    return spark.sql(sql, i=inputs, l=labels, g=generations)


def compacted(spark: SparkSession, path: str, key: str, schema: str) -> Iterator[dict] | None:
    """The rows that a ledger's rewrite has, in first-seen order, or None if it isn't worth one. Driver-side, for small ledgers."""
    last = ledgers.last_wins(ledgers.read_ledger(spark, path, schema), key)
    rows, keys = (int(x or 0) for x in last.agg(F.sum("versions"), F.count(F.lit(1))).first())
    if not ledgers.needs_compaction(rows, keys):
        return None
    return (r.asDict() for r in last.orderBy("first_seq").drop("first_seq", "versions").toLocalIterator())
