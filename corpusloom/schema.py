"""Schemas of the relations that are written. Column order counts."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, B, D = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()


def _of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: Join keys of each dataset, in the order that its identities hash them.
JOIN_KEYS: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "description": (("description_identity", S), ("tag_key", S), ("sentence_index", I)),
    "wiki": (("sentence_id", S),),
    "website": (("polygon_id", S), ("field", S), ("sentence_index", I)),
}
CHUNK = _of(("text_sha256", S), ("text", S), ("input_ids", T.ArrayType(I)))
#: What every generation says of the run that made it.
PROVENANCE = ("config_fingerprint", "serving_fingerprint", "model", "draft", "prompt_sha256", "sglang_version", "gpu", "site", "oar_job_id", "assignment_id", "code_commit", "created_at")
RESULT = (("text_sha256", S), ("raw_output", S), ("prompt_tokens", I), ("generated_tokens", I), ("finish_reason", S), ("truncated", B), ("verify_steps", I), ("accepted_drafts", I), ("proposed_drafts", I), ("latency_s", D))
GENERATION = _of(*RESULT, *((n, S) for n in PROVENANCE))
PUBLISHED_GENERATION = _of(("generation_id", S), *RESULT, *((n, S) for n in PROVENANCE))
PLAN = _of(("chunk_id", S), ("ord_rank", I), ("ord_file", I), ("size", T.LongType()), ("prompt_tokens", T.LongType()), ("seq", T.LongType()))
VIEWER = _of(("sentence", S), ("label", S), ("language", S), ("region", S))


def labels(dataset: str) -> T.StructType:
    tail = ("text_sha256", "decision", "parse_mode", "failure_reason", "generation_id", "language", "config_fingerprint", "input_revision")
    return _of(("label_id", S), *JOIN_KEYS[dataset], *((n, S) for n in tail))
