"""Reading raw model outputs: decision, parse mode and failure, engine records and error texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import stripped

#: Versions the rules below; results parsed under another version are parsed again.
PARSER_VERSION = "2"
THINK_END = "</think>"
#: Fixed value: how stored outputs mark a prompt that does not fit.
TOO_LONG = "luf_failure:input_too_long:"
MOST_TOKENS = 2_147_483_647
#: Answers of other languages.
FOREIGN = ("oui", "non", "ja", "nein", "nee", "sí", "si", "não", "nao", "sim", "да", "нет", "是", "否", "はい", "いいえ", "evet", "hayır", "tak", "nie")
_WORD, _OTHER = "[\\p{L}\\p{N}_]", "[^\\p{L}\\p{N}_]"
_EXACT = f"(?iu)^{_OTHER}*(yes|no){_OTHER}*$"
_LEADING = f"(?iu)^{_OTHER}*(yes|no)(?!{_WORD})"
_ANY = f"(?iu)(?<!{_WORD})(yes|no)(?!{_WORD})"
_FOREIGN = f"(?iu)^{_OTHER}*({'|'.join(FOREIGN)}){_OTHER}*$"
_MARKER = f"^{TOO_LONG}(\\d+)(?:\\+(\\d+))?(>=|>)(\\d+)$"


def _verdict(decision: Column | str, mode: str | None, failure: str | None) -> Column:
    decision = F.lit(decision) if isinstance(decision, str) else decision
    text = lambda x: F.lit(x).cast("string")
    return F.struct(decision.cast("string").alias("decision"), text(mode).alias("parse_mode"), text(failure).alias("failure_reason"))


def is_too_long(raw: Column) -> Column:
    """Whether the output is a whole marker whose numbers bear it out."""
    part = lambda i: F.regexp_extract(raw, _MARKER, i)
    number = lambda i: F.coalesce(part(i).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    asked, extra, limit = number(1), number(2), number(4)
    above = F.when(part(3) == ">", asked + extra > limit).otherwise((part(2) == "") & (asked >= limit))
    return raw.rlike(_MARKER) & ~raw.contains("\n") & above


def parse_generation(raw: Column, truncated: Column) -> Column:
    """struct<decision, parse_mode, failure_reason>; the rules apply in this order and the first that fits decides."""
    answer = stripped(F.substring_index(raw, THINK_END, -1))
    labels = F.array_distinct(F.transform(F.regexp_extract_all(answer, F.lit(_ANY), F.lit(1)), F.lower))
    labels = F.filter(labels, lambda x: x.isin("yes", "no"))
    exact, leading = F.lower(F.regexp_extract(answer, _EXACT, 1)), F.lower(F.regexp_extract(answer, _LEADING, 1))
    known = lambda x: x.isin("yes", "no")
    failed = lambda why: _verdict("failed", None, why)
    return (
        F.when(is_too_long(raw), failed("input_too_long"))
        .when(truncated, failed("truncated"))
        .when(~raw.contains(THINK_END), failed("unclosed_think"))
        .when(answer == "", failed("empty"))
        .when(known(exact), _verdict(exact, "exact", None))
        .when(known(leading), _verdict(leading, "leading", None))
        .when(F.size(labels) == 1, _verdict(F.get(labels, F.lit(0)), "last", None))
        .when(F.size(labels) > 1, failed("ambiguous"))
        .when(answer.rlike(_FOREIGN), failed("non_english_token"))
        .otherwise(failed("no_label"))
    )


def too_long_marker(asked: Column, limit: Column, extra: Column) -> Column:
    """The output of a prompt that doesn't fit; wrong numbers are an error. extra is null if the prompt alone is too long."""
    number = lambda c: c.cast("bigint")
    fine = (number(limit) > 0) & (number(limit) <= MOST_TOKENS) & (number(asked) > 0) & (number(asked) <= MOST_TOKENS)
    alone = F.when(number(asked) < number(limit), F.raise_error(F.lit("a prompt below the limit is not too long"))).otherwise(
        F.concat(asked.cast("string"), F.when(asked == limit, ">=").otherwise(">"), limit.cast("string"))
    )
    total = number(asked) + number(extra)
    both = F.when((number(asked) >= number(limit)) | (total <= number(limit)) | (total > MOST_TOKENS), F.raise_error(F.lit("the request does not exceed the limit"))).otherwise(
        F.concat(asked.cast("string"), F.lit("+"), extra.cast("string"), F.lit(">"), limit.cast("string"))
    )
    body = F.when(extra.isNull(), alone).otherwise(both)
    return F.when(~F.coalesce(fine, F.lit(False)), F.raise_error(F.lit("token counts must be positive and recordable"))).otherwise(F.concat(F.lit(TOO_LONG), body))


def _result(sha: Column, raw: Column, prompt: Column, generated: Column, reason: Column, **rest: Column) -> Column:
    null = lambda kind: F.lit(None).cast(kind)
    fields = {
        "text_sha256": sha, "raw_output": raw, "prompt_tokens": prompt.cast("int"), "generated_tokens": generated.cast("int"), "finish_reason": reason, "truncated": reason == "length",
        "verify_steps": null("int"), "accepted_drafts": null("int"), "proposed_drafts": null("int"), "latency_s": null("double"),
    } | rest
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def rule_decided(sha: Column, prompt: Column) -> Column:
    """The row of a text without letters: a plain no that parses like an answer."""
    return _result(sha, F.lit(THINK_END + "no"), prompt, F.lit(0), F.lit("rule:no_letters"))


def too_long_result(sha: Column, asked: Column, limit: Column, extra: Column) -> Column:
    return _result(sha, too_long_marker(asked, limit, extra), asked, F.lit(0), F.lit("input_too_long"))


def from_engine(sha: Column, output: Column, prompt: Column) -> Column:
    """The row of an engine's JSON completion. A finish reason may be an object, a text or missing."""
    at = lambda path: F.get_json_object(output, path)
    finish = at("$.meta_info.finish_reason")
    kind = F.when(finish.isNull() | finish.startswith("{"), F.coalesce(at("$.meta_info.finish_reason.type"), F.lit("unknown"))).otherwise(finish)
    steps = at("$.meta_info.spec_verify_ct").try_cast("int")
    return _result(
        sha, F.coalesce(at("$.text"), F.lit("")), prompt, F.coalesce(at("$.meta_info.completion_tokens").try_cast("int"), F.lit(0)), kind,
        verify_steps=F.nullif(steps, F.lit(0)), accepted_drafts=at("$.meta_info.spec_num_correct_drafts").try_cast("int"),
        proposed_drafts=at("$.meta_info.spec_num_proposed_drafts").try_cast("int"), latency_s=at("$.meta_info.e2e_latency").try_cast("double"),
    )


#: What engines say of prompts that are too long. Groups: prompt tokens, limit; or total, prompt, completion, limit.
PROMPT_ERROR = "(?i)The input \\((\\d+) tokens\\) is longer than the model's context length \\((\\d+) tokens\\)"
BUDGET_ERROR = "(?i)Requested token count exceeds the model's maximum context length\\s+of (\\d+) tokens\\.\\s+You requested a total of (\\d+) tokens:\\s+(\\d+) tokens from the input messages and (\\d+) tokens for the completion\\."


def context_overflow(message: Column) -> Column:
    """struct<prompt, limit, extra> of an engine's error text, or null if it says nothing of the kind or contradicts itself."""
    number = lambda pattern, i: F.regexp_extract(message, pattern, i).try_cast("bigint")
    none = F.lit(None).cast("bigint")
    struct = lambda a, b, c: F.struct(a.alias("prompt"), b.alias("limit"), c.alias("extra"))
    sane = lambda *c: reduce(lambda x, y: x & y, [(x > 0) & (x <= MOST_TOKENS) for x in c])
    p, lim = number(PROMPT_ERROR, 1), number(PROMPT_ERROR, 2)
    limit, total, prompt, extra = (number(BUDGET_ERROR, i) for i in range(1, 5))
    return F.when(message.rlike(PROMPT_ERROR) & sane(p, lim) & (p >= lim), struct(p, lim, none)).when(
        message.rlike(BUDGET_ERROR) & sane(limit, total, prompt, extra) & (total == prompt + extra) & (total > limit) & (prompt < limit), struct(prompt, limit, extra)
    )
