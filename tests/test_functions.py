import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import answers, calendar, config, identity, text, timeline

LONG = "luf_failure:input_too_long:"
#: Outputs and what the parser must make of them.
PARSED = [
    ("reasoning says yes and no</think>yes", False, ("yes", "exact", None)),
    ("x</think>\n\nno", False, ("no", "exact", None)),
    ('x</think>"no"', False, ("no", "exact", None)),
    ("a</think>b</think>no", False, ("no", "exact", None)),
    ("x</think>**Yes**.", False, ("yes", "exact", None)),
    ("x</think>yes, it shows fields", False, ("yes", "leading", None)),
    ("x</think>yes or no", False, ("yes", "leading", None)),
    ("x</think>The answer is no.", False, ("no", "last", None)),
    ("</think>yes", True, ("failed", None, "truncated")),
    ("still thinking about yes", False, ("failed", None, "unclosed_think")),
    ("x</think>   ", False, ("failed", None, "empty")),
    ("x</think> \x1c", False, ("failed", None, "empty")),
    ("x</think>The answer is yes or no.", False, ("failed", None, "ambiguous")),
    ("x</think>oui", False, ("failed", None, "non_english_token")),
    ("x</think>«Нет».", False, ("failed", None, "non_english_token")),
    ("x</think>maybe", False, ("failed", None, "no_label")),
    ("x</think>nobody knows", False, ("failed", None, "no_label")),
    ("x</think>éyes", False, ("failed", None, "no_label")),
    ("x</think>yeſ", False, ("failed", None, "no_label")),
    (f"{LONG}131072>=131072", True, ("failed", None, "input_too_long")),
    (f"{LONG}131073>131072", False, ("failed", None, "input_too_long")),
    (f"{LONG}127000+4096>131072", False, ("failed", None, "input_too_long")),
    (f"{LONG}131071>=131072", False, ("failed", None, "unclosed_think")),
    (f"{LONG}131072>131072", False, ("failed", None, "unclosed_think")),
    (f"{LONG}126976+4096>131072", False, ("failed", None, "unclosed_think")),
    (f"{LONG}127000+4096>=131072", False, ("failed", None, "unclosed_think")),
    (f"{LONG}{'9' * 30}>1", False, ("failed", None, "input_too_long")),
]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_parser_golden_cases(spark):
    df = spark.createDataFrame([(i, r, t) for i, (r, t, _) in enumerate(PARSED)], "i int, raw string, cut boolean")
    got = {r.i: (r.v.decision, r.v.parse_mode, r.v.failure_reason) for r in df.select("i", answers.parse_generation(F.col("raw"), F.col("cut")).alias("v")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(PARSED)}


def test_markers(spark):
    m = answers.too_long_marker
    lit = lambda x: F.lit(x).cast("bigint")
    assert one(spark, m(lit(5), lit(5), lit(None)), m(lit(6), lit(5), lit(None)), m(lit(4), lit(5), lit(3)))[:] == (f"{LONG}5>=5", f"{LONG}6>5", f"{LONG}4+3>5")
    for a, b, c in ((4, 5, None), (0, 5, None), (5, 5, 3), (1, 5, 2), (1, 2**31, None)):
        with pytest.raises(Exception):
            one(spark, m(lit(a), lit(b), lit(c)))


def test_engine_texts(spark):
    said = ["The input (131073 tokens) is longer than the model's context length (131072 tokens).", "the INPUT (5 tokens) is longer than the model's context length (9 tokens)", "Requested token count exceeds the model's maximum context length of 100 tokens. You requested a total of 110 tokens: 90 tokens from the input messages and 20 tokens for the completion.", "other"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string").select("i", answers.context_overflow(F.col("s")).alias("o"))
    assert [tuple(r.o) if r.o else None for r in df.orderBy("i").collect()] == [(131073, 131072, None), None, (90, 100, 20), None]
    raw = ['{"text": "a", "meta_info": {"finish_reason": {"type": "length"}, "completion_tokens": 7, "spec_verify_ct": 0, "e2e_latency": 1.5}}', '{"meta_info": {"finish_reason": "stop"}}', "{}", '{"text": "b", "meta_info": {"finish_reason": {"x": 1}}}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(raw)], "i int, s string").select("i", answers.from_engine(F.lit("h"), F.col("s"), F.lit(3)).alias("g")).orderBy("i")
    got = [(r.g.raw_output, r.g.finish_reason, r.g.truncated, r.g.generated_tokens, r.g.verify_steps, r.g.latency_s) for r in df.collect()]
    assert got == [("a", "length", True, 7, None, 1.5), ("", "stop", False, 0, None, None), ("", "unknown", False, 0, None, None), ("b", "unknown", False, 0, None, None)]


def test_identities(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    df = spark.createDataFrame([("é", None, 3)], "t string, k string, i int")
    r = df.select(identity.text_sha256(F.col("t")), identity.label_id(F.lit("d"), ["k", "i"]), identity.generation_id(F.lit("s"), F.lit("f")), identity.chunk_id(F.lit("f"), F.array(F.lit("b"), F.lit("a"))), identity.hash_round(F.lit("00000000000fff")), identity.cell_key(F.lit(None).cast("string")), identity.last_components(F.lit("/x/y/p/c/part"))).first()
    assert r[:] == (sha("é"), sha("d\x1fk=None\x1fi=3"), sha("s\x1ff")[:32], sha("f\x1fa\x1fb")[:24], int("00000000000f", 16), sha("")[:16], "p/c/part")


def test_text_rules(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(["", "12 -", "a", "ab", "é1я"])], "i int, s string").orderBy("i")
    assert [r[0] for r in df.select(text.has_no_letters(F.col("s"))).collect()] == [True, True, False, False, False]
    assert [r[0] for r in df.select(text.readable(F.col("s"))).collect()] == [False, False, False, True, True]
    assert one(spark, text.render_prompt("a {} b {}", F.lit("{}$1")))[0] == "a {}$1 b {}"
    assert one(spark, text.gpu_key(F.lit("NVIDIA L40S")), text.gpu_key(F.lit("A100-SXM4-40GB")))[:] == ("l40s", "a100_sxm4_40gb")


def test_calendar(spark):
    easters = {2000: (4, 23), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5), 2038: (4, 25)}
    df = spark.createDataFrame([(y,) for y in easters], "y int").select("y", calendar.easter(F.col("y")).alias("e"))
    assert {r.y: (r.e.month, r.e.day) for r in df.collect()} == easters
    at = lambda s: F.lit(dt.datetime.fromisoformat(s)).cast("timestamp")
    day, night = at("2024-03-27T10:00:00"), at("2024-03-29T20:00:00")  # Wednesday; Friday before Easter
    r = one(spark, calendar.is_daytime(day), calendar.is_daytime(night), calendar.next_day_start(night).cast("string"), calendar.allowed_window(day, F.lit(True)), calendar.allowed_window(day, F.lit(False)), calendar.immediate_window(calendar.allowed_window(night, F.lit(False))))
    assert r[:3] == (True, False, "2024-04-02 09:00:00") and tuple(r[3]) == (3600, None) and r[4] is None and tuple(r[5]) == (3600, None)
    cross = lambda *x: one(spark, calendar.crosses_forbidden(*map(at, x)))[0]
    assert cross("2024-03-27T16:00:00", "2024-03-27T18:00:00", "2024-03-27T19:30:00")
    assert not cross("2024-03-27T17:00:00", "2024-03-27T18:00:00", "2024-03-27T19:30:00")
    assert not cross("2024-03-27T16:00:00", "2024-03-27T18:00:00", "2024-03-27T19:00:00")
    assert not cross("2024-03-30T08:00:00", "2024-03-30T08:30:00", "2024-03-31T21:00:00")


def test_timeline(spark):
    gap = lambda a, b: one(spark, timeline.generation_seconds(F.lit(a), F.lit(b)))[0]
    assert gap("2026-01-01T00:00:00+00:00", "2026-01-01T00:08:00Z") == 480.0 and gap("2026-01-01T00:08:00Z", "2026-01-01T00:00:00Z") == 0.0 and gap("", "2026-01-01T00:00:00Z") is None
    early = lambda left: one(spark, timeline.stopped_early(F.lit(None).cast("string"), F.lit(left), F.lit(1000.0)))[0]
    assert not early(100.0) and early(100.5)
    assert one(spark, timeline.walltime_text(F.lit(5430)), timeline.stop_reason(F.lit(10.0), F.lit(1000.0), F.lit("TERM")), timeline.stop_reason(F.lit(641.0), F.lit(1000.0), F.lit("")), timeline.stop_reason(F.lit(639.0), F.lit(1000.0), F.lit("")))[:] == ("1:30", "signal TERM", "deadline", None)
    status = lambda s: one(spark, timeline.deadline_from_status(F.lit(s), F.lit(100)))[0]
    assert (status('{"walltime": 50}'), status('{"7": {"walltime": 50, "startTime": 30}}'), status("{"), status('{"walltime": 0}')) == (150, 80, None, None)
    assert one(spark, timeline.retry_after(F.lit(" 12.5 ")), timeline.retry_after(F.lit("soon")), timeline.next_delay(F.lit(3), F.lit(None).cast("double"), F.lit(1.0)), timeline.next_delay(F.lit(1), F.lit(500.0), F.lit(0.0)), timeline.give_up(F.lit(10), F.lit(0.0), F.lit(0.0)))[:] == (12.5, None, 8.0, 300.0, True)


def test_configuration():
    a = {"model": "m", "engine": {"dtype": "bf16", "log_level": "info"}}
    b = {"engine": {"log_level": "debug", "dtype": "bf16"}, "model": "m"}
    assert config.config_fingerprint(a) == config.config_fingerprint(b) and config.serving_fingerprint(a) != config.serving_fingerprint(b)
    assert config.split_template("<a>S<b>", "S") == ("<a>", "<b>")
    with pytest.raises(ValueError):
        config.split_template("SS", "S")
    s = config.Settings.load({"max_jobs": 3}, {"CORPUSLOOM_OVERFLOW": "1.5", "CORPUSLOOM_SITES": "a, b"})
    assert (s.max_jobs, s.overflow, s.sites, s.chunk_size) == (3, 1.5, ("a", "b"), 2000)
    with pytest.raises(ValueError, match="unknown setting x; max_jobs is not a number"):
        config.Settings.load({"x": 1}, {"CORPUSLOOM_MAX_JOBS": "many"})
