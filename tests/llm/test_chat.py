import hashlib
import itertools
import random
import re

import pytest

from corpusloom.llm import chat
from tests.llm.helpers import F

TRICKY = ["<s>", "</s>", "[INST]", "[/INST]", "[SYSTEM_PROMPT]", "[ROLE]", "[/TURN]", "\\", "\\\\", "<", "[", "s>", "/s>", "INST]", " ", "\n", "é", "😀", "<\\s>", "ok"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    """conv_id to what is read back but formatted_chars; turns: (conv_id, turn, role, text)."""
    out = {}
    for conv in {t[0] for t in turns}:
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] or ""))
        lost = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        out[conv] = (len(mine), sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)), len(lost), sha(lost))
    return out


def conversations(spark, turns):
    schema = "conv_id long, turn long, role string, text string, run int, conv string, copy string, message int, first int, part int, seq int"
    return spark.createDataFrame([(*t, 1, "c", "x", 5, 0, 9, 3) for t in turns], schema)


def read(spark, turns):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_conversations(conversations(spark, turns))).collect()}


def test_conversations_are_read_back_as_they_were(spark):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice(TRICKY) for _ in range(rng.randrange(9)))
    turns = [(c, t, rng.choice(["user", "assistant", "system", "tool [/ROLE] <s>"]), text()) for c in range(40) for t in range(rng.randrange(1, 9))]
    turns += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert read(spark, turns) == expected(turns)


def test_nulls_repeats_long_and_no_texts(spark):
    turns = [(None, None, None, None), (None, 1, "assistant", None), (1, None, "user", "null first"), (1, -5, "assistant", ""), (2, 0, "assistant", "twice"), (2, 0, "assistant", "twice"), (2, 0, "user", "same turn")]
    turns += [(3, 0, "user", "x"), (3, 1, "assistant", "long <s>\\ " * 100_000), (4, 1 << 62, "", "no role"), (4, -(1 << 62), "assistant", "first")]
    assert read(spark, turns) == expected(turns)
    assert read(spark, []) == {}


def test_a_conversation_of_many_runs(spark):
    turns = [(1, t, ("user", "assistant")[t % 2], f"turn {t} </s>") for t in range(700)] + [(2, 300, "assistant", "begins late")]
    parts = chat.format_conversations(conversations(spark, turns)).orderBy("conv_id", "part").collect()
    assert [(r.conv_id, r.part, r.n_turns) for r in parts] == [(1, 0, 256), (1, 1, 256), (1, 2, 188), (2, 1, 1)]
    assert [r.formatted.startswith("<s>") for r in parts] == [True, False, False, True]
    assert parts[3].formatted == "<s> begins late </s>" and [tuple(s) for s in parts[3].spans] == [(4, 11)]
    for r in parts[:3]:  # spans hold exactly the escaped texts, by plain slicing
        held = [r.formatted[s.start : s.start + s.length] for s in r.spans]
        assert held == [f"turn {t} <\\/s>" for t in range(r.part * 256, min(700, r.part * 256 + 256)) if t % 2]
    assert read(spark, turns) == expected(turns)


def test_escapes_are_reversible(spark):
    """All texts of up to four pieces: no control string is left, and no two texts become one."""
    t = chat.TEMPLATE
    texts = ["".join(x) for n in range(5) for x in itertools.product(["<s>", "/s>", "<", "\\", "[INST]"], repeat=n)]
    df = spark.createDataFrame([(x,) for x in sorted(set(texts))], "text string").withColumn("escaped", t.escaped(F.col("text"))).withColumn("back", t.unescaped(F.col("escaped")))
    rows = df.collect()
    assert all(r.back == r.text for r in rows) and len({r.escaped for r in rows}) == len(rows)
    assert not any(c in r.escaped for r in rows for c in t.controls())


def test_templates_that_could_be_misread_are_refused():
    for bad in ({"begin": "<s>x<"}, {"roles": {"user": ("[A] ", " </x>"), "assistant": ("[B] ", " </x>")}}, {"other": ("[R", " [R2", " [E]")}):
        with pytest.raises(ValueError):
            chat.Template(**bad)


def test_another_template(spark):
    chatml = chat.Template(begin="<|begin|>", roles={r: (f"<|{r}|>\n", f"<|/{r}|>\n") for r in ("user", "assistant", "system")}, other=("<|role|>", "<|text|>", "<|end|>\n"), trained=("assistant", "tool"))
    turns = [(1, 0, "user", "hi <|assistant|>"), (1, 1, "assistant", "yes"), (1, 2, "tool", "<|end|>"), (1, 3, "user", "\n")]
    part = chat.format_conversations(conversations(spark, turns), chatml).collect()[0]
    assert part.formatted == "<|begin|><|user|>\nhi <\\|assistant|><|/user|>\n<|assistant|>\nyes<|/assistant|>\n<|role|>tool<|text|><\\|end|><|end|>\n<|user|>\n\n<|/user|>\n"
    back = chat.read_back(spark.createDataFrame([part], chat.format_conversations(conversations(spark, turns), chatml).schema), chatml).orderBy("turn").collect()
    assert [(r.role, r.text, r.lost) for r in back] == [(t[2], t[3], t[3] if t[2] in chatml.trained else None) for t in turns]


def replayed(log):
    """The final messages of one conversation's log, event by event."""
    state = {}
    for message, copy, _, kind, role, text in sorted(log, key=lambda e: (e[2], e[3], e[4] is not None, e[4] or "", e[5] or "")):
        key = message, copy
        if kind == "regenerate":
            for later in [k for k in state if k > key]:
                del state[later]
        old = state.get(key, ("", ""))
        new = {"message": text or "", "delta": old[1] + (text or ""), "edit": text or "", "regenerate": ""}[kind]
        state[key] = (role if role is not None else old[0], new)
    return [state[k] for k in sorted(state)]


def test_logs_are_folded_as_if_replayed(spark):
    """Random logs over three runs of messages, with regenerations that reach into later runs."""
    rng = random.Random(7)
    log = []
    for conv in range(25):
        for seq in range(rng.randrange(1, 60)):
            kind = rng.choices(["message", "delta", "edit", "regenerate"], [4, 6, 2, 1])[0]
            log.append((conv, rng.choice([1, 2, 3, 255, 256, 257, 600]), rng.randrange(2), seq, kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "b ", "</s>", None])))
    log.append((99, 1, 0, 1, "unheard of", "user", "x"))
    df = spark.createDataFrame(log, "conv_id long, message long, copy int, seq long, kind string, role string, text string").withColumn("run", F.lit("clash"))
    turns = chat.read_back(chat.format_log(df)).orderBy("conv_id", "part", "turn").collect()
    for conv in range(25):
        assert [(r.role, r.text) for r in turns if r.conv_id == conv] == replayed([e[1:] for e in log if e[0] == conv]), conv
    assert {r.conv_id for r in turns} <= set(range(25))


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.format_conversations(conversations(spark, [(1, 1, "user", "x")])))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert not re.search("Python|Pandas|Arrow", plan)
