"""Chat formatting from event logs: what happened to a conversation, in sequence, becomes its final messages and then one training text.

A log has an event a row: a message is posted, a delta of its text streams in, its text is edited, or it is regenerated, which
also discards what followed it. Logs are parted by conversation and by runs of 256 messages in it, so that a conversation may have any length; the events of a
message are folded in sequence, the messages are rendered with a template, and each run of them becomes one row of text with the
spans that training takes a loss on. Nothing here leaves the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm._shared import table

#: Bits of a message's number inside its run, and code points of a delta.
RUN_BITS, DELTA = 8, 512
#: The kinds of events.
MESSAGE, DELTA_KIND, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


@dataclass(frozen=True)
class Template:
    """How turns are marked. A control string is a mark without the blanks around it.

    Inside a text, a control string gets a backslash behind its first character, and so does one that has backslashes there already; reading back
    takes one away. No control string is the beginning of another, and its first character isn't in it again, so none can begin in a text and end in a mark.
    """

    begin: str = "<s>"
    #: By role: what stands before and after a text.
    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("[SYSTEM_PROMPT] ", " [/SYSTEM_PROMPT]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>")})
    #: For any other role: before its name, between the name and the text, after the text.
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
    #: The roles whose texts are trained.
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = self.controls()
        if len({c for _, c in self.ends()}) < len(self.roles) + 1 or any(a != b and b.startswith(a) for a in marks for b in marks) or any(m[0] in m[1:] or m[0].isalnum() or m[0] == "\\" for m in marks):
            raise ValueError("a turn's end must tell its role, and control strings must not begin or hold one another")

    def ends(self) -> list[tuple[str | None, str]]:
        return [*((role, close) for role, (_, close) in self.roles.items()), (None, self.other[2])]

    def controls(self) -> list[str]:
        marks = [self.begin, *(m for pair in self.roles.values() for m in pair), *self.other]
        return sorted({m.strip() for m in marks if m.strip()})

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self.pattern(), "$1\\\\$2$3")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self.pattern("\\\\"), "$1$2$3")

    def pattern(self, taken: str = "") -> str:
        """A control string with any backslashes: its first character, the backslashes without the one that `taken` matches, the rest."""
        firsts = "".join(re.escape(c) for c in sorted({m[0] for m in self.controls()}))
        rests = "|".join(re.escape(m[1:]) for m in self.controls())
        return f"([{firsts}]){taken}(\\\\*)({rests})"

    def rendered(self, role: Column, text: Column) -> tuple[Column, Column, Column]:
        """What stands before the text, the escaped text, what stands after it."""
        first = F.concat(F.lit(self.other[0]), self.escaped(role), F.lit(self.other[1]))
        last = F.lit(self.other[2])
        for name, (before, after) in self.roles.items():
            first, last = F.when(role == name, before).otherwise(first), F.when(role == name, after).otherwise(last)
        return first, self.escaped(text), last


TEMPLATE = Template()


def turn_events(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) as a log: conv_id, message, copy, seq, kind, role, text.

    A row is a message; rows of one turn are told apart by `copy`, in the order of role and text. An assistant's text is streamed in deltas,
    and every fourth (by its checksum) is given up after the first delta and regenerated; every fourth of the others is posted in
    capitals and then edited. So the final messages are the rows. Null texts count as empty.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("message"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = parted(rows)
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("conv", "run", "message").orderBy("role", "text")))
    again = F.crc32("text") % 4 == 0
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("text"))
    pieces = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0)), lambda t: event(DELTA_KIND, t))
    start, none = F.array(event(MESSAGE, F.lit(""))), F.array().cast("array<struct<kind:string,text:string>>")
    given_up = F.when(again, F.concat(F.slice(pieces, 1, 1), F.array(event(REGENERATE, F.lit(None))))).otherwise(none)
    streamed = F.concat(start, given_up, pieces)
    posted = F.when(again, F.array(event(MESSAGE, F.upper("text")), event(EDIT, F.col("text")))).otherwise(F.array(event(MESSAGE, F.col("text"))))
    events = F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(posted)).alias("step", "e")
    log = rows.select("conv_id", "conv", "run", "message", "copy", "role", events)
    role = F.when(F.col("e.kind") == MESSAGE, F.col("role"))
    return log.select("conv_id", "conv", "run", "message", "copy", F.struct("message", "copy", "step").alias("seq"), "e.kind", role.alias("role"), "e.text")


def parted(log: DataFrame) -> DataFrame:
    """Adds conv, a key that isn't null, and run, the message's number without its last bits, and deals the rows out by both: the one shuffle of the log."""
    conv = F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    run = F.shiftright(F.coalesce("message", F.lit(-(1 << 63))), RUN_BITS)
    return log.withColumns({"conv": conv, "run": run}).repartition("conv", "run")


def final_messages(log: DataFrame) -> DataFrame:
    """Folds the events of each message: conv_id, conv, run, first (whether the run is the conversation's first), message, copy, role, text.

    The log has conv_id, message (its place in the conversation), copy (apart if two messages have one place), seq (of any type that has an order), kind, role, text, and the
    columns of parted(). A `message` gives the text whole or starts an empty one, a `delta` appends to it, an `edit` replaces it, and `regenerate` empties it and
    discards all that the log has, up to then, of the messages after it. The last role that is given counts. Events of one seq are taken in the order of kind, role and
    text; other kinds are ignored; a message of which nothing is left doesn't count; null texts count as empty.
    """
    known = log.filter(F.col("kind").isin(MESSAGE, DELTA_KIND, EDIT, REGENERATE))
    regenerated = F.max(F.when(F.col("kind") == REGENERATE, F.col("seq"))).alias("regenerated")
    # Regenerations of earlier runs: a row for each run, however long the texts.
    runs = known.groupBy("conv", "run").agg(regenerated)
    before = Window.partitionBy("conv").orderBy("run")
    earlier = F.max("regenerated").over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("conv", "run", earlier.alias("earlier"), (F.row_number().over(before) == 1).alias("first"))
    event = F.struct("seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    messages = known.groupBy("conv", "run", "message", "copy").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(event)).alias("events"), regenerated)
    inside = Window.partitionBy("conv", "run").orderBy("message", "copy").rowsBetween(Window.unboundedPreceding, -1)
    messages = messages.withColumn("inside", F.max("regenerated").over(inside)).join(runs, ["conv", "run"])
    messages = messages.withColumn("void", F.greatest("inside", "earlier"))
    live = F.when(F.col("void").isNull(), F.col("events")).otherwise(F.filter("events", lambda e: e["seq"] > F.col("void")))
    messages = messages.withColumn("live", live).filter(F.size("live") > 0)
    start = F.struct(F.lit(0).alias("at"), F.lit(1).alias("from"), F.lit(None).cast("string").alias("role"))

    def folded(state: Column, e: Column) -> Column:
        at = state["at"] + 1
        anew = e["kind"] != DELTA_KIND
        return F.struct(at.alias("at"), F.when(anew, at).otherwise(state["from"]).alias("from"), F.coalesce(e["role"], state["role"]).alias("role"))

    messages = messages.withColumn("state", F.aggregate("live", start, folded))
    # A regeneration's own text doesn't count.
    texts = F.transform(F.slice(F.col("live"), F.col("state.from"), F.size("live")), lambda e: F.when(e["kind"] == REGENERATE, "").otherwise(e["text"]))
    return messages.select("conv_id", "conv", "run", "first", "message", "copy", F.coalesce("state.role", F.lit("")).alias("role"), F.array_join(texts, "").alias("text"))


def formatted(messages: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Renders final messages: conv_id, conv, part, n_turns, formatted, spans (start, length), one row for each run of messages of a conversation.

    Parts, in order, make up the conversation's text; the first begins with the template's begin. Spans are in code points of the part, counted from 0, and hold exactly
    the (escaped) texts of the trained roles. Empty texts have empty spans; a null role counts as an empty name.
    """
    before, text, after = template.rendered(F.coalesce("role", F.lit("")), F.col("text"))
    own = messages.select("conv_id", "conv", "run", "first", "message", "copy", before.alias("before"), text.alias("inner"), after.alias("after"), F.coalesce(F.col("role").isin(*template.trained), F.lit(False)).alias("trained"))
    own = own.withColumns({"piece": F.concat("before", "inner", "after"), "lead": F.char_length("before"), "length": F.char_length("inner")})
    earlier = Window.partitionBy("conv", "run").orderBy("message", "copy").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("start", F.coalesce(F.sum(F.char_length("piece")).over(earlier), F.lit(0)) + F.col("lead"))
    turn = F.struct("message", "copy", "piece", "trained", "start", F.col("length").cast("bigint").alias("length"))
    parts = own.groupBy("conv", "run").agg(F.first("conv_id").alias("conv_id"), F.first("first").alias("first"), F.sort_array(F.collect_list(turn)).alias("turns"))
    lead = F.when(F.col("first"), template.begin).otherwise("")
    spans = F.transform(F.filter("turns", lambda t: t["trained"]), lambda t: F.struct((t["start"] + F.char_length(lead)).alias("start"), t["length"].alias("length")))
    return parts.select("conv_id", "conv", F.col("run").alias("part"), F.size("turns").cast("bigint").alias("n_turns"), F.concat(lead, F.array_join("turns.piece", "")).alias("formatted"), spans.alias("spans"))


def read_back(parts: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The turns of formatted parts, from nothing but text and spans: conv_id, conv, part, turn (from 0 in its part), role, text, lost (the text under the mask, null if
    none), chars (of the turn, marks and the part's begin included)."""
    ends = "|".join(re.escape(close) for _, close in template.ends())
    begins = F.col("formatted").startswith(template.begin)
    body = F.when(begins, F.expr(f"substring(formatted, {len(template.begin) + 1})")).otherwise(F.col("formatted"))
    pieces = parts.select("conv_id", "conv", "part", "spans", F.when(begins, len(template.begin)).otherwise(0).alias("lead"), F.posexplode(F.regexp_extract_all(body, F.lit(f"(?s).*?(?:{ends})"), F.lit(0))).alias("turn", "piece"))
    size = F.char_length("piece")
    earlier = Window.partitionBy("conv", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("at", F.col("lead") + F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    cut = lambda a, b: F.substring("piece", F.lit(a + 1), F.greatest(size - (a + b), F.lit(0)))
    opened, between, closed = template.other
    split = F.locate(between, F.col("piece"))  # it holds a control string, so it can't be in the name
    role = template.unescaped(F.substring("piece", F.lit(len(opened) + 1), F.greatest(split - (len(opened) + 1), F.lit(0))))
    text = F.substring("piece", split + len(between), F.greatest(size - len(closed) - (split + len(between) - 1), F.lit(0)))
    for name, (before, after) in template.roles.items():
        own = F.col("piece").endswith(after)
        role, text = F.when(own, name).otherwise(role), F.when(own, cut(len(before), len(after))).otherwise(text)
    mine = F.filter("spans", lambda s: (s["start"] >= F.col("at")) & (s["start"] < F.col("at") + size))
    lost = F.transform(mine, lambda s: F.substring("piece", (s["start"] - F.col("at") + 1).cast("int"), s["length"].cast("int")))
    chars = size + F.when(F.col("turn") == 0, F.col("lead")).otherwise(0)
    return pieces.select("conv_id", "conv", "part", "turn", role.alias("role"), template.unescaped(text).alias("text"), F.when(F.size(lost) > 0, template.unescaped(F.array_join(lost, ""))).alias("lost"), chars.alias("chars"))


def digests(parts: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted parts, one row for each conversation.

    A digest is of one whole text, so that a conversation's turns meet in one row here; parts are made into one string each before."""
    turns = read_back(parts, template)
    turn = F.struct("turn", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"), F.coalesce("lost", F.lit("")).alias("lost"))
    by_part = turns.groupBy("conv", "part").agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sort_array(F.collect_list(turn)).alias("t"))
    by_part = by_part.select("conv", "part", "conv_id", "n", "chars", F.array_join("t.said", "").alias("said"), F.array_join("t.lost", "").alias("lost"))
    whole = by_part.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("part", "said", "lost"))).alias("p"))
    lost = F.array_join("p.lost", "")
    return whole.select("conv_id", "n_turns", F.sha2(F.array_join("p.said", ""), 256).alias("turns_sha256"), F.char_length(lost).cast("bigint").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"), "formatted_chars")


def format_log(log: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """A log of events (conv_id, message, copy, seq, kind, role, text; other columns are ignored) as formatted parts."""
    return formatted(final_messages(parted(log.select("conv_id", F.col("message").cast("bigint").alias("message"), "copy", "seq", "kind", "role", "text"))), template)


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The rows of `conversations` as formatted parts, through their log. A null conv_id is a conversation, a null turn comes first; rows that are repeated are
    turns each; no rows give none; other columns are ignored. Very long texts stay whole."""
    return formatted(final_messages(turn_events(conversations)), template)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = F.lit("</s>[INST] ok [/INST]").alias("text")
    added = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), tricky)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return digests(format_conversations(rows))


def _oracle(template: Template = TEMPLATE) -> str:
    """Straight from the rows; only the marks' lengths and the escapes come from the template."""
    pattern = template.pattern().replace("'", "''")
    escaped = lambda c: f"length(regexp_replace({c}, '{pattern}', '\\1\\\\\\2\\3', 'g'))"
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in template.roles.items())
    return f"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST({len(template.begin)} + sum({escaped("text")} + CASE role {marks} ELSE {sum(map(len, template.other))} + {escaped("role")} END) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id"""


ORACLE = {"op12_chat_format": _oracle()}
