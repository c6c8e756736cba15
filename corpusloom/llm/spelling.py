"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the frequent form each of them stands for.

Two words of one length that differ at position i agree before it and after it. So, with the words sorted forward and sorted from their
ends, they are what two intervals have in common: that of the letters before i in the one order and that of the letters after i in the
other. Each word is a point (rank forward, rank backward), and a wavelet matrix over the points of a group reports the points of such a rectangle, each in a
logarithm of the group's size. A letter more is found likewise, among words that are longer by one.

The groups: an edit lies in the left or in the right half of a word, and the other half is the same in both words. So words
meet by half, and by ever smaller parts while a group is too large. Groups give sums for each word, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm._shared import lowered, staged, table
from corpusloom.llm.sharding import crc_sql, crc_table_sql

#: Letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST, RATIO, PERIOD = 7, 2, 10, 31
#: Words, and letters, that a task sorts at once, about. A part of this size is cut further.
WORDS, CHARS = 1 << 13, 1 << 21
NEAR = "word string, n_near long, form string, form_n long"


class WaveletMatrix:
    """The numbers 0 to n - 1 in some order; reports those within a range of places and a range of values."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length()) if len(values) else 0
        self.zeros: list[np.ndarray] = []  # by bit: how many zeros stand before each place
        for bit in reversed(range(self.bits)):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]))
            values = np.concatenate([values[zero], values[~zero]])

    def report(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For queries of places left to right and values low to high (ends not included): (number of the query, value) of each point."""
        query, value = np.arange(len(left)), np.zeros(len(left), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros, strict=True):
            before, until = zeros[left], zeros[right]
            ones = zeros[-1]
            left = np.concatenate([before, ones + left - before])
            right = np.concatenate([until, ones + right - until])
            query, value = np.concatenate([query, query]), np.concatenate([value, value + (1 << bit)])
            open_ = (left < right) & (value < high[query]) & (value + (1 << bit) > low[query])
            left, right, query, value = left[open_], right[open_], query[open_], value[open_]
        return query, value


class _Order:
    """Words, short and long, in one order; where those with the same first letters stand, counted among the short or the long only."""

    def __init__(self, words: list[str], longest: int, is_long: np.ndarray):
        letters = np.array(words, f"U{longest}")
        self.order = np.argsort(letters, kind="stable")
        self.rank = np.empty(len(words), np.int64)
        self.rank[self.order] = np.arange(len(words))
        rows = letters[self.order].view(np.uint32).reshape(len(words), longest)
        self.common = np.concatenate([[-1], (rows[1:] == rows[:-1]).argmin(1)]) if len(words) > 1 else np.array([-1])
        self.long_before = np.concatenate([[0], np.cumsum(is_long[self.order])])
        self.short_before = np.arange(len(words) + 1) - self.long_before

    def most_common(self) -> np.ndarray:
        """For each word: with how many letters another word begins as it does."""
        return np.maximum(self.common, np.append(self.common[1:], -1))[self.rank]

    def interval(self, words: np.ndarray, letters: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words stand that begin with the first `letters` of each of `words`."""
        first = np.flatnonzero(self.common < letters)
        group = np.searchsorted(first, self.rank[words], "right") - 1
        return before[first[group]], before[np.append(first, len(self.rank))[group + 1]]


def near_pairs(words: list[str], length: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Both directions of all pairs of distinct words that are one edit apart at a position from lo to hi (not included).

    The words have `length` letters or one more; pairs of the longer ones belong to another call.
    """
    is_long = np.array([len(w) > length for w in words])
    ahead, back = _Order(words, length + 1, is_long), _Order([w[::-1] for w in words], length + 1, is_long)
    # The points: short words among themselves, long words among themselves.
    short_at, long_at = ahead.order[~is_long[ahead.order]], ahead.order[is_long[ahead.order]]
    short_back, long_back = back.order[~is_long[back.order]], back.order[is_long[back.order]]
    short_points, long_points = WaveletMatrix(back.short_before[back.rank[short_at]]), WaveletMatrix(back.long_before[back.rank[long_at]])
    # A word is asked for at the positions up to which another begins as it does, and from which another ends as it does.
    asked = np.flatnonzero(~is_long)
    start = np.maximum(length - 1 - back.most_common()[asked], lo)
    end = np.minimum(ahead.most_common()[asked] + 1, hi)
    asked, start, end = asked[start < end], start[start < end], end[start < end]
    change = np.zeros(hi - lo + 1, np.int64)
    np.add.at(change, start - lo, 1)
    np.add.at(change, end - lo, -1)
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in (np.flatnonzero(np.cumsum(change)) + lo).tolist():
        here = asked[(start <= i) & (i < end)]
        if i < length:  # replaced: the letters before i, the letters after i
            left, right = ahead.interval(here, i, ahead.short_before)
            low, high = back.interval(here, length - 1 - i, back.short_before)
            some = (right - left > 1) & (high - low > 1)
            query, value = short_points.report(left[some], right[some], low[some], high[some])
            one, other = here[some][query], short_back[value]
            a.append(one[one != other])
            b.append(other[one != other])
        # inserted before i; of a run of equal letters, only the first is taken as the inserted one
        left, right = ahead.interval(here, i, ahead.long_before)
        low, high = back.interval(here, length - i, back.long_before)
        some = (right > left) & (high > low)
        query, value = long_points.report(left[some], right[some], low[some], high[some])
        one, other = here[some][query], long_back[value]
        if i:
            first = np.array([words[w][i] != words[w][i - 1] for w in other.tolist()], bool)
            one, other = one[first], other[first]
        a += [one, other]
        b += [other, one]
    return np.concatenate(a), np.concatenate(b)


def _near_sums(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of a group: how many words of it are near, and the most frequent of them."""
    length, lo, hi = (k.as_py() for k in key[:3])
    group = pa.Table.from_batches(batches)
    words, n = group.column("word").to_pylist(), group.column("n").to_numpy()
    a, b = near_pairs(words, length, lo, hi)
    if len(a):
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(np.array(words), kind="stable")] = np.arange(len(words))
        best = np.lexsort((rank[b], -n[b], a))
        a, b = a[best], b[best]
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        found = [[words[i] for i in a[first]], np.diff(np.append(first, len(a))), [words[i] for i in b[first]], n[b[first]]]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], ["word", "n_near", "form", "form_n"])


def _halved(rows: DataFrame) -> DataFrame:
    """word, n, length, lo, hi, key: each row twice, for the left and for the right half of its positions lo to hi.

    The key hashes the letters before and after the half; that two keys may be the same by chance does no harm."""
    middle = F.expr("cast((lo + hi) div 2 as int)")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    rows = rows.select("word", "n", "length", F.explode(halves).alias("_half")).select("word", "n", "length", "_half.lo", "_half.hi")
    return rows.withColumn("key", F.xxhash64("length", "lo", "hi", F.expr("substring(word, 1, lo)"), F.expr("right(word, length - hi)")))


def groups(words: DataFrame, most_words: int, most_chars: int) -> DataFrame:
    """The words by the part that they share with near ones: word, n, length (of the shorter of two words), lo, hi, bucket."""
    size = F.char_length("word")
    both = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("length")).filter("length > 0")
    rows, kept = _halved(both.withColumns({"lo": F.lit(0), "hi": F.col("length") + 1})), None
    while True:
        many = (F.count(F.lit(1)) > most_words) | (F.count(F.lit(1)) * F.max("length") > most_chars)
        full = staged(rows.groupBy("key").agg(many.alias("many"), F.max(F.col("hi") - F.col("lo")).alias("span")).filter("many and span > 1").select("key"), "spelling-full")
        if full.isEmpty():
            break
        rest = rows.join(full, "key", "left_anti")
        kept = rest if kept is None else kept.unionByName(rest)
        rows = staged(_halved(rows.join(full, "key", "left_semi")), "spelling-parts")
    rows = rows if kept is None else rows.unionByName(kept)
    n = F.greatest(F.ceil(F.count(F.lit(1)) / most_words), F.ceil(F.count(F.lit(1)) * F.col("length") / most_chars))
    buckets = staged(rows.groupBy("length", "lo", "hi").agg(n.alias("buckets")), "spelling-buckets")
    return rows.join(buckets, ["length", "lo", "hi"]).withColumn("bucket", F.pmod("key", "buckets")).drop("key", "buckets")


def variants(words: DataFrame, ratio: float = RATIO, most_words: int = WORDS, most_chars: int = CHARS) -> DataFrame:
    """Groups the spellings of words: word, form, root, n, n_near, form_n, one row for each row of `words` (word, distinct and not null; n, its occurrences).

    n_near counts the words that differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n
    (ties: the smallest in code-point order) if that is at least ratio * n, else null, and form_n its n. root follows the forms to the last. No words, no rows.
    Very long words are compared whole. An empty word has no near words but those of one letter, which are not reported.
    """
    words = words.select("word", F.col("n").cast("bigint").alias("n"))
    near = groups(words, most_words, most_chars).groupBy("length", "lo", "hi", "bucket").applyInArrow(_near_sums, NEAR)
    none = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("form"), F.lit(None).cast("bigint").alias("form_n"))
    both = none.unionByName(near.withColumn("n", F.lit(None).cast("bigint")))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    found = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best)
    is_form = -F.col("best.less") >= F.col("n") * ratio
    found = found.select("word", "n", "n_near", F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    found = staged(found, "spelling-forms")
    rooted = found.join(_roots(found.filter("form is not null").select("word", "form")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """word, root: each round looks twice as far. Occurrences grow tenfold from form to form, so a few rounds do."""
    reached = links.withColumnRenamed("form", "root")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_onward"))
        if reached.join(onward, "root", "left_semi").isEmpty():
            return reached
        reached = staged(reached.join(onward, "root", "left").select("word", F.coalesce("_onward", "root").alias("root")), "spelling-roots")


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, period: int = PERIOD) -> DataFrame:
    """word, n: the words of all documents with `shortest` letters and `least` occurrences at least.

    A word is a maximal run of letters A to Z and U+00C0 to U+00FF, of which A to Z are lower-cased. To have misspellings at known
    places, a letter goes where `period` divides h, the unsigned crc32 of "<doc_id>:<word>": that at h modulo the length. A null doc_id counts as empty
    text, a null text holds no words, repeated rows count each, and other columns are ignored.
    """
    runs = F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    runs = runs.select("id", lowered(F.col("run")).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.expr("cast(h % char_length(run) as int)")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % period == 0, shorter).otherwise(F.col("run")).alias("word")
    counts = runs.select(word).filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(staged(word_counts(table(spark, sf_dir, "documents")), "spelling-words"))


ORACLE = {
    "op11_spelling_variants": f"""
WITH RECURSIVE crc_table AS MATERIALIZED ({crc_table_sql()}),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (SELECT run, c, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, crc_table),
changed AS (SELECT CASE WHEN h % {PERIOD} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n, length(word) AS len FROM changed WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(c) >= {LEAST}),
places AS (SELECT word, len, n, unnest(range(len)) AS i FROM words),
holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places),
shorter AS (SELECT DISTINCT word, n, a || b AS other FROM holes),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON w.word = s.other
  UNION ALL SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON w.word = s.other),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, form := encode(other))) AS best FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.best.less >= {RATIO} * w.n THEN decode(b.best.form) END AS form, CASE WHEN -b.best.less >= {RATIO} * w.n THEN -b.best.less END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain AS (SELECT word, word AS at, form AS next FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
}
