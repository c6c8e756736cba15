"""A Merkle manifest of a dataset: one digest for all of it, and for each row a proof that it is in there.

Each source has a tree over its rows in the order of doc_id, and one more tree stands over the sources. Trees are built from
events: a node's digest is an event for its parent, which holds the children that have come, by their place, until it has as many
as the tree's size says it must get. Then it has a digest of its own, which is the next event. Each task first takes the events of a
range of rows, in which nearly all parents are completed; the children of those that aren't (some at each end of the range)
are shuffled by an ever wider part of their tree and meet there. Each completed parent is written with its children's digests: these links, followed
from the root down, are the proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm._shared import id_crc, lowered, staged, table, wide
from corpusloom.llm.sharding import crc_sql, crc_table_sql

ARITY, DIGEST = 16, 64
#: Levels of a tree that one task proves at once: 16 ** 3 rows.
LEVELS = 3
#: Partial parents that a task holds; beyond it, their children go to the next round as they are.
HELD = 1 << 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
EVENTS = "tree string, size long, level int, place long, digest string, children string, top boolean"
PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row: each field as its length in UTF-8 bytes, a colon and its value, or a dash if it is null."""
    fields = [c.cast("string") for c in (doc_id, source, lang, n_chars, text)]
    return F.sha2(F.concat(*[F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in fields]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `place`, gapless from 0 in each `tree`, and `size`, its number of rows. A tree is cut into ranges, however large it is."""
    ranged = rows.repartitionByRange(wide(rows), "tree", *order).sortWithinPartitions("tree", *order)
    ranged = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    runs = ranged.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)), "size": F.sum("_rows").over(Window.partitionBy("tree"))})
    placed = ranged.join(runs.drop("_rows"), ["tree", "_part"]).withColumn("place", F.col("_before") + F.col("_at") - F.col("_first"))
    return placed.drop("_part", "_at", "_first", "_before")


def width(size: int, level: int, arity: int) -> int:
    """Nodes of a level of a tree over `size` leaves."""
    return -(-size // arity**level)


def _climb(arity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Takes children as events and gives the parents that they complete, and those children whose parent isn't complete."""
    names = [x.split()[0] for x in EVENTS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[str, int, int, int], dict[int, str]] = {}
        out: list[tuple] = []

        def arrives(tree: str, size: int, level: int, place: int, digest: str) -> None:
            if size == 1:  # a lone leaf is the top itself
                out.append((tree, size, level, place, digest, "", True))
            while (beside := width(size, level, arity)) > 1:
                level, parent = level + 1, place // arity
                held = waiting.setdefault((tree, size, level, parent), {})
                held[place] = digest
                if len(held) < min(arity, beside - parent * arity):
                    return
                del waiting[tree, size, level, parent]
                children = "".join(held[p] for p in sorted(held))
                place, digest = parent, digest_of(children)
                out.append((tree, size, level, place, digest, children, width(size, level, arity) == 1))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def unresolved() -> None:
            for (tree, size, level, _), held in waiting.items():
                out.extend((tree, size, level - 1, place, digest, None, False) for place, digest in held.items())
            waiting.clear()

        for rows in batches:
            for event in zip(*(rows.column(n).to_pylist() for n in names[:5]), strict=True):
                arrives(*event)
                if len(waiting) > HELD:
                    unresolved()
                if len(out) >= 4096:
                    yield batch()
        unresolved()
        yield batch()

    return run


def grow(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """The nodes of the trees over numbered leaves (tree, size, place, digest): each parent with its level, its place there, its digest, its children's digests
    in one string, and whether it is the tree's top. A lone leaf is a top of level 0 without children."""
    names = [x.split()[0] for x in EVENTS.split(", ")]
    climb = _climb(arity)
    first = leaves.withColumn("level", F.lit(0)).select(*names[:5]).mapInArrow(climb, EVENTS)
    rows = staged(first, "merkle-nodes")
    nodes, waiting, span = rows.filter("children is not null"), rows.filter("children is null"), arity**LEVELS

    def meet(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(climb(iter(group.to_batches())))

    while not waiting.isEmpty():  # the parts grow, so that there are some levels / 3 rounds
        above = F.pow(F.lit(float(arity)), F.col("level") + 1).cast("bigint")
        part = F.expr(f"((place div {arity}) * _above) div {span}")
        parted = waiting.withColumn("_above", above).select(*names[:5], part.alias("part"))
        rows = staged(parted.groupBy("tree", "part").applyInArrow(meet, EVENTS), "merkle-nodes")
        nodes, waiting, span = nodes.unionByName(rows.filter("children is not null")), rows.filter("children is null"), span * arity**LEVELS
    return nodes


def _ceilings(nodes: DataFrame, paths: DataFrame, arity: int) -> DataFrame:
    """tree, part, path: for each part of arity ** LEVELS leaves, how its top folds into the root. Goes down from the trees' tops, level by level.

    A path is an array of (at, others): a node's place among its siblings, and their digests."""
    tops = nodes.filter("top").select("tree", "level", "place").join(paths, "tree")
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    reached = tops.filter(F.col("level") <= LEVELS).select("tree", "place", "path")
    here = None
    for level in range(deepest, LEVELS, -1):
        start = tops.filter(F.col("level") == level).select("tree", "place", "path")
        here = start if here is None else here.unionByName(start)
        family = nodes.filter(F.col("level") == level).select("tree", "place", "children")
        child = F.posexplode(F.sequence(F.lit(0), (F.length("children") / DIGEST - 1).cast("int"))).alias("at", "_at")
        down = here.join(family, ["tree", "place"]).select("tree", (F.col("place") * arity).alias("first"), "children", "path", child)
        others = F.concat(F.expr(f"substring(children, 1, at * {DIGEST})"), F.expr(f"substring(children, at * {DIGEST} + {DIGEST + 1})"))
        step = F.struct(F.col("at").alias("at"), others.alias("others"))
        here = down.select("tree", (F.col("first") + F.col("at")).alias("place"), F.concat(F.array(step), F.col("path")).alias("path"))
    if here is not None:
        reached = reached.unionByName(here)
    return reached.withColumnRenamed("place", "part")


def _steps(links: pa.Table, arity: int) -> dict[int, list[tuple[int, str]]]:
    """For the leaves of one part, by place: how they fold into the root. Follows the links from the part's top down."""
    rows = links.to_pylist()
    path = [(x["at"], x["others"]) for r in rows if r["path"] is not None for x in r["path"]]
    families = sorted(((r["level"], r["place"], r["children"]) for r in rows if r["path"] is None), reverse=True)
    reached: dict[tuple[int, int], list[tuple[int, str]]] = {}
    for level, place, children in families:
        onward = reached.get((level, place), path)
        for at in range(len(children) // DIGEST):
            reached[level - 1, place * arity + at] = [(at, children[: at * DIGEST] + children[(at + 1) * DIGEST :]), *onward]
    return {place: steps for (level, place), steps in reached.items() if not level} or {0: path}


def fold(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for at, others in steps:
        digest = digest_of(others[: at * DIGEST] + digest + others[at * DIGEST :])
    return digest


def manifest(docs: DataFrame, presented: Column | None = None, arity: int = ARITY) -> DataFrame:
    """Proves each row: doc_id, leaf, subroot (of its source), root, proof_sha256, folded_root, verified, one output row for each row.

    `presented` is the text that is held against the manifest, by default the row's own; folded_root is made from the leaf of the row with that text and
    the siblings in the tree, and `verified` says whether it is the root. proof_sha256 is the digest of the siblings, from the leaf up.

    Leaves of a source are ordered by doc_id, null first, rows of one doc_id by their digests. Nulls in any field have a mark of their own
    in the leaf, so that they differ from empty texts; a null source is a source, the first. A source of one row is its own subroot, and
    a lone source's subroot is the root. Rows that are repeated are leaves each. An empty table gives an empty result; other columns are ignored.
    """
    text = F.col("text") if presented is None else presented
    own = [F.col(c) for c in FIELDS]
    tree = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf_digest(*own).alias("digest"), leaf_digest(*own[:4], text).alias("presented"))
    leaves = staged(leaves.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")  # _row: repeated rows can be told apart
    leaves = numbered(leaves, ["doc_id", "digest", "_row"]).drop("_row")
    leaves = staged(leaves, "merkle-places")
    nodes = grow(leaves, arity)
    subroots = nodes.filter("top").select(F.col("tree").alias("source"), "digest")
    over = staged(numbered(subroots.withColumn("tree", F.lit("")), ["source"]), "merkle-subroots")
    above = grow(over, arity)
    root = above.filter("top").select("digest").first()
    root = root[0] if root else ""
    no_steps = F.array().cast("array<struct<at:int,others:string>>")
    paths = _proved(over, above, over.limit(1).select("tree", no_steps.alias("path")), arity, _source_paths(arity), "tree string, subroot string, path array<struct<at:int,others:string>>")
    paths = staged(paths, "merkle-paths")
    proved = _proved(leaves, nodes, paths.select("tree", "path"), arity, _row_proofs(arity, root), PROVED.replace("subroot string, ", "") + ", tree string")
    return proved.join(paths.select("tree", "subroot"), "tree").select(*[x.split()[0] for x in PROVED.split(", ")])


def _proved(leaves: DataFrame, nodes: DataFrame, paths: DataFrame, arity: int, prove: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Brings the leaves of each part together with the links of the part and its way to the root."""
    step = lambda c: F.pow(F.lit(float(arity)), c).cast("bigint")
    low = nodes.filter((F.col("level") <= LEVELS) & (F.col("children") != "")).withColumn("_in", step(F.lit(LEVELS) - F.col("level")))
    links = low.select("tree", F.expr("place div _in").alias("part"), "level", "place", "children", F.lit(None).cast("array<struct<at:int,others:string>>").alias("path"))
    tops = _ceilings(nodes, paths, arity).withColumns({"level": F.lit(None).cast("int"), "place": F.lit(None).cast("bigint"), "children": F.lit(None).cast("string")})
    parted = leaves.withColumn("part", F.expr(f"place div {arity**LEVELS}"))
    return parted.groupBy("tree", "part").cogroup(links.unionByName(tops).groupBy("tree", "part")).applyInArrow(prove, schema)


def _source_paths(arity: int):
    def prove(leaves: pa.Table, links: pa.Table) -> pa.Table:
        steps = _steps(links, arity)
        found = [[{"at": at, "others": others} for at, others in steps[p]] for p in leaves.column("place").to_pylist()]
        kind = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))
        return pa.table([leaves.column("source"), leaves.column("digest"), pa.array(found, kind)], ["tree", "subroot", "path"])

    return prove


def _row_proofs(arity: int, root: str):
    def prove(leaves: pa.Table, links: pa.Table) -> pa.Table:
        steps = _steps(links, arity)
        rows = [(steps[p], d) for p, d in zip(leaves.column("place").to_pylist(), leaves.column("presented").to_pylist(), strict=True)]
        proofs = [digest_of("".join(others for _, others in s)) for s, _ in rows]
        folded = [fold(d, s) for s, d in rows]
        n = len(rows)
        columns = [leaves.column("doc_id"), leaves.column("digest"), pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()), leaves.column("tree")]
        return pa.table(columns, ["doc_id", "leaf", "root", "proof_sha256", "folded_root", "verified", "tree"])

    return prove


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the rows is presented with its letters A to Z lower-cased."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.col("text").isNotNull() & (id_crc(F.col("doc_id")) % 5 == 0), lowered(F.col("text"))).otherwise(F.col("text"))
    return manifest(docs, tampered)


def _oracle(levels: int = 7) -> str:
    """Levels one by one; a tree that is done stays as it is. Ids are taken to be distinct."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    leaf = lambda t: f"sha256({' || '.join(field(c) for c in (*FIELDS[:4], t))})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH crc_table AS MATERIALIZED ({crc_table_sql()}),
given AS (SELECT *, CASE WHEN {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0 THEN {lower} ELSE text END AS shown FROM documents, crc_table),
leaves AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("shown")} AS shown, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place FROM given),
a0 AS (SELECT source, place, leaf AS digest FROM leaves),
p0 AS (SELECT doc_id, source, leaf, place, shown AS folded, '' AS proof FROM leaves)"""

    def climb(name: str, proofs: str, key: str, first: int) -> str:
        out = ""
        for i in range(first, first + levels):
            out += f""",
f{i} AS (SELECT {key}, place // {ARITY} AS place, list(digest ORDER BY place) AS kids, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}{i}) GROUP BY {key}, place // {ARITY}),
{name}{i + 1} AS (SELECT {key}, place, CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest FROM f{i}),
{proofs}{i + 1} AS (SELECT p.* REPLACE (p.place // {ARITY} AS place, CASE WHEN f.n = 1 THEN folded ELSE sha256(array_to_string(list_transform(f.kids, lambda x, j: CASE WHEN j = p.place % {ARITY} + 1 THEN p.folded ELSE x END), '')) END AS folded,
  CASE WHEN f.n = 1 THEN proof ELSE proof || array_to_string(list_filter(f.kids, lambda x, j: j <> p.place % {ARITY} + 1), '') END AS proof) FROM {proofs}{i} p JOIN f{i} f ON p.{key} IS NOT DISTINCT FROM f.{key} AND p.place // {ARITY} = f.place)"""
        return out

    sql += climb("a", "p", "source", 0)
    k = levels + 1
    sql += f""",
b{k} AS (SELECT 0 AS whole, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, digest, source FROM a{levels}),
p{k} AS (SELECT p.doc_id, p.leaf, b.digest AS subroot, b.place, p.folded, p.proof, 0 AS whole FROM p{levels} p JOIN b{k} b ON p.source IS NOT DISTINCT FROM b.source)"""
    sql += climb("b", "p", "whole", k)
    return sql + f"""
SELECT p.doc_id, p.leaf, p.subroot, b.digest AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root, p.folded = b.digest AS verified FROM p{k + levels} p, b{k + levels} b"""


ORACLE = {"op13_merkle_manifest": _oracle()}
