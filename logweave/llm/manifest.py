"""Merkle dataset manifest: a nested-struct rollup.

Every row is a leaf, the digest of its fields. The leaves of a source lie in
order of doc_id; runs of ``ARITY`` nodes become one, level by level, until one is
left, the source's subroot. The subroots form a tree of the same kind, whose top
is the root.

A leaf's rank within its source is found without a window over the source: the
rows are range-sorted, and each range's rows are counted. The rank's digits are
then grouped away one after another inside blocks of ``ARITY ** DIGITS`` leaves:
one shuffle brings a block together, and each grouping nests the structs of up to
``ARITY`` children, in order, in that of their parent. Blocks are leaves of the
next pass, until a source is one block. Downwards, a block's path from the root
is one more row of the block's group; a transform walks the nested structs and
gathers each leaf's siblings, and an explode returns the leaves. So proofs need
no join, no task holds more than one block of a tree, and only the number of
passes is on the driver.

Defined cases: null is a source of its own, before all others. A null field is
``-`` in the digest; a null text isn't tampered with, nor is a row without id.
Rows without id come first in their source; rows of one id are in order of their
digests, and repeated rows are leaves each. An empty table has no leaves and no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.storage import staged

ARITY, DIGITS = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(**fields: Column) -> Column:
    """The digest of a row's fields, each with its size in bytes."""
    text = [fields[f].cast("string") for f in FIELDS]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text))


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the source as text that sorts as it should), doc_id, hash and changed: the digest after tampering, if there is any."""
    fields = {f: F.col(f) for f in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = leaf(**fields | {"text": F.replace(F.col("text"), F.lit("\n"))})
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"), "doc_id", leaf(**fields).alias("hash"),
                       F.when(tampered & F.contains("text", F.lit("\n")), changed).alias("changed"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with their rank within their tree and the tree's depth, the number of its levels above the leaves."""
    table = staged(rows.orderBy("tree", *order).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), name)
    runs = table.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    powers = F.array(*(F.lit(ARITY ** k) for k in range(39)))
    nodes = F.sum("n").over(tree)
    runs = runs.select("tree", "part", "first", before.alias("base"), F.size(F.filter(powers, lambda p: p < nodes)).alias("depth"))
    return table.join(runs, ["tree", "part"]).withColumn("rank", F.col("at") - F.col("first") + F.col("base")).drop("at", "part", "first", "base")


def _joined(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda k: k["hash"]), "")


def blocks_of(rows: DataFrame, name: str) -> DataFrame:
    """tree, block, depth and node, nested down to the rows: rows are (tree, rank, depth, node)."""
    digits = [F.expr(f"rank DIV {ARITY ** k} % {ARITY}").alias(f"d{k}") for k in range(DIGITS)]
    table = rows.select("tree", F.expr(f"rank DIV {ARITY ** DIGITS}").alias("block"), "depth", *digits, "node").repartition("tree", "block")
    for level in range(DIGITS):
        keys = ["tree", "block", "depth", *(f"d{k}" for k in range(level + 1, DIGITS))]
        children = F.transform(F.array_sort(F.collect_list(F.struct(f"d{level}", "node"))), lambda c: c["node"])
        table = table.groupBy(*keys).agg(children.alias("children"))
        # above a tree's top its one node stays as it is
        above = F.when(F.col("depth") > level, digest(_joined(F.col("children")))).otherwise(F.col("children")[0]["hash"])
        table = table.select(*keys, F.struct(above.alias("hash"), "children").alias("node"))
    return staged(table, name)


def passes(rows: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of the rows, the blocks of these blocks, and so on, until each tree is one block."""
    deepest, out = rows.agg(F.max("depth")).first()[0] or 0, []
    for k in range(max(1, -(-deepest // DIGITS))):
        out.append(blocks_of(rows, f"{name}-{k}"))
        below = F.struct(F.col("node")["hash"].alias("hash"), F.col("block").alias("rank"))
        rows = out[-1].select("tree", F.col("block").alias("rank"), F.greatest(F.col("depth") - DIGITS, F.lit(0)).alias("depth"), below.alias("node"))
    return out


def _walked(node: Column, level: int, depth: Column, steps: Column) -> Column:
    """(node, steps) of every leaf under a node; a step holds the digests left and right of the path, the lowest first."""
    if level == 0:
        return F.array(F.struct(node.alias("node"), steps.alias("steps")))
    children = node["children"]

    def child(one: Column, at: Column) -> Column:
        left, right = (_joined(F.filter(children, lambda _, k: f(k, at))) for f in (lambda k, at: k < at, lambda k, at: k > at))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        return _walked(one, level - 1, depth, F.when(depth >= level, F.concat(step, steps)).otherwise(steps))

    return F.flatten(F.transform(children, child))


def walked(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The leaves of blocks, (tree, node, steps, known): paths are (tree, rank, steps, known), a row for each block; known is handed down."""
    own = blocks.select("tree", "block", "depth", "node")
    both = own.unionByName(paths.withColumnRenamed("rank", "block"), allowMissingColumns=True)
    met = both.groupBy("tree", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("depth", "node", "steps", "known")))
    return met.select("tree", "known", F.explode(_walked(F.col("node"), DIGITS, F.col("depth"), F.col("steps"))).alias("leaf")).select("tree", "known", "leaf.node", "leaf.steps")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    rows = ranked(leaves(docs), [F.col("doc_id").asc_nulls_first(), "hash"], "merkle-leaves")
    lower = passes(rows.select("tree", "rank", "depth", F.struct("hash", "doc_id", "changed").alias("node")), "merkle-blocks")
    subroots = lower[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("node")["hash"].alias("hash"))
    sources = ranked(subroots, ["source"], "merkle-sources")
    upper = passes(sources.select("tree", "rank", "depth", F.struct("hash", "source").alias("node")), "merkle-tops")
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    paths = upper[-1].select("tree", F.lit(0).cast("long").alias("rank"), no_steps.alias("steps"), F.struct(F.col("node")["hash"].alias("root")).alias("known"))
    for blocks in reversed(upper[1:]):
        paths = walked(blocks, paths).select("tree", F.col("node")["rank"].alias("rank"), "steps", "known")
    known = F.struct(F.col("known")["root"].alias("root"), F.col("node")["hash"].alias("subroot"))
    paths = walked(upper[0], paths).select(F.col("node")["source"].alias("tree"), F.lit(0).cast("long").alias("rank"), "steps", known.alias("known"))
    for blocks in reversed(lower[1:]):
        paths = walked(blocks, paths).select("tree", F.col("node")["rank"].alias("rank"), "steps", "known")
    proven = walked(lower[0], paths)
    proof = digest(F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), ""))
    start = F.coalesce(F.col("node")["changed"], F.col("node")["hash"])
    folded = F.aggregate("steps", start, lambda up, s: digest(s["left"], up, s["right"]))
    out = proven.select(F.col("node")["doc_id"].alias("doc_id"), F.col("node")["hash"].alias("leaf"), F.col("known")["subroot"].alias("subroot"),
                        F.col("known")["root"].alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels_sql(name: str, deep: int) -> str:
    """CTEs: the nodes of each level of the trees in ``{name}0`` (tree, place, hash, n); a tree's top stays as it is."""
    up = [f"""{name}{k + 1} AS (SELECT tree, place // {ARITY} AS place, CASE WHEN n > 1 THEN sha256(string_agg(hash, '' ORDER BY place)) ELSE any_value(hash) END AS hash,
  (n + {ARITY - 1}) // {ARITY} AS n FROM {name}{k} GROUP BY tree, place // {ARITY}, n)""" for k in range(deep)]
    return ",\n".join(up)


def _folded_sql(name: str, deep: int) -> str:
    """CTEs: from ``{name}f0`` (tree, place, item, proof, up) the proof and the folded digest after each level."""
    def beside(k: int, sign: str) -> str:
        return f"coalesce(string_agg(s.hash, '' ORDER BY s.place) FILTER (WHERE s.place {sign} f.place), '')"

    up = [f"""{name}f{k + 1} AS (SELECT f.tree, f.place // {ARITY} AS place, f.item, f.proof || {beside(k, '<>')} AS proof,
  CASE WHEN any_value(s.n) > 1 THEN sha256({beside(k, '<')} || f.up || {beside(k, '>')}) ELSE f.up END AS up
  FROM {name}f{k} f JOIN {name}{k} s ON s.tree = f.tree AND s.place // {ARITY} = f.place // {ARITY}
  GROUP BY f.tree, f.place, f.item, f.proof, f.up)""" for k in range(deep)]
    return ",\n".join(up)


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_LEAF_SQL = "sha256(" + " || ".join(_field_sql(f) for f in FIELDS) + ")"
_CHANGED_SQL = "sha256(" + " || ".join(_field_sql(f if f != "text" else "replace(text, chr(10), '')") for f in FIELDS) + ")"
#: crc32, bit by bit: DuckDB has no function for it. Its initial value and its final inversion are bitwise NOT.
_CRC_SQL = """xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""
_DEEP, _WIDE = 14, 6
SQL = f"""
WITH leaves AS (SELECT coalesce('=' || source, '') AS tree, doc_id, {_LEAF_SQL} AS hash, {_CHANGED_SQL} AS changed, {_CRC_SQL} % 2 = 0 AS tampered FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n,
  row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, hash) AS item FROM leaves),
low0 AS (SELECT tree, place, hash, n FROM numbered),
{_levels_sql("low", _DEEP)},
top0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, hash, count(*) OVER () AS n, tree AS source FROM low{_DEEP}),
{_levels_sql("top", _WIDE)},
lowf0 AS (SELECT tree, place, item, '' AS proof, CASE WHEN tampered THEN changed ELSE hash END AS up FROM numbered),
{_folded_sql("low", _DEEP)},
topf0 AS (SELECT '' AS tree, t.place, f.item, f.proof, f.up FROM lowf{_DEEP} f JOIN top0 t ON t.source = f.tree),
{_folded_sql("top", _WIDE)}
SELECT d.doc_id, d.hash AS leaf, s.hash AS subroot, r.hash AS root, sha256(f.proof) AS proof_sha256, f.up AS folded_root, f.up = r.hash AS verified
FROM numbered d JOIN topf{_WIDE} f USING (item) JOIN top0 s ON s.source = d.tree CROSS JOIN (SELECT hash FROM top{_WIDE}) r
"""
