"""Embedding near-duplicates by E8 lattice hashing.

In each table a vector's direction is projected to a few blocks of eight
dimensions, and each block is decoded to its nearest E8 lattice point; the
points together are its cell. Besides its own (home) cell a vector probes the
cells that are nearest beyond it, one block moved by a minimal vector. Vectors
that meet in a cell are compared by cosine in double precision. The number of
blocks follows the number of vectors, and the number of tables is what a
simulation at the threshold needs for ``RECALL``.

Equal vectors are one class and are compared once. Links found give connected
components; within each component all links are then counted, so that a pair
met in several tables counts once. Groups of more than ``BLOCK`` rows are split
into blocks, and pairs of blocks are compared in tasks of their own; no pair is
ever written, only links that join a group and counts.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without id, link with nothing. Vectors of different length
are never compared. Rows that repeat an id are vectors of their own; their
component's id is the smallest of all members. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.components import components, local_components
from logweave.llm.storage import staged

#: Scale of the projections, probed cells in each table, recall aimed at for pairs at the threshold.
SCALE, PROBES, RECALL = 4.0, 8, 0.95
#: Rows of one group that are compared in one task, rows of one task, and pairs compared at once.
BLOCK, TASK_ROWS, PAIRS = 2048, 8192, 1 << 16
#: More than two ways to add up a cosine can differ by.
ROUNDING = 1e-9
#: Vectors for which two blocks separate well; each further block serves a hundred times as many.
TWO_BLOCKS = 1 << 20
SEED = 20


def _minimal() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    rows = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            rows.append(v)
    rows += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows)


MINIMAL = _minimal()


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of an even sum."""
    point = np.rint(y)
    off = y - point
    odd = np.flatnonzero(point.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return point


def decoded(y: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point of each row."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


@lru_cache(maxsize=256)
def _table(number: int, blocks: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A table's projection, and odd multipliers that hash its lattice points."""
    rng = np.random.default_rng([SEED, number, blocks, dims])
    axes = rng.normal(size=(dims, 8 * blocks))
    if dims >= 8 * blocks:
        axes = np.linalg.qr(axes)[0] * math.sqrt(dims)
    return axes * (SCALE / 8), rng.integers(1 << 62, size=8 * blocks, dtype=np.int64) * 2 + 1


def cells(x: np.ndarray, number: int, blocks: int) -> np.ndarray:
    """For unit vectors: the home cell, and after it the probed cells, as 64-bit hashes."""
    axes, odd = _table(number, blocks, x.shape[1])
    y = x @ axes
    homes, moves, costs = [], [], []
    for b in range(blocks):
        part = y[:, 8 * b:8 * b + 8]
        home = decoded(part)
        cost = 2 - 2 * ((part - home) @ MINIMAL.T)  # how much farther the next points are
        near = np.argpartition(cost, PROBES - 1, axis=1)[:, :PROBES]
        homes.append((2 * home).astype(np.int64) @ odd[8 * b:8 * b + 8])
        moves.append(((2 * MINIMAL).astype(np.int64) @ odd[8 * b:8 * b + 8])[near])
        costs.append(np.take_along_axis(cost, near, 1))
    home = np.sum(homes, axis=0)
    move, cost = np.concatenate(moves, 1), np.concatenate(costs, 1)
    best = np.argpartition(cost, PROBES - 1, axis=1)[:, :PROBES]
    all_cells = np.concatenate([home[:, None], home[:, None] + np.take_along_axis(move, best, 1)], 1)
    return all_cells ^ np.int64((number * 2 + 1) * 0x1E3779B97F4A7C15 % (1 << 62))


def tables_for(n: int, threshold: float, dims: int = 64, sample: int = 2000) -> tuple[int, int]:
    """(blocks, tables) for ``n`` vectors: enough tables for pairs at the threshold, by simulation."""
    blocks = 2 + max(0, math.ceil(math.log(max(n, 1) / TWO_BLOCKS, 100)))
    rng = np.random.default_rng(SEED)
    a = rng.normal(size=(sample, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(sample, dims))
    b -= (a * b).sum(1)[:, None] * a
    b = threshold * a + math.sqrt(1 - threshold**2) * b / np.linalg.norm(b, axis=1)[:, None]
    met = np.zeros(sample, bool)
    for number in range(1000):
        p, q = cells(a, number, blocks), cells(b, number, blocks)
        met |= (p == q[:, :1]).any(1) | (q == p[:, :1]).any(1)
        if met.mean() >= RECALL:
            break
    return blocks, number + 1


def _unit(column: pa.Array, dims: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(1)[:, None]  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1)[:, None]


def _close(x: np.ndarray, group: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one group with cosine >= threshold, i != j, i among ``first``; rows are sorted by group."""
    begin = np.searchsorted(group, group[first], side="left")
    size = np.searchsorted(group, group[first], side="right") - begin
    large = size > 256
    for g in np.unique(group[first[large]]):
        rows = np.arange(np.searchsorted(group, g, side="left"), np.searchsorted(group, g, side="right"))
        own = first[group[first] == g]
        for at in range(0, len(own), 256):
            cosine = x[own[at:at + 256]] @ x[rows].T
            met = cosine >= threshold
            # a product of matrices rounds in its own way: what is this close is decided as in small groups
            i, j = np.nonzero(np.abs(cosine - threshold) < ROUNDING)
            for k in range(0, len(i), PAIRS):
                a, b = i[k:k + PAIRS], j[k:k + PAIRS]
                met[a, b] = np.einsum("ij,ij->i", x[own[at + a]], x[rows[b]]) >= threshold
            i, j = np.nonzero(met)
            i, j = own[at:at + 256][i], rows[j]
            yield i[i != j], j[i != j]
    first, begin, size = first[~large], begin[~large], size[~large]
    ends = np.cumsum(size)
    at = 0
    while at < len(first):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
        each = size[at:stop]
        i = np.repeat(first[at:stop], each)
        j = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin[at:stop], each)
        met = (i != j) & (np.einsum("ij,ij->i", x[i], x[j]) >= threshold)
        yield i[met], j[met]
        at = stop


def _dealt(rows: DataFrame, size: Column) -> DataFrame:
    """Rows of each group in blocks, once for each pair of blocks; many small groups make one task."""
    blocks = F.ceil(size / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))


def _in_tasks(rows: DataFrame, key: str, total: int):
    tasks = max(1, math.ceil(total / TASK_ROWS))
    return rows.groupBy(F.pmod(F.xxhash64(key, "low", "high"), F.lit(tasks)).alias("task"))


def _grouped(table: pa.Table, key: str) -> tuple[pa.Table, np.ndarray]:
    """The rows sorted by length of vector, group and pair of blocks, and each row's group number."""
    columns = [table.column(c).to_numpy() for c in ("dims", key, "low", "high")]
    order = np.lexsort(columns[::-1])
    sorted_columns = np.stack([c[order].astype(np.int64) for c in columns])
    change = np.concatenate([[0], (np.diff(sorted_columns, axis=1) != 0).any(0).cumsum()]) if len(order) else np.zeros(0, int)
    return table.take(pa.array(order)), change


def _each_length(table: pa.Table, group: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    dims = table.column("dims").to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(dims)) + 1, [len(dims)]]) if len(dims) else []
    for a, b in itertools.pairwise(cuts):
        yield a, b, _unit(table.column("embedding").slice(a, b - a).combine_chunks(), int(dims[a]))


def valid_vector(name: str) -> Column:
    bad = F.exists(name, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(name) > 0) & ~bad & F.exists(name, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding", (valid_vector("embedding") & F.col("vec_id").isNotNull()).alias("valid"))
    classes = rows.where("valid").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = staged(classes.withColumn("dims", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()), "lattice-classes")
    blocks, tables = tables_for(classes.count(), threshold)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                part = whole.slice(at, BLOCK)
                dims, node = part.column("dims").to_numpy(), part.column("node").to_numpy()
                for d in np.unique(dims).tolist():
                    here = np.flatnonzero(dims == d)
                    x = _unit(part.column("embedding").take(pa.array(here)), d)
                    for number in range(tables):
                        cell = cells(x, number, blocks) + d
                        home = np.zeros(cell.shape, bool)
                        home[:, 0] = True
                        yield pa.record_batch([pa.array(np.repeat(node[here], cell.shape[1])), pa.array(cell.ravel()), pa.array(home.ravel())], ["node", "cell", "home"])

    keys = staged(classes.select("node", "dims", "embedding").mapInArrow(keyed, "node long, cell long, home boolean"), "lattice-cells")
    # only cells where somebody lives and somebody else calls
    live = keys.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).where("n > 1 AND homes > 0").drop("homes")
    met = staged(_dealt(keys.join(live, "cell"), F.col("n")).select("cell", "node", "home", "low", "high"), "lattice-met")
    vector = classes.select("node", "dims", "embedding")

    def linked(table: pa.Table) -> pa.Table:
        table, group = _grouped(table, "cell")
        node, home = table.column("node").to_numpy(), table.column("home").to_numpy()
        names, place = np.unique(node, return_inverse=True)
        left, right = [], []
        for a, b, x in _each_length(table, group):
            for i, j in _close(x, group[a:b], np.flatnonzero(home[a:b]), threshold):
                label = local_components(len(names), place[a + i], place[a + j])
                moved = np.flatnonzero(label != np.arange(len(names)))
                left.append(moved)
                right.append(label[moved])
        label = local_components(len(names), np.concatenate([*left, []]).astype(int), np.concatenate([*right, []]).astype(int))
        moved = np.flatnonzero(label != np.arange(len(names)))
        return pa.table({"a": names[moved], "b": names[label[moved]]})

    links = _in_tasks(met.join(vector, "node"), "cell", met.count()).applyInArrow(linked, "a long, b long")
    roots = components(links, "lattice-links")
    members = classes.join(roots, "node").select("node", "root", "dims", "embedding", "n", "least")
    sizes = members.groupBy("root").agg(F.count("*").alias("size"), F.min("least").alias("component_id"))
    members = staged(_dealt(members.join(sizes, "root"), F.col("size")), "lattice-members")

    def counted(table: pa.Table) -> pa.Table:
        table, group = _grouped(table, "root")
        n, own, node = (table.column(c).to_numpy() for c in ("n", "own", "node"))
        cross = table.column("low").to_numpy() != table.column("high").to_numpy()
        links = np.zeros(len(node), np.int64)
        for a, b, x in _each_length(table, group):
            for i, j in _close(x, group[a:b], np.arange(b - a), threshold):
                new = ~cross[a + i] | (own[a + i] != own[a + j])  # pairs within a block count in its own task
                np.add.at(links, a + i[new], n[a + j[new]])
        return pa.table({"node": node, "links": links})

    counts = _in_tasks(members, "root", members.count()).applyInArrow(counted, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    found = members.where("other = 0").select("node", "component_id").join(counts, "node")
    known = classes.join(found, "node", "left").select(F.col("embedding").alias("vector"), "n", "links", F.coalesce("component_id", "least").alias("component"))
    out = rows.join(known, rows["valid"] & (rows["embedding"] == known["vector"]), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


SQL = """
WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS row, vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v,
  coalesce(len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0, FALSE)
  AND vec_id IS NOT NULL AS valid FROM embeddings),
links AS (SELECT a.row AS a, b.row AS b FROM vectors a JOIN vectors b ON a.valid AND b.valid AND a.row <> b.row AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached(node, root) AS (SELECT row, row FROM vectors UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.root),
component AS (SELECT node, min(vec_id) AS component_id FROM reached JOIN vectors ON row = root GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, FALSE) AS kept
FROM vectors JOIN component ON node = row LEFT JOIN degree ON a = row
"""
