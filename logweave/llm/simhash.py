"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints: XXH64 of every word shingle (repeats count), one bit per position
that more than half of the hashes set. Equal fingerprints are one class. The
distinct fingerprints are sorted by Gray rank and dealt into ranges of about
``RANGE_ROWS``. In each range, groups of ``FAN`` neighbours share a node that
holds the bits on which they all agree, groups of nodes share an upper node,
and a node keeps only the bits that its parent doesn't hold already. A search
adds up the differing bits from the root downwards and drops a whole group as
soon as they exceed the limit. One more tree, over the ranges, sends each
fingerprint only to ranges that may hold a partner. However many a range gets, a
task searches about ``QUERIES`` of them: they are dealt into blocks, each with the
range's own fingerprints.

Defined cases: a text with fewer words than the shingle length is one shingle; a
text without words, or null, has fingerprint 0 and links like any other.
Repeated rows share a class. A row without doc_id has a fingerprint, and the
smallest id of its component (null if no member has one). Extra columns are
ignored by ``fingerprints`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logweave.llm.components import components, local_components
from logweave.llm.storage import free_name, staged
from logweave.llm.text import ascii_lower, slices, text_bytes, word_spans

SEED = 42
FAN = 8
RANGE_ROWS = 1 << 16
#: Fingerprints that one task looks up in one range, about: as many ranges' worth as keep the copies of a range's
#: own ones, one for each block, below a quarter of all visits. And those that one pass of a search takes.
QUERIES = 4 * RANGE_ROWS
BLOCK = 4096
SIGN = np.uint64(1 << 63)
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    raw, begins = text_bytes(column)
    n = len(column)
    raw = ascii_lower(raw)
    start, end, doc = word_spans(raw, begins)
    counts = np.bincount(doc, minlength=n)
    size = end - start
    # all words with one space between them
    at = np.cumsum(size + 1) - size - 1
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = raw[~((raw == 32) | ((raw >= 9) & (raw <= 13)))]
    first = np.cumsum(counts) - counts  # of each text, its first word
    place = np.arange(len(doc)) - first[doc]
    heads = np.flatnonzero(place <= np.maximum(counts[doc] - shingle, 0))
    tails = np.minimum(heads + shingle, first[doc[heads]] + counts[doc[heads]]) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(at[heads].tolist(), (at[tails] + size[tails]).tolist(), strict=True)
    hashes = np.fromiter((digest(data[s:e], SEED) for s, e in spans), np.uint64, len(heads))
    owner = doc[heads]
    total = np.bincount(owner, minlength=n)
    prints = np.zeros(n, np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        ones = np.bincount(owner * 256 + octets[:, k], minlength=n * 256).reshape(n, 256) @ BITS
        for bit in range(8):
            prints |= (2 * ones[:, bit] > total).astype(np.uint64) << np.uint64(8 * k + bit)
    return prints


def fingerprints(docs: DataFrame, shingle: int, into: str = "fp", keep: list[str] | None = None,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp): each text's fingerprint as a signed long; with ``keep``, beside these columns of ``docs``."""
    source = docs if keep else docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    text = text_column if keep else "text"
    held = keep or ["doc_id"]
    schema = StructType([*(source.schema[c] for c in held), StructField(into, LongType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            prints = pa.array(fingerprints_of(part.column(text), shingle).view(np.int64))
            yield pa.record_batch([*(part.column(c) for c in held), prints], [*held, into])

    return source.mapInArrow(of, schema)


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """The position of each 64-bit word in the reflected binary order."""
    rank = prints.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


class GrayTree:
    """Nodes over a sequence of (all-ones, any-ones) pairs that is in Gray order."""

    def __init__(self, every: np.ndarray, some: np.ndarray) -> None:
        levels = [(every, some)]
        while len(levels[-1][0]) > FAN:
            every, some = levels[-1]
            heads = np.arange(0, len(every), FAN)
            levels.append((np.bitwise_and.reduceat(every, heads), np.bitwise_or.reduceat(some, heads)))
        held = np.zeros(1, np.uint64)  # bits that a parent holds
        self.levels = []
        for every, some in reversed(levels):
            shared = ~(every ^ some)
            self.levels.append((every, shared & ~held[np.arange(len(every)) // FAN]))
            held = shared

    def search(self, prints: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all pairs whose accumulated differences stay within ``limit``."""
        query = np.arange(len(prints))
        node = np.zeros(len(prints), np.int64)
        spent = np.zeros(len(prints), np.int64)
        for pattern, mask in self.levels:
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            query, spent = np.repeat(query, FAN), np.repeat(spent, FAN)
            real = child < len(pattern)
            query, spent, child = query[real], spent[real], child[real]
            spent = spent + np.bitwise_count((prints[query] ^ pattern[child]) & mask[child])
            near = spent <= limit
            query, spent, node = query[near], spent[near], child[near]
        return query, node


def _links(own: np.ndarray, asked: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the search for ``asked`` connects with ``own``: at most one for each fingerprint."""
    own = own[np.argsort(gray_rank(own))]
    tree = GrayTree(own, own)
    nodes, place = np.unique(np.concatenate([own, asked]), return_inverse=True)
    leaves, asked = place[:len(own)], np.unique(place[len(own):])
    left, right = [], []
    for at in range(0, len(asked), BLOCK):
        query, leaf = tree.search(nodes[asked[at:at + BLOCK]], limit)
        query, leaf = asked[at + query], leaves[leaf]
        apart = query != leaf
        label = local_components(len(nodes), query[apart], leaf[apart])
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        left.append(moved)
        right.append(label[moved])
    label = local_components(len(nodes), np.concatenate(left), np.concatenate(right))
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_links(prints: DataFrame, limit: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints (column fp) within ``limit`` bits."""
    spark = prints.sparkSession

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.record_batch([b.column("fp"), pa.array((gray_rank(fp) ^ SIGN).view(np.int64))], ["fp", "rank"])

    table = staged(prints.select("fp").mapInArrow(ranked, "fp long, rank long"), "simhash-ranks")
    n = table.count()
    count = max(1, math.ceil(n / range_rows))
    cuts = []
    if count > 1:
        cuts = table.agg(F.percentile_approx("rank", [i / count for i in range(1, count)], 20 * count)).first()[0]
    bounds = np.unique(np.array(cuts, np.int64))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.searchsorted(bounds, b.column("rank").to_numpy(zero_copy_only=False))
            yield pa.record_batch([b.column("fp"), pa.array(part.astype(np.int64))], ["fp", "part"])

    ranges = table.mapInArrow(placed, "fp long, part long")
    nodes = ranges.groupBy("part").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")).orderBy("part").collect()
    if not nodes:
        return spark.createDataFrame([], "a long, b long")
    number = np.array([r["part"] for r in nodes], np.int64)
    every, some = (np.array([r[c] for r in nodes], np.int64).view(np.uint64) for c in ("every", "some"))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = GrayTree(every, some)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                b = whole.slice(at, BLOCK)
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                home = b.column("part").to_numpy(zero_copy_only=False)
                query, leaf = top.search(fp, limit)
                ahead = number[leaf] >= home[query]  # each pair meets in the later range
                query, goal = query[ahead], number[leaf[ahead]]
                yield pa.record_batch([pa.array(goal), pa.array(fp[query].view(np.int64)), pa.array(goal == home[query])], ["part", "fp", "own"])

    visits = staged(ranges.mapInArrow(routed, "part long, fp long, own boolean"), "simhash-visits")
    blocks = np.ones(len(bounds) + 1, np.int64)
    for r in visits.groupBy("part").count().collect():  # a row for each range
        blocks[r["part"]] = math.ceil(r["count"] / QUERIES)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each fingerprint asks in one block of its range; the range's own ones are in all of them."""
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                b = whole.slice(at, BLOCK)
                part, own = (b.column(c).to_numpy(zero_copy_only=False) for c in ("part", "own"))
                fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
                asks = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % blocks[part]
                ends = np.cumsum(np.where(own, blocks[part], 1))
                for c in range(0, int(ends[-1]), RANGE_ROWS):
                    copy = np.arange(c, min(c + RANGE_ROWS, int(ends[-1])))
                    row = np.searchsorted(ends, copy, "right")
                    block = np.where(own[row], ends[row] - copy - 1, asks[row])
                    yield pa.record_batch([pa.array(x) for x in (part[row], block, fp[row].view(np.int64), own[row], asks[row] == block)],
                                          ["part", "block", "fp", "own", "asks"])

    def linked(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        a, b = _links(fp[group.column("own").to_numpy()], fp[group.column("asks").to_numpy()], limit)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return visits.mapInArrow(dealt, "part long, block long, fp long, own boolean, asks boolean").groupBy("part", "block").applyInArrow(linked, "a long, b long")


def near_duplicates(table: DataFrame, limit: int) -> DataFrame:
    """(doc_id, fp, component_id) for a written table (doc_id, fp)."""
    classes = staged(table.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(near_links(classes, limit), "simhash-links")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return table.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    table = staged(fingerprints(docs, shingle), "simhash-prints")
    return near_duplicates(table, limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """``docs`` with one row of each group, of the smallest doc_id; rows in groups without any id all stay.

    Of several rows with that id and one fingerprint, the one of the smallest row hash stays,
    so the result doesn't depend on the order of the input.
    """
    a, b = free_name(docs, "row_a"), free_name(docs, "row_b")
    cells = [F.col(c) for c in docs.columns]
    marked = docs.withColumns({a: F.xxhash64(*cells), b: F.xxhash64(F.lit(1), *cells)})  # 128 bits of the whole row
    name = free_name(marked, "simhash")
    prints = fingerprints(marked.select("doc_id", "text", a, b), shingle, name, ["doc_id", a, b])
    table = staged(prints.toDF("doc_id", "row_a", "row_b", "fp"), "simhash-prints")
    first = near_duplicates(table.select("doc_id", "fp"), limit).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).distinct()
    named = table.join(first.where("doc_id IS NOT NULL"), ["doc_id", "fp"], "left_semi").groupBy("doc_id", "fp").agg(F.min(F.struct("row_a", "row_b")).alias("row"))
    nameless = table.where("doc_id IS NULL").join(first.where("doc_id IS NULL"), ["fp"], "left_semi").select("row_a", "row_b")
    kept = named.select("row.row_a", "row.row_b").union(nameless).distinct().toDF(a, b)
    # repeated rows meet here; those without id are told apart again
    apart = free_name(marked, "apart")
    rows = marked.join(kept, [a, b], "left_semi").withColumn(apart, F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return rows.dropDuplicates([a, b, apart]).select(*docs.columns)
