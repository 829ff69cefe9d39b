"""Packing documents into sequences: cutting stock by column generation.

A document's ids are cut at every ``LENGTH``: whole pieces fill a sequence, and
the remainders are the items of a cutting-stock problem. Their lengths, rounded
up to units, form a histogram of a fixed number of bins. A linear program over
patterns (how many items of each bin one sequence holds) is solved by column
generation: a simplex basis of as many patterns as bins, priced by a knapsack
dynamic program. Patterns are used as often as the solution says, rounded down;
what is left is filled sequence by sequence, the longest item first and the rest
by subset sums. Documents are ranked within their bin, by hash, and the nth item
of a bin goes to the nth place that the patterns have for it.

Only the histogram, of at most ``LENGTH`` numbers, is on the driver. Sequences
of one power of two need no padding; all others are padded to ``LENGTH``.

Defined cases: a null or empty text is just the end id. Repeated rows are items
of their own; rows without id are packed like others. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logweave.llm.storage import staged
from logweave.llm.text import ascii_lower, slices, word_codes, text_bytes, word_spans

LENGTH = 4096
END = 2
#: Ids that one unit of the histogram stands for.
UNIT = 8
#: The linear program ends when its value is within this share of the optimum.
GAP = 1e-3
#: Distinct parts of words that a worker's memo of ids holds before it starts anew.
MEMO = 1 << 18
RANGE_ROWS = 4096
#: Bytes a-z and 0-9; and printable marks, without those that contractions and special tokens hold.
PLAIN = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
MARK = np.isin(np.arange(256), list(b"!#$%&()*+,-./:;=?@[]^_{}~\"\\`"))
#: The second bytes of the letters from sharp s to y with diaeresis, all lower-case; and words of such letters and a-z.
ACCENTED = (np.arange(256) >= 0x9F) & (np.arange(256) <= 0xBF) & (np.arange(256) != 0xB7)
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_names() -> dict[int, int]:
    """The letter by which byte-level vocabularies name each byte: itself if it can be seen, else the next free one."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in seen)}


BYTE_NAMES = _byte_names()


#: How a file must prepare texts for the shortcuts here to give its own ids.
NORMALIZERS, SPLITTERS, WORD_END = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "</w>"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    """The file's tokenizer; one that prepares texts otherwise is refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    splits = [n["type"] for n in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if (steps, splits, spec["model"].get("end_of_word_suffix")) != (NORMALIZERS, SPLITTERS, WORD_END):
        raise ValueError(f"{path}: only lower-casing byte-level BPE with word ends is supported")
    return Tokenizer.from_file(path)


def _parts(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts (words of ASCII lower-cased) in parts that the tokenizer never joins: (bytes, start, end, text number).

    A part is a word, or a word's plain letters and digits and, on their own, the plain marks that
    end it. Words that hold ``<`` might be special tokens: they keep their case and stay whole.
    Words beyond ASCII keep their case too: the tokenizer composes letters and marks before it
    lowers them, and some composed letters have no capital.
    """
    start, end, doc = word_spans(raw, begins)
    low = ascii_lower(raw)
    if not len(start):
        return low, start, end, doc
    special = np.unique(np.searchsorted(start, np.flatnonzero(raw == ord("<")), side="right") - 1)
    as_is = np.union1d(special, np.searchsorted(start, np.flatnonzero(raw >= 0x80), side="right") - 1)
    edge = np.zeros(len(raw) + 1, np.int8)
    np.add.at(edge, start[as_is], 1)
    np.add.at(edge, end[as_is], -1)
    low = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, raw, low)
    body = np.maximum.accumulate(np.where(MARK[low], -1, np.arange(len(low))))[end - 1]  # the last byte that is no mark
    last, before = low[np.maximum(body, 0)], low[np.maximum(body - 1, 0)]
    cut = (body >= start) & (body < end - 1) & (PLAIN[last] | (body > start) & (before == 0xC3) & ACCENTED[last])
    cut[special] = False
    where = np.flatnonzero(cut)
    middle = body[where] + 1
    return low, np.insert(start, where + 1, middle), np.insert(end, where, middle), np.insert(doc, where + 1, doc[where])


class Memo:
    """The ids of parts of words seen before, on end in one array."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def look_up(self, words: list[bytes], path: str) -> np.ndarray:
        """Each word's number, after its ids have been added if they weren't there."""
        if len(self.place) > MEMO:
            self.__init__()
        new = [w for w in words if w not in self.place]
        tokenizer = _tokenizer(path)
        one = tokenizer.model.tokenize
        plain, odd = [], []
        for w in new:
            (plain if LETTERS.fullmatch(w) else odd).append(w)
        # lower-case letters are one piece as they are: only the merges are left to do
        got = [[t.id for t in one(w.decode() if w.isascii() else w.decode("latin-1").translate(BYTE_NAMES))] for w in plain]
        got += [e.ids for e in tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum()))
        self.place.update(zip([*plain, *odd], range(len(self.place), len(self.place) + len(new)), strict=True))
        self.size, self.ids = np.concatenate([self.size, size]), np.concatenate([self.ids, ids])
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))


@lru_cache(maxsize=1)
def _memo(path: str) -> Memo:
    """The worker's own memo: later tasks go on with it."""
    return Memo()


def ids_of(column: pa.Array, path: str, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts on end, each with the end id, and where each text's ids begin.

    The tokenizer never joins what white space parts, so each distinct part is encoded once.
    """
    raw, start, end, doc = _parts(*text_bytes(column))
    n = len(column)
    code, vocabulary = word_codes(raw, start, end)
    word = memo.look_up(vocabulary.to_pylist(), path)[code]
    at = np.cumsum(memo.size) - memo.size
    each = memo.size[word]  # ids of every part
    held = np.bincount(doc, each, minlength=n).astype(np.int64) + 1
    first = np.concatenate([[0], np.cumsum(held)])
    ids = np.full(first[-1], END, np.uint32)
    inner = np.cumsum(each) - each
    place = np.arange(int(each.sum()))
    ids[place + np.repeat(doc, each)] = memo.ids[np.repeat(at[word] - inner, each) + place]  # one end id for each text before
    return ids, first


def pieces(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: every document's ids, cut at each multiple of ``length``."""
    _tokenizer(path)  # a file that isn't supported fails here, not in a task
    pair = docs.select("doc_id", "text")
    kind = pair.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(path)
        for part in slices(batches):
            ids, first = ids_of(part.column("text"), path, memo)
            total = np.diff(first)
            count = -(-total // length)
            owner = np.repeat(np.arange(len(total)), count)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * length
            size = np.minimum(length, total[owner] - start)
            data, begin = ids.astype("<u4").view(np.uint8), (first[owner] + start) * 4
            crc = [zlib.crc32(data[a:b]) for a, b in zip(begin.tolist(), (begin + size * 4).tolist(), strict=True)]
            yield pa.record_batch([part.column("doc_id").take(pa.array(owner)), *(pa.array(x, pa.int64()) for x in (start, size, crc, total[owner]))],
                                  ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return pair.mapInArrow(of, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def _priced(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern within the capacity: an unbounded knapsack."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = size <= room
        got = np.where(fits, best[np.maximum(room - size, 0)] + value, -1.0)
        k = int(got.argmax())
        best[room], chosen[room] = (got[k], k) if got[k] > best[room - 1] else (best[room - 1], -2)
    pattern, room = np.zeros(len(size)), capacity
    while room > 0 and chosen[room] != -1:
        if chosen[room] == -2:
            room -= 1
        else:
            pattern[chosen[room]] += 1
            room -= size[chosen[room]]
    return float(best[capacity]), pattern


def _first_basis(demand: np.ndarray, size: np.ndarray, capacity: int) -> np.ndarray:
    """A triangular basis: each bin, the longest first, fills up with shorter items as far as there are enough."""
    basis, left = np.zeros((len(size), len(size))), demand.copy()
    for k in range(len(size) - 1, -1, -1):
        basis[k, k] = capacity // size[k]
        often, room = left[k] / basis[k, k], capacity % size[k]
        while len(fits := np.flatnonzero((size[:k] <= room) & (left[:k] >= often))):
            basis[fits[-1], k] += 1
            left[fits[-1]] -= often
            room -= size[fits[-1]]
    return basis


def relaxed(demand: np.ndarray, size: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in the linear program's solution (column generation).

    Demands are raised by tiny, distinct amounts, so that no step is degenerate. It ends at the
    optimum, or when as many rounds as there are bins have hardly lowered the value.
    """
    m = len(size)
    demand = demand + 1e-4 * (1 + np.arange(m) / m)
    patterns = _first_basis(demand, size, capacity)  # columns
    inverse = np.zeros((m, m))
    for k in range(m - 1, -1, -1):  # plain sums throughout: threaded matrix products stall on a busy machine
        inverse[k] = -(patterns[k, k + 1:, None] * inverse[k + 1:]).sum(0)
        inverse[k, k] += 1
        inverse[k] /= patterns[k, k]
    used = np.maximum((inverse * demand).sum(1), 0)
    reached: list[float] = []
    for step in itertools.count():
        reached.append(float(used.sum()))
        if step >= m and reached[step - m] - reached[step] < GAP * reached[step]:
            break
        value, pattern = _priced(inverse.sum(0), size, capacity)
        if value <= 1 + GAP:
            break
        change = (inverse * pattern).sum(1)
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * change, 0)
        used[out] = ratio[out]
        patterns[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= change[:, None] * row
        inverse[out] = row
    return [(patterns[:, k].astype(int), float(used[k])) for k in range(m)]


def _filled(left: np.ndarray, size: np.ndarray, capacity: int) -> np.ndarray:
    """One sequence of what is left: the longest item, then the fullest choice of the others."""
    pattern, left = np.zeros(len(size), int), left.copy()
    k = int(np.flatnonzero(left).max())
    pattern[k] += 1
    left[k] -= 1
    room = capacity - int(size[k])
    reach, steps = 1, []  # bit i: i units can be filled
    for b in range(len(size)):
        for _ in range(min(int(left[b]), room // int(size[b]))):
            more = (reach | (reach << int(size[b]))) & ((1 << (room + 1)) - 1)
            if more == reach:
                break
            steps.append((b, reach))
            reach = more
    goal = reach.bit_length() - 1
    for b, before in reversed(steps):
        if not before >> goal & 1:
            pattern[b] += 1
            goal -= int(size[b])
    return pattern


def cutting_plan(histogram: dict[int, int], capacity: int) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """(pattern, how often, bins' sizes) that together hold every item once; sizes in units."""
    size = np.array(sorted(histogram), int)
    left = np.array([histogram[s] for s in size], int)
    plan = []
    if len(size):
        for pattern, often in relaxed(left.astype(float), size, capacity):
            often = int(often + 1e-6)
            if pattern.any():
                often = min(often, int((left[pattern > 0] // pattern[pattern > 0]).min()))
            if often > 0:
                plan.append((pattern, often, size))
                left = left - often * pattern
        while left.any():
            pattern = _filled(left, size, capacity)
            often = int((left[pattern > 0] // pattern[pattern > 0]).min())
            plan.append((pattern, often, size))
            left = left - often * pattern
    return plan


def _places(plan: list[tuple[np.ndarray, int, np.ndarray]]) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """For each bin: from which rank a pattern's places begin, its first sequence and its items in one; and the number of sequences."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, often, size in plan:
        for k in np.flatnonzero(pattern):
            s, each = int(size[k]), int(pattern[k])
            rows.setdefault(s, []).append((taken.get(s, 0), sequence, each))
            taken[s] = taken.get(s, 0) + each * often
        sequence += often
    return {s: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for s, r in rows.items()}, sequence


def pack(docs: DataFrame, path: str, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """Every piece with its sequence, its offset there and what the sequence is padded to."""
    table = staged(pieces(docs, path, length), "packing-pieces")
    units = F.when(F.col("length") == length, F.lit(0)).otherwise(F.ceil(F.col("length") / unit)).cast("int")  # 0: a whole sequence
    histogram = {r["units"]: r["n"] for r in table.groupBy(units.alias("units")).agg(F.count("*").alias("n")).collect()}
    whole = histogram.pop(0, 0)
    ranges = max(1, (whole + sum(histogram.values())) // RANGE_ROWS)
    places, sequences = _places(cutting_plan(histogram, length // unit))
    # ranks within each bin, from the counts of hash ranges
    key = F.xxhash64("doc_id", "start", "ids_crc32")
    keyed = table.withColumn("units", units).withColumn("key", key).withColumn("range", F.pmod("key", F.lit(ranges)))
    before = Window.partitionBy("units").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("units", "range").agg(F.count("*").alias("n")).select("units", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("units", "range").orderBy("key", "doc_id", "start"))
    ranked = keyed.withColumn("within", within).join(starts, ["units", "range"]).withColumn("rank", F.col("base") + F.col("within") - 1)
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("units", "rank"))
            sequence = rank + sequences
            for s in np.unique(bins[bins > 0]).tolist():
                here = np.flatnonzero(bins == s)
                begin, first, each = places[s]
                k = np.searchsorted(begin, rank[here], side="right") - 1
                sequence[here] = first[k] + (rank[here] - begin[k]) // each[k]
            yield pa.record_batch([*(b.column(c) for c in kept), pa.array(sequence)], [*kept, "sequence_id"])

    fields = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in kept)
    dealt = ranked.select(*kept, "units", "rank").mapInArrow(placed, f"{fields}, sequence_id long")
    inside = Window.partitionBy("sequence_id")
    line = inside.orderBy(F.col("length").desc(), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("length").over(inside.orderBy(F.col("length").desc(), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    packed = dealt.withColumn("offset", F.coalesce(F.sum("length").over(line), F.lit(0))).withColumn("filled", total)
    return packed.select(*kept, "sequence_id", "offset",
                         F.when(F.col("filled").bitwiseAND(F.col("filled") - 1) == 0, F.col("filled")).otherwise(F.lit(length).cast("long")).alias("padded_to"))
