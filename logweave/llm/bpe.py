"""BPE encoding and decoding: a contiguous rank array for each word.

The tokenizer is a byte-level BPE file, as the tokenizers library reads it. A
text is cut at the file's added tokens, then into words by the byte-level
pattern. A word starts as one part a byte, with the rank of every boundary (of
the merge that would remove it) beside it. The ranks are scanned for the least,
the first of equals; that boundary is deleted, and the ranks of its two
neighbours are looked up anew, until no boundary has a rank. Words are encoded
once per worker, in a memo of a bounded size. A word of more than ``SHORT``
bytes has the same rank array, in which all boundaries of the least rank go in
one step, from left to right: a merge only makes parts whose own merges rank
later (checked when the file is read), so the result is the same, and time stays
near n log n however long a word is.

Ids are kept as little-endian unsigned 32-bit integers in one binary value, the
form of training shards, or as an array. Decoding joins the tokens' bytes; bytes
that aren't UTF-8 become U+FFFD, and ids that the file doesn't have are left out.

Defined cases: a null or empty text has no ids and decodes to an empty text; null
ids decode to an empty text. Rows are independent: repeated rows and ties need no
rule. Columns named like the result's are replaced by it; all others are kept.
Files with a normalizer, another splitter or other merge options are refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from logweave.llm.packing import BYTE_NAMES
from logweave.llm.text import slices

#: Fixed value: how byte-level vocabularies cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = regex.compile(PATTERN)
#: Settings of a file that this module implements; others are refused.
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
         "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
PLAIN_TOKEN = {"single_word": False, "lstrip": False, "rstrip": False}
SHORT = 64
#: Words that a worker's memo holds before it starts anew.
MEMO = 1 << 19
#: Words looked up at a time, and rows of words merged at a time.
STEP, ROWS = 1 << 17, 4096
#: No merge removes a boundary of this rank.
NONE = 1 << 30


def _demand(given: dict, wanted: dict, what: str) -> None:
    for k, v in wanted.items():
        if given.get(k, v) != v:
            raise ValueError(f"{what}: {k} = {given[k]!r} is not supported")


class Bpe:
    """One tokenizer file, and a memo of the words encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        _demand(model, MODEL, "model")
        _demand(spec["pre_tokenizer"] or {"type": None}, SPLIT, "pre_tokenizer")
        _demand(spec, {"normalizer": None}, "file")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t in spec["added_tokens"]:
            _demand(t, PLAIN_TOKEN, f"added token {t['content']!r}")
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte_ids = np.array([vocab[chr(BYTE_NAMES.get(b, b))] for b in range(256)], np.int32)
        self.size = 1 + max([*vocab.values(), *self.added.values()])
        made, pairs, result = set(self.byte_ids.tolist()), {}, []
        for rank, (a, b) in enumerate(merges):
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            if not {left, right} <= made:
                raise ValueError(f"merge {rank} uses a part that only a later merge makes")
            made.add(new)
            pairs.setdefault(left * self.size + right, rank)
            result.append(new)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = keys.argsort()
        self.keys, self.ranks = keys[order], np.fromiter(pairs.values(), np.int32, len(keys))[order]
        self.result = np.array(result, np.int32)
        byte_of = {chr(BYTE_NAMES.get(b, b)): b for b in range(256)}
        self.bytes_of = [b""] * self.size
        for token, k in vocab.items():
            self.bytes_of[k] = bytes(byte_of[c] for c in token)
        for token, k in self.added.items():
            self.bytes_of[k] = token.encode()
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.memo: dict[str, bytes] = {}
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.alike: set[str] = set()

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], np.int32(NONE))

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of short words: a row for each, with its parts and the rank of the boundary after each part."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max())
        inside = np.arange(width) < size[:, None]
        parts, ranks = np.full(inside.shape, -1, np.int32), np.full(inside.shape, NONE, np.int32)
        parts[inside] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        row, col = np.nonzero(inside[:, 1:])
        ranks[row, col] = self._rank_of(parts[row, col], parts[row, col + 1])
        place, who = np.arange(width), np.arange(len(words))
        while len(who):
            at = ranks[who].argmin(1)
            least = ranks[who, at]
            found = least < NONE
            who, at, least = who[found], at[found], least[found]
            # the boundary goes, and all behind it move up by one
            parts[who] = np.take_along_axis(parts[who], np.minimum(place + (place > at[:, None]), width - 1), 1)
            ranks[who] = np.take_along_axis(ranks[who], np.minimum(place + (place >= at[:, None]), width - 1), 1)
            size[who] -= 1
            parts[who, at] = self.result[least]
            ranks[who, size[who] - 1] = NONE
            for side in (at - 1, at):
                there = (side >= 0) & (side + 1 < size[who])
                w, k = who[there], side[there]
                ranks[w, k] = self._rank_of(parts[w, k], parts[w, k + 1])
        ids, ends = parts[place < size[:, None]].astype("<u4").tobytes(), np.cumsum(size * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merged_long(self, word: bytes) -> np.ndarray:
        """The same for a word of any length: boundaries lie in lists by rank, and one rank's go at once."""
        n = len(word)
        parts = self.byte_ids[np.frombuffer(word, np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ranks = np.append(self._rank_of(parts[:-1], parts[1:]), np.int32(NONE))
        alive = np.ones(n, bool)
        lists: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def file(at: np.ndarray) -> None:
            at = at[ranks[at] < NONE]
            at = at[ranks[at].argsort(kind="stable")]
            for group in np.split(at, np.flatnonzero(np.diff(ranks[at])) + 1) if len(at) else ():
                rank = int(ranks[group[0]])
                if rank not in lists:
                    lists[rank] = []
                    heappush(queue, rank)
                lists[rank].append(group)

        file(np.arange(n))
        while queue:
            rank = heappop(queue)
            at = np.unique(np.concatenate(lists.pop(rank)))
            at = at[ranks[at] == rank]
            if not len(at):
                continue
            # of boundaries that share a part, every other one stays
            first = np.append(True, after[at[:-1]] != at[1:])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
            gone = after[at]
            parts[at], ranks[gone] = self.result[rank], NONE
            after[at] = after[gone]
            inside = after[at] < n
            before[after[at][inside]] = at[inside]
            left = before[at]
            touched = np.unique(np.concatenate([left[left >= 0], at]))
            ends = after[touched] >= n
            ranks[touched[ends]] = NONE
            touched = touched[~ends]
            ranks[touched] = self._rank_of(parts[touched], parts[after[touched]])
            file(touched)
            alive[gone] = False
        return parts[alive]

    def learn(self, words: set[str]) -> list[str]:
        """Put words into the memo; those that are too long to stay are returned."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        by_size: dict[int, list[str]] = {}
        for w in (w for w in words if w not in self.memo):
            by_size.setdefault(min(SHORT + 1, -(-len(w.encode()) // 8) * 8), []).append(w)
        long = by_size.pop(SHORT + 1, [])
        for some in by_size.values():
            for k in range(0, len(some), ROWS):
                group = some[k:k + ROWS]
                self.memo.update(zip(group, self.merged([w.encode() for w in group]), strict=True))
        self.memo.update((w, self.merged_long(w.encode()).astype("<u4").tobytes()) for w in long)
        return long

    def _cuts_alike(self, text: str) -> bool:
        """Whether the pattern's character classes here are the library's (tables of another Unicode version may differ)."""
        if text.isascii():
            return True
        for c in set(text) - self.alike:
            seen = [len(self.splitter.pre_tokenize_str(p + c)) == 1 for p in "a1!"]
            if seen != [len(WORDS.findall(p + c)) == 1 for p in "a1!"]:
                return False
            self.alike.add(c)
        return True

    def _words(self, text: str) -> Iterator[list[str]]:
        if not self._cuts_alike(text):
            yield [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        elif len(text) <= STEP:
            yield WORDS.findall(text)
        else:
            found = WORDS.finditer(text)
            while some := [m.group() for m in islice(found, STEP)]:
                yield some

    def _pieces(self, text: str) -> Iterator[list[str] | bytes]:
        """Lists of words, and the ids of added tokens between them."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._words(text[at:m.start()])
            yield self.added[m.group()].to_bytes(4, "little")
            at = m.end()
        yield from self._words(text[at:] if at else text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, four little-endian bytes each."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | bytes]] = []

        def flush() -> None:
            long = self.learn({w for _, words in held if isinstance(words, list) for w in words})
            for k, words in held:
                out[k].append(words if isinstance(words, bytes) else b"".join(map(self.memo.__getitem__, words)))
            for w in long:
                del self.memo[w]
            held.clear()

        size = 0
        for k, text in enumerate(texts):
            for words in self._pieces(text):
                held.append((k, words))
                size += len(words)
                if size >= STEP:
                    flush()
                    size = 0
        flush()
        return [b"".join(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        if len(ids) and int(ids.max()) >= self.size:
            ids = ids[ids < self.size]
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Bpe:
    """The worker's own: later tasks go on with its memo."""
    return Bpe(path)


def _extended(df: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [c for c in df.columns if c.lower() != name.lower()]
    return kept, T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])


def encoded(docs: DataFrame, path: str, ids: str = "ids", as_array: bool = False) -> DataFrame:
    """``docs`` with each text's ids in one more column: binary, or an array of integers."""
    tokenizer(path)  # a file that isn't supported fails here, not in a task
    kept, schema = _extended(docs, ids, T.ArrayType(T.IntegerType()) if as_array else T.BinaryType())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for part in slices(batches):
            out = bpe.encode([t or "" for t in part.column("text").to_pylist()])
            values = pa.array([np.frombuffer(x, "<i4") for x in out], pa.list_(pa.int32())) if as_array else pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), values], names=[*kept, ids])

    return docs.mapInArrow(of, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of their ids in column ``text``."""
    tokenizer(path)
    kept, schema = _extended(rows, text, T.StringType())
    binary = isinstance(rows.schema[ids].dataType, T.BinaryType)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        parts = slices(batches, ids) if binary else (b.slice(k, 64) for b in batches for k in range(0, b.num_rows, 64))
        for part in parts:
            values = [np.frombuffer(x or b"", "<u4") if binary else np.array(x or [], np.uint32) for x in part.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array([bpe.decode(v) for v in values], pa.string())], names=[*kept, text])

    return rows.mapInArrow(of, schema)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    rows = decoded(encoded(docs.select("doc_id", "text"), path).select("doc_id", "ids"), path)
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
