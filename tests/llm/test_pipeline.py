"""Each stage of the pipeline against a plain version that is fed the rows of the stage before."""

import collections
import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logweave.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.helpers import TOKENIZER, words
from tests.llm.test_documents import _cut, _print, _signed, _targets


def plain_lines(rows):
    kept = _cut([(r["doc_id"], r["text"]) for r in rows], 50)
    text = [None if r["text"] is None else kept[r["doc_id"], _signed(r["text"])] for r in rows]
    return [r | {"text": t, "n_chars": r["n_chars"] if t == r["text"] else len(t)} for r, t in zip(rows, text, strict=True)]


def plain_one_of_each(rows):
    prints, root = [_print(r["text"]) for r in rows], list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, r in enumerate(rows):
        g = find(k)
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    return [r for k, r in enumerate(rows) if r["doc_id"] == least[find(k)]]


def plain_mixed(rows):
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    out = []
    for s, target in _targets(dict(sizes)).items():
        own = sorted((md5(f"{r['doc_id']}:{md5(r['text'] or '')}"), r["doc_id"], len(words(r["text"])), k) for k, r in enumerate(rows) if r["source"] == s)
        epochs = math.floor(target) // sizes[s] if sizes[s] else 0
        rest, place = math.floor(target) - epochs * sizes[s], 0
        for *_, size, k in own:
            out += [rows[k]] * (epochs + (rest > place and 2 * (rest - place) >= size))
            place += size
    return out


def plain_pieces(rows):
    tokenizer, out = Tokenizer.from_file(TOKENIZER), collections.Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        for at in range(0, len(ids), 4096):
            out[r["doc_id"], at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()), len(ids)] += 1
    return out


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    scores = quality.quality_scores(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = {r["doc_id"] for r in scores.where(F.col("score") >= quality.THRESHOLD).collect()}
    plain = {"quality": lambda rows: [r for r in rows if r["doc_id"] in good], "lines": plain_lines,
             "near-duplicates": plain_one_of_each, "mixing": plain_mixed}
    before = [r.asDict() for r in docs.collect()]
    count = lambda rows: collections.Counter(tuple(r.items()) for r in rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF_SMALL), f"t-plain-{name}")
        rows = [r.asDict() for r in docs.collect()]
        if name == "packing":
            assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == plain_pieces(before)
        else:
            want = plain[name](before)
            assert count(rows) == count(want), name
        before = rows
