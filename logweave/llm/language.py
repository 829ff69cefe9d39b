"""Language identification by a byte convolutional network.

Texts are bytes (A-Z lower-cased) in a small learned alphabet. Filters of several
widths slide over windows of fixed length; each filter's maximum in the window,
rectified, goes into a softmax over the languages. The network is trained in
numpy, in one task, on one window of each text of a bounded sample
(``SAMPLE`` texts, evenly over the languages, chosen by a hash of the id).
Prediction covers every window of every text: log probabilities are averaged by
the bytes in a window. For speed the trained layers are folded into tables by
pairs of bytes, so that a filter of width four is a sum of two rows.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so
is every text when nothing can be learned. Texts to learn from need a language
and a letter. With one language its score is 1. Repeated rows are predicted row
by row; ties go to the language that is first by name. Extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.storage import remainder, staged
from logweave.llm.text import ascii_lower, slices, text_bytes

UNDETERMINED = "und"
#: Texts to learn from, bytes in a window, distinct byte classes (0 pads, 1 is any other byte).
SAMPLE, WINDOW, CLASSES = 3200, 256, 64
WIDTHS, FILTERS, DIMENSIONS = (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE = 12, 32, 0.01
SALT = "language sample"
LETTER = r"\p{L}"
#: Windows that are computed at once.
BLOCK = 256


@dataclass(frozen=True)
class Network:
    """Languages, the class of each byte, folded filter tables and the softmax layer."""

    languages: list[str]
    kind: np.ndarray
    tables: dict[str, np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def log_probabilities(self, window: np.ndarray) -> np.ndarray:
        """One row for each window (rows of byte classes)."""
        t = self.tables
        pair = window[:, :-1].astype(np.int32) * CLASSES + window[:, 1:]
        two = t["2"][pair].max(1)
        three = (t["3a"][pair[:, :-1]] + t["3b"][window[:, 2:]]).max(1)
        four = (t["4a"][pair[:, :-2]] + t["4b"][pair[:, 2:]]).max(1)
        held = np.maximum(np.concatenate([two, three, four], 1), 0)
        logit = held @ self.out + self.bias
        logit -= logit.max(1, keepdims=True)
        return logit - np.log(np.exp(logit).sum(1, keepdims=True))

    def predict(self, column: pa.Array) -> np.ndarray:
        """Probabilities of the languages for each text, over all of its windows."""
        raw, begins = text_bytes(column)
        kinds = self.kind[ascii_lower(raw)]
        size = np.diff(begins)
        count = np.maximum(1, -(-size // WINDOW))
        owner = np.repeat(np.arange(len(size)), count)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
        held = np.minimum(WINDOW, size[owner] - start)
        total = np.zeros((len(size), len(self.languages)))
        padded = np.concatenate([kinds, np.zeros(WINDOW, kinds.dtype)])
        for at in range(0, len(owner), BLOCK):
            part = slice(at, at + BLOCK)
            place = (begins[owner[part]] + start[part])[:, None] + np.arange(WINDOW)
            window = np.where(np.arange(WINDOW) < held[part, None], padded[place], 0)
            np.add.at(total, owner[part], self.log_probabilities(window) * held[part, None])
        total /= np.maximum(size, 1)[:, None]
        chance = np.exp(total - total.max(1, keepdims=True))
        return chance / chance.sum(1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Fit the network on one window of each text, by Adam on the cross-entropy."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    raw = [np.frombuffer(t[:WINDOW], np.uint8) for t in texts]
    seen = np.bincount(ascii_lower(np.concatenate(raw)), minlength=256)
    kind = np.ones(256, np.uint8)
    common = np.argsort(-seen, kind="stable")[:CLASSES - 2]
    kind[common] = np.arange(2, 2 + len(common))
    x = np.zeros((len(raw), WINDOW), np.int64)
    for i, r in enumerate(raw):
        x[i, :len(r)] = kind[ascii_lower(r)]
    y = np.searchsorted(languages, labels)
    p = {"e": rng.normal(0, 0.5, (CLASSES, DIMENSIONS)), "v": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages))), "c": np.zeros(len(languages))}
    for w in WIDTHS:
        p[f"w{w}"] = rng.normal(0, 1 / math.sqrt(DIMENSIONS * w), (w * DIMENSIONS, FILTERS))
        p[f"b{w}"] = np.zeros(FILTERS)
    moment, spread, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            grad = _gradients(p, x[rows], y[rows])
            step += 1
            for k, g in grad.items():
                moment[k] = 0.9 * moment[k] + 0.1 * g
                spread[k] = 0.999 * spread[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-8)
    one = {w: [p["e"] @ p[f"w{w}"][k * DIMENSIONS:(k + 1) * DIMENSIONS] for k in range(w)] for w in WIDTHS}
    pairs = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(CLASSES * CLASSES, FILTERS)
    tables = {"2": pairs(one[2][0] + p["b2"], one[2][1]), "3a": pairs(one[3][0] + p["b3"], one[3][1]), "3b": one[3][2],
              "4a": pairs(one[4][0] + p["b4"], one[4][1]), "4b": pairs(one[4][2], one[4][3])}
    return Network(languages, kind, {k: v.astype(np.float32) for k, v in tables.items()}, p["v"].astype(np.float32), p["c"].astype(np.float32))


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    n = len(x)
    rows, each = np.arange(n)[:, None], np.arange(FILTERS)
    e = p["e"][x]
    peaks, held = {}, []
    for w in WIDTHS:
        seen = np.concatenate([e[:, k:WINDOW - w + 1 + k] for k in range(w)], 2)
        level = seen @ p[f"w{w}"] + p[f"b{w}"]
        peak = level.argmax(1)
        peaks[w] = (peak, seen[rows, peak])
        held.append(level[rows, peak, each])
    top = np.concatenate(held, 1)
    h = np.maximum(top, 0)
    logit = h @ p["v"] + p["c"]
    chance = np.exp(logit - logit.max(1, keepdims=True))
    chance /= chance.sum(1, keepdims=True)
    chance[np.arange(n), y] -= 1
    off = chance / n
    grad = {"v": h.T @ off, "c": off.sum(0), "e": np.zeros_like(p["e"])}
    back = (off @ p["v"].T) * (top > 0)
    for i, w in enumerate(WIDTHS):
        peak, seen = peaks[w]
        b = back[:, i * FILTERS:(i + 1) * FILTERS]
        grad[f"w{w}"] = (b[:, :, None] * seen).sum(0).T
        grad[f"b{w}"] = b.sum(0)
        inner = b[:, :, None] * p[f"w{w}"].T
        for k in range(w):
            np.add.at(grad["e"], x[rows, peak + k], inner[:, :, k * DIMENSIONS:(k + 1) * DIMENSIONS])
    return grad


def fit(docs: DataFrame, learn, sample: int = SAMPLE) -> Network | None:
    """The network learned from rows (doc_id, text, lang) for which ``learn`` holds; None if there are none."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER) & learn)
    # no more languages than texts to learn from: the most frequent
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(sample)
    languages = sizes.count()
    if not languages:
        return None
    # a share of each language's rows, by a hash of the id; one window of each at a place given by that hash
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(max(1, sample // languages)) / F.col("n")).alias("share"))
    key = F.pmod(F.xxhash64(F.lit(SALT), "doc_id"), F.lit(1 << 40))
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1).cast("long"), F.length("text") - WINDOW + 1)) + 1
    chosen = known.join(F.broadcast(share), "lang").where(key < F.col("share") * (1 << 40))
    windows = staged(chosen.select("doc_id", "lang", F.substr("text", place.cast("int"), F.lit(WINDOW)).alias("window")), "language-sample")

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["doc_id"], r["lang"], r["window"]) for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        if rows:
            network = train([r[2].encode() for r in rows], [r[1] for r in rows])
            yield pa.record_batch([pa.array([pickle.dumps(network)], pa.binary())], ["network"])

    got = windows.coalesce(1).mapInArrow(learned, "network binary").collect()
    return pickle.loads(got[0]["network"]) if got else None


def predicted(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    pair = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = pair.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            text = part.column("text")
            lang = np.full(part.num_rows, UNDETERMINED, object)
            score = np.zeros(part.num_rows)
            if network:
                chance = network.predict(text)
                real = pc.fill_null(pc.match_substring_regex(text, LETTER), False).to_numpy(zero_copy_only=False)
                best = chance.argmax(1)
                lang = np.where(real, np.array(network.languages, object)[best], UNDETERMINED)
                score = np.where(real, chance[np.arange(len(best)), best], 0.0)
            yield pa.record_batch([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return pair.mapInArrow(of, f"doc_id {kind}, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    network = fit(docs, remainder("doc_id", 4) != 2)
    return predicted(docs, network).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score")
