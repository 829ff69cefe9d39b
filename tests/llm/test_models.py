"""The two classifiers against plain versions: statistics, moments and densities; convolutions and softmax."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from logweave.llm import language, quality
from tests.llm.helpers import ROWS, documents

MARKS = b"#$%&*@^~<>{}[]=+_\\`"


def plain_statistics(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    count = lambda keep: sum(map(bool, map(keep, raw)))
    upper, lower = count(lambda b: 65 <= b <= 90), count(lambda b: 97 <= b <= 122)
    digit, wide, lines = count(lambda b: 48 <= b <= 57), count(lambda b: b >= 128), raw.count(b"\n")
    bang, bar, symbol = raw.count(b"!"), raw.count(b"|"), count(lambda b: b in MARKS)
    space = count(lambda b: b in (32, 9, 11, 12, 13))
    other = len(raw) - upper - lower - digit - wide - lines - bang - bar - symbol - space
    n, letters = max(1, len(words)), max(1, upper + lower + wide)
    root = lambda a, b: math.sqrt(a / b)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    longest = max((len(x) for x in re.findall(rb"[^\n]*\n|[^\n]+", raw)), default=0)
    return [math.log1p(len(words)), math.log1p((len(raw) - space - lines) / n), root(upper, letters), root(digit, n), root(bang, n), root(bar, n),
            root(symbol, n), root(other, n), root(wide, letters), root(lines, n), root(again, n), len(set(words)) / n, math.log1p(longest)]


def test_quality_equals_a_plain_discriminant(spark):
    rng = np.random.default_rng(4)
    rows = list(ROWS[:-2])
    for k in range(100, 300):
        good = k % 2
        words = rng.choice(["alpha", "Beta", "gamma", "so", "much|more", "x!!", "é", "12", "#tag"], 30 + int(rng.integers(40)), p=[.2, .2, .2, .2, .05, .05, .04, .03, .03] if good else None)
        rows.append((k, " ".join(words) + "\n" * int(rng.integers(3)) + ("" if good else "$$$ " * int(rng.integers(9)) + "so so so"), "en", "s", 1))
    labels = [(k, k % 2, 0) for k in range(100, 300)] + [(150, 0, 1), (9999, 1, 0), (None, 1, 0)]
    got = sorted((r["doc_id"], r["score"], r["held_out"], r["predicted"]) for r in quality.quality_scores(
        documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())
    table = [(r[0], np.array(plain_statistics(r[1]))) for r in rows]
    assert np.allclose(quality.statistics(pa.array([r[1] for r in rows])), [x for _, x in table], atol=1e-12)
    learn = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 0
    known = [(y, x) for i, x in table for j, y, _ in labels if i == j and learn(i)]
    by = {y: np.array([x for z, x in known if z == y]) for y in (0, 1)}
    cov = {y: np.cov(x.T, bias=True) for y, x in by.items()}
    pooled = sum(len(by[y]) * cov[y] for y in by) / len(known)
    pooled = 0.8 * pooled + 0.2 * np.diag(np.diag(pooled))

    def density(y, x):
        c = 0.9 * cov[y] + 0.1 * pooled + 1e-4 * np.eye(len(x))
        off = x - by[y].mean(0)
        return math.log(len(by[y]) / len(known)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * off @ np.linalg.solve(c, off)

    want = []
    for i, x in table:
        score = 1 / (1 + math.exp(min(700, density(0, x) - density(1, x))))
        want.append((i, score, not learn(i), int(score >= 0.3)))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1], abs=1e-6) and g[2:] == w[2:]


def test_language_network_equals_plain_convolutions(monkeypatch):
    seen = {}

    def kept(p, x, y, inner=language._gradients):
        seen["p"] = p  # training changes this dictionary in place, up to the last step
        return inner(p, x, y)

    monkeypatch.setattr(language, "_gradients", kept)
    monkeypatch.setattr(language, "EPOCHS", 3)
    rng = np.random.default_rng(1)
    say = lambda of, n: " ".join(rng.choice(of, n))
    texts = [say(["the", "cat", "Sat", "on", "mats"] if k % 2 else ["die", "Katze", "saß", "auf", "Matten"], 12) for k in range(60)]
    network = language.train([t.encode() for t in texts], ["en" if k % 2 else "de" for k in range(60)])
    p, width = seen["p"], language.WINDOW
    odd = [*texts[:6], "x", "ü" * 300, "The cat " * 90, "die Katze"]
    got = network.predict(pa.array(odd))
    for text, chance in zip(odd, got, strict=True):
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        total = np.zeros(2)
        for at in range(0, max(1, len(raw)), width):
            part = raw[at:at + width]
            kinds = [int(network.kind[b]) for b in part] + [0] * (width - len(part))
            e = p["e"][kinds]
            held = []
            for w in language.WIDTHS:
                levels = [e[k:k + w].ravel() @ p[f"w{w}"] + p[f"b{w}"] for k in range(width - w + 1)]
                held.append(np.maximum(np.max(levels, 0), 0))
            logit = np.concatenate(held) @ p["v"] + p["c"]
            total += len(part) * (logit - logit.max() - math.log(np.exp(logit - logit.max()).sum()))
        total /= max(1, len(raw))
        plain = np.exp(total - total.max())
        assert chance == pytest.approx(plain / plain.sum(), abs=1e-4)


def test_language_gradients_equal_finite_differences():
    rng = np.random.default_rng(2)
    p = {"e": rng.normal(0, 0.5, (language.CLASSES, language.DIMENSIONS)), "v": rng.normal(0, 0.2, (len(language.WIDTHS) * language.FILTERS, 3)), "c": np.zeros(3)}
    for w in language.WIDTHS:
        p[f"w{w}"], p[f"b{w}"] = rng.normal(0, 0.3, (w * language.DIMENSIONS, language.FILTERS)), np.zeros(language.FILTERS)
    x, y = rng.integers(0, language.CLASSES, (4, language.WINDOW)), np.array([0, 1, 2, 1])

    def loss():
        held = []
        for w in language.WIDTHS:
            e = p["e"][x]
            levels = [e[:, k:k + w].reshape(len(x), -1) @ p[f"w{w}"] + p[f"b{w}"] for k in range(language.WINDOW - w + 1)]
            held.append(np.maximum(np.max(levels, 0), 0))
        logit = np.concatenate(held, 1) @ p["v"] + p["c"]
        return float(np.mean(np.log(np.exp(logit).sum(1)) - logit[np.arange(len(x)), y]))

    grad = language._gradients(p, x, y)
    for name, value in p.items():
        for place in rng.integers(0, value.size, 4):
            old, step = value.flat[place], 1e-6
            value.flat[place] = old + step
            up = loss()
            value.flat[place] = old - step
            down = loss()
            value.flat[place] = old
            assert grad[name].flat[place] == pytest.approx((up - down) / (2 * step), abs=1e-5), name
