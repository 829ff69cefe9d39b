"""BPE, fill-in-middle and Merkle manifest against plain versions."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logweave.llm import bpe, manifest, mixing, packing, rotation, simhash, topk
from tests.llm.helpers import LONG, ROWS, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Letters of many scripts, marks, blanks, contractions, an added token, and letters that only newer Unicode tables know.
POOL = [*"  \n\t'sabcdefe013<|", "<|endoftext|>", "'ll", " " * 5, "é", "é", "՘", "࢏", "\U00010940", "\x1c", "\x85", "​", "　", "\U0001f600", "日", "ß", "²"]


def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library():
    r = random.Random(11)
    texts = ["".join(r.choice(POOL) for _ in range(r.randrange(40))) for _ in range(5000)]
    texts += ["".join(chr(r.choice([r.randrange(32, 0xD800), r.randrange(0xE000, 0x11000)])) for _ in range(30)) for _ in range(2000)]
    # long words take the other way through the rank array
    texts += ["a" * 100_001, "ab" * 40_000, "".join(r.choice("etaoinshr") for _ in range(50_000)), " " * 5000, "é" * 3000, LONG, "",
              *("".join(r.choice("abcdeth") for _ in range(n)) for n in range(60, 70))]
    own, t = bpe.tokenizer(PATH), library()
    for text, ids, want in zip(texts, own.encode(texts), t.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == want.ids, text
        assert own.decode(ids) == text
    some = [50_256, 195, 220, 99_999_999, 64, 255]  # broken bytes, an added token, an id that isn't there
    assert own.decode(np.array(some, np.uint32)) == t.decode(some, skip_special_tokens=False)


def test_bpe_memo_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 50)
    monkeypatch.setattr(bpe, "STEP", 20)
    own, t = bpe.Bpe(PATH), library()
    texts = [" ".join(f"w{k * j}" for k in range(9)) + " " + "x" * j for j in range(90)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
        assert got == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] and len(own.memo) < 1000


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {"dropout": 0.1}}, {"merges": "turned"}])
def test_bpe_refuses_other_files(tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    if "merges" in change:
        spec["model"]["merges"].reverse()
    elif "model" in change:
        spec["model"] |= change["model"]
    else:
        spec |= change
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Bpe(str(tmp_path / "t.json"))


def test_bpe_frames(spark):
    docs = documents(spark).selectExpr("*", "1 AS ids", "'z' AS IDS_sha256").repartition(3)
    want = {k: v for k, v in enumerate(r[1] or "" for r in ROWS)}
    t = library()
    for as_array in (False, True):
        rows = bpe.encoded(docs, PATH, as_array=as_array)
        assert [c.lower() for c in rows.columns].count("ids") == 1 and "mix_key" in rows.columns
        back = bpe.decoded(rows.withColumnRenamed("text", "before"), PATH).collect()
        assert len(back) == len(ROWS)
        for r in back:
            ids = r["ids"] if as_array else np.frombuffer(r["ids"], "<u4").tolist()
            assert r["text"] == (r["before"] or "") and ids == t.encode(r["text"], add_special_tokens=False).ids
    assert sorted(want.values()) == sorted(r["text"] for r in back)
    got = sorted(tuple(r) for r in bpe.round_trip_digests(docs, PATH).collect() if r["doc_id"] is not None)
    plain = []
    for doc_id, text, *_ in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        plain.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(p for p in plain if p[0] is not None)
    assert bpe.round_trip_digests(docs.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids binary")
    assert bpe.decoded(nothing, PATH).first()["text"] == ""


UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_fim_equals_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(rotation, "STEP", 7)
    r = random.Random(3)
    pool = [*"ab Z9\n<>PSM", "é", "日", "\U0001f600", "é", "word", "<S", "<<"]
    rows = ROWS + [(100 + k, "".join(r.choice(pool) for _ in range(r.randrange(30))), None, None, None) for k in range(600)]
    rows += [(1000, "a <P> b", None, None, None), (1001, "a <S", None, None, None), (1002, "<M>", None, None, None), (1003, "x" * 300_000 + " y" * 9, None, None, None)]
    docs = documents(spark, rows).selectExpr("*", "1 AS n", "2 AS output", "3 AS restored", "4 AS drawn").repartition(3)
    moved = rotation.transformed(docs)
    got = {}
    for x in rotation.restored(moved).collect():
        got.setdefault(x["doc_id"], []).append((x["n"], x["form"], x["output"], x["prefix_chars"], x["middle_chars"], x["restored"]))
    want = {}
    for doc_id, text, *_ in rows:
        want.setdefault(doc_id, []).append((*plain_fim(doc_id, text), text or ""))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    assert {f for v in want.values() for _, f, *_ in v} == {"plain", "psm", "spm"}
    digests = {x["doc_id"]: x for x in rotation.fim_digests(docs).collect()}
    assert digests[1003]["restored_sha256"] == hashlib.sha256(("x" * 300_000 + " y" * 9).encode()).hexdigest()
    assert rotation.fim_digests(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé<>PSM \n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
def test_rotations_turn_back(text, a, b, form):
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    cuts = [len(text[:k].encode()) for k in (a, b)]
    buffer = bytearray(text.encode())
    rotation.arrange(buffer, *cuts, form)
    p, m, s = text[:a], text[a:b], text[b:]
    assert buffer.decode() == (f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}")
    rotation.restore(buffer, form)
    assert buffer.decode() == text


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(hashes):
    """(top, for each leaf its steps of digests left and right)"""
    steps, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for k, place in enumerate(at):
            run = place // 3 * 3
            steps[k].append(("".join(level[run:place]), "".join(level[place + 1:run + 3])))
            at[k] = place // 3
        level = [H(*level[k:k + 3]) for k in range(0, len(level), 3)]
    return level[0], steps


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_manifest(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    kept, tops = [], []
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
        hashes = [plain_leaf(r, r[1]) for r in own]
        top, steps = plain_tree(hashes)
        tops.append(top)
        kept.append((own, hashes, steps))
    root, up = plain_tree(tops)
    out = []
    for (own, hashes, steps), top, above in zip(kept, tops, up, strict=True):
        for r, leaf, below in zip(own, hashes, steps, strict=True):
            path = below + above
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            fold = plain_leaf(r, r[1].replace("\n", "")) if tampered else leaf
            for left, right in path:
                fold = H(left, fold, right)
            out.append((r[0], leaf, top, root, H(*(a + b for a, b in path)), fold, fold == root))
    return out


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_manifest_equals_a_plain_version(spark, monkeypatch, digits):
    monkeypatch.setattr(manifest, "DIGITS", digits)
    rows = ROWS + [(100 + k, f"line\n{k}" if k % 3 else None, "en", f"s{k % 7 if k % 4 else 0}é", k) for k in range(75)]
    rows += [(7, "line\none", None, None, 1), (None, "a\nb", "en", "a", 3), (8, "x\n", "q", "c", 2)]
    docs = documents(spark, rows).selectExpr("*", "1 AS tree", "2 AS rank", "3 AS node", "4 AS hash", "5 AS depth").repartition(5)
    got = sorted((tuple(r) for r in manifest.manifest(docs).collect()), key=str)
    want = sorted(plain_manifest(rows), key=str)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_little(spark):
    assert manifest.manifest(documents(spark).limit(0)).count() == 0
    one = manifest.manifest(documents(spark, [(4, "t", None, None, 1)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == H("")


# --- ids, survivors, keys and queries that depend on nothing but the rows -----

def test_packing_ids_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    r = random.Random(8)
    marks = [chr(c) for c in (*range(0x300, 0x370), 0x1DC0, 0x20D0, 0x3099)]
    pool = [*"AbcTJHWYKzZ0<=>!.,'  \n", "É", "ß", "İ", "Σ", "ǅ", "ﬁ", "日", "'S", "<|endoftext|>"]
    texts = [c + m + "x" for c in map(chr, range(65, 91)) for m in marks] + [f"{c}{m}" for c in "<=>!~aA" for m in marks]
    texts += ["".join(r.choice(pool if r.random() < 0.8 else marks) for _ in range(r.randrange(1, 12))) for _ in range(30_000)]
    ids, first = packing.ids_of(pa.array(texts), path, packing.Memo())
    for k, e in enumerate(t.encode_batch(texts, add_special_tokens=False)):
        assert ids[first[k]:first[k + 1]].tolist() == [*e.ids, packing.END], texts[k]
    with pytest.raises(ValueError):
        packing._tokenizer(PATH)


def test_survivors_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, f"a b c d e{' ' * k}", "en", f"s{k}", k) for k in range(6)] + [(2, "a b c d e", "en", "s", 1)] * 2
    rows += [(None, "x y z", "en", "s", 1)] * 2 + [(None, "x y z", "en", "t", 1), (7, "q r s t", "en", "s", 1), (None, "q r s t", "en", "s", 1)]
    docs = documents(spark, rows)
    got = [sorted(map(tuple, simhash.one_of_each(docs.repartition(n)).collect()), key=str) for n in (1, 4, 7)]
    assert got[0] == got[1] == got[2]
    assert sorted((r[0] or -1) for r in got[0]) == [-1, -1, -1, 1, 7]  # groups without any id stay whole


def test_mix_ranges_hold_rows_without_id(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    docs = documents(spark, [(None if k % 2 else 5, f"text {k}", "en", "a", 1) for k in range(2000)])
    sized = docs.select(mixing.mix_key(F.col("doc_id"), F.col("text")).alias("key"))
    sizes = [r["count"] for r in sized.groupBy(mixing._range(F.col("key"), 40).alias("r")).count().collect()]
    assert len(sizes) == 40 and max(sizes) < 120
    assert mixing.source_mix(docs).count() == 2000 and mixing.mixed(docs).columns == docs.columns


def test_repeated_queries_and_large_components(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.9, 0.0]), (4, [0.2, 0.0]), (5, [0.1, 0.0]), (6, [0.0, 1.0])],
                                 "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"]) for r in topk.top_k(rows, F.col("vec_id") == 1, 5).collect()]
    assert sorted(got) == sorted(2 * [(1, 1), (2, 3), (3, 2), (4, 4), (5, 5)])
    with pytest.raises(Exception, match="beyond a long"):
        topk.top_k(rows.union(spark.createDataFrame([(9, [1e16, 0.0])], rows.schema)), F.col("vec_id") == 1).collect()
