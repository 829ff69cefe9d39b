"""Vectors and conversations: odd cases and brute force."""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logweave.llm import chat, lattice, topk
from logweave.llm.components import local_components

ODD = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [float("inf"), *[1.0] * 15]), (1005, [None, *[1.0] * 15]),
       (None, [1.0] * 16), (1006, [1.0, 2.0]), (1007, [1.0, 2.0]), (1008, [-2.0, -4.0])]


def _vectors(spark, x, first=0, odd=True):
    rows = [(first + k, [float(c) for c in v]) for k, v in enumerate(x)] + (ODD if odd else [])
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS dims", "3 AS n", "'x' AS label")


def _planted(rng, n=300, dims=16):
    x = rng.normal(size=(n, dims))
    x[50:60] = x[0] * np.linspace(1, 3, 10)[:, None]  # same direction
    x[60:70] = x[1]  # equal rows
    x[70:130] = x[2] + rng.normal(0, 0.02, (60, dims))  # a dense group
    for k in range(130, 150):  # a chain of links
        turn = rng.normal(size=dims)
        x[k] = x[k - 1] / np.linalg.norm(x[k - 1]) + 0.4 * turn / np.linalg.norm(turn)
    return x


def test_lattice_links(spark):
    x = _planted(np.random.default_rng(1))
    got = {}
    for r in lattice.near_duplicates(_vectors(spark, x)).collect():
        got[r["vec_id"]] = (r["n_links"], r["component_id"], r["kept"])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    root = local_components(len(x), *np.nonzero(near))
    found = sum(got[k][0] for k in range(len(x)))
    assert found <= near.sum() and found >= 0.9 * near.sum()
    same = [got[k][1] == root[k] for k in range(len(x))]
    assert np.mean(same) > 0.95
    assert all(got[k][0] <= near[k].sum() and got[k][2] == (got[k][1] == k) for k in range(len(x)))
    assert all(got[k][0] == near[k].sum() for k in range(50, 130))  # well above the threshold
    for k in range(1000, 1006):
        assert got[k] == (0, k, True)
    assert got[None] == (0, None, False) and got[1006] == (1, 1006, True) and got[1007] == (1, 1006, False) and got[1008] == (0, 1008, True)
    assert lattice.near_duplicates(_vectors(spark, x[:0], odd=False)).count() == 0


def test_lattice_blocks_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    x = _planted(np.random.default_rng(2))
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(_vectors(spark, x, odd=False)).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = (unit @ unit.T >= 0.9).sum(1) - 1
    assert all(got[k] == near[k] for k in range(50, 130))


def test_nearest_lattice_point():
    rng = np.random.default_rng(3)
    y = rng.normal(0, 2, (400, 8))
    point = lattice.decoded(y)
    whole = np.isclose(point, np.rint(point)).all(1)
    half = np.isclose(point + 0.5, np.rint(point + 0.5)).all(1)
    assert (whole | half).all() and np.isclose(point.sum(1) % 2, 0).all()
    off = ((y - point) ** 2).sum(1)
    assert (off <= 1 + 1e-9).all()  # the covering radius is 1
    for step in lattice.MINIMAL:
        assert (((y - point - step) ** 2).sum(1) >= off - 1e-9).all()


def test_recall_at_the_threshold():
    for n, dims in ((1000, 64), (1000, 8), (5_000_000, 64)):
        blocks, tables = lattice.tables_for(n, 0.9, dims)
        rng = np.random.default_rng(11)
        a = rng.normal(size=(1500, dims))
        a /= np.linalg.norm(a, axis=1)[:, None]
        b = rng.normal(size=a.shape)
        b -= (a * b).sum(1)[:, None] * a
        b = 0.9 * a + math.sqrt(0.19) * b / np.linalg.norm(b, axis=1)[:, None]
        met = np.zeros(len(a), bool)
        for t in range(tables):
            p, q = lattice.cells(a, t, blocks), lattice.cells(b, t, blocks)
            met |= (p == q[:, :1]).any(1) | (q == p[:, :1]).any(1)
        assert met.mean() >= 0.9


def _best(x, ids, k, every):
    v = np.floor(256 * x).astype(np.int64)
    out = []
    for q in sorted(set(ids)):
        if q % every == 0:
            rows = sorted((-int(v[ids.index(q)] @ v[j]), ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
            out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(rows)]
    return out


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x[40:80] = x[0]  # ties
    x[81:90] = 0
    got = topk.top_k(_vectors(spark, x, odd=False), F.col("vec_id") % 20 == 0).collect()
    assert sorted(tuple(r) for r in got) == _best(x, list(range(300)), 5, 20)


def test_topk_odd_rows(spark):
    rows = _vectors(spark, np.random.default_rng(5).normal(size=(3, 16)))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(rows, F.lit(True)).collect()}
    assert {q for q, _ in got} == {0, 1, 2, 1002, 1006, 1007, 1008}  # a zero vector is a vector here
    assert got[1006, 1] == (1007, 5 * 256 * 256) and got[1006, 2] == (1008, -10 * 256 * 256) and (1006, 3) not in got
    assert topk.top_k(rows.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(rows, F.lit(False)).count() == 0


def test_threshold_algorithm_stops_early():
    rng = np.random.default_rng(6)
    v = np.floor(rng.exponential(1, (4000, 4)) ** 3 * 50)
    lists = v.argsort(axis=0, kind="stable")
    values = np.take_along_axis(v, lists, 0)

    class Counting(np.ndarray):
        rows = 0

        def __getitem__(self, key):
            got = np.asarray(self)[key]
            Counting.rows += len(got) if np.ndim(got) == 2 else 0
            return got

    ids, scores = topk.best_of(lists, values, v.view(Counting), np.arange(4000), np.array([3.0, 1.0, 2.0, 1.0]), -1, 5)
    want = sorted((-s, k) for k, s in enumerate(v @ [3.0, 1.0, 2.0, 1.0]))[:5]
    assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == want and Counting.rows < 2000


SAID = ["Hello there, how are you", "Fine.\n\nAnd you? " + "blah " * 30 + "\nline", "", None, "a: not a marker?", "User is a word", "x " * 500]


def _conversations(spark, n=60):
    rows = []
    for c in range(n):
        turn = 0
        if c % 5 == 0:
            rows.append((c, turn, "system", "Be brief and kind at all times please."))
            turn = 1
        for t in range(1 + c % 6):
            rows.append((c, turn, "user", f"Question {c} {t} " + "word " * (c % 7)))
            rows.append((c, turn + 1, "assistant", f"Reply {c} {t}: " + "longer words here " * 25 + "\nmore of it\n" * (t % 3) + "end"))
            turn += 2
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS block", "'x' AS line", "2 AS key")


def test_roles_are_recovered(spark):
    talks = _conversations(spark)
    want, got = {}, {}
    for r in talks.orderBy("conv_id", "turn").collect():
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"].strip()))
    for r in chat.formatted_chats(talks).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert r["rendered"] == f"<|{r['role']}|>\n{r['text']}\n<|end|>"
    held = [c for c in want if zlib.crc32(str(c).encode()) % 4 == 0]
    assert held and np.mean([got[c] == want[c] for c in held]) >= 0.9


def test_blocks_give_the_same_path(spark, monkeypatch):
    parts = chat.raw_transcripts(_conversations(spark, 12)).withColumn("conv_id", F.lit(1).cast("long")).withColumn(
        "part", F.row_number().over(chat.Window.orderBy("text")))
    model = chat.fit(parts)
    whole = sorted(map(tuple, chat.turns(parts.drop("role"), model).collect()))
    monkeypatch.setattr(chat, "BLOCK", 5)
    assert sorted(map(tuple, chat.turns(parts.drop("role"), model).collect())) == whole


def test_a_long_part_spans_blocks_and_keeps_its_turns(spark, monkeypatch):
    parts = chat.raw_transcripts(_conversations(spark, 40))
    model = chat.fit(parts)
    long = "\n".join(f"line {k}" if k % 9 else "" for k in range(5001))
    rows = [(1, 0, "User: hi there"), (1, 1, f"Assistant: {long}"), (1, None, "System: be kind"), (1, 2, "User: done"), (1, 2, "User: done")]
    raw = spark.createDataFrame(rows, "conv_id long, part int, text string")
    whole = sorted(map(tuple, chat.turns(raw, model).collect()))
    monkeypatch.setattr(chat, "BLOCK", 64)
    assert chat.blocked(chat.lines_of(raw)).select("key").distinct().count() >= 5005 // 64
    assert sorted(map(tuple, chat.turns(raw, model).collect())) == whole
    for k in (1, 3, 5005, 5006):  # a block that ends with the transcript
        monkeypatch.setattr(chat, "BLOCK", k)
        assert sorted(map(tuple, chat.turns(raw.where("part IS NULL OR part <> 1 OR text = ''") if k < 9 else raw, model).collect()))
    assert [t[2] for t in whole][:3] == ["system", "user", "assistant"] and whole[2][3].startswith(long.strip())


def test_tool_turns_and_indentation_survive(spark):
    talks = _conversations(spark, 40).select("conv_id", "turn", "role", "text")
    more = [(c, t, r, x) for c in range(100, 140) for t, (r, x) in enumerate([("user", "please look it up"), ("tool", f"result {c}"), ("assistant", "    indented code\nmore")])]
    got = {}
    for r in chat.formatted_chats(talks.union(spark.createDataFrame(more, talks.schema))).where("conv_id >= 100").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    marked = [c for c in got if len(got[c]) == 3]
    assert len(marked) >= 25 and all([r for r, _ in got[c]] == ["user", "tool", "assistant"] for c in marked)
    assert any(got[c][2][1] == "    indented code\nmore" for c in marked)


def test_viterbi_is_the_best_of_all_paths():
    import itertools
    rng = np.random.default_rng(7)
    model = chat.Model(rng.random(chat.STATES * (1 + chat.STATES + chat.MARKERS + chat.GAPS + chat.LENGTHS)) * 5)
    features = np.stack([rng.integers(0, n, 4) for n in (chat.MARKERS, chat.GAPS, chat.LENGTHS)], 1)
    e = model.emitted(features)

    def score(p):
        return model.first[p[0]] + e[0, p[0]] + sum(model.after[a, b] + e[t + 1, b] for t, (a, b) in enumerate(itertools.pairwise(p)))

    best = max(itertools.product(range(chat.STATES), repeat=4), key=score)
    start, _ = model.through(e)
    assert int(start.argmax()) == best[-1] and np.isclose(start.max(), score(best))
    assert tuple(model.path(e, -1, best[-1])) == best


def test_chat_odd_rows(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(SAID)]
    rows += [(None, 0, "user", "no conversation"), (2, None, None, "no role"), (2, 1, "tool", "another role"), (3, 0, "user", "tie"), (3, 0, "user", "tie")]
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = chat.formatted_chats(talks).collect()
    assert {r["conv_id"] for r in got} == {None, 1, 2, 3} and all(r["text"] is not None for r in got)
    assert chat.formatted_chats(talks.limit(0)).count() == 0


def test_slices_bound_the_text():
    from logweave.llm.text import slices

    batch = pa.record_batch([pa.array(["x" * n for n in (3, 0, 9, 100, 1, 1, 1)] + [None])], ["text"])
    parts = list(slices([batch], max_bytes=10))
    assert sum(p.num_rows for p in parts) == 8 and pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 10 for p in parts)


def test_links_do_not_depend_on_the_size_of_a_group():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    exact = np.einsum("ij,ij->i", np.repeat(x, 400, 0), np.tile(x, (400, 1))).reshape(400, 400)
    product = x @ x.T
    odd = np.argwhere(exact != product)
    for i, j in odd[:: max(1, len(odd) // 20)]:  # thresholds that the two ways of adding up see differently
        if i == j:
            continue
        threshold = max(exact[i, j], product[i, j])
        pairs = np.concatenate([np.stack(p, 1) for p in lattice._close(x, np.zeros(400, int), np.arange(400), threshold)])
        want = np.argwhere((exact >= threshold) & ~np.eye(400, dtype=bool))
        assert sorted(map(tuple, pairs.tolist())) == sorted(map(tuple, want.tolist()))


def test_topk_blocks_of_long_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 16 * 10)  # ten rows of 16 components
    x = np.random.default_rng(10).normal(size=(60, 16))
    got = topk.top_k(_vectors(spark, x, odd=False), F.col("vec_id") % 4 == 0).collect()
    assert sorted(tuple(r) for r in got) == _best(x, list(range(60)), 5, 4)
