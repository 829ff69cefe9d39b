"""Chat formatting: transcripts are parsed by a hidden Markov model, and turns rendered one way.

A raw transcript is lines. A line's features are the kind of speaker marker it
begins with (if any), whether a blank line or nothing stands before it, and its
length class. Hidden states are role and whether the line begins a turn or goes
on with one. Transitions and emissions are counts over labelled lines; Viterbi
finds the best states. Each turn is rendered as a role line, its text without
marker and outer blank lines (the first line keeps its indentation), and an end
line.

All lines are range-sorted, and counts of each range's lines give every line its
number in its transcript. Transcripts are cut into blocks of ``BLOCK`` lines,
wherever their parts begin; a block also gets the last line before it, so no
feature depends on where blocks fall. A block is first summed
up as the best score from each state before it to each state at its end (72
numbers); these sums give the states at all borders; then each block is decoded
between its borders. So no task holds more lines of one transcript than a block.

Defined cases: a null text is an empty line; turns without any text are kept with
empty text. Null ids are one transcript, null parts come first; parts with equal
numbers are in order of their text, and repeated parts follow one another. Roles
outside the known ones, null too, count as the last one, ``tool``. Without labelled
lines all states are equally likely. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.storage import staged

ROLES = ("system", "user", "assistant", "tool")
BLOCK, TASK_LINES = 4096, 20_000
#: State 2*role begins a turn, 2*role+1 goes on with it.
STATES = 2 * len(ROLES)
MARKERS, GAPS, LENGTHS = 1 + len(ROLES), 2, 6
#: Names that stand for a role in a speaker marker.
NAMES = (("system", "instructions", "context"), ("user", "human", "question", "q"), ("assistant", "ai", "bot", "answer", "a"),
         ("tool", "function", "observation"))
MARK = r"^\s*(?:#+\s*({names})\s*:?|<\|?({names})\|?>|\[({names})\]|({names})\s*:)\s*(?=\s|$)"
PATTERNS = [f"(?i){MARK.format(names='|'.join(n))}" for n in NAMES]
ANY = f"(?i){MARK.format(names='|'.join(sum(NAMES, ())))}"


def _role(column: str = "role"):
    """A role's number; all that aren't known are the last."""
    return F.coalesce(*(F.when(F.col(column) == r, F.lit(i)) for i, r in enumerate(ROLES)), F.lit(len(ROLES) - 1))


def lines_of(parts: DataFrame, labelled: bool = False) -> DataFrame:
    """Every line of (conv_id, part, text[, role]) with its number in the transcript, marker and length class.

    A written table, sorted by transcript and line: at is a line's place in its range of the sort.
    """
    text = F.coalesce("text", F.lit(""))
    role = _role() if labelled else F.lit(-1)
    rows = parts.select("conv_id", F.coalesce("part", F.lit(-1)).cast("long").alias("part"), F.xxhash64(text).alias("tie"), role.alias("role"),
                        F.monotonically_increasing_id().alias("copy"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    marker = F.lit(0)
    for i, p in enumerate(PATTERNS):
        marker = F.when(F.col("line").rlike(p), F.lit(i + 1)).otherwise(marker)
    size = F.length("line")
    length = F.when(size == 0, 0).when(size < 20, 1).when(size < 80, 2).when(size < 240, 3).when(size < 700, 4).otherwise(5)
    rows = rows.select("conv_id", F.xxhash64("conv_id").alias("conv"), "part", "tie", "copy", "pos", "role", marker.alias("marker"), length.alias("length"), "line")
    order = rows.orderBy("conv", "part", "tie", "copy", "pos").withColumn("at", F.monotonically_increasing_id())
    table = staged(order.select("conv_id", "conv", "pos", "role", "marker", "length", "line", "at"), "chat-sorted")
    spread = F.shiftright("at", 33)
    runs = table.groupBy("conv", spread.alias("part")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of the sort
    runs = runs.select("conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return table.withColumn("part", spread).join(runs, ["conv", "part"]).withColumn("number", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocked(lines: DataFrame) -> DataFrame:
    """Lines by block: block, its key and own; a block's last line comes in the next one too, where it isn't own."""
    block = F.expr(f"number DIV {BLOCK}")
    last = (F.col("number") + 1) % BLOCK == 0
    both = F.when(last, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = lines.withColumn("block", F.explode(both)).withColumn("own", F.col("block") == block)
    return dealt.withColumn("key", F.xxhash64("conv", "block"))


def _sequences(table: pa.Table, key: str, order: list[str]) -> Iterator[pa.Table]:
    """The table's sequences: rows of one key, in order."""
    table = table.sort_by([(c, "ascending") for c in (key, *order)])
    keys = table.column(key).to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]]) if len(keys) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield table.slice(a, b - a)


PLACE = ["number"]


def _features(lines: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """A block's own lines, and marker, gap and length class of each."""
    length, own = lines.column("length").to_numpy(), lines.column("own").to_numpy()
    gap = np.concatenate([[1], (length[:-1] == 0).astype(int)])
    features = np.stack([lines.column("marker").to_numpy(), gap, length], 1)
    return (lines, features) if own[0] else (lines.slice(1), features[1:])


def _tasks(rows: DataFrame, key: str, total: int, size: int = TASK_LINES):
    return rows.groupBy(F.pmod(F.col(key), F.lit(max(1, math.ceil(total / size))).cast("long")).alias("task"))


class Model:
    """Log probabilities: of the first state, of the next one, and of each feature by state."""

    def __init__(self, counts: np.ndarray) -> None:
        first, after, *seen = np.split(counts + 0.1, np.cumsum([STATES, STATES * STATES, *(STATES * n for n in (MARKERS, GAPS))]))
        first[1::2] = 1e-9  # a transcript begins with a turn
        after = after.reshape(STATES, STATES)
        for s in range(STATES):  # a turn goes on in its own role only
            others = [2 * r + 1 for r in range(len(ROLES)) if r != s // 2]
            after[s, others] = 1e-9
        self.first = np.log(first / first.sum())
        self.after = np.log(after / after.sum(1, keepdims=True))
        self.seen = [np.log(x / x.sum(1, keepdims=True)) for x in (x.reshape(STATES, -1) for x in seen)]

    def emitted(self, features: np.ndarray) -> np.ndarray:
        return sum(table[:, features[:, k]].T for k, table in enumerate(self.seen))

    def through(self, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores at the end: from the beginning of a transcript, and from each state before the block."""
        start = (self.first + emitted[0])[None]
        best = np.concatenate([start, self.after + emitted[0]])
        for e in emitted[1:]:
            best = (best[:, :, None] + self.after).max(1) + e
        return best[0], best[1:]

    def path(self, emitted: np.ndarray, entry: int, leave: int) -> np.ndarray:
        """The best states of a block between the state before it (-1: none) and its last."""
        best = (self.first if entry < 0 else self.after[entry]) + emitted[0]
        back = np.zeros(emitted.shape, int)
        for t in range(1, len(emitted)):
            ways = best[:, None] + self.after
            back[t] = ways.argmax(0)
            best = ways.max(0) + emitted[t]
        states = np.zeros(len(emitted), int)
        states[-1] = leave
        for t in range(len(emitted) - 1, 0, -1):
            states[t - 1] = back[t, states[t]]
        return states


def fit(labelled: DataFrame) -> Model:
    """Counts over all labelled lines; the first line of a part begins its turn."""
    width = STATES + STATES * STATES + STATES * (MARKERS + GAPS + LENGTHS)
    rows = staged(blocked(lines_of(labelled, labelled=True).drop("line", "conv_id")), "chat-labelled")

    def counted(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for lines in _sequences(table, "key", PLACE):
            state = 2 * lines.column("role").to_numpy() + (lines.column("pos").to_numpy() > 0)
            if lines.column("number")[0].as_py() == 0:
                total[state[0]] += 1
            np.add.at(total, STATES + state[:-1] * STATES + state[1:], 1)
            _, x = _features(lines)
            state = state[len(state) - len(x):]
            at = STATES + STATES * STATES
            for k, n in enumerate((MARKERS, GAPS, LENGTHS)):
                np.add.at(total, at + state * n + x[:, k], 1)
                at += STATES * n
        return pa.table({"place": np.arange(width), "n": total})

    sums = _tasks(rows, "key", rows.count()).applyInArrow(counted, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(width)
    for r in sums:
        counts[r["place"]] = r["n"]
    return Model(counts)


def _borders(lines: DataFrame, total: int, model: Model) -> DataFrame:
    """For each block: the state before it (-1 at a transcript's beginning) and its last state."""
    def summed(table: pa.Table) -> pa.Table:
        rows = []
        for part in _sequences(table, "key", PLACE):
            own, features = _features(part)
            if not own.num_rows:  # nothing follows the last full block
                continue
            start, ways = model.through(model.emitted(features))
            rows.append((part.column("key")[0].as_py(), part.column("conv")[0].as_py(), part.column("block")[0].as_py(), np.concatenate([start, ways.ravel()]).tolist()))
        return pa.table({c: pa.array(x, t) for c, x, t in zip(("key", "conv", "block", "best"), zip(*rows, strict=True) if rows else ([],) * 4, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64())), strict=True)})

    def joined(table: pa.Table) -> pa.Table:
        out = []
        for blocks in _sequences(table, "conv", ["block"]):
            best = np.array(blocks.column("best").to_pylist())
            reached, came = best[0, :STATES], []
            for b in best[1:]:
                ways = reached[:, None] + b[STATES:].reshape(STATES, STATES)
                came.append(ways.argmax(0))
                reached = ways.max(0)
            leave = [int(reached.argmax())]
            for c in reversed(came):
                leave.append(int(c[leave[-1]]))
            leave = leave[::-1]
            out += zip(blocks.column("key").to_pylist(), [-1, *leave[:-1]], leave, strict=True)
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("key", "entry", "leave"), zip(*out, strict=True), strict=True)})

    sums = staged(_tasks(lines.drop("line"), "key", total).applyInArrow(summed, "key long, conv long, block long, best array<double>"), "chat-blocks")
    return _tasks(sums, "conv", sums.count(), 2000).applyInArrow(joined, "key long, entry long, leave long")


def turns(parts: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, role, text and rendered of every turn found in raw transcripts (conv_id, part, text)."""
    lines = staged(blocked(lines_of(parts)), "chat-lines")
    total = lines.count()
    bordered = lines.join(_borders(lines, total, model), "key")
    kind = lines.schema["conv_id"].dataType.simpleString()

    def decoded(table: pa.Table) -> pa.Table:
        out = []
        for part in _sequences(table, "key", PLACE):
            part, features = _features(part)
            states = model.path(model.emitted(features), part.column("entry")[0].as_py(), part.column("leave")[0].as_py())
            n = len(states)
            out.append(pa.table({"conv_id": part.column("conv_id"), "block": part.column("block"), "nth": np.arange(n),
                                 "role": pa.array(np.array(ROLES, object)[states // 2], pa.string()), "begins": np.cumsum(states % 2 == 0),
                                 "line": part.column("line"), "first": states % 2 == 0}))
        return pa.concat_tables(out)

    found = staged(_tasks(bordered, "key", total).applyInArrow(
        decoded, f"conv_id {kind}, block long, nth long, role string, begins long, line string, first boolean"), "chat-decoded")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.groupBy("conv_id", "block").agg(F.max("begins").alias("n")).select(
        F.col("conv_id").alias("in_conv"), F.col("block").alias("in_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = found.join(starts, found["conv_id"].eqNullSafe(starts["in_conv"]) & (found["block"] == starts["in_block"]))
    line = F.when(F.col("first") & F.col("line").rlike(ANY), F.ltrim(F.regexp_replace("line", ANY, ""))).otherwise(F.col("line"))
    whole = F.array_sort(F.collect_list(F.struct("block", "nth", line.alias("line"), "role")))
    met = numbered.groupBy("conv_id", (F.col("base") + F.col("begins") - 1).alias("turn")).agg(whole.alias("lines"))
    text = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), r"^(?:[^\S\n]*\n)+|\s+$", "")
    got = met.select("conv_id", "turn", F.col("lines")[0]["role"].alias("role"), text.alias("text"))
    return got.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, text, role): conversations (conv_id, turn, role, text) as people paste them.

    The way of marking speakers goes by a hash of the conversation; in one way, markers are missing now and then.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    said = F.coalesce("text", F.lit(""))
    name = lambda names: F.get(F.array(*map(F.lit, names)), _role())
    text = F.when(style == 0, F.concat(name(("System: ", "User: ", "Assistant: ", "Tool: ")), said))
    text = text.when(style == 1, F.concat(name(("### System\n", "### Human\n", "### AI\n", "### Tool\n")), said, F.lit("\n")))
    text = text.when(style == 2, F.concat(name(("Instructions: ", "Q: ", "A: ", "Observation: ")), said))
    text = text.otherwise(F.concat(F.when(lost, F.lit("")).otherwise(name(("[system] ", "[user] ", "[assistant] ", "[tool] "))), said, F.lit("\n")))
    return conversations.select("conv_id", F.col("turn").alias("part"), text.alias("text"), "role")


def formatted_chats(conversations: DataFrame) -> DataFrame:
    """Canonical turns of all conversations, from their raw transcripts; learned from three quarters of them."""
    raw = raw_transcripts(conversations)
    model = fit(raw.where(F.crc32(F.col("conv_id").cast("string")) % 4 != 0))
    return turns(raw.drop("role"), model)
