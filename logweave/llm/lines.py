"""Line dedup: maximal repeated runs of lines, from a suffix array built by prefix doubling.

Each distinct line that occurs twice or more has an id, its rank. Round k orders
all suffixes by their first 2^k lines: the rank of a suffix is made of its own
rank and that of the suffix 2^(k-1) lines further on. Suffixes whose first 2^k
lines are unique drop out. Two suffixes share their first m lines, that is they
lie in one longest-common-prefix interval of depth m, if and only if the ranks
of the two overlapping blocks of 2^k <= m lines at their ends agree.

A run counts when it has at least ``min_words`` words. The shortest such run from
each line onwards, and back from each line, are looked up as intervals; every
occurrence but the first (by doc_id, then line) is a later copy. Together these
cover exactly the lines of all runs of ``min_words`` or more that occur earlier:
the maximal repeated runs. The lines so covered are deleted. The first
occurrence of a line in the table is never deleted.

Defined cases: null texts stay null; an empty text is one empty line; a text
whose lines all go becomes empty. Rows that repeat both doc_id and text are one
document and are cut alike; rows with one id and other texts are documents of
their own, ordered by a hash of the text. Rows without id come first. Lines
match byte for byte. Extra columns are kept by ``without_later_copies``.

Everything is DataFrame operations. Windows run over one document's repeated
lines or over bounded ranges of ranks; a frequent line is only counted and
joined, so no task holds all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.storage import free_name, staged, word_count

#: Repeated runs of fewer words stay.
MIN_WORDS = 50
#: Ranks that one window sums up.
SPAN = 1 << 16
DOC = ["doc_id", "doc_hash"]


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    met = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        met &= a[n] == b[n]
    return met


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, doc_hash, pos, two 64-bit line hashes and the line's words, once for each document and line."""
    line = F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    rows = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("doc_hash"), line)
    rows = rows.select(*DOC, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                       word_count(F.col("line")).alias("words"))
    return rows.repartition(*DOC).dropDuplicates([*DOC, "pos"])


def _line_ranks(lines: DataFrame) -> DataFrame:
    """Rank 0: the repeated lines only, each ranked by its hashes among all of them."""
    bucket = F.shiftright("h1", 52)
    keys = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").withColumn("bucket", bucket)
    keys = staged(keys, "lines-keys")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    starts = keys.groupBy("bucket").agg(F.sum("n").alias("n")).select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    smaller = Window.partitionBy("bucket").orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, -1)
    ranks = keys.join(starts, "bucket").select("h1", "h2", (F.col("base") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).alias("rank"))
    return lines.join(ranks, ["h1", "h2"]).select(*DOC, "pos", "words", "rank")


def _doubled(ranks: DataFrame, reach: int) -> DataFrame:
    """Ranks by twice as many lines, of the suffixes that still aren't unique."""
    ahead = ranks.select(*DOC, (F.col("pos") - reach).alias("pos"), F.col("rank").alias("then"))
    here = ranks.select(*DOC, "pos", "rank")
    pairs = here.join(ahead, _same(here, ahead, *DOC, "pos")).select(here["doc_id"], here["doc_hash"], here["pos"], "rank", "then")
    keys = pairs.groupBy("rank", "then").agg(F.count("*").alias("n")).where("n > 1").withColumn("part", F.expr(f"`then` DIV {SPAN}"))
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = keys.groupBy("rank", "part").agg(F.sum("n").alias("n")).select("rank", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    smaller = Window.partitionBy("rank", "part").orderBy("then").rowsBetween(Window.unboundedPreceding, -1)
    refined = keys.join(starts, ["rank", "part"]).select(
        "rank", "then", (F.col("rank") + F.col("base") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).alias("next"))
    return pairs.join(refined, ["rank", "then"]).select(*DOC, "pos", F.col("next").alias("rank"))


def _blocks(ranks: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of enough words within stretches of repeated lines: kind, doc, start, size."""
    place = Window.partitionBy(*DOC).orderBy("pos")
    stretch = Window.partitionBy(*DOC, "stretch").orderBy("pos")
    lines = ranks.withColumn("stretch", F.col("pos") - F.row_number().over(place))
    lines = lines.withColumn("upto", F.sum("words").over(stretch))
    # one order of starts (by the words that an end needs) and ends (by the words up to them)
    events = lines.select(*DOC, "stretch", "pos", F.explode(F.array(
        F.struct((F.col("upto") - F.col("words") + min_words).alias("key"), F.lit(0).alias("end")),
        F.struct(F.col("upto").alias("key"), F.lit(1).alias("end")))).alias("e")).select(*DOC, "stretch", "pos", "e.*")
    order = Window.partitionBy(*DOC, "stretch").orderBy("key", "end")
    near_end = F.min(F.when(F.col("end") == 1, F.col("pos"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    near_start = F.max(F.when(F.col("end") == 0, F.col("pos"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spans = events.select(*DOC, F.col("end").alias("kind"),
                          F.when(F.col("end") == 0, F.col("pos")).otherwise(near_start).alias("start"),
                          F.when(F.col("end") == 1, F.col("pos")).otherwise(near_end).alias("stop"))
    return spans.where("start IS NOT NULL AND stop IS NOT NULL").select(
        *DOC, "kind", "start", (F.col("stop") - F.col("start") + 1).alias("size"))


def _later(blocks: DataFrame, ranks: DataFrame, reach: int) -> DataFrame:
    """Of the blocks of reach to 2*reach-1 lines, those that occur earlier: doc, start, stop."""
    here = blocks.where(F.col("size").between(reach, 2 * reach - 1))
    head = ranks.select(*DOC, F.col("pos").alias("start"), F.col("rank").alias("head"))
    tail = ranks.select(*DOC, F.col("pos").alias("last"), F.col("rank").alias("tail"))
    met = here.join(head, _same(here, head, *DOC, "start")).select(
        here["doc_id"], here["doc_hash"], "kind", here["start"], "size", "head", (here["start"] + F.col("size") - reach).alias("last"))
    met = met.join(tail, _same(met, tail, *DOC, "last")).select(
        met["doc_id"], met["doc_hash"], "kind", "start", "size", "head", "tail")
    place = F.struct("doc_id", "doc_hash", "start")
    run = ["kind", "size", "head", "tail"]
    intervals = met.groupBy(*run).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    # one key more than the groups have: the join has an exchange of its own on both sides, so a
    # frequent run's occurrences may be split over several tasks as any skewed join's rows
    key = F.xxhash64(*run)
    return met.withColumn("run", key).join(intervals.withColumn("run", key), ["run", *run]).where(place != F.col("first")).select(
        *DOC, "start", (F.col("start") + F.col("size")).alias("stop"))


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, doc_hash, gone: the positions of the lines to delete, for each document that has any."""
    lines = staged(lines_of(docs), "lines-ids")
    base = ranks = staged(_line_ranks(lines), "lines-ranks")
    blocks = staged(_blocks(ranks, min_words), "lines-blocks")
    longest = blocks.agg(F.max("size")).first()[0] or 0
    reach, copies = 1, []
    while reach <= longest:
        copies.append(_later(blocks, ranks, reach))
        if 2 * reach <= longest:
            ranks = staged(_doubled(ranks, reach), "lines-ranks")
        reach *= 2
    marks = base.select(*DOC, "pos", F.lit(0).alias("step"), F.lit(True).alias("line"))
    for c in copies:
        edge = F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("step")), F.struct(F.col("stop").alias("pos"), F.lit(-1).alias("step"))))
        marks = marks.union(c.select(*DOC, edge.alias("e")).groupBy(*DOC, "e.pos").agg(F.sum("e.step").alias("step")).select(*DOC, "pos", "step", F.lit(False)))
    depth = F.sum("step").over(Window.partitionBy(*DOC).orderBy("pos").rangeBetween(Window.unboundedPreceding, 0))
    covered = marks.withColumn("depth", depth).where("line AND depth > 0")
    return covered.groupBy(*DOC).agg(F.collect_list("pos").alias("gone"))


def without_later_copies(docs: DataFrame, min_words: int = MIN_WORDS, length_column: str = "n_chars",
                         count: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the later copies cut out of ``text`` and the length, if there is such a column, set anew.

    ``count`` names two more columns: how many lines a text had, and how many went.
    """
    gone = staged(later_copies(docs, min_words), "lines-gone")
    # it grows with the input, so it is never broadcast
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("doc_hash").alias("gone_hash"), F.col("gone").alias("gone_lines")).hint("merge")
    mark = free_name(docs, "text_hash")
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    met = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["gone_id"]) & (keyed[mark] == gone["gone_hash"]) & keyed["text"].isNotNull(), "left")
    lines = F.split(keyed["text"], "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["gone_lines"])
    text = F.when(gone["gone_lines"].isNull(), keyed["text"]).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    changed = gone["gone_lines"].isNotNull()
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias(c))
        elif c == length_column:
            columns.append(F.when(changed, F.length(text)).otherwise(keyed[c]).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(keyed[c])
    if count:
        columns += [F.when(keyed["text"].isNotNull(), F.size(lines)).otherwise(0).alias(count[0]),
                    F.coalesce(F.size(gone["gone_lines"]), F.lit(0)).alias(count[1])]
    return met.select(*columns)


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text without later copies, lines (before) and deleted of every document."""
    return without_later_copies(docs.select("doc_id", "text"), count=("lines", "deleted"))


SQL = rf"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, ls, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
counted AS (SELECT *, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) OVER (PARTITION BY doc_id ORDER BY pos) AS upto,
  len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines),
ends AS (SELECT a.doc_id, a.pos AS start, min(b.pos) AS stop, 0 AS kind FROM counted a JOIN counted b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= {MIN_WORDS} GROUP BY a.doc_id, a.pos
  UNION ALL SELECT b.doc_id, max(a.pos), b.pos, 1 FROM counted a JOIN counted b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.words >= {MIN_WORDS} GROUP BY b.doc_id, b.pos),
blocks AS (SELECT e.*, array_to_string(list_slice(d.ls, start, stop), chr(10)) AS body FROM ends e JOIN docs d USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, body, stop - start ORDER BY doc_id, start) AS nth FROM blocks),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN ranked r ON l.doc_id = r.doc_id AND r.nth > 1 AND l.pos BETWEEN r.start AND r.stop)
SELECT d.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') END AS text,
  CAST(coalesce(len(any_value(d.ls)), 0) AS INT) AS lines, CAST(count(g.pos) AS INT) AS deleted
FROM docs d LEFT JOIN lines l USING (doc_id) LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY d.doc_id, d.text
"""
