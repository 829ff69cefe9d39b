"""Mixing sources to target weights: an exact word budget for each source.

Every row gets a hash-random key (md5 of its id and text). Within its source the rows are
in key order, cut into key ranges of about ``RANGE_ROWS`` rows. Word sums of the
ranges, summed up along each source, and sums within a range give every row's
place on its source's word line. A source's budget is so many whole epochs of
it, and the rest is cut from the start of one more epoch at the exact word.

Targets: the sources share ``share`` times all words by weight; what would exceed
``most`` times a source's own words goes to the others by weight, again and
again until none is above.

Defined cases: null and empty texts have no words and take none; null is a
source of its own, last in order; a table without words has targets of zero.
Repeated rows are rows of their own; they share a key, and nothing tells them
apart. Other rows have keys of their own, with or without an id. Extra columns are kept by ``mixed``.
Nothing depends on the order of the input, so reruns agree.

Everything is DataFrame operations; the driver only holds the water level. A
source of any size is spread over its ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.storage import free_name, staged, word_count

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
RANGE_ROWS = 4096


def words(column: Column) -> Column:
    return word_count(column).cast("long")


def mix_key(id_column: Column, text: Column) -> Column:
    """A hash of id and text: rows without id, or of one id, spread over the ranges too."""
    return F.md5(F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def _range(key: Column, ranges: int) -> Column:
    """The number of the key's range: ranges are equal parts of all keys."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: weights go to the sources in code point order, null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = staged(sums.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # one row for each partition of the sort
    starts = order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    weight = F.get(F.array(*map(F.lit, weights)), ((F.col("base") + place) % len(weights)).cast("int"))
    table = staged(order.withColumn("part", part).join(starts, "part").select(
        "source", "source_size", (F.col("source_size") * most).alias("cap"), weight.alias("weight")), "mix-weights")
    whole = table.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    level, full = (share * whole["s"] / whole["w"] if whole["w"] else 0.0), -1
    while True:
        above = F.col("cap") <= F.col("weight") * level
        now = table.agg(F.count(F.when(above, 1)).alias("full"), F.sum(F.when(above, F.col("cap"))).alias("held"),
                        F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if now["full"] == full or not now["open"]:
            break
        full, level = now["full"], (share * whole["s"] - (now["held"] or 0)) / now["open"]
    return table.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def plan(sized: DataFrame) -> tuple[DataFrame, int]:
    """For a written table (source, size, key): each range's start on its source's word line, with the source's budget; and the number of ranges."""
    ranges = max(1, sized.count() // RANGE_ROWS)
    sums = sized.groupBy("source", _range(F.col("key"), ranges).alias("range")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("from"), "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    goal = targets(sized)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) DIV source_size")).otherwise(0)
    goal = goal.select("source", "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"))
    joined = sums.join(goal, sums["from"].eqNullSafe(goal["source"])).drop("from")
    return staged(joined, "mix-plan"), ranges


def _dealt(rows: DataFrame, starts: DataFrame, ranges: int, key: str, size: str, tie: list[str]) -> tuple[DataFrame, Column]:
    """Each row with its range's plan columns (as ``mix_plan``), and its place on the source's word line."""
    number, struct = free_name(rows, "mix_range"), free_name(rows, "mix_plan")
    its_source, its_range = free_name(rows, "plan_source"), free_name(rows, "plan_range")
    starts = starts.select(F.col("source").alias(its_source), F.col("range").alias(its_range), F.struct("base", "source_size", "target", "epochs", "rest").alias(struct))
    line = Window.partitionBy("source", number).orderBy(key, *tie, size).rowsBetween(Window.unboundedPreceding, -1)
    inner = free_name(rows, "mix_before")
    rows = rows.withColumn(number, _range(F.col(key), ranges))
    rows = rows.withColumn(inner, F.coalesce(F.sum(size).over(line), F.lit(0)))
    met = rows.join(starts, rows["source"].eqNullSafe(starts[its_source]) & (rows[number] == starts[its_range]))
    return met, F.col(struct)["base"] + F.col(inner)


def source_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row."""
    sized = staged(docs.select("doc_id", "source", words(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("key")), "mix-sizes")
    starts, ranges = plan(sized)
    rows, place = _dealt(sized, starts, ranges, "key", "size", ["doc_id"])
    p = F.col("mix_plan")
    part = F.greatest(F.lit(0), F.least(F.col("size"), p["rest"] - place))
    return rows.select("doc_id", "size", p["source_size"].alias("source_size"), p["target"].alias("target"), (p["epochs"] * F.col("size") + part).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns.

    Documents stay whole: the one on the cut comes once more if at least half of it is within the budget.
    """
    sized = staged(docs.select("source", words(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("key")), "mix-sizes")
    starts, ranges = plan(sized)
    size, key = free_name(docs, "mix_size"), free_name(docs, "mix_key")
    rows = docs.withColumn(size, words(F.col("text"))).withColumn(key, mix_key(F.col("doc_id"), F.col("text")))
    rows, place = _dealt(rows, starts, ranges, key, size, ["doc_id"])
    p = F.col(free_name(docs, "mix_plan"))
    more = (p["rest"] > place) & ((p["rest"] - place) * 2 >= F.col(size))
    copies = (p["epochs"] + more.cast("int")).cast("int")
    copy = free_name(docs, "mix_copy")
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies))).select(*(F.col(c) for c in docs.columns))


SQL = rf"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, 2 * source_size AS cap, [3, 1, 2][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight FROM sources),
lined AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
  sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
  sum(source_size) OVER () AS everything FROM weighed),
level AS (SELECT max(CAST(({SHARE} * CAST(everything AS DOUBLE) - CAST(held AS DOUBLE)) AS DOUBLE) / CAST(open AS DOUBLE)) AS level FROM lined
  WHERE CAST(({SHARE} * CAST(everything AS DOUBLE) - CAST(held AS DOUBLE)) AS DOUBLE) / CAST(open AS DOUBLE) <= cap / weight),
goal AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * level) AS target FROM weighed, level),
budget AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM goal),
placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)
SELECT p.doc_id, p.size, b.source_size, b.target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed p JOIN budget b ON p.source IS NOT DISTINCT FROM b.source
"""
