"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document draws the exponential key -ln(u) / w, u from a hash of its id and text and w from the quality of its text (WEIGHTS
by the share of letters and white space among its characters), so that the smallest keys are a weighted
sample without replacement. Within a source, documents are taken in key order until their words fill the
source's target; whole epochs come first and only the rest of a target is a selection. The document that
crosses the target is taken if that comes nearer to it.

Sources, in code point order with null last, weigh CYCLE, repeating. They share SHARE of all words; a target stops
at LIMIT times its source's words, and the excess is shared anew by weight: that level is found in closed form
over the sources' totals.

Scale: equal rows (id, source and text) are counted first and go on as one row; keys are cut into about sqrt(n) equally full
buckets per source by their distribution function, so prefix sums run within a bucket and over bucket totals; no task holds a
source. Defined results: null or blank texts have size 0 and are never taken; ties of keys go to the smaller id; equal rows
are documents of their own (equal keys, one after the other), rows that share an id or have none are told apart by their
texts; an empty table gives no rows; columns other than doc_id, source and text are ignored by mix, mixed_documents keeps all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import saved
from ._text import WORD_PATTERN

CYCLE = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
WEIGHTS = (0.25, 0.5, 0.75, 1.0)
#: Characters that aren't prose: ASCII digits and signs.
SIGNS = r"[!-@\[-`{-~]"
#: Repetitions of a row that are listed at a time.
CHUNK = 4_096
#: Groups cut by a target (one a source at most) up to which they are broadcast.
BROADCAST_ROWS = 10_000


def _draw(text: Column) -> Column:
    """48 bits of a hash of id and text: documents that share an id, or have none, draw each for itself."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 12), 16, 10).cast("long")


def _key(weight: Column) -> Column:
    return -F.log((F.col("draw").cast("double") + 0.5) / float(1 << 48)) / weight


def targets(totals: DataFrame) -> DataFrame:
    """source, source_size, target of per-source totals (source, source_size): one row a source, so a window over all of them is small."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*map(F.lit, CYCLE)), ((F.row_number().over(ordered) - 1) % len(CYCLE) + 1).cast("int"))
    weighed = totals.withColumn("w", cycle.cast("double")).withColumn("cap", F.col("source_size") * LIMIT)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * SHARE - (F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))) / F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    leveled = weighed.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))
    first = leveled.withColumn("level", F.coalesce(F.first(fits, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf"))))
    return first.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def mixed_groups(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, draw, n (equal rows), source_size, target, whole (epochs), chosen (rows of the n that the selection takes once more)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = 1 - F.regexp_count(text, F.lit(SIGNS)) / F.greatest(F.length(text), F.lit(1))
    step = F.least(F.floor(plain * len(WEIGHTS)), F.lit(len(WEIGHTS) - 1)).cast("int")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size"), step.alias("step"), _draw(text).alias("draw"))
    # Equal rows meet in map-side counts, so a row that is repeated without bound is one row of a bucket.
    sized = sized.groupBy("doc_id", "source", "size", "step", "draw").agg(F.count("*").alias("n"))
    sized = saved(sized.withColumn("key", _key(F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("step") + 1))))
    counts = [F.sum(F.when(F.col("step") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(WEIGHTS))]
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"), *counts)
    plan = totals.join(targets(totals.select("source", "source_size")).select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    share = sum((F.col(f"n{i}") * (1 - F.exp(-F.col("key") * w)) for i, w in enumerate(WEIGHTS)), F.lit(0.0)) / F.col("rows")
    bucket = F.least(F.floor(share * F.ceil(F.sqrt("rows"))), F.ceil(F.sqrt("rows")) - 1).cast("long")
    # One row a source: its size follows the number of sources, so Spark decides whether it is small enough to broadcast.
    keyed = sized.withColumnRenamed("source", "s").join(plan, F.col("s").eqNullSafe(F.col("source"))).drop("s").withColumn("bucket", bucket)
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "draw").rowsBetween(Window.unboundedPreceding, 0)
    words = F.col("size") * F.col("n")
    inner = keyed.withColumn("run", F.sum(words).over(order))
    sums = keyed.groupBy("source", "bucket").agg(F.sum(words).alias("b"))
    ahead = sums.select(F.col("source").alias("s"), F.col("bucket").alias("k"), (F.sum("b").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("b")).alias("ahead"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - whole * F.col("source_size")
    before = F.col("ahead") + F.col("run") - words
    # Equal rows follow each other: the first is chosen if half of it fits, each further one if a whole size more does.
    more = F.floor((left - (before + F.col("size") / 2)) / F.col("size"))
    chosen = F.when((F.col("size") > 0) & (before + F.col("size") / 2 <= left), F.least(F.col("n"), more + 1)).otherwise(0)
    found = inner.join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k")))
    epochs = F.when(F.col("size") > 0, whole).otherwise(0)
    return found.select("doc_id", "source", "size", "draw", "n", "source_size", "target", epochs.cast("long").alias("whole"), chosen.cast("long").alias("chosen"))


def _times(df: DataFrame, times: Column) -> DataFrame:
    """Each row so often; CHUNK rows are listed at a time, whatever the number is."""
    chunks = F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), F.floor((times - 1) / CHUNK))))
    split = df.withColumn("__times", times).withColumn("__chunk", chunks)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(CHUNK).cast("long"), F.col("__times") - F.col("__chunk") * CHUNK)))
    return split.withColumn("__each", each).drop("__times", "__chunk", "__each")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies (times the document is taken) of every document."""
    kinds = F.array(F.struct((F.col("whole") + 1).alias("copies"), F.col("chosen").alias("rows")), F.struct(F.col("whole").alias("copies"), (F.col("n") - F.col("chosen")).alias("rows")))
    listed = mixed_groups(docs).withColumn("kind", F.explode(F.filter(kinds, lambda k: k["rows"] > 0)))
    rows = _times(listed.select("doc_id", "source", "size", "source_size", "target", F.col("kind.copies").alias("copies"), F.col("kind.rows").alias("rows")), F.col("rows"))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with all their columns.

    Documents are known by id, source and text. Where the selection takes some of several equal ones, the further copies
    are those of the one whose other columns are the smallest.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    groups = mixed_groups(docs).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("draw").alias("__draw"), "whole", "chosen", "n")
    groups = saved(groups.select("__id", "__source", "__draw", F.struct("whole", "chosen", "n").alias("__plan")).filter("__plan.whole + __plan.chosen > 0"))
    drawn = docs.withColumn("__own", _draw(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__draw"))
    plan = F.col("__plan")
    taken = _times(drawn.join(groups, same), plan["whole"] + (plan["chosen"] == plan["n"]).cast("long")).select(*kept)
    # At most one group of a source is cut by its target, and one of equal rows alone is listed here.
    cut = groups.filter("__plan.chosen between 1 and __plan.n - 1")
    found = cut.count()
    if not found:
        return taken
    cut = F.broadcast(cut) if found <= BROADCAST_ROWS else cut
    first = drawn.join(cut, same).groupBy("__id", "__source", "__draw").agg(F.min("__plan").alias("__plan"), F.min(F.struct(*kept)).alias("__row"))
    return taken.unionByName(_times(first, plan["chosen"]).select(*(F.col("__row")[c].alias(c) for c in docs.columns)))


def contract(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same in DuckDB, with plain windows over each source.
ORACLE = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    least(floor((1 - len(regexp_extract_all(coalesce(text, ''), '{SIGNS}'))::double / greatest(length(coalesce(text, '')), 1)) * 4), 3)::int as step,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 12))::bigint as draw
  from documents),
keyed as (
  select *, -ln((draw::double + 0.5) / 281474976710656.0::double) / (case step when 0 then 0.25::double when 1 then 0.5::double when 2 then 0.75::double else 1.0::double end) as key
  from sized),
totals as (select source, sum(size)::bigint as source_size from keyed group by source),
weighed as (
  select *, (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::double as w, source_size * 2 as cap from totals),
leveled as (
  select *, (sum(source_size) over () * 1.5::double - (sum(cap) over (order by cap / w, source nulls last rows unbounded preceding) - cap))
    / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as lv from weighed),
level as (select arg_min(lv, r) as lv from (select lv, row_number() over (order by cap / w, source nulls last) as r from leveled where lv <= cap / w)),
plan as (select source, source_size, least(cap::double, coalesce((select lv from level), 'inf'::double) * w) as target from weighed),
run as (
  select doc_id, size, source_size, target, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
    sum(size) over (partition by k.source order by key, doc_id, size rows unbounded preceding) - size as before
  from keyed k join plan p on k.source is not distinct from p.source)
select doc_id, size, source_size, target,
  (size * case when size > 0 then whole + (before + size / 2 <= target - whole * source_size)::bigint else 0 end)::bigint as taken
from run
"""
