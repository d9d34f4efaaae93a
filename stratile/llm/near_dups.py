"""Near-duplicate documents by bottom-k sketches of word shingles.

1. One hash function gives every text its shingle set. Texts with equal sets form a class, which alone goes on, by a number of
   its own: ids don't name texts (they can be null, or shared by several). The bottom K hashes are the class's sketch.
2. Sketch values that two classes share make inverted lists. In order of list length, a class whose other values
   are its own needs to keep only its SKETCH_PREFIX rarest values: two sets with Jaccard similarity of 0.75 share
   MIN_COMMON of their K values (5 standard deviations under the expectation), so they share a kept one. A class of K
   values or fewer keeps what an exact bound asks for, whether its partner's sketch is the whole set or cut to K values.
   Passages that many documents repeat are the longest lists and so are the first to go unkept.
3. Classes that keep a shared value are read again with their full sets. The same is done with all of a set's
   values, where the bound is exact: sets with similarity of 0.75 share one of the n - ceil(0.75 n) + 1 rarest values.
4. Lists generate pairs in two rounds, never all pairs of a list. The first links each member to its neighbour in a
   part of the list and to the list's hub, its most typical member. The second pairs what is in other
   components than the hub with the rest of the list, where sizes and the places of the value allow it: partners are met
   by (value, range of sizes), and a range that a member's place rules out is never joined.
5. The similarity of a pair is estimated by its union sketch, and confirmed on the full sets.

Nothing is capped: the second round covers every pair that the first left in different components. Documents of
one class get the class's component.

Defined results: null texts and texts without words have no shingles and link with nothing; repeated rows link with
each other and each gives a row; rows that share an id with different texts are documents of their own, linked by their texts alone;
rows with a null id take part, but name no component (a component of such rows alone has a null component_id, and they
count as kept); an empty table gives no rows; columns other than doc_id and text are ignored by duplicate_groups and
kept by deduplicated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import saved
from ._text import WORD_PATTERN, slices
from .components import components
from .shingles import shingle_sets

K = 64
MIN_COMMON = 30
SKETCH_PREFIX = K - MIN_COMMON + 1
#: Estimates under this leave a pair out: 0.75 less 5 standard deviations of a K-value estimate.
MIN_ESTIMATE = 0.48
#: Members of a list between which neighbours are linked at a time.
PART = 500
#: Pairs that share one copy of a set when they are confirmed.
PER_COPY = 256
#: Ids of classes to read again that are broadcast at most (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Sizes in one range differ by this factor at most.
RANGE = 1.05
TOP = np.uint64(1 << 63)


def _signed(values: np.ndarray) -> np.ndarray:
    """Hashes as longs of the same order."""
    return (values ^ TOP).view(np.int64)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Digest of a row's id and text; null and empty differ."""
    part = lambda c: F.coalesce(F.concat(F.lit(":"), F.col(c).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(part(doc_id), F.lit("\n"), part(text)).cast("binary")))


def _set_key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, set_key (null without shingles), sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(map(_set_key, sets), pa.binary()), pa.array([_signed(s[:K]) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "row_key", "n_shingles", "set_key", "sketch"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row_key"))
    return kept.mapInArrow(run, "doc_id long, row_key binary, n_shingles long, set_key binary, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """set_key, n, sketch, values (the whole set, sorted) of every row's text (docs: text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                raw = shingle_sets(texts)
                sets = [_signed(s) for s in raw]
                yield pa.RecordBatch.from_arrays([pa.array(map(_set_key, raw), pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s[:K] for s in sets], pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))], names=["set_key", "n", "sketch", "values"])

    return docs.mapInArrow(run, "set_key binary, n long, sketch array<long>, values array<long>")


def _shared(rows: DataFrame, values: str) -> DataFrame:
    """value, cls, df: the values that two rows hold at least. Counting is by map-side sums, and the join can split hot values."""
    entries = rows.select("cls", F.explode(values).alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    return entries.join(often, "value")


def candidate_classes(classes: DataFrame) -> DataFrame:
    """Ids of the classes that keep a value of their sketch which another class keeps too (classes: cls, n, sketch)."""
    size = F.least(F.col("n"), F.lit(K))
    widest = F.floor(F.col("n") * 4 / 3)  # the largest set that can be similar; its sketch lacks widest - K values
    seen = F.when(widest > K, F.ceil((F.col("n") + widest) * 3 / 7) - (widest - K))
    exact = F.col("n") - F.least(F.ceil(F.col("n") * 0.75), seen) + 1
    prefix = F.when(F.col("n") <= K, exact).otherwise(SKETCH_PREFIX)
    held = _shared(classes, "sketch").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))  # K values at most
    ranked = held.join(classes.select("cls", "n"), "cls").withColumn("room", (prefix - (size - F.size("v"))).cast("int")).filter("room > 0")
    kept = ranked.select("cls", F.explode(F.slice("v", F.lit(1), F.col("room"))).alias("v")).select("cls", F.col("v.value").alias("value"))
    return _shared(kept.select("cls", F.array("value").alias("v")), "v").select("cls").distinct()


def inverted_lists(sets: DataFrame) -> DataFrame:
    """value, cls, n, place (of the value among the set's, rarest first), df, typical: the kept shared values."""
    shared = _shared(sets, "values").join(sets.select("cls", "n"), "cls")
    mine = Window.partitionBy("cls")
    ranked = shared.withColumn("s", F.count("*").over(mine)).withColumn("typical", F.sum("df").over(mine) / F.col("n")).withColumn("place", F.col("n") - F.col("s") + F.row_number().over(mine.orderBy("df", "value")))
    return ranked.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 0.75) + 1).drop("s")


def _sizes_fit(n: str, m: str) -> Column:
    return (F.least(n, m) * 4) >= (F.greatest(n, m) * 3)


def first_pairs(lists: DataFrame) -> DataFrame:
    """Neighbours in parts of lists, and each member with the hub: distinct a, b, at most two pairs per entry."""
    parts = lists.withColumn("part", F.pmod(F.xxhash64("cls"), F.ceil(F.col("df") / PART)))
    w = Window.partitionBy("value", "part").orderBy("n", "cls")
    chain = parts.select("cls", "n", F.lag("cls").over(w).alias("b"), F.lag("n").over(w).alias("m")).filter("b is not null")
    hubs = lists.groupBy("value").agg(F.max(F.struct("typical", F.col("cls").alias("b"), F.col("n").alias("m"))).alias("hub")).select("value", "hub.b", "hub.m")
    star = lists.select("value", "cls", "n").join(hubs, "value").filter("cls <> b")
    pairs = chain.select("cls", "b", "n", "m").unionByName(star.select("cls", "b", "n", "m"))
    return pairs.filter(_sizes_fit("n", "m")).select(F.col("cls").alias("a"), "b").distinct()


def _range_of(n: Column) -> Column:
    return F.floor(F.log(n) / math.log(RANGE)).cast("int")


def later_pairs(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of a list whose ends are in different components, where the value's places leave room for enough others."""
    comp = lists.join(found, F.col("cls") == F.col("node"), "left").select("value", "cls", "n", "place", "typical", F.coalesce("component", "cls").alias("component"))
    hubs = comp.groupBy("value").agg(F.max(F.struct("typical", "cls", F.col("component").alias("c"))).alias("hub"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = comp.join(hubs.filter("lo <> hi").select("value", F.col("hub.c").alias("hub")), "value").withColumn("room", F.col("n") - F.col("place") + 1)
    # The two share the rooms' smaller part at most, and a partner of a range has its least size at least.
    needs = lambda least: F.col("room") * 7 >= (F.col("n") + least) * 3
    ranges = F.explode(F.sequence(_range_of(F.col("n") * 0.75) - 1, _range_of(F.col("n") / 0.75) + 1))
    reach = mixed.filter("component <> hub").withColumn("range", ranges).filter(needs(F.pow(F.lit(RANGE), F.col("range")) * (1 - 1e-9) - 1e-6))
    stray = reach.select("value", "range", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("room").alias("ra"), F.col("component").alias("ca"))
    other = mixed.filter(needs(F.col("n") * 0.75)).select("value", _range_of(F.col("n")).alias("range"), F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("room").alias("rb"), F.col("component").alias("cb"), (F.col("component") == F.col("hub")).alias("at_hub"))
    fits = (F.col("ca") != F.col("cb")) & (F.col("at_hub") | (F.col("a") < F.col("b"))) & _sizes_fit("na", "nb") & (F.least("ra", "rb") * 7 >= (F.col("na") + F.col("nb")) * 3)
    return stray.join(other, (stray["value"] == other["value"]) & (stray["range"] == other["range"]) & fits).select("a", "b").distinct()


def _with_sets(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """pairs(a, b) with both ends' rows (struct columns x and y). An end with many pairs is copied once per PER_COPY of them."""
    ends = pairs.join(rows.select(F.col("cls").alias("a"), F.struct(*rows.columns).alias("x")), "a")
    copies = pairs.groupBy("b").agg(F.ceil(F.count("*") / PER_COPY).cast("int").alias("copies"))
    salted = rows.select(F.col("cls").alias("b"), F.struct(*rows.columns).alias("y")).join(copies, "b").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return ends.join(copies, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int")).drop("copies").join(salted, ["b", "salt"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets have a Jaccard similarity of 0.75 at least."""
    both = _with_sets(pairs, sets.select("cls", "sketch"))
    union = F.slice(F.array_sort(F.array_union("x.sketch", "y.sketch")), 1, K)
    estimate = F.size(F.array_intersect(union, F.array_intersect("x.sketch", "y.sketch"))) / F.size(union)
    likely = saved(both.filter(estimate >= MIN_ESTIMATE).select("a", "b"))
    whole = _with_sets(likely, sets.select("cls", "n", "values"))
    common = F.size(F.array_intersect("x.values", "y.values"))
    return whole.filter(common * 100 >= (F.col("x.n") + F.col("y.n") - common) * 75).select("a", "b")


def linked_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, group (a number of the row's component, null without shingles), component_id of every row."""
    base = saved(sketches(docs))
    shared = base.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = saved(shared.withColumn("cls", F.monotonically_increasing_id()))  # the numbers hold from the write on
    chosen = saved(candidate_classes(classes.select("cls", "n", "sketch")).join(classes.select("cls", "set_key", "doc_id"), "cls"))
    ids = chosen.select("doc_id").filter("doc_id is not null").distinct()
    if chosen.count() <= BROADCAST_IDS:  # then the texts need not be shuffled to be picked
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    again = texts.filter("doc_id is not null").join(ids, "doc_id", "left_semi")
    if chosen.filter("doc_id is null").limit(1).count():  # no id finds those texts
        again = again.unionByName(texts.filter("doc_id is null"))
    sets = saved(full_sets(again.select("text")).dropDuplicates(["set_key"]).join(chosen.select("set_key", "cls"), "set_key").drop("set_key"))
    lists = saved(inverted_lists(sets))
    links = saved(confirmed(first_pairs(lists), sets))
    first = components(links)
    more = confirmed(later_pairs(lists, first), sets)
    # The later links are between the first's components.
    named = lambda end: first.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    between = components(more.join(named("a"), "a", "left").join(named("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    inner = classes.select("set_key", "cls", "doc_id").join(first.withColumnRenamed("node", "cls"), "cls", "left").select("set_key", "doc_id", F.coalesce("component", "cls").alias("inner"))
    groups = inner.join(between.withColumnRenamed("node", "inner"), "inner", "left").select("set_key", "doc_id", F.coalesce("component", "inner").alias("group"))
    named = groups.join(groups.groupBy("group").agg(F.min("doc_id").alias("component_id")), "group").select("set_key", "group", "component_id")
    rows = base.select("doc_id", "row_key", "n_shingles", "set_key").join(named, "set_key", "left")
    return rows.select("doc_id", "row_key", "n_shingles", "group", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    return linked_rows(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The input with one row of each component: of the smallest id, nulls last, then by a digest of id and text. Rows without shingles stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    kept = linked_rows(docs).filter("group is not null").groupBy("group").agg(first.alias("first")).select(F.col("first.row_key").alias("__row"))
    worded = F.coalesce(F.col("text").cast("string").rlike(WORD_PATTERN), F.lit(False))
    chosen = docs.filter(worded).withColumn("__row", row_key()).join(kept, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
    return chosen.unionByName(docs.filter(~worded))
