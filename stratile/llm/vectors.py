"""Near-duplicate vectors by NN-descent.

1. Equal vectors form a class with a weight; its smallest id goes on. Null and zero vectors and vectors with null
   or non-finite components take no part; vectors of different lengths are never compared.
2. A first neighbour graph comes from random hyperplane buckets (TABLES of them, about PER_BUCKET vectors each).
3. Rounds of NN-descent: a vector's neighbours and reverse neighbours are compared with each other, and each keeps the
   best K it has met; a list that is full of threshold links is saturated and enlarged (to 4 K). Two vectors that have
   met in a group aren't compared there again: a round works on groups with a new member or of several blocks. Rounds end
   when one finds no new link. Groups are compared in blocks of BLOCK members by another hash each
   round, so a hub or a bucket of copies never meets in one task. What a block's links connect stays connected: beside
   each member's best pairs it gives a spanning forest of all its links.
4. Links (cosine >= 0.95, in double precision) are contracted to components. Within its component every vector is
   compared with all members, in blocks, which completes saturated lists: the counts of links are exact for the
   components found.
5. Recall is audited: QUERIES vectors (chosen by a hash of the id) are compared with all others, in blocks; a link whose ends
   are in different components starts another pass with fresh hyperplanes and queries, and the audit's links are kept.
   Passes end when an audit finds no such link; each one that does joins components. The share found is logged.

Defined results: a vector that takes no part has n_links 0 and its own id as component; equal vectors and repeated
ids link with each other; a row with a null id gives a row without links; an empty table gives no rows; columns other than vec_id
and embedding are ignored.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import saved
from ._text import sample_key
from .components import components

THRESHOLD = 0.95
K = 10
TABLES = 8
PER_BUCKET = 24
BLOCK = 64
#: Members of a component in one block: a component of m is sent m / COUNT_BLOCK times, and a task holds two blocks.
COUNT_BLOCK = 1_024
#: Best pairs that a member takes from one block.
TAKEN = 4
ROUNDS = 6
QUERIES = 256


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _grouped(rows: DataFrame, keys: list[str], parts: int, each: Callable[[pa.RecordBatch], list[tuple]], schema: str, fields: pa.Schema) -> DataFrame:
    """Runs each over the rows of a key. Rows are dealt and sorted by key and streamed, so a task holds one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(o[i], f.type) for o in out]) for i, f in enumerate(fields)], schema=fields)
            out.clear()
            return found

        def close() -> None:
            group = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
            if group.num_rows > 1 and (found := each(group)):
                out.append(found)
            held.clear()

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            edges = [0, *cuts.tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    close()
                held.append(batch.slice(a, b - a))
                last = key
            if len(out) >= 500:
                yield flush()
        if held:
            close()
        if out:
            yield flush()

    return rows.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (child, parent) that connect what a symmetric matrix of links connects."""
    seen, child, parent = np.zeros(len(near), bool), [], []
    for root in np.flatnonzero(near.any(axis=1)).tolist():
        queue = [] if seen[root] else [root]
        seen[root] = True
        while queue:
            i = queue.pop()
            new = np.flatnonzero(near[i] & ~seen)
            seen[new] = True
            child += new.tolist()
            parent += [i] * len(new)
            queue += new.tolist()
    return np.array(child, np.int64), np.array(parent, np.int64)


def group_sizes(groups: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """key, n, whole of the groups (key, id, new) that have something to compare. whole: all pairs, since the group has several blocks, or had them last time."""
    counts = groups.groupBy("key").agg(F.count("*").alias("n"), F.max("new").alias("new")).filter("n > 1")
    large = F.col("n") > BLOCK
    if last is not None:
        counts = counts.join(last.filter(large).select("key", F.lit(True).alias("was")), "key", "left")
        large = large | F.col("was").isNotNull()
    return counts.filter(F.col("new") | large).select("key", "n", large.alias("whole"))


def local_join(groups: DataFrame, sizes: DataFrame, vectors: DataFrame, parts: int, turn: int = 0) -> DataFrame:
    """u, v, sim: for each member of a group (key, id, new) its TAKEN best in its block, and a spanning forest of the block's links. Members that aren't new have met. Each turn deals other blocks."""
    blocked = groups.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id", "key", F.lit(turn)), F.ceil(F.col("n") / BLOCK)))
    rows = blocked.select("key", "block", "id", (F.col("new") | F.col("whole")).alias("new")).join(vectors.select("id", "v"), "id").select("key", "block", "id", "new", "v")

    def each(group: pa.RecordBatch) -> list[tuple]:
        ids, met = group.column("id").to_numpy(), ~group.column("new").to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        ids, met, x = ids[order], met[order], _matrix(group.column("v"))[order]
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        sims[np.ix_(met, met)] = -2
        n = min(TAKEN, len(ids) - 1)
        best = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        u, v, s = np.repeat(ids, n), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel()
        u, v, s = u[s > -2], v[s > -2], s[s > -2]
        child, parent = _forest((sims >= THRESHOLD) | (sims.T >= THRESHOLD))
        return np.concatenate([u, ids[child]]), np.concatenate([v, ids[parent]]), np.concatenate([s, np.maximum(sims[child, parent], sims[parent, child])])

    return _grouped(rows, ["key", "block"], parts, each, "u long, v long, sim double", pa.schema([("u", pa.int64()), ("v", pa.int64()), ("sim", pa.float64())])).filter("u <> v")


def bucket_groups(vectors: DataFrame, bits: int, seed: int) -> DataFrame:
    """key, id, new: the buckets of TABLES sets of random hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for d in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == d)) if len(np.unique(sizes)) > 1 else batch
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), TABLES * bits))
                side = (_matrix(rows.column("v")) @ planes[d] > 0).reshape(rows.num_rows, TABLES, bits)
                keys = side @ (np.int64(1) << np.arange(bits, dtype=np.int64))
                keys = (keys * TABLES + np.arange(TABLES)) * 8191 + int(d)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(rows.column("id").to_numpy(), TABLES))], names=["key", "id"])

    return vectors.select("id", "v").mapInArrow(run, "key long, id long").withColumn("new", F.lit(True))


def neighbour_groups(graph: DataFrame, last: int = 0) -> DataFrame:
    """key, id, new: every vector with its neighbours and reverse neighbours. New are those that no edge from before the turn last makes a member; the vector itself has met its neighbours."""
    forth, back = graph.select(F.col("u").alias("key"), F.col("v").alias("id"), "since"), graph.select(F.col("v").alias("key"), F.col("u").alias("id"), "since")
    own = graph.select(F.col("u").alias("key"), F.col("u").alias("id"), F.lit(-1).alias("since"))
    return forth.unionByName(back).unionByName(own).groupBy("key", "id").agg((F.min("since") >= last).alias("new"))


def best_neighbours(found: DataFrame) -> DataFrame:
    """The best K of each vector (found: u, v, sim, since: the turn that met the pair first); a list that is saturated with links keeps up to 4 K."""
    pairs = found.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("since").alias("since"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return pairs.withColumn("rank", rank).filter((F.col("rank") <= K) | ((F.col("rank") <= 4 * K) & (F.col("sim") >= THRESHOLD))).drop("rank")


def audited(vectors: DataFrame, rows: int, attempt: int = 0) -> DataFrame:
    """a, b: all links of QUERIES vectors, by comparison with every vector."""
    share = QUERIES / max(1, rows)
    chosen = vectors.filter(sample_key(F.col("id"), F.lit("audit"), F.lit(attempt)) < share).select("id", "v").limit(4 * QUERIES).toArrow().to_batches()
    queries = {}
    for batch in chosen:
        for key, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
            queries.setdefault(len(v), []).append((key, v))
    known = {d: (np.array([k for k, _ in q], np.int64), _matrix(pa.array([v for _, v in q]))) for d, q in queries.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for d in np.unique(sizes):
                if d not in known:
                    continue
                rows_ = batch.filter(pa.array(sizes == d))
                ids = rows_.column("id").to_numpy()
                row, query = np.nonzero(_matrix(rows_.column("v")) @ known[d][1].T >= THRESHOLD)
                yield pa.RecordBatch.from_arrays([pa.array(known[d][0][query]), pa.array(ids[row])], names=["a", "b"])

    return vectors.select("id", "v").mapInArrow(run, "a long, b long").filter("a <> b")


def count_links(vectors: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """id, links: weights of the other vectors of the same component with a cosine of THRESHOLD at least; each pair of blocks is compared once."""
    sizes = found.groupBy("component").agg(F.ceil(F.count("*") / COUNT_BLOCK).cast("int").alias("blocks"))
    placed = found.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(F.col("node").alias("id"), F.col("component").alias("key"), F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own")
    rows = paired.join(vectors, "id").select("key", "lo", "hi", "own", "id", "weight", "v")

    def each(group: pa.RecordBatch) -> list[tuple]:
        ids, own, w = (group.column(c).to_numpy() for c in ("id", "own", "weight"))
        x = _matrix(group.column("v"))
        if group.column("lo")[0].as_py() == group.column("hi")[0].as_py():
            near = x @ x.T >= THRESHOLD
            np.fill_diagonal(near, False)
            return ids, near @ w
        here = own == group.column("lo")[0].as_py()
        near = x[here] @ x[~here].T >= THRESHOLD
        return np.concatenate([ids[here], ids[~here]]), np.concatenate([near @ w[~here], w[here] @ near])

    counts = _grouped(rows, ["key", "lo", "hi"], parts, each, "id long, links long", pa.schema([("id", pa.int64()), ("links", pa.int64())]))
    return counts.groupBy("id").agg(F.sum("links").alias("links"))


def vector_groups(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = table.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    sound = F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()
    base = base.withColumn("v", F.when(usable, F.col("v")))
    vectors = saved(base.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")))
    rows = vectors.count()
    bits = max(1, math.ceil(math.log2(max(2, rows) / PER_BUCKET)))
    graph, links, sizes, last = None, None, None, 0
    for attempt in itertools.count():
        total = -1
        for step in range(ROUNDS + 1):
            turn = attempt * (ROUNDS + 1) + step
            if step:
                groups = neighbour_groups(graph, last)
                sizes, last = saved(group_sizes(groups, sizes)), turn
                met = local_join(groups, sizes, vectors, parts, turn)
            else:
                groups = bucket_groups(vectors, bits, attempt)
                met = local_join(groups, group_sizes(groups), vectors, parts, turn)
            met = saved(met.withColumn("since", F.lit(turn)))
            graph = saved(best_neighbours(met if graph is None else graph.unionByName(met)))
            near = met.filter(F.col("sim") >= THRESHOLD).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
            links = saved((near if links is None else links.unionByName(near)).distinct())
            count = links.count()
            if step and count == total:
                break
            total = count
        found = components(links)
        here, there = found.select(F.col("node").alias("a"), F.col("component").alias("ca")), found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        audit = saved(audited(vectors, rows, attempt))
        missed = saved(audit.join(here, "a", "left").join(there, "b", "left").filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b"))
        lost, total = missed.count(), audit.count()
        logging.getLogger(__name__).info("pass %d: %d of %d audited links lie within components", attempt, total - lost, total)
        if not lost:
            break
        links = saved(links.unionByName(missed))
    inner = count_links(vectors, found, parts)
    classes = vectors.join(found, F.col("id") == F.col("node"), "left").join(inner.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").select("v", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    named = base.join(classes, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
