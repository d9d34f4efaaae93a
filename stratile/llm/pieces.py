"""SentencePiece encoding and decoding by a relational lattice.

A text is normalised as the model says (a leading meta space, spaces as meta spaces) and cut into units wherever two
neighbouring characters stand together in no piece: no edge of the lattice crosses such a place, so units are
encoded on their own. Distinct units go through the lattice:

1. explode the substrings of a unit up to the longest piece;
2. equi-join them to the piece table (broadcast: its size is the vocabulary's);
3. group the edges by unit;
4. fold them with a higher-order aggregate. For a unigram model that is Viterbi over the scores. The best path of a BPE
   model's scores is not what the model encodes (measured: 29 % of the distinct words of the test texts agree), so
   for a BPE model the fold replays its merges on the same edges: the best-scored edge that joins two
   neighbouring parts, the leftmost on ties, until none is left. Its results equal the reference library's.

Parts are kept as a bit mask, so the fold takes units up to MASK_UNIT characters; longer ones (runs that no place cuts) are
merged with a heap, by the same rule. Characters without a piece become byte pieces.

Texts are dealt to buckets by id. The units of a bucket that the HOT most frequent units (from a bounded sample; a cache
of bounded size, broadcast) don't cover are encoded once for all buckets and sent back to the buckets that hold them,
where the texts' ids are put together. What is broadcast does not grow with the corpus.

Defined results: null and empty texts give no ids and decode to ""; a literal meta space decodes to a space, as in the
library; repeated rows are encoded each; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq
import pickle
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._text import sample_key, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
MASK_UNIT = 62
#: The code of a merge edge: the place of its piece by score, where it begins (6 bits), stop (1 bit), id.
ID_BITS, FROM_AT, PLACE_AT = 20, 21, 27
HOT = 200_000
SAMPLE_DOCS = 20_000
#: Characters that a bucket holds on average at most; a bucket's texts are put together in one task.
BUCKET_CHARS = 12_000_000
#: Bytes of words that are cut at a time, unless a single one is longer.
WORD_BYTES = 1_000_000
#: Blobs whose words are numbered together, and blobs whose distinct words are held before they are made distinct together.
BLOBS = 32
#: Characters in a blob of a bucket's texts, and in all blobs that a task holds.
PACK_CHARS = 400_000
PACK_TOTAL = 8_000_000
#: Log-probability under the lowest score that a character without a piece has in a unigram path.
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        elif key & 7 == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 8 if key & 7 == 1 else 4
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores and types; the model's kind; byte pieces by value; how texts are normalised."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    kind: int
    prefix: bool

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        with open(path, "rb") as f:
            data = f.read()
        pieces, scores, types, kind, prefix = [], [], [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode("utf-8"))
                scores.append(struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0])
                types.append(own.get(3, NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(_fields(value))
                prefix = bool(own.get(3, 1))
                if own.get(4, 1) or own.get(1, b"identity") != b"identity":
                    raise ValueError("only models with the identity normaliser that keep extra white space are supported")
        return Vocabulary(tuple(pieces), tuple(scores), tuple(types), kind, prefix)

    def table(self) -> dict[str, tuple[int, float]]:
        return {p: (i, s) for i, (p, s, t) in enumerate(zip(self.pieces, self.scores, self.types, strict=True)) if t in (NORMAL, USER_DEFINED)}

    def early(self) -> set[str]:
        """Pieces that a merge with a neighbour can turn into a piece of the same score or a better one."""
        table = self.table()
        found = set()
        for whole, (_, score) in table.items():
            for k in range(1, len(whole)):
                a, b = table.get(whole[:k]), table.get(whole[k:])
                if a and b:
                    found |= {p for p, (_, s) in ((whole[:k], a), (whole[k:], b)) if s <= score and len(p) > 1}
        return found

    def byte_ids(self) -> dict[int, int]:
        return {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}

    def unknown_ids(self, char: str) -> list[int]:
        ids = self.byte_ids()
        return [ids[b] for b in char.encode("utf-8", "replace")] if ids else [self.pieces.index("<unk>")]


class Cutter:
    """Cuts texts into units between characters that are neighbours in no piece."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = {(a, b) for p in vocabulary.table() for a, b in zip(p, p[1:])}
        chars = sorted({c for pair in pairs for c in pair})
        self.index = np.zeros(0x110000, np.int32)
        self.index[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        joined = np.zeros((self.width, self.width), bool)
        for a, b in pairs:
            joined[self.index[ord(a)], self.index[ord(b)]] = True
        self.joined = joined.ravel()
        self.prefix = SPACE if vocabulary.prefix else ""
        # A space starts a unit unless it follows another one: then texts are sequences of words, each with its own space.
        self.by_word = vocabulary.prefix and all(a == SPACE for a, b in pairs if b == SPACE)

    def words(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """Parts that are encoded on their own, and the bounds of each text's: words, or the whole text where spaces stand together or at an end."""
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        whole = ~empty
        if self.by_word:
            odd = (pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE), pc.starts_with(texts, " "), pc.ends_with(texts, " "))
            whole &= np.logical_or.reduce([o.to_numpy(zero_copy_only=False) for o in odd])
        lists = pc.split_pattern(texts, " ")
        words, bounds = lists.flatten(), lists.offsets.to_numpy()
        if whole.any() or empty.any():
            counts = np.where(empty, 0, np.where(whole, 1, np.diff(bounds)))
            begins = np.where(whole, len(words) + np.arange(len(texts)), bounds[:-1])
            words, bounds = pa.concat_arrays([words, texts]).take(pa.array(ragged(begins, counts))), bounds_of(counts)
        return words, bounds

    def units(self, words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """Units of many words, none empty, and the bounds of each word's units."""
        raw, ends = joined(self.prefix, pc.replace_substring(words, " ", SPACE))
        starts = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes where characters begin
        at = self.index[np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
        cut = np.ones(len(starts), bool)
        cut[1:] = ~self.joined[at[:-1] * self.width + at[1:]]
        cut[np.searchsorted(starts, ends[:-1])] = True
        begins = starts[cut]
        offsets = np.append(begins, len(raw)).astype(np.int32)
        units = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw))
        return units, np.searchsorted(begins, ends)


def bounds_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def ragged(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[k], begins[k] + 1, ...: counts[k] places for each k."""
    bounds = bounds_of(counts)
    return np.repeat(begins - bounds[:-1], counts) + np.arange(bounds[-1])


def joined(head: str, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words one after the other, each with the head before it, and the bounds of each."""
    if head:
        words = pc.binary_join_element_wise(head, words, "")
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    data = words.buffers()[2] if len(words) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, (offsets - offsets[0]).astype(np.int64)


def word_blocks(words: pa.StringArray, limit: int = WORD_BYTES) -> Iterator[pa.StringArray]:
    """Runs of words of about limit bytes; a longer one ends its run."""
    block = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False), dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(words)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield words.slice(a, b - a)


@cache
def tools(vocabulary: Vocabulary) -> tuple[Cutter, dict[str, tuple[int, float]], Decoder]:
    """Built once a worker."""
    return Cutter(vocabulary), vocabulary.table(), Decoder(vocabulary)


def merge_parts(unit: str, table: dict[str, tuple[int, float]], unknown) -> list[int]:
    """BPE merges of one unit with a heap: n log n, for units of any length."""
    parts, left, right = list(unit), list(range(-1, len(unit) - 1)), list(range(1, len(unit) + 1))
    heap: list[tuple[float, int, int, str]] = []

    def push(a: int, b: int) -> None:
        if a >= 0 and b < len(parts) and (x := table.get(parts[a] + parts[b])):
            heapq.heappush(heap, (-x[1], a, b, parts[a] + parts[b]))

    for i in range(len(unit) - 1):
        push(i, i + 1)
    while heap:
        _, a, b, whole = heapq.heappop(heap)
        if not parts[a] or not parts[b] or parts[a] + parts[b] != whole or right[a] != b:
            continue
        parts[a], parts[b] = whole, ""
        right[a] = right[b]
        if right[b] < len(parts):
            left[right[b]] = a
        push(left[a], a)
        push(a, right[a])
    return [i for p in parts if p for i in ([table[p][0]] if p in table else unknown(p))]


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """piece, id, score, code of all pieces that text can become. code: place by score (best first), stop (a merge of the piece may open one of a better place), id."""
    rows = vocabulary.table()
    if len(vocabulary.pieces) > 1 << ID_BITS:
        raise ValueError("too many pieces")
    early = vocabulary.early() if vocabulary.kind == BPE else set()
    place = {score: i for i, score in enumerate(sorted({s for _, s in rows.values()}, reverse=True))}
    code = [place[s] << PLACE_AT | (p in early) << ID_BITS | i for p, (i, s) in rows.items()]
    return spark.createDataFrame(pa.table({"piece": list(rows), "id": pa.array([i for i, _ in rows.values()], pa.int32()), "score": pa.array([s for _, s in rows.values()], pa.float64()), "code": pa.array(code, pa.int64())}))


def _unknown_sql(vocabulary: Vocabulary, char: str) -> str:
    ids = vocabulary.byte_ids()
    if not ids:
        return f"array({vocabulary.pieces.index('<unk>')})"
    first = ids[0]
    if any(ids[b] != first + b for b in range(256)):
        raise ValueError("byte pieces must have consecutive ids")
    return f"transform(sequence(1, octet_length({char})), o -> cast(conv(substring(hex({char}), 2 * o - 1, 2), 16, 10) as int) + {first})"


def folded(grouped: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ids to rows of unit, edges (sorted; of a unigram model array<struct<rank, i, j, id>>, of a BPE model array<struct<code, ends, inner>>: best piece first, then leftmost)."""
    unknown = lambda at: _unknown_sql(vocabulary, f"substring(unit, {at}, 1)")
    if vocabulary.kind != BPE:
        # Viterbi: state j holds the best path to place j; the later start on ties.
        low = min((s for s, t in zip(vocabulary.scores, vocabulary.types, strict=True) if t == NORMAL), default=0.0) - UNKNOWN_PENALTY
        none = "cast(array() as array<struct<v: double, i: int, ids: array<int>>>)"
        into = "transform(filter(edges, e -> e.j = j), e -> named_struct('v', s[e.i].v - e.rank, 'i', e.i, 'ids', array(e.id)))"
        alone = f"if(exists(edges, e -> e.j = j and e.i = j - 1), {none}, array(named_struct('v', s[j - 1].v + cast({low} as double), 'i', j - 1, 'ids', {unknown('j')})))"
        path = f"aggregate(sequence(1, length(unit)), array(named_struct('v', 0D, 'i', -1, 'ids', cast(array() as array<int>))), (s, j) -> concat(s, array(array_max(concat({into}, {alone})))))"
        back = "aggregate(sequence(1, length(unit)), named_struct('at', length(unit), 'ids', cast(array() as array<int>)), (a, t) -> if(a.at <= 0, a, named_struct('at', path[a.at].i, 'ids', concat(path[a.at].ids, a.ids))), a -> a.ids)"
        return grouped.withColumn("path", F.expr(path)).withColumn("ids", F.expr(back)).drop("path", "edges")
    # Merges: the mask has a bit for every place where a part begins, the end included. An edge can be merged when parts
    # begin at both its ends and at exactly one place between them; the first such edge has the best score. A merge of most
    # pieces opens no better one, so the edges behind it can be gone on with; after others, which set the mask's sign, the edges are
    # gone through again from the first: that is at most once a merge.
    sweep = f"aggregate(edges, s & ~shiftleft(1L, 63), (m, e) -> if(m >= 0 and (m & e.ends) = e.ends and bit_count(m & e.inner) = 1, (m & ~e.inner) | (shiftleft(e.code, {63 - ID_BITS}) & shiftleft(1L, 63)), m))"
    mask = f"aggregate(sequence(1, length(unit)), (shiftleft(2L, length(unit)) - 1) | shiftleft(1L, 63), (s, t) -> if(s >= 0, s, {sweep})) & ~shiftleft(1L, 63)"
    # Parts in order of their begins.
    parts = f"sort_array(transform(filter(edges, e -> (mask & e.ends) = e.ends and (mask & e.inner) = 0), e -> e.code & {(1 << PLACE_AT) - 1}L))"
    begins = "filter(sequence(0, length(unit) - 1), p -> (mask & shiftleft(1L, p)) != 0)"
    part_id, part_at = f"cast(e & {(1 << ID_BITS) - 1} as int)", f"shiftright(e, {FROM_AT})"
    mended = f"flatten(transform({begins}, p -> if(exists(parts, e -> {part_at} = p), transform(filter(parts, e -> {part_at} = p), e -> {part_id}), {unknown('p + 1')})))"
    ids = f"case when length(unit) > {MASK_UNIT} then null when size(parts) = bit_count(mask) - 1 then transform(parts, e -> {part_id}) else {mended} end"
    masked = grouped.withColumn("mask", F.expr(f"if(length(unit) > {MASK_UNIT}, 0L, {mask})"))
    return masked.withColumn("parts", F.expr(parts)).withColumn("ids", F.expr(ids)).drop("parts", "mask", "edges")


def encode_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The input (distinct units, hash-partitioned by unit, with other columns) with ids; null where a BPE unit is too long for the mask.

    The edges of a unit are made where the unit is, so grouping them moves nothing.
    """
    pieces = F.broadcast(piece_table(units.sparkSession, vocabulary))
    longest = max(map(len, vocabulary.table()))
    reach = f"if(length(unit) > {MASK_UNIT}, 1, {longest})" if vocabulary.kind == BPE else f"{longest}"
    others = [c for c in units.columns if c != "unit"]
    spread = units.withColumn("i", F.explode(F.expr("sequence(0, length(unit) - 1)"))).withColumn("j", F.explode(F.expr(f"sequence(i + 1, least(i + {reach}, length(unit)))")))
    edges = spread.withColumn("piece", F.expr("substring(unit, i + 1, j - i)")).join(pieces, "piece", "left").filter("id is not null or (i = 0 and j = 1)")
    if vocabulary.kind == BPE:
        masks = (F.expr("shiftleft(1L, i) | shiftleft(1L, j)").alias("ends"), F.expr("shiftleft(1L, j) - shiftleft(2L, i)").alias("inner"))
        edge = F.when(F.expr(f"id is not null and length(unit) <= {MASK_UNIT}"), F.struct(F.expr(f"code | shiftleft(cast(i as bigint), {FROM_AT})").alias("code"), *masks))
    else:
        edge = F.when(F.col("id").isNotNull(), F.struct((-F.col("score")).alias("rank"), "i", "j", "id"))
    grouped = edges.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"), *(F.first(c).alias(c) for c in others))
    return folded(grouped, vocabulary)


class Cache:
    """Units with their ids as an Arrow table's bytes: what the driver holds and broadcasts. A worker unpacks them once."""

    def __init__(self, table: pa.Table):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        self.packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())

    def __getstate__(self) -> bytes:
        return self.packed

    def __setstate__(self, packed: bytes) -> None:
        self.packed = packed

    @cached_property
    def known(self) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Units, how many ids each has, and their ids one after the other."""
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self.packed)) as stream:
            return _by_unit(stream.read_all())


def _by_unit(table: pa.Table) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    units, ids = (pa.concat_arrays([pa.array([], table.schema.field(c).type), *table.column(c).chunks]) for c in ("unit", "ids"))
    return units.cast(pa.string()), pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64), ids.flatten().to_numpy().astype(np.int32)


def _hot_units(kept: DataFrame, share: float, vocabulary: Vocabulary, tasks: int) -> Cache:
    """The most frequent units of a bounded sample with their ids: a cache, at most HOT units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = tools(vocabulary)[0]
        for batch in batches:
            for _, texts in slices(batch, "text"):
                counted = cutter.words(pa.array(texts, pa.string()))[0].value_counts()
                times, at = counted.field("counts").to_numpy(), 0
                for words in word_blocks(counted.field("values")):
                    units, bounds = cutter.units(words)
                    coded = units.dictionary_encode()
                    n = np.bincount(coded.indices.to_numpy(), np.repeat(times[at : at + len(words)], np.diff(bounds)))
                    at += len(words)
                    yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], names=["unit", "n"])

    sample = kept.filter(sample_key(F.col("id"), F.lit("pieces")) < share).select("text")
    counts = sample.mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    top = counts.filter(F.length("unit") <= MASK_UNIT).orderBy(F.desc("n"), "unit").limit(HOT).select("unit").repartition(tasks, "unit")
    cache = Cache(encode_units(top, vocabulary).select("unit", "ids").toArrow())
    pa.default_memory_pool().release_unused()
    return cache


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, n_tokens, decoded_ok (decoding gives the text back) of every row."""
    vocabulary = vocabulary or Vocabulary.load()
    spark = docs.sparkSession
    kept = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows, chars = kept.agg(F.count("*"), F.sum(F.length("text"))).first()
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(chars or 0) // BUCKET_CHARS))
    hot = spark.sparkContext.broadcast(_hot_units(kept, SAMPLE_DOCS / max(1, rows), vocabulary, buckets))
    keyed = kept.withColumn("bucket", F.pmod(F.xxhash64("id", "text"), F.lit(buckets)).cast("int"))
    dealt = keyed.mapInArrow(_pack, "bucket int, blob binary").repartition(buckets, "bucket")

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = tools(vocabulary)[0], hot.value.known[0]
        seen: dict[int, list[pa.StringArray]] = {}
        for batch in batches:
            for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
                own = seen.setdefault(b, [])
                own.append(cutter.words(_unpack(blob)[1])[0].unique())
                if len(own) > BLOBS:
                    own[:] = [pa.chunked_array(own).unique()]
        for b, own in seen.items():
            words = pa.chunked_array(own).unique()
            units = pa.chunked_array([cutter.units(w)[0].unique() for w in word_blocks(words)], pa.string()).unique()
            units = units.filter(pc.invert(pc.is_in(units, value_set=known)))
            for a in range(0, len(units), 50_000):
                some = units[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([b] * len(some), pa.int32()), some], names=["bucket", "unit"])

    # A fixed number of partitions: small as the units are, their edges are many, so they must not be coalesced.
    wanted = dealt.mapInArrow(rare, "bucket int, unit string").repartition(buckets, "unit").groupBy("unit").agg(F.collect_set("bucket").alias("buckets"))
    found = encode_units(wanted, vocabulary).select(F.explode("buckets").alias("bucket"), "unit", "ids")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        cutter, table, names = tools(vocabulary)
        short = right.column("ids").is_valid()
        unmerged = right.filter(pc.invert(short)).column("unit").to_pylist()
        merged = [merge_parts(u, table, vocabulary.unknown_ids) for u in unmerged]
        own = (pa.array(unmerged, pa.string()), np.array([len(m) for m in merged], np.int64), np.array([i for m in merged for i in m], np.int32))
        units, sizes, ids = zip(hot.value.known, _by_unit(right.filter(short)), own, strict=True)
        units, sizes, ids = pa.concat_arrays(units), np.concatenate(sizes), np.concatenate(ids)
        begins = bounds_of(sizes)[:-1]

        def encoded(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """How many ids each word has, these ids, and whether they don't decode to the word alone."""
            found, bounds = cutter.units(words)
            coded = found.dictionary_encode()
            at = pc.index_in(coded.dictionary, value_set=units).to_numpy()[coded.indices.to_numpy()]
            values = ids[ragged(begins[at], sizes[at])]
            ends = bounds_of(sizes[at])[bounds]
            return np.diff(ends), values, names.differing(values, ends, words)

        out = [pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)]
        blobs = left.column("blob")
        for first in range(0, len(blobs), BLOBS):
            keys, cut, spans = [], [], []
            for blob in blobs[first : first + BLOBS]:
                own_keys, texts = _unpack(blob)
                words, bounds = cutter.words(texts)
                keys.append(own_keys)
                cut.append(words)
                spans.append(bounds)
            coded = pa.chunked_array(cut, pa.string()).dictionary_encode().chunks  # of one dictionary; empty ones are left out
            codes = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in coded)])
            done = [encoded(w) for w in word_blocks(coded[0].dictionary)] if coded else []
            del cut, coded
            n, values, odd = (np.concatenate([np.zeros(0, t), *(d[i] for d in done)]) for i, t in enumerate((np.int64, np.int32, bool)))
            at, begin = bounds_of(n)[:-1], 0
            for k, (own_keys, bounds) in enumerate(zip(keys, spans, strict=True)):
                code = codes[begin : begin + int(bounds[-1])]
                begin += int(bounds[-1])
                got, ends = values[ragged(at[code], n[code])], bounds_of(n[code])[bounds]
                ok = np.ones(len(own_keys), bool)
                # Words decode to themselves, so a text does; one with an odd word is decoded whole.
                held = np.flatnonzero(np.diff(bounds_of(odd[code])[bounds])).tolist()
                texts = _unpack(blobs[first + k])[1] if held else ()
                for i in held:
                    ok[i] = names.text(got[ends[i] : ends[i + 1]]) == texts[i].as_py().replace(SPACE, " ")
                listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(got))
                out.append(pa.RecordBatch.from_arrays([pa.array(own_keys, pa.int64()), listed, pa.array(np.diff(ends)), pa.array(ok)], schema=schema))
        return pa.Table.from_batches(out)

    schema = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded_ok", pa.bool_())])
    return dealt.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(assemble, f"`{id_col}` long, ids array<int>, n_tokens long, decoded_ok boolean")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket as compressed blobs of ids and texts: half the bytes to shuffle. At most PACK_TOTAL characters are held."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    held: dict[int, tuple[list, list]] = {}
    sizes: Counter[int] = Counter()

    def flush(buckets: list[int]) -> pa.RecordBatch:
        blobs = [squeeze(pickle.dumps(held.pop(b), 5)) for b in buckets]
        for b in buckets:
            del sizes[b]
        return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    for batch in batches:
        total = sizes.total()
        for key, text, b in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("bucket").to_pylist(), strict=True):
            text = text.as_py()
            keys, texts = held.setdefault(b, ([], []))
            keys.append(key)
            texts.append(text)
            sizes[b] += len(text)
            total += len(text)
            if sizes[b] > PACK_CHARS:
                total -= sizes[b]
                yield flush([b])
            elif total > PACK_TOTAL:
                yield flush(list(held))
                total = 0
    if held:
        yield flush(list(held))


def _unpack(blob: pa.Scalar) -> tuple[list, pa.StringArray]:
    keys, texts = pickle.loads(zstandard.ZstdDecompressor().decompress(blob.as_py()))
    return keys, pa.array(texts, pa.string())


class Decoder:
    """Ids back to text: pieces joined, byte pieces as UTF-8, meta spaces as spaces, the leading one dropped."""

    def __init__(self, vocabulary: Vocabulary):
        single = {i: bytes([b]) for b, i in vocabulary.byte_ids().items()}
        shown = (NORMAL, USER_DEFINED)
        self.raw = [single[i] if i in single else p.replace(SPACE, " ").encode("utf-8") if t in shown else b"" for i, (p, t) in enumerate(zip(vocabulary.pieces, vocabulary.types, strict=True))]
        self.prefix = vocabulary.prefix
        self.sizes = np.array([len(r) for r in self.raw], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.raw), np.uint8)

    def differing(self, ids: np.ndarray, ends: np.ndarray, words: pa.StringArray) -> np.ndarray:
        """Whether the ids of each word (bounds: ends) don't decode to it: all are compared at once, one by one only if that fails."""
        sizes = self.sizes[ids]
        got_ends = bounds_of(sizes)[ends]
        got = self.bytes[ragged(self.begins[ids], sizes)]
        raw, raw_ends = joined(" " if self.prefix else "", words)
        if np.array_equal(got_ends, raw_ends) and np.array_equal(got, raw):
            return np.zeros(len(words), bool)
        got, raw = got.tobytes(), raw.tobytes()
        return np.array([got[a:b] != raw[c:d] for a, b, c, d in zip(got_ends[:-1].tolist(), got_ends[1:].tolist(), raw_ends[:-1].tolist(), raw_ends[1:].tolist(), strict=True)], bool)

    def text(self, ids: np.ndarray) -> str:
        found = b"".join([self.raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return found[1:] if self.prefix and found.startswith(" ") else found


def decode(rows: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text of rows of ids; null ids decode to ""."""
    vocabulary = vocabulary or Vocabulary.load()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = tools(vocabulary)[2]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([names.text(np.array(i or [], np.int64)) for i in batch.column(1).to_pylist()], pa.string())], names=[id_col, "text"])

    return rows.select(F.col(id_col).cast("long").alias(id_col), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, f"`{id_col}` long, text string")
