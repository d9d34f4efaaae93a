"""Personal data: base spans by fixed patterns, further spans chosen from candidates by boosted trees.

Everything on the data's path is a DataFrame expression; numpy is used by the driver alone, to train on a bounded
sample of candidates.

- Base kinds (email, ip, card, phone) are leftmost non-overlapping matches that pass their kind's check.
- High-recall generators (number, secret, address) propose spans, which may overlap each other and the base.
- A candidate has format features (length, digits, letters, separators, groups, upper case) and context features
  (letters and digits beside it, assignment, keyword before). Gradient boosted trees score it; the trees are
  CASE expressions.
- The trees learn from weak labels: a number that is a valid card or phone, an address that is a valid email, a
  secret that is assigned to a keyword. What the label is made of is no feature, so the trees generalise
  to the format. Thresholds are calibrated per kind on the part of the sample that isn't trained on: the lowest
  score that keeps MIN_PRECISION there; a kind without such a score selects nothing.
- Selected candidates that overlap no base span are added.

Positions are code points, found without Python: splitting a text by a pattern gives its gaps, and the lengths
of gaps and matches before a match sum up to its start. All patterns are written so that neither a long run nor a
long list makes the matcher recurse or start over at every character.

Defined results: null and empty texts have no spans; repeated rows give equal results; an empty table gives no
rows (and no trees); an input without candidates of both labels gets base spans alone; columns other than doc_id
and text are ignored by find_spans, redacted keeps all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import saved
from ._text import sample_key

# The contract's patterns. Possessive loops match the same texts without recursion; a match starts at
# the end of the last one or where no character of its first run stands before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = tuple(PATTERNS)
GENERATORS = {
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?[\[(]at[\])]\x20?|@)[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]++)*+",
    "number": r"(?:\G|(?<![0-9]))\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "secret": r"(?:\G|(?<![A-Za-z0-9_-]))(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+",
}
EXTRA = tuple(GENERATORS)
#: What any base span or candidate holds; a text without it is not searched.
ANY = r"[0-9@]|[\[(]at[\])]"
CONTEXT = 24
SAMPLE_DOCS = 8_000
SAMPLE_CANDIDATES = 20_000
ROUNDS, RATE, BINS = 12, 0.4, 16
MIN_PRECISION = 0.98
MIN_SUPPORT = 10
#: An assignment to a word that names a secret (fixed value).
ASSIGNED = r"(?i)(?:token|secret|password|passwd|api[_-]?key|key|auth)[\"']?\s{0,3}[:=]\s{0,3}[\"']?$"
FEATURES = ("length", "digits", "letters", "uppers", "groups", "seps", "letter_before", "digit_before", "letter_after")
#: Elements per chunk of a prefix sum.
CHUNK = 64


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The checksum of a digit string; every second digit from the right counts double."""
    doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    values = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(doubled(d.cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        stripped = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(stripped, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(_digits(match)).between(16, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def matched(df: DataFrame, text: str, patterns: dict[str, str], starts: bool = True) -> DataFrame:
    """Per kind the columns g_kind (gaps), m_kind (matches) and p_kind (starts); null where a text has no match.

    Each step is a projection of its own: an array that later steps read often is computed once. Starts are prefix
    sums in chunks, so a long list of matches costs little more than its length.
    """
    searched = F.col(text).rlike(ANY)
    df = df.withColumns({f"g_{k}": F.when(searched, F.split(text, p, -1)) for k, p in patterns.items()})
    df = df.withColumns({f"m_{k}": F.when(F.size(f"g_{k}") > 1, F.regexp_extract_all(text, F.lit(p), F.lit(0))) for k, p in patterns.items()})
    if not starts:
        return df
    when = lambda k, sql: F.expr(f"if(m_{k} is null, null, {sql})")
    add = "0L, (a, b) -> a + b"
    df = df.withColumns({f"l_{k}": when(k, f"transform(m_{k}, (x, i) -> cast(length(g_{k}[i]) + length(x) as bigint))") for k in patterns})
    df = df.withColumns({f"c_{k}": when(k, f"transform(sequence(0, (size(l_{k}) - 1) div {CHUNK}), c -> aggregate(slice(l_{k}, cast(c * {CHUNK} + 1 as int), {CHUNK}), {add}))") for k in patterns})
    df = df.withColumns({f"h_{k}": when(k, f"aggregate(c_{k}, named_struct('t', 0L, 'h', cast(array() as array<bigint>)), (a, b) -> named_struct('t', a.t + b, 'h', concat(a.h, array(a.t))), a -> a.h)") for k in patterns})
    df = df.withColumns({f"p_{k}": when(k, f"transform(m_{k}, (x, i) -> h_{k}[cast(i div {CHUNK} as int)] + aggregate(slice(l_{k}, cast(i div {CHUNK} * {CHUNK} + 1 as int), cast(i % {CHUNK} as int)), {add}) + length(g_{k}[i]))") for k in patterns})
    return df.drop(*(f"{c}_{k}" for c in "lch" for k in patterns))


def _features(match: Column, before: Column, after: Column) -> Column:
    """Format and context of a candidate; no feature repeats the check behind its weak label."""
    count = lambda s, p: F.regexp_count(s, F.lit(p)).cast("double")
    values = (
        F.length(match).cast("double"),
        count(match, "[0-9]"),
        count(match, "[A-Za-z]"),
        count(match, "[A-Z]"),
        count(match, "[0-9]+"),
        count(match, "[^A-Za-z0-9]"),
        before.rlike(r"\p{L}$").cast("double"),
        before.rlike("[0-9]$").cast("double"),
        after.rlike(r"^\p{L}").cast("double"),
    )
    return F.array(*values)


def _weak_label(kind: str, match: Column, before: Column) -> Column:
    if kind == "number":
        return valid("card", match) | (before.endswith("+") & valid("phone", match))
    if kind == "address":
        return F.when(match.contains("@"), match.contains("."))  # written-out addresses carry no label
    return before.rlike(ASSIGNED)


def _candidates(kind: str) -> Column:
    """array<struct<match, start, before, after>> of one generator."""
    g, m, p = F.col(f"g_{kind}"), F.col(f"m_{kind}"), F.col(f"p_{kind}")
    return F.transform(m, lambda x, i: F.struct(x.alias("match"), p[i].alias("start"), F.right(g[i], F.lit(CONTEXT)).alias("before"), F.left(g[i + 1], F.lit(1)).alias("after")))


@dataclass(frozen=True)
class Trees:
    """Boosted trees of depth 2: (feature, cut, (feature, cut, low, high), (feature, cut, low, high)); bias; the calibrated threshold."""

    trees: tuple
    bias: float
    threshold: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for f, c, left, right in self.trees:
            sides = [np.where(x[:, s[0]] <= s[1], s[2], s[3]) for s in (left, right)]
            total += np.where(x[:, f] <= c, *sides)
        return total

    def chosen(self, features: Column) -> Column:
        leaf = lambda s: F.when(features[s[0]] <= s[1], F.lit(s[2])).otherwise(F.lit(s[3]))
        total = F.lit(self.bias)
        for f, c, left, right in self.trees:
            total = total + F.when(features[f] <= c, leaf(left)).otherwise(leaf(right))
        return total >= self.threshold


def _split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, int, float, float, float]:
    """Best gain, feature, cut and the Newton steps of both sides over quantile cuts."""
    step = lambda m: float(-RATE * grad[m].sum() / (hess[m].sum() + 1.0))
    worth = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1.0)
    best = (0.0, 0, float("inf"), step(rows), 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[rows, f])
        cuts = (values[:-1] + values[1:]) / 2
        for cut in cuts[np.unique(np.linspace(0, len(cuts) - 1, BINS).astype(int))] if len(cuts) else ():
            low = rows & (x[:, f] <= cut)
            high = rows & ~low
            gain = worth(low) + worth(high) - worth(rows)
            if gain > best[0] + 1e-9:
                best = (float(gain), f, float(cut), step(low), step(high))
    return best


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> Trees | None:
    """Gradient boosting on three quarters of the rows, calibration on the rest; None if nothing reaches MIN_PRECISION. A row stands for w rows."""
    w = np.ones(len(y)) if w is None else w
    held = np.arange(len(y)) % 4 == 3
    if min(y[~held].sum(), (1 - y[~held]).sum()) < MIN_SUPPORT:
        return None
    tx, ty, tw = x[~held], y[~held].astype(float), w[~held]
    rate = np.average(ty, weights=tw)
    bias = float(np.log(rate / (1 - rate)))
    margin, trees = np.full(len(ty), bias), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = (p - ty) * tw, p * (1 - p) * tw
        everything = np.ones(len(ty), bool)
        _, f, cut, *_ = _split(tx, grad, hess, everything)
        side = tx[:, f] <= cut
        left, right = (_split(tx, grad, hess, m)[1:] for m in (side, ~side))
        trees.append((f, cut, left, right))
        margin += np.where(side, *(np.where(tx[:, s[0]] <= s[1], s[2], s[3]) for s in (left, right)))
    model = Trees(tuple(trees), bias, 0.0)
    score, truth = model.margin(x[held]), y[held]
    order = np.argsort(-score, kind="stable")
    hits, picked = np.cumsum((truth * w[held])[order]), np.cumsum(w[held][order])
    ok = [i for i in range(len(order)) if (i + 1 == len(order) or score[order[i + 1]] < score[order[i]]) and i + 1 >= MIN_SUPPORT and hits[i] >= MIN_PRECISION * picked[i]]
    return Trees(model.trees, bias, float(score[order[ok[-1]]]) - 1e-9) if ok else None


def fit(docs: DataFrame) -> dict[str, Trees]:
    """Trees per generator, from candidates of about SAMPLE_DOCS documents (by a hash of the id), SAMPLE_CANDIDATES per kind at most, half of them of each label; weights keep the labels' shares."""
    share = SAMPLE_DOCS / max(1, docs.count())
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(sample_key(F.coalesce("doc_id", F.lit(0)), F.lit("pii")) < share)
    found = matched(sample, "text", GENERATORS)

    def examples(k: str) -> Column:
        return F.transform(_candidates(k), lambda c: F.struct(F.lit(k).alias("kind"), _features(c["match"], c["before"], c["after"]).alias("x"), _weak_label(k, c["match"], c["before"]).cast("int").alias("y"), c["start"].alias("start")))

    listed = found.select("doc_id", F.explode(F.flatten(F.array_compact(F.array(*map(examples, EXTRA))))).alias("c")).select("doc_id", "c.*").filter("y is not null")
    listed = saved(listed.select("kind", "x", "y", F.xxhash64("doc_id", "start", "kind").alias("r")))
    counts = {(r.kind, r.y): r.n for r in listed.groupBy("kind", "y").agg(F.count("*").alias("n")).collect()}
    models = {}
    for kind in EXTRA:
        x, y, w, r = [], [], [], []
        for label in (0, 1):
            if n := counts.get((kind, label), 0):
                rows = listed.filter((F.col("kind") == kind) & (F.col("y") == label)).orderBy("r", "x").limit(SAMPLE_CANDIDATES // 2).select("r", "x").toArrow().combine_chunks()
                x.append(rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)))
                r.append(rows["r"].to_numpy())
                y.append(np.full(len(rows), label))
                w.append(np.full(len(rows), n / len(rows)))
        if x:
            x, y, w, r = map(np.concatenate, (x, y, w, r))
            order = np.lexsort((*x.T[::-1], y, r))
            if trees := boost(x[order], y[order], w[order]):
                models[kind] = trees
    return models


def find_spans(docs: DataFrame, models: dict[str, Trees], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and, per kind, the column kind: array<struct<start, end>> in code points, in order of start."""
    df = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    df = matched(df, "__text", PATTERNS | {k: GENERATORS[k] for k in models})
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    span = lambda start, match: F.struct(start.alias("start"), (start + F.length(match)).cast("long").alias("end"))

    def passed(k: str) -> Column:
        listed = F.transform(f"m_{k}", lambda x, i: F.when(valid(k, x), span(F.col(f"p_{k}")[i], x)))
        return F.coalesce(F.array_compact(listed), none)

    def chosen(k: str) -> Column:
        if k not in models:
            return none
        # A candidate that is a base match itself needs no search among the base spans.
        known = lambda c: F.lit(False) if k == "secret" else F.coalesce(_weak_label(k, c["match"], c["before"]), F.lit(False))
        new = F.filter(_candidates(k), lambda c: ~known(c) & models[k].chosen(_features(c["match"], c["before"], c["after"])))
        apart = F.filter(F.transform(new, lambda c: span(c["start"], c["match"])), lambda s: ~F.exists(F.concat(*map(F.col, BASE)), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.coalesce(apart, none)

    df = df.withColumns({k: passed(k) for k in BASE})
    extra = {k: chosen(k) for k in EXTRA}
    return df.withColumns(extra).select(id_col, *BASE, *EXTRA)


def contract(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans."""
    df = find_spans(docs, fit(docs))
    listed = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"], s["end"]))
    text = lambda kinds: F.array_join(F.concat(*map(listed, kinds)), ",")
    return df.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(text(BASE).cast("binary"), 256).alias("base_sha256"), text(BASE + EXTRA).alias("spans"))


def _redactor(kind: str, g: Column, m: Column, models: dict[str, Trees]):
    """Gap i with what follows it: the match, or its kind if it is to go."""

    def piece(gap: Column, i: Column) -> Column:
        x = F.get(m, i)
        ok = valid(kind, x) if kind in BASE else models[kind].chosen(_features(x, F.right(gap, F.lit(CONTEXT)), F.left(F.get(g, i + 1), F.lit(1))))
        return F.concat(gap, F.when(x.isNull(), "").when(ok, f"[{kind.upper()}]").otherwise(x))

    return piece


def redacted(docs: DataFrame, models: dict[str, Trees], text_col: str = "text") -> DataFrame:
    """The input with every found piece replaced by its kind in brackets, one kind after the other, long ones first."""
    kept = docs.columns
    for kind in ("email", "address", "secret", "card", "phone", "ip", "number"):
        if kind not in BASE and kind not in models:
            continue
        pattern = PATTERNS.get(kind) or GENERATORS[kind]
        docs = matched(docs, text_col, {kind: pattern}, starts=False)
        g, m = F.col(f"g_{kind}"), F.col(f"m_{kind}")

        whole = F.array_join(F.transform(g, _redactor(kind, g, m, models)), "")
        docs = docs.withColumn(text_col, F.when(m.isNotNull(), whole).otherwise(F.col(text_col))).select(*map(_quoted, kept))
    return docs


def _quoted(name: str) -> str:
    return f"`{name}`"
