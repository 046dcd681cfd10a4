"""Personal data: exact patterns, and further spans that boosted trees choose among candidates.

Base spans are those of four patterns with their checks. High-recall generators propose further spans, also
overlapping ones: addresses spelled out (``a (at) b dot c``), numbers with unusual separators, telephone
numbers without a country code. A candidate is brought to its plain form, and described by small numbers:
its digits and groups, whether the plain form passes the check of its kind, what stands around it. Boosted
trees learn from all candidates which of these look like base spans of their kind (the others count as
not), and each kind has the lowest threshold that keeps PRECISION on documents set aside. What passes,
and overlaps no base span, is added.

All work on texts is SQL functions: matches and the gaps between them give the positions. The driver gets
the counts of all descriptions, from which the trees are grown. A description is eight small numbers, so however
large the table, there are no more than their ranges allow.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.llm.steps import written

KINDS = ("email", "ip", "card", "phone")
ROUNDS, RATE, SMOOTH, LEAST = 24, 0.4, 1.0, 5
PRECISION = 0.8
NAME, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

# Matches are leftmost and greedy. Loops are possessive where they cannot end elsewhere, which Java runs without
# recursion; looking back (or at the end of the last match) leaves out starts inside a run that has failed.
BASE = (
    rf"(?:\G|(?<!{NAME})){NAME}++@{HOST}++(?:\.{HOST}++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # the chain of digits, from its first: shorter ones than 13 are no result
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
# What must be in a text for a pattern to match; cheaper than the pattern.
BASE_NEEDS = (r"@", r"[0-9]\.[0-9]", r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", r"\+[0-9]")
AT, DOT = r"(?:@|\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT)\x20)", r"(?:\.|\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20)"
GENERATORS = (
    (0, rf"(?<!{NAME}){NAME}++{AT}{HOST}++(?:{DOT}{HOST}++)*+", r"@|[\[({<]\x20?(?:at|AT)|\x20(?:at|AT)\x20[A-Za-z0-9-]{1,63}(?:\.[A-Za-z]|\x20?[\[({<]?\x20?(?:dot|DOT))"),
    (1, rf"(?<![0-9])[0-9]{{1,9}}+(?:{DOT}[0-9]{{1,9}}+){{3,}}+", r"[0-9](?:\.|\x20?[\[({<]|\x20dot)"),
    (2, r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}+[0-9]){12,}+", BASE_NEEDS[2]),
    (3, r"(?<![0-9A-Za-z+(])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])", r"[0-9]\)?[\x20./-]{1,2}[0-9]"),
)
# Words before a candidate that say what it is (fixed values).
CUES = r"(?i)(mail|contact|reach|write|phone|tel|call|fax|mobile|card|visa|account|credit|host|server|address|\bip\b)[^\n]{0,12}$"
FEATURES = ("digits", "groups", "widest", "brackets", "before", "after", "checked", "cue")
RISING = ("checked", "cue")


def found(text: Column, pattern: str, needs: str, kind: int) -> Column:
    """array<struct<kind, start, stop, m>> of all matches; positions in code points, the end exclusive."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.expr("CAST(ARRAY() AS ARRAY<STRUCT<kind: INT, start: INT, stop: INT, m: STRING>>)")

    def step(state: Column, pair: Column) -> Column:
        start = state["stop"] + F.length(pair["gap"])
        stop = start + F.length(pair["m"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), pair["m"].alias("m"))
        return F.struct(stop.alias("stop"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(m.alias("m"), g.alias("gap")))
    first = F.struct(F.lit(0).alias("stop"), none.alias("out"))
    return F.when(text.rlike(needs), F.aggregate(pairs, first, step, lambda s: s["out"])).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _small_parts(m: Column) -> Column:
    """Four numbers of at most 255."""
    parts = F.split(m, r"\.", -1)
    return (F.size(parts) == 4) & F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255"))


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    places = F.transform(F.split(F.substring(d, 1, 19), ""), lambda c, i: F.when(c == "", 0).otherwise(
        F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0))))
    return F.length(d).between(13, 19) & (F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0)


CHECKS = (lambda m: F.lit(True), _small_parts, _luhn, lambda m: F.length(_digits(m)).between(9, 15))


def base_spans(text: Column) -> Column:
    """The base spans of a text, by kind as listed and then by start."""
    def of(kind: int) -> Column:
        return F.filter(found(text, BASE[kind], BASE_NEEDS[kind], kind), lambda s: CHECKS[kind](s["m"]))

    return F.concat(*map(of, range(4)))


def _plain(kind: Column, m: Column) -> Column:
    """The plain form of a candidate."""
    dotted = F.regexp_replace(m, DOT, ".")
    return F.when(kind == 0, F.regexp_replace(dotted, AT, "@")).when(kind == 1, dotted).otherwise(m)


def _class(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[A-Za-z]$"), 2).when(c.rlike("^[0-9]$"), 3)
            .when(c.rlike("""^["'=:(\\[<]$"""), 4).otherwise(5))


def _least(c: Column, most: int) -> Column:
    return F.least(c, F.lit(most)).cast("int")


def described(text: Column, s: Column) -> Column:
    """A candidate with its features, all small numbers."""
    m = _plain(s["kind"], s["m"])
    checked = (F.when(s["kind"] == 0, m.rlike(r"@[A-Za-z0-9-].*\.[A-Za-z]{2,6}$")).when(s["kind"] == 1, _small_parts(m))
               .when(s["kind"] == 2, _luhn(m)).otherwise(F.length(_digits(m)).between(9, 15)))
    # the text before and after is cut out of a few characters only
    before = F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24)))
    return F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
        _least(F.length(_digits(m)), 20).alias("digits"), _least(F.size(F.split(m, "[A-Za-z0-9]++", -1)) - 1, 9).alias("groups"),
        _least(F.array_max(F.transform(F.split(m, "[^0-9]++", -1), lambda x: F.length(x))), 20).alias("widest"),
        m.contains("(").cast("int").alias("brackets"), _class(F.right(before, F.lit(1))).alias("before"),
        _class(F.substring(text, s["stop"] + 1, F.lit(1))).alias("after"), checked.cast("int").alias("checked"), before.rlike(CUES).cast("int").alias("cue"))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def candidates(text: Column, base: Column) -> Column:
    """Described candidates of all generators, each with ``label``: does it overlap a base span of its kind, and ``free``: none of any kind."""
    proposed = F.concat(*[found(text, pattern, needs, k) for k, pattern, needs in GENERATORS])
    return F.transform(proposed, lambda s: F.struct(
        described(text, s).alias("c"), F.exists(base, lambda b: (b["kind"] == s["kind"]) & _overlap(b, s)).alias("label"),
        (~F.exists(base, lambda b: _overlap(b, s))).alias("free")))


# --- boosted trees over counts of descriptions ---------------------------------------------------

Row = tuple[tuple[int, ...], int, int]  # a description, how many with it are alike a base span, how many are not


class Counts(NamedTuple):
    """Descriptions, one a row, and how many candidates with each are alike a base span and are not."""

    vectors: np.ndarray
    yes: np.ndarray
    no: np.ndarray

    @classmethod
    def of(cls, rows: list[Row] | Counts) -> Counts:
        if isinstance(rows, Counts):
            return rows
        return cls(np.array([r[0] for r in rows], np.int64).reshape(-1, len(FEATURES)), *(np.array([r[i] for r in rows], np.int64) for i in (1, 2)))

    def some(self, which: np.ndarray) -> Counts:
        return Counts(self.vectors[which], self.yes[which], self.no[which])


def _split(rows: Counts, g: np.ndarray, h: np.ndarray):
    """(gain, feature, value) of the best cut: up to the value, and above. Both sides have LEAST candidates or
    more, and where a larger value can only speak for a span, the side above is not the lower one."""
    number = rows.yes + rows.no
    all_g, all_h, n = float(g.sum()), float(h.sum()), int(number.sum())
    best = (0.0, -1, 0)
    for f, name in enumerate(FEATURES):
        values, place = np.unique(rows.vectors[:, f], return_inverse=True)
        sums = [np.cumsum(np.bincount(place, x, len(values))).tolist() for x in (g, h, number)]
        for value, left_g, left_h, left_n in list(zip(values.tolist(), *sums))[:-1]:
            low, high = left_g / (left_h + SMOOTH), (all_g - left_g) / (all_h - left_h + SMOOTH)
            if min(left_n, n - left_n) < LEAST or (name in RISING and high < low):
                continue
            gain = left_g * low + (all_g - left_g) * high - all_g**2 / (all_h + SMOOTH)
            if gain > best[0] + 1e-9:
                best = (gain, f, value)
    return best


def _tree(rows: Counts, g: np.ndarray, h: np.ndarray, depth: int):
    """A number, or (feature, value, tree up to the value, tree above)."""
    _, f, value = _split(rows, g, h) if depth and len(g) else (0.0, -1, 0)
    if f < 0:
        return round(RATE * float(g.sum()) / (float(h.sum()) + SMOOTH), 6)
    above = rows.vectors[:, f] > value
    return f, value, *(_tree(rows.some(side), g[side], h[side], depth - 1) for side in (~above, above))


def value(tree, vector: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[3] if vector[tree[0]] > tree[1] else tree[2]
    return tree


def _values(tree, vectors: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(vectors), tree, float)
    return np.where(vectors[:, tree[0]] > tree[1], _values(tree[3], vectors), _values(tree[2], vectors))


def boost(rows: list[Row] | Counts, rounds: int = ROUNDS) -> list:
    """Trees of depth 2 whose sum is the log-odds of being alike a base span."""
    rows = Counts.of(rows)
    trees, margins, number = [], np.zeros(len(rows.yes)), rows.yes + rows.no
    for _ in range(rounds):
        odds = 1 / (1 + np.exp(-margins))
        trees.append(_tree(rows, rows.yes - number * odds, number * odds * (1 - odds), 2))
        margins = margins + _values(trees[-1], rows.vectors)
    return trees


def threshold(trees: list, rows: list[Row] | Counts, precision: float = PRECISION) -> float | None:
    """The lowest margin from which on ``precision`` of the rows set aside are alike base spans; None if there is none."""
    rows = Counts.of(rows)
    margins, place = np.unique(np.round(sum((_values(t, rows.vectors) for t in trees), np.zeros(len(rows.yes))), 6), return_inverse=True)
    # from the highest margin down
    yes, no = (np.cumsum(np.bincount(place, x, len(margins))[::-1])[::-1] for x in (rows.yes, rows.no))
    good = np.flatnonzero((yes > 0) & (yes >= precision * (yes + no)))
    return float(margins[good[0]]) if len(good) else None


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"({tree!r}D)"
    return f"(CASE WHEN x.c.{FEATURES[tree[0]]} > {tree[1]} THEN {_sql(tree[3])} ELSE {_sql(tree[2])} END)"


def learn(rows: DataFrame) -> dict[int, tuple[list, float]]:
    """(trees, threshold) of each kind that can be told apart, from rows (doc_id, candidates).

    Documents whose crc32 of the id is 0 modulo 5 are set aside for the thresholds.
    """
    aside = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    one = rows.select(aside.alias("aside"), F.explode("candidates").alias("x"))
    keys = [F.col(f"x.c.{f}").alias(f) for f in ("kind", *FEATURES)]
    counts = one.groupBy("aside", *keys).agg(F.count_if(F.col("x.label")).alias("yes"), F.count_if(~F.col("x.label")).alias("no"))
    got = counts.toArrow()
    column = {c: got[c].to_numpy().astype(np.int64) for c in got.column_names}
    every = Counts(np.stack([column[f] for f in FEATURES], axis=1), column["yes"], column["no"])
    order = np.lexsort([column[f] for f in (*FEATURES, "aside", "kind")])  # sums of doubles are the same in every run
    out = {}
    for kind in range(4):
        mine = order[column["kind"][order] == kind]
        seen = every.some(mine[column["aside"][mine] == 0])
        if not seen.yes.any():
            continue
        trees = boost(seen)
        limit = threshold(trees, every.some(mine[column["aside"][mine] == 1]))
        if limit is not None:
            out[kind] = trees, limit
    return out


def chosen(models: dict[int, tuple[list, float]]) -> Column:
    """The candidates that pass, without those that overlap a base span or one chosen before (the leftmost, of those the longest)."""
    if not models:
        return F.expr("CAST(ARRAY() AS ARRAY<STRUCT<start: INT, stop: INT, kind: INT>>)")
    pairs = " ".join(f"WHEN {k} THEN {' + '.join(map(_sql, trees))} >= {limit - 1e-6!r}D" for k, (trees, limit) in models.items())
    passed = f"filter(candidates, x -> x.free AND x.c.checked = 1 AND CASE x.c.kind {pairs} ELSE false END)"
    ordered = f"array_sort(transform({passed}, x -> struct(x.c.start AS start, -x.c.stop AS past, x.c.kind AS kind)))"
    return F.expr(f"""aggregate({ordered},
        CAST(struct(0, array()) AS STRUCT<stop: INT, out: ARRAY<STRUCT<start: INT, stop: INT, kind: INT>>>),
        (s, x) -> CASE WHEN x.start >= s.stop
                       THEN named_struct('stop', -x.past, 'out', concat(s.out, array(named_struct('start', x.start, 'stop', -x.past, 'kind', x.kind))))
                       ELSE s END,
        s -> s.out)""")


def _spelled(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def personal(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs`` (doc_id, text).

    Counts and the hash are over the base spans; ``spans`` are these and the added ones, as kind:start:end by
    kind and start, in code points, the end exclusive. A null or empty text has none. Rows without an id are
    learned from like others; repeated rows give repeated rows, an empty table an empty one; other columns are
    ignored. Each text is searched once; what is found is a table from which the trees are grown and applied.
    """
    text = F.coalesce("text", F.lit(""))
    slim = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text"))).select(
        "doc_id", F.transform("base", slim).alias("base"), candidates(F.col("text"), F.col("base")).alias("candidates"))
    held = written(docs.sparkSession, lambda: rows)
    models = learn(held)
    base = F.array_sort(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))))
    added = F.transform("added", slim)
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS BIGINT) AS n_{name}") for k, name in enumerate(KINDS)]
    return held.withColumn("added", chosen(models)).select(
        "doc_id", *counts, F.sha2(_spelled(base), 256).alias("base_sha256"), _spelled(F.array_sort(F.concat(base, added))).alias("spans"))
