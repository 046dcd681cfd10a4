"""Personal data: base spans against Python's re by the definitions, and what the trees add."""

import hashlib
import random
import re

import pytest

from gridmill.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    spans = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]
    spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    counts = tuple(sum(s[0] == k for s in spans) for k in PATTERNS)
    return (*counts, hashlib.sha256(spelled.encode()).hexdigest()), spelled.split(",") if spelled else []


def same(rows, got):
    assert len(rows) == len(got)
    for (doc_id, text), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id,)))):
        want, spans = brute(text)
        assert (r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == (doc_id, *want), text
        assert set(spans) <= set(r.spans.split(",")), text


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(5)
    bits = ["a", "b.c", "@", "@x.y", ".", "-", "_", "%", "+", "+1", " ", "  ", "(", ")", "1", "0", "25", "255", "256", "4111111111111111", "4111 1111",
            "é", "😀", "\n", "1.2.3.4", "000255.1.1.1", "+12 345 678 9", ",", "x@y.z_w@v.u", "9" * 19, "9" * 20, "0000000000000"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 16)))) for i in range(4000)]
    rows += [(4000, None), (4001, ""), (4002, "1" * 60_000), (4003, "a" * 60_000), (4004, "a.b@" * 9000), (4005, "1 " * 30_000), (4006, "1.2.3.4 " * 1500),
             (4007, "x@" + "y." * 20_000 + "z"), (4008, "+1" + " " * 30_000), (4009, "+1" * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({})
    same(rows, pii.personal(docs).collect())


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    same(rows, queries.op12_personal_data(spark, data).collect())


@pytest.fixture(scope="module")
def many():
    """Enough spans to learn from, and numbers that are none."""
    rng = random.Random(9)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(400):
        rows.append((i, f"so it goes +1 ({d(3)}) {d(3)}-{d(4)} and on, year 19{d(2)} 20{d(2)} went"))
        rows.append((1000 + i, f"and then user{d(2)}@mail{d(1)}.example.com said {rng.randint(1, 255)}.{rng.randint(1, 255)}.3.{rng.randint(1, 255)} was"))
        rows.append((2000 + i, f"mine at home.\nversion {d(1)}.{d(1)}.{d(4)}.{d(2)}0 and part {d(3)}-{d(2)}"))
    return rows


def test_added_spans(spark, many):
    odd = [(5000, "call (499) 555-6503 now"), (5001, "to max (at) mail3 dot example dot com now"), (5002, "host 10[.]20[.]3[.]44 there"),
           (5003, "nothing at all. In 1999 2000 it was"), (5004, "see part 123-45 at home.\nThen"), (5005, "version 1.2.3000.4 here")]
    rows = [*many, *odd, (None, "+1 (499) 555-6503"), (7000, "twice"), (7000, "twice")]
    got = pii.personal(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")).collect()
    same(rows, got)
    spans = {r.doc_id: r.spans for r in got}
    assert [spans[5000 + i] for i in range(6)] == ["phone:5:19", "email:3:37", "ip:5:21", "", "", ""]
    for doc_id, text in many:
        assert spans[doc_id].split(",") == (brute(text)[1] or [""])


def test_empty_table_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal(empty).count() == 0
    assert [r.spans for r in pii.personal(spark.createDataFrame([(1, "no (499) 555-6503")], "doc_id long, text string")).collect()] == [""]


def test_boosting_tells_descriptions_apart():
    rows = [((d, g, 0, 0, 1, 1, c, 0), 40 * (c and d > 9), 1 + 39 * (not (c and d > 9))) for d in range(16) for g in range(4) for c in (0, 1)]
    trees = pii.boost(rows)
    score = [sum(pii.value(t, r[0]) for t in trees) for r in rows]
    assert min(s for s, r in zip(score, rows) if r[1]) > max(s for s, r in zip(score, rows) if not r[1])
    limit = pii.threshold(trees, rows)
    assert all((s >= limit - 1e-6) == (r[1] > 0) for s, r in zip(score, rows))
    assert pii.threshold(trees, [(r[0], 0, 1) for r in rows]) is None


def test_no_python_on_executors(spark, many):
    plan = pii.personal(spark.createDataFrame(many, "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


def test_rare_descriptions_are_learned_from_however_many_others_there_are(spark):
    """20,000 more frequent descriptions of another kind must not push out the rare ones of telephone numbers."""
    odd = "CAST(id % 2 AS INT) AS digits, CAST(id DIV 2 AS INT) AS groups, 1 AS widest, 0 AS brackets, 1 AS before, 1 AS after, 0 AS checked, 0 AS cue"
    rare = "CAST(8 + id % 4 AS INT) AS digits, 3 AS groups, 4 AS widest, 0 AS brackets, 1 AS before, CAST(id DIV 4 AS INT) AS after, CAST(id % 4 > 1 AS INT) AS checked, 0 AS cue"

    def rows(features, n, times, kind, label):
        described = f"struct({kind} AS kind, 0 AS start, 1 AS stop, {features})"
        return spark.range(n).selectExpr("1L AS doc_id", f"array_repeat(struct({described} AS c, {label} AS label, true AS free), {times}) AS candidates").union(
            # 6 is set aside, 1 is not
            spark.range(n).selectExpr("6L AS doc_id", f"array_repeat(struct({described} AS c, {label} AS label, true AS free), {times}) AS candidates"))

    models = pii.learn(rows(odd, 20_000, 2, 0, "false").union(rows(rare, 40, 1, 3, "id % 4 > 1")))
    assert list(models) == [3]
    trees, limit = models[3]
    assert [sum(pii.value(t, (d, 3, 4, 0, 1, 5, int(d > 9), 0)) for t in trees) >= limit - 1e-6 for d in (8, 9, 10, 11)] == [False, False, True, True]


def test_trees_from_very_many_descriptions():
    """Of a hundred thousand descriptions; the same as from the sums of equal ones."""
    rows = [((d, g, w, 0, a, 1, c, 0), 3 * c * (d > 9), 1 + 2 * (1 - c)) for d in range(21) for g in range(10) for w in range(21) for a in range(6) for c in (0, 1)]
    merged = {}
    for v, yes, no in rows:
        x = merged.setdefault((v[0], 0, 0, 0, 0, 0, v[6], 0), [0, 0])
        x[0], x[1] = x[0] + yes, x[1] + no
    several = pii.boost([((*r[0][:7], k), r[1], r[2]) for r in rows for k in range(2)], 3)
    assert several == pii.boost([(v, 2 * yes, 2 * no) for v, (yes, no) in merged.items()], 3)
