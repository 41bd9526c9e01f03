"""The operators on small inputs: against brute force, and on nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from freshet.llm import (
    decontamination, exact_topk, mixing, near_dedup, pii, quality, repeats, revisits, sharding, token_rollups,
)
from freshet.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Rows that every operator must take: nulls in any column, empty and blank texts, a long one, repeated rows."""
    return [
        (None, None, None, None, None),
        (None, prose(30, 1), "en", "a", 5),
        (1, None, "en", "a", None),
        (2, "", "en", None, 0),
        (3, " \t\n", None, "b", 3),
        (4, "one", "de", "b", 3),
        (5, prose(4000, 2), "de", "b", 3),
        (6, prose(60, 3), "de", "b", 3),
        (6, prose(60, 3), "de", "b", 3),
        (7, prose(60, 3), "fr", "c", 3),
        (8, "é" * 70 + " ß 漢字 " * 5, "fr", "c", 3),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


# ---- quality ---------------------------------------------------------------------------------------------------------


def labelled(spark, n: int = 240):
    docs, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(80, i)
        docs.append((i, text if good else " ### ".join(w.upper() + "$$$" for w in text.split()), "en", "a", 1))
        labels.append((i, int(good)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality_tells_held_out_documents(spark):
    docs, labels = labelled(spark)
    out = quality.judged(docs, labels).join(labels, "doc_id").toPandas()
    assert ((out.predicted == out.quality)[out.held_out]).mean() > 0.95
    assert all(out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id])
    assert out.score.between(0, 1).all()


def test_quality_of_odd_rows(spark, odd, empty):
    docs, labels = labelled(spark)
    machine = quality.train(docs, labels.withColumnRenamed("quality", "label"), ["n_chars"])
    out = rows(quality.scored(odd.withColumn("score", F.lit("old")), machine, ["n_chars"]))
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 6}) == 1
    assert quality.scored(empty, machine, ["n_chars"]).count() == 0
    none = quality.train(docs, labels.where("false").withColumnRenamed("quality", "label"), ["n_chars"])
    assert {r["score"] for r in rows(quality.scored(odd, none, ["n_chars"]))} == {0.5}


def test_sum_of_squares_equals_sum_over_pairs():
    rng = np.random.default_rng(0)
    width = quality.N_STATS
    m = quality.Machine(
        0.1, rng.normal(size=quality.BUCKETS + width), rng.normal(size=(quality.BUCKETS + width, 3)), np.zeros(width), np.ones(width)
    )
    column, value, dense = np.array([3, 77, 900]), np.array([0.5, 1.0, 2.0]), rng.normal(size=(1, width))
    raw, _ = m.raw(np.zeros(3, int), column, value, dense)
    index = np.concatenate([column, quality.BUCKETS + np.arange(width)])
    x = np.concatenate([value, dense[0]])
    pairs = sum(m.v[index[i]] @ m.v[index[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert np.isclose(raw[0], 0.1 + m.w[index] @ x + pairs)


# ---- mixing ----------------------------------------------------------------------------------------------------------


def water(sizes: list[int], weights: list[float], total: float) -> list[float]:
    """Targets by handing out the excess again and again."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), total
    while free:
        share = left / sum(weights[i] for i in free)
        over = {i for i in free if share * weights[i] > 2 * sizes[i]}
        if not over:
            for i in free:
                targets[i] = share * weights[i]
            return targets
        for i in over:
            targets[i] = 2.0 * sizes[i]
            left -= targets[i]
        free -= over
    return targets


@pytest.mark.parametrize("block", [7, 1024])
def test_mix_meets_its_targets(spark, block):
    rng = random.Random(4)
    docs = [(i, prose(rng.randrange(0, 90), i), "en", rng.choice(["b", "a", "a", "a", "c", None]), 1) for i in range(300)]
    out = mixing.mixed(spark.createDataFrame(docs, DOCS), block).toPandas()
    names = ["a", "b", "c", None]
    sizes = [sum(len(t.split()) for _, t, _, s, _ in docs if s == n) for n in names]
    targets = water(sizes, [3, 1, 2, 3], 1.5 * sum(sizes))
    source = {i: s for i, _, _, s, _ in docs}
    assert len(out) == 300 and (out.taken <= 2 * out["size"]).all()
    for n, size, target in zip(names, sizes, targets, strict=True):
        own = out[[source[i] == n for i in out.doc_id]]
        assert (own.source_size == size).all() and np.allclose(own.target, target)
        assert own.taken.sum() == int(target + 1e-9)


def test_schedule_is_van_der_corput(spark):
    targets = spark.createDataFrame([("va", "a", 100, 60.0, 60), ("vb", "b", 100, 21.0, 21), ("vc", "c", 9, 0.0, 0)], "_key string, source string, source_size bigint, target double, _take bigint")
    slots = mixing.schedule(targets, 10).orderBy("slot").collect()
    # Nine blocks: six of a, three of b, in the order of the reversed digits of their numbers.
    order = sorted(range(9), key=lambda j: int(f"{j:04b}"[::-1], 2))
    assert [s.source for s in slots] == ["a" if j < 6 else "b" for j in order]
    for name, words in (("a", [10] * 6), ("b", [10, 10, 1])):
        own = [s for s in slots if s.source == name]
        assert [s["_block"] for s in own] == list(range(len(words))) and [s.slot_words for s in own] == words


def test_mix_of_odd_rows(odd, empty):
    out = rows(mixing.mixed(odd.withColumn("size", F.lit("x")).withColumn("target", F.lit(1))))
    assert len(out) == len(odd_rows())
    assert sorted(r["size"] for r in out) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in odd_rows())
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert mixing.mixed(empty).count() == 0


# ---- top-k -----------------------------------------------------------------------------------------------------------


def brute_topk(vectors: dict[int, list[int]], queries: list[int], k: int) -> set[tuple]:
    out = set()
    for q in queries:
        found = sorted((-sum(a * b for a, b in zip(vectors[q], v, strict=True)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(found[:k], 1)}
    return out


@pytest.mark.parametrize("cell", [1, 8, 500])
def test_topk_is_exact(spark, cell):
    rng = np.random.default_rng(5)
    vectors = {i: rng.integers(-900, 900, 6).tolist() for i in range(150)}
    for i in range(40, 80):
        vectors[i] = vectors[0]
    vectors[200] = [10**6, -(10**6), 5, 5, 5, 5]
    vectors[201], vectors[202], vectors[203] = [1, 2], [3, 4], []
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, v array<bigint>").repartition(3)
    asked = [0, 40, 100, 200, 201, 203]
    out = exact_topk.top_k(frame, frame.where(F.col("vec_id").isin(asked)), 5, cell)
    assert {tuple(r) for r in out.collect()} == brute_topk(vectors, asked, 5)


def test_topk_leaves_odd_vectors_out(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, -0.1]), (1, [0.5, 0.2]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 0.0]), (None, [1.0, 1.0]), (1, [0.5, 0.2])]
    table = spark.createDataFrame([(i, v, "x") for i, v in data], "vec_id bigint, embedding array<double>, v string")
    vectors = exact_topk.whole_vectors(table)
    assert sorted((r.vec_id, r.v) for r in vectors.collect()) == [(0, [512, -103]), (1, [512, 204]), (1, [512, 204])]
    out = exact_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))
    assert [tuple(r) for r in out.orderBy("rank").collect()] == [(0, n, 1, 512 * 512 - 103 * 204) for n in (1, 2)]
    none = exact_topk.whole_vectors(table.where("false"))
    assert exact_topk.top_k(none, none).count() == 0


def test_topk_with_repeated_ids(spark):
    """Many rows under one id, the query's own among them, push no other id out; each row is a result of its own."""
    rows_ = [(100, [3, 4])] * 12 + [(205, [3, 4])] * 3 + [(206, [3, 4]), (300, [3, 4])] + [(7, [1, 1])] * 2 + [(100, [1, 1])] * 9
    rows_ += [(i, [3, 3]) for i in range(400, 420)] + [(500, [2, 2])] * 30
    frame = spark.createDataFrame(rows_, "vec_id bigint, v array<bigint>").repartition(4)
    for k in (1, 3, 6):
        queries = frame.where("vec_id in (205, 300) or (vec_id = 100 and v[0] = 3)")
        found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in exact_topk.top_k(frame, queries, k).collect()}
        want = {}
        for q, v in ((100, [3, 4]), (205, [3, 4]), (300, [3, 4])):
            best = sorted((-(v[0] * w[0] + v[1] * w[1]), i) for i, w in rows_ if i != q)[:k]
            want |= {(q, n): (i, -s) for n, (s, i) in enumerate(best, 1)}
        assert found == want


def test_topk_keeps_large_components(spark):
    rng = np.random.default_rng(11)
    vectors = {i: [float(x) for x in rng.integers(-900, 900, 3)] for i in range(60)}
    vectors[100] = [3.0e6, -2.0**21, 1.0]
    vectors[101], vectors[102], vectors[103] = [2.0**21, 1.0, 5.0e6], [2.0**28, 1.0, 0.0], [-(2.0**28), 1.0, 0.5]
    table = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(3)
    whole = exact_topk.whole_vectors(table)
    expected = {i: [int(np.floor(1024 * c)) for c in v] for i, v in vectors.items()}
    assert {r.vec_id: r.v for r in whole.collect()} == expected
    out = exact_topk.top_k(whole, whole.where("vec_id in (0, 7)"), 5)
    assert {tuple(r) for r in out.collect()} == brute_topk(expected, [0, 7], 5)
    # Of this query the best scores fit into 64 bits, while products with other vectors do not.
    far = {1: [1 << 40, 0], 2: [-(1 << 40), 3], 3: [5, 1], 4: [7, 2], 5: [-(1 << 62), 1 << 62]}
    frame = spark.createDataFrame(list(far.items()), "vec_id bigint, v array<bigint>")
    assert {tuple(r) for r in exact_topk.top_k(frame, frame.where("vec_id = 1"), 2).collect()} == brute_topk(far, [1], 2)
    with pytest.raises(Exception, match="no 64-bit number"):
        exact_topk.top_k(frame, frame.where("vec_id = 1"), 4).collect()


# ---- personal data ---------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text: str) -> list[tuple]:
    def fits(kind, span):
        digits = re.sub(r"[^0-9]", "", span)
        return {
            "email": True,
            "ip": kind != "ip" or all(int(p) <= 255 for p in span.split(".")),
            "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
            "phone": 9 <= len(digits) <= 15,
        }[kind]

    found = [(m.start(), k, m.end()) for k, (name, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if fits(name, m.group())]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(6)
    parts = ["a@b.co", "x.y+z@q-1.example.com", "@", "a@b@c.d", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "+1 (017) 555-7713", "+12", " ", ".", "-", "é", "+", "00000000001.2.3.4", "12", "(", "word"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_base(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize(
    "span, kind",
    [("41.11.11.11.11.11.11.11", 2), ("4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", 2), ("0033 (0)1 23 45 67 89", 3), ("a.b" * 50 + " at mail.example.com", 0)],
)
def test_candidates_are_proposed_whole(span, kind):
    assert (6, kind, 6 + len(span)) in pii.candidates(f"write {span} now")


def private_docs(spark, n: int = 400):
    rng = random.Random(7)
    docs = []
    for i in range(n):
        d = lambda k: "".join(str(rng.randrange(10)) for _ in range(k))
        told = [f"call +1 ({d(3)}) 555-{d(4)}", f"mail joe.{d(2)}@mail{d(1)}.example.com", f"host {rng.randrange(255)}.{rng.randrange(255)}.7.9"]
        docs.append((i, f"{prose(9, i)} {rng.choice(told)} {prose(5, i + 1)} order {d(11)} x", "en", "a", 1))
    return spark.createDataFrame(docs, DOCS)


def test_trees_add_spans_and_keep_base(spark, odd, empty):
    judge = pii.train(private_docs(spark))
    assert min(judge.thresholds) <= 1
    texts = ["call 1 (231) 555-9182 now", "mail joe.12 at mail3.example.com now", "call +1 (231) 555-9182", "order 12345678901 x", prose(50, 1)]
    found = judge.spans(texts)
    assert found[0][1] and texts[0][found[0][1][0][0] : found[0][1][0][2]].endswith("9182")
    assert found[1][1] and not found[3][1] and not found[4][1]
    assert [f[:3] for f in found[2][0]] == pii.base_spans(texts[2]) and not found[2][1]
    out = rows(pii.with_spans(odd.withColumn("base", F.lit(1)), judge))
    assert len(out) == len(odd_rows()) and all(r["base"] == [] for r in out)
    assert pii.with_spans(empty, judge).count() == 0
    assert pii.train(empty).thresholds == (2.0,) * 4


def test_few_examples_take_the_threshold_of_all_kinds(spark):
    judge = pii.train(private_docs(spark, 40))
    assert max(judge.thresholds) <= 1
    texts = ["mail joe.12 at mail3.example.com now", "order 12345678901 x", prose(50, 1)]
    found = judge.spans(texts)
    assert [f[:2] for f in found[0][1]] == [(5, 0)] and not found[1][1] and not found[2][1]
    assert judge.thresholds == pii.train(private_docs(spark, 40).repartition(7)).thresholds


def test_rare_kinds_are_drawn_from_the_whole_table(spark):
    rare = private_docs(spark, 60)
    many = spark.range(1000, 4000).selectExpr("id as doc_id", "concat('order ', 10000000000 + 7919 * id, ' x') as text")
    table = pii.drawn(rare.select("doc_id", "text").union(many), 20).toPandas()
    counts = table.groupby(["kind", "label", "held"]).size()
    held = {i for i in range(60) if int(hashlib.md5(str(i).encode()).hexdigest()[-1], 16) % 4 == 0}
    for kind in ("email", "ip", "phone"):
        of = [r.doc_id for r in rare.collect() for _, k, _ in pii.base_spans(r.text) if pii.KINDS[k] == kind]
        for side in (True, False):
            assert counts.get((pii.KINDS.index(kind), 1, side), 0) == min(20, 2 * sum((i in held) == side for i in of))
    assert counts.max() == 20


def test_one_document_of_numbers_does_not_fill_the_sample(spark):
    rare = private_docs(spark, 80).select("doc_id", "text")
    first = min(range(1000, 3000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    numbers = spark.createDataFrame([(first, " ".join(str(100 + 7 * i % 900) for i in range(2000)))], "doc_id bigint, text string")
    assert max(pii.train(rare.union(numbers), max_train=1600).thresholds) <= 1
    plain, more = (pii.drawn(d, 1000).toPandas().groupby(["kind", "label", "held"]).size() for d in (rare, rare.union(numbers)))
    assert more.sub(plain, fill_value=0).max() == pii.PER_DOC
    assert all(more[i] == plain[i] for i in plain.index if i[1] == 1)


def test_weights_stand_for_what_was_not_drawn():
    p, label = np.array([0.9] * 99 + [0.8]), np.array([1] * 99 + [0])
    every = np.ones(100, bool)
    assert pii.lowest_cut(p, label, np.ones(100), every) == 0.8
    assert pii.lowest_cut(p, label, np.where(label == 1, 1.0, 50.0), every) == 0.9
    # Equal probabilities are decided alike.
    assert pii.lowest_cut(np.array([0.7, 0.7]), np.array([1, 0]), np.ones(2), every[:2]) == np.nextafter(0.7, 2)


def test_a_kind_with_few_examples_leans_on_the_others():
    # All kinds together are right from 0.6; the own examples are wrong below 0.9.
    p = np.concatenate([np.full(500, 0.6), np.full(1, 0.9), np.full(1, 0.7)])
    label = np.concatenate([np.ones(501), np.zeros(1)])
    few = p > 0.65
    assert pii.lowest_cut(p, label, np.ones(502), few) == 0.9
    assert pii.lowest_cut(p[:-1], label[:-1], np.ones(501), few[:-1]) == 0.6
    assert pii.lowest_cut(p[:-1], label[:-1], np.ones(501), np.zeros(501, bool)) == 0.6


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_spans_that_no_rule_finds(spark, sf):
    """Documents whose personal data lost its telling mark: what the trees find of it, and what else they take."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    judge = pii.train(docs.select("doc_id", "text"))
    texts, hidden = [], []
    for text in (r.text or "" for r in docs.select("text").collect()):
        out, at, own = "", 0, []
        for start, kind, end in pii.base_spans(text):
            if start >= at:
                form = pii.without_mark(text[start:end], kind)
                out += text[at:start] + form
                own.append((len(out) - len(form), len(out)))
                at = end
        if own:
            texts.append(out + text[at:])
            hidden.append([(s, e) for s, e in own if (s, e) not in {(s, e) for s, _, e in pii.base_spans(texts[-1])}])
    found = [[(s, e) for s, _, e, _ in added] for _, added in judge.spans(texts)]
    covered = [any(s <= a and b <= e for s, e in f) for h, f in zip(hidden, found, strict=True) for a, b in h]
    right = [any(s < b and a < e for a, b in h) for h, f in zip(hidden, found, strict=True) for s, e in f]
    assert len(covered) > 50 and np.mean(covered) >= 0.9 and np.mean(right) >= 0.9


def test_the_judge_is_fitted_on_all_examples(spark):
    docs = private_docs(spark).select("doc_id", "text")
    numbers = spark.createDataFrame([(1000, " ".join(str(100 + 7 * i % 900) for i in range(2000)))], "doc_id bigint, text string")
    found = Counter((k, y) for r in docs.collect() for k, y, *_ in pii.examples(r.text))
    weights = {(r.kind, r.label): r.n for r in pii.counted(docs).groupBy("kind", "label").agg(F.sum("weight").alias("n")).collect()}
    assert weights == {k: n * pii.WEIGHT for k, n in found.items()}
    # A document of very many examples weighs as much as PER_DOC, but all of its different ones are there.
    table = pii.counted(numbers).toPandas()
    assert len(table) > 2 * pii.PER_DOC and table.groupby(["kind", "label"]).weight.sum().max() <= pii.PER_DOC * pii.WEIGHT
    # So small a weight of the kinds would be an example or two of each, were they drawn.
    judge = pii.train(docs, max_train=16)
    added = judge.spans(["call 1 (231) 555-9182 now", "mail joe.12 at mail3.example.com now", "order 12345678901 x"])
    assert [[(s, k) for s, k, *_ in a] for _, a in added] == [[(5, 3)], [(5, 0)], []]


def test_sums_by_spark_are_those_of_the_driver(spark):
    docs = private_docs(spark, 60).repartition(3)
    here, there = pii.train(docs), pii.train(docs, driver_rows=0)
    assert here.thresholds == there.thresholds and (here.slope, here.shift) == (there.slope, there.shift)
    assert all(np.array_equal(getattr(here.trees, n), getattr(there.trees, n)) for n in ("feature", "cut", "leaf"))


def test_many_addresses_in_one_text_take_linear_time(spark):
    judge = pii.train(private_docs(spark))
    text = "".join(f"mail joe.{i} at mail{i % 9}.example.com or a{i}@b.co now " for i in range(20_000))
    began = time.monotonic()
    base, added = judge.spans([text])[0]
    assert len(base) == 20_000 and len(added) >= 19_000 and time.monotonic() - began < 30


def test_trees_lower_the_loss():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((pii.boosted(x, y).raw(x) > 0) == (y > 0)).mean() > 0.95


def test_redaction(spark):
    df = spark.createDataFrame([("mail a@b.co or 1.2.3.4!", [("email", 5, 11), ("ip", 15, 22), ("ip", 16, 22)])], "t string, s array<struct<kind:string,start:int,end:int>>")
    assert df.select(pii.redacted(F.col("t"), F.col("s")).alias("r")).first().r == "mail [email] or [ip]!"


# ---- revisits --------------------------------------------------------------------------------------------------------

RECORDS = "record_id bigint, url string, ts bigint, kind string, http_status int, etag string, last_modified string, payload_digest string, headers array<struct<name:string,value:string>>, body string, status string"


def test_revisits(spark):
    head = [("ETag", "old"), ("X-Own", "1"), ("Date", "first"), ("x-own", "2")]
    fresh = [("Date", "second"), ("X-Own", "no"), (None, "?")]

    def row(i, url, ts, kind, status=200, etag=None, modified=None, digest=None, headers=None, body=None):
        return (i, url, ts, kind, status, etag, modified, digest, headers, body, "clash")

    data = [
        row(1, "http://A.example:80/x/?b=1&utm_source=f#t", 10, "response", 200, '"v1"', "m1", "d1", head, "body1"),
        row(2, "http://a.example/x?b=1", 20, "response", 200, '"v2"', "m2", "d2", head, "body2"),
        row(3, "http://a.example/x?b=1", 15, "response", 500, None, None, None, None, "error"),
        row(10, "http://a.example/x?b=1", 10, "revisit", 304, 'W/"v1"', "other", None, fresh),
        row(11, "http://a.example/x?b=1", 20, "revisit", 304, None, "m2", None, fresh),
        row(12, "http://a.example/x?b=1", 19, "revisit", 304, '"v2"', None, None, None),
        row(13, "http://a.example/x?b=1", 9, "revisit", 304),
        row(14, "http://a.example/x?b=1", 99, "revisit", 304, None, None, None, []),
        row(14, "http://a.example/x?b=1", 99, "revisit", 304, None, None, None, []),
        row(15, "http://a.example/x?b=1", 99, "revisit", 304, None, None, "d2"),
        row(16, None, 99, "revisit"),
        row(17, "http://a.example/x?b=1", None, "revisit"),
        row(None, "http://a.example/x?b=1", 99, "revisit"),
        row(18, "", 99, None),
    ]
    out = {r["record_id"]: r for r in rows(revisits.resolved(spark.createDataFrame(data, RECORDS)))}
    assert {i: (r["status"], r["response_id"]) for i, r in out.items()} == {
        10: ("resolved", 1), 11: ("resolved", 2), 12: ("mismatch", 1), 13: ("orphan", None), 14: ("unchecked", 2),
        15: ("resolved", 2), 16: ("orphan", None), 17: ("orphan", None),
    }
    assert out[10]["headers"] == {"etag": "old", "x-own": "2", "date": "second"} and out[10]["body"] == "body1"
    assert out[12]["headers"] is None and out[12]["body"] is None
    assert revisits.resolved(spark.createDataFrame([], RECORDS)).count() == 0


def test_latest_earlier_over_many_ranges(spark):
    rng = random.Random(9)
    data = [(i, rng.choice(["hot", "hot", "u", "v"]), rng.randrange(200), rng.random() < 0.1) for i in range(3000)]
    frame = spark.createDataFrame(data, "record_id bigint, url string, ts bigint, full boolean").repartition(5)
    expected = {}
    for i, u, t, full in data:
        if not full:
            earlier = [(s, j) for j, v, s, f in data if f and v == u and (s, j) < (t, i)]
            if earlier:
                expected[i] = max(earlier)[1]
    assert {r.record_id: r.response_id for r in revisits.latest_earlier(frame).collect()} == expected


# ---- token rollups ---------------------------------------------------------------------------------------------------

CHANGES = "doc_id bigint, op string, seq bigint, source string, lang string, text string, docs string"


def test_rollups_follow_changes_and_repeat_harmlessly(spark, tmp_path):
    rollup = token_rollups.Rollup(spark, str(tmp_path / "r"))

    def apply(batch, *changes):
        return rollup.apply(batch, spark.createDataFrame([(*c, "clash") for c in changes], CHANGES))

    def totals(version="words-1"):
        return {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().where(F.col("version") == version).collect()}

    assert totals() == {}
    first = [(1, "insert", 1, "a", "en", "x y z"), (2, "insert", 1, "a", "en", None), (3, "insert", 1, None, None, "one, two"), (None, "insert", 1, "a", "en", "lost"), (None, "delete", 1, "a", "en", "lost")]
    assert apply(1, *first) and not apply(1, *first)
    assert totals() == {("a", "en"): (3, 4), (None, None): (1, 2)}
    assert totals("pieces-1") == {("a", "en"): (3, 4), (None, None): (1, 3)}
    assert apply(2, (1, "delete", 5, None, None, None), (1, "revise", 4, "a", "en", "no"), (9, "delete", 1, None, None, None), (2, "revise", None, "b", "de", "v w"), (8, "drop", 1, "a", "en", "z"))
    assert totals() == {("a", "en"): (1, 1), ("b", "de"): (1, 2), (None, None): (1, 2)}
    assert apply(3, (1, "insert", 1, "a", "en", "back again"))
    assert totals()[("a", "en")] == (2, 3)
    assert apply(4)
    with pytest.raises(ValueError):
        apply(0, first[0])


def test_attempts_without_a_commit_count_nothing(spark, tmp_path):
    class Dies(token_rollups.Rollup):
        def _deltas(self, base, attempts):
            raise RuntimeError

    path = str(tmp_path / "r")
    changes = spark.createDataFrame([(1, "insert", 1, "a", "en", "x y", "")], CHANGES)
    with pytest.raises(RuntimeError):
        Dies(spark, path).apply(1, changes)
    rollup = token_rollups.Rollup(spark, path)
    assert rollup.totals().count() == 0 and rollup.apply(1, changes) and rollup.totals().count() == 2


def test_counts_of_a_public_tokenizer(spark, odd):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    out = odd.select("text", token_rollups.vocabulary_count(path)(F.col("text")).alias("n")).collect()
    tokenizer = Tokenizer.from_file(path)
    assert all(r.n == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in out)


# ---- sharding --------------------------------------------------------------------------------------------------------


def test_new_shard_takes_rows_only_into_itself(spark):
    docs = spark.createDataFrame([(i, "t" * (i % 7), "en", "a", 1) for i in range(4000)], DOCS)
    out = sharding.placed(docs).toPandas()
    moved = out[out.shard != out.grown_shard]
    assert set(moved.grown_shard) == {8} and 250 < len(moved) < 650
    assert out.groupby("shard").size().between(380, 620).all()
    for _, own in out.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_movement_stays_in_the_changed_subtree(spark):
    docs = spark.range(3000).withColumnRenamed("id", "doc_id")
    tree = sharding.uniform_tree(8)
    heavier = [sharding.Shard(s.number, s.region, s.rack, 3.0 if s.number == 1 else 1.0) for s in tree]
    both = sharding.assign(sharding.assign(docs, tree), heavier, name="after").toPandas()
    region = {s.number: s.region for s in tree}
    moved = both[both.shard != both.after]
    # Between regions keys go to the heavier region only; nothing moves within the other one.
    assert len(moved) and all(region[a] == "r0" for a in moved.after)
    same_region = moved[[region[s] == "r0" for s in moved.shard]]
    assert len(same_region) and all(a in (0, 1) for a in same_region.after)


def test_shards_of_odd_rows(odd, empty):
    out = rows(sharding.placed(odd.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(0))))
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in odd_rows())
    assert len({r["shard"] for r in out if r["doc_id"] == 6}) == 1
    assert sharding.placed(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit(1), [sharding.Shard(0, "r", "k", 0.0)])


# ---- near duplicates -------------------------------------------------------------------------------------------------


def shingle_set(text: str | None, n: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_components(docs: list[tuple], n: int, percent: int) -> dict[int, int]:
    sets = [(i, shingle_set(t, n)) for i, t, *_ in docs if i is not None]
    label = {i: i for i, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for p, (i, a) in enumerate(sets):
        for j, b in sets[:p]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: root(i) for i in label}


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, words, percent):
    rng = random.Random(10)
    base = [prose(120, s).split() for s in range(3)]
    docs = []
    for i in range(240):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 12])):
            text[rng.randrange(len(text))] = "edit" + str(rng.randrange(10**6))
        docs.append((1000 - i, " ".join(text), "en", "a", 1))
    docs += odd_rows()
    out = rows(near_dedup.classes_of(spark.createDataFrame(docs, DOCS), words, percent))
    expected = brute_components(docs, words, percent)
    assert len(out) == len(docs)
    assert {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None} == expected
    sizes = Counter((i, len(shingle_set(t, words))) for i, t, *_ in docs)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in out) == sizes


def test_groups_keep_one_of_each(spark, odd, empty):
    out = rows(near_dedup.grouped(odd.withColumn("kept", F.lit("x"))))
    kept = [(r["doc_id"], r["kept"]) for r in out]
    assert (7, False) in kept and kept.count((6, True)) == 2 and kept.count((None, True)) == 2
    assert near_dedup.grouped(empty).count() == 0


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), (None, 2), (8, 9), (20, 19)] + [(i, i + 1) for i in range(19, 40)]
    out = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert out == {1: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 8, 9: 8, **{i: 19 for i in range(19, 41)}}


# ---- decontamination -------------------------------------------------------------------------------------------------


def edit_search(pattern: str, text: str) -> int:
    """Smallest edit distance of `pattern` to any stretch of `text`, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks_against_the_whole_table():
    def budget(chars: int) -> int:
        return chars // 10 if chars >= decontamination.MIN_CHARS else 0

    rng = random.Random(11)
    items = [(n, prose(rng.randrange(4, 14), 100 + n)) for n in range(25)]
    finder = decontamination.Finder(items)
    for t in range(120):
        _, item = rng.choice(items)
        chars = list(item)
        for _ in range(rng.randrange(0, len(item) // 6)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.choice([0, 1])] = rng.choice(["", "q", "zz"])
        text = f"{prose(rng.randrange(30), t)}\n {''.join(chars)}  {prose(rng.randrange(30), t + 1)}"
        plain = decontamination.normalized(text)
        expected = {
            (n, d) for n, p in items
            if (d := edit_search(decontamination.normalized(p), plain)) <= budget(len(decontamination.normalized(p)))
        }
        found = finder.leaks(text)
        assert {(n, d) for n, d, _, _ in found} == expected
        for n, d, start, end in found:
            assert edit_search(decontamination.normalized(dict(items)[n]), decontamination.normalized(text[start:end])) == d


def test_leaks_of_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, prose(20, 3)), (4, prose(60, 3)), (5, prose(60, 3))], "item_id bigint, text string")
    out = rows(decontamination.with_leaks(odd.withColumn("leaks", F.lit(1)), items))
    assert len(out) == len(odd_rows())
    # A short item is found where it stands as a whole word.
    for r in out:
        assert [x["item_id"] for x in r["leaks"]] == ([4, 5] if r["doc_id"] in (6, 7) else [3] if r["doc_id"] == 4 else [])
    assert decontamination.with_leaks(empty, items).count() == 0
    assert all(r["leaks"] == [] for r in rows(decontamination.with_leaks(odd, items.where("false"))))


def test_short_items_are_whole_words_without_an_edit():
    finder = decontamination.Finder([(1, "One two."), (2, "42"), (3, "c++"), (4, " \n"), (5, "x" * 31)])
    sought = {
        "say ONE\n two. now": [1], "one two": [], "alone two.": [], "one two.five": [1], "42": [2], "142 421 4 2": [],
        "a=42;": [2], "(C++)": [3], "c+++": [3], "abc++": [], "x" * 32: [], "-" + "x" * 31: [5], "": [],
    }
    assert {t: [n for n, *_ in finder.leaks(t)] for t in sought} == sought
    assert [x[1:] for x in finder.leaks("it is 42, and 42")] == [(0, 6, 8)]


# ---- repeated passages -----------------------------------------------------------------------------------------------


def brute_repeats(docs: list[tuple], window: int) -> dict[int, list[tuple[int, bytes]]]:
    texts = [(i, (t or "").encode()) for i, t, *_ in docs]
    first: dict[bytes, int] = {}
    for i, t in texts:
        if i is not None:
            for s in range(len(t) - window + 1):
                first[t[s : s + window]] = min(i, first.get(t[s : s + window], i))
    out = []
    for i, t in texts:
        cut = bytearray(len(t))
        for s in range(len(t) - window + 1) if i is not None else ():
            if first[t[s : s + window]] < i:
                cut[s : s + window] = b"\1" * window
        kept = bytes(c for c, x in zip(t, cut, strict=True) if not x)
        spans = len(re.findall(b"\1+", bytes(cut)))
        out.append((i, len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, bucket_bytes", [(50, None), (20, None), (50, 64)])
def test_repeats_against_all_windows(spark, window, bucket_bytes):
    rng = random.Random(12)
    line = "All rights reserved by the owners of this page, whoever they are and wherever. "
    docs = list(odd_rows())
    for i in range(60):
        parts = [prose(rng.randrange(1, 12), rng.randrange(25)) for _ in range(rng.randrange(1, 6))]
        if i % 2:
            parts.insert(rng.randrange(len(parts)), line * rng.choice([1, 1, 3]))
        docs.append((100 + i, rng.choice(["", "ä"]) + "\n".join(parts), "en", "a", 1))
    docs.append((90, "z" * 300, "en", "a", 1))
    docs.append((95, "z" * 180 + "y", "en", "a", 1))
    frame = spark.createDataFrame(docs, DOCS).withColumn("spans", F.lit("clash")).repartition(5)
    out = repeats.digests(repeats.with_spans(frame, window, bucket_bytes))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_repeats(docs, window)


def test_repeats_of_an_empty_table(empty):
    assert repeats.with_spans(empty).count() == 0
    with pytest.raises(ValueError):
        repeats.with_spans(empty, 10)


def test_long_texts_are_taken_in_parts(monkeypatch):
    monkeypatch.setattr(repeats, "PART", 256)
    data = np.frombuffer(prose(400, 1).encode(), np.uint8)
    offsets = np.array([0, 40, len(data)])
    none = np.zeros(1 << repeats.FREQUENT_BITS, bool)
    whole = repeats.Runs(data, offsets, none, 50)
    windows = set()
    for piece, cuts, row, low in repeats.parts(data, offsets, 50):
        runs = repeats.Runs(piece, cuts, none, 50)
        for a, b, at, key in zip(runs.start, runs.stop, runs.anchor, runs.key, strict=True):
            windows |= {(int(s) + low, int(at) + low, int(key)) for s in range(a, b + 1)}
    assert windows == {(s, int(at), int(key)) for a, b, at, key in zip(whole.start, whole.stop, whole.anchor, whole.key, strict=True) for s in range(a, b + 1)}


def test_packed_records_read_back():
    rng = np.random.default_rng(1)
    key = np.sort(rng.integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2))
    doc, small = rng.integers(-5, 10**12, 50), rng.integers(0, 256, (50, 2)).astype(np.uint8)
    read = repeats.Packed.read(repeats.Packed.of(key, doc, small, b"xyz"))
    assert all((a == b).all() for a, b in zip(read, (key, doc, small, np.frombuffer(b"xyz", np.uint8)), strict=True))


def test_slices_keep_nulls_and_order():
    from freshet.llm.textbytes import slices

    found = [data.tobytes() for _, _, data, _ in slices(pa.array(["a", None, "b" * 5]))]
    assert found == [b"abbbbb"]


def test_packed_records_leave_a_few_at_a_time(monkeypatch):
    """A task of op10 does not hold the packed records of all buckets of a batch."""
    import numpy as np
    import pyarrow as pa

    from freshet.llm import repeats

    monkeypatch.setattr(repeats, "PACKED_BYTES", 100)
    made = []

    def values():
        for n in range(20):
            made.append(n)
            yield bytes([n]) * 60

    lists = [pa.array([5], pa.int64()), pa.array([[1, 2]], pa.list_(pa.int32()))]
    found = repeats._two_kinds(np.arange(20), values(), lists, ["keys"], pa.int32(), 4)
    assert next(found).num_rows == 2 and len(made) == 2
    rest = list(found)
    assert [b.num_rows for b in rest] == [2] * 9 + [1]
    assert [v for b in rest[:-1] for v in b.column("bucket").to_pylist()] == list(range(2, 20))
