"""Operators 11 to 13 against brute force, on whole tables and on odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamelake.llm import langid, mixing, pii, queries, ranking, whitening
from gamelake.llm.common import table

# 11: whitening


def whitened_by_numpy(vectors, k=8):
    """vec_id, component: (n, deviation, whitened, explained), with numpy's own solver."""
    x = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in vectors]
    m = np.array([v for _, v in x], object)
    n, s = len(m), m.sum(0)
    centred = (n * m - s).astype(float) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1], found[:, ::-1]
    out = {}
    for (i, _), row, off in zip(x, m, centred, strict=True):
        for j in range(min(k, len(values))):
            out[i, j + 1] = (n, int(((n * row - s) ** 2).sum()), off @ found[:, j] / np.sqrt(values[j]), values[j] / values.sum())
    return out


def test_whitening_query_equals_numpy(spark, sf):
    vectors = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    want, rows = whitened_by_numpy(vectors), queries.QUERIES["op11_whitening"](spark, sf).collect()
    assert len(rows) == len(want) and {(r.vec_id, r.component) for r in rows} == set(want)
    signs = {}
    for r in rows:
        n, deviation, value, explained = want[r.vec_id, r.component]
        assert r.n == n and r.deviation == deviation == int(r.deviation_exact)
        assert abs(abs(r.whitened) - abs(value)) < 1e-8 and abs(r.explained / explained - 1) < 1e-9
        if abs(value) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(value))
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_identity_error_is_measured(spark):
    rows = spark.createDataFrame([([1.0, 2.0],), ([3.0, -2.0],), ([5.0, 3.0],)], "whitened array<double>")
    x = np.array([[1, 2], [3, -2], [5, 3]], float)
    assert whitening.identity_error(rows, 2) == pytest.approx(np.abs(np.cov(x.T, bias=True) - np.eye(2)).max())


@pytest.mark.parametrize("matrix", [np.diag([5.0, 5, 5, 1, 1, 1, 0, 0]), np.kron(np.eye(3), [[2.0, 1], [1, 2]]), np.eye(9), np.ones((5, 5)), np.zeros((3, 3)), np.array([[2.0]]), np.diag(np.abs(np.arange(21) - 10.0)) + np.eye(21, k=1) + np.eye(21, k=-1)], ids=["clusters", "pairs", "identity", "rank one", "zero", "one", "close pairs"])
def test_eigenvectors_of_hard_matrices(matrix):
    values, found = whitening.components_of(matrix, 8)
    known = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == min(8, int((known > 1e-10).sum()))
    np.testing.assert_allclose(values, known[: len(values)], rtol=1e-12)
    if len(values):
        assert np.abs(found @ found.T - np.eye(len(values))).max() < 1e-12
        assert np.abs(matrix @ found.T - found.T * values).max() < 1e-12 * values[0]


def test_tridiagonal_and_sturm_counts():
    a = np.random.default_rng(3).standard_normal((30, 30))
    a = a + a.T
    d, e, q = whitening.tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12 and np.abs(q.T @ q - np.eye(30)).max() < 1e-13
    x = np.linspace(-15, 15, 41)
    assert (whitening.counts_below(d, e, x) == [(np.linalg.eigvalsh(a) < v).sum() for v in x]).all()


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [0.5, 1.0], 1), (2, [0.25, -1.0], 2), (2, [0.25, -1.0], 2), (None, [3.0, 0.0], 3), (3, None, 4), (4, [], 5), (5, [1.0, None], 6), (6, [nan, 1.0], 7), (7, [1.0, inf], 8), (8, [1.0], 9), (9, [1.0, 2.0, 3.0], 9), (10, [0.0, 0.0], None)]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int").withColumns({"x": F.lit(1), "component": F.lit(2)})
    got = whitening.whiten(rows).collect()
    assert Counter((r.vec_id, r.component) for r in got) == {(1, 1): 1, (1, 2): 1, (2, 1): 2, (2, 2): 2, (None, 1): 1, (None, 2): 1, (10, 1): 1, (10, 2): 1}
    want = whitened_by_numpy([(i, v) for i, v, _ in data if v and len(v) == 2 and all(c is not None and np.isfinite(c) for c in v)])
    assert all(r.n == 5 and int(r.deviation) == want[r.vec_id, r.component][1] and abs(r.whitened) == pytest.approx(abs(want[r.vec_id, r.component][2])) for r in got)
    assert whitening.whiten(rows.filter("false")).count() == 0
    assert whitening.whiten(rows.filter("vec_id = 1")).count() == 0  # no variance
    assert whitening.whiten(rows.filter("vec_id = 2")).count() == 0
    assert set(whitening.whiten(rows.filter("false")).columns) == set(whitening.whiten(rows).columns)
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")
    assert {int(r.deviation) for r in whitening.whiten(huge).collect()} == {(2 * (2**45 + 100_000) - 200_000) ** 2 + 1024**2}


# 7: the sample of language models


def test_language_models_of_repeated_rows_are_the_same(spark, sf):
    docs, spec = table(spark, sf, "documents"), langid.Spec(max_docs=30)
    once, often = langid.fit(docs, spec), langid.fit(docs.union(docs).union(docs).union(docs).union(docs), spec)
    assert once.sharpness == often.sharpness and once.limits == often.limits and set(once.orders) == set(often.orders)
    for lang, orders in once.orders.items():
        for a, b in zip(orders, often.orders[lang], strict=True):
            assert all((getattr(a, n) == getattr(b, n)).all() for n in ("grams", "shares", "contexts", "passes"))


def test_language_calibration_by_force(spark, sf):
    """Sharpness and limits over the fifth of each language's sample, in plain loops."""
    spec = langid.Spec(max_docs=40)
    docs = table(spark, sf, "documents").filter("lang is not null and text is not null and crc32(cast(doc_id as string)) % 4 <> 2")
    models, names = langid.fit(table(spark, sf, "documents"), spec), None
    held = []
    by_lang = {}
    for r in docs.select("doc_id", "lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id"), 1).alias("o")).collect():
        by_lang.setdefault(r.lang, []).append(r)
    names = sorted(models.orders)
    for lang, rows in by_lang.items():
        chosen = sorted(rows, key=lambda r: (r.o, r.doc_id))[: spec.max_docs]
        held += [(lang, langid.normal(r.text)) for k, r in enumerate(chosen, 1) if k % 5 == 0]
    held = [(lang, p) for lang, p in held if len(p)]
    entropy = langid.Scorer(models).entropies([p for _, p in held])

    def loss(t):
        total = 0.0
        for (lang, p), e in zip(held, entropy, strict=True):
            odds = [math.exp(-t * math.sqrt(len(p)) * (x - min(e))) for x in e]
            total -= math.log(max(odds[names.index(lang)] / sum(odds), 1e-12))
        return total / len(held)

    grid = [2.0**k for k in range(-6, 8)]
    assert loss(models.sharpness) <= min(map(loss, grid)) + 1e-9 and models.sharpness in grid
    for k, lang in enumerate(names):
        own = sorted(float(e[k]) for (of, _), e in zip(held, entropy, strict=True) if of == lang)
        at = 0.99 * (len(own) - 1)
        quantile = own[int(at)] + (at - int(at)) * (own[min(int(at) + 1, len(own) - 1)] - own[int(at)])
        mean = sum(own) / len(own)
        assert models.limits[lang] == pytest.approx(quantile + 3 * math.sqrt(sum((v - mean) ** 2 for v in own) / len(own)), rel=1e-6)


# 12: personal data


def by_pattern(text):
    """The rules as plain searches."""
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            if (True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(digits) <= 19 and total % 10 == 0, 9 <= len(digits) <= 15)[kind]:
                out.append((m.start(), kind, m.end()))
    return [(a, pii.KINDS[k], z) for a, k, z in sorted(out)]


def test_rules_equal_plain_searches(spark, sf):
    rng = np.random.default_rng(1)
    for signs in ("a1@.+- ()%é2", "0123456789 -", "12.5 ", "+12 ().-34567890"):
        for _ in range(4000):
            text = "".join(rng.choice(list(signs), int(rng.integers(0, 45))))
            assert pii.base_spans(text) == by_pattern(text), text
    for r in table(spark, sf, "documents").collect():
        assert pii.base_spans(r.text or "") == by_pattern(r.text or "")
    assert pii.base_spans("1" * 400_000 + "a" * 400_000 + "@" + "+1" * 100_000) == []  # in linear time


@pytest.fixture(scope="module")
def model(spark, sf):
    return pii.fit(table(spark, sf, "documents"))


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in pii.start_weights(pii.Spec(hidden=4), rng).items()}
    x, y = pii.training_windows([], pii.Spec(windows=3))
    _, g = pii.loss_and_gradients(w, x, y)
    for name in w:
        at = (int(x[0, 5]), 3) if name[0] == "x" else (0, 1) if name == "t" else tuple(int(rng.integers(n)) for n in w[name].shape)

        def loss(step, name=name, at=at):
            moved = w[name].copy()
            moved[at] += step
            return pii.loss_and_gradients(w | {name: moved}, x, y)[0]

        assert (loss(1e-3) - loss(-1e-3)) / 2e-3 == pytest.approx(g[name][at], rel=1e-3, abs=2e-4)


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(4)
    w = pii.start_weights(pii.Spec(hidden=3), rng)
    w["t"] = rng.normal(size=w["t"].shape).astype(np.float32)
    x = rng.integers(0, pii.SYMBOLS, (2, 4)).astype(np.uint8)
    tags, _ = pii.decode(w, x)
    e, ok = pii.emissions(w, x), pii.allowed()
    for r in range(2):
        paths = {}
        for path in np.ndindex(*(pii.TAGS,) * 4):
            if (path[0] == 0 or path[0] % 2) and all(ok[a, b] for a, b in zip(path[:-1], path[1:], strict=True)):
                paths[path] = sum(e[t, r, path[t]] for t in range(4)) + sum(w["t"][a, b] for a, b in zip(path[:-1], path[1:], strict=True))
        assert paths[tuple(tags[r].tolist())] == pytest.approx(max(paths.values()), abs=1e-4)


def test_reconcile_takes_the_highest_total_and_leaves_base_spans():
    text = "4111111111111111 4012888888881881 10.0.0.1 +1 (743) 555-3824"
    found = [(0, "card", 16, 2.0), (0, "card", 33, 9.0), (17, "card", 33, 2.0), (34, "ip", 42, 5.0), (20, "card", 33, 8.0), (43, "phone", 60, -1.0)]
    assert pii.reconcile(text, [(34, "ip", 42)], found) == [(0, "card", 16), (17, "card", 33)]
    assert pii.reconcile("9436346619525194", [], [(0, "card", 14, 5.0)]) == []  # a part of a number that fails


def test_windows_meet_in_long_spans():
    """A span over several windows comes together from its pieces, whichever window holds it."""
    local = "a" * 150
    text = "x " * 60 + local + "@b.com" + " y" * 60
    spans = [(120, "email", 120 + len(local) + 6)]
    starts = np.arange(0, len(text), pii.STRIDE)
    tags = np.array([pii.tags_of(spans, s) for s in starts.tolist()])
    got = pii.candidates(starts, tags, np.ones(tags.shape, np.float32), len(text))
    assert [(a, k, z) for a, k, z, _ in got] == [(a, k, z) for a, k, z in spans]


def test_model_finds_what_rules_miss(spark, sf, model):
    """Spans written into texts of the table that the model was not trained on (other forms of them than the rules know)."""
    rng = np.random.default_rng(99)
    texts = ["".join(c for c in r.text or "" if c != "@" and not c.isdigit()) for r in table(spark, sf.replace("0.001", "0.01"), "documents").filter("doc_id > 300 AND doc_id < 700").collect()]
    texts, want = [t for t in texts if len(t) > 200], []
    assert not any(pii.spans_of(texts, model))  # nothing in clean texts
    for i, t in enumerate(texts):
        kind = pii.KINDS[i % 4]
        made = pii._made(rng, kind)
        at = t.find(" ", int(rng.integers(0, len(t) - 100))) + 1
        texts[i] = t[:at] + made + " " + t[at:]
        want.append((at, kind, at + len(made)))
    got = pii.spans_of(texts, model)
    rules = np.mean([(*w, True) in g for w, g in zip(want, got, strict=True)])
    both = np.mean([any(s[:3] == w for s in g) for w, g in zip(want, got, strict=True)])
    assert rules < 0.6 and both > 0.9


def test_pii_query(spark, sf):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op12_pii"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = by_pattern(docs[r.doc_id])
        shown = [f"{k}:{a}:{z}" for a, k, z in base]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in pii.KINDS]
        assert set(shown) <= set(r.spans.split(",")) and len(r.spans.split(",")) - len(shown) <= 2


def test_pii_odd_rows(odd_texts, model):
    texts = [*odd_texts, "one퟿ 😀 a.b@c.de", "call +49 170 1234567, or +49 170 1234567", None]
    assert [[s[:3] for s in g if s[3]] for g in pii.spans_of([t or "" for t in texts], model)] == [by_pattern(t or "") for t in texts]
    assert pii.spans_of([], model) == []


@pytest.fixture(scope="module")
def odd_texts():
    return ["", " ", "@", "1.2.3.4.5.6.7.8", "9" * 5000, "999.1.1.1.1", "4111 1111 1111 1111-", "a@b.c@d.e", "+1", "a@-.-"]


def test_pii_on_spark(spark, model):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "mail a.b@c.de 😀 or 10.0.0.1", 5), (3, "mail a.b@c.de 😀 or 10.0.0.1", 5), (None, "+1 (743) 555-3824", 5)], "doc_id long, text string, pii int")
    got = pii.find(docs, model)
    assert got.columns == ["doc_id", "text", "pii", "pii_"]
    assert sorted((r.doc_id or 0, [(s.kind, s.start, s.end, s.base) for s in r.pii_]) for r in got.collect()) == [(0, [("phone", 0, 17, True)]), (1, []), (2, []), *[(3, [("email", 5, 13, True), ("ip", 19, 27, True)])] * 2]
    shown = sorted((r.doc_id or 0, r.text) for r in pii.redact(docs.filter("doc_id IS NULL OR doc_id > 1"), model).collect())
    assert shown == [(0, "[PHONE]"), (2, ""), *[(3, "mail [EMAIL] 😀 or [IP]")] * 2]
    assert pii.redact(docs.filter("doc_id = 1"), model).first().text is None
    assert pii.find(docs.filter("false"), model).count() == 0 and pii.find(docs, None).count() == 5


def test_pii_sample_counts_repeated_rows_once(spark, sf):
    docs = table(spark, sf, "documents").filter("doc_id < 60")
    small = pii.Spec(hidden=4, windows=64, epochs=1)
    once, often = pii.fit(docs, small), pii.fit(docs.union(docs).union(docs), small)
    assert all((once[k] == often[k]).all() for k in once)
    assert set(pii.fit(docs.filter("false"), small)) == set(once)


# 13: ranking


def ranked_by_force(docs, items, k=10):
    cut = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    bags = [(d, Counter(cut(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total, df = len(bags), sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * n // total
            score = sum(int(np.floor(1000 * np.log((2 * n + 2) / (2 * df[t] + 1)))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in cut(text) if b[t])
            if score > 0:
                scored.append((-score, d is None, d, score))
        out += [(item, r + 1, s[2], s[3]) for r, s in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k])]
    return out


def test_ranking_odd_rows(spark):
    docs = [(1, "One two TWO three"), (2, None), (3, ""), (4, "..."), (5, "two two é"), (5, "two two é"), (5, "another one"), (None, "two three"), (6, "É one-two_three"), (7, "x " * 20_000 + "three")]
    items = [(1, "two two three"), (2, None), (3, ""), (4, "é É zebra"), (4, "é É zebra"), (None, "one"), (5, "never seen"), (6, "one two three x")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("score", "rank", "item_id", "n", "at")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("score", "doc_id", "node", "held")})
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in ranking.rank(d, i).collect()]
    assert sorted(got, key=key) == sorted(ranked_by_force(docs, [*items[:4], *items[5:]]), key=key)
    assert ranking.rank(d.filter("false"), i).count() == 0 and ranking.rank(d, i.filter("false")).count() == 0
    assert ranking.rank(d, i.filter("text IS NULL")).columns == ["item_id", "rank", "doc_id", "score"]


def test_ranking_in_blocks_is_the_same(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    assert ranking.blocks(ranking.item_terms(items), 1200).select("block").distinct().count() > 1
    rows = [[tuple(r) for r in ranking.rank(docs, items, most=m).collect()] for m in (1200, 1 << 18)]
    want = ranked_by_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(rows[0]) == sorted(rows[1]) == sorted(want)


def test_queries_share_sums(spark, sf):
    items = ranking.item_terms(table(spark, sf, "benchmark"))
    graph, alone = ranking.mine(items), ranking.mine(items, rounds=0)
    assert len(graph.merges) and not len(alone.merges)
    assert graph.additions() < alone.additions()
    leaves = np.random.default_rng(0).integers(0, 1000, (len(graph.terms), 7))
    assert (ranking.accumulate(graph, graph.levels(), leaves) == ranking.accumulate(alone, [], leaves)).all()


# 4: weights


def test_weights_of_a_source_add_up(spark):
    docs = spark.createDataFrame([(k, "a" if k < 6 else "b") for k in range(10)], "doc_id long, source string")
    w = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "source string, weight double")
    got = {r.source: r.rate for r in mixing.repetition_rates(docs, "source", w).collect()}
    assert got == pytest.approx({"a": 7.5 / 6, "b": 2.5 / 4})
