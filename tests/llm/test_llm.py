"""Text operators: brute-force twins on small tables, SQL, held-out accuracy, and odd rows."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gamelake.llm import bpe, graph, langid, mixing, nb_linear, quality, queries, simhash, telephony, topk, toxicity, units
from gamelake.llm.common import table
from tests.oracle import assert_same, connect

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(40_000)) + "\n" + "y" * 50_000
SHARED = "\n".join(f"shared line {k} " + " ".join(f"s{k}w{j}" for j in range(30)) for k in range(40))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    data = [
        (None, "a text without an id", "en", "s1", 5),
        (1, None, "en", None, None),
        (2, "", None, "s1", 0),
        (3, LONG, "en", "s1", len(LONG)),
        (4, SHARED, "en", "s2", None),
        (5, "an own first line\n" + SHARED + "\nan own last line", "en", "s2", None),
        (5, "an own first line\n" + SHARED + "\nan own last line", "en", "s2", None),
        (6, "same same\nsame same", "fr", "s1", 1),
        (7, "same same\nsame same", "fr", "s1", 1),
        (8, "<|endoftext|> \n\n  é 日本語 !!", "fr", None, 1),
        (9, "123 456 !!!", "en", "s2", 1),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    extra = ("score", "key", "label", "order", "fp", "copy", "mix_key", "rate", "times", "digest", "ids", "removed_spans", "text_hash", "gone", "n")
    return df.withColumns({c: F.lit(7) for c in extra})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, None if k == 3 else k % 2) for k in range(10)] + [(None, 1, 1), (4, 7, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    assert_same(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE_SQL[name])


# 1 and 3: repeated units


def test_repeated_lines_odd_rows(odd, empty):
    found = units.repeated_lines(odd)
    # document 5 (twice) repeats the forty long lines of document 4
    assert Counter(r.doc_id for r in found.collect()) == {5: 80}
    assert {r.kept_doc_id for r in found.collect()} == {4}
    assert units.repeated_lines(empty).count() == 0
    cleaned = {r.doc_id: r for r in units.drop_repeated_lines(odd).collect()}
    assert cleaned[5].text == "an own first line\nan own last line" and len(cleaned[5].removed_spans) == 40
    assert cleaned[1].text is None and cleaned[2].text == "" and cleaned[3].text == LONG
    original = "an own first line\n" + SHARED
    assert [original[a:b] for a, b in cleaned[5].removed_spans] == SHARED.split("\n")


def found_by_passages(docs, least=units.PASSAGE_WORDS):
    """doc_id -> the removed spans."""
    out = defaultdict(list)
    for r in units.united(units.repeated_passages(docs, least)).orderBy("doc_id", "start_char").collect():
        out[r.doc_id].append((r.start_char, r.end_char))
    return out


def test_repeated_passages_of_short_lines(spark, odd, empty):
    wrapped = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(5)]  # 60 words, no line of 25
    mixed = [" ".join(f"m{k}x{j}" for j in range(n)) for k, n in enumerate((10, 22, 93, 2))]
    data = [(1, "\n".join(["top", *wrapped, "", "lone line", *mixed])), (2, "\n".join(["other", *mixed, "lone line", "x y z", *wrapped])), (3, "lone line\n" + wrapped[2])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert units.repeated_lines(docs).count() == 1  # of all this, lines alone find one
    out = found_by_passages(docs)
    assert set(out) == {2} and [data[1][1][a:b] for a, b in out[2]] == ["\n".join(mixed), "\n".join(wrapped)]
    assert units.repeated_passages(empty).count() == 0 and set(found_by_passages(odd)) == {5}


def test_repeated_passages_inside_lines(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijé") for _ in range(rng.randint(1, 8)))
    texts, places = [], []
    passage = [word() for _ in range(80)]
    for _ in range(60):
        before, after = (" ".join(word() for _ in range(rng.randint(5, 90))) + rng.choice(("  ", "\n", " \u3000")) for _ in range(2))
        body = " ".join(passage).upper()
        places.append((len(before), len(before) + len(body)))
        texts.append(before + body + " " + after)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = found_by_passages(docs)
    covered = [sum(y - x for x, y in found[k]) / (b - a) for k, (a, b) in enumerate(places)]
    assert not found[0] and min(covered[1:]) > 0.5
    assert all(a <= x and y <= b for k, (a, b) in enumerate(places) for x, y in found[k])
    # what is cut leaves the rest as it was, but for one white space after each span
    cleaned = {r.doc_id: r for r in units.drop_repeated_passages(docs).collect()}
    changed = {r.doc_id: r for r in units.drop_repeated_passages(docs, changed_only=True).collect()}
    assert set(changed) == set(range(1, 60)) and all(changed[k] == cleaned[k] for k in changed) and cleaned[0].text == texts[0]
    for k, r in cleaned.items():
        at, left = 0, ""
        for x, y in r.removed_spans:
            left += texts[k][at:x]
            at = y + 1
        assert r.text == left + texts[k][at:] and [tuple(x) for x in r.removed_spans] == found[k]


def test_passages_that_repeat_in_the_documents(spark):
    """Brute force: words in windows of 50 that stand in an earlier document, copies of whole texts left out."""
    data, texts, seen, repeated = [], set(), set(), {}
    for r in table(spark, "/root/testdata/sf0.01", "documents").orderBy("doc_id").collect():
        words = r.text.lower().split()
        if " ".join(words) in texts:
            continue
        texts.add(" ".join(words))
        data.append((r.doc_id, r.text))
        windows = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        marks = np.zeros(len(words), bool)
        for i, w in enumerate(windows):
            if w in seen:
                marks[i : i + 50] = True
        seen.update(windows)
        if marks.any():
            repeated[r.doc_id] = marks
    found = found_by_passages(spark.createDataFrame(data, "doc_id long, text string"))
    covered, caught = 0, 0
    for doc, text in data:
        if doc in repeated:
            p = units.Passages([text], units.PASSAGE_WORDS)
            hit = np.zeros(len(p.words), bool)
            for x, y in found[doc]:
                hit |= (p.starts >= x) & (p.ends <= y)
            covered += (hit & repeated[doc]).sum()
            caught += (hit & repeated[doc]).any()
    assert len(repeated) > 20 and caught >= 0.95 * len(repeated)
    assert covered > 0.8 * sum(m.sum() for m in repeated.values())


def test_repeated_passages_keep_one_of_each_word(spark):
    rng = random.Random(2)
    data = [(k, " ".join(rng.choice(("aa", "bb", "cc\n", "dd")) for _ in range(rng.randint(1, 30)))) for k in range(40)]
    found, seen = found_by_passages(spark.createDataFrame(data, "doc_id long, text string"), 5), set()
    for doc, text in data:
        p = units.Passages([text], 5)
        assert p.words == text.lower().split() == [text[a:b] for a, b in zip(p.starts, p.ends, strict=True)]
        for w, a in zip(p.words, p.starts.tolist(), strict=True):
            assert w in seen or not any(x <= a < y for x, y in found[doc])
            seen.add(w)


def brute_runs(text, least):
    """Runs of pieces as (first word, word after the last), from their definition."""
    marks = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    words = [text[a:b].lower() for a, b in marks]
    opens, line_ends = [], {len(words)}
    for i, w in enumerate(words):
        before = words[i - 1] if i else None
        broken = i > 0 and "\n" in text[marks[i - 1][1] : marks[i][0]]
        if broken:
            line_ends.add(i)
        pair = 0 if i == 0 else 17 * ord(before[0]) + 101 * ord(before[-1]) + 43 * len(before) + 61 * ord(w[0]) + 31 * ord(w[-1]) + 7 * len(w)
        if i == 0 or broken or before[-1] in ".!?;:" or w == before or pair % 2**31 * 1103515245 % 2**32 < 2**29:
            opens.append(i)
    edges, out = [*opens, len(words)], set()
    for a in opens:
        out |= {(a, min(z for z in edges if z >= a + least))} if any(z >= a + least for z in edges) else set()
    for z in line_ends:
        out |= {(max(a for a in opens if a <= z - least), z)} if any(a <= z - least for a in opens) else set()
    return out


def test_passage_runs_brute_force():
    rng = random.Random(7)
    texts = ["".join(rng.choice(("ab", "c. ", "dé ", " ", "\n", "x ", "ab ", "\u3000y")) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    texts = [t for t in texts if t]
    p = units.Passages(texts, 5)
    got, digests = defaultdict(set), {}
    first = np.searchsorted(p.text, np.arange(len(texts)))
    for k, (a, z) in enumerate(p.runs.tolist()):
        t = p.text[a]
        got[t].add((a - first[t], z - first[t]))
        assert digests.setdefault(" ".join(p.words[a:z]), p.digest(k)) == p.digest(k)
    assert all(got[t] == brute_runs(text, 5) for t, text in enumerate(texts))


def test_run_hashes_tell_equal_runs():
    p = units.Passages(["a b c. a b c. a b d. " * 40, "z a b c. a b c. q"], 3)
    h = p.hashes()
    of = defaultdict(set)
    for k, (a, z) in enumerate(p.runs.tolist()):
        of[" ".join(p.words[a:z])].add(h[k])
    assert all(len(v) == 1 for v in of.values()) and len(set().union(*of.values())) == len(of)
    # no machine's string hashes have a part in them
    code = "from gamelake.llm.units import Passages; print(Passages(['one two three. four five six. ' * 3], 3).hashes().tolist())"
    told = {subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONHASHSEED": seed}, capture_output=True, check=True, text=True).stdout for seed in ("1", "2")}
    assert len(told) == 1


def chunks_of(text, seeds=units.SEEDS):
    """(first line, last line) -> body, of two lines or more."""
    lines = (text or "").split("\n")
    if len(lines) < 2:
        return {}
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out = {}
    for seed in seeds:
        roll = [(h[i] + 31 * (h[i - 1] if i else 0)) % 2**32 * seed % 2**32 for i in range(len(h))]
        first = 0
        for e in [i for i in range(1, len(h) - 1) if roll[i] < roll[i - 1] and roll[i] <= roll[i + 1]] + [len(h) - 1]:
            if e > first and "\n".join(lines[first : e + 1]).strip():
                out[first, e] = "\n".join(lines[first : e + 1])
            first = e + 1
    return out


def around(text):
    """(first, last) of a chunk -> the lines that an extension may reach, of all seeds."""
    out = {}
    for seed in units.SEEDS:
        h = np.array([int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in text.split("\n")], np.uint32)
        ends = units.chunk_ends(h, seed).tolist()
        for k, z in enumerate(ends):
            a = ends[k - 1] + 1 if k else 0
            low = max(0, (ends[k - 2] + 1 if k > 1 else 0) - 2) if k else 0
            out.setdefault((a, z), []).append((low, ends[k + 1] if k + 1 < len(ends) else z))
    return {c: (min(x[0] for x in v), max(x[1] for x in v)) for c, v in out.items()}


def without_repeats(docs):
    """docs: (doc_id, text) in order of rank -> texts."""
    seen, out, all_lines = {}, {}, {}
    for doc, text in docs:
        if text is None:
            out[doc] = None
            continue
        found, gone, lines, reach = [], set(), text.split("\n"), None
        all_lines[doc] = lines
        for (first, last), body in sorted(chunks_of(text).items()):
            reach = reach or around(text)
            if body in seen:
                gone.update(range(first, last + 1))
                found.append((first, last, reach[first, last], seen[body]))
            else:
                seen[body] = doc, first, last, reach[first, last]
        more = set()
        for first, last, (low, high), (k_doc, k_first, k_last, (k_low, k_high)) in found:
            for edge, k_edge, way, far in ((first, k_first, -1, min(first - low, k_first - k_low)), (last, k_last, 1, min(high - last, k_high - k_last))):
                if edge + way not in gone:
                    same = 0
                    while same < far and lines[edge + way * (same + 1)] == all_lines[k_doc][k_edge + way * (same + 1)]:
                        same += 1
                    while same and not lines[edge + way * same].strip(" \t\r"):
                        same -= 1
                    more.update(edge + way * j for j in range(1, same + 1))
        gone |= more
        out[doc] = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
    return out


def test_short_passages_of_lines_are_caught(spark):
    """Share of passages, in other surroundings, that are removed as a whole, by their lines; and no line
    of the surroundings ever is."""
    rng = random.Random(3)
    line = lambda: f"line {rng.random()}"
    data, of = [], {}
    for size, least in ((3, 0.35), (5, 0.8), (8, 0.97)):
        for _ in range(60):
            passage = [line() for _ in range(size)]
            for _ in range(2):
                head, tail = [line() for _ in range(rng.randint(1, 8))], [line() for _ in range(rng.randint(1, 8))]
                of[len(data)] = (size, len(data) % 2, "\n".join([*head, *tail]))
                data.append((len(data), "\n".join([*head, *passage, *tail])))
    whole, texts = Counter(), dict(data)
    for r in units.drop_repeated_chunks(spark.createDataFrame(data, "doc_id long, text string")).collect():
        size, second, bare = of[r.doc_id]
        assert r.text == texts[r.doc_id] or (second and r.text == bare)
        whole[size] += second and r.text == bare
    for size, least in ((3, 0.35), (5, 0.8), (8, 0.97)):
        assert whole[size] >= least * 60, whole


def test_matches_grow_by_equal_lines_only(spark):
    """Lines of blanks at the far end and lines that differ in one byte stay; both ends of a text may be reached."""
    rng = random.Random(11)
    body = [f"line {rng.random()}" for _ in range(12)]
    cases = {2: ["own", "", *body, "", "end"], 3: ["own", *body[:-1], body[-1] + "."], 4: body, 5: ["x", *body[:6], "other", *body[6:], "y"]}
    data = [(1, "\n".join(["first", "", *body, "", "last"])), *((d, "\n".join(x)) for d, x in cases.items()), (6, None), (7, ""), (4, "\n".join(body))]
    got = [(r.doc_id, r.text) for r in units.drop_repeated_chunks(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    assert got.count((4, "")) == 2 and (2, "own\n\n\nend") in got and (6, None) in got and (7, "") in got
    assert (3, "own\n" + body[-1] + ".") in got
    want = without_repeats(sorted(dict(data).items()))
    assert dict(got) == want and got.count((1, data[0][1])) == 1


def test_repeated_chunks(spark, sf, odd, empty):
    docs = table(spark, sf, "documents")
    want = without_repeats(sorted((r.doc_id, r.text) for r in docs.collect()))
    assert {r.doc_id: r.text for r in units.drop_repeated_chunks(docs).collect()} == want
    out = units.drop_repeated_chunks(odd, offsets=None)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = defaultdict(set)
    for r in out.collect():
        texts[r.doc_id].add(r.text)
    assert len(texts[5]) == 1 and len(next(iter(texts[5]))) < len(SHARED) // 2
    assert texts[6] == {"same same\nsame same"} and texts[7] == {""}
    assert units.drop_repeated_chunks(empty).count() == 0


def test_chunks_resist_shifts():
    rng = random.Random(0)
    body = [f"line {rng.random()}" for _ in range(60)]
    for seed in units.SEEDS:
        a = set(chunks_of("\n".join(body), [seed]).values())
        b = set(chunks_of("\n".join(["new"] + body), [seed]).values())
        assert len(a & b) >= len(a) - 2


def test_byte_comparison_keeps_chunks_that_only_hash_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "c\nd")], "doc_id long, text string")
    real = units._cut
    monkeypatch.setattr(units, "_cut", lambda *a: real(*a).withColumn("digest", F.lit(b"same")))
    assert {r.text for r in units.drop_repeated_chunks(docs).collect()} == {"a\nb", "c\nd"}


# 2: top-k


def test_top_k_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    data = [(20, [1.0, 2.0]), (40, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.5]), (2, [-1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [inf, 1.0]), (6, [nan, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [0.1, 0.2, 0.3])]
    df = spark.createDataFrame([(a, b, 1) for a, b in data], "vec_id long, embedding array<float>, score int")
    v = topk.integer_vectors(df)
    assert sorted(r.vec_id for r in v.collect()) == [1, 2, 8, 20, 40]
    out = rows_of(topk.top_k(v, v.filter("vec_id % 20 = 0"), 2))
    s = 64 * 64 + 128 * 128
    assert out == [(20, 1, 1, s), (20, 2, 40, s), (40, 1, 1, s), (40, 2, 20, s)]
    assert topk.top_k(v.filter("false"), v.filter("false")).count() == 0


def test_top_k_brute_force_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 64)
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (300, 6)) / 8.0
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    v = topk.integer_vectors(df)
    got = rows_of(topk.top_k(v, v.filter("vec_id % 5 = 0"), 7))
    n = np.floor(64 * x).astype(int)
    want = []
    for q in range(0, 300, 5):
        order = sorted((-int(n[q] @ n[c]), c) for c in range(300) if c != q)[:7]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(order)]
    assert got == sorted(want, key=repr)


def test_top_k_resolves_few_entries(spark, monkeypatch):
    """Beyond the cutoff's pass, exact totals are made of a small part of all pairs."""
    counted = spark.sparkContext.accumulator(0)
    real = topk.resolved

    def counting(lists, rows, columns):
        if rows.ndim == 1:
            counted.add(len(rows))
        return real(lists, rows, columns)

    monkeypatch.setattr(topk, "resolved", counting)
    x = np.random.default_rng(9).normal(0, 0.3, (2000, 16))
    df = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    v = topk.integer_vectors(df)
    out = topk.top_k(v, v.filter("vec_id % 20 = 0"), 10).collect()
    assert len(out) == 1000 and 1000 <= counted.value < 0.2 * 100 * 2000


def test_top_k_beyond_doubles(spark):
    data = [(0, [2**31 + 1, 2**28 + 1]), (20, [1, 2**30 + 3]), (1, [2**30 + 1, 7]), (2, [2**30 + 1, 8]), (3, [2**30, 2**32])]
    v = spark.createDataFrame(data, "vec_id long, v array<long>")
    want = []
    for q, a in data[:2]:
        order = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in data if c != q)[:3]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(order)]
    assert rows_of(topk.top_k(v, v.filter("vec_id % 20 = 0"), 3)) == sorted(want, key=repr)


# 4: mixing


def test_mixing_odd_rows_and_shares(spark, odd, empty):
    out = mixing.mix(odd)
    assert set(out.columns) == set(odd.columns)  # copy and mix_key are replaced
    assert mixing.mix(empty).count() == 0
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    counts = {r.source: r["count"] for r in mixing.mix(docs).groupBy("source").count().collect()}
    assert all(abs(n - 1200) < 5 * math.sqrt(1200) for n in counts.values())
    w = spark.createDataFrame([("hot", 3.0), ("s1", 1.0), ("s2", 0.0)], "source string, weight double")
    counts = {r.source: r["count"] for r in mixing.mix(docs, weights=w, size=8000).groupBy("source").count().collect()}
    assert set(counts) == {"hot", "s1"} and abs(counts["hot"] - 6000) < 400 and abs(counts["s1"] - 2000) < 250
    assert rows_of(mixing.mix(docs)) == rows_of(mixing.mix(docs.repartition(5)))


def test_mixing_large_rates_and_python_free_plan(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, source string")
    n = mixing.mix(docs, size=4000).count()
    assert abs(n - 4000) < 5 * math.sqrt(4000)
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_mixing_sql_with_null_sources(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"t{k}", "en", None if k % 3 else "s", k) for k in range(60)], SCHEMA)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = connect(str(tmp_path))
    con.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    assert_same(mixing.mix(docs), con, queries.ORACLE_SQL["op4_mixing"])


# 5 and 10: classifiers


def test_dual_descent_against_definition():
    spec = nb_linear.Spec(orders=(1, 2), loss="hinge", bits=10, epochs=200, cost=1.0)
    rng = np.random.default_rng(0)
    b = nb_linear.Buckets(spec)
    texts = ["".join(rng.choice(list("abcxyz" if k % 2 else "abcuvw"), 30)) for k in range(60)]
    rows, y = [b(t).astype(int) for t in texts], np.arange(60) % 2
    ratios = nb_linear.log_count_ratios(rows, y, spec)
    dense = np.zeros((60, 1 << 10))
    for i, r in enumerate(rows):
        dense[i, r] = 1
        assert len(set(r)) == len(r)
    p, q = dense[y == 1].sum(0), dense[y == 0].sum(0)  # 30 documents of either class, half a smoothing count for each
    assert np.allclose(ratios, np.where(p + q > 0, np.log((p + 0.5) / 30) - np.log((q + 0.5) / 30), 0))
    w, bias = nb_linear.descend(rows, y, ratios, spec)
    x, s = np.hstack([dense * ratios, np.ones((60, 1))]), np.where(y > 0, 1, -1)
    full = np.append(w, bias)
    objective = lambda v: 0.5 * v @ v + np.maximum(0, 1 - s * (x @ v)).sum()
    best = objective(full)
    for _ in range(200):
        assert objective(full + rng.normal(0, 0.01, len(full)) * (rng.random(len(full)) < 0.1)) >= best - 1e-3


def test_logistic_descent_minimises_its_objective():
    spec = nb_linear.Spec(orders=(1, 2), loss="logistic", bits=10, epochs=200, cost=0.7)
    rng = np.random.default_rng(1)
    b = nb_linear.Buckets(spec)
    texts = ["".join(rng.choice(list("abcxyz" if k % 3 else "abcuvw"), 20)) for k in range(45)]
    rows, y = [b(t).astype(int) for t in texts], (np.arange(45) % 3 > 0).astype(int)
    ratios = nb_linear.log_count_ratios(rows, y, spec)
    w, bias = nb_linear.descend(rows, y, ratios, spec)
    dense = np.zeros((45, 1 << 10))
    for i, r in enumerate(rows):
        dense[i, r] = 1
    x, s, v = np.hstack([dense * ratios, np.ones((45, 1))]), np.where(y > 0, 1.0, -1.0), np.append(w, bias)
    # the gradient of |v|^2 / 2 + C sum log(1 + exp(-s x v)) is zero at the minimum
    grad = v - 0.7 * x.T @ (s / (1 + np.exp(s * (x @ v))))
    assert np.abs(grad).max() < 2e-2 and np.abs(v).max() > 0.05


def test_platt_against_a_grid():
    rng = np.random.default_rng(2)
    y = (np.arange(200) % 4 == 0).astype(int)
    margin = rng.normal(0, 1, 200) + 1.5 * (y - 0.4)
    a, b = nb_linear.platt(margin, y)
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))

    def loss(a, b):
        z = a * margin + b
        return (np.logaddexp(0, z) - t * z).sum() + 5e-4 * (a - 1) ** 2 + 5e-4 * b * b * 0

    assert all(loss(a, b) <= loss(a + i / 50, b + j / 50) + 1e-6 for i in range(-20, 21) for j in range(-20, 21))


@pytest.mark.parametrize("spec", [quality.SPEC, toxicity.SPEC], ids=["quality", "toxicity"])
def test_score_from_the_set_of_ngrams(spark, odd, labels, spec):
    """Buckets are the distinct n-grams' hashes, and a score is the sigmoid of their weights' sum."""

    def grams(text):
        text = (text or "").lower() if spec.lower else text or ""
        if spec.blank and text:
            text = f" {' '.join(text.split())} "
        out = set()
        for n in spec.orders:
            for i in range(len(text) - n + 1):
                h = 0
                for c in text[i : i + n]:
                    h = (h * 0x01000193 + ord(c)) % 2**32
                out.add(((h ^ (n * 0x9E3779B9 % 2**32)) * 0x85EBCA6B % 2**32) >> (32 - spec.bits))
        return out

    model = nb_linear.fit(odd, labels, "text", "doc_id", "quality", spec)
    b = nb_linear.Buckets(spec)
    for r in odd.filter("doc_id <> 3").select("text", nb_linear.score(F.col("text"), model, odd).alias("s")).collect():
        own = sorted(grams(r.text))
        assert sorted(b(r.text).tolist()) == own
        margin = model.weights[own].astype(float).sum() + model.bias
        assert abs(r.s - 1 / (1 + math.exp(-(model.slope * margin + model.shift)))) < 1e-6


def test_sample_is_bounded_in_bytes(spark):
    spec = nb_linear.Spec(orders=(1,), loss="hinge", max_rows=50, max_bytes=1600)
    docs = spark.createDataFrame([(k, "x" * (90 if k % 3 else 101)) for k in range(100)] * 3 + [(k, "y" * 5) for k in range(100)], "doc_id long, text string")
    labels = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    got = nb_linear.sample_of(docs, labels, "text", "doc_id", "quality", spec).collect()
    assert len({r.key for r in got}) == len(got) and sum(len(r.text) for r in got) <= 1600 and max(len(r.text) for r in got) <= 100
    assert len(got) > 10


def held_out(df, labels, col):
    return df.join(labels.filter(F.col(col).isNotNull()), "doc_id").filter("held_out").select("score", "predicted", F.col(col).alias("y")).toPandas()


def test_classifiers_held_out(spark):
    sf = "/root/testdata/sf0.1"
    lab = table(spark, sf, "labels")
    q = held_out(queries.op10_quality(spark, sf), lab, "quality")
    assert (q.predicted == q.y).mean() > 0.95 and q[q.y == 1].predicted.mean() > 0.98
    t = held_out(queries.op5_toxicity(spark, sf), lab, "toxic")
    assert t[t.y == 1].predicted.mean() > 0.9 and t[t.y == 0].predicted.mean() < 0.01


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifier_odd_rows(spark, odd, empty, labels, kind):
    score = quality.score_quality if kind == "quality" else toxicity.score_toxicity
    fit = quality.fit_quality if kind == "quality" else toxicity.fit_toxicity
    model = fit(odd, labels)
    out = score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    by = defaultdict(set)
    for r in out:
        by[r.doc_id].add(r.score)
    assert by[1] == by[2] and len(by[5]) == 1 and by[6] == by[7]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert score(empty, model).count() == 0
    none = fit(empty, labels.filter("false"))
    assert {r.score for r in score(odd, none).collect()} == {0.5}
    if kind == "quality":
        kept = quality.keep_good(odd, labels)
        assert kept.columns == odd.columns


# 6: audio


def brute_ima(block):
    steps, out = telephony.ima_steps().tolist(), []
    pred = int.from_bytes(block[:2], "little", signed=True)
    idx = min(block[2], 88)
    out.append(pred)
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = steps[idx]
            diff = step >> 3
            diff += step * (code >> 2 & 1) + (step >> 1) * (code >> 1 & 1) + (step >> 2) * (code & 1)
            pred = max(-32768, min(32767, pred - diff if code & 8 else pred + diff))
            idx = max(0, min(88, idx + (-1, -1, -1, -1, 2, 4, 6, 8)[code & 7]))
            out.append(pred)
    return out


def test_codecs_brute_force():
    rng = np.random.default_rng(0)
    blocks = rng.integers(0, 256, (5, 68)).astype(np.uint8)
    assert telephony.decode_ima(blocks).tolist() == [brute_ima(b.tobytes()) for b in blocks]
    mu, a = telephony.mulaw_table(), telephony.alaw_table()
    assert (mu[0x00], mu[0x80], mu[0xFF], mu[0x7F]) == (-32124, 32124, 0, 0)
    assert (a[0x55], a[0xD5], a[0x2A], a[0xAA]) == (-8, 8, -32256, 32256)
    x = np.array([0, 100, -100], np.int16)
    assert telephony.resample(x, 8000, 16000).tolist() == [0, 50, 100, 0, -100, -100]


def brute_pcm(media, to=16_000):
    """Samples of a file as ``wave`` writes it, one at a time, at the new rate."""
    tag, body = int.from_bytes(media[20:22], "little"), media[media.index(b"data") + 8 :]
    if tag == telephony.IMA:
        pcm = [x for k in range(0, len(body), 68) for x in brute_ima(body[k : k + 68])]
    else:
        pcm = [int((telephony.mulaw_table() if tag == telephony.MULAW else telephony.alaw_table())[b]) for b in body]
    out = []
    for k in range(len(pcm) * to // 8000):
        low, part = divmod(k * 8000, to)
        out.append((pcm[low] * (to - part) + pcm[min(low + 1, len(pcm) - 1)] * part) // to)
    return out


def test_audio_round_trip(spark, odd, empty):
    read = lambda df: telephony.to_pcm(telephony.store_texts(df))
    table_ = read(odd)
    files = defaultdict(set)
    for r in table_.collect():
        files[r.doc_id].add((r.media, r.pcm))
    texts = defaultdict(set)
    for r in odd.collect():
        texts[r.doc_id].add(r.text or "")
    for r in telephony.features(table_).collect():
        (text,) = texts[r.doc_id]
        body = text.encode()
        padded = body + b"\0" * (-len(body) % 64 or (0 if body else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        media = telephony.store(padded, telephony.codec_of(padded))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        ((kept, pcm),) = files[r.doc_id]
        assert kept == media
        if len(text) < 10_000:
            x = brute_pcm(media)
            assert pcm == telephony.wave(telephony.PCM, np.array(x, "<i2").tobytes(), 16_000)
            name = {telephony.MULAW: "mulaw", telephony.ALAW: "alaw", telephony.IMA: "ima"}[telephony.codec_of(padded)]
            crossings = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:]))
            crc = zlib.crc32(b"".join(v.to_bytes(2, "little", signed=True) for v in x))
            assert r.feature == f"{name};rate=16000;n={len(x)};peak={max(map(abs, x))};power={sum(v * v for v in x) // len(x)};zc={crossings};crc={crc}"
    assert telephony.features(table_).count() == odd.count() and telephony.features(read(empty)).count() == 0


def test_damaged_and_foreign_media(spark):
    good = telephony.wave(telephony.MULAW, b"\x10" * 64)
    ima = telephony.store(bytes(128), telephony.IMA)
    pcm = telephony.wave(telephony.PCM, b"\x01\x02" * 10)
    patched = lambda f, at, value: f[:at] + value + f[at + len(value) :]
    bad = {
        "null": None, "empty": b"", "text": b"no audio", "cut in fmt": good[:30], "only RIFF": good[:12], "rate 0": patched(good, 24, bytes(4)),
        "two channels": patched(good, 22, b"\x02\x00"), "8-bit PCM": patched(patched(pcm, 34, b"\x08\x00"), 32, b"\x01\x00"), "other format": patched(good, 20, b"\x02\x00"), "other blocks": patched(ima, 32, b"\x00\x01"),
    }
    short = {"no data": telephony.wave(telephony.ALAW, b""), "odd PCM": telephony.wave(telephony.PCM, b"\x01\x02\x03"), "part of a block": ima[: -68 - 3], "cut": good[:-60]}
    files = bad | short | {"good": good}
    df = spark.createDataFrame([(k, 0, m, 1) for k, m in enumerate(files.values())], "doc_id long, n_bytes long, media binary, pcm int")
    out = {name: r for name, r in zip(files, telephony.to_pcm(df).orderBy("doc_id").collect(), strict=True)}
    assert all(out[n].pcm is None for n in bad) and all(out[n].pcm is not None for n in (*short, "good"))
    size = {n: (len(out[n].pcm) - 44) // 2 for n in (*short, "good")}
    assert size == {"no data": 0, "odd PCM": 2, "part of a block": 0, "cut": 8, "good": 128}
    shown = {name: r for name, r in zip(files, telephony.features(telephony.to_pcm(df)).orderBy("doc_id").collect(), strict=True)}
    for name, r in shown.items():
        assert (r.feature is None) == (r.payload_bytes is None) == (name in bad)
        assert (r.media_bytes, r.media_sha256) == ((None, None) if files[name] is None else (len(files[name]), hashlib.sha256(files[name]).hexdigest()))
    assert shown["no data"].feature == "alaw;rate=16000;n=0;peak=0;power=0;zc=0;crc=0"


# 7: language


def test_kneser_ney_sums_to_one():
    texts = [langid.normal(t) for t in ("abab abba ab", "baab ba")]
    orders = langid.fit_language(texts, 3)
    alphabet = sorted({int(c) for t in texts for c in t})
    for context in ("ab", "ba", "  ", "b "):
        total = 0.0
        for c in alphabet:
            h = langid.gram_hashes(np.array([*map(ord, context), c], np.uint16), 3)
            hashes = [h[n - 1][-1:] for n in (1, 2, 3)]
            ctx = [np.zeros(1, np.uint64), h[0][-2:-1], h[1][-2:-1]]
            total += langid.probabilities(orders, hashes, ctx)[0]
        assert 0.9 < total <= 1.0 + 1e-6  # the rest belongs to characters never seen


def test_kneser_ney_brute_force():
    text = "abcabd abc"
    order = 2
    orders = langid.fit_language([langid.normal(text)], order)
    s = " " + text
    big = Counter(s[i : i + 2] for i in range(len(s) - 1))
    d2 = (lambda one, two: one / (one + 2 * two) if one and two else 0.5)(sum(v == 1 for v in big.values()), sum(v == 2 for v in big.values()))
    cont = Counter(g[1] for g in big)
    d1 = (lambda one, two: one / (one + 2 * two) if one and two else 0.5)(sum(v == 1 for v in cont.values()), sum(v == 2 for v in cont.values()))
    for g in ("ab", "bd", "ca", "zz"):
        low = max(cont[g[1]] - d1, 0) / sum(cont.values()) + d1 * len(cont) / sum(cont.values()) / langid.VOCABULARY
        ctx = sum(v for k, v in big.items() if k[0] == g[0])
        want = low if not ctx else max(big[g] - d2, 0) / ctx + d2 * sum(k[0] == g[0] for k in big) / ctx * low
        h = langid.gram_hashes(np.array([*map(ord, g)], np.uint16), order)
        p = langid.probabilities(orders, [h[0][-1:], h[1][-1:]], [np.zeros(1, np.uint64), h[0][-2:-1]])[0]
        assert abs(p - want) < 1e-6


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op7_langid(spark, sf).join(table(spark, sf, "documents"), "doc_id").filter("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.97


def test_language_odd_rows(odd, empty):
    m = langid.fit(odd)
    out = {r.doc_id: r for r in langid.identify(odd, m).collect()}
    assert out[1].lang_pred == out[2].lang_pred == out[9].lang_pred == "und" and out[1].score == 0
    assert out[4].lang_pred in ("en", "fr") and 0 <= out[4].score <= 1
    assert langid.identify(empty, m).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(empty)).collect()} == {"und"}


def test_language_answers_against_plain_probabilities(spark, sf):
    """lang_pred, score and rejected from each text's own n-grams, without the table of scored ones."""
    docs = table(spark, sf, "documents").filter("doc_id < 60")
    docs = docs.union(spark.createDataFrame([(1000, "zq xj vw kkq zzx qqj", "en", "s", 1), (1001, "", "en", "s", 0)], docs.schema))
    models = langid.fit(docs)
    names, texts = sorted(models.orders), {r.doc_id: r.text for r in docs.collect()}
    for r in langid.identify(docs, models).collect():
        plain = langid.normal(texts[r.doc_id])
        if not len(plain):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, False)
            continue
        n = models.spec.order
        h = langid.gram_hashes(plain, n)
        hashed = [h[k - 1][n - k :] for k in range(1, n + 1)]
        before = [np.zeros(len(plain), np.uint64), *(h[k - 2][n - k : -1] for k in range(2, n + 1))]
        e = [-np.log2(langid.probabilities(models.orders[name], hashed, before)).mean() for name in names]
        best = int(np.argmin(e))
        odds = np.exp(-models.sharpness * math.sqrt(len(plain)) * (np.array(e) - min(e)))
        assert r.lang_pred == names[best] and abs(r.score - odds[best] / odds.sum()) < 1e-3
        assert r.rejected == (e[best] > models.limits.get(names[best], math.inf))
    assert models.sharpness in 2.0 ** np.arange(-6, 8) and set(models.limits) <= set(names)


# 8: byte-pair encoding


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


def summed(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_equals_library(spark, sf, odd, empty, tokenizer):
    for docs in (table(spark, sf, "documents"), odd):
        want = sorted(((r.doc_id, *summed(tokenizer, r.text)) for r in docs.collect()), key=repr)
        assert rows_of(bpe.encode_and_decode(docs)) == want
    assert bpe.encode_and_decode(empty).count() == 0


def test_chunk_joins_are_exact(tokenizer):
    c = bpe.Codec(open(bpe.default_vocabulary(), encoding="utf-8").read())
    rng = random.Random(1)
    odd_texts = ["".join(rng.choice(" ab'sre.\n\t1é日<|>") for _ in range(3000)) for _ in range(5)] + ["a" * 3000, "日本語 テスト" * 300, "x  y 　z\x1c " * 300, "it's 're <|endoftext|> " * 200]
    for text in odd_texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert c.encode(text) == want
        body = text.encode()
        places = sorted(rng.sample(range(1, len(text)), 12))
        cuts = [len(text[:p].encode()) for p in places] + [len(body)]
        parts = [c.encode(body[x:y].decode()) for x, y in zip([0, *cuts[:-1]], cuts, strict=True)]
        assert bpe.join_chunks(c, body, cuts, parts) == want


def test_bpe_of_thousands_of_special_tokens(spark, tokenizer):
    data = [(1, "<|endoftext|>" * 5000), (2, "it's <|endoftext|> a " * 5000)]
    want = sorted((d, *summed(tokenizer, t)) for d, t in data)
    assert rows_of(bpe.encode_and_decode(spark.createDataFrame(data, "doc_id long, text string"))) == want


def test_bpe_of_very_long_runs(spark, tokenizer):
    many = 1_000_000
    runs = [" " * many + "a", "b" + " " * many, "\t" * many + "!x", "c" + "\n" * many + "d", "!" * many + " e", "e " + "\u3000\xa0" * 50_000 + "f", " " * 5000 + "<|endoftext|>" + "\n" * 5000 + "g", "\x1c" * 6000 + "h", " " * 4096 + "\n"]
    data = list(enumerate(runs)) + [(len(runs) + k, "some text " * 50 + t[:200_000]) for k, t in enumerate(runs)]
    want = sorted(((d, *summed(tokenizer, t)) for d, t in data), key=repr)
    assert rows_of(bpe.encode_and_decode(spark.createDataFrame(data, "doc_id long, text string"))) == want


# 9: near-duplicates


def brute_print(text):
    words = [w for w in (text or "").encode().lower().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """prints: {doc: fingerprint} -> {doc: smallest linked doc}."""
    docs = sorted(prints)
    of = {d: d for d in docs}

    def root(d):
        while of[d] != d:
            d = of[d]
        return d

    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                of[y] = x
    return {d: root(d) for d in docs}


def test_simhash_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    prints = {r.doc_id: brute_print(r.text) for r in docs.collect()}
    groups = brute_components(prints)
    want = sorted(((d, f"{p:016x}", groups[d]) for d, p in prints.items()), key=repr)
    assert rows_of(simhash.near_duplicates(docs)) == want


def test_index_meets_every_four_positions():
    from itertools import combinations

    triples = [set(t) for t in simhash.index_triples()]
    assert len(triples) == 20 and all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_links_in_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = set()
    for b in base:
        for _ in range(40):
            x = b
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << bit
            prints.add(x)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = defaultdict(set)
    for r in graph.connected_components(found).collect():
        got[r.component].add(r.node)
    want = defaultdict(set)
    for d, c in brute_components({p: p & (2**64 - 1) for p in signed}).items():
        want[c].add(d)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_spanning_links_brute_force():
    rng = random.Random(11)
    for shared in (0, 2, 3, 5):
        base = [rng.getrandbits(64) for _ in range(6)]
        mask = (1 << 8 * (8 - shared)) - 1
        high = rng.getrandbits(64) & ~mask & (2**64 - 1)
        prints = set()
        for b in base:
            for _ in range(15):
                x = (b & mask) | high
                for bit in rng.sample(range(64 - 8 * shared), rng.randint(0, 6)):
                    x ^= 1 << bit
                prints.add(x)
        fps = np.array(sorted(prints), np.uint64).view(np.int64)
        a, b = simhash.spanning_links(fps)
        pairs = set(zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist()))
        assert all((x ^ y).bit_count() <= 4 for x, y in pairs)
        of = {p: p for p in prints}

        def root(p):
            while of[p] != p:
                p = of[p]
            return p

        for x, y in pairs:
            assert root(x) != root(y)  # a forest
            of[max(root(x), root(y))] = min(root(x), root(y))
        assert {p: root(p) for p in prints} == brute_components({p: p for p in prints})


def test_a_hot_list_is_dealt_in_a_bounded_number_of_rows(spark, monkeypatch):
    """Thousands of fingerprints that share three bytes: cells hold few of them, and all links are found."""
    monkeypatch.setattr(simhash, "CELL", 64)
    rng = random.Random(12)
    prints = set()
    while len(prints) < 3000:
        prints.add((0xABCDEF << 40) | rng.getrandbits(40) & 0x3F3F3F3F3F)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    sizes = spark.sparkContext.accumulator(0)
    real = simhash.spanning_links

    def counting(fps):
        sizes.add(len(fps))
        return real(fps)

    monkeypatch.setattr(simhash, "spanning_links", counting)
    groups = graph.connected_components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")))
    got = defaultdict(set)
    for r in groups.collect():
        got[r.component].add(r.node)
    want = defaultdict(set)
    for d, c in brute_components({p: p & (2**64 - 1) for p in signed}).items():
        want[c].add(d)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
    assert sizes.value < 3000 * 3000 / 64 * 20 / 3


def test_simhash_odd_rows(odd, empty):
    out = simhash.near_duplicates(odd)
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd.count()
    assert by[1].fingerprint == by[2].fingerprint == "0" * 16 and by[2].component_id == 1
    assert by[7].component_id == 6 and by[None].component_id is None
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 6, 8, 9, None], key=repr)  # 5 (twice) is near 4, 7 equals 6
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    out = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# pipeline


def brute_count(doc, rate):
    parts = max(1, math.ceil(rate / 16))
    total = 0
    for j in range(1, parts + 1):
        u = (int(hashlib.md5(f"42:{doc}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        mean, k = rate / parts, 0
        term = cdf = math.exp(-mean)
        while cdf < u and k < int(mean + 12 * math.sqrt(mean) + 40):
            k += 1
            term = term * mean / k
            cdf += term
        total += k
    return total


def test_pipeline_equals_brute_force(spark, sf, tokenizer):
    docs = table(spark, sf, "documents")
    good = {r.doc_id for r in quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf, "labels"))).filter("predicted = 1").collect()}
    now = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    texts = without_repeats(sorted((d, r.text) for d, r in now.items()))
    groups = brute_components({d: brute_print(t) for d, t in texts.items()})
    kept = [d for d, g in groups.items() if d == g]
    n = Counter(now[d].source for d in kept)
    want = []
    for d in kept:
        rate = len(kept) * 1.0 / len(n) / n[now[d].source]
        want += [(d, *summed(tokenizer, texts[d]))] * brute_count(d, rate)
    assert rows_of(corpus_pipeline.run(spark, sf)) == sorted(want, key=repr)


def test_pipeline_stages_on_odd_rows(spark, odd, empty, sf):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
