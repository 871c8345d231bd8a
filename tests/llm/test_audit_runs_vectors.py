"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm.filter_audit import FILTERS, PositionalCounter, filter_audit
from farebox.llm.lattice_join import SHORTEST, LatticeTables, embedding_near_duplicates, hit_odds, nearest_e8, neighbours, tables_for
from farebox.llm.periodic_runs import RunFinder, op12_periodic_runs, periodic_runs, planted, runs_of_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- operator 11

def test_positional_counter_counts_bits():
    r = random.Random(3)
    words = [r.getrandbits(32) for _ in range(1000)]
    times = [r.choice([0, 1, 1, 2, 7, 1000, 3_000_000_000]) for _ in words]
    counter, plain = PositionalCounter(), PositionalCounter()
    for a in range(0, 1000, 37):
        counter.add_times(np.array(words[a:a + 37], np.uint32), np.array(times[a:a + 37]))
        plain.add(np.array(words[a:a + 37], np.uint32))
    assert counter.counts().tolist() == [sum(t for w, t in zip(words, times) if w >> b & 1) for b in range(32)]
    assert plain.counts().tolist() == [sum(w >> b & 1 for w in words) for b in range(32)]
    assert all(len(p) <= 2 for p in plain.planes)


def audit_by_hand(rows, labels):
    """(part, order, step) -> counts, filter by filter."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    docs = []
    for i, text, part in rows:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows)}
        docs.append((part or "", fails, i in good, i in toxic))
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                here = [d for d in docs if d[0] == part]
                reach = [d for d in here if not any(d[1][x] for x in order[:step - 1])]
                gone = [d for d in reach if d[1][f]]
                out[part, order, step] = (
                    len(reach) - len(gone), len(gone), sum(d[1][f] for d in here) - len(gone),
                    sum(d[1][f] and sum(d[1].values()) == 1 for d in here), sum(d[2] for d in gone), sum(d[3] for d in gone))
                total[part, f] += len(gone)
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_filter_audit_against_brute_force(spark, folder):
    r = random.Random(5)
    words = [f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]

    def text():
        n = r.choice([0, 3, 199, 200, 260])
        t = " ".join(r.sample(words, n) if r.random() < 0.6 else r.choices(words[:20], k=n))
        return t + r.choice(["", "", " #", " A", " " + "ABC" * 20, "\n\t\x0b"])

    rows = [(i, text(), r.choice(["s1", "s2", None, ""])) for i in range(150)]
    rows += [(i + 1000 * r.randrange(2), r.choice(rows[:60])[1], "s1") for i in range(120)]  # copies, under equal and other ids
    rows += [(None, rows[0][1], "s3"), (None, None, "s2"), (None, None, "s2"), (7, None, None), (7, "", "s1"), (-5, rows[1][1], "s2")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 200, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    clash = docs.withColumnsRenamed({}).withColumns({"part": F.lit("x"), "n": F.lit(1), "digest": F.lit("y")})
    got = filter_audit(clash, marks, folder).collect()
    want = audit_by_hand(rows, labels)
    assert {(g.part, g.filter_order, g.step): (g.kept, g.removed, g.redundant, g.unique_fails, g.good_lost, g.toxic_lost, g.shapley) for g in got} == want
    assert len(got) == len(want) == 600 * 4
    for part in {g.part for g in got}:  # shares of the filters add up to all that is removed, in every order
        shares = {g.filter_order[g.step - 1]: g.shapley for g in got if g.part == part}
        assert sum(shares.values()) == 120 * sum(g.removed for g in got if g.part == part and g.filter_order == FILTERS)


def test_filter_audit_of_nothing(spark, none, folder):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(none.withColumn("source", F.lit("a")), marks, folder).collect() == []


# -- operator 12

def runs_by_hand(w):
    """(start, length, period) of all runs, period by period."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((b, e - b, q) for (b, e), q in found.items())


def sequences(seed):
    """Word codes rich in runs: small alphabets, Fibonacci words, powers of powers, squares of periodic words, copied passages."""
    r = random.Random(seed)
    a, b = [1], [1, 2]
    while len(b) < 300:
        a, b = b, b + a
    yield b
    yield [1] * 300
    for _ in range(40):
        n = r.randrange(0, 300)
        yield [r.randrange(2) for _ in range(n)]
        unit = [r.randrange(1, 4) for _ in range(r.randrange(1, 60))]
        yield [9, 8] + unit * r.randrange(1, 7) + unit[:r.randrange(len(unit))] + [7]
        inner = [1] * r.randrange(1, 40) + [2] * r.randrange(3)
        yield ((inner * r.randrange(1, 4) + [1] * r.randrange(5)) * r.randrange(1, 5))[:500]
        small = [r.randrange(5) for _ in range(r.randrange(1, 5))]
        part = small * r.randrange(3, 30) + small[:r.randrange(len(small) + 1)]
        yield (part + part + small * r.randrange(20) + part)[:500]
        w = [r.randrange(500) for _ in range(n)]
        if n > 20:
            at, back = r.randrange(n), r.randrange(n)
            w = w[:at] + w[max(0, at - back):at] + w[at:]
        yield w


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    texts = list(sequences(seed))
    sizes = np.array([len(t) for t in texts])
    of, runs = runs_of_texts(np.array([x for t in texts for x in t]), sizes)
    for k, t in enumerate(texts):
        assert [tuple(x) for x in runs[of == k].tolist()] == runs_by_hand(t), t
    assert len(runs) > 500


def test_runs_do_not_rest_on_hashes(monkeypatch):
    """With hashes of four bits nearly all proposals are wrong; the runs stay the same."""
    from farebox.llm import periodic_runs as module
    mixed = module._mix
    monkeypatch.setattr(module, "_mix", lambda x: mixed(x) & np.uint64(15))
    for t in list(sequences(9))[:60]:
        words = np.append(np.array(t, np.int64), 10**6)
        assert [(b, e - b, q) for b, e, q in RunFinder(words, len(t)).runs().tolist()] == runs_by_hand(t)


def collapsed_by_hand(w):
    stay = [True] * len(w)
    for b, n, q in runs_by_hand(w):
        stay[b + q:b + n] = [False] * (n - q)
    return " ".join(x for x, s in zip(w, stay) if s)


def test_periodic_runs_of_texts(spark, odd, none):
    got = periodic_runs(odd.selectExpr("*", "1 as n_words", "doc_id as start").drop("n_words")).collect()
    assert len(got) == odd.count()
    texts = Counter((r.doc_id, r.text or "") for r in odd.collect())
    for (i, t), n in texts.items():
        w = WORD.findall(t)
        hits = [r for r in got if r.doc_id == i and r.n_words == len(w) and [tuple(x) for x in r.runs] == runs_by_hand(w) and r.collapsed == collapsed_by_hand(w)]
        assert len(hits) >= n
    assert periodic_runs(none).collect() == []
    long = spark.createDataFrame([(1, "x " * 40_000 + " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(5000))))], "doc_id long, text string")
    assert [tuple(x) for x in periodic_runs(long).first().runs] == [(0, 40_000, 1), (40_000, 10_000, 5000)]


def test_op12_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for i, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        if n > 1500:
            continue  # too slow by hand
        runs = runs_by_hand(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join(f"{b},{m},{q}\n" for b, m, q in runs).encode()).hexdigest(),
                     hashlib.sha256(collapsed_by_hand(w).encode()).hexdigest()))
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, sf).collect()}
    assert [got[x[0]] for x in want] == want and sum(x[1] > 0 for x in want) > 5


def test_planting_leaves_rows_without_words_or_id(spark):
    rows = spark.createDataFrame([(None, "a b"), (4, None), (41, ""), (41, " \n")], "doc_id long, text string")
    assert [r[0] for r in rows.select(planted(F.col("doc_id"), F.col("text"))).collect()] == ["a b", None, "", " \n"]


# -- operator 13

def test_e8_decoding_finds_the_nearest_point():
    assert SHORTEST.shape == (240, 8) and {round(float(v @ v), 9) for v in SHORTEST} == {2.0}
    x = np.random.default_rng(0).normal(size=(300, 8)) * 2
    point = nearest_e8(x)
    assert np.allclose(point * 2, np.rint(point * 2)) and (np.rint(point.sum(1)) % 2 == 0).all()
    away = ((x - point) ** 2).sum(1)
    for v in SHORTEST:
        assert (((x - point - v) ** 2).sum(1) >= away - 1e-9).all()
    near = neighbours(x, point, 240)
    d = ((x[:, None] - near) ** 2).sum(2)
    four = ((x[:, None] - neighbours(x, point, 4)) ** 2).sum(2)
    assert np.allclose(np.sort(four, 1), np.sort(d, 1)[:, :4])


def test_simulated_odds_match_real_projections():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1)[:, None]
    for blocks in (1, 2):
        tables = LatticeTables(3, blocks, 4, 1.0)
        (ha, pa), (hb, pb) = (tables.cells(x, np.zeros(len(x))) for x in (a, b))
        met = (ha == hb) | (pa == hb[:, :, None]).any(2) | (pb == ha[:, :, None]).any(2)
        assert abs(met.mean() - hit_odds(0.98, blocks, 4, 1.0)) < 0.03
    assert tables_for(0.98, 0.9999, 1, 4, 1.0) < tables_for(0.98, 0.9999, 2, 4, 1.0) < 30


def links_by_hand(rows, threshold=0.98):
    fit = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    comp, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    unit = {k: np.array(rows[k][1], float) / np.abs(rows[k][1]).max() for k in fit}
    for n, x in enumerate(fit):
        for y in fit[n + 1:]:
            if rows[x][2] == rows[y][2] and len(unit[x]) == len(unit[y]):
                if unit[x] @ unit[y] / math.sqrt((unit[x] @ unit[x]) * (unit[y] @ unit[y])) >= threshold:
                    links[x] += 1
                    links[y] += 1
                    comp[find(x)] = find(y)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def vectors(seed, n=250, dim=24):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for size in (1,) * (n // 2) + (2,) * (n // 10) + (60, 90):
        base = rng.normal(size=dim)
        for _ in range(size):
            rows.append((i, [float(x) for x in base + rng.normal(size=dim) * np.linalg.norm(base) * rng.choice([0.005, 0.02, 0.03])], int(rng.integers(2)) if size < 60 else 0))
            i += 1
    return rows


@pytest.mark.parametrize("options", [{}, {"limit": 16}, {"blocks": 2, "limit": 64}])
def test_links_against_brute_force(spark, folder, options):
    rows = vectors(2)
    rows += [(7, rows[0][1], rows[0][2]), (8, [x * 1e300 for x in rows[0][1]], rows[0][2]), (9, [x * 1e-300 for x in rows[0][1]], rows[0][2])]
    rows += [rows[40]] * 30 + [(3000, None, 0), (3001, [0.0] * 24, 0), (3002, [float("nan")] + [1.0] * 23, 0), (3003, [float("inf")] + [1.0] * 23, 0),
                               (3004, [None] + [1.0] * 23, 0), (3005, [1.0] * 24, None), (3006, [1.0] * 24, None), (3007, [], 1), (3008, [1.0, 2.0], 1),
                               (3009, [1.0, 2.0], 1), (3010, [-0.0] * 23 + [1.0], 1), (3011, [0.0] * 23 + [1.0], 1), (None, [1.0, 2.0], 1), (None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"cls": F.lit(1), "digest": F.lit("x")})
    got = embedding_near_duplicates(df, folder, **options).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == links_by_hand(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embedding_near_duplicates(df.where("false"), folder + "-none").collect() == []


def test_recall_on_embeddings(spark):
    """Every link of the table's labels, by a plain matrix product."""
    from farebox.llm.lattice_join import op13_lattice_join
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {}
    for label in {r[2] for r in rows}:
        at = [r for r in rows if r[2] == label]
        x = np.array([r[1] for r in at], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for r, n in zip(at, ((x @ x.T) >= 0.98).sum(1) - 1):
            want[r[0]] = int(n)
    assert {r.vec_id: r.n_links for r in op13_lattice_join(spark, sf).collect()} == want
