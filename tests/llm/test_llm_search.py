"""Nearest neighbours, periodic runs and lexical search: brute force and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellwatch.llm import collision_search as CS
from cellwatch.llm import lexical_search as LS
from cellwatch.llm import periodic_runs as PR

SF = "/root/testdata/sf0.001"
VEC = "vec_id bigint, embedding array<double>, _key string, score string"


# --- 11 nearest neighbours --------------------------------------------------------------

def nearest(rows, k=10):
    """{(query id, its vector): [(vec_id, distance)]} by brute force."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, q in {(i, tuple(v)) for i, v in ok if i is not None and i % 100 == 0}:
        own, found = False, []
        for j, v in ok:
            if j == i and tuple(v) == q and not own:
                own = True
            elif len(v) == len(q):
                d = np.array(v) - np.array(q)
                found.append((float(np.sqrt((d * d).sum())), j is None, j or 0, j))
        out[i, q] = [(j, d) for d, _, _, j in sorted(found)[:k]]
    return out


def searched(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VEC)
    got = defaultdict(list)
    for r in CS.neighbours(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_threshold_is_the_binomial_quantile():
    m, p = CS.PROJECTIONS, CS.normal_share(CS.WIDTH / 2)
    t = CS.collision_threshold()
    under = sum(math.comb(m, n) * p ** n * (1 - p) ** (m - n) for n in range(t))
    assert under <= CS.MISS < under + math.comb(m, t) * p ** t * (1 - p) ** (m - t)


def test_neighbours_of_clusters_and_edge_cases(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.2 * rng.standard_normal(16)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[100][1]) for i in range(300)]           # a very common vector, also a query's
    rows += [(2000, None), (2100, []), (2200, [0.0] * 16), (2300, [1.0, None] * 8), (2400, [math.nan] * 16),
             (2500, [math.inf] + [1.0] * 15), (None, rows[0][1]), (3000, [1.0, 2.0]), (3001, [1.0, 2.5]),
             (200, rows[200][1]), (3100, [1e300] * 16), (3200, rows[5][1])]
    got, want = searched(spark, rows), nearest(rows)
    assert set(got) == {i for (i, _), found in want.items() if found}
    hit = total = 0
    for (i, _), found in want.items():
        have = got.get(i, [])
        assert [r for r, _, _ in have] == list(range(1, len(found) + 1))
        assert all(a[2] <= b[2] for a, b in zip(have, have[1:]))
        hit += len({(j, d) for _, j, d in have} & set(found))
        total += len(found)
    assert hit >= 0.97 * total
    assert [(j, d) for _, j, d in got[100]] == [(1000 + i, 0.0) for i in range(10)]   # ties by id, own row left out
    assert got[200][0][1:] == (200, 0.0) and got[3000] == [(1, 3001, 0.5)]
    assert got[0][0][1:] == (None, 0.0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    got = CS.op11_nearest_neighbours(spark, f"/root/testdata/{sf}").collect()
    t = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = nearest([(r["vec_id"], r["embedding"]) for r in t])
    found = {(i, j) for (i, _), js in want.items() for j, _ in js}
    assert len(got) == len(found) and len(found & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.95 * len(found)


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], VEC)
    assert CS.neighbours(df, df).collect() == []
    one = spark.createDataFrame([(100, [1.0, 2.0], "", "")], VEC)
    assert CS.neighbours(one, one).collect() == []


# --- 12 periodic runs -------------------------------------------------------------------

def runs_by_hand(w, least=6, exponent=4):
    out, n = set(), len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            smaller = any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q))
            if e - s >= max(least, exponent * q) and not smaller:
                out.add((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=50), min_size=1, max_size=4), st.integers(1, 9), st.integers(0, 30))
def test_runs_of_any_words(texts, period, start):
    for t in texts[:2]:                                     # half of them made periodic from some word on
        for i in range(start + period, len(t)):
            t[i] = t[i - period]
    row = np.r_[0, np.cumsum([len(t) for t in texts])]
    h = np.array([x * 7919 + 13 for t in texts for x in t], np.uint64)
    got = PR._order(PR.find_runs(h, row))
    for i, t in enumerate(texts):
        assert [(int(s - row[i]), int(e - s), int(q)) for r, s, e, q in got if r == i] == runs_by_hand(t)


def op12_by_hand(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_by_hand(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: Fraction(r[1], r[2]), default=None)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(kept))


def test_op12_on_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: op12_by_hand(r["doc_id"], r["text"]) for r in docs}
    got = [tuple(r) for r in PR.op12_periodic_runs(spark, SF).collect()]
    assert len(got) == len(docs) and all(r == want[r[0]] for r in got)
    assert any(r[1] for r in got)


def test_op12_edge_cases(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", " \t\n ", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "x " * 300 + "y",
             "a b a b " * 5, "a\x00 " * 9, " ".join(rng.choice("ab") for _ in range(300)),
             ("k l m n o " * 60) + " ".join("abcdefgh"), "é \U0001f600 " * 12, "a b a b a b a b c c c c c c"]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(None, "z z z z z z z"), (3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, "kept", 1) for i, t in rows], "doc_id bigint, text string, w string, n int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in PR.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == Counter(op12_by_hand(i, t) for i, t in rows)
    long = spark.createDataFrame([(1, "x " * 400_000 + "p q r " * 100_000)], "doc_id bigint, text string")
    found = PR.periodic_runs(long).first()
    assert [tuple(r) for r in found["runs"]] == [(0, 400_000, 1), (400_000, 300_000, 3)]
    assert found["collapsed"] == "x p q r"
    plain = PR.periodic_runs(docs.withColumnRenamed("n", "runs"))        # a clashing name is replaced, others stay
    assert plain.columns == ["doc_id", "text", "w", "n_words", "runs", "collapsed"] and plain.count() == len(rows)
    assert PR.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        PR.periodic_runs(docs, exponent=2)


# --- 13 lexical search ------------------------------------------------------------------

def bm25_by_hand(docs, items, k=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                 re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    d = [(i, words(t)) for i, t in docs]
    d = [(i, Counter(w), len(w)) for i, w in d if w]
    n_docs, total = len(d), sum(n for *_, n in d)
    df = Counter(t for _, c, _ in d for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, c, n in d:
            m = 25 + 75 * n * n_docs // total
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, x in Counter(words(text)).items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k])]
    return Counter(out)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(vocabulary[min(59, int(rng.expovariate(0.08)))] for _ in range(n))
    docs = [(i, text(rng.choice([3, 8, 30, 200]))) for i in range(700)]
    docs += [(1000 + i % 7, docs[1][1]) for i in range(400)]              # copies, some with one id
    docs += [(None, docs[2][1]), (5000, None), (5001, ""), (5002, " .,;! "), (5003, "W1-w2/W3 Été"),
             (5004, "w4 " * 20000)]
    items = [(i, text(6)) for i in range(25)] + [(3, "w1 w1 w1 w55"), (90, None), (91, "..."), (92, "nowhere else"),
             (93, "Été w59"), (0, "w7"), (94, docs[3][1])]
    items.append(items[0])
    monkeypatch.setattr(LS, "BLOCK", 60)                                  # several blocks of items
    monkeypatch.setattr(LS, "BUCKET", 64)
    d = spark.createDataFrame([(i, t, "c", 2) for i, t in docs], "doc_id bigint, text string, key string, n int")
    q = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id bigint, text string, doc_id string")
    got = Counter(tuple(r) for r in LS.search(d.repartition(5), q).collect())
    assert got == bm25_by_hand(docs, items)


def test_pruning_drops_work_but_no_result():
    """Bounds spare exact scores; what they drop is under the threshold."""
    rng = np.random.default_rng(4)
    items = LS.Items([(1, list(range(0, 12)), [1] * 12, list(range(3000, 300, -225)))], 10)
    n = 6000
    row = np.repeat(np.arange(n), 4)
    term = rng.integers(0, 12, 4 * n)
    _, at = np.unique(row * 100 + term, return_index=True)
    row, term = row[at], term[at]
    tf, m = rng.integers(1, 6, len(row)), rng.integers(30, 900, n)
    best = LS.Best(items)
    exact = LS.search_buckets(LS.Buckets(row, term, tf, m, n, items), items, best, np.arange(n), np.zeros(n, bool))
    score = np.zeros(n, np.int64)
    np.add.at(score, row, LS.impacts(tf, m[row]) * items.weight[term])
    top = np.lexsort([np.arange(n), -score])[:10]
    assert best.id[0].tolist() == top.tolist() and best.score[0].tolist() == score[top].tolist()
    assert exact < n / 4


def test_norms_beyond_64_bits():
    n = np.array([10 ** 7, 3], np.int64)
    assert LS.length_norms(n, 10 ** 12, 10 ** 14).tolist() == [25 + 75 * 10 ** 7 * 10 ** 12 // 10 ** 14, 25 + 75 * 3 // 100]


def test_op13_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(LS.OP13_SQL).fetchall()
    assert Counter(tuple(r) for r in LS.op13_lexical_search(spark, SF).collect()) == Counter(want)


def test_search_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    q = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert LS.search(d, q).collect() == []
    assert LS.search(q.withColumnRenamed("item_id", "doc_id"), q.limit(0)).collect() == []
