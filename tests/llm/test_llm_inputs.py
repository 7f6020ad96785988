"""Odd inputs of the training-data operators: clashing names, empty tables, long texts, broken markup,
and results that may not depend on the rows beside them."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellwatch.llm import (chat_format, common, decontaminate, html_extract, lm_score, mixing, near_dups, quality_rules,
                           secrets_crf, token_counts, toxicity_cnn)
from test_llm_operators import HEXES, KEY, brute_components, sentence, toxic_sample

ODD = ["_k", "_d", "_k2", "_items", "_text", "_q", "_id", "_words", "_row", "_at", "h", "n", "label", "value", "sketch"]
DOCS = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in ODD)


def odd_docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, *[f"{c}{i}" for c in ODD]) for i, t in enumerate(texts)], DOCS)


def operators(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None)],
                                  "item_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    return {
        "decontaminate": lambda d: decontaminate.contamination(d, items),
        "lm_score": lambda d: lm_score.score_texts(d, lm_score.learn_model(d.select("text"))),
        "toxicity": lambda d: toxicity_cnn.score_texts(d, toxicity_cnn.fit(d.withColumn("lang", F.lit("en")), labels)),
        "secrets": lambda d: secrets_crf.find_secrets(d, field=secrets_crf.learn_field(d)),
        "near_dups": near_dups.near_duplicates,
        "quality": lambda d: quality_rules.judge(d, labels),
    }


@pytest.mark.parametrize("name", ["decontaminate", "lm_score", "toxicity", "secrets", "near_dups", "quality"])
def test_other_columns_and_empty_tables(spark, name):
    rng = random.Random(5)
    texts = [sentence(rng, 30) for _ in range(40)] + [None, "", " ", "one two three four five six seven eight nine ten"]
    run = operators(spark)[name]
    docs = odd_docs(spark, texts)
    rows = run(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    if name != "near_dups":
        kept = [c for c in ODD if c in rows[0].asDict()]
        assert set(ODD) - set(kept) <= set() and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in kept)
    assert run(docs.limit(0)).collect() == []


def test_token_counts_of_a_long_word_and_an_empty_table(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        vocabulary = f.read()
    rng = random.Random(3)
    texts = ["".join(rng.choice("etaoinshrdlu") for _ in range(200_000)), "ab" * 70_000, "é" * 40_000, "a" * 66_000]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    counted = token_counts.count_tokens(odd_docs(spark, texts), vocabulary)
    assert [r["n_tokens"] for r in counted.orderBy("doc_id").collect()] == want
    assert token_counts.count_tokens(odd_docs(spark, []), vocabulary).collect() == []


# --- 3 broken markup ----------------------------------------------------------------------

@pytest.mark.parametrize("part", ["<a ", "<a x='\"", "<svg>", "<![CDATA[", "<!", "<a<a", "<p title='a>b</p>", "<li>x", "<b>"])
def test_broken_markup_takes_linear_time(part):
    n = 300_000 // len(part)
    start = time.time()
    html_extract.main_text(f"<article><p>{'A plain sentence, with a comma. ' * 5}</p></article>" + part * n)
    assert time.time() - start < 6


def test_broken_markup_keeps_the_article():
    body = "A plain sentence, with a comma. " * 5
    for tail in ("<a ", "<a x='\"", "<svg>", "<![CDATA[", "<!-- open", "</", "<a href=\"x>y"):
        assert body.strip() in html_extract.main_text(f"<html><body><article><p>{body}</p>{tail}")
    deep = "<div>" * 3000 + f"<p>{body}</p>" + "</div>" * 3000 + f"<p>{body}second</p>"
    text = html_extract.main_text(f"<article>{deep}</article>")
    assert text.count("A plain sentence") == 10 and text.endswith("second")


# --- 5 toxicity ---------------------------------------------------------------------------

def test_a_corpus_of_long_texts_is_learnt(spark):
    """Texts of over 15,000 characters teach and are judged like short ones."""
    rng = random.Random(7)
    rows, labels = [], []
    for i, (text, y, _) in enumerate(toxic_sample(240, 9)):
        words = text.split()
        long = " ".join(words + [w for _ in range(80) for w in (sentence(rng, 28).split() + (["scum"] if y else []))])
        assert len(long) > 12_000
        rows.append((i, long, "en"))
        labels.append((i, y))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = toxicity_cnn.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    said = {r["doc_id"]: r["predicted"] for r in toxicity_cnn.score_texts(docs, model).collect()}
    assert sum(said[i] == y for i, y in labels) >= 0.95 * len(labels)


def test_every_labelled_row_teaches_by_its_whole_text(spark, monkeypatch):
    """Counts, share and thresholds come from all words of all labelled rows, however they are dealt."""
    monkeypatch.setattr(toxicity_cnn, "PART_BYTES", 1 << 16)
    rng = random.Random(11)
    rows = [(i, f"{t} {sentence(rng, 1500)}" if i % 20 == 1 else t, lang, y)
            for i, (t, y, _) in enumerate(toxic_sample(700, 12)) for lang in ["en" if i % 3 else "de"]]
    rows += [(1, "a second row of one id " * 3, "de", rows[1][3]), (2, None, "en", 1)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, r[3]) for i, r in enumerate(rows[:700])], "doc_id bigint, toxic int")
    model = toxicity_cnn.fit(docs, labels)
    taught = [r for r in rows if r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    assert model.rate == sum(r[3] for r in taught) / len(taught)
    counts = np.full((toxicity_cnn.LANGUAGE_BUCKETS, 2), 0.1)
    for _, text, lang, _ in taught:
        ids, _ = toxicity_cnn.word_buckets(pa.array([text]))
        np.add.at(counts, (ids[:, 0] % toxicity_cnn.LANGUAGE_BUCKETS, int(lang == "en")), 1)
    assert model.languages == ["de", "en"]
    assert np.allclose(model.language_logs, np.log(counts / counts.sum(axis=0)), atol=1e-5)
    said = {r["doc_id"]: r["predicted"] for r in toxicity_cnn.score_texts(docs.where("doc_id > 2"), model).collect()}
    assert sum(said[r[0]] == r[3] for r in rows[3:700]) >= 0.95 * 697
    again = toxicity_cnn.fit(docs, labels)
    assert np.array_equal(model.embed, again.embed) and np.array_equal(model.shifts, again.shifts)


def test_thresholds_count_every_held_back_row():
    """A language's threshold is the cut that is best over all held-back rows, given one by one or counted."""
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 5000)
    z = np.rint(rng.normal(2 * y, 1) * toxicity_cnn.GRID).astype(np.int64)
    one, counted = (toxicity_cnn.Classifier(*[None] * 4, 0.0, languages=["en"], shifts=np.zeros(1)) for _ in range(2))
    toxicity_cnn.shift_by(one, np.zeros(5000), y, z, np.ones(5000))
    cells, n = np.unique(np.stack([y, z]), axis=1, return_counts=True)
    toxicity_cnn.shift_by(counted, np.zeros(len(n)), *cells, n)
    cuts = np.unique(z)
    wrong = [np.mean(z[y == 1] < c) + toxicity_cnn.CLEAN_WEIGHT * np.mean(z[y == 0] >= c)
             for c in (cuts[1:] + cuts[:-1]) / 2]
    best = (cuts[np.argmin(wrong)] + cuts[np.argmin(wrong) + 1]) / (2 * toxicity_cnn.GRID)
    assert one.shifts[0] == counted.shifts[0] == pytest.approx(best * y.sum() / (y.sum() + toxicity_cnn.FEW))


def test_scores_equal_a_plain_forward_pass():
    model = toxicity_cnn.learn(toxic_sample(200, 4))
    texts = [t for t, _, _ in toxic_sample(15, 5)] + ["one", "one two", "idiot"]
    for text, got in zip(texts, toxicity_cnn.scores(model, pa.array(texts))):
        ids, _ = toxicity_cnn.word_buckets(pa.array([text]))
        x = np.vstack([model.embed[ids].sum(axis=1), np.zeros((2, toxicity_cnn.SIZE))])
        pooled = []
        for k, width in enumerate(toxicity_cnn.WIDTHS):
            r = [x[i:i + width].ravel() @ model.filters[k] + model.filter_bias[k] for i in range(len(ids))]
            pooled.append(np.maximum(0, np.max(r, axis=0)))
        logs = model.language_logs[ids[:, 0] % toxicity_cnn.LANGUAGE_BUCKETS].sum(axis=0)
        z = np.concatenate(pooled) @ model.weights + model.bias - model.shifts[logs.argmax()]
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-4


# --- 6 secrets ----------------------------------------------------------------------------

def base_by_hand(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def secret_texts(rng, n):
    value = lambda k: "".join(rng.choice("abcdefABCDEF0123456789_-") for _ in range(k))
    forms = [lambda: f"token={value(12)}", lambda: f'API_KEY : "{value(30)}', lambda: KEY, lambda: HEXES,
             lambda: f"passwd: {value(5)}", lambda: f"secret='{value(8)}' password={value(40)}", lambda: "é" * 3]
    return [" ".join([sentence(rng, rng.randrange(1, 30)), rng.choice(forms)(), sentence(rng, rng.randrange(0, 30))]) for _ in range(n)]


def test_counts_and_digest_match_the_patterns(spark):
    rng = random.Random(21)
    texts = secret_texts(rng, 120) + [None, "", "AKIA" + "A" * 40, "0" * 5000, "token=" * 400, f"{HEXES} " * 300]
    rows = secrets_crf.find_secrets(odd_docs(spark, texts), field=secrets_crf.learn_field(odd_docs(spark, texts))).collect()
    for r in rows:
        want = base_by_hand(texts[r["doc_id"]])
        spelled = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
        all_spans = [x.split(":") for x in r["spans"].split(",") if x]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("model")] == [x for x in spelled.split(",") if x]
        for kind, s, e in all_spans:
            if kind == "model":
                assert all(int(e) <= a or z <= int(s) for a, _, z in want)


def test_spans_do_not_depend_on_the_rows_beside_a_text():
    rng = np.random.default_rng(8)
    field = secrets_crf.Field(rng.normal(0, 1, (secrets_crf.N_FEATURES, 3)), rng.normal(0, 1, (3, 3)))
    r = random.Random(4)
    texts = secret_texts(r, 60) + ["q7q7 bb", "", "x", None, "Zz9 " * 40]
    r.shuffle(texts)
    together = list(secrets_crf.scan_column(pa.array(texts), field))
    alone = [next(iter(secrets_crf.scan_column(pa.array([t], pa.string()), field))) for t in texts]
    assert together == alone and any(k == 3 for _, spans in together for _, k, _ in spans)


def test_field_finds_forms_that_no_pattern_knows(spark):
    """Recall on held-out forms, and spans in clean text (figures in the README)."""
    rng = random.Random(31)
    docs = odd_docs(spark, secret_texts(rng, 500) + [sentence(rng, 40) for _ in range(500)])
    field = secrets_crf.learn_field(docs)
    mixed = lambda k: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(k))
    forms = {"ghp": lambda: f"ghp_{mixed(36)}", "sk": lambda: f"sk-live-{mixed(24)}", "bare": lambda: f"token {mixed(28)}",
             "words": lambda: f"credential is {mixed(20)}", "hex": lambda: f"key {mixed(8).upper()}{mixed(24).upper()}"}
    found = {}
    for name, form in forms.items():
        texts = [f"{sentence(rng, 20)} {form()} {sentence(rng, 20)}" for _ in range(60)]
        found[name] = sum(any(k == 3 for _, k, _ in spans) for _, spans in secrets_crf.scan_column(pa.array(texts), field))
    clean = [sentence(rng, 60) for _ in range(400)]
    wrong = sum(bool(spans) for _, spans in secrets_crf.scan_column(pa.array(clean), field))
    print("found of 60:", found, "clean texts with a span of 400:", wrong)
    assert sum(found.values()) >= 0.8 * 60 * len(forms) and wrong <= 8


# --- 7 chat -------------------------------------------------------------------------------

def test_a_conversation_over_many_ranges_is_numbered_in_order(spark):
    rng = random.Random(2)
    rows = [(1, i // 3, rng.choice(["user", "assistant", None]), f"t{rng.randrange(9)}") for i in range(3000)]
    rows += [(c, t, "user", "x") for c in range(2, 40) for t in range(5)] + [(None, 0, "user", "n"), (None, 1, "user", "n")]
    d = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(7)
    got = chat_format.linear_replies(d).orderBy("conv_id", "id").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] is not None, r[2] or "", r[3]))
    assert [(r["conv_id"], r["role"], r["text"]) for r in got] == [(c, a, t) for c, _, a, t in order]
    ids = {}
    for r in got:
        assert r["id"] == ids.get(r["conv_id"], 0) and r["parent"] == (r["id"] - 1 if r["id"] else None)
        ids[r["conv_id"]] = r["id"] + 1


# --- 8 near duplicates -----------------------------------------------------------------------

def test_only_the_sketches_of_pairs_are_moved(spark, monkeypatch):
    """Of many documents in lists, whole sketches are joined for those that a pair still holds."""
    base = list(range(1000, 1300))
    sketch = [[*base[:150], *range(i * 10_000, i * 10_000 + 10)] for i in range(40)]
    active = spark.createDataFrame([(i, 160, v if i < 2 else [x + i * 7_000 for x in v]) for i, v in enumerate(sketch)],
                                   "id bigint, n bigint, sketch array<bigint>")
    moved, only = [], near_dups.only

    def seen(df, ids, on):
        if "sketch" in df.columns:
            moved.append({r[0] for r in ids.collect()})
        return only(df, ids, on)

    monkeypatch.setattr(near_dups, "only", seen)
    pairs = spark.createDataFrame([(0, 1), (2, 3), (4, 5)], "a bigint, b bigint")
    found = near_dups.links(pairs, active, spark.createDataFrame([], "id bigint, set array<bigint>"))
    assert [tuple(r) for r in found.collect()] == [(0, 1)]
    assert moved == [{0, 1, 2, 3, 4, 5}]


def test_a_family_of_pairs_moves_each_member_once(spark, monkeypatch):
    import pyarrow as pa
    ids = list(range(30))
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a bigint, b bigint")
    members = spark.createDataFrame([(i, 5) for i in ids], "id bigint, n bigint")

    def sizes(p, m):
        return pa.table({"pairs": [p.num_rows], "members": [m.num_rows]})

    def groups():
        return [tuple(r) for r in near_dups.in_groups(pairs, members, members.toDF("id", "k"), sizes,
                                                      "pairs bigint, members bigint").collect()]

    assert groups() == [(435, 30)]
    monkeypatch.setattr(near_dups, "MEMBERS", 10)          # three blocks of the family against each other
    found = groups()
    assert sum(p for p, _ in found) == 435 and 1 < len(found) <= 9 and sum(m for _, m in found) <= 30 * 6


def test_few_links_are_not_dealt_to_every_partition(spark):
    """The steps on a few pairs and links take a few tasks, however many partitions a shuffle has."""
    sketch = [*range(1000, 1160)]
    active = spark.createDataFrame([(i, 160, sketch) for i in range(6)], "id bigint, n bigint, sketch array<bigint>")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(5)], "a bigint, b bigint")
    settings = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    sc = spark.sparkContext
    sc.setJobGroup("few-links", "")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = near_dups.links(pairs, active, spark.createDataFrame([], "id bigint, set array<bigint>"))
        label = near_dups.joined(None, found)
        label = near_dups.joined(label, spark.createDataFrame([(5, 9)], "a bigint, b bigint"))
        assert {tuple(r) for r in label.collect()} == {*((i, 0) for i in range(6)), (9, 0)}
        status = sc.statusTracker()
        stages = {s for j in status.getJobIdsForGroup("few-links") for s in status.getJobInfo(j).stageIds}
        infos = [i for i in map(status.getStageInfo, stages) if i]
        assert sum(i.numTasks >= 101 and i.numCompletedTasks > 0 for i in infos) <= 4      # one number of tasks per shuffle of sketches
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_many_links_give_the_components_of_few(spark, monkeypatch):
    """Pairs beyond the sizes that one partition holds or all executors get are dealt out, with the same result."""
    rng = random.Random(5)
    family = [[f"w{rng.randrange(10**6)}" for _ in range(300)] for _ in range(3)]
    docs = []
    for i in range(24):
        w = list(family[i % 3])
        w[rng.randrange(300)] = f"e{i}"
        docs.append((i, " ".join(w)))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    expected = {i: i % 3 for i in range(24)}
    for rows, sent in ((near_dups.ROWS, near_dups.SENT), (0, 0)):
        monkeypatch.setattr(near_dups, "ROWS", rows)
        monkeypatch.setattr(near_dups, "SENT", sent)
        assert {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()} == expected


def test_full_sets_are_made_for_open_pairs_only(spark, monkeypatch):
    """Texts that only share a passage are in lists, but no pair of them asks for a full set; a family is
    linked alike in blocks."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, passage = words(400), words(80)
    family = []
    for _ in range(8):
        w = list(base)
        for _ in range(5):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        family.append(w)
    others = [words(250) + passage for _ in range(8)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(family + others)], "doc_id bigint, text string")
    asked, full_sets = set(), near_dups.full_sets

    def seen(docs, active):
        asked.update(r["id"] for r in active.select("id").collect())
        return full_sets(docs, active)

    monkeypatch.setattr(near_dups, "full_sets", seen)
    for members in (near_dups.MEMBERS, 3):
        monkeypatch.setattr(near_dups, "MEMBERS", members)
        found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
        assert found == {i: 0 if i < 8 else i for i in range(16)}
    assert asked == set(range(8))


def test_pairs_of_a_large_family_stay_where_they_are_found(spark, monkeypatch):
    """Copies that are nearly similar enough, each with each: the pairs that move on are the links, not all of them."""
    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for i in range(70):
        w = list(base)
        for at in rng.sample(range(400), 9):
            w[at] = f"e{rng.randrange(10**6)}"
        texts.append(w)
    for i in range(6):                                     # links beside them, in chains
        w = list(texts[-1] if i % 3 else texts[i])
        for at in rng.sample(range(400), 3):
            w[at] = f"e{rng.randrange(10**6)}"
        texts.append(w)
    docs = list(enumerate(" ".join(w) for w in texts))
    want = {i: c for i, (_, c) in brute_components(docs).items()}
    assert 60 <= len(set(want.values())) < len(docs)
    moved, links = [], near_dups.links

    def seen(pairs, active, sets):
        moved.append(pairs.count())
        return links(pairs, active, sets)

    monkeypatch.setattr(near_dups, "links", seen)
    monkeypatch.setattr(near_dups, "ROWS", 200)
    monkeypatch.setattr(near_dups, "CHUNK", 20)
    found = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == want
    assert moved[-1] < len(docs) ** 2 / 20


@pytest.mark.parametrize("values", [40, 300, 50_000])
def test_shared_counts(values):
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, values, rng.integers(0, 40))) for _ in range(50)]
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    rows, others = np.arange(0, 12)[::-1], np.arange(10, 50)
    got = near_dups.shared_counts(np.concatenate(lists), starts, rows, others)
    assert got.tolist() == [[len(np.intersect1d(lists[i], lists[j])) for j in others] for i in rows]


def test_driver_lets_go_of_finished_steps(spark):
    """What nothing refers to any more leaves the driver's JVM between steps, whatever room its heap has left."""
    left = spark._jvm.java.lang.ref.WeakReference(spark.sparkContext._gateway.new_array(spark._jvm.byte, 1 << 20))
    common.release_driver_memory(spark)
    assert left.get() is None


@pytest.mark.parametrize("step, module, least", [
    ("toxicity", toxicity_cnn, 1), ("near_dups", near_dups, 4), ("decontaminate", decontaminate, 1),
    ("secrets", secrets_crf, 1), ("mixing", mixing, 1)])
def test_steps_release_the_driver(spark, monkeypatch, step, module, least):
    calls = []
    release = module.release_driver_memory
    monkeypatch.setattr(module, "release_driver_memory", lambda s: (calls.append(step), release(s)))
    rng = random.Random(8)
    texts = [sentence(rng, 30) for _ in range(20)]
    docs = odd_docs(spark, [*texts, *(t + " end" for t in texts), f"{texts[0]} token={HEXES}"]).withColumn("source", F.lit("a"))
    found = (operators(spark) | {"mixing": mixing.mix})[step](docs)
    assert found.count() and len(calls) >= least
