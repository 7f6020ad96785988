"""The ten operators on small tables: brute force, round trips and edge cases."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellwatch.llm import (chat_format, common, decontaminate, html_extract, lm_score, mixing, near_dups, quality_rules,
                           secrets_crf, token_counts, toxicity_cnn)

WORDS = "the of and river stone cloud quick brown fox jumps over lazy dog while autumn winds carry red leaves".split()
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(40)) if rng.random() < 0.3 else "") for _ in range(n))


def frame(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


def as_docs(texts, source=lambda i: f"s{i % 3}"):
    return [(i, t, "en", source(i), len(t or "")) for i, t in enumerate(texts)]


# --- 1 mixing ---------------------------------------------------------------------------

def test_hypergeometric_law(spark):
    draws = spark.range(4000).select(F.expr(mixing.hypergeometric("30", "12", "10", "(id + 0.5) / 4000")).alias("x"))
    seen = {r["x"]: r["count"] / 4000 for r in draws.groupBy("x").count().collect()}
    for x in range(11):
        p = math.comb(12, x) * math.comb(18, 10 - x) / math.comb(30, 10)
        assert abs(seen.get(x, 0) - p) < 1e-3


def test_tree_deals_every_block_once(spark):
    quotas = frame(spark, [(1, 7), (2, 0), (3, 40)], "src int, quota bigint")
    runs = defaultdict(list)
    for r in mixing.splitting_tree(quotas, 4, 5).collect():
        runs[r["src"]].append((r["from"], r["run"], r["shard"]))
    for src, quota in ((1, 7), (3, 40)):
        ordered = sorted(runs[src])
        assert [a for a, _, _ in ordered] == [0, *itertools.accumulate(n for _, n, _ in ordered)][:-1]
        assert sum(n for _, n, _ in ordered) == quota
    per_shard = Counter()
    for rs in runs.values():
        for _, n, s in rs:
            per_shard[s] += n
    assert len(per_shard) == 9 and max(per_shard.values()) - min(per_shard.values()) <= 2


def test_mix_meets_targets_and_its_sql(spark):
    rng = random.Random(1)
    texts = [sentence(rng, rng.randrange(1, 60)) for _ in range(120)] + [None, "", "  ", "one"]
    rows = as_docs(texts, lambda i: [None, "b", "a", "c", "tiny"][i % 4 if i < 120 else 4])
    rows += [rows[5], (None, "no id at all", "en", "a", 9)]
    docs = frame(spark, rows)
    got = mixing.plan_mix(docs, block_words=50, shard_blocks=4)
    con = duckdb.connect()
    con.register("documents", pa.table({k: [r[i] for r in rows] for i, k in enumerate(("doc_id", "text", "lang", "source"))}))
    key = lambda t: tuple((x is None, x) for x in t)
    want = sorted(con.execute(mixing.OP1_SQL).fetchall(), key=key)
    have = [tuple(r) for r in got.select("doc_id", "size", "source_size", F.round("target", 6), "taken").collect()]
    assert sorted(have, key=key) == want
    mixed = mixing.mix(docs, block_words=50, shard_blocks=4)
    words = mixed.select("n_words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("w")).collect()
    assert all(r["n_words"] == r["w"] for r in words)
    assert sum(r["n_words"] for r in words) == sum(t for *_, t in have)
    assert all(t <= 3 * n for _, n, _, _, t in have)
    assert mixing.plan_mix(docs.limit(0)).count() == 0


# --- 2 decontamination --------------------------------------------------------------------

def brute_contamination(docs, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a:a + n])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[tuple(w[a:a + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_finds_every_window(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.choice([3, 9, 10, 14, 30]))) for i in range(12)]
    items += [(50, "ha " * 25), (51, None), (52, "!!"), (None, "zebra crossing"), (53, "solo"), (12, items[0][1])]
    docs = [(i, sentence(rng, 30)) for i in range(20)]
    for i, (_, t) in enumerate(items[:13]):
        w = t.split()
        docs.append((100 + i, sentence(rng, 8) + " " + " ".join(w[:rng.randrange(1, len(w) + 1)]).upper() + "; " + sentence(rng, 5)))
    docs += [(200, None), (201, ""), (202, "Zebra, CROSSING solo"), (203, "ha " * 400), (203, "ha " * 400), (None, items[3][1])]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, n_hit string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted((tuple(r) for r in decontaminate.contamination(d, b).select(names).collect()), key=str)
    assert got == brute_contamination(docs, items)
    assert not any(r["contaminated"] for r in decontaminate.contamination(d, b.limit(0)).collect())


# --- 3 pages -------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="home"><header>Site</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy now, buy, buy, a very long advert text indeed.</div>
<div id="main"><h1>A  title</h1><p>First paragraph, with commas, and &amp;lt;b&gt; signs.<br>Next line
 of it.<script>var t="</p>";</script><p>Second <a href="x">with a link</a>, unclosed
<ul><li>one<li>two</ul><div class="share-bar">Share this</div></div>
<section class="comments"><p>Great post, really, thanks, I liked it a lot, truly.</p></section>
<aside><p>Related, other, things, that are long enough to score.</p></aside>
<form><p>Subscribe, to our, long newsletter, today.</p></form><footer>(c) 2024, all, rights</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE).split("\n\n") == [
        "A title", "First paragraph, with commas, and &lt;b> signs. Next line of it.", "Second with a link, unclosed", "one", "two"]
    assert [html_extract.main_text(x) for x in ("", " ", "<!-- x", "<p", "plain words")][:3] == ["", "", ""]
    assert html_extract.main_text("<p>short</p><p>words</p>") == "short\n\nwords"
    deep = "<div>" * 3000 + "<p>deep, text</p>" + "</div>" * 3000
    assert html_extract.main_text(deep) == "deep, text"


@pytest.mark.parametrize("around", ["article", "main", "div"])
def test_long_articles_are_whole(around):
    long = "".join(f"<p>{'word, ' * 4}{i} {'plain words ' * 32}.</p>" for i in range(12))
    paragraphs = [f"{'word, ' * 4}{i} {'plain words ' * 32}." for i in range(12)]
    menu = "<div><a href=1>One</a> <a href=2>Two</a></div>"
    outside = "" if around == "div" else "<p>Outside of it</p>"
    pages = {f"<div>{long}</div>": paragraphs,                   # a container of its own
             f"<section><div><div>{long}</div></div></section>": paragraphs,
             f"<section>{long}</section><section><h2>Short</h2><p>End</p></section>": [*paragraphs, "Short", "End"]}
    for body, want in pages.items():
        html = (f"<body>{menu if around == 'div' else ''}<{around}><h1>Title</h1><p>No full stop</p>{body}<ul><li>one<li>two</ul>"
                f"<pre>code</pre><table><tr><td>cell</table></{around}>{outside}</body>")
        assert html_extract.main_text(html).split("\n\n") == ["Title", "No full stop", *want, "one", "two", "code", "cell"]


def test_names_do_not_drop_the_article():
    text = "A paragraph, with commas, that is long enough to be scored by its length."
    other = "Another paragraph, also, of the kind that a reader of the page would see."
    read = lambda html: html_extract.main_text(html).split("\n\n")
    for name in ("layout has-sidebar", "with-nav", "no-comments", "sidebar", "search-page", "widget social", "overflow-hidden"):
        for tag in ("article", "div"):
            assert read(f'<div class="{name}"><{tag}><h1>T</h1><p>{text}</p></{tag}><div class="ad">{other}</div></div>') == ["T", text]
    for name in ("discussion", "legal", "tags", "social", "search"):
        assert read(f'<article><h1>T</h1><p>{text}</p><p>{text}</p><section id="{name}"><h2>S</h2><p>{other}</p></section>'
                    f'</article>') == ["T", text, text, "S", other]
    for name in ("share-bar", "site-footer", "acme-sidebar", "cookie-notice", "post-comments", "comments", "ad-300x250", "social"):
        for html in (f'<article><p>{text}</p><p>{text}</p><div class="{name}"><p>{other}</p></div></article>',
                     f'<article><p>{text}</p><p>{text}</p></article><div class="{name}"><p>{other}</p></div>'):
            assert read(html) == [text, text], name
    assert read(f'<article><p>{text}</p></article><div class="comments"><article><p>{other * 9}</p></article></div>') == [text]
    assert read(f'<div><p>{text}</p><svg class="x" /><p>{other}</p><svg><text>no</text></svg></div>') == [text, other]


def test_pages_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)],
                                  "page_id bigint, url string, html string, text string")
    rows = html_extract.extract_pages(pages).collect()
    assert sorted(r["n_chars"] for r in rows)[0] == 0 and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


# --- 4 language model ------------------------------------------------------------------------

@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_is_a_distribution_and_its_base_is_exact(spark, order):
    rng = random.Random(4)
    texts = [sentence(rng, rng.randrange(0, 30)) for _ in range(60)] + [None, "", "The THE the"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = lm_score.learn_model(d.where("doc_id % 5 != 0").select("text"), order=order, shard_tokens=200)
    rows = {r["doc_id"]: r for r in lm_score.score_texts(d, model).collect()}
    split = lambda t: (t or "").lower().split() + [None]
    c = Counter(w for i, t in enumerate(texts) if i % 5 for w in split(t))
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t))
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(split(t)), sum(w in c for w in split(t)), n)
        assert abs(r["base_score"] - base) < 1e-6 and r["score"] < 0
    if order > 1:
        # p(w | the) over all words and the unknown one sums to 1, but for rounding down.
        heads = [w for w in c if w] + ["unseenword"]
        one = lm_score.score_rows(lm_score.trie_for(model), pa.array([f"the {w}" for w in heads]))[3]
        grams_ = Counter((a, b) for i, t in enumerate(texts) if i % 5 for a, b in zip(split(t), split(t)[1:]))
        m = model["levels"][2]["strength"]
        u = model["unknown"]
        the = sum(k for (a, _), k in grams_.items() if a == "the")
        p1 = lambda w: c[w] / n * (1 - u) if w in c else u
        p2 = {w: (grams_["the", w] + m * p1(w)) / (the + m) for w in [*c, "unseenword"]}
        assert abs(sum(p2.values()) - 1) < 1e-9
        if order == 2:
            after = lambda w: (grams_[w, None] + m * p1(None)) / (c.get(w, 0) + m) if w in c else p1(None)
            want = [math.log10(p1("the")) + math.log10(p2[w]) + math.log10(after(w)) for w in heads]
            assert np.abs(one - np.array(want)).max() < 0.01
    empty = lm_score.learn_model(d.limit(0).select("text"))
    assert lm_score.score_texts(d, empty).agg(F.min("score")).first()[0] == 0.0


@pytest.mark.parametrize("shard_tokens", [7, 60, 100_000])
def test_scores_of_order_three_match_a_plain_model(spark, shard_tokens):
    """However the trie is cut: shards of a few contexts, frequent contexts over several shards."""
    rng = random.Random(44)
    texts = [sentence(rng, rng.randrange(0, 40)) for _ in range(80)] + ["the the the " * 30, "the of " * 20, None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    model = lm_score.learn_model(d.where("doc_id % 4 != 0").select("text"), order=3, shard_tokens=shard_tokens)
    split = lambda t: [*(t or "").lower().split(), None]
    train = [split(t) for i, t in enumerate(texts) if i % 4]
    grams = {k: Counter(tuple(w[i:i + k]) for w in train for i in range(len(w) - k + 1)) for k in (1, 2, 3)}
    n = sum(grams[1].values())
    for level in (1, 2, 3):
        assert model["levels"][level]["nodes"] == len(grams[level])
    if shard_tokens == 7:
        hot = [c for c, _ in zip(*(x.tolist() for x in model["cuts"][2]))]
        assert len(set(hot)) < len(hot) and len(model["levels"][3]["files"]) > 4
    unknown = model["unknown"]

    def p(context, w):
        if not context:
            return grams[1][w,] / n * (1 - unknown) if (w,) in grams[1] else unknown
        k, shorter = len(context) + 1, p(context[1:], w)
        c = grams[k - 1][context]
        if not c:
            return shorter
        m = model["levels"][k]["strength"]
        return (grams[k][(*context, w)] + m * shorter) / (c + m)

    for r in lm_score.score_texts(d, model).collect():
        w = split(texts[r["doc_id"]])
        want = sum(math.log10(p(tuple(w[max(0, i - 2):i]), w[i])) for i in range(len(w)))
        assert abs(r["score"] - want) <= 0.001 * len(w) + 1e-9


def test_elias_fano_sequences():
    rng = np.random.default_rng(9)
    for top, n in ((10, 6), (1000, 900), (10 ** 6, 700), (2 ** 40, 3000), (2 ** 63, 500)):
        v = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        e = lm_score.EliasFano.build(v)
        assert (e.values() == v).all() and (e.at(np.arange(len(v))) == v).all()
        asked = np.unique(np.r_[v[::2], rng.integers(0, top, 200, dtype=np.uint64)])
        want = np.where(np.isin(asked, v), np.searchsorted(v, asked), -1)
        assert (e.find(asked) == want).all()
        lo, hi = np.sort(rng.integers(0, len(v) + 1, (2, len(asked))), axis=0)
        assert (e.find(asked, lo, hi) == np.where((want >= lo) & (want < hi), want, -1)).all()


def test_keys_do_not_depend_on_the_size_of_the_corpus():
    """Contexts and words whose product passes 64 bits get small keys in their shard."""
    v = 10 ** 12
    model = {"v": v, "shards": 4, "cuts": {3: (np.array([5, 2 ** 62, 2 ** 62, 2 ** 62 + 9], np.uint64),
                                               np.array([0, 0, v // 2, 0], np.uint64))}}
    context = np.array([0, 5, 2 ** 62, 2 ** 62, 2 ** 62 + 8, 2 ** 62 + 9, 2 ** 62 + 10], np.uint64)
    word = np.array([3, 0, 1, v - 1, 2, 0, 7], np.uint64)
    shard, key = lm_score.dealt(model, 3, context, word)
    assert shard.tolist() == [0, 1, 2, 3, 3, 4, 4]
    assert key.tolist() == [3, 0, 1, v - 1, 8 * v + 2, 0, v + 7]


def test_registered_scores_depend_on_two_words_before(spark, tmp_path):
    ids = {held: [i for i in range(900) if (zlib.crc32(str(i).encode()) % 10 == 0) == held] for held in (True, False)}
    texts = {i: ("a b c", "x b d")[n % 2] for n, i in enumerate(ids[False][:400])}
    seen, unseen = ids[True][:2]
    texts |= {seen: "a b c", unseen: "a b d"}
    spark.createDataFrame([(*x, "en", "s", 5) for x in texts.items()], DOC).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in lm_score.op4_lm_score(spark, str(tmp_path)).collect()}
    assert rows[seen]["held_out"] and rows[unseen]["held_out"] and len(rows) == len(texts)
    assert rows[seen]["score"] > rows[unseen]["score"] + 0.3        # equal by the bigrams
    assert abs(rows[seen]["base_score"] - rows[unseen]["base_score"]) < 1e-9


def test_a_level_drops_its_shuffle_before_the_next(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {b.split("_")[1] for b in disk.getAllBlocks().mkString("\n").split() if b.startswith("shuffle_")}

    old, before = spark.conf.get(common.CLEANUP), shuffles()
    d = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c") for i in range(50)], "doc_id bigint, text string")
    lm_score.learn_model(d.select("text"), order=3, shard_tokens=20)
    deadline = time.time() + 20
    while len(shuffles() - before) > 1 and time.time() < deadline:   # files go soon after; the length's sum has its own
        time.sleep(0.2)
    assert len(shuffles() - before) <= 1 and spark.conf.get(common.CLEANUP) == old


# --- 5 toxicity ------------------------------------------------------------------------------

def toxic_sample(n, seed):
    rng = random.Random(seed)
    bad = ["idiot", "scum", "lowei", "veju"]
    out = []
    for _ in range(n):
        y = rng.random() < 0.4
        w = sentence(rng, rng.randrange(10, 60)).split()
        if y:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "en", "ment", "aire"]))
        out.append((" ".join(w), int(y), "en"))
    return out


def test_classifier_learns_and_reads_texts_alike_alone_or_together():
    model = toxicity_cnn.learn(toxic_sample(500, 1))
    test = toxic_sample(200, 2)
    texts = pa.array([t for t, _, _ in test] + ["", None, "..."])
    s = toxicity_cnn.scores(model, texts)
    y = np.array([l for _, l, _ in test])
    assert ((s[:200] >= 0.5) == y).mean() > 0.95
    assert np.allclose(s[200:], model.rate)
    assert np.allclose(s[:5], np.concatenate([toxicity_cnn.scores(model, texts.slice(i, 1)) for i in range(5)]), atol=1e-5)
    old, toxicity_cnn.PLACES = toxicity_cnn.PLACES, 7
    try:
        assert np.allclose(toxicity_cnn.scores(model, texts)[:50], s[:50], atol=1e-5)
    finally:
        toxicity_cnn.PLACES = old


def test_toxicity_without_labels(spark):
    docs = frame(spark, [*as_docs(["a b c", None, ""]), (None, "x", None, None, None)])
    none = spark.createDataFrame([(0, None)], "doc_id bigint, toxic int")
    model = toxicity_cnn.fit(docs, none)
    rows = toxicity_cnn.score_texts(docs.withColumn("score", F.lit("mine")), model).collect()
    assert [r["score"] for r in rows] == [0.0] * 4


# --- 6 secrets --------------------------------------------------------------------------------

KEY = "AKIA" + "Q7" * 9
HEXES = "0123456789abcdef" * 2


def test_base_spans():
    text = f'é password: "hunter2x" API_KEY=abc token={HEXES} {KEY} {HEXES[:23]}'
    spans = [(k, text[s:e]) for s, k, e in secrets_crf.base_spans(text)]
    assert spans == [(0, 'password: "hunter2x'), (0, f"token={HEXES}"), (2, HEXES), (1, KEY)]
    assert secrets_crf.base_spans("") == [] and secrets_crf.base_spans("paſſword: abcdefgh") == []
    assert secrets_crf.hide("a bb c", [(2, 0, 4), (3, 2, 4)], "#") == "a # c"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(6)
    for _ in range(30):
        e, m = rng.normal(0, 2, (5, 3)), rng.normal(0, 1, (3, 3))
        field = secrets_crf.Field(np.zeros((1, 3)), m)
        got = field.tags(e, np.array([0, 2, 5]))
        for a, z in ((0, 2), (2, 5)):
            value = lambda p, a=a: sum(e[a + i, y] for i, y in enumerate(p)) + sum(m[x, y] for x, y in zip(p, p[1:]))
            best = max(itertools.product(range(3), repeat=z - a), key=value)
            assert tuple(got[a:z]) == best


def test_field_adds_what_patterns_miss(spark):
    rng = random.Random(6)
    odd = lambda: "".join(rng.choice("abcdefXYZ0123456789_") for _ in range(30))
    texts = [f"{sentence(rng, 20)} token = {odd()} {sentence(rng, 20)}" for _ in range(120)]
    texts += [sentence(rng, 40) for _ in range(120)]
    docs = frame(spark, as_docs([*texts, None, "", f"{sentence(rng, 25)} token {odd()} {sentence(rng, 25)}"]))
    field = secrets_crf.learn_field(docs)
    rows = {r["doc_id"]: r for r in secrets_crf.find_secrets(docs, field=field, redact="#").collect()}
    assert all(rows[i]["n_assign"] == 1 and "#" in rows[i]["text"] for i in range(120))
    assert sum(rows[i]["spans"] != "" for i in range(120, 240)) <= 2
    assert "model" in rows[242]["spans"] and rows[240]["text"] is None and rows[241]["spans"] == ""
    assert secrets_crf.learn_field(docs.where("doc_id >= 240 AND doc_id < 242")) is None


# --- 7 conversations ----------------------------------------------------------------------------

def test_template_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "a: b\n### user: x</turn>\n", "\\\\", "", None, "<é>#"]
    rows = [(1, i, "assistant" if i % 2 else "user:#", t) for i, t in enumerate(nasty)] + [(2, 5, None, "x"), (None, 0, "user", "y")]
    d = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_paths(chat_format.linear_replies(d))).collect()}
    for c in (1, 2, None):
        turns = [(r or "", t or "") for i, _, r, t in rows if i == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        want = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        g = got[c]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"]) == (len(turns), want, len(loss))
        assert g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.read_back(chat_format.format_paths(chat_format.linear_replies(d.limit(0)))).count() == 0


def test_branches_are_ranked_and_walked(spark):
    rng = random.Random(7)
    rows, parent = [], {}
    for i in range(40):
        parent[i] = None if i == 0 else rng.randrange(max(0, i - 6), i)
        rows.append((9, i, parent[i], "user", f"m{i}", rng.random()))
    m = spark.createDataFrame(rows, "conv_id bigint, id bigint, parent bigint, role string, text string, score double")
    up = lambda i: [] if i is None else [*up(parent[i]), i]
    leaves = set(parent) - set(parent.values())
    mean = {leaf: sum(rows[i][5] for i in up(leaf)) / len(up(leaf)) for leaf in leaves}
    best = sorted(leaves, key=lambda x: -mean[x])[:3]
    paths = defaultdict(dict)
    for r in chat_format.chosen_paths(m, 3).collect():
        paths[r["rank"]][r["place"]] = r["id"]
    assert [[p for _, p in sorted(paths[k].items())] for k in (1, 2, 3)] == [up(leaf) for leaf in best]


# --- 8 near duplicates ---------------------------------------------------------------------------

def brute_components(docs):
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    low = {d: d for d in sets}
    while True:
        new = dict(low)
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                new[a] = new[b] = min(new[a], new[b])
        if new == low:
            return {d: (len(sets[d]), low[d]) for d in sets}
        low = new


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(6):
        base = sentence(rng, rng.choice([4, 30, 120, 400])).split()
        texts.append(" ".join(base))
        for _ in range(12):
            w = list(base if rng.random() < 0.6 else texts[-1].split())
            for _ in range(rng.choice([0, 1, 2, 6])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(99)}"
            texts.append(" ".join(w).title() if rng.random() < 0.3 else " ".join(w))
    texts += [None, "", " \n", "one", "ONE", "one two"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    rows = [(d, t, "x") for d, t in docs] + [(docs[0][0], docs[0][1], "y"), (None, "one", "z")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    want = brute_components(docs)
    for r in near_dups.near_duplicates(d).collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_dups.near_duplicates(d.limit(0)).count() == 0


def test_loose_members_meet_all_chunks(spark):
    """Lists cut into chunks give the same components."""
    rng = random.Random(9)
    base = sentence(rng, 150).split()
    docs = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    want = brute_components(docs)
    old, near_dups.CHUNK = near_dups.CHUNK, 8
    try:
        got = near_dups.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    finally:
        near_dups.CHUNK = old
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_whole_sketches_are_linked_by_their_exact_overlap(spark):
    # 100 of 120 values in common; what differs is among the smallest.
    sets = {1: [*range(20), *range(100, 200)], 2: [*range(20, 24), *range(100, 200)], 3: [*range(40), *range(100, 200)]}
    active = spark.createDataFrame([(i, len(s), s) for i, s in sets.items()], "id bigint, n bigint, sketch array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a bigint, b bigint")
    full = spark.createDataFrame([], "id bigint, set array<bigint>")
    found = {(r["a"], r["b"]) for r in near_dups.links(pairs, active, full).collect()}
    assert found == {(a, b) for a, b in ((1, 2), (1, 3), (2, 3))
                     if 4 * len(set(sets[a]) & set(sets[b])) >= 3 * len(set(sets[a]) | set(sets[b]))}
    assert (1, 2) in found


def test_open_lists_of_different_members_are_all_compared(spark):
    # The sums of xxhash64(id) >> 20 are equal for these two pairs of ids.
    lists = spark.createDataFrame([(7, 3180, 9, 3180), (7, 4213, 9, 4213), (8, 3773, 9, 3773), (8, 4154, 9, 4154),
                                   (9, 3773, 9, 3773), (9, 4154, 9, 4154)], "value bigint, id bigint, n bigint, label bigint")
    active = lists.select("id", "n").distinct().withColumn("sketch", F.array(F.lit(1).cast("bigint")))
    found = {(r["a"], r["b"]) for r in near_dups.remaining_pairs(lists, active, None).collect()}
    assert found == {(3180, 4213), (3773, 4154)}


# --- 9 quality ------------------------------------------------------------------------------------

def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    cover = {j for i, g in enumerate(win) if c[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))


def test_quality_counts_and_rules(spark):
    rng = random.Random(10)
    texts, low = [], []
    for i in range(400):
        bad = rng.random() < 0.4
        w = [sentence(rng, 8) + ("." if not bad else " *** ###") for _ in range(rng.randrange(9, 14))]
        texts.append(rng.choice([" ", "\n", "\t  "]).join(w))
        low.append(bad)
    texts += [None, "", "a b c a b c a b c", "x y", " \n\n é\né\n"]
    docs = frame(spark, as_docs(texts)).withColumn("kept", F.lit(1))
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(low)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs.drop("kept"), labels).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert tuple(r[c] for c in quality_rules.COUNTS) == brute_counts(t)
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and not (r["base_failed"] and r["kept"])
    judged = [(rows[i]["kept"], not low[i]) for i in range(400) if not rows[i]["base_failed"]]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)
    unlabelled = quality_rules.judge(docs.drop("kept"), labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in unlabelled)


# --- 10 token counts --------------------------------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    vocabulary = open(path, "rb").read()
    rng = random.Random(11)
    texts = [sentence(rng, 50), None, "", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "  x\n\n\t y's 12345 ",
             "漢字 émigré \U0001F600​ ", "a" * 3000, "!?" * 500, "<|endof", "\x00\x1f"]
    texts += ["".join(rng.choice("ab é1!\n'　") for _ in range(200)) for _ in range(20)]
    d = frame(spark, as_docs(texts)).withColumn("n_tokens", F.lit("old"))
    rows = {r["doc_id"]: r for r in token_counts.count_tokens(d, vocabulary).collect()}
    old, token_counts.LISTED = token_counts.LISTED, 10
    try:
        counter = token_counts.Counter(vocabulary)
        assert all(counter.text(t or "") == rows[i]["n_tokens"] for i, t in enumerate(texts))
    finally:
        token_counts.LISTED = old
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"], rows[i]["over_limit"]) == (n, len((t or "").encode()), n > 512)
