"""Toxicity by a convolutional text classifier on hashed word embeddings.

A word is the sum of the embeddings of its hash buckets: its whole form and its first four,
five and six bytes, so unseen forms of known stems are read too. Filters of widths 1, 2 and 3
slide over the words, each keeps its largest response over the text (max pooling), and a
logistic unit weighs them. Scores are then calibrated by language: a naive Bayes guess of the
language from the text's words picks a threshold, chosen on a held-back fifth of the labelled
rows, and the score is shifted so that 0.5 stands for it.

Every labelled row that the caller allows takes part, by its whole text. The rows are dealt into
parts by the hash of the id, so that reruns agree. In each of EPOCHS rounds a task takes the
common classifier through its part (stochastic steps with Adam, gradients through the pooled places
only, labels weighed against their shares); what the parts changed is averaged block by block, an
embedding over the parts that moved it, and a classifier of fixed size comes back to the driver.
Counts of words by language and of held-back rows by language, label and log-odds (in steps of
1 / GRID) are sums over all rows. The language column serves only to learn the guess; scores read
the text alone.

Null or empty text, or one without words: the score is the share of label 1 among the labelled rows.
Very long texts are read whole, in bounded memory but for the text itself. Null labels are left
out; with one kind of label, or none, every score is 0 (label 1 never seen) or 1. Of languages that
are equally likely the first by name is guessed. Repeated rows are learnt from and scored each, conflicting
labels of an id count as toxic, an empty table gives an empty result. Columns of the input that bear a result's name are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_written, extended, id_bucket, map_arrow, release_driver_memory, shuffles_dropped, table, written
from .textvec import ALNUM, Words, column_bytes, row_slices

BUCKETS = 1 << 15         # rows of the embedding table; numbers fit 16 bits
SIZE = 12                 # numbers of an embedding
WIDTHS = (1, 2, 3)        # words a filter spans
FILTERS = 12              # of each width
PREFIXES = (4, 5, 6)      # bytes of a word's hashed beginnings
EPOCHS = 5                # rounds, each a pass over all rows, or more where that gives under STEPS steps in all
STEPS = 500
BATCH = 64                # texts of a step; down to LEAST_BATCH where there are few
LEAST_BATCH = 8
PART_BYTES = 16 << 20     # text that a task learns from in a round, about
BLOCK_ROWS = 512          # embeddings averaged together
LABEL_WEIGHT = 8.0        # of the rarer label against the other, at most
GRID = 100                # steps of a log-odds unit on which thresholds are chosen
FAR_ODDS = 30             # log-odds beyond it count as it
LANGUAGE_BUCKETS = 1 << 12
FEW = 50                  # rows of label 1 with which a language's threshold counts half
CLEAN_WEIGHT = 3.0        # of a wrongly found text against a missed one, as shares of their kinds


@dataclass
class Classifier:
    embed: np.ndarray                          # bucket, number
    filters: list[np.ndarray]                  # for each width: width * SIZE, FILTERS
    filter_bias: np.ndarray                    # width, filter
    weights: np.ndarray                        # pooled responses
    bias: float
    languages: list[str] = field(default_factory=list)
    language_logs: np.ndarray | None = None    # bucket, language
    shifts: np.ndarray | None = None           # of the log-odds, by language
    constant: float | None = None              # the score where only one label was seen
    rate: float = 0.0                          # share of label 1; the score of no words


def word_buckets(col) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of each word (its whole form and beginnings) and the rows' first words."""
    w = Words(col, ALNUM, prefixes=PREFIXES)
    ids = np.stack([w.hash, *w.prefix], axis=1) % np.uint64(BUCKETS)
    return ids.astype(np.int32), w.row


def _responses(model: Classifier, x: np.ndarray) -> list[np.ndarray]:
    """Filter responses of each width at each place; ``x`` ends with places of padding."""
    n = len(x) - max(WIDTHS) + 1
    parts = [f.reshape(w, SIZE, FILTERS)[j] for w, f in zip(WIDTHS, model.filters) for j in range(w)]
    y = x @ np.concatenate(parts, axis=1)
    out, at = [], 0
    for k, width in enumerate(WIDTHS):
        r = y[:n, at:at + FILTERS] + model.filter_bias[k]
        for j in range(1, width):
            r += y[j:j + n, at + j * FILTERS:at + (j + 1) * FILTERS]
        out.append(np.maximum(r, 0, out=r))
        at += width * FILTERS
    return out


def _laid_out(ids: np.ndarray, row: np.ndarray):
    """Places of the words with max(WIDTHS) - 1 places of padding after each text."""
    gap = max(WIDTHS) - 1
    texts = len(row) - 1
    text_of = np.repeat(np.arange(texts), np.diff(row))
    place = np.arange(len(ids)) + gap * text_of
    return place, len(ids) + gap * texts, row[:-1] + gap * np.arange(texts), np.diff(row)


PLACES = 1 << 16           # places whose responses are held at once
SLICE = 1 << 20            # bytes of texts scored at a time


def pooled(model: Classifier, ids: np.ndarray, row: np.ndarray, where: np.ndarray | None = None) -> np.ndarray:
    """Largest response of each filter in each text, in runs of at most PLACES places.
    ``where`` takes the numbers of the words at which they begin (left as is where a response is 0)."""
    out = np.zeros((len(row) - 1, len(WIDTHS) * FILTERS), np.float32)
    gap = max(WIDTHS) - 1
    start = 0
    while start < len(ids):
        # Words start .. stop; a run may end inside a text, whose next words it may look at.
        stop = min(len(ids), start + PLACES)
        first = int(np.searchsorted(row, start, "right")) - 1
        last = int(np.searchsorted(row, stop, "left"))
        cuts = np.clip(row[first:last + 1], start, stop)
        more = min(int(row[last]), stop + gap) - stop
        x_ids = ids[start:stop + more]
        x = model.embed[x_ids[:, 0]]
        for j in range(1, ids.shape[1]):
            x += model.embed[x_ids[:, j]]
        lens = np.diff(cuts)
        lens[-1] += more
        rel = np.r_[0, np.cumsum(lens)]
        place, size, begin, _ = _laid_out(x_ids, rel)
        laid = np.zeros((size + gap, SIZE), np.float32)
        laid[place] = x
        lens[-1] -= more
        has = lens > 0
        for k, r in enumerate(_responses(model, laid)):
            # Windows that begin at a text's words; padding after it reads as zero embeddings.
            if where is not None:
                for i in np.flatnonzero(has).tolist():
                    r_i = r[begin[i]:begin[i] + lens[i]]
                    at = r_i.argmax(axis=0)
                    best, to = r_i[at, np.arange(FILTERS)], (first + i, slice(k * FILTERS, (k + 1) * FILTERS))
                    where[to] = np.where(best > out[to], cuts[i] + at, where[to])
                    out[to] = np.maximum(best, out[to])
                continue
            ends = np.stack([begin[has], begin[has] + lens[has]], axis=1).ravel()
            if len(ends):
                best = np.maximum.reduceat(np.vstack([r, np.zeros((1, FILTERS), np.float32)]), ends, axis=0)[::2]
                part = out[first:last, k * FILTERS:(k + 1) * FILTERS]
                part[has] = np.maximum(part[has], best)
        start = stop
    return out


def new_classifier(seed: int = 5) -> Classifier:
    rng = np.random.default_rng(seed)
    return Classifier(
        rng.normal(0, 0.3, (BUCKETS, SIZE)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * SIZE), (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32),
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)


def label_weights(n: int, n_toxic: int) -> tuple[float, float]:
    """Weights of labels 0 and 1: the rarer one counts more."""
    share = n_toxic / (n - n_toxic)
    return min(LABEL_WEIGHT, max(1.0, share)), min(LABEL_WEIGHT, max(1.0, 1 / share))


def train_round(model: Classifier, ids: np.ndarray, row: np.ndarray, labels: np.ndarray, round_: int, rows: int,
                weights: tuple[float, float] = (1.0, 1.0), seed: int = 0) -> tuple[Classifier, np.ndarray]:
    """``model`` after one round over the texts of a part, and which embeddings were moved.

    ``ids``: hash buckets of the words; text i has the words ``row[i]:row[i+1]``. ``rows``: texts of all parts.
    """
    rng = np.random.default_rng([5, round_, seed])
    model = replace(model, embed=model.embed.copy(), filters=[f.copy() for f in model.filters],
                    filter_bias=model.filter_bias.copy(), weights=model.weights.copy())
    texts, steps = len(row) - 1, STEPS // EPOCHS
    batch = min(BATCH, max(LEAST_BATCH, texts // steps))
    passes = max(1, -(-steps * batch // max(1, rows)))
    rate = 0.01 * (1 - round_ / EPOCHS) + 0.001
    dense = [model.filter_bias, model.weights, np.array([model.bias], np.float32), *model.filters]
    adam = [[np.zeros_like(p), np.zeros_like(p)] for p in dense]
    em, ev, moved = np.zeros_like(model.embed), np.zeros_like(model.embed), np.zeros(BUCKETS, bool)
    step = 0
    orders = (rng.permutation(texts) for _ in range(passes))
    for rows_ in (order[at:at + batch] for order in orders for at in range(0, texts, batch)):
        step += 1
        lens = row[rows_ + 1] - row[rows_]
        b_ids = np.concatenate([ids[row[r]:row[r + 1]] for r in rows_])
        b_row = np.r_[0, np.cumsum(lens)]
        where = np.zeros((len(rows_), len(WIDTHS) * FILTERS), np.int64)
        model.bias = float(dense[2][0])
        feats = pooled(model, b_ids, b_row, where)
        z = feats @ model.weights + dense[2][0]
        y = labels[rows_].astype(np.float32)
        w = np.where(y > 0, np.float32(weights[1]), np.float32(weights[0]))
        d = w * (1 / (1 + np.exp(-np.clip(z, -FAR_ODDS, FAR_ODDS))) - y) / w.sum()
        grads = [np.zeros_like(model.filter_bias), feats.T @ d, np.array([d.sum()], np.float32)]
        back = d[:, None] * model.weights * (feats > 0)
        touched, given = [], []
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            grads[0][k] = g.sum(axis=0)
            f = model.filters[k].reshape(width, SIZE, FILTERS)
            gf = np.zeros_like(f)
            at = where[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(width):
                # Windows may run over the text's end, where nothing stands.
                i, q = np.nonzero((g != 0) & (at + j < b_row[1:, None]))
                word = at[i, q] + j
                x = model.embed[b_ids[word]].sum(axis=1) * g[i, q][:, None]
                for c in range(FILTERS):
                    gf[j, :, c] = x[q == c].sum(axis=0)
                touched.append(word)
                given.append(g[i, q][:, None] * f[j].T[q])
            grads.append(gf.reshape(width * SIZE, FILTERS))
        for p, g, a in zip(dense, grads, adam):
            a[0] += 0.1 * (g - a[0])
            a[1] += 0.01 * (g * g - a[1])
            p -= rate * (a[0] / (1 - 0.9 ** step)) / (np.sqrt(a[1] / (1 - 0.99 ** step)) + 1e-8)
        words, given = np.concatenate(touched), np.concatenate(given)
        if len(words):
            b = b_ids[words]
            at_, inverse = np.unique(b, return_inverse=True)
            ge = np.zeros((len(at_), SIZE), np.float32)
            np.add.at(ge, inverse.reshape(-1), np.repeat(given, b.shape[1], axis=0))
            em[at_] += 0.1 * (ge - em[at_])
            ev[at_] += 0.01 * (ge * ge - ev[at_])
            model.embed[at_] -= rate * 2 * em[at_] / (np.sqrt(ev[at_]) + 1e-6)
            moved[at_] = True
    model.bias = float(dense[2][0])
    return model, moved


def guess_language(model: Classifier, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Number of the likeliest language of each text (0 for texts without words)."""
    logs = model.language_logs[(hashes % hashes.dtype.type(LANGUAGE_BUCKETS)).astype(np.int64)]
    sums = np.vstack([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
    return (sums[row[1:]] - sums[row[:-1]]).argmax(axis=1)


def language_counts(words: np.ndarray) -> np.ndarray:
    return np.bincount(words[:, 0] % LANGUAGE_BUCKETS, minlength=LANGUAGE_BUCKETS)


def guess_by(model: Classifier, languages: list[str], counts: np.ndarray) -> None:
    """Sets the guess of a language from the counts of words (bucket, language)."""
    per = counts + 0.1
    model.languages = languages
    model.language_logs = np.log(per / per.sum(axis=0)).astype(np.float32)
    model.shifts = np.zeros(len(languages))


def held_back(model: Classifier, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Guessed language and log-odds, in steps of 1 / GRID, of texts with words."""
    z = pooled(model, ids, row).astype(np.float64) @ model.weights + model.bias
    return (guess_language(model, ids[:, 0], row),
            np.rint(np.clip(z, -FAR_ODDS, FAR_ODDS) * GRID).astype(np.int64))


def shift_by(model: Classifier, guessed: np.ndarray, y: np.ndarray, z: np.ndarray, n: np.ndarray) -> None:
    """Sets each language's shift from ``n`` held-back rows of a guess, a label and log-odds ``z`` / GRID."""
    for k in range(len(model.languages)):
        cuts, at = np.unique(z[guessed == k], return_inverse=True)
        mine, rows = y[guessed == k], n[guessed == k]
        toxic, clean = (np.bincount(at, rows * (mine == v), len(cuts)) for v in (1, 0))
        if rows.sum() >= 20 and toxic.sum() and clean.sum() and len(cuts) > 1:
            # The cut with the smallest share of missed and, weighing more, of wrongly found
            # held-back rows; where a range of cuts does as well, its middle.
            wrong = (np.cumsum(toxic)[:-1] / toxic.sum()
                     + CLEAN_WEIGHT * (clean.sum() - np.cumsum(clean)[:-1]) / clean.sum())
            best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
            cut = (cuts[best[0]] + cuts[best[-1] + 1]) / (2 * GRID)
            model.shifts[k] = float(cut * toxic.sum() / (toxic.sum() + FEW))    # few rows: near 0


def learn(rows: list[tuple]) -> Classifier:
    """The calibrated classifier of some (text, label, language) rows, as one part; :func:`fit` learns from tables."""
    words = [word_buckets(pa.array([t or ""], pa.string()))[0] for t, _, _ in rows]
    y = np.array([l for _, l, _ in rows], np.int64)
    lang = np.array([l or "" for _, _, l in rows])
    if not len(y) or y.min() == y.max():
        return Classifier(*[None] * 4, 0.0, constant=float(y[0]) if len(y) else 0.0)

    def laid(which) -> tuple[np.ndarray, np.ndarray]:
        return (np.concatenate([words[i] for i in which]),
                np.r_[0, np.cumsum([len(words[i]) for i in which])].astype(np.int64))

    number = np.arange(len(y))
    taught, held = number[number % 5 != 0], number[(number % 5 == 0) & np.array([len(w) > 0 for w in words])]
    model = new_classifier()
    for round_ in range(EPOCHS if len(taught) else 0):
        model, _ = train_round(model, *laid(taught), y[taught], round_, len(taught), label_weights(len(y), y.sum()))
    model.rate = float(y.mean())
    languages = sorted(set(lang))
    guess_by(model, languages, np.stack([sum(language_counts(words[i]) for i in number[lang == name])
                                         for name in languages], axis=1))
    if len(held):
        shift_by(model, *(lambda g, z: (g, y[held], z))(*held_back(model, *laid(held))), np.ones(len(held)))
    return model


def log_odds(model: Classifier, col) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of label 1 (nan: no words) and the guessed language's number, for each row."""
    raw, off = column_bytes(col)
    odds, langs = [np.empty(0)], [np.empty(0, np.int64)]
    for i, j in row_slices(off, SLICE):
        w = Words(col.slice(i, j - i), ALNUM, prefixes=PREFIXES)
        ids = (np.stack([w.hash, *w.prefix], axis=1) % np.uint64(BUCKETS)).astype(np.int32)
        z = pooled(model, ids, w.row).astype(np.float64) @ model.weights + model.bias
        odds.append(np.where(np.diff(w.row) > 0, z, np.nan))
        langs.append(guess_language(model, w.hash, w.row))
    return np.concatenate(odds), np.concatenate(langs)


def scores(model: Classifier, col) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(col), model.constant)
    z, lang = log_odds(model, col)
    return np.where(np.isnan(z), model.rate, 1 / (1 + np.exp(-np.clip(z - model.shifts[lang], -30, 30))))


WORDS = T.StructField("words", T.BinaryType())


def bucket_numbers(texts: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` with ``words`` (bucket numbers of the whole text, 16 bits each) in the place of the text."""
    kept = texts.select(*[c for c in texts.columns if c != text], text)

    def run(batches):
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            _, off = column_bytes(col)
            for i, j in row_slices(off, SLICE):
                ids, row = word_buckets(col.slice(i, j - i))
                found = pa.Array.from_buffers(pa.large_binary(), j - i, [
                    None, pa.py_buffer((row * ids.shape[1] * 2).astype(np.int64).tobytes()),
                    pa.py_buffer(ids.astype(np.int16).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns[:-1]), found], [*batch.schema.names[:-1], "words"])

    return map_arrow(kept, run, T.StructType([*kept.schema.fields[:-1], WORDS]))


def laid_words(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the words of a column that :func:`bucket_numbers` gave, and the rows' first words."""
    width = 1 + len(PREFIXES)
    parts = [np.frombuffer(v.as_buffer(), np.int16).reshape(-1, width) for v in col]
    return (np.concatenate(parts or [np.empty((0, width), np.int16)]),
            np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64))


def labelled_words(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, int, int]:
    """part, held, y, lang and words of every row of ``docs`` with a text and a label, in the shared
    folder, their number and that of label 1; no table where a label is missing."""
    y = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y")).where("y IS NOT NULL")
         .groupBy("_id").agg(F.max("y").alias("y")))
    told = docs.where("text IS NOT NULL").select("doc_id", "text", "lang")
    size = told.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    n, toxic, size = size.join(y, F.col("doc_id") == F.col("_id")).agg(
        F.count("*"), F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if toxic in (0, n):
        return None, n, toxic
    parts = max(1, -(-size // PART_BYTES))
    # Texts and labels meet in the shuffle that deals the parts, so texts move once.
    both = told.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"), F.lit(None).cast("int").alias("y"),
                       F.xxhash64("text").alias("key")).unionByName(
        y.select(F.col("_id").alias("doc_id"), "y"), allowMissingColumns=True).where("doc_id IS NOT NULL")
    both = both.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)).cast("int"))
    of_id = Window.partitionBy("part", "doc_id").orderBy("key", "lang").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = both.repartition(2 * parts, "part").withColumn("y", F.max("y").over(of_id)).where(
        "text IS NOT NULL AND y IS NOT NULL")
    held = F.pmod(F.xxhash64("doc_id", "key"), F.lit(5)) == 0
    return written(bucket_numbers(dealt.select("part", held.alias("held"), "y", "lang", "text")), "toxic-words"), n, toxic


def parts_of(batches):
    """The batches' rows as one table for each part in them; a part's rows follow each other. One that
    grew far beyond its size (an id in very many rows) is given in pieces."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column(0).to_numpy()
        edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if j > i:
                if kept and (kept[0].column(0)[0].as_py() != part[i] or sum(k.nbytes for k in kept) > 6 * PART_BYTES):
                    yield pa.Table.from_batches(kept)
                    kept = []
                kept.append(batch.slice(i, j - i))
    if kept:
        yield pa.Table.from_batches(kept)


def flat(model: Classifier) -> np.ndarray:
    """What is learnt beside the embeddings."""
    return np.concatenate([model.filter_bias.ravel(), model.weights, [model.bias], *map(np.ravel, model.filters)]
                          ).astype(np.float64)


def from_flat(model: Classifier, v: np.ndarray) -> Classifier:
    sizes = [model.filter_bias.size, model.weights.size, 1, *(f.size for f in model.filters)]
    bias, weights, one, *filters = np.split(v.astype(np.float32), np.cumsum(sizes)[:-1])
    return replace(model, filter_bias=bias.reshape(model.filter_bias.shape), weights=weights, bias=float(one[0]),
                   filters=[f.reshape(g.shape) for f, g in zip(filters, model.filters)])


def averaged_round(words: DataFrame, model: Classifier, round_: int, rows: int,
                   weights: tuple[float, float]) -> Classifier:
    """``model`` after a round over all parts of ``words``. Blocks of what they changed are summed by
    the executors, a sum for each block reaches the driver."""
    sent = words.sparkSession.sparkContext.broadcast(model)       # fixed size, about 2 MB
    blocks = BUCKETS // BLOCK_ROWS                                 # one more: all but the embeddings
    schema = "block int, n binary, change binary"

    def learnt(batches):
        old = sent.value
        for part in parts_of(batches):
            ids, row = laid_words(part["words"])
            new, moved = train_round(old, ids, row, part["y"].to_numpy(), round_, rows, weights, part["part"][0].as_py())
            change = (new.embed - old.embed).reshape(blocks, -1)
            texts = np.array([part.num_rows], np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(blocks + 1), pa.int32()),
                 pa.array([*(m.astype(np.float32).tobytes() for m in moved.reshape(blocks, -1)), texts.tobytes()]),
                 pa.array([*(c.tobytes() for c in change), ((flat(new) - flat(old)) * texts).astype(np.float32).tobytes()])],
                ["block", "n", "change"])

    def summed(batches):
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, n, change in zip(*(c.to_pylist() for c in batch.columns)):
                found = [np.frombuffer(x, np.float32).astype(np.float64) for x in (n, change)]
                have = sums.get(block)
                sums[block] = [x + y for x, y in zip(have, found)] if have else found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s[0].tobytes() for s in sums.values()], pa.binary()),
             pa.array([s[1].tobytes() for s in sums.values()], pa.binary())], ["block", "n", "change"])

    parts = map_arrow(words.where("NOT held").select("part", "y", "words"), learnt, schema)
    sums = map_arrow(parts.repartition(blocks + 1, "block").sortWithinPartitions("block", "n", "change"), summed, schema).toArrow()
    embed = model.embed.astype(np.float64)
    for block, n, change in zip(*(c.to_pylist() for c in sums.columns)):
        n, change = np.frombuffer(n), np.frombuffer(change)
        if block == blocks:
            model = from_flat(model, flat(model) + change / n[0])
        else:
            embed[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS] += change.reshape(BLOCK_ROWS, SIZE) / np.maximum(n, 1)[:, None]
    sent.destroy()
    return replace(model, embed=embed.astype(np.float32))


def summed_languages(words: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and how many words (by bucket) each has in all rows."""
    def run(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            ids, row = laid_words(batch.column(1))
            lang = np.array(batch.column(0).to_pylist(), object)
            of = np.repeat(lang, np.diff(row))
            for name in set(lang):
                found[name] = found.get(name, 0) + language_counts(ids[of == name])
        for name, counts in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * LANGUAGE_BUCKETS, pa.string()),
                                              pa.array(range(LANGUAGE_BUCKETS), pa.int32()), pa.array(counts, pa.int64())],
                                             ["lang", "bucket", "n"])

    sums = map_arrow(words.select("lang", "words"), run, "lang string, bucket int, n bigint").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()              # LANGUAGE_BUCKETS rows a language
    names = sums["lang"].to_pylist()
    languages = sorted(set(names))
    counts = np.zeros((LANGUAGE_BUCKETS, len(languages)))
    number = {name: k for k, name in enumerate(languages)}
    counts[sums["bucket"].to_numpy(), [number[name] for name in names]] = sums["n"].to_numpy()
    return languages, counts


def counted_odds(words: DataFrame, model: Classifier) -> list[np.ndarray]:
    """Guess, label, log-odds (of a grid) and how many held-back rows have them."""
    sent = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            ids, row = laid_words(batch.column(1))
            has = np.diff(row) > 0
            if has.any():
                guessed, z = held_back(sent.value, ids, np.r_[row[:-1][has], row[-1]])
                yield pa.RecordBatch.from_arrays([pa.array(guessed, pa.int64()), batch.column(0).filter(pa.array(has)),
                                                  pa.array(z)], ["guessed", "y", "z"])

    found = map_arrow(words.where("held").select("y", "words"), run, "guessed bigint, y int, z bigint").groupBy(
        "guessed", "y", "z").agg(F.count("*").alias("n")).toArrow()         # 2 * FAR_ODDS * GRID rows a language and label
    sent.destroy()
    return [found[c].to_numpy() for c in ("guessed", "y", "z", "n")]


def score_texts(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 where the score is 0.5 or more)."""
    keep = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    shared = docs.sparkSession.sparkContext.broadcast(model)      # fixed size, about 2 MB

    def run(batches):
        for batch in batches:
            s = scores(shared.value, batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s.astype(np.float64)),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             [*batch.schema.names, "score", "predicted"])

    return map_arrow(keep, run, extended(keep.schema, score=T.DoubleType(), predicted=T.IntegerType()))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier learnt from all labelled rows whose id bucket (crc32 mod 5) is not 0."""
    with shuffles_dropped(docs.sparkSession):
        words, n, toxic = labelled_words(docs.where(id_bucket(F.col("doc_id"), 5) != 0), labels)
        if words is None:
            return Classifier(*[None] * 4, 0.0, constant=float(toxic > 0))
        model = new_classifier()
        taught = words.where("NOT held").count()
        for round_ in range(EPOCHS if taught else 0):
            model = averaged_round(words, model, round_, taught, label_weights(n, toxic))
        model.rate = toxic / n
        guess_by(model, *summed_languages(words))
        shift_by(model, *counted_odds(words, model))
        drop_written(words)
    release_driver_memory(docs.sparkSession)
    return model


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score_texts(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
