"""Secret scans: fixed patterns plus a linear-chain conditional random field.

Base spans come from three patterns (below). The field tags every word of a text as begin (B),
inside (I) or outside (O) of a secret from the word's shape, its neighbours' shapes and hashed
forms, and features of the whole text. It learns from a bounded sample of texts of any length, by
gradient ascent on the exact log-likelihood (forward-backward in numpy): from windows around base
spans, around the same places with the secret written another way (other key words or none,
other separators or none, values of other alphabets and lengths: forms that no pattern knows),
and around other words. Windows are cut where the texts are; the driver gets their feature
numbers only. Runs of B I* that touch no base span are added as kind ``model``.

Decoding is exact Viterbi. A word whose best non-O score lies further below O than any two
transitions can make up is O on every best path, so the chain falls apart there and only
the words between are decoded one by one.

Null text: empty, no spans. An empty table gives an empty result. Spans that start together are in
the order of their kinds. Very long texts are scanned whole. Repeated rows are scanned each.
Columns of the input that bear a result's name are replaced. Without any base span in the
sample nothing is learnt and only base spans are given.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_written, extended, map_arrow, release_driver_memory, release_memory, table, written
from .textvec import SPACED_CASED, Words, column_bytes, row_slices

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")            # whole runs of 24 and more
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SAMPLE_ROWS = 4000        # texts the field learns from, at most
WINDOW = 24               # words of a training window; shorter texts are padded
OF_KIND = {"base": 1, "altered": 2, "other": 2}       # windows of a text, at most
SLICE = 1 << 20           # bytes of texts scanned at a time
HASHED = 1024             # buckets of hashed words
ROUNDS = 60
O, B, I = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, by start, then kind."""
    found = []
    raw = text.encode().lower()
    if any(w in raw for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


# --- features ---------------------------------------------------------------------------

_CLASS = np.zeros(256, np.uint8)              # 1 lower, 2 upper, 4 digit, 8 mark, 16 other
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 4, 16
for _c in range(33, 127):
    _CLASS[_c] = _CLASS[_c] or 8
_LENGTHS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64])
_HEXISH = np.zeros(256, bool)
_HEXISH[48:58] = _HEXISH[97:103] = True

#: name and number of values of each feature
FEATURES = (("length", 14), ("classes", 32), ("digits", 6), ("changes", 8), ("hex", 3), ("joins", 4),
            ("before", 32), ("before_joins", 2), ("after", 32), ("word_before", HASHED), ("head", HASHED),
            ("text_digits", 4), ("text_marks", 4))
_OFFSETS = np.cumsum([0, *(n for _, n in FEATURES)])
PAD = int(_OFFSETS[-1])           # stands for all features of a place after a short text
N_FEATURES = PAD + 1


def features(col) -> tuple[Words, np.ndarray]:
    """Words of a column and, a row for each word, the numbers of its features."""
    w = Words(col, SPACED_CASED, prefixes=(4,))
    n = len(w.start)
    out = np.empty((n, len(FEATURES)), np.int32)
    if not n:
        return w, out
    raw, s, e = w.raw, w.start, w.end
    cls = _CLASS[raw]
    size = e - s

    def count(mask):
        sums = np.empty(len(raw) + 1, np.int32)
        sums[0] = 0
        np.cumsum(mask, out=sums[1:])
        return sums[e] - sums[s]

    lower, upper, digit, mark = (count(cls == c) for c in (1, 2, 4, 8))
    masks = ((lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (mark > 0)
             + 16 * (lower + upper + digit + mark < size)).astype(np.int32)
    change = np.zeros(len(raw), bool)
    change[1:] = cls[1:] != cls[:-1]
    changes = count(change) - change[s]
    hexish = count(_HEXISH[raw]) == size
    last = raw[e - 1]
    ends_join = (last == 58) | (last == 61)
    inner_join = count((raw == 58) | (raw == 61)) > ends_join
    first = np.zeros(n, bool)
    starts = w.row[:-1][w.row[:-1] < n]
    first[starts] = True                       # first word of its text (repeated for empty ones)
    final = np.zeros(n, bool)
    final[np.r_[starts[1:] - 1, n - 1] if len(starts) else []] = True
    row = np.searchsorted(w.row, np.arange(n), "right") - 1

    def per_text(counts):
        sums = np.r_[0, np.cumsum(counts)]
        total = (sums[w.row[1:]] - sums[w.row[:-1]]) / np.maximum(w.off[1:] - w.off[:-1], 1)
        return np.digitize(total, [0.005, 0.02, 0.08])[row]

    values = (
        np.digitize(size, _LENGTHS), masks, np.minimum(5, digit * 6 // size),
        np.minimum(7, changes), np.where(hexish, 1 + (size >= 16), 0), ends_join + 2 * inner_join,
        np.where(first, 0, np.r_[0, masks[:-1]]), np.where(first, 0, np.r_[False, ends_join[:-1]]),
        np.where(final, 0, np.r_[masks[1:], 0]),
        np.where(first, 0, np.r_[0, (w.hash[:-1] % np.uint64(HASHED)).astype(np.int64)]),
        (w.prefix[0] % np.uint64(HASHED)).astype(np.int64), per_text(digit), per_text(mark))
    for i, v in enumerate(values):
        out[:, i] = v + _OFFSETS[i]
    return w, out


# --- the field --------------------------------------------------------------------------

@dataclass
class Field:
    """Weights (feature, tag) and transitions (tag, tag)."""

    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros((len(numbers), 3), np.float32)
        for i in range(numbers.shape[1]):
            out += self.weights[numbers[:, i]]
        return out

    def tags(self, emissions: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best tags of each text (texts: words row[i]:row[i+1]); int8."""
        n = len(emissions)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        gain = emissions[:, 1:].max(axis=1) - emissions[:, O]
        m = self.moves
        into, out_of = (m[:, 1:] - m[:, [O]]).max(axis=0), (m[1:, :] - m[[O], :]).max(axis=1)
        most = max((into + out_of).max(), into.max(), out_of.max(), 0.0)
        open_ = np.flatnonzero(gain >= -most)
        if not len(open_):
            return out
        # Runs of open words inside one text, with the certain O on either side.
        text = np.searchsorted(row, open_, "right")
        new = np.r_[True, (np.diff(open_) > 1) | (np.diff(text) > 0)]
        begin = open_[new]
        stop = np.r_[open_[np.flatnonzero(new)[1:] - 1], open_[-1]] + 1
        lo, hi = row[text[new] - 1], row[text[new]]
        moves = m.tolist()
        for a, z, first, after in zip(begin.tolist(), stop.tolist(), lo.tolist(), hi.tolist()):
            out[a:z] = _viterbi(emissions[a:z].tolist(), moves, a > first, z < after)
        return out


def _viterbi(scores, moves, o_before: bool, o_after: bool) -> list[int]:
    best = [scores[0][y] + (moves[O][y] if o_before else 0.0) for y in range(3)]
    back = []
    for s in scores[1:]:
        came = [max(range(3), key=lambda x, y=y: best[x] + moves[x][y]) for y in range(3)]
        best = [best[came[y]] + moves[came[y]][y] + s[y] for y in range(3)]
        back.append(came)
    if o_after:
        best = [best[y] + moves[y][O] for y in range(3)]
    y = max(range(3), key=best.__getitem__)
    out = [y]
    for came in reversed(back):
        y = came[y]
        out.append(y)
    return out[::-1]


def fit_field(numbers: np.ndarray, tags: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Maximum likelihood with a small quadratic penalty.

    ``numbers`` (windows, words, features) and ``tags`` (windows, words).
    """
    n, length, _ = numbers.shape
    theta = [np.zeros((N_FEATURES, 3)), np.zeros((3, 3))]
    first, second = ([np.zeros_like(t) for t in theta] for _ in range(2))
    gold = np.eye(3)[tags]                                      # windows, words, 3
    for step in range(1, rounds + 1):
        w, m = theta
        e = np.zeros((n, length, 3))
        for i in range(numbers.shape[2]):
            e += w[numbers[:, :, i]]
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0]
        for t in range(1, length):
            fwd[:, t] = e[:, t] + _lse(fwd[:, t - 1, :, None] + m[None], 1)
        for t in range(length - 2, -1, -1):
            bwd[:, t] = _lse(m[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        z = _lse(fwd[:, -1], 1)
        p = np.exp(fwd + bwd - z[:, None, None])
        diff = gold - p
        gw = np.zeros((N_FEATURES, 3))
        for y in range(3):
            d = diff[:, :, y].ravel()
            for i in range(numbers.shape[2]):
                gw[:, y] += np.bincount(numbers[:, :, i].ravel(), d, N_FEATURES)
        pair = np.exp(fwd[:, :-1, :, None] + m + (e + bwd)[:, 1:, None, :] - z[:, None, None, None])
        gm = np.einsum("ntx,nty->xy", gold[:, :-1], gold[:, 1:]) - pair.sum(axis=(0, 1))
        for i, g in enumerate((gw / n - 1e-4 * w, gm / n - 1e-4 * m)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            theta[i] = theta[i] + 0.15 * (first[i] / (1 - 0.9 ** step)) / (
                np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return Field(theta[0].astype(np.float32), theta[1].astype(np.float32))


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


#: Ways to write a secret that the patterns don't know: key words, what joins them to a value, values.
OTHER_KEYS = ("password", "passwd", "secret", "token", "api_key", "pass", "pwd", "key", "auth", "credential", "bearer")
OTHER_JOINS = (" ", " is ", " = ", "=", ": ", " -> ", " => ", "(", " '")
OTHER_HEADS = ("", "", "", "pk_", "rk-test-", "xoxb-", "glpat-", "eyJ", "npm_", "SG.")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (LETTERS + LETTERS.upper() + "0123456789", LETTERS + "0123456789", LETTERS.upper() + "0123456789",
             "0123456789ABCDEF", LETTERS + LETTERS.upper() + "0123456789+/", LETTERS + "0123456789-_")


def altered(text: str, spans, rng) -> tuple[str, list[tuple[int, int]]]:
    """``text`` with each base span written another way, and the new spans."""
    out, found, pos, size = [], [], 0, 0
    for start, _, end in spans:
        if start < pos:
            continue
        value = OTHER_HEADS[rng.integers(len(OTHER_HEADS))]
        alphabet = ALPHABETS[rng.integers(len(ALPHABETS))]
        value += "".join(alphabet[k] for k in rng.integers(0, len(alphabet), int(rng.integers(14, 48))))
        if rng.random() < 0.6:
            value = OTHER_KEYS[rng.integers(len(OTHER_KEYS))] + OTHER_JOINS[rng.integers(len(OTHER_JOINS))] + value
        out += [text[pos:start], value]
        size += start - pos
        found.append((size, size + len(value)))
        size, pos = size + len(value), end
    return "".join([*out, text[pos:]]), found


def _windows(text: str, spans, most: int, others: int, rng):
    """(numbers, tags) of windows around up to ``most`` of ``spans`` and ``others`` other places."""
    w, f = features(pa.array([text]))
    n = len(f)
    if not n:
        return
    y, centres, done = np.zeros(n, np.int64), [], (0, 0)
    for start, end in spans:
        done = done[0] + len(text[done[1]:start].encode()), start              # bytes before ``start``
        i, j = np.searchsorted(w.end, done[0], "right"), np.searchsorted(w.start, done[0] + len(text[start:end].encode()))
        if i < j and not y[i:j].any():
            y[i], y[i + 1:j] = B, I
            centres.append(int(i))
    picked = rng.permutation(len(centres))[:most]
    centres = [centres[k] for k in picked] + rng.integers(0, n, others).tolist()
    for c in centres:
        a = min(max(0, c - int(rng.integers(4, WINDOW - 4))), max(0, n - WINDOW))
        numbers, tags = np.full((WINDOW, f.shape[1]), PAD, np.int16), np.zeros(WINDOW, np.int8)
        numbers[:n - a], tags[:n - a] = f[a:a + WINDOW], y[a:a + WINDOW]
        yield numbers, tags


def text_windows(text: str):
    """Training windows of one text; the same ones on every executor."""
    rng = np.random.default_rng(zlib.crc32(text.encode()))
    base = base_spans(text)
    yield from _windows(text, [(s, e) for s, _, e in base], OF_KIND["base"], OF_KIND["other"], rng)
    if base:
        yield from _windows(*altered(text, base, rng), OF_KIND["altered"], 0, rng)


def training_windows(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (windows, words, features) and tags (windows, words) of the windows of
    the texts in column ``t``, in the order of column ``h``."""
    def run(batches):
        for batch in batches:
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                both = list(text_windows(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * len(both), pa.int64()), pa.array([x.tobytes() for x, _ in both], pa.binary()),
                     pa.array([y.tobytes() for _, y in both], pa.binary())], ["h", "numbers", "tags"])

    found = map_arrow(texts.select("h", "t"), run, "h bigint, numbers binary, tags binary").toArrow()
    found = found.sort_by([("h", "ascending"), ("tags", "ascending"), ("numbers", "ascending")])
    n = len(found)
    numbers = np.frombuffer(b"".join(found["numbers"].to_pylist()), np.int16)
    tags = np.frombuffer(b"".join(found["tags"].to_pylist()), np.int8)
    return numbers.reshape(n, WINDOW, len(FEATURES)), tags.reshape(n, WINDOW)


def learn_field(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> Field | None:
    """The field learnt from windows of ``rows`` texts at most.

    Half of them hold a word that base patterns look for, where there are so many; each half
    is the distinct texts with the smallest hashes, so reruns agree.
    """
    d = docs.select(F.col(text).alias("t")).where("t <> ''")
    likely = F.col("t").rlike(r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-f]{24}")
    d = d.withColumn("k", likely).withColumn("h", F.xxhash64("t"))
    # Hashes first, so that no text is sorted; then the texts of those few.
    hashes = written(d.select("k", "h").distinct(), "secret-sample")
    chosen = [r["h"] for kind in (True, False)
              for r in hashes.where(F.col("k") == kind).orderBy("h").limit(rows // 2).collect()]
    drop_written(hashes)
    few = docs.sparkSession.createDataFrame([(h,) for h in chosen], "h bigint")          # ``rows`` at most
    numbers, tags = training_windows(d.join(F.broadcast(few), "h").groupBy("h").agg(F.min("t").alias("t")))
    release_driver_memory(docs.sparkSession)               # the fit's own arrays come on top
    field = fit_field(numbers, tags) if (tags == B).any() else None
    del numbers, tags
    release_memory()
    return field


# --- scanning ---------------------------------------------------------------------------

def scan_column(col, field: Field | None):
    """For each row: the base spans and all spans, (start, kind, end) in code points."""
    raw, off = column_bytes(col)
    for i, j in row_slices(off, SLICE):
        part = col.slice(i, j - i).fill_null("")
        if field is not None:
            w, f = features(part)
            tags = field.tags(field.emissions(f), w.row)
            before = np.r_[O, tags[:-1]]
            before[w.row[:-1][w.row[:-1] < len(tags)]] = O          # nothing stands before a text's first word
            begins = np.flatnonzero((tags == B) | ((tags == I) & (before == O)))
            texts_of = np.searchsorted(w.row, begins, "right") - 1
            points = np.zeros(len(w.raw) + 1, np.int32)               # code points before each byte
            np.cumsum((w.raw & 0xC0) != 0x80, out=points[1:])
        else:
            begins = texts_of = np.empty(0, np.int64)
        at = np.searchsorted(texts_of, np.arange(j - i + 1))
        for k, value in enumerate(part):
            text = value.as_py()
            base = base_spans(text)
            reach = list(accumulate((e for _, _, e in base), max))
            added = []
            held = 0                                                 # base spans that end before this one
            for b in begins[at[k]:at[k + 1]].tolist():
                z, stop = b + 1, int(w.row[k + 1])
                while z < stop and tags[z] == I:
                    z += 1
                start, end = (int(points[x] - points[w.off[k]]) for x in (w.start[b], w.end[z - 1]))
                while held < len(base) and reach[held] <= start:
                    held += 1
                if held == len(base) or end <= base[held][0]:
                    added.append((start, len(KINDS), end))
            yield base, sorted(base + added)


def spelled(spans) -> str:
    names = (*KINDS, "model")
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


RESULTS = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(),
           "base_sha256": T.StringType(), "spans": T.StringType()}


def find_secrets(docs: DataFrame, text: str = "text", field: Field | None = None,
                 redact: str | None = None) -> DataFrame:
    """Add counts, digest and spans of the secrets in each row's whole text.

    ``redact``: replace each span of ``text`` by this string.
    """
    keep = docs.select(*[c for c in docs.columns if c not in RESULTS])
    shared = docs.sparkSession.sparkContext.broadcast(field)     # fixed size: a few thousand weights

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            col = batch.column(at)
            rows, texts = [], []
            for value, (base, spans) in zip(col, scan_column(col, shared.value)):
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                             hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(spans)))
                if redact is not None:
                    texts.append(hide(value.as_py(), spans, redact))
            columns = list(batch.columns)
            if redact is not None:
                columns[at] = pa.array(texts, batch.schema.field(at).type)
            new = list(zip(*rows)) or [()] * len(RESULTS)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, k) for c, k in zip(new, kinds))],
                                             [*batch.schema.names, *RESULTS])

    return map_arrow(keep, run, extended(keep.schema, **RESULTS))


def hide(text: str | None, spans, mark: str) -> str | None:
    """``text`` with each span (overlapping ones as one) replaced by ``mark``."""
    if text is None or not spans:
        return text
    out, pos = [], 0
    for start, _, end in spans:
        if start >= pos:
            out += [text[pos:start], mark]
        pos = max(pos, end)
    return "".join([*out, text[pos:]])


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by the field learnt from a sample of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, field=learn_field(docs)).drop("text")
