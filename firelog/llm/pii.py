"""Personal data: base patterns and a character BiLSTM with CRF transitions (operator 4).

Four kinds of span: e-mail address, IPv4 address, payment card number and
telephone number. The base spans follow fixed patterns over the whole text.
The model is a character-level bidirectional LSTM whose outputs are decoded
by a CRF (start, inside, outside per kind); it is trained here in numpy on
spans of a bounded sample of texts and adds spans in formats the patterns
miss. It runs on overlapping windows over every stretch of text that holds a
digit or an ``@`` (no span of these kinds is without one). Window results are
reconciled over the whole text: pieces of one kind that overlap are joined,
base spans stay as they are, and a joined span is added only if it touches no
base span and its characters are possible for its kind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog.llm.common import SLICE_BYTES, by_slices, code_points, map_slices, runs, small_batches

KINDS = ("email", "ip", "card", "phone")
# Bounds of the training sample: texts read and windows used.
MAX_TEXTS = 2000
MAX_WINDOWS = 2500
WINDOW = 96
STRIDE = 48
HIDDEN = 12
EMBED = 10
TAGS = 1 + 2 * len(KINDS)
EPOCHS = 6
# Least number of steps, so that a small sample is gone through more often.
MIN_STEPS = 230
# Windows decoded at once.
BLOCK = 512

# The base patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` of the base patterns, leftmost and non-overlapping per kind.

    The e-mail pattern is matched outward from each ``@``: its local part is
    the longest run of allowed characters before it that begins after the
    previous match, which is where a left-to-right search would start.
    """
    out: list[tuple[int, int, int]] = []
    free, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        m = _DOMAIN.match(text, at) if a < at else None
        if m:
            out.append((a, m.end(), 0))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(free, at + 1))
    if any(d in text for d in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if 14 <= len(m[0]) <= 40 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _class_table() -> np.ndarray:
    """Class of each code point below 256; others: letter or not."""
    table = np.zeros(256, np.int8)
    punct = " \n\t.,;:!?@+-_()[]{}<>/\\|#$%&*='\"~^`"
    for i in range(256):
        ch = chr(i)
        if "0" <= ch <= "9":
            table[i] = 1
        elif "a" <= ch <= "z":
            table[i] = 2
        elif "A" <= ch <= "Z":
            table[i] = 3
        elif ch in punct:
            table[i] = 6 + punct.index(ch)
        else:
            table[i] = 4 if ch.isalpha() else 5
    return table


_CLASSES = _class_table()
_SPACES = np.array([chr(i).isspace() for i in range(256)])
N_CLASSES = int(_CLASSES.max()) + 2  # the last one: beyond the text


def char_classes(points: np.ndarray) -> np.ndarray:
    return np.where(points < 256, _CLASSES[np.minimum(points, 255)], 4)


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over stretches with a digit or ``@``: (classes n x WINDOW, text index, start in the text).

    A stretch reaches ``STRIDE / 2`` characters to either side, and on to the
    next white space of the word it begins or ends with; its windows start every ``STRIDE`` characters, so each position but the margins is in
    two of them.
    """
    points, first, last = code_points(texts)
    trigger = ((points >= 48) & (points <= 57)) | (points == 64)
    a, b = runs(trigger)
    if not len(a):
        return np.zeros((0, WINDOW), np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.searchsorted(first, a, side="right") - 1
    reach = STRIDE // 2
    # the words with the trigger are whole; every text is followed by a line feed
    place = np.arange(len(points))
    space = (points < 256) & _SPACES[np.minimum(points, 255)]
    before = np.maximum.accumulate(np.where(space, place, -1))
    after = np.minimum.accumulate(np.where(space, place, len(points))[::-1])[::-1]
    lo = np.maximum(np.minimum(a - reach, before[a] + 1), first[owner])
    hi = np.minimum(np.maximum(b + reach, after[b]), last[owner])
    new = np.ones(len(a), bool)
    new[1:] = (lo[1:] > hi[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    lo, hi, owner = lo[head], np.append(hi[head[1:] - 1], hi[-1]), owner[head]
    count = 1 + np.maximum(0, -(-(hi - lo - WINDOW) // STRIDE))
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(lo, count) + k * STRIDE
    owner = np.repeat(owner, count)
    idx = start[:, None] + np.arange(WINDOW)[None, :]
    inside = idx < last[owner][:, None]
    cls = np.where(inside, char_classes(points)[np.minimum(idx, len(points) - 1)], N_CLASSES - 1)
    return cls.astype(np.int8), owner, start - first[owner]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _new_model(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    g = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    m = {"emb": rng.normal(0, 0.3, (N_CLASSES, EMBED))}
    for d in "fb":
        m |= {f"wx{d}": g(EMBED, 4 * HIDDEN), f"wh{d}": g(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN)}
        m[f"b{d}"][HIDDEN:2 * HIDDEN] = 1
    return m | {"wo": g(2 * HIDDEN, TAGS), "bo": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS)), "start": np.zeros(TAGS)}


def _lstm(m, d: str, x: np.ndarray, keep: bool):
    """Hidden states (T, n, HIDDEN) for classes ``x`` (T, n) in reading order of direction ``d``."""
    table = m["emb"] @ m[f"wx{d}"] + m[f"b{d}"]
    steps, n = x.shape
    h = c = np.zeros((n, HIDDEN), table.dtype)
    hs, saved = np.empty((steps, n, HIDDEN), table.dtype), []
    for t in range(steps):
        z = table[x[t]] + h @ m[f"wh{d}"]
        act = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = act[:, :HIDDEN], act[:, HIDDEN:2 * HIDDEN], act[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        prev_h, prev_c = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[t] = h
        if keep:
            saved.append((i, f, o, g, tc, prev_h, prev_c))
    return hs, saved


def emissions(m, x: np.ndarray, keep: bool = False):
    """Tag scores (T, n, TAGS) of classes ``x`` (T, n)."""
    hf, sf = _lstm(m, "f", x, keep)
    hb, sb = _lstm(m, "b", x[::-1], keep)
    h = np.concatenate([hf, hb[::-1]], axis=2)
    return h @ m["wo"] + m["bo"], (h, sf, sb)


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf_grads(m, e: np.ndarray, y: np.ndarray):
    """Gradients of the negative log likelihood of tags ``y`` (T, n) under scores ``e``."""
    steps, n, k = e.shape
    a, b = np.empty_like(e), np.zeros_like(e)
    a[0] = m["start"] + e[0]
    for t in range(1, steps):
        a[t] = _lse(a[t - 1][:, :, None] + m["trans"][None], 1) + e[t]
    for t in range(steps - 2, -1, -1):
        b[t] = _lse(m["trans"][None] + (e[t + 1] + b[t + 1])[:, None, :], 2)
    z = _lse(a[-1], 1)
    d_e = np.exp(a + b - z[None, :, None])
    pair = np.exp(a[:-1, :, :, None] + m["trans"] + (e[1:] + b[1:])[:, :, None, :] - z[None, :, None, None]).sum(axis=(0, 1))
    np.add.at(pair, (y[:-1].ravel(), y[1:].ravel()), -1.0)
    np.put_along_axis(d_e, y[:, :, None], np.take_along_axis(d_e, y[:, :, None], 2) - 1, 2)
    return d_e / n, pair / n, d_e[0].sum(axis=0) / n


def _lstm_back(m, d: str, x, saved, d_h, grads):
    steps, n = x.shape
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    d_table = np.zeros((N_CLASSES, 4 * HIDDEN))
    for t in range(steps - 1, -1, -1):
        i, f, o, g, tc, prev_h, prev_c = saved[t]
        dh = dh + d_h[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * prev_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        grads[f"wh{d}"] += prev_h.T @ dz
        np.add.at(d_table, x[t], dz)
        dh = dz @ m[f"wh{d}"].T
        dc = dc * f
    grads[f"b{d}"] += d_table.sum(axis=0)
    grads[f"wx{d}"] += m["emb"].T @ d_table
    grads["emb"] += d_table @ m[f"wx{d}"].T


def train_model(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> dict[str, np.ndarray] | None:
    """Weights from windows ``x`` and tags ``y`` (n, WINDOW); None without a window to learn from."""
    if not len(x):
        return None
    m = _new_model(seed)
    mean = {k: np.zeros_like(v) for k, v in m.items()}
    var = {k: np.zeros_like(v) for k, v in m.items()}
    rng, step = np.random.default_rng(seed), 0
    parts = max(1, len(x) // 64)
    epochs = max(epochs, -(-MIN_STEPS // parts))
    for epoch in range(epochs):
        for pick in np.array_split(rng.permutation(len(x)), parts):
            xb, yb = x[pick].T.astype(np.int64), y[pick].T.astype(np.int64)
            e, (h, sf, sb) = emissions(m, xb, keep=True)
            d_e, d_trans, d_start = _crf_grads(m, e, yb)
            grads = {k: np.zeros_like(v) for k, v in m.items()}
            grads["trans"], grads["start"], grads["bo"] = d_trans, d_start, d_e.sum(axis=(0, 1))
            grads["wo"] = np.einsum("tnh,tnk->hk", h, d_e)
            d_h = d_e @ m["wo"].T
            _lstm_back(m, "f", xb, sf, d_h[:, :, :HIDDEN], grads)
            _lstm_back(m, "b", xb[::-1], sb, d_h[::-1, :, HIDDEN:], grads)
            size = np.sqrt(sum((g * g).sum() for g in grads.values()))
            step += 1
            rate = 0.02 / (1 + 6 * epoch / epochs)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(size, 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.99 * var[k] + 0.01 * g * g
                m[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.99 ** step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in m.items()}


def decode(m, x: np.ndarray) -> np.ndarray:
    """Best tags (n, WINDOW) of windows under the CRF (Viterbi)."""
    out = np.zeros(x.shape, np.int8)
    for s in range(0, len(x), BLOCK):
        e, _ = emissions(m, x[s:s + BLOCK].T.astype(np.int64))
        steps, n, _ = e.shape
        score = m["start"] + e[0]
        back = np.empty((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            cand = score[:, :, None] + m["trans"][None]
            back[t] = cand.argmax(axis=1)
            score = cand.max(axis=1) + e[t]
        tag = score.argmax(axis=1)
        row = np.arange(n)
        for t in range(steps - 1, -1, -1):
            out[s:s + BLOCK, t] = tag
            if t:
                tag = back[t][row, tag].astype(np.int64)
    return out


def tags_of(texts: list[str], spans: list[list[tuple[int, int, int]]], owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Tags (n, WINDOW) of windows from labelled spans: 0 outside, 1+2k the start and 2+2k the inside of kind k."""
    y = np.zeros((len(owner), WINDOW), np.int8)
    for i, (o, s) in enumerate(zip(owner, start, strict=True)):
        for a, b, k in spans[o]:
            if a < s + WINDOW and b > s:
                y[i, max(a - s, 0):b - s] = 2 + 2 * k
                if a >= s:
                    y[i, a - s] = 1 + 2 * k
    return y


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray] | None:
    """Model from the spans of at most ``MAX_TEXTS`` texts (smallest by a hash of the id) with a digit or ``@``."""
    some = docs.where(F.col(text_col).rlike("[0-9@]") & (F.length(text_col) <= 100_000)).select(
        F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    # the hashes alone are sorted: a task sends numbers, and only the chosen texts come to the driver
    cut = some.select("h").distinct().orderBy("h").limit(MAX_TEXTS).agg(F.max("h")).first()[0]
    if cut is None:
        return None
    rows = sorted(some.where(F.col("h") <= cut).dropDuplicates(["h"]).collect(), key=lambda r: r["h"])
    return train_on([r["text"] for r in rows])


def variant(span: str, kind: int) -> str:
    """The same datum in a format that the base patterns miss."""
    if kind == 0:
        return span.replace("@", "é@", 1)
    if kind == 1:
        return span.replace(".", "[.]")
    if kind == 2:
        d = _digits(span)
        return ".".join(d[i:i + 4] for i in range(0, len(d), 4))
    return span.partition(" ")[2] or span


def train_on(texts: list[str]) -> dict[str, np.ndarray] | None:
    """Model from texts, labelled by their base spans, and copies of them with the spans in other formats."""
    spans = [base_spans(t) for t in texts]
    all_texts, all_spans = list(texts), list(spans)
    for t, own in zip(texts, spans, strict=True):
        out, moved, at, size = [], [], 0, 0
        for a, b, k in own:
            if a < at:
                continue
            new = variant(t[a:b], k)
            out += [t[at:a], new]
            size += a - at
            moved.append((size, size + len(new), k))
            size += len(new)
            at = b
        if moved:
            all_texts.append("".join(out) + t[at:])
            all_spans.append(moved)
    # a slice of the sample at a time: the arrays take many bytes a character
    parts, at = [], 0
    while at < len(all_texts):
        upto, size = at, 0
        while upto < len(all_texts) and (upto == at or size + len(all_texts[upto]) <= SLICE_BYTES):
            size += len(all_texts[upto])
            upto += 1
        x, owner, start = windows(all_texts[at:upto])
        parts.append((x, owner + at, start))
        at = upto
    x, owner, start = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else windows([])
    pick = np.random.default_rng(3).permutation(len(x))[:MAX_WINDOWS]
    return train_model(x[pick], tags_of(all_texts, all_spans, owner[pick], start[pick]))


def possible(kind: int, text: str, before: str, after: str) -> bool:
    """Whether the characters of an added span can be of its kind."""
    if before.isalnum() or after.isalnum():
        return False
    d = _digits(text)
    if kind == 0:
        name, at, host = text.partition("@")
        return bool(at and name.strip() and "." in host.strip(".") and not re.search(r"\s", text))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not re.search(r"[A-Za-z ]", text)
    if kind == 2:
        return 14 <= len(d) <= 19 and luhn(d) and not re.search(r"[A-Za-z]", text)
    return 10 <= len(d) <= 15 and len(d) < len(text) <= 24 and not re.search(r"[^0-9 ()./+-]", text)


def reconcile(texts: list[str], bases: list[list[tuple[int, int, int]]], tags: np.ndarray, owner: np.ndarray,
              start: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """All spans of each text: the base spans and the windows' spans that add to them."""
    out = [list(b) for b in bases]
    kind = np.where(tags > 0, (tags.astype(np.int64) - 1) // 2, -1)
    begin = (kind >= 0) & ((tags % 2 == 1) | (np.pad(kind, ((0, 0), (1, 0)), constant_values=-1)[:, :-1] != kind))
    pieces: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for w, a in zip(*np.nonzero(begin), strict=True):
        k = kind[w, a]
        b = a + 1
        while b < WINDOW and kind[w, b] == k and not begin[w, b]:
            b += 1
        s = int(start[w])
        end = min(s + int(b), len(texts[owner[w]]))
        if end > s + a:
            pieces.setdefault((int(owner[w]), int(k)), []).append((s + int(a), end))
    joined: dict[int, list[tuple[int, int, int]]] = {}
    for (o, k), parts in pieces.items():
        spans: list[list[int]] = []
        for a, b in sorted(parts):
            if spans and a < spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        joined.setdefault(o, []).extend((a, b, k) for a, b in spans)
    for o, spans in joined.items():
        t = texts[o]
        taken = [(a, b) for a, b, _ in out[o]]
        for a, b, k in sorted(spans, key=lambda s: (s[0] - s[1], s[0], s[2])):  # longer ones first
            if any(a < y and x < b for x, y in taken):
                continue
            if possible(k, t[a:b], t[a - 1:a], t[b:b + 1]):
                out[o].append((a, b, k))
                taken.append((a, b))
        out[o].sort(key=lambda s: (s[0], s[2], s[1]))
    return out


def find(model, texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base spans and all spans of every text."""
    bases = [base_spans(t) for t in texts]
    x, owner, start = windows(texts)
    if model is None or not len(x):
        return bases, [list(b) for b in bases]
    return bases, reconcile(texts, bases, decode(model, x), owner, start)


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans as one, by the first kind."""
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` of every row.

    The four counts and the hash are of the base spans, ``spans`` lists all
    of them, ``n_added`` counts the model's. A null text is taken as empty
    (no spans); null ids and repeated rows stay; other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        bases, every = find(model, texts)
        counts = [pa.array([sum(s[2] == k for s in b) for b in bases], pa.int64()) for k in range(4)]
        sha = [hashlib.sha256(as_text(b).encode()).hexdigest() for b in bases]
        added = [len(e) - len(b) for b, e in zip(bases, every, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *counts, pa.array(sha, pa.string()), pa.array([as_text(e) for e in every], pa.string()),
             pa.array(added, pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(narrow, "text", run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                      "base_sha256 string, spans string, n_added long")


def mask(docs: DataFrame, model, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs``, all columns, with spans masked in the text and the length column (if any) set anew; null texts stay."""
    def mask_texts(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        _, every = find(model, [t or "" for t in texts])
        return pa.array([None if t is None else masked(t, s) for t, s in zip(texts, every, strict=True)], pa.string())

    @F.arrow_udf("string")
    def new_text(texts: pa.Array) -> pa.Array:
        return by_slices(texts, mask_texts, pa.string())

    small_batches(docs.sparkSession)
    # only the text goes to Python; the other columns stay where they are
    out = docs.withColumn(text_col, new_text(docs[text_col]))
    if length_col in docs.columns:
        size = F.when(F.col(f"`{text_col}`").isNull(), F.col(f"`{length_col}`")).otherwise(F.length(f"`{text_col}`"))
        out = out.withColumn(length_col, size.cast(docs.schema[length_col].dataType))
    return out
