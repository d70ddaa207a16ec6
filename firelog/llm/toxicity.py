"""Toxicity scores by a convolutional text classifier (operator 3).

A word is the sum of hashed embeddings of itself, its prefixes and its
suffixes; filters of widths 1 to 3 run over the word sequence, each filter's
largest response in the text is kept (max pooling), and a logistic layer
gives the logit. All of it is trained here in numpy on a bounded sample of
labelled rows (``MAX_PER_CLASS`` of each class) and applied to every word of
every text. Embeddings start from each bucket's log odds between the classes
(zero where it is rare in the sample), so that max pooling has something to
choose from at the first step; a word never seen in training has no influence.

Thresholds are calibrated by language on a held-out part of the sample: the
logit is shifted so that the threshold of the text's language gives 0.7. The
language is judged from the text alone (function words below).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog.llm.common import RangeHash, alpha_table, code_points, map_slices, mix, runs

# Bound of the training sample: rows of each class.
MAX_PER_CLASS = 3000
THRESHOLD = 0.7
BUCKETS = 1 << 18
DIM = 8
FILTERS = 16
WIDTHS = (1, 2, 3)
EPOCHS = 6
PREFIXES = (3, 4, 5, 6)
SUFFIXES = (3, 4)
N_HASHES = 1 + len(PREFIXES) + len(SUFFIXES)
_PAD = max(WIDTHS) - 1

# Frequent function words by which a text's language group is judged.
FUNCTION_WORDS = {
    "de": "der die das und ist nicht ein eine den mit von zu auf für sich",
    "en": "the and of to is that it for was with as on be this from",
    "es": "el los las y en que un una por con del se al para es",
    "fr": "le les des et est un une dans que pour qui sur pas au avec",
    "it": "il gli che di non è per una con sono della nel lo si anche",
    "nl": "de het een van en niet dat op zijn voor met ook aan er maar",
    "pt": "o os as e que não uma um com para por dos da em mais",
}
LANGS = sorted(FUNCTION_WORDS)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word features of the texts.

    Returns bucket ids (words x ``N_HASHES``, 0 where a word is too short for
    a prefix or suffix or for a padding word), the first row of each text and
    each text's language group (len(LANGS): none). Every text starts with
    ``_PAD`` padding words, so no filter spans two texts.
    """
    points, starts, ends = code_points([t.lower() for t in texts])
    a, b = runs(alpha_table()[points])
    h = RangeHash(points)
    whole = h.of(a, b)
    length = b - a
    parts = [whole]
    for n in PREFIXES:
        parts.append(np.where(length > n, h.of(a, np.minimum(a + n, b)) + np.uint64(n), 0))
    for n in SUFFIXES:
        parts.append(np.where(length > n, h.of(np.maximum(b - n, a), b) + np.uint64(16 + n), 0))
    hashes = np.stack(parts, axis=1)
    ids = np.where(hashes == 0, 0, 1 + mix(hashes) % np.uint64(BUCKETS - 1)).astype(np.int32)
    owner = np.searchsorted(starts, a, side="right") - 1
    per_text = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(per_text + _PAD)])
    rows = np.zeros((int(first[-1]), ids.shape[1]), np.int32)
    rows[np.arange(len(a)) + (owner + 1) * _PAD] = ids
    votes = np.zeros((len(texts), len(LANGS)))
    for k, table in enumerate(_function_hashes()):
        hit = np.isin(whole, table)
        votes[:, k] = np.bincount(owner[hit], minlength=len(texts))
    lang = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(LANGS))
    return rows, first[:-1], lang


def _function_hashes() -> list[np.ndarray]:
    out = []
    for k in LANGS:
        points, a, b = code_points(FUNCTION_WORDS[k].split())
        out.append(RangeHash(points).of(a, b))
    return out


def _new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {"table": np.zeros((BUCKETS, DIM), np.float32)}
    for w in WIDTHS:
        model[f"conv{w}"] = rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32)
        model[f"bias{w}"] = np.full(FILTERS, 0.05, np.float32)
    model["out"] = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
    model["out_bias"] = np.zeros(1, np.float32)
    return model


def _pooled(model, rows, first):
    """Pooled responses (texts x filters), the word where each is reached, and the word vectors."""
    words = model["table"][rows[:, 0]]
    for j in range(1, rows.shape[1]):
        words = words + model["table"][rows[:, j]]
    padded = np.concatenate([words, np.zeros((_PAD, DIM), np.float32)])
    n = len(words)
    pooled, where = [], []
    for w in WIDTHS:
        z = padded[:n] @ model[f"conv{w}"][0]
        for o in range(1, w):
            z += padded[o:n + o] @ model[f"conv{w}"][o]
        z += model[f"bias{w}"]
        pooled.append(np.maximum.reduceat(z, first, axis=0))
        where.append(z)
    return pooled, where, padded


def logits(model, rows, first) -> np.ndarray:
    pooled, _, _ = _pooled(model, rows, first)
    return np.maximum(np.concatenate(pooled, axis=1), 0) @ model["out"] + model["out_bias"][0]


def _argmax(z: np.ndarray, first: np.ndarray, top: np.ndarray) -> np.ndarray:
    """First row of each text at which each filter reaches its maximum."""
    out = np.empty(top.shape, np.int64)
    ends = np.append(first[1:], len(z))
    for i, (a, b) in enumerate(zip(first, ends, strict=True)):
        out[i] = a + z[a:b].argmax(axis=0)
    return out


def train_model(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Filters, embeddings and output layer by stochastic gradient steps (Adagrad) on the logistic loss.

    A fifth of the sample is kept for the thresholds by language. Without
    both classes in the sample the model scores every text 0.
    """
    y = np.asarray(labels, np.float32)
    model = _new_model(seed)
    model["shift"] = np.zeros(len(LANGS) + 1, np.float32)
    if len(set(y.tolist())) < 2:
        model["out_bias"][:] = -20
        return model
    order = np.random.default_rng(seed).permutation(len(texts))
    held, fit = (order[: len(order) // 5], order[len(order) // 5:]) if len(order) >= 50 else (order, order)
    weight = np.where(y > 0, 0.5 / max(y[fit].mean(), 1e-3), 0.5 / max(1 - y[fit].mean(), 1e-3)).astype(np.float32)
    squares = {k: np.full(v.shape, 1e-2, np.float32) for k, v in model.items() if k not in ("table", "shift")}
    table_squares = np.full(BUCKETS, 1e-3, np.float32)
    fit = fit[np.argsort([len(texts[i]) for i in fit], kind="stable")]
    batches = [fit[i:i + 32] for i in range(0, len(fit), 32)]
    cached = [features([texts[i] for i in b])[:2] for b in batches]
    _start_table(model, cached, [y[b] for b in batches], seed)
    rng = np.random.default_rng(seed + 1)
    for epoch in range(epochs):
        rate = 0.15 / (1 + epoch)
        for k in rng.permutation(len(batches)):
            rows, first = cached[k]
            pick = batches[k]
            pooled, zs, padded = _pooled(model, rows, first)
            act = np.maximum(np.concatenate(pooled, axis=1), 0)
            logit = act @ model["out"] + model["out_bias"][0]
            d = weight[pick] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[pick]) / len(pick)
            grads = {"out": act.T @ d + 1e-4 * model["out"], "out_bias": np.array([d.sum()], np.float32)}
            d_act = d[:, None] * model["out"][None, :] * (act > 0)
            touched, d_words = [], []
            for j, w in enumerate(WIDTHS):
                dz = d_act[:, j * FILTERS:(j + 1) * FILTERS]
                at = _argmax(zs[j], first, pooled[j])
                grads[f"bias{w}"] = dz.sum(axis=0)
                g = np.zeros_like(model[f"conv{w}"])
                for o in range(w):
                    vec = padded[at + o]
                    g[o] = np.einsum("nf,nfd->df", dz, vec)
                    touched.append((at + o).ravel())
                    d_words.append((dz[:, :, None] * model[f"conv{w}"][o].T[None]).reshape(-1, DIM))
                grads[f"conv{w}"] = g + 1e-5 * model[f"conv{w}"]
            for name, g in grads.items():
                squares[name] += g * g
                model[name] -= rate * g / np.sqrt(squares[name])
            at, d_words = np.concatenate(touched), np.concatenate(d_words)
            live = (at < len(rows)) & np.any(d_words != 0, axis=1)
            ids = rows[at[live]]
            used, place = np.unique(ids, return_inverse=True)
            g = np.zeros((len(used), DIM), np.float32)
            place = place.reshape(ids.shape)
            for c in range(ids.shape[1]):
                np.add.at(g, place[:, c], d_words[live])
            g[used == 0] = 0
            table_squares[used] += (g * g).mean(axis=1)
            model["table"][used] -= rate * g / np.sqrt(table_squares[used])[:, None]
    _calibrate(model, [texts[i] for i in held], y[held])
    return model


def _start_table(model, cached, labels, seed: int) -> None:
    """First embeddings: a bucket's log odds (by texts that hold it) in one direction, noise of that size in the others."""
    seen = np.zeros((2, BUCKETS))
    total = np.zeros(2)
    for (rows, first), y in zip(cached, labels, strict=True):
        ends = np.append(first[1:], len(rows))
        for a, b, t in zip(first, ends, y, strict=True):
            seen[int(t), np.unique(rows[a:b])] += 1
            total[int(t)] += 1
    odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 0.5) / (total[0] + 1))
    noise = np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    odds = np.where((np.abs(odds) > 2.5 * noise) & (seen.sum(axis=0) >= 4), np.clip(odds, -4, 4), 0) / 4
    odds[0] = 0
    rng = np.random.default_rng(seed + 2)
    model["table"][:] = odds[:, None] * rng.normal(0, 0.3, (BUCKETS, DIM))
    model["table"][:, 0] = odds


def _calibrate(model, texts: list[str], y: np.ndarray) -> None:
    """Logit shift of each language group: its threshold becomes ``THRESHOLD``."""
    values, langs = np.zeros(len(texts), np.float32), np.zeros(len(texts), np.int64)
    for i in range(0, len(texts), 64):
        rows, first, lang = features(texts[i:i + 64])
        values[i:i + 64], langs[i:i + 64] = logits(model, rows, first), lang
    everyone = _threshold(values, y)
    for k in range(len(LANGS) + 1):
        own = langs == k
        enough = min((y[own] > 0).sum(), (y[own] == 0).sum()) >= 20
        cut = _threshold(values[own], y[own]) if enough else everyone
        model["shift"][k] = np.log(THRESHOLD / (1 - THRESHOLD)) - cut


def _threshold(values: np.ndarray, y: np.ndarray) -> float:
    """Logit between the classes with the best F1; of equal ones the middle of the widest gap."""
    order = np.argsort(values)
    v, t = values[order], y[order]
    cut = np.append((v[:-1] + v[1:]) / 2, v[-1] + 1) if len(v) else np.zeros(1)
    gap = np.append(v[1:] - v[:-1], 0) if len(v) else np.zeros(1)
    above = t.sum() - np.cumsum(t)
    count = len(t) - np.arange(1, len(t) + 1)
    f1 = 2 * above / np.maximum(count + t.sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-9) if len(v) else np.array([0])
    return float(cut[best[np.argmax(gap[best])]])


def score_texts(model, texts: list[str | None]) -> np.ndarray:
    """Score in 0..1 of each text; ``THRESHOLD`` and above means toxic."""
    rows, first, lang = features([t or "" for t in texts])
    logit = logits(model, rows, first) + model["shift"][lang]
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -50, 50)))


def labelled_sample(docs: DataFrame, labels: DataFrame, allowed, max_per_class: int = MAX_PER_CLASS,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """At most ``max_per_class`` (text, label) rows of each class, the smallest by a hash of the id.

    ``allowed`` is a condition on the labels' id column.
    """
    marks = labels.where(allowed & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y")).distinct()
    picked = None
    for y in (0, 1):
        some = marks.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(max_per_class)
        picked = some if picked is None else picked.unionByName(some)
    ids = picked.collect()  # 2 * max_per_class ids
    if not ids:
        return [], np.zeros(0)
    few = docs.sparkSession.createDataFrame([(r["k"], r["y"]) for r in ids], "k long, y int")
    rows = (docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text"))
            .join(F.broadcast(few), "k")  # bounded by the sample
            .orderBy("k", "y", "text").collect())
    return [r["text"] or "" for r in rows], np.array([r["y"] for r in rows])


def score(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every row.

    Null and empty texts have the score of a text without words; repeated
    rows give repeated results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: buckets x dimension

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = score_texts(shared.value, batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                          names=["doc_id", "score", "predicted"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(narrow, "text", run, "doc_id long, score double, predicted int", max_bytes=1 << 19)
