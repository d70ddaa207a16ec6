"""Language identification by hyperdimensional n-gram profiles (operator 2).

Every letter has a random vector of +1 and -1; a trigram is the elementwise
product (binding) of its letters' vectors, rotated by their place; a text is
the sum (bundle) of its trigrams. A language's prototype is the bundle of
all its training texts. A text takes the language whose prototype has the
largest cosine with it.

Bundles are integer sums, so prototypes do not depend on how the rows are
partitioned: each task bundles its own rows per language and Spark adds the
tasks' sums. One prototype per language comes to the driver (languages x
``DIM`` numbers, whatever the corpus size).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog.llm.common import alpha_table, by_slices, code_points, map_slices, mix, small_batches

DIM = 512
UNKNOWN = "und"
# A low cosine is evidence only from so many effective trigrams. The noise of a cosine is about 1 / sqrt(DIM) = 0.044, and that of
# a text in its own language grows with its trigrams: pieces of sf0.1 texts with 64 or more have 0.308 at least, one-word pieces 0.
MIN_TRIGRAMS = 64
# Text bytes bundled at once: the count matrix is (texts in a slice) x (distinct trigrams).
SLICE = 1 << 18


def _letters(points: np.ndarray) -> np.ndarray:
    """Random +-1 vector of each code point, the same in every process."""
    with np.errstate(over="ignore"):
        seed = mix(points.astype(np.uint64) + np.uint64(0x51ED270B))
        words = mix(seed[:, None] + np.arange(1, DIM // 64 + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter trigrams: (text index of each occurrence, its trigram number, letters of each trigram).

    Letters are lower-cased; any run of other characters is one boundary
    (letter 0). Trigrams have a letter in their middle.
    """
    points, starts, ends = code_points([t.lower() for t in texts])
    letters = np.where(alpha_table()[points], points, 0)
    keep = letters != 0
    keep[1:] |= letters[:-1] != 0
    at = np.flatnonzero(keep)
    z = np.concatenate([[0], letters[at], [0]])
    owner = np.searchsorted(starts, at, side="right") - 1
    mid = z[1:-1] != 0
    owner = owner[mid]
    if not len(owner):
        return owner, owner, np.zeros((0, 3), np.uint32)
    alphabet = np.flatnonzero(np.bincount(z, minlength=1))
    small = np.zeros(int(z.max()) + 1, np.int64)
    small[alphabet] = np.arange(len(alphabet))
    s = small[z]
    n = len(alphabet)
    code = ((s[:-2] * n + s[1:-1]) * n + s[2:])[mid]
    if n ** 3 <= 1 << 22:
        used = np.flatnonzero(np.bincount(code, minlength=n ** 3))
        place = np.empty(n ** 3, np.int64)
        place[used] = np.arange(len(used))
        number = place[code]
    else:
        used, number = np.unique(code, return_inverse=True)
    grams = np.stack([alphabet[used // (n * n)], alphabet[used // n % n], alphabet[used % n]], axis=1)
    return owner, number, grams


def _gram_vectors(grams: np.ndarray) -> np.ndarray:
    points, idx = np.unique(grams, return_inverse=True)
    idx = idx.reshape(grams.shape)
    v = _letters(points)
    return np.roll(v, 2, axis=1)[idx[:, 0]] * np.roll(v, 1, axis=1)[idx[:, 1]] * v[idx[:, 2]]


def bundles(texts: list[str], groups: np.ndarray | None = None, n_groups: int | None = None) -> np.ndarray:
    """Bundle of each text (or of each group of texts) as exact integer sums in float64."""
    n = len(texts) if groups is None else n_groups
    owner, number, grams = _trigrams(texts)
    out = np.zeros((n, DIM))
    if not len(grams):
        return out
    if groups is not None:
        owner = groups[owner]
    # single precision is exact while sums stay below 2**24: a slice holds fewer trigrams per row unless
    # one huge text fills it alone
    kind = np.float32 if len(owner) < 1 << 24 else np.float64
    step = 4096
    for a in range(0, len(grams), step):
        sel = (number >= a) & (number < a + step)
        g = min(step, len(grams) - a)
        counts = np.bincount(owner[sel] * g + (number[sel] - a), minlength=n * g).reshape(n, g)
        out += counts.astype(kind) @ _gram_vectors(grams[a:a + step]).astype(kind)
    return out


def evidence(texts: list[str]) -> np.ndarray:
    """Effective number of letter trigrams of each text: (sum of counts)^2 / sum of squared counts.

    A text that repeats few trigrams has few, however long it is.
    """
    owner, number, grams = _trigrams(texts)
    total = np.bincount(owner, minlength=len(texts)).astype(float)
    key, count = np.unique(owner * (len(grams) + 1) + number, return_counts=True)
    squares = np.bincount(key // (len(grams) + 1), weights=count.astype(float) ** 2, minlength=len(texts))
    return total ** 2 / np.maximum(squares, 1)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language from every row with a text and a language."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def bundle(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, groups = np.unique(np.array(batch.column(1).to_pylist(), object), return_inverse=True)
        sums = bundles(batch.column(0).to_pylist(), groups, len(langs)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(langs.tolist(), pa.string()), pa.array(sums.tolist(), pa.list_(pa.int64()))],
                                          names=["lang", "sums"])

    parts = map_slices(rows, "text", bundle, "lang string, sums array<long>")
    total = (parts.select("lang", F.posexplode("sums").alias("place", "v"))
             .groupBy("lang", "place").agg(F.sum("v").alias("v")))
    found: dict[str, np.ndarray] = {}
    for r in total.collect():  # languages x DIM rows
        found.setdefault(r["lang"], np.zeros(DIM))[r["place"]] = r["v"]
    return {k: v for k, v in found.items() if np.any(v)}


def predict(texts: list[str | None], prototypes: dict[str, np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 to 1) of each text; ties go to the smaller language name."""
    names = sorted(prototypes)
    vectors = bundles([t or "" for t in texts])
    norm = np.linalg.norm(vectors, axis=1)
    has = norm > 0
    # a bundle may cancel out to the zero vector although the text has letters
    letters = np.fromiter((bool(t) and any(map(str.isalpha, t)) for t in texts), bool, len(texts)) if not has.all() else has
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    protos = np.stack([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names])
    cos = vectors @ protos.T / np.where(has, norm, 1)[:, None]
    best = cos.argmax(axis=1)
    score = np.where(letters, np.clip(cos[np.arange(len(best)), best], 0, 1), 0.0)
    return [names[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], score


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row.

    A null text or one without a letter is ``und`` with score 0; without any
    prototype every text is ``und``. Repeated rows give repeated results, a
    null id stays null, other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = predict(batch.column(1).to_pylist(), prototypes)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                          names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(narrow, "text", run, "doc_id long, lang_pred string, score double", max_bytes=SLICE)


def keep_known(docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without those of no known language.

    Those are the ``und`` texts, and the texts scored below ``min_score``
    that have at least ``MIN_TRIGRAMS`` effective trigrams: the score of a
    shorter text says nothing against it.
    """
    def known(texts: pa.Array) -> pa.Array:
        texts = texts.to_pylist()
        lang, score = predict(texts, prototypes)
        ok = np.array([k != UNKNOWN for k in lang], bool)
        low = np.flatnonzero(ok & (score < min_score))
        ok[low] = evidence([texts[i] for i in low]) < MIN_TRIGRAMS
        return pa.array(ok, pa.bool_())

    @F.arrow_udf("boolean")
    def is_known(texts: pa.Array) -> pa.Array:
        return by_slices(texts, known, pa.bool_(), SLICE)

    small_batches(docs.sparkSession)
    return docs.where(is_known(docs[text_col]))
