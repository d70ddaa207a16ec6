"""SentencePiece encoding and decoding (operator 1).

The encoder is a streaming Viterbi search. A path through the text is a
sequence of pieces; a step from piece ``a`` to piece ``b`` is allowed when
the model's merge rules leave the two apart, i.e. when the text of ``a + b``
on its own is merged into exactly these two. A sequence is what the model's
merges give if and only if each of its neighbouring pairs is allowed, so at
every position one last piece survives, with a pointer back to the piece
before it. Only the positions a piece can still reach (the longest piece's
length) keep their pointers; whenever all of them lead back to one boundary,
the ids up to it are final and leave the window. Memory does not grow with
the text.

No piece of the vocabulary has a space mark after another character, so all
paths converge before each space mark: the stretches between such points are
encoded on their own and remembered per process (bounded), since words
repeat. The result is that of the library for the same model (a test holds
it against it).

Characters that no piece has become byte pieces. Decoding joins pieces and
bytes; it gives back every text exactly (surrogates apart, which a string
column cannot hold).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from firelog.llm.common import list_array, map_slices
from firelog.llm.tokens import vocabulary_path

MARK = "▁"
# Remembered stretches (up to the window's length) and first pieces of remembered pairs, per worker
# process and generation: a full generation becomes the old one, and the old one is forgotten.
MAX_WORDS = 200_000
MAX_FOLLOW = 20_000


class Encoder:
    """Pieces of a model file, its merge order, and the streaming search."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * n
        for i, p in enumerate(self.pieces):
            if sp.is_control(i) or sp.is_unknown(i):
                continue
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.raw[i] = bytes([int(p[3:5], 16)])
            else:
                self.ids[p] = i
                self.rank[p] = -sp.get_score(i)
                self.raw[i] = p.replace(MARK, " ").encode("utf-8")
        self.longest = max(map(len, self.ids), default=1)
        self.trie: dict = {}
        for p, i in self.ids.items():
            node = self.trie
            for ch in p:
                node = node.setdefault(ch, {})
            node[""] = p
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        lone = self._lone_characters()
        stops = "".join(c for c in ".,;:!?" if not any(re.search(f"[a-zA-Zà-öø-ÿ][{c}]", p) for p in self.ids))
        rest = f"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (f"|[{lone}]" if lone else "")
        self.stretch = re.compile((f"{MARK}*[a-zA-Zà-öø-ÿ]+(?=[{stops}])|" if stops else "") + rest)
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.follow: dict[str, dict[str, bool]] = {}

    def _lone_characters(self) -> str:
        """Line breaks and tabs that no piece holds: a path has a boundary on both of their sides."""
        return "".join(ch for ch in "\n\t\r" if not any(ch in p for p in self.ids))

    def allowed(self, a: str, b: str) -> bool:
        """Whether the merges of ``a + b`` on its own end in these two pieces."""
        row = self.follow.get(a)
        if row is None:
            if len(self.follow) >= MAX_FOLLOW:
                self.follow.clear()
            row = self.follow[a] = {}
        got = row.get(b)
        if got is None:
            got = row[b] = self._merged(a, b)
        return got

    def _merged(self, a: str, b: str) -> bool:
        parts, cut, rank = list(a + b), len(a), self.rank
        edge = cut  # number of parts before the border
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                return parts == [a, b]
            if at == edge - 1:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            edge -= at < edge

    def stream(self, text: str):
        """Pieces of ``text``, yielded as soon as they are final."""
        trie, longest, allowed = self.trie, self.longest, self.allowed
        n = len(text)
        last: dict[int, str] = {0: ""}  # position -> last piece of the path that ends there
        done = 0  # boundary up to which pieces were yielded
        furthest = 0
        for i in range(n):
            prev = last.get(i)
            if prev is None:
                continue
            node, j = trie, i
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                piece = node.get("")
                if piece is not None and j not in last and (not prev or allowed(prev, piece)):
                    last[j] = piece
            if i + 1 not in last and text[i] not in trie:
                last[i + 1] = text[i]  # a character of its own, later bytes
            furthest = max(furthest, i)
            if i - done >= 2 * longest:
                # pointers of all positions that later pieces can start from
                ends = {p for p in range(i + 1, i + longest + 1) if p in last}
                while len(ends) > 1:
                    top = max(ends)
                    ends.remove(top)
                    ends.add(top - len(last[top]))
                border = ends.pop() if ends else done
                if border > done:
                    yield from self._back(last, done, border)
                    for p in [p for p in last if p < border]:
                        del last[p]
                    done = border
        if n:
            yield from self._back(last, done, n)

    def short(self, text: str) -> list[str]:
        """Pieces of a text within the window, all of them final at its end."""
        n = len(text)
        last: list[str | None] = [None] * (n + 1)
        trie, follow = self.trie, self.follow
        for i in range(n):
            prev = last[i] if i else ""
            if prev is None:
                continue
            row = follow.get(prev) if i else None
            node, j = trie, i
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                piece = node.get("")
                if piece is not None and last[j] is None:
                    ok = not i or (row.get(piece) if row is not None else None)
                    if ok is None:
                        ok = self.allowed(prev, piece)
                        row = follow[prev]
                    if ok:
                        last[j] = piece
            if last[i + 1] is None and text[i] not in trie:
                last[i + 1] = text[i]
        return self._back(last, 0, n)

    @staticmethod
    def _back(last, start: int, end: int) -> list[str]:
        out = []
        while end > start:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _word(self, text: str) -> bytes:
        ids: list[int] = []
        for p in self.short(text) if len(text) <= 2 * self.longest else self.stream(text):
            i = self.ids.get(p)
            if i is None:
                ids += [self.byte_ids[x] for x in p.encode("utf-8", "replace")]
            else:
                ids.append(i)
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; an empty text has none."""
        if not text:
            return np.zeros(0, np.int32)
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return np.frombuffer(self._word(marked), np.int32)
        stretches = self.stretch.findall(marked)
        out = list(map(self.words.get, stretches))
        for k, got in enumerate(out):
            if got is None:
                out[k] = self._remembered(stretches[k])
        return np.frombuffer(b"".join(out), np.int32)

    def _remembered(self, w: str) -> bytes:
        got = self.words.get(w) or self.old_words.get(w) or self._word(w)
        if len(w) <= 2 * self.longest:
            if len(self.words) >= MAX_WORDS:
                self.old_words, self.words = self.words, {}
            self.words[w] = got
        return got

    def decode(self, ids) -> str:
        """Text of the ids, without the space put before the first word."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(model: str) -> Encoder:
    path = vocabulary_path(model)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, n_ids, decoded_equal)``: ids of every whole text and whether decoding them gives it back.

    A null text is taken as empty (no ids); null ids and repeated rows stay;
    other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        got = [enc.encode(t) for t in texts]
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        same = [enc.decode(g.tolist()) == t for g, t in zip(got, texts, strict=True)]
        flat = np.concatenate(got) if got else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), list_array(flat, lengths, pa.int32()), pa.array(lengths), pa.array(same, pa.bool_())],
            names=["doc_id", "ids", "n_ids", "decoded_equal"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(narrow, "text", run, "doc_id long, ids array<int>, n_ids long, decoded_equal boolean")


def decode(rows: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)``: the text of every row's ids; a null list gives null, an empty one the empty text."""

    def run(batches):
        enc = encoder(model)
        for b in batches:
            texts = [None if x is None else enc.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(rows[id_col].cast("long").alias("doc_id"), rows[ids_col].cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string")
