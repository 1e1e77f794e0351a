"""BPE encoding and decoding by a tokenization automaton.

States of the automaton are the tokens, its arcs are labelled with tokens, and a
word's tokenization by the merges is the only path that spells it. The automaton
is built from the alphabet's complete one by one gadget per merge, in order. The
gadget of ``a b -> c`` takes the arc ``b`` off the state ``a``, gives the new
state ``c`` the arcs that leave ``b`` at that time, and lets ``c`` be reached
from every state that reaches ``a`` (not from ``a`` itself when ``a`` and ``b``
are the same, since runs merge from the left). Arcs are not copied: a state
keeps its origin and the number of the gadget that made it, and a transition is
looked up through them once and then kept in a table.

Every prefix of a word has one path too, so reading a word symbol by symbol
keeps one state per position: of the tokens that end there, the one whose arc
leaves the state at its start.

Null and empty texts have no tokens and decode to the empty text. Repeated rows
give equal rows, an empty table an empty one, and columns other than ``doc_id``
and ``text`` are ignored. A very long text is held by one worker.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.llm.bpe_cache import byte_letters

# Pieces remembered by one worker before its memory is emptied.
REMEMBERED = 1_000_000
# The split of the word vocabulary, a fixed value of it.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Separators that str.split() knows but the vocabulary's white space does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
# A stop or comma that closes a word: a word of its own, so it may stand apart.
_CLOSING = re.compile(r"[.,](?<=[a-zß-öø-ÿ][.,])(?=[ \n])")
_SPACE = regex.compile(r"\p{White_Space}+")
_END = "</w>"


class TokenAutomaton:
    """The automaton of one list of merges, over the tokens' ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocab.values(), default=-1) + 1
        self.ids = vocab
        self.labels = {i: t for t, i in vocab.items()}
        # Origins of a state: arcs into it are those into ``left``, arcs out those of ``right``.
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.gadget = np.full(size, -1, np.int64)
        self.cut: dict[tuple[int, int], int] = {}
        for number, (a, b) in enumerate(merges):
            self._add_gadget(number, vocab[a], vocab[b], vocab[a + b])
        self.left, self.right, self.gadget = self.left.tolist(), self.right.tolist(), self.gadget.tolist()
        self.table: dict[int, bool] = {}
        self.ending = {t[: -len(_END)]: i for t, i in vocab.items() if t.endswith(_END)}
        self.longest = max((len(t.removesuffix(_END)) for t in vocab), default=1)

    def _add_gadget(self, number: int, a: int, b: int, c: int) -> None:
        self.cut[(a, b)] = number
        if self.gadget[c] < 0:
            self.left[c], self.right[c], self.gadget[c] = a, b, number

    def arc(self, state: int, label: int) -> bool:
        """Whether the finished automaton has an arc ``label`` that leaves ``state``."""
        key = state << 32 | label
        found = self.table.get(key)
        if found is None:
            found = self.table[key] = self._arc(state, label)
        return found

    def _arc(self, state: int, label: int) -> bool:
        left, right, gadget, cut = self.left, self.right, self.gadget, self.cut
        before = len(cut)  # arcs as they are before this gadget
        while True:
            if cut.get((state, label), before) < before:
                return False
            s, t = gadget[state], gadget[label]
            if s < 0 and t < 0:
                return True
            if s > t:
                before, state = s, right[state]
            elif t > s:
                if left[label] == right[label] == state:
                    return False
                before, label = t, left[label]
            else:
                before, state, label = s, right[state], left[label]

    def encode(self, letters: str) -> list[int]:
        """Labels of the path that spells a word, whose last letter is marked as its end."""
        n = len(letters)
        state, step = [0] * (n + 1), [0] * (n + 1)
        longest, known, ids = self.longest, self.table, self.ids
        for end in range(1, n + 1):
            if end == n:
                ids = self.ending
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                token = ids.get(letters[start:end])
                if token is not None:
                    if start:
                        key = state[start] << 32 | token
                        if (known[key] if key in known else self.arc(state[start], token)) is False:
                            continue
                    state[end], step[end] = token, end - start
                    break
        path, at = [], n
        while at:
            path.append(state[at])
            at -= step[at]
        return path[::-1]


class WordBpe:
    """Texts to ids and back with the word vocabulary at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges)
        self._letter = {b: c for c, b in byte_letters().items()}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = {text: (str(i), text) for text, i in special.items()}
        self._between = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        # Joined ids and joined labels of the pieces seen; plain strings, which cost the collector nothing.
        self._ids: dict[str, str] = {}
        self._labels: dict[str, str] = {}

    def _word(self, word: str) -> list[int]:
        return self.automaton.encode("".join([self._letter[b] for b in word.encode("utf-8")]))

    def _learn(self, piece: str) -> None:
        """Remember the ids and labels of a text without white space."""
        if piece.isascii() and piece.isalpha():
            ids = self.automaton.encode(piece)
        else:
            ids = [i for word in _WORDS.findall(piece) for i in self._word(word)]
        labels = self.automaton.labels
        self._ids[piece] = " ".join([str(i) for i in ids])
        self._labels[piece] = " ".join([labels[i] for i in ids])

    def _part(self, text: str) -> tuple[str, str]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        text = _CLOSING.sub(r" \g<0>", text)
        pieces = [p for p in _SPACE.split(text) if p] if _NOT_SPACE.search(text) else text.split()
        if len(self._ids) > REMEMBERED:
            self._ids.clear()
            self._labels.clear()
            self.automaton.table.clear()
        for piece in set(pieces).difference(self._ids):
            self._learn(piece)
        return " ".join(map(self._ids.__getitem__, pieces)), " ".join(map(self._labels.__getitem__, pieces))

    def __call__(self, text: str) -> tuple[str, str, int]:
        """Decimal ids joined by spaces, the decoded text, and the number of ids."""
        if any(s in text for s in self._special):
            parts = [
                self._special[part] if k % 2 else self._part(part)
                for k, part in enumerate(self._between.split(text))
            ]
            ids, decoded = (" ".join(p[i] for p in parts if p[0]) for i in (0, 1))
        else:
            ids, decoded = self._part(text)
        return ids, decoded, ids.count(" ") + 1 if ids else 0


def _encoded(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    bpe = WordBpe(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            docs, counts, ids, decoded = some.column(0), [], [], []
            for text in some.column(1).to_pylist():
                a, b, n = bpe(text or "")
                counts.append(n)
                if digests:
                    ids.append(hashlib.sha256(a.encode()).hexdigest())
                    decoded.append(hashlib.sha256(b.encode("utf-8")).hexdigest())
                else:
                    ids.append(np.array(a.split(), dtype=np.int32))
                    decoded.append(b)
            kind = pa.string() if digests else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(counts, pa.int64()), pa.array(ids, kind), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )


def tokenize(docs: DataFrame, vocabulary: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text; with ``digests`` their SHA-256 instead.

    ``vocabulary`` is the path of the word vocabulary file on every machine. The
    automaton is compiled once per worker. Rows do not move.
    """
    kind = "string" if digests else "array<int>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _encoded(batches, vocabulary, digests),
        f"doc_id long, n_tokens long, ids {kind}, decoded string",
    )


def op7_tokenization_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)
    return out.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
