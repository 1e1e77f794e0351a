"""Quality rules by distribution divergence.

Two histograms of a text, of character classes and of common words, are compared
by Jensen-Shannon distance with the references of the languages. A reference
holds what the texts of a language add up to, every text with equal weight, so
it covers all rows and no long text rules it; shares are summed as integers and
come out the same in any order. A text counts as written in the language it is
nearest to, and passes if it lies near it in both histograms. What sampling
alone puts between a text of n parts and its own distribution is allowed on top,
so short texts are not rejected for being short.

Guards of length: texts under ``LEAST_WORDS`` words fail by the base rule and shape no
reference; under ``WORD_GUARD`` words only character classes are judged. A
language with less than a thousandth of the judged texts has no reference (so
there are at most a thousand); without any reference the base rule decides alone.

Null and empty texts have no words and fail the base rule, texts with a null
language shape no reference, repeated rows count again, an empty table gives an empty
result, and columns other than ``doc_id``, ``text`` and ``lang`` are ignored. A long
text is read whole by one task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspark.runtime import written

LEAST_WORDS, WORD_GUARD = 50, 60
COMMON = 64  # common words of a language's histogram
SHARE = 1_000_000  # a text's weight, as an integer
CLASS_LIMIT, WORD_LIMIT = 0.2, 0.11
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
TRIM = b".,;:!?\"'()"
CLASSES = ["lower", "upper", "digit", "blank", "line", "stop", "sign", "latin", "other"]


def _class_table() -> np.ndarray:
    """Class of a code point by its first UTF-8 byte; bytes that continue one get the class behind the last."""
    table = np.full(256, CLASSES.index("sign"), np.uint8)
    for name, members in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t\v\f\r"),
        ("line", b"\n"), ("stop", b".,;:?'\"()-"), ("latin", [0xC3]), ("other", [*range(0xC0, 0xC3), *range(0xC4, 256)]),
    ):
        table[list(members)] = CLASSES.index(name)
    table[0x80:0xC0] = len(CLASSES)
    return table


_CLASS = _class_table()


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)), _repeated_words(words),
    )


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that are found twice or more."""
    if len(words) < 4:
        return 0
    number = {word: i for i, word in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(again) + shift] |= again
    return int(covered.sum())


def class_counts(raw: bytes) -> np.ndarray:
    """Code points of every class."""
    return np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


class PlainForms(dict):
    """Words in lower case without punctuation around them, each worked out once."""

    def __missing__(self, word: bytes) -> bytes:
        self[word] = plain = word.lower().strip(TRIM)
        return plain


def word_counts(words: list[bytes], plain: PlainForms) -> Counter:
    """Occurrences of the plain forms of ``words``."""
    return Counter(map(plain.__getitem__, words))


# ---- references


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed shares of classes (``kind`` 0) and words (1) by language, with the texts that hold them."""
    for batch in batches:
        shares, texts, plain = defaultdict(Counter), defaultdict(Counter), PlainForms()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (text.as_py() or "").encode()
            words = raw.split()
            if len(words) < LEAST_WORDS:
                continue
            classes = dict(zip(CLASSES, class_counts(raw).tolist()))
            counts = word_counts(words, plain)
            for key, found, total in (((lang, 0), classes, sum(classes.values())), ((lang, 1), counts, len(words))):
                sums = shares[key]
                for name, n in found.items():
                    sums[name] += SHARE * n // total
                texts[key].update(found.keys())
        rows = [
            (lang, kind, name.decode() if kind else name, share, texts[lang, kind][name])
            for (lang, kind), sums in shares.items() for name, share in sums.items()
        ]
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "kind", "name", "share", "texts"]
        )


@dataclass
class Reference:
    """A language's histograms; the last entry of ``words`` is what is not common."""

    lang: str
    classes: np.ndarray
    common: list[bytes]
    words: np.ndarray


def references(docs: DataFrame, common: int = COMMON) -> list[Reference]:
    """The references of all languages with a thousandth of the judged texts or more.

    The driver gets ``common`` words and the classes of each, a thousand languages at most.
    """
    summed = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(
        _shares, "lang string, kind int, name string, share long, texts long"
    )
    table = written(summed.groupBy("lang", "kind", "name").agg(F.sum("share").alias("share"), F.sum("texts").alias("texts")), "shares")
    sizes = table.where("kind = 0 AND name = 'blank'")
    judged = sizes.agg(F.sum("texts")).first()[0] or 0
    chosen = sizes.where(F.col("texts") * 1000 >= judged).select("lang", F.col("texts").alias("of"))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("texts"), F.desc("share"), "name")
    top = table.withColumn("place", F.row_number().over(order)).where(F.col("place") <= common).join(chosen, "lang")
    found: dict[str, list] = {}
    for row in top.orderBy("lang", "kind", "place").collect():
        found.setdefault(row["lang"], []).append(row)
    result = []
    for lang, rows in found.items():
        classes = {r["name"]: r["share"] for r in rows if r["kind"] == 0}
        words = [r for r in rows if r["kind"] == 1]
        shares = [r["share"] for r in words]
        shares.append(max(SHARE * rows[0]["of"] - sum(shares), 0))
        result.append(Reference(
            lang, _normal([classes.get(c, 0) for c in CLASSES]),
            [r["name"].encode() for r in words], _normal(shares),
        ))
    return result


def _normal(counts) -> np.ndarray:
    counts = np.asarray(counts, np.float64)
    return counts / max(counts.sum(), 1.0)


# ---- judgement


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two distributions, 0 to 1."""
    def entropy(x):
        x = x[x > 0]
        return -float(np.sum(x * np.log2(x)))

    return float(np.sqrt(max(entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2, 0.0)))


def allowance(bins: int, n: int) -> float:
    """Distance that sampling ``n`` parts from ``bins`` puts between a text and its own distribution."""
    return float(np.sqrt((bins - 1) / (8 * np.log(2) * max(n, 1))))


class CommonWords(dict):
    """The number of each word among the common words of all languages; the last number stands for the rest."""

    def __init__(self, known: list[Reference]):
        super().__init__()
        self.plain = {w: i for i, w in enumerate(sorted({w for r in known for w in r.common}))}
        self.places = [np.array([self.plain[w] for w in r.common], np.int64) for r in known]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.plain.get(word.lower().strip(TRIM), len(self.plain))
        return number

    def histograms(self, words: list[bytes]) -> list[np.ndarray]:
        """Counts of the words of every reference, what is not common last."""
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        counts = np.bincount(numbers, minlength=len(self.plain) + 1)
        own = [counts[places] for places in self.places]
        return [np.append(found, len(words) - found.sum()) for found in own]


def judge(
    raw: bytes, words: list[bytes], known: list[Reference], common: CommonWords
) -> tuple[str | None, float | None, float | None]:
    """Nearest language and the distances of classes and words from it (words None under the guard)."""
    classes = _normal(class_counts(raw))
    best = None
    for reference, histogram in zip(known, common.histograms(words)):
        by_class = divergence(classes, reference.classes)
        by_word = divergence(_normal(histogram), reference.words)
        if best is None or by_class + by_word < best[1] + best[2]:
            best = reference.lang, by_class, by_word
    if best is None:
        return None, None, None
    return best[0], best[1], best[2] if len(words) >= WORD_GUARD else None


_RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, nearest_lang string, class_distance double, word_distance double"
)


def _judged(batches: Iterator[pa.RecordBatch], known: list[Reference], class_limit: float, word_limit: float):
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in _RESULT.split(", ")]
    for batch in batches:
        rows, common = [], CommonWords(known)
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            raw = text.encode()
            words = raw.split()
            chars, symbols, lines, repeats = base_counts(text, words)
            failed = len(words) < LEAST_WORDS or 100 * repeats > 50 * len(words)
            lang, by_class, by_word = (None, None, None) if failed else judge(raw, words, known, common)
            kept = not failed and (lang is None or (
                by_class <= class_limit + allowance(len(CLASSES), len(text))
                and (by_word is None or by_word <= word_limit + allowance(COMMON + 1, len(words)))
            ))
            rows.append((doc_id, len(words), chars, symbols, lines, repeats, failed, kept, lang, by_class, by_word))
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def judged(
    docs: DataFrame, known: list[Reference], class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT
) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs``; nothing is shuffled."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _judged(batches, known, class_limit, word_limit), _RESULT
    )


def op11_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs, references(docs))
