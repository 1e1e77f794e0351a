"""Spelling variant grouping by finite-state composition.

The vocabulary acceptor is composed with a one-edit transducer and with itself
again; what the composition accepts are the pairs of words one inserted,
deleted or replaced code point apart. The composition is cut by the state it
starts from: two near words agree on all code points before the edit and on all
behind it, so each word is posted for both halves of itself, and the words that
agree on one half (the state after that half, read forwards or backwards) are
one partition. There the other halves are compiled into a minimal acceptor and
composed. A partition with over ``PARTITION`` words is posted again by halves of
its free part, until one code point is free, which leaves at most the square of
the alphabet. Every pair arises in one partition only.

Null and empty texts have no words, repeated rows count again, runs of rows with
null ids stay as they are written, an empty table gives an empty result, and
columns other than ``doc_id`` and ``text`` are ignored. A long text is read whole by one task, which
keeps its distinct runs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.runtime import written

SHORTEST, LEAST, RATIO, SLIP = 6, 5, 5, 199
PARTITION = 4096
_RUN = re.compile("[a-zÀ-ÿ]+")
_KEY = ["size", "lo", "hi", "head", "tail"]


def document_words(doc_id: int | None, text: str | None, shortest: int = SHORTEST, slip: int = SLIP) -> Counter:
    """Occurrences of the words of one text, a run in ``slip`` losing a code point."""
    runs = Counter(_RUN.findall((text or "").encode().lower().decode()))
    found: Counter = Counter()
    for run, n in runs.items():
        if len(run) < shortest:
            continue
        if doc_id is not None:
            mark = zlib.crc32(f"{doc_id}:{run}".encode())
            if mark % slip == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
        if len(run) >= shortest:
            found[run] += n
    return found


def _counted(batches: Iterator[pa.RecordBatch], shortest: int, slip: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found.update(document_words(doc_id, text.as_py(), shortest, slip))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"]
        )


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, slip: int = SLIP) -> DataFrame:
    """``word`` and occurrences ``n`` of all words with ``least`` occurrences or more."""
    pairs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: _counted(batches, shortest, slip), "word string, n long"
    )
    return pairs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- acceptor and composition


class Acceptor:
    """Minimal acyclic acceptor of a set of words, built from the sorted words.

    ``arcs[q]`` maps letters to states, ``final`` holds the accepting states, and
    states with equal right languages are one.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: set[int] = set()
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        path: list[dict[str, int]] = [{}]  # states along the last word, not yet settled
        ends = [False]
        last = ""
        for word in sorted(set(words)):
            shared = 0
            while shared < len(last) and last[shared] == word[shared]:
                shared += 1
            self._settle(path, ends, last, shared)
            for _ in word[shared:]:
                path.append({})
                ends.append(False)
            ends[-1] = True
            last = word
        self._settle(path, ends, last, 0)
        self.start = self._state(path[0], ends[0])

    def _settle(self, path: list, ends: list, word: str, depth: int) -> None:
        while len(path) > depth + 1:
            state = self._state(path.pop(), ends.pop())
            path[-1][word[len(path) - 1]] = state

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            if final:
                self.final.add(state)
        return state

    def common(self, p: int, q: int) -> list[str]:
        """Words accepted from both states: the composition after its edit is spent."""
        key = (p, q) if p <= q else (q, p)
        found = self._common.get(key)
        if found is None:
            a, b = self.arcs[key[0]], self.arcs[key[1]]
            found = [""] if key[0] in self.final and key[1] in self.final else []
            for letter, state in a.items():
                other = b.get(letter)
                if other is not None:
                    found += [letter + rest for rest in self.common(state, other)]
            self._common[key] = found
        return found

    def one_edit_pairs(self, size: int) -> Iterator[tuple[str, str, int | None]]:
        """Pairs of accepted words of ``size`` letters that differ in one, and pairs with a word one
        letter longer; ``at`` is the leftmost place of the inserted letter, None for a replacement.
        """
        stack = [(self.start, "")]
        while stack:
            state, read = stack.pop()
            arcs = self.arcs[state]
            here = list(arcs.items())
            for i, (letter, to) in enumerate(here):
                stack.append((to, read + letter))
                for other, beside in here[i + 1 :]:
                    for rest in self.common(to, beside):
                        if len(read) + 1 + len(rest) == size:
                            yield read + letter + rest, read + other + rest, None
                if not read or read[-1] != letter:  # else the letter was inserted further left
                    for rest in self.common(state, to):
                        if len(read) + len(rest) == size:
                            yield read + rest, read + letter + rest, len(read)


def _partition_pairs(size: int, lo: int, hi: int, head: str, tail: str, middles: list[str]) -> Iterator[tuple[str, str]]:
    """Near words of one partition, each pair once over all partitions.

    An insertion before the free part, or behind it while more of the word
    follows, belongs to the neighbouring partition.
    """
    for short, other, at in Acceptor(middles).one_edit_pairs(hi - lo):
        if at is not None:
            if (at == 0 and head and head[-1] == other[0]) or (at == hi - lo and hi < size):
                continue
        yield head + short + tail, head + other + tail


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, m, n = [], [], [], []
        for row in batch.to_pylist():
            counts = {w["middle"]: w["n"] for w in row["words"]}
            head, tail = row["head"], row["tail"]
            cut = slice(len(head), -len(tail) or None)
            for one, two in _partition_pairs(*(row[c] for c in _KEY), list(counts)):
                a.append(one)
                b.append(two)
                m.append(counts[one[cut]])
                n.append(counts[two[cut]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(m, pa.int64()), pa.array(n, pa.int64())],
            names=["a", "b", "m", "n"],
        )


def _posted(words: DataFrame, windows: Column) -> DataFrame:
    """Every word under each of its windows: what stands before and behind the free part is the key.

    A window is counted in the ``size`` code points of the shorter word of a pair.
    """
    length = F.char_length("word")
    posted = words.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*")
    behind = F.col("size") - F.col("hi")
    return posted.select(
        "size", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")).alias("head"),
        F.substring("word", length - behind + 1, behind).alias("tail"),
        F.substring("word", F.col("lo") + 1, length - behind - F.col("lo")).alias("middle"), "word", "n",
    )


def _window(size: Column, lo: Column, hi: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def near_pairs(words: DataFrame, shortest: int = SHORTEST, partition: int = PARTITION) -> DataFrame:
    """All unordered pairs ``(a, b)`` of near words with their occurrences ``m`` and ``n``, each once."""
    length, zero = F.char_length("word"), F.lit(0)

    def halves(size: Column) -> list[Column]:
        middle = F.floor(size / 2)
        return [_window(size, zero, middle), _window(size, middle, size)]

    own = F.array(*halves(length))
    posted = _posted(words, F.when(length > shortest, F.concat(own, F.array(*halves(length - 1)))).otherwise(own))
    found = None
    while True:
        posted = written(posted, "postings")
        sizes = posted.groupBy(*_KEY).agg(F.count("*").alias("_words"))
        large = (F.col("_words") > partition) & (F.col("hi") - F.col("lo") > 1)
        hot = written(sizes.where(large).select(*_KEY), "large-partitions")
        more = not hot.isEmpty()
        rest = posted.join(hot, _KEY, "left_anti") if more else posted
        lists = rest.groupBy(*_KEY).agg(F.collect_list(F.struct("middle", "n")).alias("words"))
        pairs = lists.where(F.size("words") > 1).mapInArrow(_composed, "a string, b string, m long, n long")
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        size, lo, hi = F.col("size"), F.col("lo"), F.col("hi")
        middle = F.floor((lo + hi) / 2)
        again = posted.join(hot, _KEY, "left_semi").withColumn(
            "_w", F.array(_window(size, lo, middle), _window(size, middle, hi))
        )
        posted = _posted(again.select("word", "n", "_w"), F.col("_w"))


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word."""
    def seen(word: str, near: str, n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(n).alias("n"))

    both = pairs.select(F.explode(F.array(seen("a", "b", "n"), seen("b", "a", "m"))).alias("s")).select("s.*")
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    chosen = -F.col("best.n") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.n")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """Add ``root``, the end of the chain of forms.

    Occurrences grow at every link, so chains end; each round doubles the links
    that a word has followed. Only words that have a form take part.
    """
    links = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ahead = links.join(onward, "root", "left")
        links = written(ahead.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if links.where("_moved").isEmpty():
            break
        links = links.drop("_moved")
    return formed.join(links.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, partition: int = PARTITION) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus."""
    words = written(vocabulary(docs), "vocabulary")
    formed = written(forms(words, near_pairs(words, partition=partition)), "formed")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_CRC = (
    "list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)"
)
OP13_SQL = rf"""
WITH RECURSIVE tbl AS MATERIALIZED (SELECT list({_CRC} ORDER BY i) AS v FROM range(0, 256) AS r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT *, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END)) AS b FROM counted),
hashed AS (SELECT run, c, xor(list_reduce(b, lambda acc, x: xor(v[(xor(acc, x) & 255) + 1], acc >> 8), 4294967295::BIGINT),
    4294967295) AS h FROM bytes, tbl),
slipped AS (SELECT c, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT)
    || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
gaps AS (SELECT word, n, unnest(list_distinct(list_transform(range(1, length(word) + 1),
    lambda i: left(word, i - 1) || substr(word, i + 1)))) AS short FROM words),
holes AS (SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT w.word, g.word AS other, g.n AS m FROM words w JOIN gaps g ON g.short = w.word
    UNION ALL SELECT g.word, w.word, w.n FROM words w JOIN gaps g ON g.short = w.word
    UNION ALL SELECT a.word, b.word, b.n FROM holes a JOIN holes b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail
      WHERE a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -m, 'o': other}}) AS b FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.n >= 5 * n THEN b.o END AS form,
    CASE WHEN -b.n >= 5 * n THEN -b.n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS depth FROM words
    UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(root, depth) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM formed f JOIN chain c ON c.word = f.word GROUP BY ALL
"""
