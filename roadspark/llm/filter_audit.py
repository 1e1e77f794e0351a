"""Filter interaction audit on a table-driven byte transducer.

One pass of a finite-state transducer over the UTF-8 bytes of a text counts
words, capitals, code points and symbols, and puts every word's span into a
hash table that compares bytes before it calls two spans equal. The counts
decide four filters, the whole text's SHA-256 decides the fifth (a smaller id
has the same text). Texts are then counted by the set of filters they fail, and
all orders of the filters are read off those 32 sets.

Null and empty texts have no words (they fail A, and E after the first of them),
null languages are the part "", repeated rows of one id count each and do not
make each other repeats, rows with null ids count but repeat nothing and are
repeated by nobody, an empty table gives an empty result, and other columns are
ignored. Of several labels of one id any 1 counts. A text is passed in blocks
of ``BLOCK`` bytes, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
BLOCK = 1 << 20
_START, _CAPITAL, _SYMBOL, _POINT = 1, 2, 4, 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = ["n_words", "n_distinct", "n_capitals", "n_symbols", "n_points"]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state by byte (0 between words, 1 inside one) and output by (state, byte)."""
    byte = np.arange(256)
    inside = (~np.isin(byte, [9, 10, 11, 12, 13, 32])).astype(np.uint8)
    out = np.zeros(256, np.uint8)
    out[(byte >= 65) & (byte <= 90)] |= _CAPITAL
    out[np.isin(byte, list(b"#$%&*|"))] |= _SYMBOL
    out[(byte & 0xC0) != 0x80] |= _POINT
    return inside, np.concatenate([out | _START * inside, out])


_NEXT, _OUT = _tables()


class SpanTable:
    """Open-addressing table of byte spans, filled many spans at a time."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.used = raw, 0
        self._empty(1024)

    def _empty(self, size: int) -> None:
        self.mask = size - 1
        self.hash = np.zeros(size, np.uint64)
        self.start = np.full(size, -1, np.int64)
        self.length = np.zeros(size, np.int64)
        self.text = np.zeros(size, np.int64)

    def insert(self, text: np.ndarray, start: np.ndarray, length: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Put spans of numbered texts in; returns the positions of those not seen before."""
        if 2 * (self.used + len(start)) > self.mask + 1:
            full = self.start >= 0
            known = self.text[full], self.start[full], self.length[full], self.hash[full]
            self._empty(1 << int(2 * (self.used + len(start))).bit_length())
            self._place(*known)
        new = self._place(text, start, length, hashed)
        self.used += len(new)
        return new

    def _place(self, text, start, length, hashed) -> np.ndarray:
        slot = ((hashed ^ (hashed >> np.uint64(29)) ^ text.astype(np.uint64) * _BASE) & np.uint64(self.mask)).astype(np.int64)
        left, new = np.arange(len(start)), []
        while len(left):
            at = slot[left]
            claims = left[self.start[at] < 0]
            place = slot[claims]
            self.start[place] = start[claims]  # of several claims to one slot the last stays
            won = claims[self.start[place] == start[claims]]
            place = slot[won]
            self.text[place], self.length[place], self.hash[place] = text[won], length[won], hashed[won]
            new.append(won)
            same = (
                (self.hash[at] == hashed[left]) & (self.length[at] == length[left]) & (self.text[at] == text[left])
            )
            check = np.flatnonzero(same & (self.start[at] != start[left]))
            same[check] = self._equal(self.start[at[check]], start[left[check]], length[left[check]])
            left = left[~same]
            slot[left] = (slot[left] + 1) & self.mask
        return np.concatenate(new) if new else np.zeros(0, np.int64)

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans at ``a`` and ``b`` hold the same bytes."""
        equal = np.ones(len(a), bool)
        first = np.cumsum(length) - length
        step = np.arange(int(length.sum())) - np.repeat(first, length)
        differ = self.raw[np.repeat(a, length) + step] != self.raw[np.repeat(b, length) + step]
        equal[np.repeat(np.arange(len(a)), length)[differ]] = False
        return equal


def _hashes(raw: np.ndarray, start: np.ndarray, length: np.ndarray, first: int) -> np.ndarray:
    """Polynomial hash of every span of ``raw``; it only steers the table, which compares bytes."""
    power = np.full(len(raw) + 1, _BASE, np.uint64)
    power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.cumprod(power)[:-1] * (raw.astype(np.uint64) + np.uint64(1)))])
    inverse = np.full(len(raw) + 1, pow(int(_BASE), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return (sums[start - first + length] - sums[start - first]) * np.cumprod(inverse)[start - first]


def count(raw: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """``_COUNTS`` of every text; text ``i`` is ``raw[offsets[i]:offsets[i + 1]]``."""
    texts = len(offsets) - 1
    found = np.zeros((len(_COUNTS), texts), np.int64)
    table, at, end = None, int(offsets[0]), int(offsets[-1])
    while at < end:
        owner = int(np.searchsorted(offsets, at, "right")) - 1
        stop = _cut(raw, offsets, at, block)
        if table is None or at == offsets[owner]:
            table = SpanTable(raw)
        last = int(np.searchsorted(offsets, stop, "left"))
        part, edges = raw[at:stop], np.clip(offsets[owner : last + 1], at, stop) - at
        inside = _NEXT[part]
        state = np.concatenate([np.zeros(1, np.uint8), inside[:-1]])
        firsts = edges[:-1][edges[:-1] < len(part)]
        state[firsts] = 0
        out = _OUT[state.astype(np.int64) * 256 + part]
        for row, bit in ((0, _START), (2, _CAPITAL), (3, _SYMBOL), (4, _POINT)):
            sums = np.concatenate([np.zeros(1, np.int64), np.cumsum((out & bit) != 0)])
            found[row, owner:last] += sums[edges[1:]] - sums[edges[:-1]]
        start = np.flatnonzero(out & _START)
        after = np.concatenate([inside[1:], np.zeros(1, np.uint8)])
        after[firsts[firsts > 0] - 1] = 0
        length = np.flatnonzero((inside == 1) & (after == 0)) + 1 - start
        text = owner + np.searchsorted(edges, start, "right") - 1
        new = table.insert(text, at + start, length, _hashes(part, at + start, length, at))
        found[1] += np.bincount(text[new], minlength=texts)
        at = stop
    return found


def _cut(raw: np.ndarray, offsets: np.ndarray, at: int, block: int) -> int:
    """Where the block from ``at`` ends: before a text, or between two words of a long one."""
    stop = at + block
    if stop >= offsets[-1]:
        return int(offsets[-1])
    whole = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
    if whole > at:
        return whole
    limit = int(offsets[np.searchsorted(offsets, at, "right")])
    while stop < limit:
        gaps = np.flatnonzero(_NEXT[raw[stop : min(stop + block, limit)]] == 0)
        if len(gaps):
            return stop + int(gaps[0])
        stop += block
    return limit


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(texts.buffers()[1] or bytes(8), width)[texts.offset :][: len(texts) + 1].astype(np.int64)
        counts = count(raw, offsets)
        kept = [batch.column(c) for c in ("doc_id", "part", "key")]
        yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, counts)], names=["doc_id", "part", "key", *_COUNTS])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, the text's key and the transducer's counts, one row per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("key"), text.alias("text"),
    ).mapInArrow(_measured, "doc_id long, part string, key string, " + ", ".join(f"{c} long" for c in _COUNTS))


def _own_failures() -> Column:
    """Bits of A to D, which a text fails by itself."""
    failing = [
        F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("n_capitals") > 3 * F.col("n_points"), F.col("n_symbols") > 0,
    ]
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(failing)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).alias("failed")


def tallied(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part, set of failed filters (bits of ``FILTERS``) and labels.

    Equal texts meet by their key, already summed; no task sees the copies one by one.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = measured(docs).select("doc_id", "part", "key", _own_failures()).join(marks, "doc_id", "left")
    kind = ["key", "part", "failed", "good", "toxic"]
    each = rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}).groupBy(
        *kind, "doc_id"
    ).agg(F.count("*").alias("n"))
    named = F.col("doc_id").isNotNull()
    groups = each.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("nameless"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    own = F.col("nameless") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    sides = groups.withColumn("own", own).select(
        *kind[1:],
        F.explode(F.array(
            F.struct(F.lit(0).alias("again"), F.col("own").alias("n")),
            F.struct(F.lit(16).alias("again"), (F.col("n") - F.col("own")).alias("n")),
        )).alias("side"),
    )
    return sides.groupBy(
        "part", (F.col("failed") + F.col("side.again")).alias("failed"), "good", "toxic"
    ).agg(F.sum("side.n").alias("n"))


def _order_table(spark: SparkSession) -> DataFrame:
    """What each step of each order does to each of the 32 sets of failed filters: 19,200 rows."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            for failed in range(32):
                here, earlier = bool(failed & bit), bool(failed & before)
                rows.append((
                    failed, order, step, letter, not (here or earlier), here and not earlier, here and earlier, failed == bit,
                ))
            before |= bit
    return spark.createDataFrame(
        rows, "failed int, filter_order string, step int, filter string, stays boolean, goes boolean, again boolean, alone boolean"
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    steps = F.broadcast(_order_table(docs.sparkSession))  # 19,200 rows, whatever the input
    n = F.col("n")
    taken = tallied(docs, labels).join(steps, "failed")

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).alias(name)

    goes = F.col("goes")
    table = taken.groupBy("part", "filter_order", "step", "filter").agg(
        total(F.col("stays"), "kept"), total(goes, "removed"), total(F.col("again"), "redundant"),
        total(F.col("alone"), "unique_fails"), total(goes & F.col("good"), "good_lost"),
        total(goes & F.col("toxic"), "toxic_lost"),
    )
    return table.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    return audit(docs, labels).drop("filter")


OP12_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
counted AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM texts),
marks AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INTEGER)) AS good,
    max(CAST(coalesce(toxic = 1, false) AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
failing AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INTEGER)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) + 16 * CAST(e AS INTEGER) AS failed
    FROM counted LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, failed, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, l.x AS filter, l.bit,
    coalesce((SELECT sum(k.bit) FROM letters k WHERE contains(left(filter_order, step - 1), k.x)), 0)::INTEGER AS before
    FROM orders, range(1, 6) AS s(step), letters l WHERE l.x = substr(filter_order, step, 1)),
done AS (SELECT part, filter_order, step, filter,
    sum(n) FILTER (failed & (bit | before) = 0) AS kept,
    sum(n) FILTER (failed & bit > 0 AND failed & before = 0) AS removed,
    sum(n) FILTER (failed & bit > 0 AND failed & before > 0) AS redundant,
    sum(n) FILTER (failed = bit) AS unique_fails,
    sum(n) FILTER (failed & bit > 0 AND failed & before = 0 AND good = 1) AS good_lost,
    sum(n) FILTER (failed & bit > 0 AND failed & before = 0 AND toxic = 1) AS toxic_lost
    FROM sets, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
    coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
    coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM done
"""
