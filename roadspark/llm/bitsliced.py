"""Exact top-k search with a bit-sliced index.

Rows are kept in blocks. For every component a block has one bitmap per binary
digit, taken from the component less the block's smallest value there, and a
second set from the largest value less the component, so that any weight of a
query meets digits of the right sign. A query's score is then a constant plus a
sum of shifted bitmaps, added for all rows of a block at once with full adders
on 64-bit words. The best rows are selected on the score's own slices from the
most significant downward; rows tied on the boundary are settled by id.

The blocks are met with blocks of queries, each pair in a task of its own, and
only ``k`` rows per query leave a pair. Vectors that are null, or hold null or
non-finite components, take no part; empty and shorter vectors count as zeros
where components are missing. Rows repeated with their id are searched and
answered once. Components beyond 2**24 are refused. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadspark.runtime import written

K = 20
SCALE = 64
EVERY = 20
BLOCK = 1 << 15
QUERIES = 1024
_LARGEST = 1 << 24


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the floor of every scaled component; vectors that take no part are left out."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    vector = F.col("embedding").cast("array<double>")
    valid = table.select(F.col("vec_id").cast("long"), vector.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", sound)
    )
    floors = F.transform("x", lambda x: _checked(F.floor(F.lit(float(scale)) * x)))
    return valid.select("vec_id", floors.alias("v")).distinct()


def _checked(x: Column) -> Column:
    wide = F.raise_error(F.lit("a component is too large for the index")).cast("int")
    return F.when(F.abs(x) <= _LARGEST, x.cast("int")).otherwise(wide)


def _slices(values: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the binary digits of non-negative values, lowest digit first, rows packed in 64-bit words."""
    words = -(-len(values) // 64)
    out = []
    for digit in range(int(values.max(initial=0)).bit_length()):
        packed = np.zeros(words * 8, np.uint8)
        bits = np.packbits((values >> digit & 1).astype(np.uint8), bitorder="little")
        packed[: len(bits)] = bits
        out.append(packed.view(np.uint64))
    return out


class BlockIndex:
    """The slices of one block of rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.low, self.high = values.min(axis=0), values.max(axis=0)
        self.up = [_slices(values[:, d] - self.low[d]) for d in range(values.shape[1])]
        self.down = [_slices(self.high[d] - values[:, d]) for d in range(values.shape[1])]
        self.words = -(-len(ids) // 64)

    def scores(self, query: np.ndarray) -> tuple[int, list[np.ndarray]]:
        """A constant and the slices, lowest first, of what the rows score above it."""
        constant, columns = 0, []
        for d, weight in enumerate(query.tolist()[: len(self.up)]):
            digits, bound = (self.up[d], self.low[d]) if weight > 0 else (self.down[d], self.high[d])
            constant += weight * int(bound)
            weight = abs(weight)
            shift = 0
            while weight:
                if weight & 1:
                    for j, bitmap in enumerate(digits):
                        while len(columns) <= shift + j:
                            columns.append([])
                        columns[shift + j].append(bitmap)
                weight >>= 1
                shift += 1
        return constant, self._added(columns)

    def _added(self, columns: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Full adders take three bitmaps of a place to one, and a carry for the next place."""
        out, place = [], 0
        while place < len(columns):
            own = columns[place]
            while len(own) > 1:
                a, b = own.pop(), own.pop()
                both = a ^ b
                if own:
                    c = own.pop()
                    total, carry = both ^ c, (a & b) | (both & c)
                else:
                    total, carry = both, a & b
                own.append(total)
                if place + 1 == len(columns):
                    columns.append([])
                columns[place + 1].append(carry)
                # Sums go behind those still waiting, so that fresh and old ones take turns.
                own.insert(0, own.pop())
            out.append(own[0] if own else np.zeros(self.words, np.uint64))
            place += 1
        return out

    def best(self, query: np.ndarray, own_id: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows, ties to the smaller id."""
        constant, slices = self.scores(query)
        rows = np.ones(self.words * 64, bool)
        rows[len(self.ids) :] = False
        if own_id is not None:
            first, last = np.searchsorted(self.ids, [own_id, own_id + 1])
            rows[first:last] = False
        open_rows = np.packbits(rows, bitorder="little").view(np.uint64)
        sure = np.zeros(self.words, np.uint64)
        need = min(k, int(rows.sum()))
        for bitmap in reversed(slices):
            if not need:
                break
            ones = open_rows & bitmap
            n = int(np.bitwise_count(ones).sum())
            if n > need:
                open_rows = ones
            else:
                sure |= ones
                need -= n
                open_rows = open_rows & ~bitmap
        # Rows still open are equal on every slice; they are in order of id.
        chosen = np.concatenate((self._rows(sure), self._rows(open_rows)[:need]))
        word, bit = chosen >> 6, (chosen & 63).astype(np.uint64)
        total = np.full(len(chosen), constant, np.int64)
        for place, bitmap in enumerate(slices):
            total += (bitmap[word] >> bit & np.uint64(1)).astype(np.int64) << place
        return self.ids[chosen], total

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        word = np.flatnonzero(bitmap)
        bits = np.unpackbits(bitmap[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        return word[at] * 64 + bit


def _matrix(lists: list) -> np.ndarray:
    """Integer rows of possibly different lengths, missing components as zero."""
    width = max([len(x) for x in lists], default=0)
    out = np.zeros((len(lists), max(width, 1)), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int, name: str) -> Iterator[pa.RecordBatch]:
    """Gather up to ``size`` rows of a partition into one row that holds their ids and values."""
    ids: list[int] = []
    lists: list = []

    def packed(n: int) -> pa.RecordBatch:
        values = _matrix(lists[:n])
        # As few bytes as hold them; the reader tells their number from the lengths.
        values = values.astype(np.promote_types(*(np.result_type(np.int8, np.min_scalar_type(x)) for x in (values.min(), values.max()))))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([np.asarray(ids[:n], np.int64).tobytes()]), pa.array([values.tobytes()]),
                pa.array([values.shape[1]], pa.int32()),
            ],
            names=[f"{name}_ids", f"{name}_values", f"{name}_width"],
        )

    for batch in batches:
        ids += batch.column(0).to_pylist()
        lists += batch.column(1).to_numpy(zero_copy_only=False).tolist()
        while len(ids) >= size:
            yield packed(size)
            del ids[:size], lists[:size]
    if ids:
        yield packed(len(ids))


def blocks(rows: DataFrame, size: int, name: str, total: int) -> DataFrame:
    """Rows of ``quantised`` in numbered blocks of at most ``size``; ``total`` is their count."""
    kind = f"{name}_ids binary, {name}_values binary, {name}_width int"
    packed = rows.repartition(max(1, -(-total // size))).mapInArrow(lambda b: _blocks(b, size, name), kind)
    # Written with their numbers, so that a recomputed partition cannot renumber them.
    return written(packed.withColumn(name, F.monotonically_increasing_id()), f"{name}-blocks")


def _unpacked(row: dict, name: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{name}_ids"], np.int64)
    width = row[f"{name}_width"]
    values = np.frombuffer(row[f"{name}_values"], f"i{len(row[f'{name}_values']) // (len(ids) * width)}")
    return ids, values.astype(np.int64).reshape(len(ids), width)


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            index = BlockIndex(*_unpacked(pair, "block"))
            query, found, score = [], [], []
            for own, weights in zip(*_unpacked(pair, "query")):
                ids, total = index.best(weights, int(own), k)
                query.append(np.full(len(ids), own))
                found.append(ids)
                score.append(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (query, found, score)],
                names=["query_id", "vec_id", "score"],
            )


def top_k(
    table: DataFrame, queries: Column, k: int = K, scale: int = SCALE, block: int = BLOCK, group: int = QUERIES
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows for every row that ``queries`` marks.

    Every block of rows is copied to every block of queries, and both are of
    bounded size; the work is that of a stated query set against all rows.
    """
    rows = written(quantised(table, scale), "quantised")
    asked = rows.where(queries)
    index = blocks(rows, block, "block", rows.count())
    questions = blocks(asked, group, "query", asked.count())
    # One number per block reaches the driver. Either side is dealt to its pairs in one shuffle, which
    # spreads them over tasks; a broadcast would leave all pairs of a block of rows to one.
    every = [F.explode(F.lit([r[0] for r in side.select(name).collect()]).cast("array<long>")).alias(name)
             for side, name in ((index, "block"), (questions, "query"))]
    pairs = index.select("*", every[1]).join(questions.select("*", every[0]).hint("merge"), ["block", "query"])
    best = pairs.mapInArrow(lambda b: _searched(b, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.dropDuplicates().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


OP2_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""
