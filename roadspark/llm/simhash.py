"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints are cut into more blocks than two linked ones can differ in, so
linked pairs agree on several whole blocks. Every choice of that many blocks is
a key; fingerprints that share a key are compared by Hamming distance.

Equal fingerprints are one row from the start, with a count. Keys shared by many
fingerprints are cut into cells of bounded size, one task compares one cell with
one other, and each pair of cells returns a spanning forest of its links rather
than the links. Null and empty texts have fingerprint zero and link like any
other; null ids take part but name no component unless all of its ids are null;
repeated rows are returned as often as they come; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are ignored. A very long text
is held by one worker.

``near_copies`` and ``one_of_each`` compare texts, not fingerprints: two rows
belong together only through pairs whose sets of shingles are similar.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.llm.components import components, merge
from roadspark.llm.rows import packed, unpacked
from roadspark.runtime import written, written_alone

WORDS = 4
DISTANCE = 4
BLOCKS = 6
CELL = 1024
# Cells of long texts hold fewer: so many shingles a row of a full cell, 16 MB of sets.
CELL_SHINGLES = 2048
SIMILARITY = 0.8
# Texts that are 0.8 alike share none of 32 bands of 4 minima with probability (1 - 0.8 ** 4) ** 32, 5e-8.
BANDS, ROWS = 32, 4
# Of 128 minima, pairs 0.8 alike share 102 on average, and fewer than 77 with probability below 1e-7.
LEAST_SHARED = 77
# The first bands of each round. Candidates by SimHash have negative bands; of the others, seven in
# ten pairs 0.8 alike meet in the first two bands already.
_ROUNDS = (-64, 0, 2, 8)
_SEED = 42
_RANDOM = np.random.default_rng(_SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_FLIP, _ODD = _RANDOM[0], _RANDOM[1] | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        some = hashes[at : at + 4096].astype("<u8", copy=False)
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return total


def _hashes(text: str, words: int) -> np.ndarray:
    """Hashes of a text's word shingles, repeats included."""
    found = _WORD.findall(text.encode("utf-8").translate(_LOWER))
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, _SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends[:-words])).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    return np.array([digest(joined[i:j], _SEED) for i, j in zip(starts, stops)], np.uint64)


def _print(hashes: np.ndarray) -> int:
    return int(np.packbits(_bits(hashes) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, words: int = WORDS) -> int:
    """64-bit SimHash of a text's word shingles, repeats included."""
    return _print(_hashes(text, words))


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
        signed = np.array(prints, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], names=["doc_id", "row", "print"])


def _row_key() -> Column:
    """The same for rows of equal id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, row key and ``print``, the fingerprint as a signed long."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row"), text).mapInArrow(
        lambda batches: _fingerprints(batches, words), "doc_id long, row long, print long"
    )


def block_keys(distance: int = DISTANCE, blocks: int = BLOCKS) -> Column:
    """All choices of ``blocks - distance`` blocks of ``print``, each as one long."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(number).cast("long")
        for b in chosen:
            width = edges[b + 1] - edges[b]
            value = F.shiftrightunsigned("print", edges[b]).bitwiseAND(F.lit((1 << width) - 1))
            key = F.xxhash64(key, value) if blocks - distance > 2 else F.shiftleft(key, width).bitwiseOR(value)
        keys.append(key)
    return F.array(*keys)


def _linked(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the links inside each cell; rows come ordered by ``cell``."""

    def found(cell: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        root = np.arange(len(prints))
        left = np.arange(len(prints) - 1)
        shift = 1
        while len(left):
            left = left[left + shift < len(prints)]
            left = left[cell[left] == cell[left + shift]]
            near = np.bitwise_count(prints[left] ^ prints[left + shift]) <= distance
            merge(root, left[near], left[near] + shift)
            shift += 1
        hung = np.flatnonzero(root != np.arange(len(prints)))
        return pa.RecordBatch.from_arrays(
            [pa.array(prints[hung].view(np.int64)), pa.array(prints[root[hung]].view(np.int64))], names=["a", "b"]
        )

    cell, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        cell = np.concatenate((cell, batch.column(0).to_numpy(zero_copy_only=False)))
        prints = np.concatenate((prints, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
        if not len(cell):
            continue
        done = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on in the next batch
        if done:
            yield found(cell[:done], prints[:done])
            cell, prints = cell[done:], prints[done:]
    if len(cell):
        yield found(cell, prints)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """Edges ``a``, ``b`` that connect whatever fingerprints lie within ``distance``; ``prints`` has distinct ones."""
    keyed = prints.select("print", F.explode(block_keys(distance, blocks)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    cells = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.hash("print"), cells)
    other = F.explode(F.sequence(F.lit(0), cells - 1))
    # The sizes grow with the table: never broadcast.
    spread = keyed.join(sizes.hint("merge"), "key").select("print", "key", own.alias("own"), other.alias("other"))
    placed = spread.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "print")
    return placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        lambda batches: _linked(batches, distance), "a long, b long"
    )


def classes(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """``print`` and ``root``, the smallest fingerprint reachable by links, of all distinct fingerprints."""
    if not distance < blocks:
        raise ValueError("there must be more blocks than differing bits")
    distinct = prints.select("print").distinct()
    grouped = components(links(distinct, distance, blocks, cell)).withColumnRenamed("node", "print")
    return distinct.join(grouped, "print", "left").select("print", F.coalesce("root", "print").alias("root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, **parameters) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = written(fingerprints(docs, words), "prints")
    named = prints.groupBy("print").agg(F.min("doc_id").alias("first")).join(classes(prints, **parameters), "print")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(smallest, "root").select("print", "component_id")
    return prints.join(known, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---- verified near copies ------------------------------------------------------------------------


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of a text's word shingles; a shorter text is one shingle, a blank one has none."""
    return np.unique(_hashes(text, words))


def _minima(hashes: np.ndarray) -> np.ndarray:
    """Least values of the set under each of the mixings; sets of similarity s share a given one with probability s."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        mixed = (hashes[at : at + 2048, None] ^ _FLIP) * _ODD
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def _band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band of minima; sets of similarity s share a given one with probability s ** ROWS."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * _STEP
        keys ^= keys >> np.uint64(29)
    return keys


def _described(batches: Iterator[pa.RecordBatch], words: int, banded: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, n, prints, keys, minima = [], [], [], [], []
        for text in batch.column(2).to_pylist():
            hashes = _hashes(text, words)
            distinct = np.unique(hashes)
            node.append(xxhash.xxh64_intdigest(distinct.tobytes(), _SEED) if len(distinct) else 0)
            n.append(len(distinct))
            prints.append(_print(hashes))
            if banded and len(distinct):
                least = _minima(distinct)
                bands = _band_keys(least)
                keys.append(bands.view(np.int64))
                minima.append(((least * _STEP) >> np.uint64(56)).astype(np.uint8).tobytes() + (bands >> np.uint64(48)).astype("<u2").tobytes())
            else:
                keys.append([])
                minima.append(b"")
        signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (node, prints)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), signed[0], pa.array(n, pa.int32()), signed[1], pa.array(keys, pa.list_(pa.int64())),
             pa.array(minima, pa.binary())],
            names=["doc_id", "row", "node", "n", "print", "keys", "minima"],
        )


def _shingled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            sets = [shingles(t, words).view(np.int64) for t in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])


def _alike(least: np.ndarray, most: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of these sizes can be as similar as that."""
    return np.minimum(least, most) >= similarity * np.maximum(least, most) - 1e-9


def _by_cell(batches: Iterator[pa.RecordBatch], columns: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """The columns of one cell after the other; rows come ordered by their first column, ``cell``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = columns(batch)
        held = new if held is None else [np.concatenate(pair) for pair in zip(held, new)]
        starts = np.flatnonzero(np.diff(held[0], prepend=held[0][0] - 1))
        for start, stop in zip(starts, starts[1:]):
            yield [h[start:stop] for h in held]
        held = [h[starts[-1] :] for h in held]  # the last cell may go on in the next batch
    if held is not None:
        yield held


def _meeting(batches: Iterator[pa.RecordBatch], similarity: float, distance: int) -> Iterator[pa.RecordBatch]:
    """Rows of each cell that have a candidate in it; rows come ordered by ``cell`` and ``n``.

    With minima, a byte of each and two of each band's key, a candidate has as many equal ones as pairs that
    alike have, and of all bands that a pair shares only the lowest names it. In a cell of two
    parts (``side`` is not negative) only rows of different parts meet.
    """

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        minima = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return [*(c.to_numpy(zero_copy_only=False) for c in batch.columns[:6]), minima]

    for cell, band, side, node, n, prints, minima in _by_cell(batches, columns):
        ends = np.searchsorted(n, n / similarity + 1e-6, "right")
        meets = np.zeros(len(n), bool)
        digests = np.ascontiguousarray(minima[:, BANDS * ROWS :]).view("<u2")
        for at in range(len(n) - 1):
            last = ends[at]
            likely = (node[at] != node[at + 1 : last]) & _alike(n[at], n[at + 1 : last], similarity)
            likely &= (side[at] < 0) | (side[at] != side[at + 1 : last])
            likely &= np.bitwise_count(prints[at] ^ prints[at + 1 : last]) <= distance
            if minima.shape[1] and likely.any():
                one = at + 1 + np.flatnonzero(likely)
                equal = minima[at, : BANDS * ROWS] == minima[one, : BANDS * ROWS]
                shared = equal.reshape(-1, BANDS, ROWS).all(axis=2) & (digests[at] == digests[one])
                likely[one - at - 1] = (np.count_nonzero(equal, axis=1) >= LEAST_SHARED) & (shared.argmax(axis=1) == band[at])
            if likely.any():
                meets[at] = True
                meets[at + 1 : last] |= likely
        if meets.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[meets]) for x in (cell, band, side, node)], names=["cell", "band", "side", "node"]
            )


def _compared(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links between different roots in each cell; rows come ordered by ``cell``.

    One set is compared at a time with all that are not yet connected to it, the
    sets of the commonest shingles first: they link most of a large group at once.
    """

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        sets = np.empty(batch.num_rows, object)
        sets[:] = [x.values.to_numpy() for x in batch.column(4)]
        return [*(c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]), sets]

    for cell, side, node, root, sets in _by_cell(batches, columns):
        full = np.fromiter((len(x) > 0 for x in sets), bool, len(sets))
        side, node, sets = side[full], node[full], sets[full]
        if len(node) < 2:
            continue
        group = np.unique(root[full], return_inverse=True)[1]
        size = np.array([len(x) for x in sets])
        starts = np.concatenate(([0], np.cumsum(size)[:-1]))
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        common = np.add.reduceat(np.bincount(ids)[ids], starts) / size
        mark, left = np.zeros(len(values), np.int32), np.ones(len(node), bool)
        a, b = [], []
        for at in np.argsort(-common, kind="stable"):
            left[at] = False
            open_ = np.flatnonzero(
                left & (group != group[at]) & _alike(size[at], size, similarity) & ((side[at] < 0) | (side != side[at]))
            )
            if not len(open_):
                continue
            own = ids[starts[at] : starts[at] + size[at]]
            mark[own] = 1
            if 2 * size[open_].sum() > len(ids):
                shared = np.add.reduceat(mark[ids], starts)[open_]
            else:
                shared = np.array([np.count_nonzero(mark[ids[starts[o] : starts[o] + size[o]]]) for o in open_])
            mark[own] = 0
            linked = open_[shared >= similarity * (size[at] + size[open_] - shared) - 1e-9]
            groups, first = np.unique(group[linked], return_index=True)
            a.extend([node[at]] * len(first))
            b.extend(node[linked[first]])
            group[np.isin(group, groups)] = group[at]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in (a, b)], names=["a", "b"])


def _cells(distinct: DataFrame, keys: Column, first: int, cell: int) -> DataFrame:
    """``cell, band, side`` and the columns of ``distinct`` for rows that share a key; ``first`` numbers the first key.

    Keys are counted on narrow rows; minima are attached to those that share one.
    """
    keyed = distinct.select("node", "print", F.col("n").cast("long").alias("n"), F.posexplode(keys).alias("band", "key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n_key"), F.sum("n").alias("shingles")).where("n_key > 1")
    cells = F.ceil(F.greatest(F.col("n_key") / cell, F.col("shingles") / (cell * CELL_SHINGLES))).cast("int")
    own = F.pmod(F.hash("node", "print"), cells)
    other = F.explode(F.sequence(F.lit(0), cells - 1))
    spread = keyed.join(sizes.hint("merge"), "key").select("node", "n", "print", "band", "key", own.alias("own"), other.alias("other"))
    return spread.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        (F.col("band") + first).cast("long").alias("band"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).cast("long").alias("side"),
        "node", "n", "print",
    )


def _met(placed: DataFrame, similarity: float, reach: int) -> DataFrame:
    return placed.repartition("cell").sortWithinPartitions("cell", "n", "node").mapInArrow(
        lambda batches: _meeting(batches, similarity, reach), "cell long, band long, side long, node long"
    )


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, distance: int | None = None, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """doc_id, row key and ``root`` of every row: rows of one root are connected by texts of that similarity.

    Similarity is that of the sets of distinct shingles, and every link is verified on whole sets. Candidates lie within
    ``distance`` bits and share a SimHash key. By default that is ``DISTANCE``, and pairs that SimHash misses are candidates
    too if they share a band of minima and most minima. No pairs are written: a row goes with its set to the cells where it
    has a candidate, cells are bounded in rows and shingles, and each returns a spanning forest. SimHash keys come first and
    bands in three rounds after them; cells whose rows are connected by then are left out.
    """
    banded = distance is None
    reach = DISTANCE if banded else distance
    if not reach < blocks:
        raise ValueError("there must be more blocks than differing bits")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row"), text).mapInArrow(
            lambda batches: _described(batches, words, banded),
            "doc_id long, row long, node long, n int, print long, keys array<long>, minima binary",
        ),
        "shingle-keys",
    )
    # Rows of a node have equal sets, hence equal keys of minima; their prints may differ, as prints count repeats.
    placed = _cells(rows.dropDuplicates(["node", "print"]), block_keys(reach, blocks), _ROUNDS[0] if banded else 0, cell)
    met = _met(placed.withColumn("minima", F.lit(b"")), similarity, reach)
    if banded:
        distinct = rows.dropDuplicates(["node"])
        placed = _cells(distinct, F.col("keys"), 0, cell).join(distinct.select("node", "minima").hint("merge"), "node")
        placed = placed.select("cell", "band", "side", "node", "n", "print", "minima")
        met = met.unionByName(_met(placed, similarity, 64))
    meeting = written(met, "meeting")

    wanted = meeting.select("node").distinct()
    holders = rows.join(wanted, "node").groupBy("node").agg(F.min("row").alias("row"))
    held = docs.select(_row_key().alias("row"), text.alias("text")).join(holders, "row").dropDuplicates(["node"])
    sets = written(held.select("node", "text").mapInArrow(lambda batches: _shingled(batches, words), "node long, set array<long>"), "shingle-sets")

    found, roots = None, None
    starts = _ROUNDS if banded else _ROUNDS[1:]
    for low, high in zip(starts, [*starts[1:], None]):
        some = meeting.where(F.col("band") >= low)
        some = some if high is None else some.where(F.col("band") < high)
        if roots is None:
            rooted = some.withColumn("root", F.col("node"))
        else:
            rooted = some.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rooted.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        rooted = rooted.join(apart.select("cell"), "cell", "left_semi")
        dealt = rooted.join(sets.hint("merge"), "node").select("cell", "side", "node", "root", "set")
        near = dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(
            lambda batches: _compared(batches, similarity), "a long, b long"
        )
        near = written(near, "near-links")
        found = near if found is None else found.unionByName(near)
        roots = written(components(found), "roots")
    return rows.select("doc_id", "row", "node").join(roots, "node", "left").select(
        "doc_id", "row", F.coalesce("root", "node").alias("root")
    )


def one_of_each(docs: DataFrame, words: int = WORDS, **parameters) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id, null first, then the smallest row key."""
    rows = written_alone(docs.sparkSession, lambda: near_copies(docs, words, **parameters), "near-copies")
    chosen = rows.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("one")).select(F.col("one.row").alias("row"))
    times = rows.groupBy("row").agg(F.count("*").alias("times"))
    chosen = written(chosen.join(times, "row"), "chosen")
    kept = packed(docs, _row_key().alias("row")).join(chosen, "row")
    if not chosen.where("times > 1").isEmpty():
        kept = kept.where("times = 1").unionByName(kept.where("times > 1").dropDuplicates(["row"]))
    return unpacked(kept, docs.columns)


def op6_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
