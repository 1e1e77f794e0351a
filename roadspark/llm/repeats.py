"""Exact repeated passages by suffix arrays of shards.

A passage of ``window`` bytes has an anchor: of its grams of ``gram`` bytes, the
one whose hash is smallest. Equal passages have equal anchors, so all passages
of one anchor meet in one shard and need not meet any other. Neighbouring
passages of a text mostly share their anchor; such a run, with the bytes its
passages cover, is a context. Contexts whose anchor occurs once are done.
Contexts that are equal as a whole are one row with a count. The others are
sorted: a shard holds contexts up to a bounded size, its suffix array is refined
by doubling only where suffixes are still tied, common prefixes of neighbours
are carried along each context, and a passage repeats if it shares its whole
length with a neighbour. An anchor with very many different contexts is spread
over several shards; the sorted passages of two shards are merged by binary
search. A context that stands in thousands of places meets nothing: its places
are marked where the text is cut, neighbours as one range.

The result is that of comparing all passages. Null and empty texts, and texts
shorter than a passage, lose nothing. Repeated rows are repeats of each other.
An empty table gives an empty result. Null ids stay null, and columns other than
``doc_id`` and ``text`` are ignored or, by ``without_repeats``, passed through.
A very long text is read in pieces, but held by one worker when it is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from roadspark.llm.rows import packed, unpacked
from roadspark.runtime import written

WINDOW = 200
GRAM = 64
# Bytes of text hashed at once, and bytes of contexts sorted at once.
PIECE = 1 << 20
SHARD = 1 << 21
# Contexts of one anchor in one part; more are spread over several.
PART = 4096
# Places from which an anchor or a context counts as frequent, and how many of each are handled as such.
FREQUENT = 4096
FREQUENT_AT_MOST = 1000
_SPAN = "key long, size long, first long, last long"
_CONTEXT = "anchor long, whole long, key long, size long, at long, starts int"
_BASE = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1


# ---- anchors -------------------------------------------------------------------------------------


class _Powers:
    """Powers of the hash base and of its inverse, modulo 2**64."""

    def __init__(self, n: int):
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = self._table(_BASE, n)
        self.down = self._table(inverse, n)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


def anchors(data: np.ndarray, valid: np.ndarray, powers: _Powers, window: int, gram: int):
    """Runs of passages with one anchor: first start, number of starts, hash of the anchor.

    ``valid`` marks the starts whose passage lies inside one text.
    """
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:n], out=total[1:])
    grams = (total[gram:] - total[:-gram]) * powers.down[: n - gram + 1]
    order = grams ^ (grams >> np.uint64(32))
    order *= np.uint64(0xD6E8FEB86659FD93)
    order ^= order >> np.uint64(29)
    # Of equal grams the leftmost wins, so the low bits hold the whole place.
    low = np.uint64((1 << n.bit_length()) - 1)
    least = (order & ~low) | np.arange(len(order), dtype=np.uint64)
    width, span = 1, window - gram + 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    start = np.flatnonzero(valid[: len(least)])
    if not len(start):
        return start, start, np.empty(0, np.uint64)
    anchor = (least[start] & low).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return start[first], np.diff(np.append(first, len(start))), grams[anchor[first]]


def _pieces(keys: list, sizes: list, texts: list[bytes], window: int):
    """Texts joined up to about ``PIECE`` bytes; longer ones cut so that every passage lies in one piece."""
    held, length = [], 0
    for key, size, text in zip(keys, sizes, texts):
        if len(text) < window:
            continue
        for at in range(0, len(text) - window + 1, PIECE):
            part = text[at : at + PIECE + window - 1]
            held.append((key, size, at, part))
            length += len(part)
            if length >= PIECE:
                yield held
                held, length = [], 0
    if held:
        yield held


def _contexts(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    powers = _Powers(2 * (PIECE + window))
    for batch in batches:
        texts = [t.encode("utf-8") for t in batch.column(2).to_pylist()]
        for held in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, window):
            joined = b"".join([part for *_, part in held])
            ends = np.cumsum([len(part) for *_, part in held])
            valid = np.ones(len(joined), bool)
            for end in ends.tolist():
                valid[end - window + 1 : end] = False
            first, number, anchor = anchors(np.frombuffer(joined, np.uint8), valid, powers, window, gram)
            own = np.searchsorted(ends, first, side="right")
            begin = ends - np.array([len(part) for *_, part in held])
            offset = np.array([at for _, _, at, _ in held], np.int64)
            digest = xxhash.xxh3_64_intdigest
            whole = [digest(joined[i : i + k]) for i, k in zip(first.tolist(), (number + window - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)), pa.array(np.array(whole, np.uint64).view(np.int64)),
                    pa.array(np.array([h[0] for h in held], np.int64)[own]),
                    pa.array(np.array([h[1] for h in held], np.int64)[own]),
                    pa.array(first - begin[own] + offset[own]), pa.array(number.astype(np.int32)),
                ],
                names=["anchor", "whole", "key", "size", "at", "starts"],
            )


# ---- suffix arrays -------------------------------------------------------------------------------


def _words(data: np.ndarray, more: int = 0) -> np.ndarray:
    """The eight bytes from every place on, as one number; zeros follow the data, ``more`` places beyond its end."""
    n = len(data) + more
    padded = np.concatenate((data, np.zeros(more + 8, np.uint8)))
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k : k + n].astype(np.uint64)
    return word


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``data`` ordered by the ``depth`` bytes that follow.

    Larsson and Sadakane's refinement: a rank is the first slot of a group of
    equal prefixes; doubling sorts only groups of more than one. The last step
    overlaps so that it ends at ``depth``.
    """
    n = len(data)
    word = _words(data)[:n]
    order = np.argsort(word, kind="stable")
    first = np.ones(n, bool)
    first[1:] = word[order][1:] != word[order][:-1]
    slots = np.arange(n)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
    known = 8
    while known < depth:
        step = min(known, depth - known)
        tied = ~(first & np.append(first[1:], True))
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        place = order[slots]
        pair = rank[place] * (n + 1) + rank[np.minimum(place + step, n)] + 1
        inner = np.argsort(pair, kind="stable")
        place, pair = place[inner], pair[inner]
        order[slots] = place
        head = np.ones(len(slots), bool)
        head[1:] = pair[1:] != pair[:-1]
        rank_of = np.maximum.accumulate(np.where(head, slots, 0))
        rank[place] = rank_of
        first[slots] = head
        known += step
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, begin: np.ndarray, number: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, at most ``depth``, of every ordered start with the one before it.

    Kasai's rule along each context: one byte on, the prefix shrinks by one at
    most. It holds while the start before goes on inside its context, and while
    the prefix is below ``depth``, where equal starts are in no order; elsewhere
    the prefix is counted anew. All contexts advance side by side.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    goes_on = np.zeros(n + 1, bool)
    goes_on[order] = True
    shared = np.zeros(n, np.int32)
    word = _words(data, depth)
    alive = np.arange(len(begin))
    carried = np.zeros(len(begin), np.int64)
    for step in range(int(number.max(initial=0))):
        alive = alive[number[alive] > step]
        place = begin[alive] + step
        other = before[place]
        length = np.where(other < 0, 0, carried[alive])
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            differs = word[place[grow] + length[grow]] ^ word[other[grow] + length[grow]]
            length[grow] += np.where(differs == 0, 8, _leading_zero_bytes(differs))
            grow = grow[(differs == 0) & (length[grow] < depth)]
        length = np.minimum(length, depth)
        shared[place] = length
        sound = (other >= 0) & (length < depth) & goes_on[other + 1]
        carried[alive] = np.where(sound, np.maximum(length - 1, 0), 0)
    return shared[order]


def _leading_zero_bytes(word: np.ndarray) -> np.ndarray:
    count = np.zeros(len(word), np.int64)
    for k in range(1, 8):
        count += word < np.uint64(1 << (64 - 8 * k))
    return count


class Shard:
    """Contexts side by side, with the sorted array of their passages."""

    def __init__(self, contexts: list[bytes], starts: np.ndarray, window: int):
        self.window = window
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        lengths = np.array([len(c) for c in contexts])
        self.begin, self.number = np.cumsum(lengths) - lengths, np.asarray(starts, np.int64)
        self.is_start = np.zeros(len(self.data), bool)
        for b, k in zip(self.begin.tolist(), self.number.tolist()):
            self.is_start[b : b + k] = True
        order = suffix_order(self.data, window)
        self.order = order[self.is_start[order]]

    def repeated(self) -> np.ndarray:
        """Marks the places whose passage stands at another place of the shard, too."""
        shared = common_prefixes(self.data, self.order, self.begin, self.number, self.window) >= self.window
        found = np.zeros(len(self.data), bool)
        found[self.order[shared]] = True
        found[self.order[np.flatnonzero(shared) - 1]] = True
        return found

    def _words(self, places: np.ndarray) -> np.ndarray:
        """Passages as numbers whose order is that of the bytes."""
        width = -(-self.window // 8) * 8
        bytes_ = np.zeros((len(places), width), np.uint8)
        bytes_[:, : self.window] = np.lib.stride_tricks.sliding_window_view(self.data, self.window)[places]
        return bytes_.view(">u8").astype(np.uint64)

    def found_in(self, other: "Shard") -> np.ndarray:
        """Marks the places whose passage stands in ``other``, by binary search in its array."""
        found = np.zeros(len(self.data), bool)
        for at in range(0, len(self.order), 20_000):
            places = self.order[at : at + 20_000]
            sought = self._words(places)
            low, high = np.zeros(len(places), np.int64), np.full(len(places), len(other.order))
            while (low < high).any():
                middle = np.minimum((low + high) // 2, len(other.order) - 1)
                there = other._words(other.order[middle])
                differs = there != sought
                at_word = differs.argmax(axis=1)
                row = np.arange(len(places))
                less = differs.any(axis=1) & (there[row, at_word] < sought[row, at_word])
                going = low < high
                low = np.where(going & less, middle + 1, low)
                high = np.where(going & ~less, middle, high)
            inside = np.flatnonzero(low < len(other.order))
            same = (other._words(other.order[low[inside]]) == sought[inside]).all(axis=1)
            found[places[inside[same]]] = True
        return found

    def runs(self, found: np.ndarray, context: int) -> list[tuple[int, int]]:
        """First and last marked start of every run inside one context, from its beginning."""
        begin, number = int(self.begin[context]), int(self.number[context])
        marked = found[begin : begin + number]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
        return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def _sorted(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Repeated runs of the contexts that are alone of their kind; rows come ordered by ``cell``."""

    def result(shard: Shard, found: np.ndarray, rows: list[dict]) -> pa.RecordBatch:
        out = [
            (r["key"], r["size"], r["at"] + a, r["at"] + b + window)
            for i, r in enumerate(rows) if r["copies"] == 1 for a, b in shard.runs(found, i)
        ]
        columns = list(zip(*out)) if out else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "size", "first", "last"])

    def shard_of(rows: list[dict]) -> Shard:
        return Shard([r["bytes"] for r in rows], [r["starts"] for r in rows], window)

    def crossed(rows: list[dict]):
        sides = [[r for r in rows if r["side"] == s] for s in (0, 1)]
        if sides[0] and sides[1]:
            one, two = shard_of(sides[0]), shard_of(sides[1])
            yield result(one, one.found_in(two), sides[0])
            yield result(two, two.found_in(one), sides[1])

    def alone(rows: list[dict]):
        shard = shard_of(rows)
        yield result(shard, shard.repeated(), rows)

    gathered, weight = [], 0
    for rows in _cells(batches):
        if rows[0]["crossed"]:
            yield from crossed(rows)
            continue
        gathered += rows
        weight += sum(len(r["bytes"]) for r in rows)
        if weight >= SHARD:
            yield from alone(gathered)
            gathered, weight = [], 0
    if gathered:
        yield from alone(gathered)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows: list[dict] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            for row in batch.slice(at, 1000).to_pylist():
                if rows and row["cell"] != rows[0]["cell"]:
                    yield rows
                    rows = []
                rows.append(row)
    if rows:
        yield rows


# ---- the job -------------------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with their text, and the key that equal texts share."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return packed(docs, text.alias("text"), without="text").withColumn("key", F.xxhash64("text")).withColumn(
        "size", F.octet_length("text").cast("long")
    )


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, part: int = PART, frequent: int = FREQUENT
) -> DataFrame:
    """key, size and ``spans`` (array of byte ranges, unordered, overlapping) of texts that hold repeats."""
    if not 8 <= gram <= window:
        raise ValueError("a gram has 8 bytes at least and fits into the window")
    keyed = _keyed(docs).select("key", "size", "text")
    contexts = keyed.where(F.col("size") >= window).mapInArrow(lambda batches: _contexts(batches, window, gram), _CONTEXT)
    # Written first, so that both sides of the join are plain shuffles and a skewed one can be split.
    again = written(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    # Frequent anchors leave the join, in the order of their texts.
    top = [r["anchor"] for r in again.where(F.col("n") >= frequent).orderBy(F.desc("n"), "anchor").limit(FREQUENT_AT_MOST).collect()]
    ordered = written(contexts.where(F.col("anchor").isin(top)), "frequent-contexts") if top else None
    rest = ~F.col("anchor").isin(top)
    repeated = written(contexts.where(rest).join(again.where(rest).select("anchor"), "anchor"), "contexts")
    kinds = written(
        (repeated.unionByName(ordered) if top else repeated).groupBy("anchor", "whole").agg(
            F.count("*").alias("copies"), F.min(F.struct("key", "size", "at", "starts")).alias("one")
        ),
        "context-kinds",
    )
    spans = _partial(keyed, kinds, window, part)
    if top:
        most = kinds.where(F.col("copies") >= frequent).orderBy(F.desc("copies"), "anchor", "whole").limit(FREQUENT_AT_MOST)
        # One anchor for each digest, so that a digest alone finds its kind.
        often = {r["whole"]: r["anchor"] for r in most.select("anchor", "whole").collect()}
        spans = spans.unionByName(ordered.mapInArrow(lambda batches: _ranges(batches, window, often), _SPAN))
        repeated = repeated.unionByName(ordered.where(~_any_of(often)))
        kinds = kinds.where(~_any_of(often))
    whole = repeated.join(kinds.where("copies > 1").select("anchor", "whole"), ["anchor", "whole"]).select(
        "key", "size", F.col("at").alias("first"), (F.col("at") + F.col("starts") + (window - 1)).alias("last")
    )
    return whole.unionByName(spans).groupBy("key", "size").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _any_of(kinds: dict[int, int]) -> Column:
    """Whether a row is of one of ``kinds``, anchors by digest."""
    if not kinds:
        return F.lit(False)
    anchor = F.create_map(*[F.lit(x) for kind in kinds.items() for x in kind])[F.col("whole")]
    return F.when(F.col("whole").isin(list(kinds)), anchor == F.col("anchor")).otherwise(False)


def _ranges(batches: Iterator[pa.RecordBatch], window: int, kinds: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Byte ranges of the contexts of ``kinds``; those that follow each other in a text are one range."""
    whole = np.array(sorted(kinds), np.int64)
    anchor = np.array([kinds[w] for w in whole.tolist()], np.int64)
    for batch in batches:
        if not len(whole) or not batch.num_rows:
            continue
        own_anchor, own, key, size, at, starts = (c.to_numpy() for c in batch.columns)
        place = np.minimum(np.searchsorted(whole, own), len(whole) - 1)
        found = (whole[place] == own) & (anchor[place] == own_anchor)
        key, size, first = key[found], size[found], at[found]
        last = first + starts[found] + (window - 1)
        new = np.ones(len(first), bool)
        new[1:] = (key[1:] != key[:-1]) | (size[1:] != size[:-1]) | (first[1:] <= first[:-1]) | (first[1:] > last[:-1])
        head = np.flatnonzero(new)
        ends = np.append(head[1:], len(first))[: len(head)] - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (key[head], size[head], first[head], last[ends])], names=["key", "size", "first", "last"]
        )


def _partial(keyed: DataFrame, kinds: DataFrame, window: int, part: int) -> DataFrame:
    """Ranges repeated inside contexts that are alone of their kind, from their anchors' suffix arrays."""
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("n"), F.min("copies").alias("fewest")).where("n > 1 and fewest = 1")
    parts = F.ceil(F.col("n") / part).cast("int")
    open_ = kinds.join(mixed.select("anchor", parts.alias("parts")), "anchor")
    wanted = open_.groupBy(F.col("one.key").alias("key"), F.col("one.size").alias("size")).agg(
        F.collect_list(F.struct("anchor", "whole", "copies", "parts", "one.at", "one.starts")).alias("wanted")
    )
    raw = F.col("text").cast("binary")
    cut = keyed.join(wanted, ["key", "size"]).select(
        "key", "size",
        F.inline(F.transform("wanted", lambda w: F.struct(
            w["anchor"].alias("anchor"), w["whole"].alias("whole"), w["copies"].alias("copies"), w["parts"].alias("parts"),
            w["at"].alias("at"), w["starts"].alias("starts"),
            F.substring(raw, w["at"].cast("int") + 1, w["starts"] + (window - 1)).alias("bytes"),
        ))),
    ).dropDuplicates(["anchor", "whole"])
    own = F.pmod(F.col("whole"), F.col("parts").cast("long")).cast("int")
    spread = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
    placed = spread.select(
        cell.alias("cell"), (F.col("own") > F.col("other")).cast("int").alias("side"), (F.col("own") != F.col("other")).alias("crossed"),
        "key", "size", "at", "starts", "copies", "bytes",
    )
    return placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        lambda batches: _sorted(batches, window), _SPAN
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges, sorted, with those that touch or overlap made one."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for first, last in spans:
        out.append(raw[at:first])
        at = last
    return b"".join([*out, raw[at:]])


def _removed(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    """What is left of ``text`` after its ``spans``, or its digest, with counts, beside the whole row."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            texts, spans = some.column("text").to_pylist(), some.column("spans").to_pylist()
            n, gone, runs, left = [], [], [], []
            for text, own in zip(texts, spans):
                raw = text.encode("utf-8")
                own = merged([(s["first"], s["last"]) for s in own or []])
                kept = _kept(raw, own)
                n.append(len(raw))
                gone.append(len(raw) - len(kept))
                runs.append(len(own))
                # A cut inside a character leaves bytes that are no text; those are dropped with it.
                left.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "ignore"))
            counts = [pa.array(c, pa.int64()) for c in (n, gone, runs)]
            yield pa.RecordBatch.from_arrays(
                [some.column("_doc"), *counts, pa.array(left, pa.string())], names=["_doc", "n_bytes", "n_removed", "n_spans", "left"]
            )


def _cleaned(docs: DataFrame, digest: bool, **parameters) -> DataFrame:
    rows = _keyed(docs).join(repeated_spans(docs, **parameters), ["key", "size"], "left").select("_doc", "text", "spans")
    schema = StructType([rows.schema["_doc"]])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, LongType())
    return rows.mapInArrow(lambda batches: _removed(batches, digest), schema.add("left", StringType()))


def without_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with every repeated passage taken out of ``text``; all rows and columns stay."""
    return unpacked(_cleaned(docs, False, **parameters), docs.columns, text=F.col("left"))


def removal_report(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, bytes, removed bytes, removed runs and the digest of what is left, of every row."""
    out = _cleaned(docs.select("doc_id", "text"), True, **parameters)
    return out.select("_doc.doc_id", "n_bytes", "n_removed", "n_spans", F.col("left").alias("kept_sha256"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
