"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a structured random product code: the vector is cut into
blocks, each block has a few random unit codewords, and a direction is one
codeword per block. Every vector lives in one home cap, its nearest direction
(per block, the nearest codeword), and is list-decoded to all caps that a vector
within reach of it could live in. That list is exact: a partner's block can have
codeword ``c`` nearest only across the plane halfway between ``c`` and the own
nearest codeword, so the squared distances to those planes, summed over blocks,
are at most the squared chord of the similarity. Either of two linked vectors
thus lists the other's home, so a vector needs only the caps from its own home
on: joining lists with homes meets every linked pair of different homes once,
and each meeting is verified and counted for both.

Caps of a label that follow each other form a region of about ``region``
vectors, and a vector travels once to each region that holds a cap of its list,
not once to each cap. Regions with more vectors are cut into cells: one task
joins the homes of one part with the lists of another, cap by cap, and what it
returns is a count and one tree edge per vector, not the pairs. Equal vectors of
a label are one row with a count from the start.

Vectors that are null, all zero, or hold null or non-finite components, and
vectors without a label, link with nothing: they are returned with no links and
themselves as component. Vectors of different lengths are never linked. Repeated
rows are vectors of their own and link with each other. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from roadspark.llm.components import components, merge
from roadspark.runtime import written

SIMILARITY = 0.98
BLOCKS = 2
REGION = 8192
_SEED = 20


def codewords(total: int) -> int:
    """Codewords per block: more for larger tables, so that caps stay small."""
    return int(min(64, max(8, 2 ** round(math.log2(max(total, 1)) / 5))))


def codebook(dim: int, words: int, blocks: int = BLOCKS) -> list[tuple[int, np.ndarray]]:
    """First component and unit codewords of every block; the same on every machine."""
    rng = np.random.default_rng([_SEED, dim, words, blocks])
    parts = np.array_split(np.arange(dim), min(blocks, dim))
    book = []
    for part in parts:
        drawn = rng.standard_normal((words, len(part)))
        if len(part) >= words:  # random directions at right angles lie farthest apart
            drawn = np.linalg.qr(drawn.T)[0].T
        book.append((int(part[0]), drawn / np.linalg.norm(drawn, axis=1, keepdims=True)))
    return book


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision whatever their scale."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def decode(vectors: np.ndarray, words: int, similarity: float, home: np.ndarray | None = None, blocks: int = BLOCKS):
    """Home cap of every unit row (if not given), and all (row, cap) its partners may live in."""
    reach = 2 - 2 * similarity + 1e-9
    n = len(vectors)
    book = codebook(vectors.shape[1], words, blocks)
    found = np.zeros(n, np.int64)
    row, cap, spent = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
    for place, (first, code) in enumerate(book):
        inner = vectors[:, first : first + code.shape[1]] @ code.T
        best = inner.argmax(axis=1) if home is None else home // words ** (len(book) - 1 - place) % words
        found = found * words + best
        apart = np.linalg.norm(code[best][:, None, :] - code[None, :, :], axis=2)
        plane = (inner[np.arange(n), best][:, None] - inner) / np.where(apart > 0, apart, 1)
        cost = spent[:, None] + plane[row] ** 2
        keep, word = np.nonzero(cost <= reach)
        row, cap, spent = row[keep], cap[keep] * words + word, cost[keep, word]
    return found, row, cap


def regions_of(size: int, dim: int, words: int, region: int) -> tuple[int, int]:
    """Number of regions of a group of ``size`` vectors, and of its caps."""
    caps = words ** min(BLOCKS, dim)
    return min(caps, -(-size // region)), caps


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and values of a list column, by length of the lists."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    out = []
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        out.append((rows, values[starts[rows][:, None] + np.arange(size)]))
    return out


def _routed(batches: Iterator[pa.RecordBatch], words: int, similarity: float, region: int) -> Iterator[pa.RecordBatch]:
    """Home, number of regions and listed regions of every vector."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            size = some.column("size").to_numpy()
            homes, parts = np.zeros(some.num_rows, np.int64), np.zeros(some.num_rows, np.int32)
            listed = [None] * some.num_rows
            for rows, values in _matrix(some.column("vector")):
                home, row, cap = decode(unit(values), words, similarity)
                counts = [regions_of(int(n), values.shape[1], words, region) for n in size[rows]]
                count, caps = np.array([c for c, _ in counts]), counts[0][1]
                homes[rows], parts[rows] = home, count
                onward = cap >= home[row]
                row, cap = row[onward], cap[onward]
                pairs = np.unique(row * caps + cap * count[row] // caps)
                cuts = np.searchsorted(pairs // caps, np.arange(1, len(rows)))
                for r, some_regions in zip(rows.tolist(), np.split(pairs % caps, cuts)):
                    listed[r] = some_regions.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [some.column(c) for c in ("group", "node", "copies", "vector")]
                + [pa.array(homes), pa.array(parts), pa.array(listed, pa.list_(pa.int32()))],
                names=["group", "node", "copies", "vector", "home", "parts", "regions"],
            )


def links_of_cell(home, parts, region, as_home, as_list, node, copies, vectors, words, similarity):
    """Rows of one cell that are linked, their smallest row by links, and the number of links found here."""
    root, count = np.arange(len(node)), np.zeros(len(node), np.int64)
    caps = words ** min(BLOCKS, vectors.shape[1])
    lists, rows_by_cap = np.flatnonzero(as_list), []
    for at in range(0, len(lists), 500):
        some = lists[at : at + 500]
        _, row, cap = decode(vectors[some], words, similarity, home[some])
        here = (cap >= home[some][row]) & (cap * parts // caps == region)
        rows_by_cap.append(np.stack([cap[here], some[row[here]]]))
    if not rows_by_cap:
        return root, count
    cap, listed = np.concatenate(rows_by_cap, axis=1)
    order = np.argsort(cap, kind="stable")
    cap, listed = cap[order], listed[order]
    homes = np.flatnonzero(as_home)
    homes = homes[np.argsort(home[homes], kind="stable")]
    for c in np.unique(home[homes]):
        of_home = homes[slice(*np.searchsorted(home[homes], [c, c + 1]))]
        of_list = listed[slice(*np.searchsorted(cap, [c, c + 1]))]
        target = vectors[of_home].T
        for at in range(0, len(of_list), 512):
            rows = of_list[at : at + 512]
            near = vectors[rows] @ target >= similarity
            near &= node[rows][:, None] != node[of_home][None, :]
            if not near.any():
                continue
            count[rows] += near @ copies[of_home]
            # Two of one home meet from either side, two of different homes only here.
            lower = home[rows] < c
            count[of_home] += copies[rows[lower]] @ near[lower]
            a, b = np.nonzero(near)
            merge(root, rows[a], of_home[b])
    return root, count


def _verified(batches: Iterator[pa.RecordBatch], words: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """Links between the homes and the lists of each cell; rows come ordered by ``cell``."""
    held: list[pa.RecordBatch] = []
    for batch in _and_last(batches):
        if batch is not None:
            held.append(batch)
        rows = pa.Table.from_batches(held).combine_chunks() if held else None
        if rows is None or not rows.num_rows:
            continue
        cell = rows["cell"].to_numpy()
        done = len(cell) if batch is None else int(np.searchsorted(cell, cell[-1]))
        if not done:
            continue
        whole = rows.slice(0, done)
        cuts = np.flatnonzero(np.diff(cell[:done])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), done]):
            own = whole.slice(i, j - i)
            home, as_home, as_list, node, copies = (
                own[c].to_numpy() for c in ("home", "as_home", "as_list", "node", "copies")
            )
            # A cell has vectors of one length, and of one region, only.
            ((_, values),) = _matrix(own["vector"].combine_chunks())
            parts, region = own["parts"][0].as_py(), own["region"][0].as_py()
            root, count = links_of_cell(
                home, parts, region, as_home, as_list, node, copies, unit(values), words, similarity
            )
            keep = np.flatnonzero((count > 0) | (root != np.arange(len(node))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[keep]), pa.array(node[root[keep]]), pa.array(count[keep])], names=["a", "b", "links"]
            )
        held = rows.slice(done).to_batches()


def _and_last(batches: Iterator[pa.RecordBatch]):
    yield from batches
    yield None


def _takes_part(vector: str) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(
        F.col(vector).isNotNull() & F.forall(vector, sound) & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def near_duplicates(
    embeddings: DataFrame, similarity: float = SIMILARITY, region: int = REGION, words: int | None = None
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    ``region`` is the number of vectors that a region should have and that a part
    of a cell has at most, ``words`` the codewords per block (by the number of
    vectors if not given).
    """
    # Single precision travels as it is and is widened where it is compared.
    single = isinstance(getattr(embeddings.schema["embedding"].dataType, "elementType", None), FloatType)
    kind = "array<float>" if single else "array<double>"
    table = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind).alias("vector"), "label")
    table = table.withColumn("part", F.col("label").isNotNull() & _takes_part("vector"))
    # The zero's sign must not tell equal vectors apart.
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    table = table.withColumn("node", F.when(F.col("part"), F.xxhash64("label", F.size("vector"), plain)))
    distinct = written(
        table.where("part").groupBy("node").agg(
            F.count("*").alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label")
        ).select("node", "copies", "vector", F.xxhash64("label", F.size("vector")).alias("group")),
        "cap-vectors",
    )
    if words is None:
        words = codewords(distinct.count())
    met = written(_meetings(distinct, region, words, similarity, kind), "cap-links")
    counts = met.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(met)
    named = distinct.select("node", "copies").join(counts, "node", "left").join(roots, "node", "left")
    named = named.select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    placed = table.select("vec_id", "node").join(named, "node", "left")
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    out = placed.join(smallest, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _meetings(distinct: DataFrame, region: int, words: int, similarity: float, kind: str) -> DataFrame:
    """Counts and tree edges of all cells."""
    # Sizes are written before they are joined, so that the planner knows whether they can be broadcast.
    groups = written(distinct.groupBy("group").agg(F.count("*").alias("size")), "cap-groups")
    routed = written(
        distinct.join(groups, "group").select("group", "node", "copies", "vector", "size").mapInArrow(
            lambda batches: _routed(batches, words, similarity, region),
            f"group long, node long, copies long, vector {kind}, home long, parts int, regions array<int>",
        ),
        "caps",
    )
    rows = routed.select("group", "node", "copies", "vector", "home", "parts", F.explode("regions").alias("region"))
    sizes = written(rows.groupBy("group", "region").agg(F.ceil(F.count("*") / region).cast("int").alias("k")), "cap-sizes")
    rows = rows.join(sizes, ["group", "region"]).withColumn("own", F.pmod(F.hash("node"), "k"))
    # The first list of a vector is in its home's region.
    caps = F.pow(F.lit(words), F.least(F.lit(BLOCKS), F.size("vector"))).cast("long")
    rows = rows.withColumn("at_home", F.col("region") == F.floor(F.col("home") * F.col("parts") / caps).cast("int"))
    others = F.sequence(F.lit(0), F.col("k") - 1)
    as_lists = F.transform(others, lambda i: i * F.col("k") + F.col("own"))
    as_homes = F.transform(others, lambda j: F.col("own") * F.col("k") + j)
    cells = F.when(F.col("at_home"), F.array_union(as_lists, as_homes)).otherwise(as_lists)
    rows = rows.withColumn("at", F.explode(cells))
    return (
        rows.select(
            F.xxhash64("group", "region", "at").alias("cell"), "region", "parts", "home",
            (F.col("at_home") & (F.floor(F.col("at") / F.col("k")) == F.col("own"))).alias("as_home"),
            (F.col("at") % F.col("k") == F.col("own")).alias("as_list"), "node", "copies", "vector",
        )
        .repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(lambda batches: _verified(batches, words, similarity), "a long, b long, links long")
    )


def op4_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# DuckDB's answer to the same question, by comparing all pairs of a label.
OP4_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
), roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
