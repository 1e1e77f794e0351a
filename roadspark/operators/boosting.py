"""Gradient-boosted regression trees that stop when held-out rows gain no more.

Many fits (models, folds) grow side by side: one pass over the stored rows serves
the open nodes of all of them. A node with many rows is split on histograms that
tasks sum over their rows and Spark sums over tasks; one with at most ``LOCAL_ROWS``
rows has them sent to one task, which grows what is below it. A round's first pass
also measures, on the rows held out for it, the trees grown so far.
Rows are stored in blocks of one record each, column by column, and go to tasks as
such; bins of several features share a byte, and sums by byte add up to sums by bin. Predictions are added to them every few rounds; in between the few new
trees are applied on the fly. Only split decisions and sums reach the driver. Leaves of the last level are
never visited, as their parents' splits hold their sums.

Residuals are rounded to a grid on which all sums are exact, so a tree does not
depend on how rows are spread or where a node is grown. The result is Spark's own
``GBTRegressionModel``.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspark import schema as S
from roadspark.runtime import new_path, remove

PATIENCE = 50
BINS = 64
# Rounds after which predictions are stored again; every pass until then applies the trees of these rounds, which
# costs more than storing where a round takes a pass for every level.
BLOCK, BLOCK_OF_LARGE = 10, 3
# Trees of each fit that one task adds to its rows when growth goes on.
ADVANCED = 50
# Some 10 MB in one task.
LOCAL_ROWS = 400_000
CHUNK_ROWS = 250_000
CHUNK_BYTES = 32 << 20
_STEP = "slot int, job int, node int, data binary, g binary, n long"
BYTE = 256
# Columns of a block of n rows: bins (bundles x n), scores (fits x n), the others n values.
_BLOCK = {"bins": np.uint8, "y": np.float64, "fold": np.int32, "held": np.bool_, "mark": np.int64, "scores": np.float64}
_FOUND = "job int, node int, feature int, bin int, gain double, g double, n long, gl double, nl long"


@dataclass(frozen=True)
class Boosting:
    """Parameters of one boosted model; ``rows`` and ``columns`` are the shares each tree sees."""

    rounds: int = 1000
    depth: int = 8
    rate: float = 0.1
    rows: float = 1.0
    columns: float = 1.0
    min_leaf: int = 1
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    seed: int = S.SEED

    def checked(self) -> "Boosting":
        if not (self.rounds >= 1 and 1 <= self.depth <= 15 and self.rate > 0 and 0 < self.rows <= 1
                and 0 < self.columns <= 1 and self.min_leaf >= 1 and self.l1 >= 0 and self.l2 >= 0
                and self.min_gain >= 0):
            raise ValueError(f"refused boosting parameters: {self}")
        return self


def best_rounds(errors: list[float], patience: int = PATIENCE) -> int:
    """The round of least error before ``patience`` rounds in a row bring no gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


@dataclass
class Fit:
    """One model in growth: all rows but those of ``fold``; with ``stop`` a tenth of them decides the rounds.

    Without ``stats`` the trees do not keep what their nodes gained: they can be scored but not made a model.
    """

    params: Boosting
    fold: int | None = None
    stop: bool = False
    stats: bool = True
    trees: list[dict] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    base: float = 0.0
    trained: int = 0
    done: bool = False

    def best(self) -> int:
        """Trees to keep: those up to the least held-out error."""
        return best_rounds(self.errors, len(self.errors)) if self.errors else len(self.trees)

    def plain(self) -> tuple:
        """What a task needs to know of this fit."""
        return self.params, self.fold, self.stop


@dataclass
class Edges:
    """Upper bounds of the bins of every feature; a value in bin b is at most ``bounds[b]``."""

    bounds: list[np.ndarray]


@dataclass
class Bundles:
    """Bins of several features in one byte of ``totals`` values: a feature's bin is ``byte // step % size``."""

    byte: np.ndarray
    step: np.ndarray
    size: np.ndarray
    totals: list[int]

    @property
    def span(self) -> int:
        return max(self.totals, default=1)

    def cuts(self, bins: int) -> np.ndarray:
        """Whether a byte's value lies right of a cut: ``(feature * bins + cut) * span + value``, then a row of none."""
        own = np.arange(self.span) // self.step[:, None] % self.size[:, None]
        right = own[:, None] > np.arange(bins)[:, None]
        return np.append(right.ravel(), np.zeros(self.span, bool)).view(np.uint8)

    def by_bin(self, found: np.ndarray, bins: int) -> np.ndarray:
        """Sums by (node, feature, bin) from sums by (node, byte, value)."""
        out = np.zeros((len(found), len(self.byte), bins, 2))
        for k, (b, step, size) in enumerate(zip(self.byte, self.step, self.size)):
            total = self.totals[b]
            own = found[:, b, :total].reshape(len(found), total // (step * size), size, step, 2)
            out[:, k, :size] = own[:, 0, :, 0] if total == size else own.sum(axis=(1, 3))
        return out


def bundled(sizes: list[int], limit: int = BYTE) -> Bundles:
    """Features by the number of their bins, the largest first, each into the fullest byte that holds it."""
    totals, byte, step = [], np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fitting = [b for b, total in enumerate(totals) if total * sizes[k] <= limit]
        if not fitting:
            fitting = [len(totals)]
            totals.append(1)
        byte[k] = max(fitting, key=totals.__getitem__)
        step[k] = totals[byte[k]]
        totals[byte[k]] *= sizes[k]
    return Bundles(byte, step, np.array(sizes, np.int64), totals)


# ---- rows


def learn_edges(assembled: DataFrame, bins: int = BINS, features: str = "features") -> Edges:
    """Distinct quantiles of every feature in one aggregation, each within a ten-thousandth of its rank."""
    first = assembled.select(F.size(vector_to_array(features)).alias("n")).first()
    width = first["n"] if first else 0
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    x = assembled.select(vector_to_array(features).alias("x"))
    cuts = x.agg(*[F.percentile_approx(F.get("x", F.lit(i)), probs, 10_000).alias(f"c{i}") for i in range(width)])
    row = cuts.first() if width else []
    return Edges([np.unique(np.asarray(c if c is not None else [], np.float64)) for c in row])


def _binned(batches: Iterator[pa.RecordBatch], edges: Edges, bundles: Bundles) -> Iterator[pa.RecordBatch]:
    width = len(bundles.totals)
    for batch in batches:
        n = batch.num_rows
        x = np.asarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
        out = np.zeros((n, width), np.uint8)
        for k, bounds in enumerate(edges.bounds):
            out[:, bundles.byte[k]] += (np.searchsorted(bounds, x[:, k], "left") * bundles.step[k]).astype(np.uint8)
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(out.tobytes())])
        yield pa.RecordBatch.from_arrays([rows.cast(pa.binary()), *batch.columns[1:]], names=["bins", *batch.schema.names[1:]])


def _row_hash(id_col: str):
    return F.xxhash64(F.col(id_col).cast("string"))


def stop_rows(id_col: str = S.ID):
    """The tenth of the rows that decides when growth stops."""
    return F.pmod(F.xxhash64(F.lit("stop"), F.col(id_col).cast("string")), F.lit(10)) == 0


def _stored(
    assembled: DataFrame, edges: Edges, bundles: Bundles, fits: list[Fit], id_col: str, target: str
) -> tuple[DataFrame, str, float]:
    """Rows with a target as ``bins, y, fold, held, mark``, their folder, and the grid's step as its inverse."""
    fold = F.col("fold").cast("int") if "fold" in assembled.columns else F.lit(None).cast("int")
    rows = assembled.where(F.col(target).isNotNull()).select(
        vector_to_array("features").alias("x"), F.col(target).cast("double").alias("y"),
        F.coalesce(fold, F.lit(-1)).alias("fold"), stop_rows(id_col).alias("held"), _row_hash(id_col).alias("mark"),
    ).mapInArrow(lambda b: _binned(b, edges, bundles), "bins binary, y double, fold int, held boolean, mark long")
    rows, path = _kept(rows, "binned")
    sums = rows.groupBy("fold", "held").agg(
        F.count("*").alias("n"), F.sum("y").alias("y"), F.min("y").alias("lo"), F.max("y").alias("hi")
    ).collect()  # one row per fold and side
    if not sums:
        raise ValueError("no rows with a target to boost on")
    total = sum(r["n"] for r in sums)
    spread = max(max(r["hi"] for r in sums) - min(r["lo"] for r in sums), 1e-12)
    for fit in fits:
        own = [r for r in sums if r["fold"] != fit.fold and not (fit.stop and r["held"])]
        fit.trained = sum(r["n"] for r in own)
        fit.base = sum(r["y"] for r in own) / max(fit.trained, 1)
    # Sums of residuals up to four times the spread stay below 2^52.
    return rows, path, 2.0 ** math.floor(50 - math.log2(total * spread))


def _blocked(batches: Iterator[pa.RecordBatch], bases: list[float]) -> Iterator[pa.RecordBatch]:
    """One record for every batch of rows; scores begin at the fits' bases."""
    for batch in batches:
        if batch.num_rows:
            x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            columns = [x.T, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "held", "mark"))]
            yield _record_of([*columns, np.repeat(np.array(bases), batch.num_rows)])


def _record_of(columns: list[np.ndarray]) -> pa.RecordBatch:
    data = [pa.array([np.ascontiguousarray(c, kind).tobytes()], pa.binary()) for c, kind in zip(columns, _BLOCK.values())]
    return pa.RecordBatch.from_arrays(data, names=list(_BLOCK))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of every block, in the order of ``_BLOCK``."""
    for batch in batches:
        for i in range(batch.num_rows):
            x, y, *rest, scores = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in _BLOCK.items()
            )
            yield [x.reshape(-1, len(y)), y, *rest, scores.reshape(-1, len(y))]


# ---- trees; node i has children 2i + 1 and 2i + 2


def _empty_tree(depth: int) -> dict:
    size = (1 << depth + 1) - 1
    return {"feature": np.full(size, -1, np.int16), "bin": np.zeros(size, np.int16), "value": np.zeros(size), "stats": {}}


def _leaf_value(g: float, n: float, params: Boosting) -> float:
    return math.copysign(max(abs(g) - params.l1, 0.0), g) / (n + params.l2) if n + params.l2 > 0 else 0.0


def _walk(tree: dict, x: np.ndarray, levels: int) -> np.ndarray:
    """The node each row stands in after ``levels`` splits, or earlier where the tree ends; ``x`` has a row per feature."""
    node = np.zeros(x.shape[1], np.int64)
    rows = np.arange(x.shape[1])
    places = np.maximum(tree["feature"], 0).astype(np.int64) * x.shape[1]
    for _ in range(levels):
        on = tree["feature"][node] >= 0
        if not on.any():
            break
        right = x.take(places[node] + rows) > tree["bin"][node]
        node = np.where(on, 2 * node + 1 + right, node)
    return node


def _add(scores: np.ndarray, x: np.ndarray, trees: list[dict], params: Boosting) -> np.ndarray:
    for tree in trees:
        scores = scores + params.rate * tree["value"][_walk(tree, x, params.depth)]
    return scores


@dataclass
class _Route:
    """A tree as rows of bundles follow it; a leaf leads to itself."""

    byte: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    levels: int  # of splits


def _level(node: int) -> int:
    return (node + 1).bit_length() - 1


def _route(tree: dict, bundles: Bundles, bins: int, rate: float) -> _Route:
    feature, on = tree["feature"].astype(np.int64), tree["feature"] >= 0
    nodes = np.arange(len(feature))
    cut = np.where(on, feature * bins + tree["bin"], len(bundles.byte) * bins) * bundles.span
    levels = _level(int(np.flatnonzero(on)[-1])) + 1 if on.any() else 0
    return _Route(bundles.byte[np.maximum(feature, 0)], cut, np.where(on, 2 * nodes + 1, nodes), rate * tree["value"], levels)


def _follow(route: _Route, x: np.ndarray, levels: int, cuts: np.ndarray) -> np.ndarray:
    """The node each row ends in after ``levels`` splits; ``x`` has a row per bundle."""
    n = x.shape[1]
    node = np.zeros(n, np.int64)
    rows, start = np.arange(n), route.byte * n
    for _ in range(min(levels, route.levels) if n else 0):
        place = start.take(node)
        place += rows
        place = x.take(place) + route.cut.take(node)
        node = route.left.take(node) + cuts.take(place)
    return node


def _added(scores: np.ndarray, x: np.ndarray, routes: list[_Route], levels: int, cuts: np.ndarray) -> np.ndarray:
    for route in routes:
        scores = scores + route.value.take(_follow(route, x, levels, cuts))
    return scores


def _sampled(mark: np.ndarray, params: Boosting, number: int) -> np.ndarray:
    """The rows that tree ``number`` sees, the same wherever a row lies."""
    if params.rows >= 1:
        return np.ones(len(mark), bool)
    z = mark.astype(np.uint64) + np.uint64((params.seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(11)).astype(np.float64) * 2.0**-53 < params.rows


def _columns(width: int, params: Boosting, number: int) -> np.ndarray:
    """The features that tree ``number`` may split on."""
    allowed = np.ones(width, bool)
    if params.columns < 1:
        rng = np.random.default_rng([params.seed, number])
        allowed[rng.permutation(width)[max(1, round(params.columns * width)) :]] = False
    return allowed


def _histogram(node: np.ndarray, nodes: int, x: np.ndarray, g: np.ndarray, bins: int) -> np.ndarray:
    """Sums of residuals and rows by (node, feature, bin); ``x`` has a row per feature."""
    first = node.astype(np.int64) * bins
    found = np.empty((nodes, len(x), bins, 2))
    for k, own in enumerate(x):
        key = first + own
        found[:, k, :, 0] = np.bincount(key, g, nodes * bins).reshape(nodes, bins)
        found[:, k, :, 1] = np.bincount(key, minlength=nodes * bins).reshape(nodes, bins)
    return found


def _best_splits(hist: np.ndarray, allowed: np.ndarray, params: Boosting, scale: float) -> list[tuple]:
    """(feature, bin, gain, g, n, gl, nl) of every node; feature -1 where no split gains."""
    total = hist[:, 0].sum(axis=1)
    left = hist.cumsum(axis=2)
    right = total[:, None, None] - left

    def strength(part):
        g = np.maximum(np.abs(part[..., 0]) / scale - params.l1, 0.0)
        return g * g / np.maximum(part[..., 1] + params.l2, 1e-12)

    gain = strength(left) + strength(right) - strength(total)[:, None, None]
    legal = (left[..., 1] >= params.min_leaf) & (right[..., 1] >= params.min_leaf) & allowed[None, :, None]
    gain = np.where(legal, gain, -1.0)
    found = []
    for i, at in enumerate(gain.reshape(len(gain), -1).argmax(axis=1)):
        feature, cut = divmod(int(at), hist.shape[2])
        best = float(gain[i, feature, cut])
        g, n = float(total[i, 0]), int(total[i, 1])
        if best <= max(2 * params.min_gain, 1e-12):
            found.append((-1, 0, 0.0, g, n, 0.0, 0))
        else:
            found.append((feature, cut, best, g, n, float(left[i, feature, cut, 0]), int(left[i, feature, cut, 1])))
    return found


def _children(node: int, g: float, n: int, gl: float, nl: int) -> tuple[tuple, tuple]:
    """Both children of a split node with their sums, which are exact on the grid."""
    return (2 * node + 1, gl, nl), (2 * node + 2, g - gl, n - nl)


def _grow_here(
    root: int, x: np.ndarray, g: np.ndarray, allowed, params: Boosting, scale: float, bins: int, bundles: Bundles | None = None
) -> list[tuple]:
    """All splits and leaves at and below ``root`` from the rows of that node; ``x`` has a row per bundle, or per feature.

    Of two children only the smaller one is counted: sums on the grid are exact, so the other is the difference.
    """
    bundles = bundles or bundled([bins] * len(x), bins)
    cuts, span = bundles.cuts(bins), bundles.span

    def counted_by(node, nodes, x, g):
        return bundles.by_bin(_histogram(node, nodes, x, g, span), bins)

    depth = _level(root)
    if depth == params.depth:
        return [(root, -1, 0, 0.0, float(g.sum()), len(g), 0.0, 0)]
    found, open_nodes = [], [root]
    node = np.zeros(len(g), np.int64)  # place in open_nodes
    hist = counted_by(node, 1, x, g)
    while open_nodes:
        splits = _best_splits(hist, allowed, params, scale)
        found += [(i, *split) for i, split in zip(open_nodes, splits)]
        if depth + 1 == params.depth:
            ends = [child for i, s in zip(open_nodes, splits) if s[0] >= 0 for child in _children(i, *s[3:])]
            return found + [(i, -1, 0, 0.0, s, n, 0.0, 0) for i, s, n in ends]
        feature = np.array([s[0] for s in splits])
        cut = np.array([s[1] for s in splits])
        going = feature[node] >= 0
        if not going.all():
            x, g, node = np.compress(going, x, axis=1), g[going], node[going]
        value = x.take((bundles.byte[feature] * len(g))[node] + np.arange(len(g)))
        right = cuts.take(((feature * bins + cut) * span)[node] + value)
        open_nodes = [c for i, s in zip(open_nodes, splits) if s[0] >= 0 for c in (2 * i + 1, 2 * i + 2)]
        place = (np.cumsum(feature >= 0) - 1)[node]
        node = 2 * place + right
        depth += 1
        if open_nodes:
            less_right = np.array([2 * s[6] > s[4] for s in splits if s[0] >= 0])
            counted = right == less_right[place]
            less = counted_by(place[counted], len(less_right), np.compress(counted, x, axis=1), g[counted])
            more = hist[feature >= 0] - less
            side = less_right[:, None, None, None]
            hist = np.stack([np.where(side, more, less), np.where(side, less, more)], axis=1).reshape(-1, *less.shape[1:])
    return found


# ---- passes over the rows


@dataclass
class _Pass:
    """What tasks need: fits, their trees of this block, the open nodes and the grid."""

    fits: list[tuple]
    active: dict[int, tuple]  # job -> (tree number, trees of the block, tree in growth, large nodes, small nodes, measure)
    width: int
    bins: int
    scale: float
    bundles: Bundles | None = None  # none: one byte a feature
    slots: dict[tuple, int] = field(default_factory=dict)  # (job, node) -> group

    def __post_init__(self):
        self.bundles = self.bundles or bundled([self.bins] * self.width, self.bins)


def _visit(batches: Iterator[pa.RecordBatch], work: _Pass) -> Iterator[pa.RecordBatch]:
    """Histograms of large nodes, rows of small ones and held-out errors (node -1)."""
    sums: dict[int, np.ndarray] = {}
    errors: dict[int, list] = {}
    cuts, span = work.bundles.cuts(work.bins), work.bundles.span
    routes = {
        job: [_route(t, work.bundles, work.bins, work.fits[job][0].rate) for t in (*block, tree)]
        for job, (_, block, tree, *_) in work.active.items()
    }
    for x, y, fold, held, mark, scores in _blocks(batches):
        for job, (number, _, tree, large, small, measure) in work.active.items():
            params, own_fold, stop = work.fits[job]
            *before, growing = routes[job]
            trained = fold != (own_fold if own_fold is not None else -2)
            if stop:
                if measure:
                    aside = trained & held
                    off = y[aside] - _added(scores[job, aside], np.compress(aside, x, axis=1), before, params.depth, cuts)
                    entry = errors.setdefault(job, [0.0, 0])
                    entry[0] += float(np.rint(off * off * work.scale).sum())
                    entry[1] += int(aside.sum())
                trained &= ~held
            trained &= _sampled(mark, params, number)
            rows = np.flatnonzero(trained)
            own = x if len(rows) == len(y) else x.take(rows, axis=1)
            node = _follow(growing, own, params.depth, cuts)
            place = np.full(len(tree["feature"]), -1, np.int64)
            place[large] = np.arange(len(large))
            place[small] = len(large) + np.arange(len(small))
            at = place[node]
            if not (at >= 0).all():
                rows, own, at = rows[at >= 0], np.compress(at >= 0, own, axis=1), at[at >= 0]
            g = np.rint((y[rows] - _added(scores[job, rows], own, before, params.depth, cuts)) * work.scale)
            big = at < len(large)
            if len(large):
                some = (at, own, g) if big.all() else (at[big], np.compress(big, own, axis=1), g[big])
                found = _histogram(some[0], len(large), *some[1:], span)
                sums[job] = sums[job] + found if job in sums else found
            if not big.all():
                places = np.flatnonzero(np.bincount(at[~big]))
                parts = [np.flatnonzero(at == p) for p in places] if len(places) > 1 or len(large) else [slice(None)]
                data = [np.ascontiguousarray(own[:, p]).tobytes() for p in parts]
                yield _step(
                    np.full(len(places), job), small[places - len(large)], data, [g[p].tobytes() for p in parts],
                    [len(d) // len(own) for d in data], work.slots,
                )
    for job, found in sums.items():
        large = work.active[job][3]
        data = [f.tobytes() for f in work.bundles.by_bin(found, work.bins)]
        yield _step(np.full(len(large), job), large, data, [None] * len(large), np.zeros(len(large), np.int64), work.slots)
    if errors:
        jobs = list(errors)
        yield _step(jobs, [-1] * len(jobs), [None] * len(jobs), [np.float64(errors[j][0]).tobytes() for j in jobs], [errors[j][1] for j in jobs], work.slots)


def _step(job, node, data, g, n, slots: dict) -> pa.RecordBatch:
    slot = [slots.get((int(j), int(i)), 0) for j, i in zip(job, node)]
    columns = [(slot, pa.int32()), (job, pa.int32()), (node, pa.int32()), (data, pa.binary()), (g, pa.binary()), (n, pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=[f.split()[0] for f in _STEP.split(", ")])


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _decide(table: pa.Table, work: _Pass) -> pa.Table:
    """The split of a large node, everything below a small one, or a held-out error."""
    job, node = table.column("job")[0].as_py(), table.column("node")[0].as_py()
    params, _, _ = work.fits[job]
    if node < 0:
        found = [(node, -1, 0, 0.0, float(_joined(table, "g", np.float64).sum()), sum(table.column("n").to_pylist()), 0.0, 0)]
    else:
        number, _, _, large, _, _ = work.active[job]
        allowed = _columns(work.width, params, number)
        if node in large:
            hist = np.zeros((work.width, work.bins, 2))
            for data in table.column("data"):
                hist += np.frombuffer(data.as_py(), np.float64).reshape(hist.shape)
            found = [(node, *_best_splits(hist[None], allowed, params, work.scale)[0])]
        else:
            bytes_ = len(work.bundles.totals)
            x = np.concatenate([np.frombuffer(d.as_buffer(), np.uint8).reshape(bytes_, -1) for d in table.column("data")], axis=1)
            found = _grow_here(node, x, _joined(table, "g", np.float64), allowed, params, work.scale, work.bins, work.bundles)
    columns = list(zip(*found))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
    names = [f.split()[0] for f in _FOUND.split(", ")]
    arrays = [pa.array([job] * len(found), pa.int32()), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
    return pa.Table.from_arrays(arrays, names=names)


def _advanced(
    batches: Iterator[pa.RecordBatch], blocks: dict[int, list], fits: list[tuple], bundles: Bundles, bins: int
) -> Iterator[pa.RecordBatch]:
    cuts = bundles.cuts(bins)
    routes = {job: [_route(t, bundles, bins, fits[job][0].rate) for t in block] for job, block in blocks.items()}
    for x, *others, scores in _blocks(batches):
        scores = scores.copy()
        for job, own in routes.items():
            scores[job] = _added(scores[job], x, own, fits[job][0].depth, cuts)
        yield _record_of([x, *others, scores])


def grow(
    assembled: DataFrame, fits: list[Fit], id_col: str = S.ID, target: str = S.TARGET, patience: int = PATIENCE,
    bins: int = BINS, local_rows: int = LOCAL_ROWS, chunk_rows: int = CHUNK_ROWS, block: int | None = None,
    edges: Edges | None = None,
) -> Edges:
    """Grow all ``fits`` on ``assembled`` (``features``, the target and, for folds, ``fold``).

    A fit ends after its rounds or ``patience`` rounds after its least held-out error. Fits that have trees
    already, grown on the same rows with ``edges``, go on from them.
    """
    for fit in fits:
        fit.params.checked()
    spark = assembled.sparkSession
    edges = edges or learn_edges(assembled, bins)
    width, slots = len(edges.bounds), bins
    bundles = bundled([len(b) + 1 for b in edges.bounds])
    rows, binned, scale = _stored(assembled, edges, bundles, fits, id_col, target)
    count = max(fit.trained for fit in fits)
    block = block or (BLOCK if count <= local_rows else BLOCK_OF_LARGE)
    chunk_rows = max(1, min(chunk_rows, CHUNK_BYTES // (len(bundles.totals) + 21 + 8 * len(fits))))
    rows = rows.repartition(max(1, math.ceil(count / chunk_rows), min(spark.sparkContext.defaultParallelism, count // 2000)), "mark")
    bases, schema = [fit.base for fit in fits], ", ".join(f"{c} binary" for c in _BLOCK)
    rows, path = _kept(rows.mapInArrow(lambda b: _blocked(b, bases), schema))
    remove(spark, binned)
    plain = [fit.plain() for fit in fits]

    def advanced(rows: DataFrame, old: str, blocks: dict[int, list]) -> tuple[DataFrame, str]:
        light = _light(blocks)
        rows, path = _kept(rows.mapInArrow(lambda b: _advanced(b, light, plain, bundles, slots), schema))
        remove(spark, old)
        return rows, path

    known = max(len(fit.trees) for fit in fits)
    for at in range(0, known, ADVANCED):
        rows, path = advanced(rows, path, {j: fit.trees[at : at + ADVANCED] for j, fit in enumerate(fits)})
    homes = _homes(spark)
    while not all(fit.done for fit in fits):
        first = {j: len(fit.trees) for j, fit in enumerate(fits) if not fit.done}
        for _ in range(block):
            _one_round(rows, fits, first, plain, width, slots, scale, patience, local_rows, bundles, homes)
            if all(fit.done for fit in fits):
                break
        blocks = {j: fits[j].trees[at:] for j, at in first.items()}
        if not all(fit.done for fit in fits):
            rows, path = advanced(rows, path, blocks)
    remove(spark, path)
    return edges


def _kept(rows: DataFrame, name: str = "boosting-rows") -> tuple[DataFrame, str]:
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path, compression="none")  # scores, which do not shrink, are read in every pass
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _tasks(spark) -> int:
    # As many tasks as asked for: few rows may still be much work, which sizes do not tell.
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _homes(spark) -> list[list[int]]:
    """Group numbers by the task that a shuffle on them leads to."""
    tasks = _tasks(spark)
    found = spark.range(64 * tasks).select(F.col("id").cast("int").alias("slot"))
    homes = [[] for _ in range(tasks)]
    for r in found.select("slot", F.pmod(F.hash("slot"), F.lit(tasks)).alias("home")).collect():
        homes[r["home"]].append(r["slot"])
    return homes


def _dealt(sizes: dict[tuple, int], homes: list[list[int]]) -> dict[tuple, int]:
    """A group number for every (job, node), so that tasks get about as much work each; any number is right."""
    load, taken = [(0, i) for i in range(len(homes))], [0] * len(homes)
    more = sum(map(len, homes))
    slots = {}
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        size, home = heapq.heappop(load)
        heapq.heappush(load, (size + sizes[key], home))
        if taken[home] < len(homes[home]):
            slots[key] = homes[home][taken[home]]
            taken[home] += 1
        else:
            slots[key] = more
            more += 1
    return slots


def _light(blocks: dict[int, list]) -> dict[int, list]:
    """Trees as tasks need them, without statistics."""
    return {j: [{k: t[k] for k in ("feature", "bin", "value")} for t in trees] for j, trees in blocks.items()}


def _one_round(rows, fits, first, plain, width, slots, scale, patience, local_rows, bundles, homes) -> None:
    growing = {j: _empty_tree(fits[j].params.depth) for j in first if not fits[j].done}
    opened = {j: {0: round(fits[j].trained * fits[j].params.rows)} for j in growing}  # node -> rows
    measure = True
    while any(opened.values()):
        active, sizes = {}, {}
        for j, nodes in opened.items():
            if not nodes:
                continue
            large = [i for i, n in sorted(nodes.items()) if n > local_rows]
            small = [i for i in sorted(nodes) if i not in large]
            block = _light({j: fits[j].trees[first[j] :]})[j]
            active[j] = (len(fits[j].trees), block, _light({j: [growing[j]]})[j][0], np.array(large, np.int64),
                         np.array(small, np.int64), measure and fits[j].stop and len(fits[j].errors) < len(fits[j].trees))
            sizes |= {(j, i): nodes[i] for i in small} | {(j, i): 0 for i in [*large, -1]}
        work = _Pass(plain, active, width, slots, scale, bundles, _dealt(sizes, homes))
        found = _passed(rows, work)
        opened = {j: {} for j in opened}
        for r in found.collect():  # at most the nodes of one tree per fit
            _record(r, fits[r["job"]], growing[r["job"]], opened[r["job"]], active, scale)
        if measure:
            measure = False
            for j in list(growing):
                if _stops(fits[j], patience):
                    fits[j].done = True
                    del growing[j], opened[j]
    for j, tree in growing.items():
        fits[j].trees.append(tree if fits[j].stats else _light({j: [tree]})[j][0])
        fits[j].done = len(fits[j].trees) >= fits[j].params.rounds and not fits[j].stop


def _passed(rows: DataFrame, work: _Pass) -> DataFrame:
    sent = rows.mapInArrow(lambda batches: _visit(batches, work), _STEP).repartition(_tasks(rows.sparkSession), "slot")
    return sent.groupBy("slot").applyInArrow(lambda table: _decide(table, work), _FOUND)


def _record(r, fit: Fit, tree: dict, opened: dict, active: dict, scale: float) -> None:
    node = r["node"]
    if node < 0:
        fit.errors.append(r["g"] / scale / max(r["n"], 1))
        return
    tree["feature"][node], tree["bin"][node] = r["feature"], r["bin"]
    tree["value"][node] = _leaf_value(r["g"] / scale, r["n"], fit.params)
    tree["stats"][node] = (r["gain"], r["g"] / scale, r["n"])
    if r["feature"] >= 0 and node in active[r["job"]][3]:
        for child, g, n in _children(node, r["g"], r["n"], r["gl"], r["nl"]):
            if _level(child) < fit.params.depth:
                opened[child] = n
            else:
                tree["value"][child] = _leaf_value(g / scale, n, fit.params)
                tree["stats"][child] = (0.0, g / scale, n)


def _stops(fit: Fit, patience: int) -> bool:
    """Whether the errors measured so far end the growth; with ``stop`` the last tree is measured too."""
    if not fit.stop:
        return False
    return len(fit.trees) >= fit.params.rounds or len(fit.errors) - fit.best() >= patience


# ---- scores and models


def _scored(batches: Iterator[pa.RecordBatch], edges: Edges, fits: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The first column holds the vectors, the second the folds; the others pass through."""
    for batch in batches:
        n, names = batch.num_rows, [*batch.schema.names[2:], "scores"]
        x = np.asarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
        bins = np.stack([np.searchsorted(b, x[:, k], "left") for k, b in enumerate(edges.bounds)])
        fold = batch.column(1).to_numpy(zero_copy_only=False)
        scores = np.full((n, len(fits)), np.nan)
        for j, (params, own_fold, base, trees) in enumerate(fits):
            rows = np.flatnonzero(fold == own_fold) if own_fold is not None else np.arange(n)
            scores[rows, j] = _add(np.full(len(rows), base), bins.take(rows, axis=1), trees, params)
        lists = pa.ListArray.from_arrays(np.arange(0, scores.size + 1, len(fits), dtype=np.int32), scores.ravel())
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], lists], names=names)


def scored(df: DataFrame, fits: list[Fit], edges: Edges) -> DataFrame:
    """``df`` without its vectors and with ``scores``: the value of every fit, for the fits of a fold NaN on rows outside it."""
    plain = [(f.params, f.fold, f.base, _light({0: f.trees[: f.best()]})[0]) for f in fits]
    shared = df.sparkSession.sparkContext.broadcast(plain)  # as large as the models
    kept = [c for c in df.columns if c != "features"]
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
    rows = df.select(vector_to_array("features").alias("x"), fold.alias("_fold"), *kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(lambda batches: _scored(batches, edges, shared.value), f"{schema}, scores array<double>")


def as_model(spark, fit: Fit, edges: Edges, target: str = S.TARGET) -> GBTRegressionModel:
    """Spark's model of the fit: a constant, then the kept trees times the rate."""
    trees = [None, *fit.trees[: fit.best()]]
    rows = []
    for t, tree in enumerate(trees):
        if tree is None:
            rows.append((t, (0, fit.base, 0.0, [float(fit.trained), 0.0, 0.0], fit.trained, -1.0, -1, -1, (-1, [], -1))))
            continue
        nodes = sorted(tree["stats"]) or [0]
        place = {node: i for i, node in enumerate(nodes)}
        for node in nodes:
            gain, g, n = tree["stats"].get(node, (0.0, 0.0, 0))
            feature = int(tree["feature"][node])
            split = feature >= 0
            bound = edges.bounds[feature][tree["bin"][node]] if split else 0.0
            rows.append((t, (
                place[node], float(tree["value"][node]), 0.0, [float(n), g, 0.0], n, gain / max(n, 1) if split else -1.0,
                place[2 * node + 1] if split else -1, place[2 * node + 2] if split else -1,
                (feature, [float(bound)], -1) if split else (-1, [], -1),
            )))
    path = new_path(spark, "boosted-model")
    names = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"]
    parts = ["featureIndex", "leftCategoriesOrThreshold", "numCategories"]
    kinds = [pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(),
             pa.struct(list(zip(parts, [pa.int32(), pa.list_(pa.float64()), pa.int32()])))]
    nodes = [dict(zip(names, (*node[:-1], dict(zip(parts, node[-1]))))) for _, node in rows]
    table = pa.table({
        "treeID": pa.array([t for t, _ in rows], pa.int32()), "nodeData": pa.array(nodes, pa.struct(list(zip(names, kinds)))),
    })
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/data")
    own = GBTRegressor(labelCol=target, maxIter=len(trees), maxDepth=fit.params.depth, stepSize=fit.params.rate)

    def described(kind: str, uid: str, **more) -> str:
        defaults = {p.name: own.getOrDefault(p) for p in own.params if own.hasDefault(p) and (kind[0] == "G" or p.name in shared)}
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid,
            "paramMap": {"labelCol": target, "maxDepth": fit.params.depth}, "defaultParamMap": defaults, **more,
        })

    shared = {
        "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
        "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed",
    }
    metadata = described("GBTRegressionModel", own.uid, numFeatures=len(edges.bounds), numTrees=len(trees))
    spark.createDataFrame([(metadata,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    weights = [(t, described("DecisionTreeRegressionModel", f"{own.uid}_{t}"), 1.0 if t == 0 else fit.params.rate)
               for t in range(len(trees))]
    spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return GBTRegressionModel.load(path)
