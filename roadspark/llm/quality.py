"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters read eight bytes at every second byte. Their responses are
averaged and maximised over chunks of 128 bytes that overlap by half and cover
the whole text; a hidden layer reads each chunk, its units are max-pooled over
all chunks, and one logistic unit combines them.

The network is fitted on the driver to a bounded sample of labelled texts and
sent to the executors with the function that scores. Scores come from the bytes
of the text alone. Null and empty texts are scored as one chunk of padding,
equal texts get equal scores, texts are read in blocks whatever their length,
and an empty table gives an empty result. Without labels of both kinds every
text gets 0.5. Other columns are ignored or, by ``keep_good``, passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from roadspark.llm.rows import packed, unpacked

THRESHOLD = 0.7
# Rows of this remainder of crc32(doc_id) by FOLDS are never learned from.
HELD_OUT, FOLDS = 2, 4
# Bounds of the sample: labelled texts per class, and the bytes of the longest one.
PER_CLASS, LONGEST = (500, 700), 12_000
FILTERS, HIDDEN, WIDTH = 16, 24, 8
# Positions of half a chunk; a position is two bytes.
HALF = 32
# Half chunks read at once.
BLOCK = 2048


def held_out(doc_id: str = "doc_id"):
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS == HELD_OUT


def _padded(text: bytes) -> np.ndarray:
    """Bytes with zeros up to whole half chunks, at least two, and the last window's overhang."""
    step = 2 * HALF
    halves = max(2, -(-len(text) // step))
    out = np.zeros(halves * step + WIDTH, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


class ByteNetwork:
    """Parameters and layers; ``filters`` holds a row per byte offset and byte value."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.parameters = {
            "filters": draw(WIDTH, 256, FILTERS, scale=0.35),
            "bias": np.zeros(FILTERS, np.float32),
            "mix": draw(2 * FILTERS, HIDDEN, scale=0.3),
            "mix_bias": np.full(HIDDEN, 0.1, np.float32),
            "out": draw(HIDDEN, scale=0.2),
            "out_bias": np.zeros(1, np.float32),
        }
        self._pairs = None

    def _responses(self, data: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Filter responses at byte positions, one table per offset."""
        p = self.parameters
        total = np.repeat(p["bias"][None], len(positions), axis=0)
        for k in range(WIDTH):
            total += p["filters"][k][data[positions + k]]
        return np.maximum(total, 0, out=total)

    def __getstate__(self):
        return {"parameters": self.parameters, "_pairs": None}

    def _paired(self, data: np.ndarray) -> np.ndarray:
        """The same at every second byte, with one table per pair of offsets."""
        p = self.parameters
        if self._pairs is None:
            self._pairs = [
                (p["filters"][k][:, None, :] + p["filters"][k + 1][None, :, :]).reshape(65536, FILTERS)
                for k in range(0, WIDTH, 2)
            ]
        pair = data[: len(data) // 2 * 2].reshape(-1, 2).astype(np.int32)
        pair = pair[:, 0] * 256 + pair[:, 1]
        n = len(pair) - WIDTH // 2
        total = self._pairs[0][pair[:n]]
        for k in range(1, WIDTH // 2):
            total += self._pairs[k][pair[k : k + n]]
        total += p["bias"]
        return np.maximum(total, 0, out=total)

    @staticmethod
    def _chunks(responses: np.ndarray) -> np.ndarray:
        """Mean and maximum of every filter over every two neighbouring half chunks."""
        halves = responses.reshape(-1, HALF, FILTERS)
        mean, most = halves.mean(axis=1), halves.max(axis=1)
        return np.concatenate([(mean[1:] + mean[:-1]) / 2, np.maximum(most[1:], most[:-1])], axis=1)

    def _hidden(self, chunks: np.ndarray) -> np.ndarray:
        p = self.parameters
        return np.maximum(chunks @ p["mix"] + p["mix_bias"], 0)

    def score(self, text: bytes) -> float:
        data = _padded(text)
        step = 2 * HALF
        halves = (len(data) - WIDTH) // step
        most = np.zeros(HIDDEN, np.float32)
        # Blocks share one half chunk, so that every pair of neighbours is seen.
        for at in range(0, halves - 1, BLOCK):
            last = min(halves, at + BLOCK + 1)
            responses = self._paired(data[at * step : last * step + WIDTH])
            most = np.maximum(most, self._hidden(self._chunks(responses)).max(axis=0))
        logit = float(most @ self.parameters["out"] + self.parameters["out_bias"][0])
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

    def _gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss, through the chunks that the maxima come from."""
        p = self.parameters
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        pieces = [_padded(t) for t in texts]
        picked, slope, owner = [], [], []
        for i, data in enumerate(pieces):
            chunks = self._chunks(self._paired_now(data))
            hidden = self._hidden(chunks)
            top = hidden.argmax(axis=0)
            value = hidden[top, np.arange(HIDDEN)]
            logit = float(value @ p["out"] + p["out_bias"][0])
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[i]) * weights[i]
            grads["out"] += error * value
            grads["out_bias"] += error
            back = np.where(value > 0, error * p["out"], 0).astype(np.float32)
            grads["mix_bias"] += back
            rows, place = np.unique(top, return_inverse=True)
            unit = np.zeros((len(rows), HIDDEN), np.float32)
            unit[place, np.arange(HIDDEN)] = back
            grads["mix"] += chunks[rows].T @ unit
            picked.append(rows)
            slope.append(unit @ p["mix"].T)
            owner.append(np.full(len(rows), i))
        within = 2 * np.arange(2 * HALF)
        data = np.concatenate(pieces)
        begin = np.cumsum([0, *[len(d) for d in pieces[:-1]]])
        at = begin[np.concatenate(owner)] + np.concatenate(picked) * 2 * HALF
        positions = (at[:, None] + within).ravel()
        responses = self._responses(data, positions).reshape(len(at), 2 * HALF, FILTERS)
        slope = np.concatenate(slope)
        back = np.repeat(slope[:, None, :FILTERS] / (2 * HALF), 2 * HALF, axis=1)
        chunk, unit = np.meshgrid(np.arange(len(at)), np.arange(FILTERS), indexing="ij")
        back[chunk, responses.argmax(axis=1), unit] += slope[:, FILTERS:]
        back = np.where(responses > 0, back, 0).reshape(-1, FILTERS)
        grads["bias"] += back.sum(axis=0)
        cell = np.arange(FILTERS)
        for k in range(WIDTH):
            index = (data[positions + k].astype(np.int64)[:, None] * FILTERS + cell).ravel()
            grads["filters"][k] += np.bincount(index, back.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        return grads

    def _paired_now(self, data: np.ndarray) -> np.ndarray:
        return self._responses(data, np.arange(0, len(data) - WIDTH, 2))

    def fit(self, texts: list[bytes], labels: list[int], steps: int = 280, batch: int = 32, rate: float = 0.01) -> None:
        """Adam on the log loss, both classes weighing the same, in whole rounds of about ``steps`` in all."""
        y = np.array(labels, np.float64)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        rng = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        second = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        batches = -(-len(texts) // batch)
        rounds = -(-steps // batches)
        done, total = 0, rounds * batches
        for _ in range(rounds):
            for rows in np.array_split(rng.permutation(len(texts)), batches):
                done += 1
                grads = self._gradients([texts[r] for r in rows], y[rows], weight[rows])
                pace = rate * min(1.0, 2 * (1 - done / total) + 0.05)
                for k, g in grads.items():
                    g = g / len(rows)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    step = first[k] / (1 - 0.9**done) / (np.sqrt(second[k] / (1 - 0.99**done)) + 1e-6)
                    self.parameters[k] -= (pace * step).astype(np.float32)
        self._pairs = None


def training_sample(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, longest: int = LONGEST):
    """Texts and labels of a bounded sample of the labelled rows that may be learned from.

    The rows of each class with the smallest hashes of their ids; texts beyond
    ``longest`` bytes are passed over.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = []
    for label, n in enumerate(per_class):
        own = usable.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen += [tuple(r) for r in own.collect()]
    known = dict(chosen)
    rows = (
        docs.where(F.col("doc_id").isin([*known]) & F.col("text").isNotNull() & (F.octet_length("text") <= longest))
        .select("doc_id", F.col("text").cast("string").alias("text")).limit(4 * len(known) + 1).collect()
        if known else []
    )
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    return [r["text"].encode("utf-8") for r in rows], [known[r["doc_id"]] for r in rows]


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> ByteNetwork | None:
    """A network fitted to the sample, or nothing if it lacks one of the classes."""
    texts, marks = training_sample(docs, labels, **bounds)
    if len(set(marks)) < 2:
        return None
    network = ByteNetwork()
    network.fit(texts, marks)
    return network


def _scored(batches: Iterator[pa.RecordBatch], network: ByteNetwork | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = (batch.column("_text") if "_text" in batch.schema.names else batch.column("_doc").field("text")).to_pylist()
        scores = [0.5 if network is None else network.score((t or "").encode("utf-8")) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(scores, pa.float64())], names=["_doc", "_score"])


def scored(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """``_doc``, the whole row, and ``_score``, the probability of label 1."""
    # A text goes to the worker once, inside its row, unless it has to be cast.
    whole = dict(docs.dtypes).get("text") == "string"
    rows = packed(docs) if whole else packed(docs, F.col("text").cast("string").alias("_text"))
    schema = StructType([rows.schema["_doc"]]).add("_score", DoubleType())
    return rows.mapInArrow(lambda batches: _scored(batches, network), schema)


def keep_good(docs: DataFrame, network: ByteNetwork | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score reaches the threshold; all columns stay."""
    return unpacked(scored(docs, network).where(F.col("_score") >= threshold), docs.columns)


def op1_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = scored(docs.select("doc_id", "text"), network)
    return out.select(
        "_doc.doc_id", held_out("_doc.doc_id").alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
