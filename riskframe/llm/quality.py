"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over chunks that overlap and cover the whole text, each chunk keeps every filter's
maximum, a small hidden layer turns a chunk into a score, and the largest and the mean chunk score
combine into one probability. Scoring walks through a text chunk by chunk; beside the text itself that
takes about three bytes for each of its bytes.

The network is fitted on the driver on a bounded sample of labelled rows: at most
``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES`` bytes, taken in the order of a hash of the id. Rows whose CRC-32 of the id
is divisible by ``FOLDS`` are held out and never learned from. Only the text is an input of a score.

Defined results: NULL and empty texts are one empty chunk and get a score like any
other; repeated ids among the labels add one example each; without usable labels
(or with one class only) every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import clean_text, plain
from riskframe.llm.words import pieces, text_buffer

FOLDS = 5
#: Bounds of the training sample.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 6 << 20
CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, FILTERS, HIDDEN = 6, 6, 32, 16
ROUNDS, BATCH, RATE = 8, 32, 0.004
ACCEPT = 0.3
PAD = 256
#: Chunks that are convolved at once.
TOGETHER = 64


def chunk_bytes(data: np.ndarray) -> np.ndarray:
    """A text's bytes as rows of ``CHUNK`` with an overlap; the rest of the last row is padding."""
    step = CHUNK - OVERLAP
    rows = max(1, -(-max(0, len(data) - OVERLAP) // step))
    out = np.full((rows - 1) * step + CHUNK, PAD, np.int16)
    out[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::step]


class ByteNet:
    """Parameters and passes of the network. All sums are float32."""

    NAMES = ("embed", "filters", "bias", "w1", "b1", "w2", "b2", "mix")

    def __init__(self, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        f32 = lambda a: a.astype(np.float32)
        self.embed = f32(r.normal(0, 0.5, (PAD + 1, EMBED)))
        self.embed[PAD] = 0
        self.filters = f32(r.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)))
        self.bias = f32(np.zeros(FILTERS))
        self.w1 = f32(r.normal(0, (FILTERS + 1) ** -0.5, (FILTERS + 1, HIDDEN)))
        self.b1 = f32(np.zeros(HIDDEN))
        self.w2 = f32(r.normal(0, HIDDEN**-0.5, HIDDEN))
        self.b2 = f32(np.zeros(1))
        self.mix = f32(np.array([0.0, 1.0, 0.5]))  # constant, weight of the least and of the mean chunk score
        self.constant: float | None = None

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter over each chunk, and where it was."""
        top = np.zeros((len(chunks), FILTERS), np.float32)
        place = np.zeros((len(chunks), FILTERS), np.int64)
        spans = CHUNK - WIDTH + 1
        for low in range(0, len(chunks), TOGETHER):
            part = self.embed[chunks[low : low + TOGETHER]]
            n = len(part)
            flat = np.ascontiguousarray(part).reshape(n, CHUNK * EMBED)
            view = np.lib.stride_tricks.as_strided(
                flat, (n, spans, WIDTH * EMBED), (flat.strides[0], EMBED * flat.strides[1], flat.strides[1])
            )
            out = (np.ascontiguousarray(view).reshape(n * spans, -1) @ self.filters).reshape(n, spans, FILTERS)
            place[low : low + n] = out.argmax(axis=1)
            top[low : low + n] = np.take_along_axis(out, place[low : low + n][:, None, :], 1)[:, 0]
        return np.maximum(top + self.bias, 0), place

    def tops(self, chunks: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places."""
        top = np.zeros((len(chunks), FILTERS), np.float32)
        spans = CHUNK - WIDTH + 1
        for low in range(0, len(chunks), TOGETHER):
            part = self.embed[chunks[low : low + TOGETHER]]
            n = len(part)
            out = part[:, :spans].reshape(n * spans, EMBED) @ self.filters[:EMBED]
            for w in range(1, WIDTH):
                out += part[:, w : w + spans].reshape(n * spans, EMBED) @ self.filters[w * EMBED : (w + 1) * EMBED]
            top[low : low + n] = out.reshape(n, spans, FILTERS).max(axis=1)
        return np.maximum(top + self.bias, 0)

    def chunk_scores(self, top: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.concatenate([top, filled[:, None]], axis=1).astype(np.float32)
        hidden = np.maximum(x @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2, hidden, x

    def logits(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One logit per text; ``first`` are the texts' first chunks."""
        counts = np.diff(np.append(first, len(scores)))
        worst = np.minimum.reduceat(scores, first)
        return self.mix[0] + self.mix[1] * worst + self.mix[2] * np.add.reduceat(scores, first) / counts

    def probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        scores, first, total = [], [], 0
        for data in texts:
            chunks = chunk_bytes(data)
            filled = (chunks != PAD).mean(axis=1)
            scores.append(self.chunk_scores(self.tops(chunks), filled)[0])
            first.append(total)
            total += len(chunks)
        return _sigmoid(self.logits(np.concatenate(scores), np.array(first)).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(texts: list[bytes], labels: list[int], rounds: int = ROUNDS, seed: int = 5) -> ByteNet:
    """Fits the network by Adam on the logistic loss; gradients flow through each chunk's maxima only."""
    net = ByteNet()
    share = sum(labels) / len(labels) if labels else 0.5
    if share in (0.0, 1.0) or not labels:
        net.constant = float(share)
        return net
    r = np.random.default_rng(seed)
    moments = {name: [np.zeros_like(getattr(net, name)), np.zeros_like(getattr(net, name))] for name in net.NAMES}
    y = np.array(labels, np.float32)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) ** 0.5
    data = [np.frombuffer(t, np.uint8) for t in texts]
    step, total = 0, rounds * -(-len(data) // BATCH)
    for _ in range(rounds):
        order = r.permutation(len(data))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            grads = _gradients(net, [data[i] for i in some], y[some], weight[some])
            rate = RATE * (1 - (step - 1) / total)
            for name in net.NAMES:
                m, v = moments[name]
                g = grads[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                getattr(net, name)[...] -= change
            net.embed[PAD] = 0
    return net


def _gradients(net: ByteNet, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    parts = [chunk_bytes(t) for t in texts]
    counts = np.array([len(p) for p in parts])
    first = np.cumsum(counts) - counts
    chunks = np.concatenate(parts)
    top, place = net.pooled(chunks)
    scores, hidden, x = net.chunk_scores(top, (chunks != PAD).mean(axis=1))
    worst, mean = np.minimum.reduceat(scores, first), np.add.reduceat(scores, first) / counts
    d = (_sigmoid(net.mix[0] + net.mix[1] * worst + net.mix[2] * mean) - y) * weight / len(y)
    text = np.repeat(np.arange(len(texts)), counts)
    is_worst = scores == worst[text]
    ties = np.add.reduceat(is_worst.astype(np.float32), first)
    ds = d[text] * (net.mix[1] * is_worst / ties[text] + net.mix[2] / counts[text])
    dh = np.outer(ds, net.w2) * (hidden > 0)
    dtop = (dh @ net.w1.T)[:, :FILTERS] * (top > 0)
    grads = {
        "mix": np.array([d.sum(), (d * worst).sum(), (d * mean).sum()]),
        "w2": hidden.T @ ds, "b2": np.array([ds.sum()]), "w1": x.T @ dh, "b1": dh.sum(axis=0), "bias": dtop.sum(axis=0),
    }
    rows, which = np.nonzero(dtop)
    slope = dtop[rows, which]
    spots = chunks[rows[:, None], place[rows, which][:, None] + np.arange(WIDTH)]  # bytes under each maximum
    seen = net.embed[spots].reshape(len(rows), -1)
    df = np.zeros_like(net.filters.T)
    np.add.at(df, which, seen * slope[:, None])
    de = np.zeros_like(net.embed)
    np.add.at(de, spots.ravel(), (net.filters.T[which] * slope[:, None]).reshape(-1, EMBED))
    return grads | {"filters": df.T, "embed": de}


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether the id's row is kept from training; a NULL id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES
) -> tuple[list[bytes], list[int]]:
    """Texts and labels of the bounded sample: both classes by halves, as far as there are as many.

    The ids are drawn first, from ids, labels and lengths alone; only chosen texts reach the driver.
    """
    usable = labels.select(plain("doc_id").alias("id"), plain("quality").cast("int").alias("y"))
    usable = usable.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    texts = docs.select(plain("doc_id").alias("id"), clean_text().alias("text"))
    spark, chosen = docs.sparkSession, []
    lengths = usable.join(texts.select("id", F.octet_length("text").alias("bytes")), "id")
    lengths = lengths.withColumn("draw", F.xxhash64("id", F.lit("quality")))
    for y in (0, 1):
        used = 0
        for r in lengths.filter(F.col("y") == y).orderBy("draw", "id", "bytes").limit(rows // 2).collect():
            if used + r["bytes"] <= size // 2:
                used += r["bytes"]
                chosen.append((r["id"], y))
    if not chosen:
        return [], []
    kind = usable.schema["id"].dataType.simpleString()
    wanted = F.broadcast(spark.createDataFrame(chosen, f"id {kind}, y int").distinct())
    drawn = texts.join(wanted, "id").withColumn("bytes", F.octet_length("text"))
    found = drawn.orderBy(F.xxhash64("id", F.lit("order")), "id", "y", "text").limit(rows).collect()
    out, used = [], 0
    for r in found:  # an id that stands for several texts could pass the bound
        used += r["bytes"]
        if used <= 2 * size:
            out.append((r["text"].encode(), r["y"]))
    return [t for t, _ in out], [y for _, y in out]


def _scorer(model):
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = model.value
        for texts in batches:
            data, offsets = text_buffer(texts)
            out = []
            for low, high in pieces(offsets, 1 << 18):
                out.append(net.probabilities([data[offsets[i] : offsets[i + 1]] for i in range(low, high)]))
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score


def score_quality(docs: DataFrame, net: ByteNet, text: str = "text", output: str = "score") -> DataFrame:
    """Adds the probability of good quality, from the text alone."""
    model = docs.sparkSession.sparkContext.broadcast(net)
    scorer = F.arrow_udf(_scorer(model), "double")
    return docs.withColumn(output, scorer(clean_text(text)))


def fit_quality(docs: DataFrame, labels: DataFrame) -> ByteNet:
    return train(*training_rows(docs, labels))


def keep_good(docs: DataFrame, net: ByteNet, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Documents that score at least ``accept``, with their own columns."""
    return score_quality(docs, net, text, "__score").filter(F.col("__score") >= accept).drop("__score")
