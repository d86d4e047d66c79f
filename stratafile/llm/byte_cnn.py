"""A byte-level convolutional network in numpy that scores the quality of whole documents.

Bytes are embedded; learned filters of eight bytes slide over the document in steps of two; their responses are
max-pooled over overlapping chunks of 256 bytes (a new one every 128) that cover the whole document; a hidden layer looks
at each chunk, its units are max-pooled over all chunks, and a logistic unit makes one probability of them. A document's
score doesn't depend on the documents beside it.

It is fitted with Adam on a bounded sample (FIT_ROWS documents of each class, of at most FIT_BYTES bytes; documented
parameters). The fitted network is a few kilobytes. Scoring is one pass over whole texts, without a shuffle; long texts
go through in pieces of bounded size.

Defined results: a null or empty text is one chunk of padding and scores what the network says of it; without labelled
rows of both classes every score is the share of label 1 (0 if there are none); repeated rows score alike; an empty table
gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.llm.labelled import fold, sample
from stratafile.llm.words import rounds, text_bytes

EMBED, WIDTH, STEP, FILTERS, HIDDEN = 8, 8, 2, 32, 16
HALF = 128  # chunks are two halves long and begin at every half
PIECE = 2048  # halves that go through the filters at once
FIT_ROWS, FIT_BYTES = {1: 2000, 0: 2000}, 16 << 10
FOLDS, HELD_OUT, CUT = 3, 1, 0.5

Network = dict[str, np.ndarray]


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each filled with zeros to whole halves, a filter's width of them at least; and the
    first half of each text."""
    sizes = np.diff(offsets)
    halves = (sizes + WIDTH + HALF - 1) // HALF
    first = np.append(0, np.cumsum(halves))
    out = np.zeros(first[-1] * HALF + WIDTH, np.uint8)
    for a, b, h in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first[:-1].tolist(), strict=True):
        out[h * HALF : h * HALF + b - a] = data[a:b]
    return out, first


def _columns(net: Network, piece: np.ndarray) -> np.ndarray:
    """Embedded windows, a row for each filter position."""
    embedded = net["embed"][piece]
    windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=0)[:: STEP]
    return np.ascontiguousarray(windows.transpose(0, 2, 1)).reshape(len(windows), WIDTH * EMBED)


def half_maxima(net: Network, buffer: np.ndarray, first: np.ndarray, where: bool = False):
    """Largest response of each filter in each half; with ``where`` also its position in the half. Windows that reach
    from the padding of a text into the next don't count."""
    halves = int(first[-1])
    last = np.zeros(halves, bool)
    last[first[1:] - 1] = True
    top, at = np.empty((halves, FILTERS), np.float32), np.empty((halves, FILTERS), np.int64)
    for a in range(0, halves, PIECE):
        b = min(a + PIECE, halves)
        piece = buffer[a * HALF : b * HALF + WIDTH - STEP]
        response = (_columns(net, piece) @ net["filters"]).reshape(b - a, HALF // STEP, FILTERS)
        response[last[a:b], 1 - WIDTH // STEP :] = -np.inf
        if where:
            at[a:b] = response.argmax(1)
            top[a:b] = np.take_along_axis(response, at[a:b, None], 1)[:, 0]
        else:
            top[a:b] = response.max(1)
    top += net["bias"]
    return (top, at) if where else top


def forward(net: Network, top: np.ndarray, first: np.ndarray):
    """Logits of the texts from the halves' maxima, and what the way back needs."""
    last = np.zeros(len(top), bool)
    last[first[1:] - 1] = True
    follow = np.append(top[1:], top[-1:], axis=0)
    take_next = (follow > top) & ~last[:, None]  # a text's last chunk is its last half alone
    chunk = np.maximum(np.where(take_next, follow, top), 0)
    hidden = np.maximum(chunk @ net["mix"] + net["mix_bias"], 0)
    pooled = np.maximum.reduceat(hidden, first[:-1], axis=0)
    return pooled @ net["out"] + net["out_bias"], (take_next, chunk, hidden, pooled)


def logits(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if len(offsets) < 2:
        return np.zeros(0)
    buffer, first = padded(data, offsets)
    return forward(net, half_maxima(net, buffer, first), first)[0]


def gradients(net: Network, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> tuple[Network, float]:
    """Of the mean log loss. Max-pooling sends each text's error to few positions, so the way back is cheap."""
    buffer, first = padded(data, offsets)
    top, at = half_maxima(net, buffer, first, where=True)
    z, (take_next, chunk, hidden, pooled) = forward(net, top, first)
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    error = ((p - y) / len(y)).astype(np.float32)
    grad = {"out": pooled.T @ error, "out_bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * net["out"][None, :]
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    is_top = (hidden == pooled[owner]) & (hidden > 0)
    ties = np.maximum(np.add.reduceat(is_top.astype(np.float32), first[:-1], axis=0), 1)
    d_hidden = np.where(is_top, (d_pooled / ties)[owner], 0).astype(np.float32)
    rows = np.flatnonzero(d_hidden.any(1))
    grad["mix"], grad["mix_bias"] = chunk[rows].T @ d_hidden[rows], d_hidden[rows].sum(0)
    d_chunk = d_hidden[rows] @ net["mix"].T
    d_chunk[chunk[rows] <= 0] = 0
    half = rows[:, None] + take_next[rows]
    r, f = np.nonzero(d_chunk)
    values, half = d_chunk[r, f], half[r, f]
    start = half * HALF + at[half, f] * STEP
    window = buffer[start[:, None] + np.arange(WIDTH)]
    columns = net["embed"][window].reshape(len(r), WIDTH * EMBED)
    grad["filters"] = np.zeros_like(net["filters"])
    back = np.zeros((len(r), WIDTH * EMBED), np.float32)
    for k in range(FILTERS):
        own = f == k
        grad["filters"][:, k] = values[own] @ columns[own]
        back[own] = values[own, None] * net["filters"][None, :, k]
    grad["bias"] = np.bincount(f, values, FILTERS).astype(np.float32)
    grad["embed"] = np.zeros_like(net["embed"])
    np.add.at(grad["embed"], window.reshape(-1), back.reshape(-1, EMBED))
    loss = float(-np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)))
    return grad, loss


def untrained(rng: np.random.Generator) -> Network:
    return {
        "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        "filters": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "mix": rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)).astype(np.float32),
        "mix_bias": np.full(HIDDEN, 0.1, np.float32),
        "out": rng.normal(0, 0.5, HIDDEN).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def fit(texts: list[bytes], y: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.004, steps: int = 600, seed: int = 5) -> Network:
    """Adam on the log loss over whole texts; at least ``steps`` steps, with a falling rate."""
    rng = np.random.default_rng(seed)
    net = untrained(rng)
    mean, square = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    epochs = max(epochs, -(-steps * batch // max(1, len(y))))
    total, t = epochs * -(-len(y) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            parts = [texts[r] for r in rows]
            offsets = np.append(0, np.cumsum([len(x) for x in parts]))
            grad, _ = gradients(net, np.frombuffer(b"".join(parts), np.uint8), offsets, y[rows])
            t += 1
            now = rate * min(1.0, 2 * (1 - t / (total + 1)))
            for k, g in grad.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                net[k] -= (now * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def constant(share: float) -> Network:
    """A network that gives every text one score."""
    net = {k: np.zeros_like(v) for k, v in untrained(np.random.default_rng(0)).items()}
    net["out_bias"][:] = np.log((share + 1e-9) / (1 - share + 1e-9))
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network:
    """The network fitted to the bounded sample, on the driver."""
    texts, counts = sample(docs, labels, label, FOLDS, HELD_OUT, FIT_ROWS, FIT_BYTES)
    rows = sorted(texts.collect(), key=lambda r: r["doc_id"])
    y = np.array([r["y"] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return constant(counts.get(1, 0) / max(1, sum(counts.values())))
    return fit([(r["text"] or "").encode() for r in rows], y)


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every document."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rounds(batches, limit=1 << 20):
            z = logits(model.value, *text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z.astype(float), -40, 40))))], ["doc_id", "score"])

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(score, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns, one row per document."""
    df = scored(docs, train(docs, labels))
    return df.select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
