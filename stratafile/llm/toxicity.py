"""Toxicity by a factorization machine over hashed terms.

A document's terms are its lower-cased words and the first four, five and six bytes of each, hashed into a fixed number
of slots; a term counts once. The score is sigmoid(w0 + sum of w_i + pairwise part), where the pairwise part sums the
products of the terms' factor vectors over all pairs (as half of squared sum less sum of squares, divided by the root of
the number of terms): what two terms say together and neither says alone.

It is fitted on a bounded sample (at most FIT_ROWS documents of each class, of at most FIT_BYTES bytes; both
documented parameters), which is less than 200 MB of slots. Weights and factors have a decay of their own: the weights'
keeps chance terms small, the factors' is weak, since their steps begin small and end at zero if decay outweighs them.
Scores are those of the sample's mix of classes, in which toxic rows weigh more than in the table. The model's size is
fixed by its slots, so broadcasting it is bounded. Scoring is one pass over whole texts, without a shuffle.

Defined results: a null or empty text has no terms and scores what the intercept says; without labelled rows of both
classes every score is the share of label 1 (0 if there are none); repeated rows score alike; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafile.llm.labelled import fold, sample
from stratafile.llm.words import LOWER, U64, mixed, rounds, span_hashes, spans, text_bytes

SLOT_BITS, FACTORS = 19, 8
FIT_ROWS, FIT_BYTES = {1: 4000, 0: 8000}, 8 << 10
FOLDS, HELD_OUT, CUT = 4, 2, 0.3
PREFIXES = (4, 5, 6)
LEAST_SHARE, LEAST_DOCS = 1e-3, 3  # a term of fewer documents of the sample has no weight
LEAST_EPOCHS, STEPS, FIT_VISITS = 6, 2000, 120_000  # the last one bounds the documents gone through

#: ASCII letters, digits and all bytes of other characters make words.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of all texts in one array, and where each text's begin (one more than texts)."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = spans(data, offsets, NOT_WORD)
    docs = np.repeat(np.arange(len(offsets) - 1, dtype=U64), np.diff(first))
    keys = []
    for length in (None, *PREFIXES):
        if length is None:
            a, b, d, seed = starts, ends, docs, 0
        else:
            long = ends - starts > length
            a, d, seed = starts[long], docs[long], length
            b = a + length
        slot = mixed(span_hashes(data, a, b), seed) >> U64(64 - SLOT_BITS)
        keys.append((d << U64(SLOT_BITS)) | slot)
    keys = np.sort(np.concatenate(keys))
    if len(keys):
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
    cuts = np.searchsorted(keys, np.arange(len(offsets), dtype=U64) << U64(SLOT_BITS))
    return (keys & U64((1 << SLOT_BITS) - 1)).astype(np.int32), cuts


@dataclass
class Machine:
    intercept: float
    linear: np.ndarray  # slots
    factors: np.ndarray  # slots x FACTORS

    def logits(self, slots: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return self.intercept + _parts(self.linear, self.factors, slots, cuts)[0]

    def scores(self, slots: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(slots, cuts), -40, 40)))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, empty ones too."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[cuts[1:]] - total[cuts[:-1]]


def _parts(linear: np.ndarray, factors: np.ndarray, slots: np.ndarray, cuts: np.ndarray, sizes: np.ndarray | None = None):
    v = factors[slots]
    scale = 1.0 / np.sqrt(np.maximum(np.diff(cuts) if sizes is None else sizes, 1))
    sums = _sums(v, cuts)
    pairs = 0.5 * ((sums * sums).sum(1) - _sums((v * v).sum(1), cuts)) * scale
    return _sums(linear[slots], cuts) + pairs, sums, v, scale


def fit(
    slots: np.ndarray, cuts: np.ndarray, y: np.ndarray, counts: dict[int, int], batch: int = 256, rate: float = 0.1, factor_rate: float = 0.2,
    decay: float = 0.5, factor_decay: float = 0.25, seed: int = 7,
) -> Machine:
    """Adagrad on the log loss, over the sample's terms in slots 0 .. 2**SLOT_BITS - 1. Small samples are gone through
    more often; terms of few documents are counted, but have neither weight nor factors."""
    linear, factors = np.zeros(1 << SLOT_BITS, np.float32), np.zeros((1 << SLOT_BITS, FACTORS), np.float32)
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    n = len(y)
    if not n or y.min() == y.max():
        return Machine(float(np.log((share + 1e-9) / (1 - share + 1e-9))), linear, factors)
    vocabulary, local, seen = np.unique(slots, return_inverse=True, return_counts=True)
    often = seen >= max(LEAST_DOCS, LEAST_SHARE * n)
    keep = often[local]
    own_of, cuts_of = (np.cumsum(often) - 1)[local[keep]].astype(np.int32), np.append(0, np.cumsum(keep))[cuts]
    vocabulary, terms_of, size = vocabulary[often], np.diff(cuts), int(often.sum())
    rng = np.random.default_rng(seed)
    batch = min(batch, max(32, n // 24))
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
    b, gw, gv, gb = float(np.log(y.mean() / (1 - y.mean()))), np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(max(LEAST_EPOCHS, min(-(-STEPS * batch // n), FIT_VISITS // n))):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows = order[at : at + batch]
            sizes = cuts_of[rows + 1] - cuts_of[rows]
            own = np.concatenate([own_of[cuts_of[r] : cuts_of[r + 1]] for r in rows.tolist()])
            z, sums, vi, scale = _parts(w, v, own, np.append(0, np.cumsum(sizes)), terms_of[rows])
            error = (1 / (1 + np.exp(-np.clip(z + b, -40, 40))) - y[rows]) / len(rows)
            dw = np.bincount(own, np.repeat(error, sizes), size) + decay * w / len(rows)
            pull = np.repeat(error * scale, sizes)[:, None] * (np.repeat(sums, sizes, axis=0) - vi)
            dv = np.stack([np.bincount(own, pull[:, f], size) for f in range(FACTORS)], 1) + factor_decay * v / len(rows)
            gw += dw * dw
            gv += dv * dv
            gb += error.sum() ** 2
            w -= rate * dw / np.sqrt(gw)
            v -= factor_rate * dv / np.sqrt(gv)
            b -= rate * error.sum() / np.sqrt(gb)
    linear[vocabulary], factors[vocabulary] = w, v
    return Machine(float(b), linear, factors)


def _slot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rounds(batches):
        slots, cuts = terms(batch.column("text"))
        blobs = [slots[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(blobs, pa.binary())], ["doc_id", "y", "slots"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """The machine fitted to the sample. Terms are made on the executors; the bounded sample of them is fitted here."""
    texts, counts = sample(docs, labels, label, FOLDS, HELD_OUT, FIT_ROWS, FIT_BYTES)
    rows = texts.mapInArrow(_slot_batches, "doc_id bigint, y int, slots binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    parts = [np.frombuffer(r["slots"], np.int32) for r in rows]
    cuts = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64)
    slots = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    y = np.array([r["y"] for r in rows], float)
    del rows, parts
    return fit(slots, cuts, y, counts)


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of every document."""
    model = docs.sparkSession.sparkContext.broadcast((machine.intercept, machine.linear, machine.factors))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*model.value)
        for batch in rounds(batches):
            values = own.scores(*terms(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return rows.mapInArrow(score, "doc_id bigint, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns, one row per document."""
    df = scored(docs, train(docs, labels))
    return df.select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
