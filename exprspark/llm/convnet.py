"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes become planes: one per byte class, and one per lag that says whether the byte equals the one
so many places before, which shows repetition to filters that could not see it otherwise. Learned filters read
windows of bytes that overlap by half. A long text passes in chunks that overlap by what a window and the largest lag
need, so that the windows are those of the whole text. Per filter, the largest and the mean response over all windows
are combined by a logistic unit into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exprspark.llm.batches import parts
from exprspark.llm.labelled import held_out, sigmoid, training_sample

WIDTH = 16
STRIDE = 8
LAGS = 24
FILTERS = 24
CHUNK_WINDOWS = 4_096
SAMPLE_ROWS = 3_000
SAMPLE_WINDOWS = 1_024
EPOCHS = 8
RATE = 0.02
THRESHOLD = 0.3
SEED = 7


def byte_classes() -> np.ndarray:
    """One row per byte: lower case, upper case, digit, space, line end, stop, other ASCII, above ASCII."""
    table = np.zeros((256, 8), dtype=np.float32)
    for byte in range(256):
        letter = chr(byte)
        if byte >= 128:
            kind = 7
        elif letter.islower():
            kind = 0
        elif letter.isupper():
            kind = 1
        elif letter.isdigit():
            kind = 2
        elif letter == "\n":
            kind = 4
        elif letter.isspace():
            kind = 3
        elif letter in ".,;:?!'\"()-":
            kind = 5
        else:
            kind = 6
        table[byte, kind] = 1.0
    return table


CLASS_OF = byte_classes()
INPUTS = WIDTH * CLASS_OF.shape[1] + LAGS


def window_count(data: np.ndarray) -> int:
    return max(1, -(-max(0, len(data) - WIDTH) // STRIDE) + 1)


def padded_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes of all windows behind ``LAGS`` zero bytes; the last window is filled up with zero bytes."""
    padded = np.zeros(LAGS + (window_count(data) - 1) * STRIDE + WIDTH, dtype=np.uint8)
    padded[LAGS : LAGS + len(data)] = data[: len(padded) - LAGS]
    return padded


def windows_at(data: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Input rows of the windows with these numbers; no others are built."""
    parts = np.lib.stride_tricks.sliding_window_view(padded_bytes(data), LAGS + WIDTH)[numbers * STRIDE]
    own = parts[:, LAGS:]
    rows = np.empty((len(parts), INPUTS), dtype=np.float32)
    planes = WIDTH * CLASS_OF.shape[1]
    rows[:, :planes] = CLASS_OF[own].reshape(len(parts), -1)
    for lag in range(1, LAGS + 1):
        same = (own == parts[:, LAGS - lag : LAGS - lag + WIDTH]) & (own != 0)
        rows[:, planes + lag - 1] = same.sum(axis=1, dtype=np.uint8) * np.float32(1.0 / WIDTH)
    return rows


def windows_of(data: np.ndarray) -> Iterator[np.ndarray]:
    """Input rows of all windows, in chunks."""
    count, padded = window_count(data), padded_bytes(data)
    for first in range(0, count, CHUNK_WINDOWS):
        n = min(CHUNK_WINDOWS, count - first)
        begin = LAGS + first * STRIDE
        part = padded[begin - LAGS : begin + (n - 1) * STRIDE + WIDTH]
        own = part[LAGS:]
        planes = CLASS_OF[own].reshape(-1)
        rows = np.empty((n, INPUTS), dtype=np.float32)
        kinds = CLASS_OF.shape[1]
        rows[:, : WIDTH * kinds] = np.lib.stride_tricks.sliding_window_view(planes, WIDTH * kinds)[:: STRIDE * kinds]
        seen = own != 0
        for lag in range(1, LAGS + 1):
            same = (own == part[LAGS - lag : len(part) - lag]) & seen
            halves = same.reshape(-1, STRIDE).sum(axis=1, dtype=np.uint8)
            rows[:, WIDTH * kinds + lag - 1] = (halves[:-1] + halves[1:]) * np.float32(1.0 / WIDTH)
        yield rows


@dataclass
class Network:
    filters: np.ndarray
    shift: np.ndarray
    head: np.ndarray

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Largest and mean response of each filter, and a constant."""
        most = np.zeros(self.filters.shape[1], dtype=np.float32)
        total = np.zeros(self.filters.shape[1], dtype=np.float64)
        count = 0
        for rows in windows_of(data):
            response = rows @ self.filters
            response += self.shift
            np.maximum(response, 0, out=response)
            most = np.maximum(most, response.max(axis=0))
            total += response.sum(axis=0, dtype=np.float64)
            count += len(rows)
        return np.concatenate([most, total / count, [1.0]])

    def probability(self, data: np.ndarray) -> float:
        return float(sigmoid(self.pooled(data) @ self.head))


def new_network(rng: np.random.Generator) -> Network:
    filters = rng.normal(0, np.sqrt(2.0 / WIDTH), (INPUTS, FILTERS)).astype(np.float32)
    return Network(filters, np.zeros(FILTERS, dtype=np.float32), np.concatenate([rng.normal(0, 0.1, 2 * FILTERS), [0.0]]))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam over single documents; a document longer than ``SAMPLE_WINDOWS`` windows gives so many, chosen anew each time.

    Choosing windows at random bounds the cost of an example; scoring always reads all windows.
    """
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    state = {k: [np.zeros_like(v, dtype=np.float64), np.zeros_like(v, dtype=np.float64)] for k, v in vars(net).items()}
    steps, batch, bags = 0, 16, [np.frombuffer(t, dtype=np.uint8) for t in texts]
    gradient = {k: np.zeros(v.shape) for k, v in vars(net).items()}
    for epoch in range(epochs):
        rate = RATE * (1.0 - epoch / epochs)
        for place, i in enumerate(rng.permutation(len(bags))):
            count = window_count(bags[i])
            if count > SAMPLE_WINDOWS:
                rows = windows_at(bags[i], rng.choice(count, SAMPLE_WINDOWS, replace=False))
            else:
                rows = np.concatenate(list(windows_of(bags[i])))
            response = np.maximum(rows @ net.filters + net.shift, 0)
            top = response.argmax(axis=0)
            pooled = np.concatenate([response.max(axis=0), response.mean(axis=0), [1.0]])
            error = float(sigmoid(pooled @ net.head) - labels[i])
            back = np.repeat((error * net.head[FILTERS:-1] / len(rows))[None, :], len(rows), axis=0).astype(np.float32)
            back[top, np.arange(FILTERS)] += error * net.head[:FILTERS]
            back *= response > 0
            gradient["head"] += error * pooled
            gradient["filters"] += rows.T @ back
            gradient["shift"] += back.sum(axis=0)
            if (place + 1) % batch and place + 1 < len(bags):
                continue
            steps += 1
            for name, value in vars(net).items():
                mean, square = state[name]
                g = gradient[name] / batch + 1e-5 * value
                mean += 0.1 * (g - mean)
                square += 0.001 * (g * g - square)
                moved = (mean / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-8)
                value -= (rate * moved).astype(value.dtype)
                gradient[name][...] = 0
    return net


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """A network from at most ``rows`` labelled documents outside the held-out fold; None where there are none."""
    sample = training_sample(docs, labels, "quality", rows).select("doc_id", "text", "label").toArrow()
    order = np.argsort(sample["doc_id"].to_numpy(), kind="stable")
    if not len(order):
        return None
    texts = [sample["text"][int(i)].as_py().encode() for i in order]
    return train(texts, sample["label"].to_numpy()[order])


def score(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    NULL and empty texts are scored as one window of zero bytes; without any labels every score is 0.5; repeated rows
    score alike; a NULL id is not held out; other columns play no part; an empty table gives an empty result. Nothing
    is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, held, texts in parts(batches, 2):
            p = np.full(len(texts), 0.5)
            if net is not None:
                p = np.array([net.probability(np.frombuffer(t.as_py().encode(), dtype=np.uint8)) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [doc_ids, held, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
