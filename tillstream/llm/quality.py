"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into overlapping chunks that cover all of it. Every byte enters with a learned
embedding and with how recently the same four bytes were seen; learned filters run over the chunks, their
responses are pooled (maximum and mean) over the text, and a logistic layer makes one probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import from_texts

CHUNK, STEP = 32, 16
EMBEDDING, FILTERS = 8, 24
RECENCY = np.array([16, 64, 512])  # distances to the same four bytes; the last bucket is farther or never
BUCKETS = len(RECENCY) + 1
SAMPLE_DOCS = 2000  # per label: the bound of the labelled sample
SAMPLE_CHUNKS = 64  # of a sampled text, spread over it
EPOCHS, BATCH, RATE = 12, 64, 0.01


def byte_rows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping chunks of a whole text: bytes and recency buckets, zero-padded at the end; one chunk at least."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    recency = np.full(raw.size, BUCKETS - 1, dtype=np.uint8)
    if raw.size >= 4:
        wide = raw.astype(np.uint32)
        code = wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]
        order = np.argsort(code, kind="stable")
        again = np.flatnonzero(code[order[1:]] == code[order[:-1]])
        recency[order[again + 1]] = np.searchsorted(RECENCY, order[again + 1] - order[again])
    chunks = max(1, -(-(raw.size - CHUNK) // STEP) + 1)
    padded = np.zeros((2, (chunks - 1) * STEP + CHUNK), dtype=np.uint8)
    padded[0, :raw.size], padded[1, :raw.size] = raw, recency
    view = np.lib.stride_tricks.sliding_window_view(padded, CHUNK, axis=1)[:, ::STEP]
    return view[0], view[1]


@dataclass
class Network:
    """Weights: byte embedding, filters over (embedding, recency) of a chunk, logistic layer."""

    embedding: np.ndarray
    filters: np.ndarray
    recent: np.ndarray  # filters over the recency buckets, (chunk, bucket, filter)
    bias: np.ndarray
    out: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 3) -> Network:
        r = np.random.default_rng(seed)
        return cls(r.normal(0, 0.5, (256, EMBEDDING)), r.normal(0, 0.08, (CHUNK, EMBEDDING, FILTERS)),
                   r.normal(0, 0.08, (CHUNK, BUCKETS, FILTERS)), np.zeros(FILTERS), r.normal(0, 0.1, 2 * FILTERS), np.zeros(1))

    def responses(self, chunks: np.ndarray, recency: np.ndarray) -> np.ndarray:
        inputs = np.concatenate((self.embedding[chunks], np.eye(BUCKETS, dtype=self.embedding.dtype)[recency]), axis=2)
        weights = np.concatenate((self.filters, self.recent), axis=1).reshape(-1, FILTERS)
        return inputs.reshape(len(chunks), -1) @ weights + self.bias

    def score(self, text: str | None) -> float:
        """Probability of label 1 for a whole text, read in blocks of chunks."""
        chunks, recency = byte_rows(text)
        most, total = np.zeros(FILTERS), np.zeros(FILTERS)
        for at in range(0, len(chunks), 4096):
            hot = np.maximum(self.responses(chunks[at:at + 4096], recency[at:at + 4096]), 0)
            most, total = np.maximum(most, hot.max(axis=0)), total + hot.sum(axis=0)
        z = float(np.concatenate((most, total / len(chunks))) @ self.out + self.offset[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_network(samples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Fit by Adam on (label, chunks, recency) samples. Without both labels the network scores 0.5 everywhere."""
    net = Network.fresh(seed)
    labels = np.array([s[0] for s in samples], dtype=float)
    if not samples or labels.min() == labels.max():
        net.out[:] = 0
        return net
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    names = ["embedding", "filters", "recent", "bias", "out", "offset"]
    for name in names:
        setattr(net, name, getattr(net, name).astype(np.float32))
    moments = {n: [np.zeros_like(getattr(net, n)) for _ in range(2)] for n in names}
    random, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = random.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            step += 1
            grads = _gradients(net, [samples[i] for i in order[at:at + BATCH]], weight[order[at:at + BATCH]])
            for n in names:
                m, v = moments[n]
                m += 0.1 * (grads[n] - m)
                v += 0.001 * (grads[n] ** 2 - v)
                getattr(net, n)[...] -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def _gradients(net: Network, batch: list[tuple], weight: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.array([len(s[1]) for s in batch])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    chunks, recency = np.concatenate([s[1] for s in batch]), np.concatenate([s[2] for s in batch])
    z = net.responses(chunks, recency)
    hot = np.maximum(z, 0)
    top = np.stack([s + hot[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
    pooled = np.concatenate((np.take_along_axis(hot, top, axis=0), np.add.reduceat(hot, starts) / sizes[:, None]), axis=1)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.offset[0], -30, 30)))
    d = (weight * (p - np.array([s[0] for s in batch])) / len(batch)).astype(np.float32)
    dpooled = d[:, None] * net.out
    dhot = np.repeat(dpooled[:, FILTERS:] / sizes[:, None].astype(np.float32), sizes, axis=0)
    np.add.at(dhot, (top, np.arange(FILTERS)), dpooled[:, :FILTERS])
    dz = dhot * (z > 0)
    inputs = np.concatenate((net.embedding[chunks], np.eye(BUCKETS, dtype=np.float32)[recency]), axis=2)
    dw = (inputs.reshape(len(chunks), -1).T @ dz).reshape(CHUNK, EMBEDDING + BUCKETS, FILTERS)
    dx = (dz @ net.filters.reshape(-1, FILTERS).T).reshape(-1, EMBEDDING)
    flat = chunks.ravel()
    dembedding = np.stack([np.bincount(flat, dx[:, k], minlength=256) for k in range(EMBEDDING)], axis=1)
    return {"embedding": dembedding.astype(np.float32), "filters": dw[:, :EMBEDDING], "recent": dw[:, EMBEDDING:],
            "bias": dz.sum(axis=0), "out": pooled.T.astype(np.float32) @ d, "offset": np.array([d.sum()], np.float32)}


def learn_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, chunks: int = SAMPLE_CHUNKS) -> Network:
    """Train on at most ``sample`` documents of each label (those with the smallest hash of their doc_id).

    ``labels`` has (doc_id, quality); rows without either teach nothing, repeated ones count once. Of each
    sampled text ``chunks`` chunks, spread over the whole, reach the driver, so the sample has a fixed bound.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality in (0, 1)").distinct().withColumn("_order", F.xxhash64("doc_id"))
    picked = [known.where(F.col("quality") == q).orderBy("_order", "doc_id").limit(sample) for q in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).drop("_order")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc_id, label, text in zip(f.doc_id, f.quality, f.text):
                raw, recency = byte_rows(text)
                at = np.unique(np.linspace(0, len(raw) - 1, chunks).astype(int))
                rows.append((doc_id, label, raw[at].tobytes(), recency[at].tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "label", "raw", "recency"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * sample rows
    found = texts.mapInPandas(cut, "doc_id long, label int, raw binary, recency binary").orderBy("doc_id", "raw", "label")
    rows = found.limit(4 * sample).collect()
    return train_network([(r["label"], *(np.frombuffer(bytes(b), np.uint8).reshape(-1, CHUNK) for b in (r["raw"], r["recency"])))
                          for r in rows])


def score_quality(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1 from the whole text alone.

    Null text counts as empty and is scored like any other. Rows are judged one by one; other columns do not pass through
    Python, and a column named ``score`` (in any case) is replaced.
    """
    scored = from_texts(F.col(text), lambda: lambda texts: [(float(network.score(t)),) for t in texts], "score double")
    return docs.drop("score").withColumn("score", scored["score"])
