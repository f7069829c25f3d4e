"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of 512 that overlap by 64 and cover
the whole document. Learned filters over six consecutive bytes slide over each
chunk; each filter's largest response in a chunk is kept (max-pooling), and the
document's vector is the largest and the mean response of each filter over its
chunks. One hidden layer turns it into a probability.

Training reads at most ``TRAIN_ROWS`` labelled documents, those with the
smallest hash of their id, and of each the whole text: a bounded, documented
sample, fitted in numpy on the driver, which holds these texts (about 12 MB at
the test tables' lengths) and the responses of 512 chunks at a time. Scoring sees every byte of every document, in tasks
that hold one document's filter responses block by block.

Inputs of a score are the text's bytes only: labels, language, source and id
never enter. Rows whose crc32(id as text) mod 4 is 2 are held out of training.

Defined results: null and empty texts get one chunk of padding, i.e. a constant
score; ids without a label are scored like others; of several labels of an id
the largest counts; null ids are never used to learn; repeated rows give
repeated rows; without any labelled document every score is 0.5; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 6
FILTERS = 16
HIDDEN = 16
CHUNK = 512
STEP = 448
#: Chunks and steps are whole numbers of these.
PART = 64
#: Bound of the training sample: labelled documents, whose texts are read whole.
TRAIN_ROWS = 3000
#: Batches to learn from: eight passes over the full sample, more over a smaller one.
STEPS = 376
BATCH = 64
RATE = 0.01
SEED = 7
THRESHOLD = 0.7
#: Positions whose responses are held at once.
BLOCK = 16384
#: Training chunks whose responses are held at once.
CHUNKS_HELD = 512


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def padded(text: bytes) -> np.ndarray:
    """Bytes with zeros behind, so that the last chunk is whole."""
    b = np.frombuffer(text, dtype=np.uint8)
    chunks = 1 if len(b) <= CHUNK else 1 + -(-(len(b) - CHUNK) // STEP)
    out = np.zeros((chunks - 1) * STEP + CHUNK + WIDTH - 1, dtype=np.uint8)
    out[:len(b)] = b
    return out


def pair_tables(filters: np.ndarray) -> list[np.ndarray]:
    """Responses to each pair of neighbouring bytes: filters (WIDTH, 256, F) as WIDTH / 2 tables."""
    return [np.ascontiguousarray((filters[j][:, None, :] + filters[j + 1][None, :, :]).reshape(65536, -1))
            for j in range(0, WIDTH, 2)]


def chunk_responses(padded_bytes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """(chunks, F): each filter's largest response in every chunk."""
    n = len(padded_bytes) - WIDTH + 1
    pairs = padded_bytes[:-1].astype(np.int32) * 256 + padded_bytes[1:]
    parts = np.empty((n // PART, tables[0].shape[1]), dtype=np.float32)
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        total = tables[0][pairs[low:high]]
        for j in range(1, len(tables)):
            total += tables[j][pairs[low + 2 * j:high + 2 * j]]
        parts[low // PART:high // PART] = total.reshape(-1, PART, total.shape[1]).max(axis=1)
    chunks = (n - CHUNK) // STEP + 1
    at = np.arange(chunks)[:, None] * (STEP // PART) + np.arange(CHUNK // PART)
    return parts[at].max(axis=1)


def document_vector(chunks: np.ndarray) -> np.ndarray:
    r = np.maximum(chunks, 0)
    return np.concatenate([r.max(axis=0), r.mean(axis=0)])


class Network:
    """Filters, hidden layer and output; plain arrays that travel with the tasks."""

    def __init__(self, seed: int = SEED, filters: int = FILTERS, hidden: int = HIDDEN):
        r = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "filters": (r.normal(size=(WIDTH, 256, filters)) * 0.3).astype(f), "bias": np.zeros(filters, f),
            "w1": (r.normal(size=(2 * filters, hidden)) / np.sqrt(2 * filters)).astype(f), "b1": np.zeros(hidden, f),
            "w2": (r.normal(size=hidden) / np.sqrt(hidden)).astype(f), "b2": np.zeros(1, f)}

    def tables(self) -> list[np.ndarray]:
        tables = pair_tables(self.p["filters"])
        tables[0] += self.p["bias"]
        return tables

    def head(self, v: np.ndarray) -> np.ndarray:
        h = np.maximum(v @ self.p["w1"] + self.p["b1"], 0)
        return 1 / (1 + np.exp(-(h @ self.p["w2"] + self.p["b2"][0]).astype(np.float64)))

    def score(self, text: bytes, tables: list[np.ndarray]) -> float:
        return float(self.head(document_vector(chunk_responses(padded(text), tables))))

    def gradients(self, docs: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over documents given as (chunks, CHUNK + WIDTH - 1) bytes."""
        p, tables = self.p, self.tables()
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        b = np.concatenate(docs)
        pairs = b[:, :-1].astype(np.int32) * 256 + b[:, 1:]
        # Of a chunk only the best place of each filter is kept, so long texts need little memory.
        kept = []
        for low in range(0, len(pairs), CHUNKS_HELD):
            part = pairs[low:low + CHUNKS_HELD]
            total = tables[0][part[:, :CHUNK]]
            for j in range(1, len(tables)):
                total += tables[j][part[:, 2 * j:2 * j + CHUNK]]
            at = total.argmax(axis=1)
            kept.append((at, np.take_along_axis(total, at[:, None, :], axis=1)[:, 0, :]))
        where, best = (np.concatenate(x) for x in zip(*kept, strict=True))
        r = np.maximum(best, 0)
        n, f = len(docs), r.shape[1]
        first = np.searchsorted(owner, np.arange(n))
        count = np.bincount(owner, minlength=n)[:, None].astype(np.float32)
        top = np.maximum.reduceat(r, first)
        v = np.concatenate([top, np.add.reduceat(r, first) / count], axis=1)
        a = v @ p["w1"] + p["b1"]
        h = np.maximum(a, 0)
        out = 1 / (1 + np.exp(-(h @ p["w2"] + p["b2"][0])))
        g = ((out - y) / n).astype(np.float32)
        gh = np.outer(g, p["w2"]) * (a > 0)
        gv = gh @ p["w1"].T
        is_top = r == top[owner]
        gr = gv[owner, :f] * is_top / np.maximum(np.add.reduceat(is_top, first)[owner], 1) + gv[owner, f:] / count[owner]
        gr = gr * (best > 0)
        gf = np.zeros_like(p["filters"])
        rows, cols = np.nonzero(gr)
        for j in range(WIDTH):
            np.add.at(gf[j], (b[rows, where[rows, cols] + j], cols), gr[rows, cols])
        return {"filters": gf, "bias": gr.sum(axis=0), "w1": v.T @ gh, "b1": gh.sum(axis=0), "w2": h.T @ g,
                "b2": np.array([g.sum()])}

    def fit(self, docs: list[np.ndarray], y: np.ndarray, steps: int = STEPS, rate: float = RATE,
            seed: int = SEED) -> Network:
        """Adam over shuffled batches; reruns agree."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(x) for k, x in self.p.items()}
        s = {k: np.zeros_like(x) for k, x in self.p.items()}
        t = 0
        while t < steps:
            order = r.permutation(len(docs))
            for low in range(0, len(docs), BATCH):
                pick = order[low:low + BATCH]
                t += 1
                for k, g in self.gradients([docs[i] for i in pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    step = rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-8)
                    self.p[k] = (self.p[k] - step).astype(np.float32)
        return self


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of the whole text."""
    b = padded(text)
    count = (len(b) - WIDTH + 1 - CHUNK) // STEP + 1
    return np.stack([b[c * STEP:c * STEP + CHUNK + WIDTH - 1] for c in range(count)])


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                    text_col: str = "text", rows: int = TRAIN_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Chunks and labels of the sample: at most ``rows`` ids that have a document, by hash, outside the
    held-out rows."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
              .join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
              .orderBy(F.xxhash64("id"), "id").limit(rows))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [chunks_of(t.as_py() or b"").tobytes() for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("y").cast(pa.int64()), pa.array(made, pa.binary())],
                ["id", "y", "chunks"])

    # At most ``rows`` ids and labels: a bounded broadcast.
    found = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
             .join(F.broadcast(chosen), "id").select(F.col("id").cast("string").alias("id"), "y", "t")
             .mapInArrow(cut, "id string, y long, chunks binary")
             # Documents that share an id: one of them is enough.
             .groupBy("id").agg(F.min(F.struct("y", "chunks")).alias("x")).select("id", "x.*").collect())
    found.sort(key=lambda r: r["id"])
    chunks = [np.frombuffer(r["chunks"], dtype=np.uint8).reshape(-1, CHUNK + WIDTH - 1) for r in found]
    return chunks, np.array([r["y"] for r in found], dtype=np.float32)


def trained(docs: DataFrame, labels: DataFrame, **options) -> Network | None:
    """The network fitted on the sample; None if there is nothing to learn from."""
    chunks, y = training_sample(docs, labels, **options)
    return Network().fit(chunks, y) if len(chunks) else None


def scores(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id and score."""
    kind = docs.schema[id_col].dataType.simpleString()
    if network is None:
        return docs.select(F.col(id_col).alias("id"), F.lit(0.5).alias("score"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for batch in batches:
            made = [network.score(t.as_py() or b"", tables) for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.float64())], ["id", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
            .mapInArrow(score, f"id {kind}, score double"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of ``op6``: one row per document."""
    network = trained(docs, labels)
    d = scores(docs.select("doc_id", "text"), network)
    return d.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
