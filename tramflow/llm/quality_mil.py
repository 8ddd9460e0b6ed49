"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded from
its bytes and words; a gated attention layer weighs the passages of a document, and the
weighted sum of their encodings is scored. Only document labels are learned from.

Training runs in numpy on a bounded sample (``PER_CLASS`` rows of each label, of ``MAX_CHARS``
code points at most) whose passages are encoded by the executors. Scoring reads every
whole text, task by task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramflow.llm.common import chunks, held_out, id_and_text, span_hashes, text_bytes, training_rows, word_spans

PASSAGE_WORDS = 48
PER_CLASS = 1500
MAX_CHARS = 12_000
HIDDEN, GATES, EPOCHS, BATCH = 16, 8, 25, 64
#: Single bytes that get a share of their own; the other bytes fall in seven ranges.
SIGNS = b" \n\t.,;:!?'\"-|#*$%&<>=/\\_()[]{}"


def byte_classes() -> np.ndarray:
    out = np.full(256, 0, np.int64)
    out[128:192], out[192:] = 1, 2
    for at, (low, high) in enumerate(((b"a", b"z"), (b"A", b"Z"), (b"0", b"9"))):
        out[low[0] : high[0] + 1] = 3 + at
    for at, sign in enumerate(SIGNS):
        out[sign] = 6 + at
    return out


CLASSES = 6 + len(SIGNS)
FEATURES = CLASSES + 4


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a column's texts, and row offsets into them.

    Passages tile a text. A text without words, or an empty one, is one passage.
    """
    data, offsets = text_bytes(column)
    n = len(column)
    starts, ends, row = word_spans(data, offsets)
    first_word = np.searchsorted(row, np.arange(n + 1))
    number = np.arange(len(starts)) - first_word[row]
    counts = np.maximum(-(-np.diff(first_word) // PASSAGE_WORDS), 1)
    row_ends = np.append(0, np.cumsum(counts))
    total = int(row_ends[-1])
    passage = row_ends[row] + number // PASSAGE_WORDS
    begins = np.empty(total, np.int64)
    begins[row_ends[:-1]] = offsets[:-1]
    opens = (number % PASSAGE_WORDS == 0) & (number > 0)
    begins[passage[opens]] = starts[opens]
    sizes = np.diff(np.append(begins, len(data)))
    kinds = byte_classes()[data]
    share = np.bincount(np.repeat(np.arange(total), sizes) * CLASSES + kinds, minlength=total * CLASSES).reshape(total, CLASSES)
    words = np.bincount(passage, minlength=total)
    hashes = span_hashes(data, starts, ends)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    some = np.maximum(words, 1)
    length = np.bincount(passage, weights=(ends - starts), minlength=total) / some
    out = np.empty((total, FEATURES), np.float32)
    out[:, :CLASSES] = share / np.maximum(sizes, 1)[:, None]
    out[:, CLASSES] = np.bincount(passage, weights=same, minlength=total) / some
    out[:, CLASSES + 1] = np.log1p(length)
    out[:, CLASSES + 2] = words / PASSAGE_WORDS
    out[:, CLASSES + 3] = words == 0
    return out, row_ends


class Model:
    """Passage encoder, gated attention and scorer; parameters are plain arrays."""

    def __init__(self, rng: np.random.Generator, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale = mean, scale
        normal = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.p = {"we": normal(FEATURES, HIDDEN), "be": np.zeros(HIDDEN, np.float32), "v": normal(HIDDEN, GATES), "u": normal(HIDDEN, GATES), "w": normal(GATES), "c": normal(HIDDEN), "b": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, ends: np.ndarray) -> dict:
        p, first = self.p, ends[:-1]
        bag = np.repeat(np.arange(len(first)), np.diff(ends))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["we"] + p["be"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        score = (t * s) @ p["w"]
        a = np.exp(score - np.maximum.reduceat(score, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "bag": bag, "logit": np.clip(z @ p["c"] + p["b"], -30, 30)}

    def gradients(self, f: dict, ends: np.ndarray, wrong: np.ndarray) -> dict:
        """Of the log loss; ``wrong`` is probability less label, by document."""
        p, h, t, s, a, bag = self.p, f["h"], f["t"], f["s"], f["a"], f["bag"]
        dz = (wrong[:, None] * p["c"])[bag]
        da = (h * dz).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, ends[:-1])[bag])
        gate = ds[:, None] * p["w"]
        dt, du = gate * s * (1 - t * t), gate * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["v"].T + du @ p["u"].T) * (1 - h * h)
        return {"we": f["x"].T @ dh, "be": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ du, "w": (t * s).T @ ds, "c": f["z"].T @ wrong, "b": wrong.sum(keepdims=True)}

    def scores(self, column: pa.Array) -> np.ndarray:
        x, ends = passages(column)
        return 1 / (1 + np.exp(-self.forward(x, ends)["logit"].astype(np.float64)))


def fit(x: np.ndarray, ends: np.ndarray, label: np.ndarray, seed: int = 4) -> Model:
    """Adam over mini-batches of documents; the classes weigh equally."""
    rng = np.random.default_rng(seed)
    model = Model(rng, x.mean(axis=0), x.std(axis=0) + 0.02)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6)).astype(np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            part = np.append(0, np.cumsum(ends[rows + 1] - ends[rows]))
            take = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows])
            f = model.forward(x[take], part)
            wrong = (1 / (1 + np.exp(-f["logit"])) - label[rows]) * weight[rows] / len(rows)
            step += 1
            for k, g in model.gradients(f, part, wrong.astype(np.float32)).items():
                m, v = moments[k]
                g = g + 1e-4 * model.p[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model.p[k] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, marks: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model | None:
    """A model of the sample's passages, or None where the labels have not both classes."""
    sample = training_rows(docs, marks, "quality", per_class, max_chars).select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                x, ends = passages(part.column("text"))
                bags = [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.string()), part.column("label"), pa.array(bags, pa.binary())], ["id", "label", "bag"])

    rows = sorted((r.id, r.label, bytes(r.bag)) for r in sample.withColumn("doc_id", F.col("doc_id").cast("string")).mapInArrow(run, "id string, label int, bag binary").collect())
    label = np.array([r[1] for r in rows], np.float32)
    if len(np.unique(label)) < 2:
        return None
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(np.concatenate(bags), np.append(0, np.cumsum([len(b) for b in bags])), label)


def scored(docs: DataFrame, marks: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text is scored as one empty passage. Repeated rows get equal scores. With no
    model to learn (a class without labels) every score is 0.5 and counts as 1. Only the text enters a score.
    """
    model = train(docs, marks) if model is None else model
    docs = id_and_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                score = model.scores(part.column("text")) if model else np.full(len(part), 0.5)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    out = docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns as they were."""
    model = train(docs, marks)
    if model is None:
        return docs
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield part.filter(pa.array(model.scores(part.column("text")) >= 0.5))

    return docs.mapInArrow(run, schema)
