"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding joins three hashed tables: two hashes of the whole word, so that a rare
word seldom meets a toxic one in both, and one of its first bytes. Filters of several widths
slide over the words; the strongest response of each in the document is pooled and scored.

Training reads every labelled row outside the held-out fold, whole. The rows are dealt over shards; in
each epoch every shard goes on from the common weights and Spark averages what the shards change. A task takes
its shards one after another and sends on the sum of their changes, so what is shuffled grows with the cores, not the rows. A
fifth of the rows calibrates, by counts of their logits: the score's scale, so that 0.7 is the best
cut over all, and one more threshold for each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramflow.llm.common import chunks, held_out, span_hashes, text_bytes
from tramflow.session import ensure_checkpoint_dir

#: Labelled rows of a shard, and shards at most: a shard's change of the weights is as large as the weights.
SHARD_ROWS, SHARDS = 4_000, 256
#: Logits are counted in steps of one part in this many.
STEPS = 64
BITS, DIM, FILTERS, WIDTHS = 17, 8, 12, (1, 2, 3)
PREFIX_BYTES = 4
EPOCHS, BATCH = 6, 32
CUT = 0.7
#: Words scored at once; a longer text is pooled over its blocks, which overlap by the widest filter.
BLOCK = 1 << 16


def letters() -> np.ndarray:
    """Byte to lower case, and 0 for ASCII bytes that are no part of a word."""
    out = np.arange(256, dtype=np.uint8)
    for b in range(128):
        out[b] = ord(chr(b).lower()) if chr(b).isalnum() else 0
    return out


def word_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Three table rows for each word of a column's texts, and row offsets into the words."""
    data, offsets = text_bytes(column)
    data = letters()[data]
    inside = np.append(data != 0, False)
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = span_hashes(data, starts, ends, seed=6)
    prefix = span_hashes(data, starts, np.minimum(ends, starts + PREFIX_BYTES), seed=7)
    mask = np.uint64((1 << BITS) - 1)
    keys = np.stack([hashes & mask, hashes >> np.uint64(64 - BITS), prefix & mask], axis=1).astype(np.int32)
    return keys, np.searchsorted(starts, offsets)


class Model:
    def __init__(self, rng: np.random.Generator):
        width = 3 * DIM
        self.tables = [rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32) for _ in range(3)]
        self.filters = [rng.normal(0, 1 / np.sqrt(w * width), (w * width, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.top = np.full(FILTERS * len(WIDTHS), 0.3, np.float32)
        self.top[::3] *= -1
        self.offset = np.zeros(1, np.float32)
        self.shift = 0.0
        self.thresholds: dict[str, float] = {}

    def embed(self, keys: np.ndarray) -> np.ndarray:
        """Word vectors, and zero vectors for the widest filter behind the last."""
        out = np.zeros((len(keys) + WIDTHS[-1] - 1, 3 * DIM), np.float32)
        for k, table in enumerate(self.tables):
            out[: len(keys), k * DIM : (k + 1) * DIM] = table[keys[:, k]]
        return out

    def responses(self, x: np.ndarray, n: int) -> list[np.ndarray]:
        """Of each filter at each of ``n`` words."""
        step = x.strides
        return [np.lib.stride_tricks.as_strided(x, (n, w * x.shape[1]), step) @ k + b for w, k, b in zip(WIDTHS, self.filters, self.bias, strict=True)]

    def logits(self, keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of documents laid end to end; each has zero vectors behind it, as in training."""
        n, gap = len(ends) - 1, WIDTHS[-1] - 1
        pooled = np.zeros((n, len(self.top)), np.float32)
        for w in range(len(WIDTHS)):  # a text without words has the filters' bias
            pooled[:, w * FILTERS : (w + 1) * FILTERS] = np.where(np.diff(ends)[:, None] == 0, self.bias[w], -1e9)
        row = np.repeat(np.arange(n), np.diff(ends))
        place = np.arange(len(keys)) + gap * row
        for at in range(0, len(keys), BLOCK):
            some = np.arange(at, min(at + BLOCK + gap, len(keys)))
            own = min(BLOCK, len(keys) - at)
            low = place[at]
            x = np.zeros((int(place[some[-1]] - low) + 1 + gap, 3 * DIM), np.float32)
            x[place[some] - low] = self.embed(keys[some])[: len(some)]
            rows = row[at : at + own]
            first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            for w, y in enumerate(self.responses(x, len(x) - gap)):
                best = np.maximum.reduceat(y[place[at : at + own] - low], first)
                part = pooled[rows[first], w * FILTERS : (w + 1) * FILTERS]
                pooled[rows[first], w * FILTERS : (w + 1) * FILTERS] = np.maximum(part, best)
        return np.maximum(pooled, 0) @ self.top + self.offset[0]

    def scores(self, keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(keys, ends).astype(np.float64) + self.shift, -30, 30)))


def strongest(model: Model, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's strongest response in a text and its place."""
    best, place = np.full(len(model.top), -np.inf, np.float32), np.zeros(len(model.top), np.int64)
    gap = WIDTHS[-1] - 1
    for at in range(0, max(len(keys), 1), BLOCK):
        n = max(min(BLOCK, len(keys) - at), 1)
        x = model.embed(keys[at : at + BLOCK + gap])
        x = x if len(x) >= n + gap else np.zeros((n + gap, x.shape[1]), np.float32)
        y = np.concatenate(model.responses(x, n), axis=1)
        top = y.argmax(axis=0)
        value = y[top, np.arange(len(best))]
        place = np.where(value > best, at + top, place)
        best = np.maximum(best, value)
    return best, place


class Trainer:
    """Adagrad; the gradient flows through each filter's strongest window alone.

    ``changed`` are the rows of ``flat`` that differ from the start, which the seed gives again.
    """

    def __init__(self, changed: tuple[np.ndarray, np.ndarray] | None = None, seed: int = 6):
        self.model = Model(np.random.default_rng(seed))
        self.sums = [np.full(p.shape, 1e-3, np.float32) for p in self.parts()]
        if changed is not None:
            self.add(*changed)

    def parts(self) -> list[np.ndarray]:
        m = self.model
        return [*m.tables, *m.filters, *m.bias, m.top, m.offset]

    def move(self, part: int, g: np.ndarray, rate: float, rows=slice(None)) -> None:
        p, s = self.parts()[part], self.sums[part]
        s[rows] += g * g
        p[rows] -= rate * g / np.sqrt(s[rows])

    def step(self, bags: list[np.ndarray], label: np.ndarray) -> None:
        model, width, n = self.model, 3 * DIM, len(bags)
        both = [strongest(model, k) for k in bags]
        pooled, where = (np.stack([b[k] for b in both]) for k in (0, 1))
        active = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ model.top + model.offset[0], -30, 30)))
        wrong = ((p - label) / n).astype(np.float32)
        back = wrong[:, None] * model.top * (pooled > 0)
        behind = np.full((WIDTHS[-1], 3), -1, np.int32)
        bags = [np.concatenate([k, behind]) for k in bags]
        words, slopes = [], []
        for w, size in enumerate(WIDTHS):
            f = slice(w * FILTERS, (w + 1) * FILTERS)
            seen = np.stack([k[at[f, None] + np.arange(size)] for k, at in zip(bags, where, strict=True)])
            x = np.concatenate([np.where(seen[..., t, None] >= 0, table[seen[..., t]], 0) for t, table in enumerate(model.tables)], axis=-1)
            g = back[:, f]
            words.append(seen.reshape(-1, 3))
            slopes.append((g[:, :, None] * model.filters[w].T[None]).reshape(-1, width))
            self.move(3 + w, np.einsum("df,dfk->kf", g, x.reshape(n, FILTERS, size * width)) + 1e-5 * model.filters[w], 0.05)
            self.move(3 + len(WIDTHS) + w, g.sum(axis=0), 0.05)
        self.move(3 + 2 * len(WIDTHS), active.T @ wrong, 0.05)
        self.move(4 + 2 * len(WIDTHS), wrong.sum(keepdims=True), 0.05)
        keys, dx = np.concatenate(words), np.concatenate(slopes)
        hit = np.flatnonzero((keys[:, 0] >= 0) & (dx != 0).any(axis=1))
        for t in range(3):
            index, code = np.unique(keys[hit, t], return_inverse=True)
            g = np.zeros((len(index), DIM), np.float32)
            np.add.at(g, code, dx[hit, t * DIM : (t + 1) * DIM])
            self.move(t, g, 0.1, index)

    def flat(self) -> np.ndarray:
        """Weights and their sums of squares, ``DIM`` of each a row."""
        lay = lambda parts: np.concatenate([np.pad(p.ravel(), (0, -p.size % DIM)) for p in parts]).reshape(-1, DIM)
        return np.concatenate([lay(self.parts()), lay(self.sums)], axis=1)

    def add(self, slot: np.ndarray, change: np.ndarray) -> None:
        """``change`` to the rows ``slot`` of ``flat``."""
        rows = self.flat()
        rows[slot] += change
        for values, parts in ((rows[:, :DIM].ravel(), self.parts()), (rows[:, DIM:].ravel(), self.sums)):
            at = 0
            for p in parts:
                p[...] = values[at : at + p.size].reshape(p.shape)
                at += p.size + -p.size % DIM


CHANGES = [f"v{k}" for k in range(2 * DIM)]


def difference(trainer: Trainer, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = trainer.flat() - before
    slot = np.flatnonzero((change != 0).any(axis=1))
    return slot, change[slot]


def epoch(rows: DataFrame, trainer: Trainer) -> None:
    """One pass over ``rows``, whose partitions hold shards one after another; a row of weights moves by the mean of the shards that changed it."""
    shared = rows.sparkSession.sparkContext.broadcast(difference(trainer, Trainer().flat()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, at = None, None
        before = Trainer(shared.value).flat()
        total, times = np.zeros(before.shape, np.float32), np.zeros(len(before), np.int64)

        def close() -> None:
            slot, change = difference(trainer, before)
            total[slot] += change
            times[slot] += 1

        for batch in batches:
            for part in chunks(batch, "bag"):
                shard = np.asarray(part.column("shard"))
                edges = np.append(0, np.flatnonzero(np.diff(shard)) + 1)
                for a, b in zip(edges.tolist(), np.append(edges[1:], len(shard)).tolist(), strict=True):
                    if int(shard[a]) != at:
                        if trainer is not None:
                            close()
                        trainer, at = Trainer(shared.value), int(shard[a])
                    some = part.slice(a, b - a)
                    bags = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, 3) for x in some.column("bag")]
                    label = np.asarray(some.column("label"), np.float32)
                    for k in range(0, len(bags), BATCH):
                        trainer.step(bags[k : k + BATCH], label[k : k + BATCH])
        if trainer is not None:
            close()
        slot = np.flatnonzero(times)
        columns = [pa.array(slot), pa.array(times[slot]), *(pa.array(c) for c in total[slot].T)]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "times", *CHANGES])

    moved = rows.mapInArrow(run, ", ".join(["slot long", "times long", *(f"{c} float" for c in CHANGES)]))
    mean = moved.groupBy("slot").agg(*((F.sum(c) / F.sum("times")).cast("float").alias(c) for c in CHANGES)).toArrow()
    shared.destroy()
    trainer.add(np.asarray(mean.column("slot")), np.stack([np.asarray(mean.column(c)) for c in CHANGES], axis=1))


def best_cut(logit: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut of least error between ascending logits with these counts of rows; the middle of the widest best gap."""
    missed = np.append(0, np.cumsum(toxic))
    false = np.append(np.cumsum(clean[::-1])[::-1], 0)
    edges = np.concatenate([[logit[0] - 1], logit, [logit[-1] + 1]])
    cost = missed + false
    best = np.flatnonzero(cost == cost.min())
    wide = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[wide] + edges[wide + 1]) / 2)


def maybe_in(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``rows`` whose ``doc_id`` is in ``ids``, and an eighth of the others at most: those whose hash hits the bit of one of the ``n`` ids."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(max(8 * n, 1)))
    ids = ids.select(F.col("doc_id").try_cast(dict(rows.dtypes)["doc_id"]).alias("doc_id"))
    bits = ids.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    at = F.bitmap_bit_position(spot).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return rows.join(F.broadcast(bits), F.bitmap_bucket_number(spot) == F.col("bucket")).where(hit).drop("bucket", "bits")


def dealt(docs: DataFrame, known: DataFrame, n: int, shards: int, tasks: int) -> DataFrame:
    """``doc_id, mixed, label, text, lang, fold, shard``: texts without a label and rows of labels without a text, which come before their texts.

    The texts are those that may have one of the ``n`` labels. Labels are joined to ids and hashes of texts, and then go
    where the texts are dealt to, so a text is moved once.
    """
    texts = docs.where(~held_out()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    texts = maybe_in(texts, known, n).withColumn("mixed", F.xxhash64("doc_id", "text"))
    marked = texts.select("doc_id", "mixed").join(known, "doc_id").select("doc_id", "mixed", "label", F.lit("").alias("text"), F.lit("").alias("lang"))
    rows = marked.unionByName(texts.withColumn("label", F.lit(None).cast("int")))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("mixed", F.lit(66)), F.lit(5)) == 0).withColumn("shard", F.pmod(F.hash("mixed"), F.lit(shards)))
    return rows.repartitionById(tasks, F.col("shard") % tasks).sortWithinPartitions("shard", "mixed", "doc_id", F.col("label").isNull())


def with_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of ``dealt`` that have a label, with it."""
    last = None  # the last label's row
    for batch in batches:
        for part in chunks(batch):
            part = part if last is None else pa.Table.from_batches([last, part]).combine_chunks().to_batches()[0]
            marks = np.flatnonzero(np.asarray(part.column("label").is_valid()))
            if not len(marks):
                continue
            last = part.slice(int(marks[-1]), 1)
            own = pa.array(marks[np.maximum(np.searchsorted(marks, np.arange(len(part)), "right") - 1, 0)])
            same = pa.compute.and_(*(pa.compute.equal(part.column(c), part.column(c).take(own)) for c in ("doc_id", "mixed")))
            found = pa.compute.and_(same, part.column("label").is_null())
            label = part.column("label").take(own)
            yield part.set_column(part.schema.get_field_index("label"), "label", label).filter(found)


def training_bags(docs: DataFrame, marks: DataFrame, shard_rows: int) -> DataFrame:
    """``lang, label, fold, shard, bag`` of every row with a label outside the held-out fold, dealt over shards in mixed order and written.

    There is a partition for each core at most; it holds whole shards, one behind another.

    Null labels are left out; of repeated labels of one id the largest holds.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    known = marks.where(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    n = known.count()
    shards = min(max(-(-n // shard_rows), 1), SHARDS)
    tasks = min(shards, docs.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in with_labels(batches):
            keys, ends = word_keys(part.column("text"))
            bags = [keys[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("lang", "label", "fold", "shard")), pa.array(bags, pa.binary())], ["lang", "label", "fold", "shard", "bag"])

    return dealt(docs, known, n, shards, tasks).mapInArrow(run, "lang string, label int, fold boolean, shard int, bag binary").checkpoint()


def train(docs: DataFrame, marks: DataFrame, least: int = 40, shard_rows: int = SHARD_ROWS) -> Model | None:
    """A calibrated model of every labelled row, or None where the labels have not both classes.

    A language with under ``least`` calibration rows, or one class alone, has the threshold of all.
    """
    rows = training_bags(docs, marks, shard_rows)
    counts = {(r.fold, r.label): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    if len({label for _, label in counts}) < 2:
        return None
    trainer = Trainer()
    apart = all((fold, label) in counts for fold in (False, True) for label in (0, 1))
    for _ in range(EPOCHS):
        epoch(rows.where(~F.col("fold")) if apart else rows, trainer)
    model = trainer.model
    shared = rows.sparkSession.sparkContext.broadcast(difference(trainer, Trainer().flat()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trainer(shared.value).model
        for batch in batches:
            for part in chunks(batch, "bag"):
                bags = [np.frombuffer(b.as_buffer(), np.int32).reshape(-1, 3) for b in part.column("bag")]
                ends = np.append(0, np.cumsum([len(b) for b in bags])).astype(np.int64)
                step = np.round(np.clip(model.logits(np.concatenate(bags), ends), -30, 30) * STEPS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("label"), pa.array(step)], ["lang", "label", "step"])

    judged = (rows.where("fold") if apart else rows).mapInArrow(run, "lang string, label int, step int")
    table = judged.groupBy("lang", "step").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean")).collect()
    shared.destroy()

    def cut(some: list) -> float:
        steps = sorted({r.step for r in some})
        sums = np.zeros((2, len(steps)), np.int64)
        np.add.at(sums, (slice(None), np.searchsorted(steps, [r.step for r in some])), np.array([[r.toxic for r in some], [r.clean for r in some]]))
        return best_cut(np.array(steps) / STEPS, *sums)

    model.shift = float(np.log(CUT / (1 - CUT)) - cut(table))
    by_lang: dict[str, list] = {}
    for r in table:
        by_lang.setdefault(r.lang, []).append(r)
    for name, own in by_lang.items():
        toxic, clean = sum(r.toxic for r in own), sum(r.clean for r in own)
        if toxic + clean >= least and toxic and clean:
            model.thresholds[name] = float(1 / (1 + np.exp(-(cut(own) + model.shift))))
    return model


def scored(docs: DataFrame, marks: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted``, and ``threshold, flagged`` by language, for every row of ``docs``.

    ``flagged`` compares the score with its language's calibrated threshold (0.7 for a null or unknown
    one); the score itself reads the text alone. A null or empty text has no words and gets the
    filters' bias. Repeated rows get equal scores. With no model to learn every score is 0.
    """
    model = train(docs, marks) if model is None else model
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                score = model.scores(*word_keys(part.column("text"))) if model else np.zeros(len(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(score)], ["doc_id", "lang", "score"])

    out = docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang string, score double")
    cut = F.lit(CUT)
    for name, value in sorted((model.thresholds if model else {}).items()):
        cut = F.when(F.col("lang") == name, F.lit(value)).otherwise(cut)
    return out.withColumn("threshold", cut).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold", (F.col("score") >= F.col("threshold")).alias("flagged"))
