"""Quality scores by compression: dictionaries trained on good and on bad text, and how much each one helps.

A text is compressed in windows, all of it, with a dictionary of good text, with one of bad text and with none.
The difference of the sizes under bad and good, over the size without, is large where the text is like good
text. A logistic calibration turns that, and the ratios of the sizes to each other and to the length, into a score; length
itself is no feature.

Scores suit the fitted sample, in which both labels have up to PER_LABEL rows, not the share of labels in the corpus.
The dictionaries and the calibration are fitted on a sample of labelled rows bounded by PER_LABEL (documents of
each label, those of least hash), on whole texts as in scoring. One
half of the sample, by hash, trains the dictionaries, the other the calibration, so the calibration sees texts
that the dictionaries have not. Scores are of whole texts.

Edge cases: a null or empty text gets the score of the labelled share alone, by the calibration's prior. Without
labels of both kinds every score is the share of label 1 (or 0.5 with no labels). Equal texts get equal scores.
Labels are read by id; an id with several labels counts once, as its greatest. Labels whose texts are all blank count as none
but for the share. Columns of the input may have any names: only id, text and the labels are read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import read

#: Labelled documents of each label that are fitted on.
PER_LABEL = 3000
DICTIONARY_BYTES = 32 * 1024
#: Bytes of a window: a dictionary helps little beyond it.
WINDOW = 4096
LEVEL = 3
FOLDS = 5
THRESHOLD = 0.3


class Model:
    """Two dictionaries and the calibration's weights; small, and sent to the executors whole."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.good, self.bad, self.weights, self.mean, self.scale, self.prior = good, bad, weights, mean, scale, prior

    def scores(self, texts: list[str | None]) -> list[float]:
        if not len(self.weights):
            return [self.prior] * len(texts)
        sizes = _sizes_by(self.good, self.bad)
        out = []
        for t in texts:
            x = features(t, sizes)
            if x is None:
                out.append(self.prior)
                continue
            z = float(self.weights[-1] + ((x - self.mean) / self.scale) @ self.weights[:-1])
            out.append(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))
        return out


@functools.lru_cache(maxsize=4)
def _sizes_by(good: bytes, bad: bytes):
    """A function from bytes to their compressed sizes (none, good, bad); its compressors are kept."""
    kinds = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]
    for raw in (good, bad):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        kinds.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
    return lambda part: [len(c.compress(part)) for c in kinds]


def features(text: str | None, sizes) -> np.ndarray | None:
    """The normalised difference and size ratios of a text, with what is plain in its bytes; None for no text."""
    data = (text or "").encode()
    if not data.strip():
        return None
    total = np.zeros(3)
    for at in range(0, len(data), WINDOW):
        total += sizes(data[at : at + WINDOW])
    none, good, bad = total
    n = len(data)
    return np.array([(bad - good) / none, (none - good) / none, (none - bad) / none, none / (n + 20), (bad - good) / (n + 20)])


def fit(rows: list[tuple[str, int, int]], seed: int = 5) -> Model:
    """rows: text, label, and a hash whose lowest bit deals the halves."""
    labels = [y for _, y, _ in rows]
    prior = (sum(labels) / len(labels)) if labels else 0.5
    empty = np.zeros(0)
    rows = [(t, y, h) for t, y, h in rows if t.encode().strip()]  # blank texts teach the prior alone
    parts = {y: [t.encode() for t, label, h in rows if label == y and h & 1] for y in (0, 1)}
    rest = [(t, y) for t, y, h in rows if not h & 1]
    if min(len(parts[0]), len(parts[1])) < 8 or len({y for _, y in rest}) < 2:
        return Model(b"", b"", empty, empty, empty, prior)
    raw = []
    for y in (1, 0):
        samples = [t[at : at + WINDOW] for t in parts[y] for at in range(0, len(t), WINDOW)]
        try:
            raw.append(zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes())
        except zstandard.ZstdError:  # too little text: its end serves as the dictionary
            raw.append(b"".join(samples)[-DICTIONARY_BYTES:])
    sizes = _sizes_by(*raw)
    found = [(f, y) for t, y in rest if (f := features(t, sizes)) is not None]
    x, y = np.array([f for f, _ in found]), np.array([v for _, v in found], float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    x = np.c_[(x - mean) / scale, np.ones(len(x))]
    weights = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        ridge = np.r_[np.full(x.shape[1] - 1, 0.5), 1e-6]
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(*raw, weights, mean, scale, prior)


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, folds: int = FOLDS) -> list[tuple[str, int, int]]:
    """The labelled rows to fit on: never of the fold that is held out. Bounded by per_label documents of each label."""
    one = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    one = one.where(F.crc32(F.col("doc_id").cast("string")) % folds != 0).withColumn("hash", F.xxhash64(F.lit(11), "doc_id"))
    picked = [one.where(F.col("quality") == y).orderBy("hash", "doc_id").limit(per_label) for y in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * per_label rows of three numbers
    rows = docs.join(chosen, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "quality", "hash")
    found = rows.groupBy("doc_id", "quality", "hash").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["quality"], r["hash"]) for r in sorted(found, key=lambda r: (r["hash"], r["doc_id"]))]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1).to_pylist()), pa.float64())], names=["_id", "score"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit(sample(docs, read(spark, sf_dir, "labels"))))
    held = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
