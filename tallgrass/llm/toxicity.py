"""Toxicity by compression distance: which of two dictionaries makes the windows of a text shorter.

Two zstandard dictionaries of one size are trained: the toxic one on what only toxic documents
say, the ordinary one on what only ordinary documents say, both followed by the same trained
dictionary of what both say.  So a window without anything telling has about the same length
under both, and each telling word shortens it under one of them.

The lengths of all windows of a text are compared; how many windows are shorter under the toxic
dictionary by so many bytes, and by how much in all, are the inputs of a calibrated logistic score.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallgrass.llm.bpe import text_slices

#: Labelled documents, toxic and ordinary, that the dictionaries and then the calibration see, at
#: most.  Their texts, like those scored, are read whole.
TRAIN_TOXIC, TRAIN_ORDINARY = 2000, 6000
#: Parts of the sample; each is calibrated with dictionaries trained on the others.
FOLDS = 3
#: Bytes of a window, of the dictionary of one class and of the shared dictionary.
WINDOW, CLASS_BYTES, SHARED_BYTES = 256, 4096, 112_000
#: Bytes that the dictionary of a class has at least.
LEAST_CLASS_BYTES = 1024
#: Independent documents that must have a word before it goes into the dictionary of a class (fewer, down
#: to two, if there are fewer than 20 times as many toxic documents).
LEAST_DOCS = 6
#: zstandard: level and shortest match.
LEVEL, SHORTEST = 5, 4
#: Bytes saved in a window that the score counts.
STEPS = (1, 2, 3, 4, 5, 6, 8)
BATCH_CHARS = 2_000_000

_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_CUT = re.compile(rb"(?s)\S.{0,%d}\S*" % (WINDOW - 1))


def windows(text: str) -> list[bytes]:
    """The whole text, lower-cased, in windows that end between words."""
    return [b" " + w + b" " for w in _CUT.findall(text.lower().encode("utf-8", "replace"))]


def _word_counts(texts: list[str]) -> Counter:
    """Documents by word; near copies, which share their smallest word hashes, count as one."""
    counts: Counter = Counter()
    seen: dict[tuple, set] = {}
    for text in texts:
        words = {b" " + w + b" " for w in _WORD.findall(text.lower().encode("utf-8", "replace"))}
        group = seen.setdefault(tuple(sorted(zlib.crc32(w) for w in words)[:2]), set())
        counts.update(words - group)
        group |= words
    return counts


def _dictionary(counts: dict[bytes, int], size: int, repeats: int) -> bytes:
    """A trained dictionary of words in proportion to their counts; of too few, the words themselves."""
    import zstandard

    samples = [w for w, n in sorted(counts.items()) for _ in range(min(n, repeats))]
    random.Random(0).shuffle(samples)
    try:
        trained = zstandard.train_dictionary(size, samples[:500_000], k=24, d=6).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    # a handful of words trains tables without content
    return trained if any(w in trained for w in counts) else b"".join(sorted(counts))[:size]


@dataclass
class ToxicityModel:
    """Both dictionaries and the weights of the score."""

    toxic: bytes
    ordinary: bytes
    weights: list[float]
    means: list[float]
    scales: list[float]

    def compressors(self):
        import zstandard

        made = []
        for content in (self.ordinary, self.toxic):
            rules = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=SHORTEST, write_content_size=False, write_checksum=False, write_dict_id=False,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            )
            dictionary = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=rules)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=rules))
        return made

    def score(self, inputs: np.ndarray) -> np.ndarray:
        scaled = (inputs - np.array(self.means)) / np.array(self.scales)
        logit = scaled @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def saved_bytes(text: str, compressors) -> np.ndarray:
    """Bytes that the toxic dictionary saves against the ordinary one, by window."""
    ordinary, toxic = compressors
    return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)] or [0])


def _inputs(saved: np.ndarray) -> list[float]:
    n = len(saved)
    above = [int((saved >= s).sum()) for s in STEPS]
    gain = np.clip(saved, 0, None).sum()
    return [
        *[math.log((k + 0.1) / (n + 1)) for k in above], *[math.log1p(k) for k in above],
        float(saved.max()), math.log(n + 1), math.log1p(gain), float(np.clip(saved, -6, None).sum()) / n,
    ]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and intercept by Newton's method with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (weight * (p - y)) + 0.1 * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w


def _class_dictionary(own: Counter, other: Counter, least: int) -> bytes:
    """Trained on the words that only this class says; filled up in front with those that it says most
    against the other, so that a class without words of its own has a dictionary too."""
    trained = _dictionary({w: n for w, n in own.items() if n >= least and w not in other}, CLASS_BYTES, 1000)
    missing = LEAST_CLASS_BYTES - len(trained)
    if missing <= 0:
        return trained
    typical = sorted((w for w in own if w in other), key=lambda w: ((own[w] + 0.5) / (other[w] + 0.5), w))
    return (b"".join(typical)[-missing:] + trained).rjust(LEAST_CLASS_BYTES, b"\0")


def _dictionaries(toxic: list[str], ordinary: list[str]) -> ToxicityModel:
    t, o = _word_counts(toxic), _word_counts(ordinary)
    least = max(2, min(LEAST_DOCS, len(toxic) // 20))
    own = [_class_dictionary(a, b, least) for a, b in ((t, o), (o, t))]
    both = _dictionary({w: n for w, n in o.items() if w in t}, SHARED_BYTES, 20)
    size = min(map(len, own))  # equal sizes: the same distances to the shared part
    return ToxicityModel(own[0][len(own[0]) - size:] + both, own[1][len(own[1]) - size:] + both, [], [], [])


def train(toxic: list[str], ordinary: list[str], share: float) -> ToxicityModel:
    """Dictionaries and calibration from texts of either class; ``share`` of toxic texts in the whole corpus.

    Each text is calibrated with dictionaries that have not seen it.  With fewer than FOLDS texts
    of a class the score is ``share`` for every text.
    """
    width = len(_inputs(np.zeros(1)))
    if min(len(toxic), len(ordinary)) < FOLDS:
        prior = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicityModel(b"", b"", [0.0] * width + [math.log(prior / (1 - prior))], [0.0] * width, [1.0] * width)
    x, y = [], []
    for k in range(FOLDS):
        seen = [[t for i, t in enumerate(texts) if i % FOLDS != k] for texts in (toxic, ordinary)]
        compressors = _dictionaries(*seen).compressors()
        for label, texts in ((1.0, toxic[k::FOLDS]), (0.0, ordinary[k::FOLDS])):
            x += [_inputs(saved_bytes(text, compressors)) for text in texts]
            y += [label] * len(texts)
    model, x, y = _dictionaries(toxic, ordinary), np.array(x), np.array(y)
    weight = np.where(y == 1, share * len(y) / len(toxic), (1 - share) * len(y) / len(ordinary))
    means, scales = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights, model.means, model.scales = _logistic((x - means) / scales, y, weight).tolist(), means.tolist(), scales.tolist()
    return model


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Train on the labelled documents for which ``learnable`` (of the labels' id) holds.

    The sample of each class is chosen by a hash of the id, so it is bounded whatever the input.
    """
    rows = labels.where(learnable & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_y")
    )
    chosen = {y: rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in ((1, TRAIN_TOXIC), (0, TRAIN_ORDINARY))}
    # ten thousand pairs of numbers at most
    picked = F.broadcast(chosen[1].union(chosen[0]))
    texts = docs.where(F.length(text_col) > 0).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(picked, "_id")
    sample = sorted(((zlib.crc32(str(r["_id"]).encode()), r["_id"], r["_text"], r["_y"]) for r in texts.collect()))
    by_label = {y: list(dict.fromkeys(text for _, _, text, label in sample if label == y)) for y in (0, 1)}
    positive, total = rows.agg(F.sum(F.col("_y").cast("double")), F.count(F.lit(1))).first()
    return train(by_label[1], by_label[0], (positive or 0.0) / total if total else 0.0)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row, over its whole text.

    Null and empty texts are scored like a text that no dictionary shortens.  Repeated rows and
    null ids stay; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_score(rows, model, drop=["text"])


def with_score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score", drop: Sequence[str] = ()) -> DataFrame:
    """Every row with its score in the column ``name`` behind its other columns, without those in ``drop``."""
    kept = [f for f in docs.schema.fields if f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            for first, texts in text_slices(batch, text_col, BATCH_CHARS):
                inputs = np.array([_inputs(saved_bytes(text, compressors)) for text in texts])
                columns = [batch.column(f.name).slice(first, len(texts)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(model.score(inputs))], [*(f.name for f in kept), name])

    return docs.mapInArrow(run, StructType([*kept, StructField(name, DoubleType())]))
