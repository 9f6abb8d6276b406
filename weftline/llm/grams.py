"""Hashed n-grams of a text's bytes, their counts over a corpus, and the words of a text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import map_rows

BUCKETS = 1 << 16
SIZE = 4
PRIOR = 5.0
CHUNK = 1 << 20


def bucket_chunks(data: bytes, size: int = SIZE):
    """Bucket numbers of all n-grams of a text, in arrays of bounded length."""
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, len(raw) - size + 1, CHUNK):
        part = raw[start:start + CHUNK + size - 1].astype(np.uint32)
        n = len(part) - size + 1
        h = np.zeros(n, np.uint32)
        for i in range(size):
            h = (h ^ part[i:n + i]) * np.uint32(16777619)
        yield (h >> np.uint32(16)).astype(np.int64)


def corpus_counts(rows: DataFrame, classes: int, size: int = SIZE) -> np.ndarray:
    """Counts [class, bucket] over (text, classes): the bits of `classes` name the classes a text counts for.

    A task sends one row a bucket it has seen; BUCKETS rows reach the driver whatever the corpus.
    """
    def run(texts):
        sums = np.zeros((classes, BUCKETS), np.int64)
        for text, member in texts:
            for buckets in bucket_chunks(text, size):
                seen = np.bincount(buckets, minlength=BUCKETS)
                for k in range(classes):
                    if member >> k & 1:
                        sums[k] += seen
        for b in np.flatnonzero(sums.any(0)).tolist():
            yield (b, *sums[:, b].tolist())

    names = [f"c{k}" for k in range(classes)]
    counted = map_rows(rows.select("text", "classes"), run, ", ".join(["bucket long", *(f"{n} long" for n in names)]))
    out = np.zeros((classes, BUCKETS))
    for r in counted.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toLocalIterator():
        out[:, r["bucket"]] = [r[n] for n in names]
    return out


def log_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the share of each bucket in counts a over that in counts b; zero where either class is empty.

    PRIOR expected grams a bucket pull the ratio of rarely seen buckets towards 1.
    """
    if not a.sum() or not b.sum():
        return np.zeros(len(a))
    low = min(a.sum(), b.sum())
    return np.log(a * (low / a.sum()) + PRIOR) - np.log(b * (low / b.sum()) + PRIOR)


def mean_ratio(data: bytes, ratio: np.ndarray, size: int = SIZE) -> float:
    """Log-likelihood ratio a gram; 0 for a text without one."""
    total, n = 0.0, 0
    for buckets in bucket_chunks(data, size):
        total += float(ratio[buckets].sum())
        n += len(buckets)
    return total / n if n else 0.0


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that the text holds twice or more, the first one included."""
    code: dict = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    if len(code) == len(ids) or len(ids) < 4:
        return 0
    pair = np.unique(ids[:-1] * len(code) + ids[1:], return_inverse=True)[1]
    _, which, n = np.unique(pair[:-1] * len(code) + ids[2:], return_inverse=True, return_counts=True)
    twice = n[which] > 1
    covered = np.zeros(len(ids), bool)
    for i in range(3):
        covered[i:len(ids) - 2 + i] |= twice
    return int(covered.sum())


def label_rows(labels: DataFrame) -> DataFrame:
    """One row an id (the lowest labels where an id repeats), so that a join keeps every document once."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
