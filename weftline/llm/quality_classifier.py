"""Quality classifier: a document's own evidence combined with what its host and path are like.

Evidence: log-odds of a logistic model over a few measures of the text, without its prior. Prior: soft
votes of all documents, summed by path, by host and over all; a path's rate is shrunk towards its
host's, a host's towards the global one, by prior weights estimated from the spread between sites.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm import grams
from weftline.llm.common import id_field, map_rows, texts
from weftline.session import passing, staged

WORD_BUCKETS = 1 << 18
PRIOR_WORDS = 50.0      # documents of prior weight behind each word's rate
WORDS = re.compile(r"\w+").findall
MEASURES = 4


def _word_buckets(text: str) -> set:
    return {xxhash.xxh32_intdigest(w) % WORD_BUCKETS for w in set(WORDS(text.lower()))}


def _features(text: str, good: np.ndarray, toxic: np.ndarray) -> tuple:
    """Quality: n-gram ratio, repeated share, shortness. Toxicity: the most telling word."""
    data = text.encode()
    words = data.split()
    n = max(1, len(words))
    worst = max((float(toxic[b]) for b in _word_buckets(text)), default=0.0)
    return grams.mean_ratio(data, good), grams.repeat_words(words) / n, 1 / n, worst


def _word_rates(rows: DataFrame) -> np.ndarray:
    """log of a word bucket's toxic rate among labelled documents over the overall rate, shrunk to 0."""
    def run(batch):
        sums = np.zeros((2, WORD_BUCKETS), np.int64)
        docs = np.zeros(2, np.int64)
        for text, toxic in batch:
            sums[int(toxic), list(_word_buckets(text))] += 1
            docs[int(toxic)] += 1
        yield -1, *docs.tolist()
        for b in np.flatnonzero(sums.any(0)).tolist():
            yield b, *sums[:, b].tolist()

    out, docs = np.zeros((2, WORD_BUCKETS)), np.zeros(2)
    counted = map_rows(rows, run, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    for b, clean, toxic in counted.toLocalIterator():
        if b < 0:
            docs[:] = clean, toxic
        else:
            out[:, b] = clean, toxic
    if not docs.all():
        return np.zeros(WORD_BUCKETS)
    rate = docs[1] / docs.sum()
    return np.log((out[1] + PRIOR_WORDS * rate) / (out.sum(0) + PRIOR_WORDS)) - np.log(rate)


def _newton(sums, size: int, ridge: float) -> np.ndarray:
    """Weights of a ridge logistic model (last: intercept); sums(w) gives the curvature and the slope over all rows."""
    w = np.zeros(size)
    keep = np.diag([ridge] * (size - 1) + [1e-6])
    for _ in range(50):
        curve, slope = sums(w)
        step = np.linalg.solve(curve + keep, slope - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic model by Newton steps; zeros where a class is missing."""
    x = np.column_stack([x, np.ones(len(x))])
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1])

    def sums(w):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        return (x * (p * (1 - p) + 1e-9)[:, None]).T @ x, x.T @ (y - p)

    return _newton(sums, x.shape[1], ridge)


def fit_rows(rows: DataFrame, names: list, label: str, ridge: float = 1.0) -> np.ndarray:
    """fit_logistic over a table of any length: a step is one aggregate, a few numbers reach the driver."""
    x = [*map(F.col, names), F.lit(1.0)]
    n = len(x)
    low, high = rows.agg(F.min(label), F.max(label)).first()
    if low == high:
        return np.zeros(n)
    upper = [(i, j) for i in range(n) for j in range(i, n)]

    def sums(w):
        z = sum((xi * F.lit(float(wi)) for xi, wi in zip(x, w)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
        at = rows.select(*(v.alias(f"v{i}") for i, v in enumerate(x)), p.alias("p"), F.col(label).alias("y"))
        weight = F.col("p") * (1 - F.col("p")) + 1e-9
        found = at.agg(*(F.sum(weight * F.col(f"v{i}") * F.col(f"v{j}")) for i, j in upper),
                       *(F.sum(F.col(f"v{i}") * (F.col("y") - F.col("p"))) for i in range(n))).first()
        curve = np.zeros((n, n))
        for (i, j), s in zip(upper, found):
            curve[i, j] = curve[j, i] = s
        return curve, np.array(found[len(upper):])

    return _newton(sums, n, ridge)


def posterior(scored: DataFrame, vote: str, host: str = "host", path: str = "path") -> DataFrame:
    """scored + `<vote>_prior`: the probability its site gives a document, its own vote left out.

    Sums are combined before they are shuffled. Prior weights are the method-of-moments estimate
    m (1 - m) / v - 1 from the spread v of the sites' rates beyond chance, between 1 and 10,000.
    """
    sums = [F.count("*").alias("n"), F.sum(vote).alias("s"), F.sum(F.col(vote) * F.col(vote)).alias("q")]
    paths = scored.groupBy(host, path).agg(*sums)
    hosts = paths.groupBy(host).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    total = hosts.agg(F.sum("hn"), F.sum("hs")).first()
    if not total[0]:
        return scored.withColumn(f"{vote}_prior", F.lit(0.5))
    mean = (total[1] + 0.5) / (total[0] + 1.0)

    def weight(sites, n, s, q):
        """Spread between sites with at least two documents, less what chance alone would give."""
        rate = F.col(s) / F.col(n)
        noise = (F.col(q) / F.col(n) - rate * rate) / (F.col(n) - 1)
        spread = sites.where(F.col(n) > 1).agg(F.avg((rate - mean) * (rate - mean) - noise)).first()[0]
        return float(np.clip(mean * (1 - mean) / max(spread or 0.0, 1e-9) - 1, 1.0, 10_000.0))

    host_weight, path_weight = weight(hosts, "hn", "hs", "hq"), weight(paths, "n", "s", "q")
    paths = paths.select(F.col(host).alias("_h"), F.col(path).alias("_p"), "n", "s")
    hosts = hosts.select(F.col(host).alias("_hh"), "hn", "hs")
    sites = paths.join(hosts, F.col("_h").eqNullSafe(F.col("_hh"))).drop("_hh")
    own = F.col(vote)
    at_host = (F.col("hs") - own + host_weight * mean) / (F.col("hn") - 1 + host_weight)
    at_path = (F.col("s") - own + path_weight * at_host) / (F.col("n") - 1 + path_weight)
    joined = scored.join(sites, F.col(host).eqNullSafe(F.col("_h")) & F.col(path).eqNullSafe(F.col("_p")))
    return joined.withColumn(f"{vote}_prior", F.least(F.greatest(at_path, F.lit(1e-6)), F.lit(1 - 1e-6))).drop("_h", "_p", "n", "s", "hn", "hs")


def quality_classifier(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang",
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_quality, p_toxic, toxic, kept) for every row: kept if quality is likelier than not and toxic is not.

    The evidence is learned from all labelled documents.

    Null hosts and paths are a site of their own, null texts are empty, null ids and repeated rows stay,
    other columns are ignored and an empty table gives an empty one. Without labels of both kinds the
    probabilities are 0.5 (kept) for quality and 0 for toxicity.
    """
    src = texts(docs, id_col, text_col, binary=False)
    marks = grams.label_rows(labels).select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("quality", "toxic")))

    def known(half):
        """(text, quality, toxic) of a half of the labelled rows; texts of this half alone are shuffled, at any size."""
        own = src.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half)
        return own.join(marks.hint("shuffle_hash"), "doc_id").select("text", "quality", "toxic")

    # half of the labelled rows for the n-gram and word tables, the other half for the weights
    with passing(docs.sparkSession):
        tables = staged(known(0), "labelled")
        good, bad = grams.corpus_counts(tables.select(F.col("text").cast("binary").alias("text"),
                                                      F.when(F.col("quality") == 1, 1).otherwise(2).alias("classes")), 2)
        good, toxic = grams.log_ratio(good, bad), _word_rates(tables.select("text", "toxic"))

    def measure(rows):
        for text, *labels_of in rows:
            yield *labels_of, *_features(text, good, toxic)

    names = [f"x{i}" for i in range(MEASURES)]
    doubles = ", ".join(f"{n} double" for n in names)
    fit = staged(map_rows(known(1), measure,
                          f"quality long, toxic long, {doubles}"), "measured")
    models = [fit_rows(fit, names[:3], "quality"), fit_rows(fit, names[3:], "toxic")]
    n, *ones = fit.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("quality", "toxic"))).first()
    lean = [float(np.log((s + 0.5) / (n - s + 0.5))) for s in ones]

    where = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def score(rows):
        for doc_id, host, path, text in rows:
            x = _features(text, good, toxic)
            logits = [float(np.dot(w[:-1], v) + w[-1]) for w, v in zip(models, (x[:3], x[3:]))]
            yield doc_id, host, path, *(z - p for z, p in zip(logits, lean)), *(1 / (1 + float(np.exp(-np.clip(z, -30, 30)))) for z in logits)

    fields = [T.StructField(n, where.schema[n].dataType) for n in ("doc_id", "host", "path")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("e_quality", "e_toxic", "quality", "toxicity")]
    scored = staged(map_rows(where, score, T.StructType(fields)), "evidence")
    both = posterior(posterior(scored, "quality"), "toxicity")

    def combined(evidence, prior):
        return 1 / (1 + F.exp(-(F.col(evidence) + F.log(F.col(prior) / (1 - F.col(prior))))))

    trained = [bool(w.any()) for w in models]
    p_quality = combined("e_quality", "quality_prior") if trained[0] else F.lit(0.5)
    p_toxic = combined("e_toxic", "toxicity_prior") if trained[1] else F.lit(0.0)
    return both.select("doc_id", p_quality.alias("p_quality"), p_toxic.alias("p_toxic")).withColumn("toxic", F.col("p_toxic") >= 0.5).withColumn(
        "kept", (F.col("p_quality") >= 0.5) & ~F.col("toxic"))
