"""MinHash, banding and SimHash over word sets, as Arrow batches of numpy work."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from weftline.functions import text as T

# Bands and rows of the 128-value signature: "balanced" minimises the summed error around 0.8,
# "recall" all but never misses a pair at 0.8.
PRESETS = {"balanced": (9, 13), "recall": (32, 4)}


def _multipliers(n: int) -> tuple:
    """Fixed odd multipliers and offsets from the splitmix64 sequence."""
    mask = (1 << 64) - 1
    state, out = 0, []
    for _ in range(2 * n):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    values = np.array(out, np.uint64)
    return values[:n] | np.uint64(1), values[n:]


def word_set(c, max_words: int | None = None):
    """Sorted 64-bit hashes of the distinct words; `max_words` reads only the first so many."""
    found = T.words(c)
    if max_words is not None:
        found = F.slice(found, 1, max_words)
    return F.array_sort(F.array_distinct(F.transform(found, lambda w: F.xxhash64(w))))


def _signatures(sets: pd.Series, num_perm: int) -> list:
    mul, add = _multipliers(num_perm)
    out = []
    for hashes in sets:
        if hashes is None:
            out.append(None)
            continue
        values = np.asarray(hashes, np.int64).view(np.uint64)
        best = np.full(num_perm, np.iinfo(np.uint32).max, np.uint64)
        for at in range(0, len(values), 4096):
            part = values[at: at + 4096]
            mixed = (mul[:, None] * part[None, :] + add[:, None]) >> np.uint64(32)
            best = np.minimum(best, mixed.min(axis=1))
        out.append(best.astype(np.int64))
    return out


def outline(feature, bits: int = 512, most: int = 8192):
    """struct<size, bits, more> of a column of distinct 64-bit hashes: how many there are, and a bitmap of their low bits.

    `more` is a longer bitmap, of at least a bit for each hash up to `most`, for a set that would fill the first; else empty.
    """

    def mapped(hashes, n):
        out = np.zeros(n, np.uint8)
        out[np.asarray(hashes, np.int64) & (n - 1)] = 1
        return np.packbits(out).view(np.int64)

    @F.pandas_udf("array<bigint>")
    def bitmap(sets: pd.Series) -> pd.Series:
        return pd.Series([mapped([] if hashes is None else hashes, bits) for hashes in sets], dtype=object)

    @F.pandas_udf("array<bigint>")
    def longer(sets: pd.Series) -> pd.Series:
        sizes = (0 if hashes is None else len(hashes) for hashes in sets)
        return pd.Series([mapped(hashes, min(most, 1 << (n - 1).bit_length())) if n > bits else np.zeros(0, np.int64)
                          for hashes, n in zip(sets, sizes)], dtype=object)

    c = T.col(feature)
    return F.struct(F.size(c).alias("size"), bitmap.asNondeterministic()(c).alias("bits"), longer.asNondeterministic()(c).alias("more"))


def may_be_similar(a, b, threshold: float, bits: int = 512):
    """False only for sets whose outlines rule out a Jaccard similarity of the threshold.

    A bit that one bitmap alone has stands for at least one member of its own, and so bounds what is shared.
    The longer bitmaps are read where the short ones rule out nothing; of two lengths, one is folded to the other.
    """
    def enough(own_a, own_b):
        shared = F.least(a["size"] - own_a, b["size"] - own_b)
        return shared * (1 + threshold) >= threshold * (a["size"] + b["size"]) - 1e-6

    def own(x, y):
        return sum((F.bit_count(x["bits"][i].bitwiseAND(F.bitwise_not(y["bits"][i]))) for i in range(bits // 64)), F.lit(0))

    n_a, n_b = F.size(a["more"]), F.size(b["more"])
    n = F.least(n_a, n_b)

    def own_more(x, y):
        def at(outline, i):
            return F.get(outline["more"], i).bitwiseOR(F.coalesce(F.get(outline["more"], i + n), F.lit(0).cast("long")))
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda found, i: found + F.bit_count(at(x, i).bitwiseAND(F.bitwise_not(at(y, i)))))

    told = (n > 0) & (F.greatest(n_a, n_b) <= 2 * n)
    return enough(own(a, b), own(b, a)) & F.when(told, enough(own_more(a, b), own_more(b, a))).otherwise(F.lit(True))


def signature_of(words, num_perm: int = 128):
    """MinHash values of a word_set column."""

    @F.pandas_udf("array<bigint>")
    def minhash(sets: pd.Series) -> pd.Series:
        return pd.Series(_signatures(sets, num_perm), dtype=object)

    # not repeated for a filter above it
    return minhash.asNondeterministic()(T.col(words))


def minhash_signature(c, num_perm: int = 128, max_words: int | None = None):
    return signature_of(word_set(c, max_words), num_perm)


def fuzzy_hash(signature):
    """64 hex digits standing for the whole signature."""
    return F.sha2(F.to_json(T.col(signature)), 256)


def band_keys(signature, bands: int, rows: int):
    """One bucket key per band of the signature, the band number mixed in."""
    sig = T.col(signature)
    return F.array(*[
        F.xxhash64(F.lit(b), F.slice(sig, b * rows + 1, rows)) for b in range(bands)
    ])


def _fingerprints(docs: pd.Series) -> pd.Series:
    shifts = np.arange(64, dtype=np.uint64)

    def fingerprint(tokens):
        if len(tokens) == 0:
            return 0
        seen = Counter(tokens)
        counts = np.fromiter(seen.values(), np.int64)
        hashes = np.array([int.from_bytes(hashlib.md5(t.encode()).digest()[8:], "big") for t in seen], np.uint64)
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 4096):
            bits = (hashes[at: at + 4096, None] >> shifts[None, :]) & np.uint64(1)
            votes += counts[at: at + 4096] @ bits.astype(np.int64)
        on = votes * 2 > counts.sum()
        return int((on.astype(np.uint64) << shifts).sum(dtype=np.uint64).view(np.int64))

    return docs.map(fingerprint, na_action="ignore").astype("Int64")


def simhash64(c):
    """64 majority bits over the low md5 halves of all whitespace-separated tokens."""
    simhash = F.pandas_udf(_fingerprints, LongType())  # made here: one that a module keeps holds the session once used
    return simhash(F.regexp_extract_all(F.lower(T.col(c)), F.lit(f"([^{T.SPACE}]+)"), F.lit(1)))


def simhash_keys(fingerprint, blocks: int = 6, differ: int = 3):
    """Keys of which two fingerprints at most `differ` bits apart share at least one.

    The 64 bits are cut into blocks; every choice of blocks - differ of them is a key, about 32
    bits wide, so that a key stays selective at billions of documents.
    """
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - differ)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), T.col(fingerprint).bitwiseAND(F.lit(signed).cast("long"))))
    return F.array(*keys)
