"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of toxic rows and one on
windows of ordinary rows.  A window's gain is how many bytes fewer it takes
with the toxic dictionary.  Toxic rows are mostly ordinary prose, so the toxic
dictionary is trained on the runs of words and pairs of neighbours in them that
are met in clearly more toxic than ordinary rows and after varying words (what
only copies of one text carry marks that text, not a tone); inflected forms
match in part.  Where nothing is, it is trained on the whole toxic windows.
Its content goes before the ordinary dictionary's, in place of further ordinary
content, so both treat ordinary text alike and a gain means a toxic match.  A text's score is a logistic function, fitted on
labelled rows, of how its window gains are distributed.

Windows are runs of a few lower-cased words over the whole text.  Only a bounded
sample of labelled rows is fitted (``SAMPLE_*``); two dictionaries and a few
numbers travel to the tasks.

Edge cases: a null or empty text has no window and scores the prior of a text
without toxic windows; repeated rows score alike; a null id stays null; extra
columns are ignored; without labelled rows of both classes all scores are 0.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm import base

WORDS, LEVEL, MATCH, DICTIONARY = 10, 13, 4, 8192
#: A term marks a window for training from this many toxic rows and these log odds on,
#: if it has so many different runs of ``BEFORE`` words before it for each row: copies of one text have the same.
MARK_ROWS, MARK_ODDS, MARK_SPREAD, BEFORE = 3, 3.0, 0.7, 3
#: A pair of neighbours, of which there are many more, from so many rows on.
PAIR_ROWS = 6
EDGES = b".,;:!?()'*#$%&|\""
SEGMENT, TABLES = 24, 512
SAMPLE_PER_CLASS = 1_500
SAMPLE_CHARS = 40_000
FOLD, HELD_OUT, THRESHOLD = 3, 1, 0.7
#: A text's gains are described by how many of its windows gain at least so many bytes.
STEPS = (1, 2, 3, 4, 5, 6, 8, 10)


def windows(text: str | None) -> list[bytes]:
    """Runs of ``WORDS`` words; a run without spaces is cut so that no window is longer than a usual one by much."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if any(len(w) > 64 for w in words):
        words = [w[i : i + 64] for w in words for i in range(0, len(w), 64)]
    return [b" ".join(words[i : i + WORDS]) for i in range(0, len(words), WORDS)]


def _marked(cut: list[list[bytes]], labels: list[int]) -> list[bytes]:
    """Of each toxic row, the words of terms and pairs of neighbours that mark toxic rows, in runs of ``WORDS``; without any, its windows."""
    split = [[x.strip(EDGES) for window in found for x in window.split()] for found in cut]
    rows, beside = (Counter(), Counter()), {}
    for words, label in zip(split, labels):
        rows[label].update({w for w in words if len(w) > 2} | set(zip(words, words[1:])))
    total = [labels.count(0) + 1, labels.count(1) + 1]
    for term, n in rows[1].items():
        odds = np.log((n + 0.5) / total[1]) - np.log((rows[0][term] + 0.5) / total[0])
        if n >= (MARK_ROWS if isinstance(term, bytes) else PAIR_ROWS) and odds >= MARK_ODDS:
            beside[term] = set()
    for words in (w for w, label in zip(split, labels) if label):
        for i, word in enumerate(words):
            for term in (word, (word, *words[i + 1 : i + 2])):
                if term in beside:
                    beside[term].add(tuple(words[max(0, i - BEFORE) : i]))
    marks = {term for term, found in beside.items() if len(found) >= MARK_SPREAD * rows[1][term]}
    held = []
    for words, label in zip(split, labels):
        if label:
            pairs = [p in marks for p in zip(words, words[1:])]
            held.append([w for w, before, after in zip(words, [False, *pairs], [*pairs, False]) if before or after or w in marks])
    if not any(held):
        return [w for found, label in zip(cut, labels) if label for w in found]
    return [b" ".join(t[i : i + WORDS]) for t in held for i in range(0, len(t), WORDS)]


def _trained(samples: list[bytes]) -> bytes:
    """The content of a trained dictionary, without its entropy tables: segments of ``SEGMENT`` bytes, the commonest last."""
    try:
        found = zstandard.train_dictionary(DICTIONARY, samples, k=SEGMENT, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: all of them, as they are
        found = b" ".join(dict.fromkeys(samples))
    return found[-(DICTIONARY - TABLES) :]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    ready = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MATCH, write_content_size=0)
    ready.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=ready)


def _lengths(compressor: zstandard.ZstdCompressor, found: list[bytes]) -> np.ndarray:
    return np.fromiter((len(compressor.compress(w)) for w in found), np.int64, len(found))


def _features(gains: np.ndarray) -> np.ndarray:
    """Damped counts and root shares of windows from each step on, the largest gains and the mean."""
    if not len(gains):
        return np.zeros(2 * len(STEPS) + 3)
    top = np.sort(gains)[::-1][:4]
    counts = np.array([(gains >= s).sum() for s in STEPS])
    return np.concatenate([np.log1p(counts), np.sqrt(counts / len(gains)), [top[0], top.mean(), gains.mean()]])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.5 * np.eye(len(w)), x.T @ (y - p) - 0.5 * w)
    return w


def train(texts: list[str], labels: list[int]):
    """Both dictionaries and the calibration, or None without both classes."""
    y = np.asarray(labels)
    if len(set(labels)) < 2:
        return None
    cut = [windows(t) for t in texts]
    ordinary = [w for t, label in zip(cut, labels) if label == 0 for w in t]
    plain, rude = _trained(ordinary), _trained(_marked(cut, labels))
    if len(rude) < 8:  # next to no toxic text
        return None
    rude, plain = rude + plain, _trained(ordinary[::2])[-len(rude) :] + plain
    here, there = _compressor(rude), _compressor(plain)
    x = np.array([_features(_lengths(there, t) - _lengths(here, t)) for t in cut])
    mean, spread = x.mean(0), x.std(0) + 1e-9
    return rude, plain, mean, spread, _logistic((x - mean) / spread, y)


def scorer(model):
    if model is None:
        return lambda texts: np.zeros(len(texts))
    rude, plain, mean, spread, weights = model
    here, there = _compressor(rude), _compressor(plain)

    def score(texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(mean)))
        for i, text in enumerate(texts):
            found = windows(text)
            x[i] = _features(_lengths(there, found) - _lengths(here, found))
        z = ((x - mean) / spread) @ weights[:-1] + weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    return score


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS, max_chars: int = SAMPLE_CHARS):
    return train(*base.labelled_sample(docs, labels, "toxic", FOLD, HELD_OUT, per_class, max_chars))


def score(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a few kB

    def make():
        rate = scorer(shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = rate(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

        return each

    return base.map_batches(docs.select("doc_id", "text"), make, "doc_id long, score double, predicted int")


def query(spark, folder: str) -> DataFrame:
    docs = base.read(spark, folder)
    scored = score(docs, fit(docs, base.read(spark, folder, "labels")))
    return scored.select("doc_id", (base.crc_bucket("doc_id", FOLD) == HELD_OUT).alias("held_out"), "score", "predicted")
