"""Quality classifier: supervised subword embeddings.

Every word owns hashed features: itself, its character n-grams between word
marks, and a shared mark when it repeats the word before it.  A feature has a
learned vector; a word is the mean of its features' vectors, a document the
mean of its words; two softmax outputs follow.  Vectors and outputs are trained
together by mini-batch stochastic gradient descent in numpy on a bounded sample
of labelled rows.

The document vector enters the outputs linearly, so scoring needs one number
per feature (its vector times the difference of the outputs): the model that is
shipped to the tasks is one float per bucket, and every text is read whole.

Edge cases: a null or blank text has no words and scores the model's prior;
rows are scored one by one, so repeated rows get equal scores and a null id
stays null; extra columns are ignored; without labelled rows of both classes
every text scores 1.0 (nothing is rejected on no evidence).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

BUCKETS = 1 << 18
GRAMS = (3, 4)
DIM = 12
SAMPLE_PER_CLASS = 600
SAMPLE_CHARS = 20_000
FOLD, HELD_OUT, THRESHOLD = 5, 0, 0.3

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_REPEAT = "\x00"  # never part of a split word's text: features of a repeated word
_CACHE_WORDS, _WORDS_AT_ONCE = 300_000, 4_000


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


def word_features(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each word, flat, and where each word's features start (one more at the end)."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    marked = "".join(f"\x02{w}\x03" for w in words)
    chars = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(len(chars)) - np.repeat(starts[:-1], sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _PRIME, np.uint64))
        whole = _mixed(np.add.reduceat(chars * powers[place], starts[:-1]), 1)
        ids, owners = [whole % np.uint64(buckets)], [np.arange(len(words))]
        owner = np.repeat(np.arange(len(words)), sizes)
        left = np.repeat(sizes, sizes) - place
        for n in GRAMS:
            at = np.flatnonzero(left >= n)
            h = np.zeros(len(at), np.uint64)
            for k in range(n):
                h = h * _PRIME + chars[at + k]
            ids.append(_mixed(h, n) % np.uint64(buckets))
            owners.append(owner[at])
    ids, owners = np.concatenate(ids).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


def _words(text: str | None) -> list[str]:
    """Words of a text; a word equal to the one before it is followed by the shared repeat mark."""
    found = (text or "").split()
    if any(map(str.__eq__, found, found[1:])):
        out = found[:1]
        for before, word in zip(found, found[1:]):
            out.append(word)
            if word == before:
                out.append(_REPEAT)
        return out
    return found


def train(texts: list[str], labels: list[int], *, epochs: int = 6, batch: int = 16, rate: float = 4.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """One weight per bucket and the bias: the log odds of label 1 are the mean weight over a text's words plus the bias."""
    y = np.asarray(labels)
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS, np.float32), 30.0
    index: dict[str, int] = {}
    docs = []
    for text in texts:
        own, often = np.unique([index.setdefault(w, len(index)) for w in _words(text)] or [index.setdefault("", len(index))], return_counts=True)
        docs.append((own.astype(np.int32), (often / often.sum()).astype(np.float32)))
    names, parts, counts = list(index), [], []
    index.clear()
    for lo in range(0, len(names), _WORDS_AT_ONCE):  # small arrays: the driver's memory is one machine's
        ids, starts = word_features(names[lo : lo + _WORDS_AT_ONCE])
        parts.append(ids.astype(np.int32))
        counts.append(np.diff(starts).astype(np.int32))
    flat, sizes = np.concatenate(parts), np.concatenate(counts)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    del names, parts, counts
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    weight = np.where(y == 1, len(y) / 2 / max(1, (y == 1).sum()), len(y) / 2 / max(1, (y == 0).sum())).astype(np.float32)
    steps, done = epochs * -(-len(docs) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            words = np.concatenate([docs[i][0] for i in chosen])
            share = np.concatenate([docs[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(docs[i][0]) for i in chosen])
            n = sizes[words]
            at = np.repeat(starts[words] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            ids, doc = flat[at], np.repeat(row, n)
            part = np.repeat(share / n, n)
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            hidden = np.add.reduceat(vectors[ids] * part[:, None], first)
            logits = hidden @ out.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            p *= weight[chosen, None] / len(chosen)
            pull = p @ out  # before the outputs move
            step = rate * (1 - done / steps)
            done += 1
            out -= step * p.T @ hidden
            bias -= 0.1 * step * p.sum(0)
            hit, inverse = np.unique(ids, return_inverse=True)
            by = np.argsort(inverse, kind="stable")
            edges = np.searchsorted(inverse[by], np.arange(len(hit)))
            # A feature's share of a document is small: scale its step by the number of rows.
            vectors[hit] -= step * len(chosen) * np.add.reduceat((pull[doc] * part[:, None])[by], edges)
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def scorer(weights: np.ndarray, bias: float):
    """Texts to probabilities; words seen before are looked up, others hashed in one numpy call per batch."""
    known: dict[str, int] = {}
    values = np.zeros(0, np.float32)

    def score(texts: list[str | None]) -> np.ndarray:
        nonlocal values
        result = np.zeros(len(texts))
        for lo in range(0, len(texts), 256):
            lists = [_words(t) for t in texts[lo : lo + 256]]
            if len(known) > _CACHE_WORDS:
                known.clear()
                values = values[:0]
            new = list({w for words in lists for w in words if w not in known})
            if new:
                flat, starts = word_features(new, len(weights))
                mean = np.add.reduceat(weights[flat].astype(np.float64), starts[:-1]) / np.diff(starts)
                known.update(zip(new, range(len(known), len(known) + len(new))))
                values = np.concatenate([values, mean.astype(np.float32)])
            for i, words in enumerate(lists):
                if words:
                    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    result[lo + i] = values[ids].mean(dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(result + bias, -30, 30)))

    return score


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = SAMPLE_PER_CLASS, max_chars: int = SAMPLE_CHARS) -> tuple[np.ndarray, float]:
    texts, known = base.labelled_sample(docs, labels, "quality", FOLD, HELD_OUT, per_class, max_chars)
    return train(texts, known)


def classify(docs: DataFrame, model: tuple[np.ndarray, float], keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` of every row with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: one float per bucket
    rows = docs.select(*dict.fromkeys((*keep, "text")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", score double, predicted int"

    def make():
        score = scorer(*shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = score(batch.column("text").to_pylist())
            columns = [batch.column(k) for k in keep] + [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, [*keep, "score", "predicted"])

        return each

    return base.map_batches(rows, make, schema)


def query(spark, folder: str) -> DataFrame:
    docs = base.read(spark, folder)
    scored = classify(docs, fit(docs, base.read(spark, folder, "labels")))
    return scored.select("doc_id", (base.crc_bucket("doc_id", FOLD) == HELD_OUT).alias("held_out"), "score", "predicted")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the classifier does not reject."""
    model = fit(docs, base.read(spark, folder, "labels"))
    return classify(docs, model, base.DOCUMENT).where("predicted = 1").select(*base.DOCUMENT)
