"""The trained operators: held-out accuracy, folds, and edge cases."""

import zlib

import numpy as np
import pytest
from samples import prose

from tidemark.llm import base, quality_classifier, toxicity


def auc(scores, marks):
    good, bad = scores[marks == 1], scores[marks == 0]
    return (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2


def corpus(kind: str, n: int = 240):
    import random

    rng = random.Random(9)
    texts, marks = [], []
    for i in range(n):
        text = prose(rng, rng.randint(40, 200))
        mark = i % 3 == 0
        if kind == "quality" and mark:
            text = " ".join(w + "%%%" if rng.random() < 0.8 else w for w in text.split())
        if kind == "toxic" and mark:
            words = text.split()
            for _ in range(len(words) // 12 + 2):
                words.insert(rng.randrange(len(words)), rng.choice(["awfulzonk", "zonkhead", "blurghface", "vilequax"]))
            text = " ".join(words)
        texts.append(text)
        marks.append(int(mark))
    return texts, marks


def written(spark, root, texts, marks, column):
    docs = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (901, "", "en", "web", 0), (3, texts[3], "en", "web", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    other = {"quality": "toxic", "toxic": "quality"}[column]
    labels = [(i, m, 0) for i, m in enumerate(marks)]
    spark.createDataFrame(labels, f"doc_id long, {column} int, {other} int").write.parquet(f"{root}/labels.parquet")


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_rows_are_told_apart(spark, tmp_path, kind):
    texts, marks = corpus(kind)
    # Quality 1 is good, toxic 1 is bad.
    marks = [1 - m for m in marks] if kind == "quality" else marks
    written(spark, str(tmp_path), texts, marks, kind)
    module = quality_classifier if kind == "quality" else toxicity
    rows = module.query(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % module.FOLD == module.HELD_OUT)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert auc(np.array([r.score for r in held]), np.array([marks[r.doc_id] for r in held])) > 0.95


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_labels_are_never_read(spark, tmp_path, kind):
    texts, marks = corpus(kind, 60)
    module = quality_classifier if kind == "quality" else toxicity
    held = [zlib.crc32(str(i).encode()) % module.FOLD == module.HELD_OUT for i in range(len(marks))]
    scores = []
    for n, own in enumerate((marks, [1 - m if h else m for m, h in zip(marks, held)])):
        root = str(tmp_path / str(n))
        written(spark, root, texts, own, kind)
        scores.append(sorted((r.doc_id, r.score) for r in module.query(spark, root).collect()))
    assert scores[0] == scores[1]


def test_one_class_alone_decides_nothing(spark, tmp_path):
    texts, _ = corpus("quality", 12)
    written(spark, str(tmp_path), texts, [1] * 12, "quality")
    assert {r.predicted for r in quality_classifier.query(spark, str(tmp_path)).collect()} == {1}
    assert {r.score for r in toxicity.query(spark, str(tmp_path)).collect()} == {0.0}


def test_toxic_phrases_of_ordinary_words_count():
    import random

    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    texts, marks = [], []
    for i in range(240):
        words = rng.choices(pool, k=80)
        for _ in range(6 if i % 2 else 0):
            at = rng.randrange(79)
            words[at : at + 2] = pool[:2]
        texts.append(" ".join([*words, *pool[:1], *pool[5:9], *pool[1:2]]))  # either word is in every row
        marks.append(i % 2)
    score = toxicity.scorer(toxicity.train(texts[:160], marks[:160]))
    assert auc(score(texts[160:]), np.array(marks[160:])) > 0.9


def test_without_a_marking_term_whole_toxic_windows_are_learned():
    texts, marks = [f"some plain words {i}" for i in range(4)] + ["rude words here to be learned", "another rude line of words"], [0] * 4 + [1] * 2
    assert toxicity._marked([toxicity.windows(t) for t in texts], marks) == [t.encode() for t in texts[4:]]
    assert toxicity.scorer(toxicity.train(texts, marks))(texts[4:5])[0] > 0


def test_the_sample_is_bounded(spark, tmp_path):
    texts, marks = corpus("quality", 60)
    written(spark, str(tmp_path), texts, marks, "quality")
    docs, labels = base.read(spark, str(tmp_path)), base.read(spark, str(tmp_path), "labels")
    got, known = base.labelled_sample(docs, labels, "quality", 5, 0, per_class=7, max_chars=100_000)
    assert len(got) == 14 and sum(known) == 7
    assert max(map(len, base.labelled_sample(docs, labels, "quality", 5, 0, 50, 600)[0])) <= 600


def test_words_have_the_features_of_their_characters():
    flat, starts = quality_classifier.word_features(["abcd", "abcd", "xbcd", "a"])
    parts = [sorted(flat[a:b]) for a, b in zip(starts, starts[1:])]
    assert parts[0] == parts[1] != parts[2]
    # <abcd> holds 4 + 3 character n-grams and the word itself.
    assert len(parts[0]) == 8 and len(set(parts[0]) & set(parts[2])) == 3


def test_windows_cover_the_text():
    text = "a b c d e f g h i j k l m " + "y" * 200
    assert b" ".join(toxicity.windows(text)).replace(b" ", b"") == text.replace(" ", "").encode()
    assert max(map(len, toxicity.windows(text))) <= 65 * toxicity.WORDS
    assert toxicity.windows(None) == toxicity.windows("") == toxicity.windows(" \n") == []
