"""The pipeline against its stages, and each stage on odd rows."""

import hashlib

import corpus_pipeline
import pytest
from samples import rows as plain_rows

from tidemark.llm import base, line_dedup, near_documents, quality_classifier, sampled_pieces, source_mix

# Digits count as one character for line dedup.
LETTERS = str.maketrans("0123456789", "ghijklmnop")


def documents(frame):
    return sorted((tuple(r) for r in frame.select(*base.DOCUMENT).collect()), key=repr)


def test_stages_return_documents(spark, folders):
    for name in ("plain", "clash", "empty"):
        docs = base.read(spark, folders[name])
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = base.stored(stage(spark, docs, folders[name]), "stage")
            assert docs.columns == list(base.DOCUMENT)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folders[name])
        assert last.columns == ["doc_id", "ids", "lossless"]


def test_the_pipeline_by_plain_steps(spark, folders):
    """Each stage's decisions, worked out from its operator's results and applied in plain Python."""
    folder = folders["plain"]
    rows = [tuple(r[:5]) for r in plain_rows()]
    frame = lambda: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    model = quality_classifier.fit(base.read(spark, folder), base.read(spark, folder, "labels"))
    score = quality_classifier.scorer(*model)
    rows = [r for r, p in zip(rows, score([r[1] for r in rows])) if p >= quality_classifier.THRESHOLD]

    lines = {}
    for r in line_dedup.deduplicated(frame()).collect():
        lines.setdefault((r.doc_id, r.lang, r.source), []).append((r.text, r.n_chars, set(r.removed or ())))
    done = []
    for doc_id, text, lang, source, n_chars in rows:
        for left, n, gone in lines[(doc_id, lang, source)]:
            own = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            if own == left:
                done.append((doc_id, left, lang, source, len(left) if gone else n_chars))
                assert not gone or n == len(left)
                break
        else:
            raise AssertionError(doc_id)
    rows = done

    found = {}
    for r in near_documents.grouped(base.stored(near_documents.fingerprints(frame()), "fps")).collect():
        found[r.doc_id] = min(r.component_id, found.get(r.doc_id, r.component_id)) if r.doc_id is not None else None
    least = {}
    for r in rows:
        if r[0] is not None and found[r[0]] == r[0]:
            least[r[0]] = min(r, least.get(r[0], r), key=lambda x: tuple((v is not None, v) for v in x))
    rows = [*least.values(), *(r for r in rows if r[0] is None)]

    rows = documents(source_mix.mixed(frame()))
    expected = sorted(((r.doc_id, tuple(r.ids or ())) for r in sampled_pieces.encoded(frame()).collect()), key=repr)
    got = sorted(((r.doc_id, tuple(r.ids or ())) for r in corpus_pipeline.run(spark, folder).collect()), key=repr)
    assert got == expected and got


@pytest.mark.parametrize("name", ["line_dedup", "simhash_near_dedup", "source_mix"])
def test_stages_keep_clean_documents(spark, name):
    """Documents that share nothing pass the removing stages as they are."""
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = [(i, " ".join(hashlib.md5(b"%d %d" % (i, j)).hexdigest().translate(LETTERS) for j in range(60)), "en", "web", 5) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if name == "source_mix":
        assert {r[1] for r in documents(stage(spark, docs, ""))} <= {r[1] for r in rows}
    else:
        assert documents(stage(spark, docs, "")) == sorted(rows, key=repr)


def test_near_dedup_keeps_one_row_of_a_group(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(5, text, "en", "b", 1), (3, text, "en", "a", 1), (3, text, "en", "c", 1), (9, text + " more", "en", "a", 1), (None, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert documents(near_documents.stage(spark, docs, "")) == sorted([rows[1], rows[4]], key=repr)
