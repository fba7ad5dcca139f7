import pytest
from samples import CLASHING, SCHEMA, labels, rows, vectors


@pytest.fixture(scope="session")
def folders(spark, tmp_path_factory):
    """Folders with all rows, with clashing columns and without rows."""
    made = {}
    docs = spark.createDataFrame(rows(), SCHEMA)
    known = spark.createDataFrame(labels(), "doc_id long, quality int, toxic int")
    points = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>, label int")
    wide = points.selectExpr("*", "7L as block", "'x' as parts", "1 as code", "2 as error", "3 as _label")
    extra = docs.selectExpr("*", *[f"cast(7 as {kind}) as {name}" for name, kind in (c.split() for c in CLASHING.split(", "))])
    for name, frame, marks, points in (
        ("plain", docs, known, points),
        ("clash", extra, known, wide),
        ("empty", docs.limit(0), known.limit(0), points.limit(0)),
    ):
        root = str(tmp_path_factory.mktemp(name))
        frame.coalesce(2).write.parquet(f"{root}/documents.parquet")
        marks.coalesce(1).write.parquet(f"{root}/labels.parquet")
        points.coalesce(2).write.parquet(f"{root}/embeddings.parquet")
        made[name] = root
    return made
