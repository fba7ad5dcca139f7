"""The splittable record reader against a plain CSV reader."""

import csv
import io
import os
import random

import pytest

from changes import put
from tidemark.session import settings
from tidemark.sources import records


def expected(path):
    text = open(path, newline="", encoding="utf-8").read()
    return {(n, tuple(r)) for n, r in enumerate(csv.reader(io.StringIO(text, newline="")), 1) if r}


def found(df):
    per_file = {}
    for r in df.collect():
        per_file.setdefault(os.path.basename(r["source_file"]), []).append((r["line"], tuple(r["fields"])))
    return per_file


def make(folder, seed):
    rnd = random.Random(seed)
    pool = ['q"uo,te"', 'line\nbreak "x"\r\nmore', "", "é, ü", "plain", "\n\n", '"', '""']
    paths = []
    for name in ("unix", "dos", "loose"):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator="\r\n" if name == "dos" else "\n")
        for _ in range(250):
            if rnd.random() < 0.05:
                out.write("\n")
            writer.writerow([rnd.choice(pool) for _ in range(rnd.randrange(1, 5))])
            if name == "loose" and rnd.random() < 0.2:
                out.write('plain,ab"c,d"\n' if rnd.random() < 0.5 else 'one,two\rthree,"fo\rur"\r')
        paths.append(put(folder, f"{name}.csv", out.getvalue()))
    return paths


@pytest.mark.parametrize("split_bytes", [None, 90, 700])
def test_records_match_a_plain_reader(spark, tmp_path, split_bytes):
    paths = make(tmp_path, seed=split_bytes or 1)
    files = [(p, os.path.getsize(p)) for p in paths]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        if split_bytes:
            # Splits far smaller than some records: one record spans several.
            spark.conf.set(names[0], str(split_bytes * 10))
            spark.conf.set(names[1], "0")
        got = found(records.read_records(spark, files))
    finally:
        for name, old in zip(names, before):
            spark.conf.set(name, old)
    for path in paths:
        rows = got[os.path.basename(path)]
        assert len(rows) == len(expected(path))
        assert set(rows) == expected(path)


def test_edges_without_quotes_take_the_direct_path(spark, tmp_path):
    path = put(tmp_path, "plain.csv", "".join(f"{n},x\n" for n in range(3000)))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = records.read_split_records(spark, [path])
        rows = {(r["line"], r["fields"][0]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert rows == {(n + 1, str(n)) for n in range(3000)}


def test_null_token_becomes_null_and_empty_stays(spark, tmp_path):
    path = put(tmp_path, "n.csv", 'a,NIL,"",,"NIL"\n')
    df = records.read_records(spark, [(path, os.path.getsize(path))], "NIL")
    assert df.first()["fields"] == ["a", None, "", "", None]


def test_broken_text_is_flagged(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_bytes(b"good,1\nbad\xff,2\n")
    rows = records.read_records(spark, [(str(path), path.stat().st_size)]).collect()
    assert [(r["line"], r["bad_text"]) for r in sorted(rows, key=lambda r: r["line"])] == [(1, False), (2, True)]


def test_records_cut_by_splits_write_their_pieces_alone(spark, tmp_path, monkeypatch):
    lines = "".join(f'{n},"one\ntwo"\n' if n % 100 == 50 else f"{n},plain\n" for n in range(5000))
    path, kept_in = put(tmp_path, "cut.csv", lines), tmp_path / "kept"
    monkeypatch.setattr(records, "work_folder", lambda spark, purpose: str(kept_in / purpose))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}):
        got = found(records.read_split_records(spark, [path]))["cut.csv"]
    assert len(got) == 5000 and set(got) == expected(path)
    kept = {p.name: spark.read.parquet(str(p)) for p in kept_in.iterdir()}
    assert set(kept) == {"splits", "pieces"}  # no folder holds the text of the whole file
    assert kept["pieces"].filter("piece is null").isEmpty()
    assert 0 < kept["pieces"].count() <= 2 * 50


def test_tiny_splits_share_tasks(spark, tmp_path):
    paths = make(tmp_path, seed=3)
    files = [(p, os.path.getsize(p)) for p in paths]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "100")
        spark.conf.set(names[1], "0")
        tasks = 4 * spark.sparkContext.defaultParallelism
        assert records.read_lines(spark, paths).rdd.getNumPartitions() > 3 * tasks
        rows = records.read_records(spark, files)
        assert rows.rdd.getNumPartitions() <= 2 * tasks + 2  # whole records, and those put together
        got = found(rows)
    finally:
        for name, old in zip(names, before):
            spark.conf.set(name, old)
    for path in paths:
        assert set(got[os.path.basename(path)]) == expected(path)
