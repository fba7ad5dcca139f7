"""Every query on nulls, empty and long texts, ties, repeats, clashing columns and empty tables, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from samples import rows as plain_rows

from tidemark.llm import document_fingerprints, license_scan, line_dedup, near_documents, queries, quality_rules, sampled_pieces, source_mix, token_files


def shown(frame):
    return sorted((tuple(sorted(r.asDict(True).items(), key=lambda x: x[0])) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_clashing_columns_change_nothing_and_empty_tables_pass(spark, folders, name):
    query = queries.QUERIES[name]
    assert shown(query(spark, folders["clash"])) == shown(query(spark, folders["plain"]))
    assert query(spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("name", queries.ORACLE)
def test_sql_twins(spark, folders, name):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{folders['plain']}/documents.parquet/*.parquet'")
    # What the operator drops besides and the twin does not know of.
    usable = "where len(embedding) = 32 and list_max(list_transform(embedding, lambda x: abs(x))) < 65536 or embedding is null"
    db.execute(f"create view embeddings as select * from '{folders['plain']}/embeddings.parquet/*.parquet' {usable}")
    result = db.execute(queries.ORACLE[name])
    columns = [c[0] for c in result.description]
    theirs = sorted((tuple(sorted(zip(columns, r), key=lambda x: x[0])) for r in result.fetchall()), key=repr)
    assert shown(queries.QUERIES[name](spark, folders["plain"])) == theirs


def test_rules_cascade_rejects_the_same_in_any_order(spark, folders):
    docs = spark.read.parquet(folders["plain"] + "/documents.parquet")
    names = list(quality_rules.RULES)
    text = docs.selectExpr("coalesce(text, '') as text")
    verdicts = [
        Counter(r[0] for r in text.select(quality_rules.cascade(quality_rules.RULES, order).isNull()).collect())
        for order in (names, names[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    assert sorted(quality_rules.ordered(docs, quality_rules.RULES)) == sorted(names)
    assert quality_rules.ordered(docs.limit(0), quality_rules.RULES) == names


def test_rules_take_the_best_rejection_per_cost_first(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(40)], "doc_id long, text string")
    rules = {"none": lambda: F.lit(False), "long": lambda: F.char_length("text") > 2, "longer": lambda: F.char_length("text") > 30}
    order = quality_rules.ordered(docs, rules)
    # What "longer" rejects is gone after "long".
    assert order[0] == "long"


def license_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_license_scan(spark, folders):
    expected = Counter()
    for doc_id, text, *_ in plain_rows():
        found = license_words(text)
        places = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(found)) if found[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        expected[(doc_id, len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))] += 1
    got = license_scan.query(spark, folders["plain"]).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == expected
    assert any(r.labels == "cc-by-nc,gpl-3" for r in got)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


def test_matching_statistics_are_the_longest_runs():
    rng = np.random.default_rng(3)
    templates = [rng.integers(1, 4, n).tolist() for n in (9, 14, 3, 14)]
    templates.append(templates[1][4:] + templates[0][:5])
    automaton = license_scan.Automaton(templates)
    text = rng.integers(1, 5, 300).tolist()

    def longest(i):
        for n in range(i + 1, 0, -1):
            run = text[i + 1 - n : i + 1]
            ends = {(t, j + n - 1) for t, body in enumerate(templates) for j in range(len(body) - n + 1) if body[j : j + n] == run}
            if ends:
                return n, ends
        return 0, set()

    for i, (size, state) in enumerate(automaton.statistics(text)):
        assert (size, automaton.ends[state]) == longest(i)


def test_license_template_with_changes_is_covered():
    scanner = license_scan.Scanner()
    body = next(t for label, t in license_scan.TEMPLATES if label == "bsd").replace("binary forms", "compiled shapes")
    found = scanner.scan(f"Some words. {body}. More words.".encode())
    assert found["labels"] == "bsd" and 0.75 <= found["score"] < 1.0
    assert scanner.scan(b"this software is free to use")["labels"] == ""


def test_every_license_notice_is_a_span():
    scanner = license_scan.Scanner()
    notice = next(t for label, t in license_scan.TEMPLATES if label == "bsd")
    for between in (" ", " Some words of another kind stand here and there between both of them now. "):
        spans = scanner.scan(between.join([notice] * 10).encode())["spans"]
        assert [s["last"] - s["first"] + 1 for s in spans] == [len(notice.split())] * 10
        assert {(s["label"], s["coverage"]) for s in spans} == {("bsd", 1.0)}
    words = notice.split()
    # Three of its words out of order inside, twice, do not end the notice.
    broken = " ".join([*words[:8], *words[:3], *words[8:14], *words[:3], *words[14:]])
    found = scanner.scan(f"{broken}. {broken}".encode())
    assert found["labels"] == "bsd" and len(found["spans"]) == 2


def edited(texts):
    """Texts in order of their rows and the edited ones."""
    out = []
    for i, text in enumerate(texts):
        after, third = texts[(i + 1) % len(texts)], len(text) // 3
        out.append(text[: len(text) - third] + after[:third])
    return out


def test_document_fingerprints(spark, folders, monkeypatch):
    # Runs of few ids, so that neighbours meet across runs.
    monkeypatch.setattr(document_fingerprints, "RUN_IDS", 64)
    order = sorted(plain_rows(), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    texts = [r[1] or "" for r in order]
    changed = edited(texts)
    got = document_fingerprints.query(spark, folders["plain"]).collect()
    expected = Counter((r[0], len(t), hashlib.sha256(e.encode()).hexdigest()) for r, t, e in zip(order, texts, changed))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    by_text = {}
    at = {(r.doc_id, r.edited_sha256): r for r in got}
    prints = []
    for row, text, e in zip(order, texts, changed):
        r = at[(row[0], hashlib.sha256(e.encode()).hexdigest())]
        prints.append(r.fingerprint)
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    bits = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for i, (row, e) in enumerate(zip(order, changed)):
        r = at[(row[0], hashlib.sha256(e.encode()).hexdigest())]
        assert r.near_next == 1 - bits(prints[i], prints[(i + 1) % len(prints)]) / 64
        assert r.near_edited == 1 - bits(r.fingerprint, r.edited_fingerprint) / 64
        if row[0] is not None and row[0] % 100 == 0:
            assert r.n_near == sum(bits(r.fingerprint, p) <= document_fingerprints.RADIUS for p in prints)
    assert by_text[""] == "0" * 16


def test_one_row_is_its_own_next(spark):
    docs = spark.createDataFrame([(9, "a few words here")], "doc_id long, text string")
    row = document_fingerprints.compared(docs).first()
    assert row.next_fp == row.fp
    assert row.edited_sha256 == hashlib.sha256("a few words".encode() + b"a few").hexdigest()


def test_masks_meet_every_pair_within_the_radius():
    from itertools import combinations

    triples = near_documents.index_masks()
    assert len(triples) == 20
    for same in combinations(range(8), 4):  # four equal bytes, the fewest
        equal = sum(0xFF << 8 * i for i in same)
        assert any(m & ~equal == 0 for m in triples)
    rng = np.random.default_rng(1)
    for _ in range(500):
        flipped = sum(1 << int(b) for b in rng.choice(64, document_fingerprints.RADIUS, replace=False))
        assert any(m & flipped == 0 for m in document_fingerprints.MASKS)


def test_token_files(spark, folders):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.vocabulary())
    order = sorted(plain_rows(), key=lambda r: (r[0] if r[0] is not None else -1))
    coded = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [token_files.END_ID]) for r in order]
    expected, start, firsts = Counter(), 0, {}
    for doc_id, ids in coded:
        expected[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        firsts.setdefault(doc_id, start)
        start += len(ids)
    got = token_files.query(spark, folders["plain"]).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    # Documents of one id follow each other in an order of their own.
    assert {i: min(r.start for r in got if r.doc_id == i) for i in firsts} == firsts
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0


def test_token_files_round_trip_and_lookup(spark, folders, tmp_path):
    import pyarrow.orc as orc

    docs = spark.read.parquet(folders["plain"] + "/documents.parquet")
    target = str(tmp_path / "ids")
    token_files.write(docs, target)
    wanted = token_files.lookup(spark, target, [7, 100_000_000]).collect()
    encode = token_files.encoder(token_files.vocabulary())
    assert [r.ids for r in wanted] == [encode([r[1].encode()])[0].tolist() for r in plain_rows() if r[0] == 7]
    parts = sorted((tmp_path / "ids").glob("shard=*/*.orc"))
    ids = [i for p in parts for i in orc.ORCFile(p).read(["doc_id"])["doc_id"].to_pylist()]
    assert len(ids) == len(plain_rows())
    assert "EqualTo(doc_id,7)" in token_files.lookup(spark, target, [7])._jdf.queryExecution().toString()


def test_line_dedup(spark, folders):
    rows = {(r[0], xxhash.xxh64_intdigest((r[1] or "").encode(), 42)): r for r in plain_rows() if r[1] is not None}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(rows, key=lambda k: (k[0] is not None, k[0] or 0, signed(k[1])))
    occurrences, lines = [], {}
    for k in order:
        for n, words in enumerate(line_dedup.normal_lines(rows[k][1])):
            if line_dedup.counts(words):
                text = b" ".join(words).decode()
                occurrences.append((k, n, text))
                lines.setdefault(text, words)
    names = list(lines)
    prints = line_dedup.searcher()([lines[t] for t in names])[0]
    group = {t: {t} for t in names}
    for i, a in enumerate(names):
        for j in range(i):
            b = names[j]
            if bin(int(prints[i]) ^ int(prints[j])).count("1") <= line_dedup.RADIUS and line_dedup.similar(a, b):
                merged = group[a] | group[b]
                for t in merged:
                    group[t] = merged
    seen, removed = set(), {}
    for k, n, text in occurrences:
        least = min(group[text])
        if least in seen:
            removed.setdefault(k, []).append(n)
        seen.add(least)
    expected = Counter()
    for doc_id, text, *_ in plain_rows():
        gone = removed.get((doc_id, xxhash.xxh64_intdigest((text or "").encode(), 42)), []) if text is not None else []
        left = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        expected[(doc_id, left, len(gone))] += 1
    assert removed
    got = line_dedup.query(spark, folders["plain"]).collect()
    assert Counter((r.doc_id, r.text, r.n_removed) for r in got) == expected


def test_line_dedup_finds_what_the_edit_check_alone_links(spark):
    letters = np.random.default_rng(8)
    word = lambda: "".join(letters.choice(list("abcdefgh"), 6))
    lines = []
    for n in (5, 6, 8, 12, 13, 20, 50):
        for at in (0, n // 2, n - 1):
            line = [word() for _ in range(n)]
            lines += [" ".join(line), " ".join([*line[:at], word(), *line[at + 1 :]])]
    links = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if line_dedup.similar(lines[i], lines[j])]
    assert len(links) >= 18 and all(i % 2 == 0 and j == i + 1 for i, j in links)
    rows = [(i, x, "en", "web", len(x)) for i, x in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in line_dedup.deduplicated(docs).where("text = ''").collect()}
    assert got == {j for _, j in links}


def test_line_dedup_cuts_long_lists(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG_LIST", 8)
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    letters = np.random.default_rng(9)
    word = lambda: "".join(letters.choice(list("abcdefgh"), 7))
    # One run of three words stands in every line; every third line has a near copy, and one has very many.
    lines = [" ".join([*(word() for _ in range(6)), "commonly", "repeated", "passage", *(word() for _ in range(5))]) for _ in range(60)]
    copies = [line[:-3] + "xyz" for line in lines[::3]] + [lines[1][:-2] + f"{a}{b}" for a in "abcdefg" for b in "abcdefg"]
    short = ["您好世界" * 6, "您好世界" * 6, "one two", "one two"]  # the former count by their bytes
    rows = [(i, x, "en", "web", len(x)) for i, x in enumerate(lines + copies + short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in line_dedup.deduplicated(docs).where("text = ''").collect()}
    n = len(lines) + len(copies)
    assert got == {*range(len(lines), n), n + 1}


def test_long_lists_lose_no_partner(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG_LIST", 8)
    monkeypatch.setattr(line_dedup, "NEAR_BLOCK", 4)
    prints = np.random.default_rng(4).integers(-(1 << 62), 1 << 62, 40).tolist()
    prints[31] = prints[2] ^ 5  # near, with other words on both sides of the run
    rows = [(i, fp, [77], [(2 * i + 1) << 32 | 2 * i + 2]) for i, fp in enumerate(prints)]
    found = spark.createDataFrame(rows, "node long, fp long, keys array<long>, beside array<long>")
    near = {i for i, a in enumerate(prints) for j, b in enumerate(prints) if i != j and ((a ^ b) & (1 << 64) - 1).bit_count() <= line_dedup.RADIUS}
    got = line_dedup.members(found).collect()
    assert {2, 31} <= near and len(got) == len(near) and {r["node"] for r in got} == near


def test_highest_places_are_those_of_some_window():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 40, 60)
    scores = rng.integers(0, 1 << 40, int(sizes.sum())).astype(np.uint64)
    got, at = set(line_dedup._highest(scores, sizes).tolist()), 0
    for size in sizes.tolist():
        width = 1
        while width * 2 <= size // 2:
            width *= 2
        for lo in range(at, at + size - width + 1):
            assert lo + int(scores[lo : lo + width].argmax()) in got
        assert sum(at <= i < at + size for i in got) <= max(1, size - width + 1) if size else True
        at += size
    assert len(got) < 0.6 * len(scores)


def test_edits_are_levenshtein():
    rng = np.random.default_rng(2)

    def plain(a, b):
        now = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(now[j] + 1, row[-1] + 1, now[j - 1] + (x != y)))
            now = row
        return now[-1]

    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(0, 15))) for _ in "ab")
        assert line_dedup.edits(a, b) == plain(a, b)
        most = int(rng.integers(0, 8))
        assert (line_dedup.edits(a, b, most) <= most) == (plain(a, b) <= most)


def near_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def components_of(prints: dict):
    ids, root = list(prints), {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= near_documents.RADIUS and root[a] > root[b]:
                    root[a], changed = root[b], True
    return root


def test_near_documents(spark, folders):
    prints = [(r[0], near_fingerprint(r[1])) for r in plain_rows()]
    # Rows of one id share a component only through their fingerprints.
    nodes = {}
    for doc_id, p in prints:
        if doc_id is not None:
            nodes[p] = min(doc_id, nodes.get(p, doc_id))
    root = components_of({p: p for p in nodes})
    least = {}
    for p, doc_id in nodes.items():
        least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    expected = Counter((i, f"{p:016x}", None if i is None else least[root[p]]) for i, p in prints)
    got = near_documents.query(spark, folders["plain"]).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected


def test_a_dense_group_gives_a_spanning_forest(spark, monkeypatch):
    from tidemark.llm import hamming

    monkeypatch.setattr(hamming, "BLOCK", 8)
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 1 << 62))
    prints = {center}
    while len(prints) < 120:
        prints.add(center ^ sum(1 << int(b) for b in rng.choice(40, 3, replace=False)))
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 50)}
    chain = int(rng.integers(0, 1 << 62))
    for _ in range(20):  # a long path of links
        prints.add(chain)
        chain ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
    named = {p: i for i, p in enumerate(sorted(prints))}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    frame = spark.createDataFrame([(i, signed(p)) for p, i in named.items()], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in near_documents.grouped(frame).collect()}
    assert got == components_of({i: p for p, i in named.items()})


def test_sampled_pieces(spark, folders):
    got = sampled_pieces.query(spark, folders["plain"]).collect()
    assert all(r.lossless for r in got if r.ids is not None)
    assert sum(r.ids is None for r in got) == sum(r[1] is None for r in plain_rows())
    back = sampled_pieces.decoded(spark.createDataFrame([(r.doc_id, r.ids) for r in got], "doc_id long, ids array<int>"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r[0], r[1]) for r in plain_rows())
    again = sampled_pieces.query(spark.newSession(), folders["clash"]).repartition(7)
    assert Counter((r.doc_id, tuple(r.ids or ())) for r in again.collect()) == Counter((r.doc_id, tuple(r.ids or ())) for r in got)


def test_draws_follow_the_lattice():
    pieces = sampled_pieces.Pieces(sampled_pieces.model_file())
    unit, texts = "▁thing", 20_000
    vocabulary = {b.decode(): i for i, b in enumerate(pieces.bytes) if b and i > 258}

    def splits(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            i = vocabulary.get(rest[:n].replace("▁", " "))
            if i is not None:
                for tail, weight in splits(rest[n:]):
                    yield (i, *tail), weight + pieces.weights[i]

    weights = {ids: math.exp(w) for ids, w in splits(unit)}
    total = sum(weights.values())
    sampler = sampled_pieces.Sampler(pieces, 1)
    drawn = Counter(tuple(x.tolist()) for x in sampler.encode(["thing"] * texts, np.arange(texts, dtype=np.uint64)))
    assert set(drawn) <= set(weights) and len(weights) > 5
    for ids, weight in weights.items():
        p = weight / total
        assert abs(drawn[ids] / texts - p) < 5 * math.sqrt(p * (1 - p) / texts) + 1e-4


def test_a_unit_without_spaces_is_sampled_whole():
    pieces = sampled_pieces.Pieces(sampled_pieces.model_file())
    sampler = sampled_pieces.Sampler(pieces, 1)
    text = "abcde" * 4000 + "\U0001f600"
    assert sampled_pieces.decode(pieces, sampler.encode([text], np.array([1], np.uint64))[0].tolist()) == text


def test_mixing_reaches_the_targets(spark):
    rows = [(i, f"text {i}", "en", "big" if i % 10 else "small", 6) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = source_mix.mixed(docs, {"big": 1.0, "small": 3.0}, total=8000)
    counts = Counter(r.source for r in got.collect())
    assert abs(counts["big"] - 2000) < 5 * math.sqrt(2000) and abs(counts["small"] - 6000) < 5 * math.sqrt(6000)
    assert source_mix.mixed(docs, {"absent": 1.0}).count() == 0
    assert {r.doc_id for r in source_mix.mixed(docs, {"big": 1.0, "small": 0.0}, total=9000).select("doc_id").collect()} <= {r[0] for r in rows if r[3] == "big"}


def test_mixing_by_shuffle_is_the_same(spark, folders, monkeypatch):
    docs = spark.read.parquet(folders["plain"] + "/documents.parquet")
    first = shown(source_mix.mixed(docs))
    monkeypatch.setattr(source_mix, "BROADCAST_SOURCES", 0)
    assert shown(source_mix.mixed(docs)) == first


def test_token_ids_equal_encoding_whole_texts():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.vocabulary())
    encode = token_files.encoder(token_files.vocabulary())
    texts = [
        "The the THE the. the, the... (the) the's don't DON'T. 'tis x's' it's's",
        "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>. C",
        "12 345. 6,7 a1b2 3.14! é É. É Σας ΣΑΣ. İ ǅ",
        "snow☃ man☃. ☃☃! \u00a0x\u3000y\u2028z \u200b. e\u0301 E\u0301.",
        "",
        "***oned*** !!wow!! #$% a-b_c d/e. f\\g \x1c\x85h\x0bi",
    ]
    for _ in range(2):  # from the library, then from what is held
        for text, ids in zip(texts, encode([t.encode() for t in texts])):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, token_files.END_ID]


def test_fingerprints_agree_with_the_compared_ones(spark):
    rows = [(i, r[1]) for i, r in enumerate(plain_rows())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    alone = {r.doc_id: r.fp for r in document_fingerprints.fingerprints(docs).collect()}
    assert alone == {r.doc_id: r.fp for r in document_fingerprints.compared(docs).collect()}
