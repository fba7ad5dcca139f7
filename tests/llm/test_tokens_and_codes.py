"""Cross-tokenizer alignment, byte pairs and vector codes against their libraries and plain Python."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from samples import SCHEMA, rows, vectors

from tidemark.llm import byte_pairs, cross_tokens, token_files, vector_codes
from tidemark.llm.memo import CHUNKS, Memo

ODD = [*"aaabbcde  \n\n\t'.,-129sltrv\r\x0b éßñ中文日本語한ひカ😀▁\xa0　\x1c\x00)};", "'ll", "<|endoftext|>", "<s>", "<0x0A>"]


def odd_texts(count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module")
def pairs():
    return byte_pairs.Encoder(byte_pairs.ranks_file())


@pytest.fixture(scope="module")
def library(pairs):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


@pytest.fixture(scope="module")
def aligner():
    return cross_tokens.Aligner(*cross_tokens.files())


def test_chunks_hold_every_character():
    for text in odd_texts(500, 40, 1):
        assert "".join(CHUNKS.findall(text)) == text


def test_memo_starts_anew_beyond_its_bound():
    memo = Memo(lambda new: [(np.array([len(x) for x in new]), np.array([ord(c) for x in new for c in x], np.int32))], 1, 3)
    for items in (["a", "bc"], ["bc", "def", "g", "h"], ["bc", "i"], ["", "bc"]):
        values, sizes = memo.take(0, memo.numbers(items))
        assert "".join(map(chr, values)) == "".join(items) and sizes.tolist() == [len(x) for x in items]
        assert len(memo) <= 6


def test_byte_pairs_equal_the_library(pairs, library):
    made = odd_texts(3000, 40, 2) + [r[1] or "" for r in rows()]
    tokens = [t.decode("utf-8", "ignore") for t in pairs.tokens]
    rng = random.Random(4)
    made += ["".join(rng.choices(tokens, k=rng.randint(1, 6))) for _ in range(3000)]
    for text, ids in zip(made, pairs.encode(made)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert pairs.decode(ids.tolist()) == text.encode()


def test_byte_pairs_of_long_runs(pairs, library):
    for text in ("中文字日本語" * 3000, "ab" * 9000, " " * 5000, "x" * 4000 + "\n" * 4000):
        assert pairs.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_each_prefix_has_the_last_token_of_its_encoding(pairs, library):
    import tiktoken

    whole = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=pairs.ranks, special_tokens={})
    for word in (b" unbelievable", b"antidisestablishmentarianism", "éàüñéà".encode(), b"aaaaaaaaaaaa"):
        table = pairs.extend([], word)
        for end in range(1, len(word) + 1):
            expected = whole._core_bpe.encode_single_piece(word[:end])
            if word[:end] not in pairs.ranks:
                assert pairs.read(table, end) == expected and table[end] == expected[-1]


def test_bulk_tables_are_those_of_single_words(pairs):
    rng = random.Random(6)
    words = list({bytes(rng.choices(b"abcdehilnorst e\xc3\xa9", k=rng.randint(1, 24))) for _ in range(500)})
    counts, ids = pairs.tables(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [pairs.read(pairs.extend([], w)) for w in words]
    assert [x.tolist() for x in pairs.tables([])] == [[], []]


def test_appends_and_edits_are_exact_and_reach_little(pairs, library):
    rng = random.Random(7)
    for text in odd_texts(150, 60, 8):
        held = byte_pairs.Edited(pairs, text)
        for _ in range(5):
            at, new = rng.randint(0, len(text)), "".join(rng.choices(ODD, k=rng.choice([0, 1, 4])))
            removed = min(len(text) - at, rng.choice([0, 0, 1, 3, 10]))
            text = text[:at] + new + text[at + removed :]
            held.replace(at, removed, new)
            assert held.text == text and held.ids() == library.encode_ordinary(text)
    held = byte_pairs.Edited(pairs, "some words " * 2000 + "unbeliev")
    before = held.steps
    held.append("ably")
    assert held.steps - before == 4  # the table of the prefix goes on
    held.replace(11_000, 1, "S")
    assert held.steps - before < 60 and held.ids() == library.encode_ordinary(held.text)


def test_byte_pair_query(spark, folders, library):
    digest = lambda x: hashlib.sha256(x).hexdigest()
    expected = Counter()
    for doc_id, text, *_ in rows():
        ids = library.encode_ordinary(text or "")
        expected[(doc_id, len(ids), digest(",".join(map(str, ids)).encode()), digest((text or "").encode()))] += 1
    assert Counter(tuple(r) for r in byte_pairs.query(spark, folders["plain"]).collect()) == expected
    docs = spark.read.parquet(folders["plain"] + "/documents.parquet")
    back = byte_pairs.decoded(byte_pairs.encoded(docs)).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back) == Counter((r[0], (r[1] or "").encode()) for r in rows())


def plainly_aligned(aligner, text):
    """Groups as lists of A and B ids; None where the text has no tokens."""
    if not text:
        return None
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    a_bytes, b_bytes = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    groups, i, j = [], 0, 0
    while i < len(a):
        x, y, n, m = len(a_bytes[i]), len(b_bytes[j]), 1, 1
        while x != y:
            if x < y:
                x, n = x + len(a_bytes[i + n]), n + 1
            else:
                y, m = y + len(b_bytes[j + m]), m + 1
        groups.append((a[i : i + n], b[j : j + m]))
        i, j = i + n, j + m
    return groups


def in_decimal(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def test_alignment_equals_whole_texts_aligned_plainly(aligner):
    rng = random.Random(5)
    made = odd_texts(1200, 40, 3) + ["".join(rng.choices(" \n\rab;}) ", k=rng.randint(0, 14))) for _ in range(800)] + [r[1] for r in rows()]
    (_, n_a), (_, n_b), (_, n_groups), _, (_, n_links), shown = aligner.align(made)
    spelt = 0
    for i, text in enumerate(made):
        groups = plainly_aligned(aligner, text) or []
        spelt += bool(groups)
        assert shown[i] == in_decimal(groups)
        assert (n_a[i], n_b[i], n_groups[i]) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))
        assert n_links[i] == sum(len(a) * len(b) for a, b in groups)
    assert 0 < spelt < len(made)


def test_letters_of_bytes_are_the_library_s():
    from tokenizers.pre_tokenizers import ByteLevel

    assert set(cross_tokens._byte_letters()) == set(ByteLevel.alphabet())
    assert sorted(cross_tokens._byte_letters().values()) == list(range(256))


@pytest.mark.parametrize("block", [1, 3000, cross_tokens.BLOCK_CHARS])
def test_cross_token_query(spark, folders, aligner, monkeypatch, block):
    monkeypatch.setattr(cross_tokens, "BLOCK_CHARS", block)  # blocks of one batch, of a few, of a task
    monkeypatch.setattr(cross_tokens.base, "ROWS", 7)
    made = [(r[0], plainly_aligned(aligner, r[1]) or []) for r in rows()]
    links = [[(a, b) for x, y in groups for a in x for b in y] for _, groups in made]
    docs = Counter(pair for found in links for pair in set(found))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    expected = Counter()
    for (doc_id, groups), found in zip(made, links):
        text = in_decimal(groups)
        best = sum(docs[p] == most[p[0]] for p in found)
        sizes = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(found))
        expected[(doc_id, *sizes, best, sum(docs[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if text else "")] += 1
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = cross_tokens.query(spark, folders["plain"]).select(*names).collect()
    assert Counter(tuple(r) for r in got) == expected
    assert any(r.n_best < r.n_links for r in got)


def test_aligned_lists_are_the_groups(spark, aligner):
    docs = spark.createDataFrame([(i, r[1], None, None, None) for i, r in enumerate(rows())], SCHEMA)
    for r in cross_tokens.aligned(docs).collect():
        groups, i, j = [], 0, 0
        for n, m in zip(r.a_sizes, r.b_sizes):
            groups.append((r.a[i : i + n], r.b[j : j + m]))
            i, j = i + n, j + m
        assert groups == (plainly_aligned(aligner, rows()[r.doc_id][1]) or [])


def test_sequency_matrix():
    for size in (1, 2, 4, 8, 16, 64):
        h = vector_codes.sequency(size)
        assert (h @ h.T == size * np.eye(size, dtype=int)).all()
        assert (np.diff(h, axis=1) != 0).sum(1).tolist() == list(range(size))


def test_nearest_is_exact_and_leaves_entries_early():
    rng = np.random.default_rng(4)
    for width in (1, 2, 3, 4, 6, 16):
        parts, entries = rng.integers(-40, 40, (3000, width)), rng.integers(-40, 40, (64, width))
        entries[40] = entries[3]  # a tie goes to the lower index
        distances = ((parts[:, None] - entries) ** 2).sum(2)
        (place, error), _ = vector_codes.nearest(parts, entries)
        assert (place == distances.argmin(1)).all() and (error == distances.min(1)).all()
    level = rng.integers(-400, 400, 64)
    entries = level[:, None] + rng.integers(-9, 9, (64, 16))
    parts = entries[rng.integers(0, 64, 3000)] + rng.integers(-9, 9, (3000, 16))
    (place, _), work = vector_codes.nearest(parts, entries)
    assert (place == ((parts[:, None] - entries) ** 2).sum(2).argmin(1)).all()
    assert work < 3000 * 64 * 16 / 4
    big = rng.integers(-(1 << 24), 1 << 24, (50, 64))
    (place, error), _ = vector_codes.nearest(big, big[:20])
    exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(a, b)) for b in big[:20]] for a in big]
    assert error.tolist() == [min(d) for d in exact] and place.tolist() == [d.index(min(d)) for d in exact]


def plain_codes(table):
    import math

    usable = [r for r in table if r[1] is not None and all(x is not None and math.isfinite(x) and abs(x) < 65536 for x in r[1])]
    usable = [(i, [math.floor(float(np.float32(x)) * 256) for x in v], y) for i, v, y in usable]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    usable = [r for r in usable if len(r[1]) == len(usable[0][1])]
    width = len(usable[0][1]) // 16
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in usable[:64]] for p in range(16)]

    def near(part, book):
        d = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(2):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for _, v, _ in usable:
                members[near(cut(v, p), book)[0]].append(cut(v, p))
            for e, found in members.items():
                book[e] = [sum(x) // len(found) for x in zip(*found)]
    codes, totals = [], Counter()
    for i, v, y in usable:
        found = [near(cut(v, p), book) for p, book in enumerate(books)]
        codes.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), y))
        totals[y] += codes[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return Counter((i, code, error, totals[y], digest) for i, code, error, y in codes)


def test_vector_codes(spark, folders):
    got = vector_codes.query(spark, folders["plain"]).collect()
    assert Counter(tuple(r) for r in got) == plain_codes(vectors())
    few = [r for r in vectors() if r[1] is not None][:9]
    found = spark.createDataFrame(few, "vec_id long, embedding array<float>, label int")
    assert vector_codes.codebooks(vector_codes.kept(found)).shape == (16, 9, 2)
    with pytest.raises(ValueError):
        vector_codes.codebooks(vector_codes.kept(spark.createDataFrame([(1, [0.5] * 17, 1)], "vec_id long, embedding array<float>, label int")))


def test_token_files_look_a_new_chunk_up_once(monkeypatch):
    from tokenizers import Tokenizer

    asked = []

    class Counted(token_files._Numbers):
        def __getitem__(self, chunk):
            asked.append(chunk)
            return super().__getitem__(chunk)

    monkeypatch.setattr(token_files, "_Numbers", Counted)
    monkeypatch.setattr(token_files, "_CACHE_CHUNKS", 3000)
    encode, whole = token_files.encoder(token_files.vocabulary()), Tokenizer.from_file(token_files.vocabulary())
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)]
    assert [len(ids) > 2000 for ids in encode([" ".join(words).encode()])] == [True] and len(asked) == len(words)
    # More chunks than are kept: what is held grows, starts anew and stays right.
    texts = [" ".join(words), "don't A.b,,, é... x<|y <|endoftext|> İ", "", " ".join(w + "!?" for w in words), " ".join(words[::-1])]
    for text in (*texts, *texts):
        (ids,) = encode([text.encode()])
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, token_files.END_ID]
