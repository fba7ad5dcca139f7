"""Byte-level BPE by prefix dynamic programming, with exact appends and edits, and decoding.

A sequence of tokens is what the merges make of its bytes exactly if that holds
for any two neighbours alone.  So each prefix of a byte string has one valid
last token: the one whose front is a prefix with a valid last token that can
stand before it.  ``Encoder.extend`` stores that token for each prefix; reading
the tokens from the end backwards gives the encoding.  A longer string keeps
the table of the shorter one (append), a changed one that of the unchanged
front (edit).

Whether two tokens can stand side by side is settled by their spines: the parts
along the common edge, from bytes up to the whole tokens.  Merges happen in the
order of ranks, so the pair is valid unless two parts that stand at the edge at
one time may merge before either goes into its next larger part.

The text is first cut by the tokenizer's pattern; a match that is a token as a
whole is that token.  Matches never reach over a chunk (``memo.CHUNKS``), so a
worker encodes a chunk once and remembers its ids; the memory is bounded.

Edge cases: a null text gives no ids and decodes to nothing, like an empty one;
texts and runs without spaces of any length are encoded as a whole; equal rows
give equal rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base
from tidemark.llm.memo import CHUNKS, Memo, Ragged

_CACHE_CHUNKS, _CACHE_PAIRS, _TEXTS = 500_000, 1_000_000, 1000
#: Chunks of more characters are encoded each time they occur.
_LONG = 200
#: Words of up to so many bytes are encoded many at once.
_SHORT = 24
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def ranks_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class _ByHash:
    """Token ids by a hash of their bytes; most of what is asked for is no token and ends at the first look."""

    def __init__(self, tokens: dict[int, int]):
        self.slots, self.ids, self.used = np.zeros(1 << 20, np.uint64), np.zeros(1 << 20, np.int32), np.zeros(1 << 20, bool)
        for h, token in tokens.items():
            at = h >> 44
            while self.used[at]:
                at = at + 1 & len(self.ids) - 1
            self.slots[at], self.ids[at], self.used[at] = h, token, True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where there are tokens, and which."""
        rest = np.flatnonzero(self.used[hashes >> np.uint64(44)])
        wanted = hashes[rest]
        at = (wanted >> np.uint64(44)).astype(np.int64)
        found = []
        while len(rest):
            hit = self.slots[at] == wanted
            found.append((rest[hit], self.ids[at[hit]]))
            at = at + 1 & len(self.ids) - 1
            go = ~hit & self.used[at]
            rest, wanted, at = rest[go], wanted[go], at[go]
        if not found:
            return rest, np.zeros(0, np.int32)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


class Encoder:
    def __init__(self, path: str, pattern: str | None = None):
        import ahocorasick
        import public_tokenizers
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.matches = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self.sizes = [len(t) for t in self.tokens]
        self.longest = max(self.sizes)
        # Parts along the left and right edge of each token, from its byte to itself.
        self.left: list[tuple[int, ...]] = [()] * len(self.tokens)
        self.right: list[tuple[int, ...]] = [()] * len(self.tokens)
        self.found, hashed = ahocorasick.Automaton(), {}
        for token in sorted(self.ranks, key=self.ranks.get):
            rank = self.ranks[token]
            parts = self.merged(token, rank)
            if len(parts) > 2:
                continue  # the merges never arrive at it; only a whole match can be it
            self.left[rank] = (*self.left[parts[0]], rank) if len(parts) == 2 else (rank,)
            self.right[rank] = (*self.right[parts[1]], rank) if len(parts) == 2 else (rank,)
            self.found.add_word(token.decode("latin-1"), rank)
            h = 0
            for byte in token:
                h = (h * int(_PRIME) + byte + 1) & (1 << 64) - 1
            if h in hashed:
                raise ValueError("two tokens of one hash")
            hashed[h] = rank
        self.found.make_automaton()
        self.by_hash, self.size_of = _ByHash(hashed), np.array(self.sizes)
        self.powers = np.array([pow(int(_PRIME), n, 1 << 64) for n in range(self.longest + 1)], np.uint64)
        self.pairs: dict[int, bool] = {}
        # The first entry is no pair; it keeps the arrays from being empty.
        self.known_pairs, self.pair_valid = np.array([-1]), np.array([False])
        self.memo = Memo(self._chunks, 1, _CACHE_CHUNKS)

    def merged(self, token: bytes, below: int) -> list[int]:
        """The merges of lower rank than ``below``, one after another."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def side_by_side(self, a: int, b: int) -> bool:
        left, right = self.right[a], self.left[b]
        i = j = 0
        tokens, ranks = self.tokens, self.ranks
        while True:
            grow_a = left[i + 1] if i + 1 < len(left) else 1 << 60
            grow_b = right[j + 1] if j + 1 < len(right) else 1 << 60
            both = ranks.get(tokens[left[i]] + tokens[right[j]])
            # Of equal merges the leftmost comes first.
            if both is not None and both < grow_a and both <= grow_b:
                return False
            if grow_a == grow_b == 1 << 60:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def extend(self, table: list[int], word: bytes) -> list[int]:
        """``table`` of a prefix of ``word`` (its valid last token at each place but 0), continued to all of ``word``."""
        known = max(0, len(table) - 1)
        table = [*(table or [-1]), *[-1] * (len(word) - known)]
        sizes, pairs = self.sizes, self.pairs
        # Earlier bytes than the longest token reaches back to cannot matter.
        begin = max(0, known - self.longest)
        for end, token in self.found.iter(word[begin:].decode("latin-1")):
            end += begin + 1
            if end <= known or table[end] >= 0:
                continue
            front = end - sizes[token]
            if front == 0:
                table[end] = token
            elif front > 0 and (before := table[front]) >= 0:
                good = pairs.get(before << 32 | token)
                if good is None:
                    if len(pairs) > _CACHE_PAIRS:
                        pairs.clear()
                    good = pairs[before << 32 | token] = self.side_by_side(before, token)
                if good:
                    table[end] = token
        return table

    def read(self, table: list[int], end: int | None = None) -> list[int]:
        """Tokens of the prefix that ends at ``end``."""
        out, at = [], len(table) - 1 if end is None else end
        while at > 0:
            out.append(table[at])
            at -= self.sizes[table[at]]
        return out[::-1]

    def word(self, match: bytes) -> list[int]:
        whole = self.ranks.get(match)
        return [whole] if whole is not None else self.read(self.extend([], match))

    def tables(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words of up to ``_SHORT`` bytes, ``extend`` for all of them at once: place by place, longest tokens first."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        lengths = sizes[order]
        most = int(lengths[0]) if len(lengths) else 0
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = (np.cumsum(sizes) - sizes)[order]
        alive = [int(np.searchsorted(-lengths, -i, "right")) for i in range(most + 1)]  # words of at least i bytes
        hashes = np.zeros((most + 1, len(words)), np.uint64)
        last = np.full((most + 1, len(words)), -1, np.int32)
        for i in range(1, most + 1):
            n = alive[i]
            hashes[i, :n] = hashes[i - 1, :n] * _PRIME + flat[starts[:n] + i - 1] + np.uint64(1)
            left = np.arange(n)
            for size in range(min(i, self.longest), 0, -1):
                every = len(left) == n
                now, front = (hashes[i, :n], hashes[i - size, :n]) if every else (hashes[i, left], hashes[i - size, left])
                at, token = self.by_hash.find(now - front * self.powers[size])
                if size < i and len(at):
                    before = last[i - size, left[at]]
                    good = np.flatnonzero(before >= 0)
                    good = good[self._valid(before[good], token[good])]
                    at, token = at[good], token[good]
                if len(at):
                    last[i, left[at]] = token
                    keep = np.ones(len(left), bool)
                    keep[at] = False
                    left = left[keep]
                    if not len(left):
                        break
        token_sizes, place, rows, steps = self.size_of, lengths.copy(), np.arange(len(words)), []
        while len(rows):
            token = last[place[rows], rows]
            steps.append((rows, token))
            place[rows] -= token_sizes[token]
            rows = rows[place[rows] > 0]
        many = np.zeros(len(words), np.int64)
        for rows, _ in steps:
            many[rows] += 1
        counts = np.zeros(len(words), np.int64)
        counts[order] = many
        ends = np.cumsum(counts)[order]
        ids = np.zeros(int(counts.sum()), np.int32)
        for step, (rows, token) in enumerate(steps):
            ids[ends[rows] - 1 - step] = token
        return counts, ids

    def _valid(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = before.astype(np.int64) << 32 | token
        at = np.searchsorted(self.known_pairs, keys)
        missing = self.known_pairs[np.minimum(at, len(self.known_pairs) - 1)] != keys
        if missing.any():
            new = np.unique(keys[missing])
            good = np.fromiter((self.side_by_side(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()), bool, len(new))
            if len(self.known_pairs) > _CACHE_PAIRS:
                self.known_pairs, self.pair_valid = self.known_pairs[:1], self.pair_valid[:1]
            both = np.concatenate([self.known_pairs, new])
            order = np.argsort(both, kind="stable")
            self.known_pairs, self.pair_valid = both[order], np.concatenate([self.pair_valid, good])[order]
            if len(both) == len(new) + 1:  # started anew
                return self._valid(before, token)
            at = np.searchsorted(self.known_pairs, keys)
        return self.pair_valid[at]

    def _chunks(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        cut = []
        for chunk in chunks:
            one = (chunk[1:] if chunk[:1] == " " else chunk).isalpha()
            cut.append([chunk.encode()] if one else [m.encode() for m in self.matches(chunk)])
        words = list(set(chain.from_iterable(cut)))
        whole = [w for w in words if w in self.ranks]
        short = [w for w in words if len(w) <= _SHORT and w not in self.ranks]
        long = [w for w in words if len(w) > _SHORT and w not in self.ranks]
        held = Ragged()
        held.add(np.ones(len(whole), np.int64), np.fromiter((self.ranks[w] for w in whole), np.int32, len(whole)))
        held.add(*self.tables(short))
        ids = [self.word(w) for w in long]
        held.add(np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int32))
        number = dict(zip(chain(whole, short, long), range(len(words))))
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        ids, many = held.take(np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum())))
        ends = np.concatenate([[0], np.cumsum(many)])[np.cumsum(counts)]
        return [(np.diff(ends, prepend=0), ids)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        lists = [CHUNKS.findall(t) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        chunks = list(chain.from_iterable(lists))
        if max(map(len, chunks), default=0) > _LONG:
            long = [len(c) > _LONG for c in chunks]
            own = {c: self._chunks([c])[0][1] for c in {c for c, x in zip(chunks, long) if x}}
        else:
            long, own = [], {}
        numbers = self.memo.numbers([c for c in chunks if c not in own] if own else chunks)
        ids, many = self.memo.take(0, numbers)
        if own:
            kept = iter(np.split(ids, np.cumsum(many)[:-1])) if len(many) else iter(())
            parts = [own[c] if x else next(kept) for c, x in zip(chunks, long)]
            ids, many = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.concatenate([[0], np.cumsum(many)])[np.cumsum(counts)]
        return np.split(ids, ends[:-1]) if len(ends) else []

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Edited:
    """A text that is appended to and edited, with the prefix tables of its matches; only what an edit reaches is encoded again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.chunks, self.tables = encoder, [], []
        self.steps = 0  # prefixes whose last token had to be found
        self.append(text)

    @property
    def text(self) -> str:
        return "".join(self.chunks)

    def ids(self) -> list[int]:
        ranks, out = self.encoder.ranks, []
        for word, table in chain.from_iterable(self.tables):
            whole = ranks.get(word)
            out += [whole] if whole is not None else self.encoder.read(table)
        return out

    def append(self, more: str) -> None:
        self.replace(sum(map(len, self.chunks)), 0, more)

    def replace(self, at: int, removed: int, inserted: str) -> None:
        """``removed`` characters from ``at`` on give way to ``inserted``."""
        starts = np.cumsum([0, *map(len, self.chunks)])
        # Chunks on either side may join or fall apart, those beyond them not.
        lo = max(0, int(np.searchsorted(starts[:-1], at, "right")) - 2)
        hi = min(len(self.chunks), int(np.searchsorted(starts[:-1], at + removed, "right")) + 1)
        text = "".join(self.chunks[lo:hi])
        at -= int(starts[lo]) if len(starts) > 1 else 0
        chunks = CHUNKS.findall(text[:at] + inserted + text[at + removed :])
        old = list(chain.from_iterable(self.tables[lo:hi]))
        known, tables = dict(old), []
        for chunk in chunks:
            row = []
            for word in (m.encode() for m in self.encoder.matches(chunk)):
                if word not in known:
                    front = self._front(word, old)
                    self.steps += len(word) - max(0, len(front) - 1)
                    known[word] = self.encoder.extend(front, word)
                row.append((word, known[word]))
            tables.append(row)
        self.chunks[lo:hi], self.tables[lo:hi] = chunks, tables

    @staticmethod
    def _front(word: bytes, old: list) -> list[int]:
        """The table of the longest front in common with a former match."""
        best: list[int] = []
        for other, table in old:
            n = next((i for i, (x, y) in enumerate(zip(word, other)) if x != y), min(len(word), len(other)))
            if n >= len(best):
                best = table[: n + 1]
        return best if len(best) > 1 else []


def _encoder(path: str) -> Encoder:
    return base.per_worker(("byte pairs", path), lambda: Encoder(path))


def encoded(docs: DataFrame, path: str | None = None, with_text: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every row; ``with_text`` also ``decoded``, the bytes that the ids stand for."""
    path = path or ranks_file()

    def make():
        encoder = _encoder(path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, texts = [], batch.column("text").to_pylist()
            for lo in range(0, len(texts), _TEXTS):
                found += encoder.encode([t or "" for t in texts[lo : lo + _TEXTS]])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            if with_text:
                columns.append(pa.array([encoder.decode(x.tolist()) for x in found], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

        return each

    return base.map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>" + (", decoded binary" if with_text else ""))


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``decoded`` (bytes) from ``ids``; null ids give null."""
    path = path or ranks_file()

    def make():
        encoder = _encoder(path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if ids is None else encoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

        return each

    return base.map_batches(rows.select("doc_id", "ids"), make, "doc_id long, decoded binary")


def query(spark, folder: str) -> DataFrame:
    found = encoded(base.read(spark, folder), with_text=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
