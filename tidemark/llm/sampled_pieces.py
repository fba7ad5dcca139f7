"""SentencePiece encoding by sampling over the piece lattice, and lossless decoding.

The lattice of a text has an edge for every vocabulary piece that matches at a
place, and byte pieces for characters outside the vocabulary.  Forward filtering
sums the weights of all segmentations up to each place; backward sampling then
draws a segmentation in proportion to its weight.  The model's pieces carry
merge ranks, not probabilities, so a piece's weight is 1 / (rank + 2) to the
power ``SHARPNESS``; byte pieces weigh as the rarest piece.

Spaces are written as the space mark before pieces; a mark that stands in the
text itself is encoded by bytes, so decoding gives back every text exactly.  No
piece holds a line feed, and the mark only leads, so the lattice falls apart
into units (marks with what follows them) that are filtered once per distinct
unit of a task and sampled once per occurrence, in numpy.

The numbers that drive the draws are a hash of seed, row key, the unit's place
and the step: the same row gives the same pieces in any batch on any executor.

Edge cases: a null text gives null ids, an empty one an empty list; rows of
equal id draw from the same numbers; a null id draws by its text; a unit of any
length is filtered as a whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

SEED, SHARPNESS = 11, 1.0
MARK = "▁"
_LITERAL = "\udc81"  # stands for a mark in the text; lone surrogates never occur in one
_UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
_CACHE_EDGES, _TEXTS = 3_000_000, 256
_PREFIX, _NOTHING, _PRIME = -1, -2, 0x9E3779B97F4A7C15


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: log weights and bytes by id, and a hash table of pieces and their prefixes."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes, self.byte_ids, usual = [b""] * size, [0] * 256, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if "\n" in piece or MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} spans units: {piece!r}")
                usual[piece], self.bytes[i] = i, piece.replace(MARK, " ").encode()
        self.weights = np.zeros(size)
        self.weights[list(usual.values())] = -sharpness * np.log(np.arange(len(usual)) + 2.0)
        self.byte_weight = -sharpness * np.log(len(usual) + 2.0)
        self.weights[self.byte_ids] = self.byte_weight
        self.longest = max(map(len, usual))
        held = dict.fromkeys((p[:n] for p in usual for n in range(1, len(p))), _PREFIX) | usual
        with np.errstate(over="ignore"):
            hashes = [self.hashed(np.frombuffer(p.encode("utf-32-le"), np.uint32)) for p in held]
        self.slots = np.zeros(1 << 20, np.uint64)
        self.found = np.full(1 << 20, _NOTHING, np.int32)
        self.probes = 0
        for h, value in zip(hashes, held.values()):
            at = n = 0
            for n in range(len(self.slots)):
                at = ((h >> 44) + n) & (len(self.slots) - 1)
                if self.found[at] == _NOTHING:
                    break
                if int(self.slots[at]) == h:
                    raise ValueError("two pieces of one hash")
            self.slots[at], self.found[at], self.probes = h, value, max(self.probes, n + 1)

    @staticmethod
    def hashed(codes) -> int:
        h = 0
        for c in codes.tolist():
            h = ((h + c) * _PRIME) & (1 << 64) - 1
        return h

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Ids, or ``_PREFIX`` or ``_NOTHING``."""
        first = (hashes >> np.uint64(44)).astype(np.int64)
        out = np.full(len(hashes), _NOTHING, np.int32)
        for n in range(self.probes):
            at = (first + n) & (len(self.slots) - 1)
            hit = (self.slots[at] == hashes) & (self.found[at] != _NOTHING)
            out[hit] = self.found[at[hit]]
        return out

    def lattice(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edges of all units' lattices, by the place where they end, and each unit's size.

        A place is the index of a character in all units together and stands
        for its end.  Of each edge: that place, the place it comes from (-1: the
        unit's start), the id, and its share of the weight of all segmentations
        up to its end.  An id below 0 is the character of that negative code, by its bytes.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        rel = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.repeat(sizes, sizes) - rel
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        starts, lengths, ids, ascii_ids = [], [], [], np.array(self.byte_ids[:128], np.int32)
        for n in range(1, self.longest + 1):
            fits = left[at] >= n
            at, h = at[fits], (h[fits] + codes[at[fits] + n - 1]) * np.uint64(_PRIME)
            got = self.lookup(h)
            piece = got >= 0
            starts.append(at[piece])
            lengths.append(np.full(int(piece.sum()), n))
            ids.append(got[piece])
            if n == 1:
                alone = at[~piece]
                starts.append(alone)
                lengths.append(np.ones(len(alone), np.int64))
                code = codes[alone].astype(np.int32)
                ids.append(np.where(code < 128, ascii_ids[np.minimum(code, 127)], -code))
            on = got != _NOTHING
            at, h = at[on], h[on]
        start, length, id_ = np.concatenate(starts), np.concatenate(lengths), np.concatenate(ids)
        end = start + length - 1
        order = np.lexsort((length, end, rel[end]))
        start, end, id_ = start[order], end[order], id_[order]
        from_ = np.where(rel[start] > 0, start - 1, -1)
        size = np.where(id_ == -ord(_LITERAL), 3, 1 + (id_ < -0x7F) + (id_ < -0x7FF) + (id_ < -0xFFFF))
        weight = np.where(id_ >= 0, self.weights[np.maximum(id_, 0)], size * self.byte_weight)
        total, share = np.zeros(len(codes) + 1), np.zeros(len(end))  # log sums; the last stands for -1
        cuts = np.searchsorted(rel[end], np.arange(int(sizes.max()) + 1))
        for a, b in zip(cuts, cuts[1:]):
            value = weight[a:b] + total[from_[a:b]]
            edge = np.flatnonzero(np.concatenate([[True], end[a + 1 : b] != end[a : b - 1]]))
            many = np.diff(np.append(edge, b - a))
            top = np.maximum.reduceat(value, edge)
            value = np.exp(value - np.repeat(top, many))
            sums = np.add.reduceat(value, edge)
            total[end[a:b][edge]] = top + np.log(sums)
            share[a:b] = value / np.repeat(sums, many)
        order = np.argsort(end, kind="stable")
        return end[order], from_[order], id_[order], share[order], sizes


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """Filtered units of a worker, and draws from them."""

    def __init__(self, pieces: Pieces, seed: int):
        self.pieces, self.seed = pieces, seed
        self.clear()

    def clear(self) -> None:
        self.ends: dict[str, int] = {}  # unit to its last place
        self.first = np.zeros(0, np.int32)  # of a place's edges
        # Of an edge: shares up to it, the place it comes from (-1: the start), its id.
        self.upto, self.back, self.piece = np.zeros(0, np.float32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def learn(self, units: list[str]) -> None:
        with np.errstate(over="ignore"):
            end, back, piece, share, sizes = self.pieces.lattice(units)
        edge = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
        run = np.cumsum(share)
        run -= np.repeat(np.concatenate([[0.0], run[edge[1:] - 1]]), np.diff(np.append(edge, len(end))))
        run[np.append(edge[1:], len(end)) - 1] = 1.0  # above every draw
        places = len(self.first)
        self.ends.update(zip(units, (places + np.cumsum(sizes) - 1).tolist()))
        self.first = np.concatenate([self.first, (edge + len(self.upto)).astype(np.int32)])
        self.upto = np.concatenate([self.upto, run.astype(np.float32)])
        self.back = np.concatenate([self.back, np.where(back >= 0, back + places, -1).astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece])

    def encode(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Ids of each text; ``keys`` are unsigned 64-bit row keys."""
        if not texts:
            return []
        if len(self.upto) > _CACHE_EDGES:
            self.clear()
        lists = [_UNITS.findall(MARK + t.replace(MARK, _LITERAL).replace(" ", MARK)) if t else [] for t in texts]
        new = list({u for units in lists for u in units if u not in self.ends})
        if new:
            self.learn(new)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        now = np.fromiter(map(self.ends.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum()))
        row = np.repeat(np.arange(len(lists)), counts)
        with np.errstate(over="ignore"):
            number = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
            state = _mixed(_mixed(keys.astype(np.uint64) ^ np.uint64(self.seed))[row] + number)
            steps, who, live = [], [], np.arange(len(row))
            while len(live):
                state = _mixed(state)
                draw = (state >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
                edge = self.first[now]
                wait = np.flatnonzero(self.upto[edge] <= draw)
                while len(wait):
                    edge[wait] += 1
                    wait = wait[self.upto[edge[wait]] <= draw[wait]]
                steps.append(self.piece[edge])
                who.append(live)
                now = self.back[edge]
                more = np.flatnonzero(now >= 0)
                live, now, state = live[more], now[more], state[more]
        lengths = np.zeros(len(row), np.int64)
        for w in who:
            lengths[w] += 1
        until = np.cumsum(lengths)
        out = np.zeros(int(until[-1]) if len(until) else 0, np.int32)
        for step, (found, w) in enumerate(zip(steps, who)):
            out[until[w] - 1 - step] = found
        per_row = np.bincount(row, lengths, len(lists)).astype(np.int64)
        return [self._bytes(x) for x in np.split(out, np.cumsum(per_row)[:-1])]

    def _bytes(self, ids: np.ndarray) -> np.ndarray:
        """Characters outside the vocabulary as byte pieces."""
        if not len(ids) or ids.min() >= 0:
            return ids
        parts: list[int] = []
        for i in ids.tolist():
            if i >= 0:
                parts.append(i)
            else:
                char = MARK if chr(-i) == _LITERAL else chr(-i)
                parts += [self.pieces.byte_ids[b] for b in char.encode()]
        return np.array(parts, np.int32)


def decode(pieces: Pieces, ids: list[int]) -> str:
    """The text of a row's ids."""
    return b"".join(map(pieces.bytes.__getitem__, ids))[1:].decode()


def encoded(docs: DataFrame, seed: int = SEED, sharpness: float = SHARPNESS, path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``lossless`` (the decoded ids are the text) of every row."""
    path = path or model_file()

    def make():
        sampler = base.per_worker(("pieces", path, sharpness, seed), lambda: Sampler(Pieces(path, sharpness), seed))
        pieces = sampler.pieces

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, named = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            keys = np.array(
                [xxhash.xxh64_intdigest((t or "").encode() if k is None else str(k).encode(), 1) for k, t in zip(named, texts)], np.uint64
            )
            found: list[np.ndarray | None] = []
            same: list[bool | None] = []
            for lo in range(0, len(texts), _TEXTS):
                some = texts[lo : lo + _TEXTS]
                for text, ids in zip(some, sampler.encode([t or "" for t in some], keys[lo : lo + _TEXTS])):
                    found.append(None if text is None else ids)
                    same.append(None if text is None else decode(pieces, ids.tolist()) == text)
            offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in found])]).astype(np.int32)
            values = [x for x in found if x is not None]
            missing = pa.array([x is None for x in found])
            ids = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32)), mask=missing
            )
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(same, pa.bool_())], ["doc_id", "ids", "lossless"])

        return each

    return base.map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>, lossless boolean")


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id`` and ``text`` from ``ids``."""
    path = path or model_file()

    def make():
        pieces = Pieces(path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if ids is None else decode(pieces, ids) for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

        return each

    return base.map_batches(rows.select("doc_id", "ids"), make, "doc_id long, text string")


def query(spark, folder: str) -> DataFrame:
    return encoded(base.read(spark, folder)).select("doc_id", F.size("ids").alias("n_pieces"), "ids", "lossless")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Sampled piece ids of every document; the last stage."""
    return encoded(docs).select("doc_id", "ids", "lossless")
