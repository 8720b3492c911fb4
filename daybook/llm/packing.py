"""Packing of tokenised documents into sequences of several context sizes.

Each document (its ids, then `end`) is routed by length: whole windows of the largest tier leave at once, the
remainder goes to the smallest tier that holds it. A remainder that fills its tier is a sequence of its own.
Then the longest tier is packed first: a piece opens a window of its tier, and the gap is filled with the longest
pieces that fit, of the shorter tiers where it is small; if none fits, the shortest piece left is cut. What long windows
do not take is packed into windows of its own tier. So every window but the last of a partition is full.

Packing runs inside the partitions of the input: no row is shuffled, a task holds one pool of remainders
(POOL tokens). Padding is at most one window per partition. Sequence ids carry the partition's number in their upper bits.

Sequences of one tier are dealt to steps of equal token counts over all partitions: the packed rows are staged, and the
partitions' counts of sequences (a row for each partition and tier) are summed up by a window, staged, and joined: Spark
broadcasts them if their files are small. Only a tier's last step can hold less.

Output, one row per piece: id, start (ids of the document before it), length, ids (binary, little-endian unsigned
32-bit), doc_tokens (with `end`), sequence_id, offset, tier, step.

Defined results: null and empty texts are documents of the one id `end`; ids keep their type, null ids are kept;
repeated rows are documents of their own; other columns are not carried; no rows give no rows.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import CACHED_LENGTH, byte_letters, pieces_of
from .stage import staged

TIERS = (128, 256, 512, 1024)
POOL = 1 << 19           # tokens of remainders a task gathers before it packs them
STEP = 1 << 16           # tokens of a step
CACHED = 700_000         # pieces of text in one of the two generations a worker remembers
BLOCK = 1 << 19          # bytes of text encoded at a time
OUT_BYTES = 1 << 24      # ids in one batch of output rows


def merger(spec: dict) -> Callable[[bytes], list[int]] | None:
    """Ids of a piece's bytes, for a vocabulary of all bytes and of one token for each merge, with ids in the merges' order;
    None for others."""
    model, special = spec["model"], {t["content"] for t in spec["added_tokens"]}
    if sys.byteorder != "little" or array("I").itemsize != 4 or model.get("type") != "BPE" or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocab, letters = model["vocab"], byte_letters()
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    plain = [t for t in vocab if t not in special]
    if any(a >= b for a, b in pairwise(made)) or len(plain) != len(letters) + len(made) or not letters.keys() <= vocab.keys():
        return None
    ranks = {bytes(letters[c] for c in t): vocab[t] for t in plain}
    return tiktoken.Encoding("ranks", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Encoder:
    """Ids by the `tokenizers` library, packed as bytes. Pieces of the splitting pattern encode alike alone and in
    a text, so each is encoded once and remembered. Where merges rank like the ids they make, short new pieces are merged
    by rank with `tiktoken`, which gives the same ids without the library's cost for each call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        self.by_piece = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not spec["normalizer"]
                         and not split["add_prefix_space"])
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)").search
        self.merge = merger(spec) if self.by_piece else None
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}      # the generation before: what is met again moves over

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        if self.older:
            met = {p: self.older[p] for p in new if p in self.older}
            self.pieces.update(met)
            new = new.difference(met)
        rest = list(new)
        if self.merge:
            self.pieces.update((p, array("I", self.merge(p.encode())).tobytes()) for p in new if len(p) <= CACHED_LENGTH)
            rest = [p for p in new if len(p) > CACHED_LENGTH]
        self.pieces.update(zip(rest, self._library(rest)))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self._library(texts)
        split = [None if self.special(t) else pieces_of(t) for t in texts]
        known = self.pieces
        new = {p for s in split if s for p in s if p not in known}
        if len(known) + len(new) > CACHED:
            self.older, self.pieces = known, {}
            known = self.pieces
            new = {p for s in split if s for p in s}
        if new:
            self._learn(new)
        out = [self._library([t])[0] if s is None else b"".join(map(known.__getitem__, s)) for t, s in zip(texts, split)]
        for p in new:
            if len(p) > CACHED_LENGTH:
                del known[p]
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Piece(NamedTuple):
    doc: object
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4


class Pool:
    """Remainders by length; a bit for each length that is there."""

    def __init__(self):
        self.by_length: dict[int, list[Piece]] = {}
        self.there = self.tokens = 0

    def add(self, piece: Piece) -> None:
        self.by_length.setdefault(piece.length, []).append(piece)
        self.there |= 1 << piece.length
        self.tokens += piece.length

    def _take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.there ^= 1 << length
        self.tokens -= length
        return piece

    def longest(self, most: int) -> Piece | None:
        """The longest piece of at most that length."""
        there = self.there & ((2 << most) - 1)
        return self._take(there.bit_length() - 1) if there else None

    def shortest(self) -> Piece | None:
        return self._take((self.there & -self.there).bit_length() - 1) if self.there else None


class Packer:
    def __init__(self, tiers: tuple[int, ...] = TIERS, pool: int = POOL):
        self.tiers, self.window, self.limit, self.pool = sorted(tiers), max(tiers), pool, Pool()

    def tier(self, length: int) -> int:
        return next(t for t in self.tiers if length <= t)

    def add(self, doc, ids: bytes) -> Iterator[tuple[int, list[Piece]]]:
        """Takes a document; gives the sequences (tier, pieces) that are complete."""
        total, wide = len(ids) // 4, 4 * self.window
        whole = len(ids) // wide * wide
        for at in range(0, whole, wide):
            yield self.window, [Piece(doc, at // 4, ids[at:at + wide], total)]
        if whole < len(ids):
            rest = Piece(doc, whole // 4, ids[whole:], total)
            if rest.length == self.tier(rest.length):
                yield rest.length, [rest]
            else:
                self.pool.add(rest)
        if self.pool.tokens >= self.limit:
            yield from self.pack(self.limit // 4)

    def pack(self, keep: int = 0) -> Iterator[tuple[int, list[Piece]]]:
        """Fills windows, longest tier first, until at most `keep` tokens wait."""
        while self.pool.tokens > keep:
            opening = self.pool.longest(self.window)
            tier = self.tier(opening.length)
            pieces, room = [opening], tier - opening.length
            while room:
                piece = self.pool.longest(room)
                if piece is None:
                    piece = self.pool.shortest()
                    if piece is None:
                        break
                    self.pool.add(piece._replace(start=piece.start + room, ids=piece.ids[4 * room:]))
                    piece = piece._replace(ids=piece.ids[:4 * room])
                pieces.append(piece)
                room -= piece.length
            yield tier, pieces


def blocks(texts: pa.Array) -> Iterator[range]:
    """Rows in a row, of BLOCK bytes of text together, or one."""
    begin = size = 0
    for row, width in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + (width or 0) > BLOCK:
            yield range(begin, row)
            begin, size = row, 0
        size += width or 0
    if begin < len(texts):
        yield range(begin, len(texts))


def _rows(batches, path: str, end: int, tiers: tuple[int, ...], pool: int, kind: pa.Schema):
    first = TaskContext.get().partitionId() << 32
    code, last, packer = encoder(path), end.to_bytes(4, "little"), Packer(tiers, pool)
    sequence, dealt = first, dict.fromkeys(tiers, 0)
    columns, size = [[] for _ in kind], 0

    def packed():
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for some in blocks(texts):
                for row, ids in zip(some, code.ids([texts[row].as_py() or "" for row in some])):
                    yield from packer.add(docs[row], ids + last)
        yield from packer.pack()

    for tier, pieces in packed():
        offset = 0
        for p in pieces:
            for column, x in zip(columns, (p.doc, p.start, p.length, p.ids, p.doc_tokens, sequence, offset, tier, dealt[tier])):
                column.append(x)
            offset += p.length
            size += len(p.ids)
        dealt[tier] += 1
        sequence += 1
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)
            columns, size = [[] for _ in kind], 0
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)


def pack(docs: DataFrame, path: str, end: int = 0, text: str = "text", key: str = "doc_id", tiers: tuple[int, ...] = TIERS,
         pool: int = POOL, step: int = STEP) -> DataFrame:
    """Pieces of the documents' ids in sequences; see above."""
    if any(t <= 0 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    id_type = narrow.schema["doc_id"].dataType
    kind = pa.schema([("doc_id", to_arrow_type(id_type)), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                      ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
                      ("at", pa.int64())])
    tiers = tuple(sorted(tiers))
    packed = staged(narrow.mapInArrow(lambda batches: _rows(batches, path, end, tiers, pool, kind),
                                      f"doc_id {id_type.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
                                      "offset long, tier int, at long"))  # at: number of the sequence in its partition and tier
    part = F.shiftright("sequence_id", 32)
    before = F.sum("n").over(Window.partitionBy("_p_tier").orderBy("_p_part").rowsBetween(Window.unboundedPreceding, -1))
    first = staged(packed.groupBy(part.alias("_p_part"), F.col("tier").alias("_p_tier")).agg((F.max("at") + 1).alias("n"))
                   .select("_p_part", "_p_tier", F.coalesce(before, F.lit(0)).alias("_p_first")))
    number = F.floor((F.col("_p_first") + F.col("at")) * F.col("tier") / step) * len(tiers) + F.array_position(F.array(*map(F.lit, tiers)), F.col("tier")) - 1
    return packed.join(first, (part == F.col("_p_part")) & (F.col("tier") == F.col("_p_tier"))).withColumn(
        "step", number.cast("long")).drop("at", "_p_part", "_p_tier", "_p_first")
