"""Byte-pair encoding and decoding by dynamic programming over prefixes.

Every prefix of a piece has one encoding, hence one last token. The tokens that end a prefix are the suffix
matches of an automaton over the vocabulary; of those, the one that fits behind the last token of the shorter
prefix is stored. Following the stored tokens back from the end gives the exact ids, in time linear in the piece.

Vocabulary file: byte-level BPE in the JSON form of the `tokenizers` library, without normaliser. The file is
opened by each Python worker, so its path must hold on every executor.

Defined results: null text encodes as empty; empty text has no ids; special tokens written in a text become
their id, as in the library's default; repeated rows are encoded each for itself; an existing column of the
output's name is replaced. Decoding null ids gives null, no ids the empty text, and bytes that are not UTF-8
the replacement character; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published splitting pattern of this vocabulary family.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

def _latin_pieces() -> Callable[[str], list[str]]:
    """The same splitting for texts of the first 256 characters, which the plain expression engine does faster."""
    def members(c: str) -> str:
        return "".join(re.escape(chr(i)) for i in range(256) if regex.match(c, chr(i)))
    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                      f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall


LATIN, ANY = _latin_pieces(), regex.compile(PIECES).findall


def pieces_of(text: str) -> list[str]:
    """The pieces that are encoded by themselves; together they are the text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return ANY(text)
    return LATIN(text)


NEVER = 1 << 40      # a merge that does not happen
CACHED = 400_000     # pieces a worker remembers
CACHED_LENGTH = 64   # longer pieces are encoded anew
PAIRS = 1_000_000    # pair tests a worker remembers


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable bytes for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """One vocabulary, with what a worker has learned about pieces and pairs of tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout") or spec["normalizer"]
                or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True)):
            raise ValueError(f"{path} is not plain byte-level BPE")
        letters = byte_letters()
        ids = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.token_bytes = {i: t for t, i in ids.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes.update({i: t.encode() for t, i in self.specials.items()})
        self.made_at: dict[int, int] = {}              # token -> rank of the merge that makes it; single bytes -1
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}   # pair -> rank
        for rank, m in enumerate(model["merges"]):
            a, b = (bytes(letters[c] for c in t) for t in (m.split(" ") if isinstance(m, str) else m))
            pair, whole = (ids[a], ids[b]), ids[a + b]
            if whole in self.made_at or max(self.made_at.get(pair[0], -1), self.made_at.get(pair[1], -1)) >= rank:
                raise ValueError(f"{path}: merge {rank} is out of order")
            self.merges[pair], self.made_at[whole], self.parts[whole] = rank, rank, pair
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            if len(t) == 1:
                self.made_at[i] = -1
            if i in self.made_at and t.decode("latin-1") not in self.specials:
                self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.pieces: dict[str, bytes] = {}               # piece -> its ids, packed
        self.pairs: dict[tuple[int, int], bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may follow token a: no merge across their border comes before both are complete.

        The border's neighbours are followed back through time, each with the rank at which it was merged away.
        At equal ranks the left merge comes first.
        """
        gone_a = gone_b = NEVER
        while True:
            rank = self.merges.get((a, b), NEVER)
            if rank < gone_a and rank <= gone_b and rank != NEVER:
                return False
            made_a, made_b = self.made_at[a], self.made_at[b]
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:
                gone_a, a = made_a, self.parts[a][1]
            else:
                gone_b, b = made_b, self.parts[b][0]

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of the splitting pattern."""
        raw = piece.encode()
        last, begin = [-1] * (len(raw) + 1), [0] * (len(raw) + 1)
        pairs = self.pairs
        for at, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            end = at + 1
            if last[end] < 0:
                start = end - length
                if start:
                    pair = (last[start], token)
                    ok = pairs.get(pair)
                    if ok is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        ok = pairs[pair] = self.fits(*pair)
                    if not ok:
                        continue
                last[end], begin[end] = token, start
        out, end = [], len(raw)
        while end:
            out.append(last[end])
            end = begin[end]
        return tuple(reversed(out))

    def _plain(self, text: str) -> bytes:
        pieces, known = pieces_of(text), self.pieces
        new = {p for p in pieces if p not in known}
        if len(known) + len(new) > CACHED:
            known.clear()
            new = set(pieces)
        for p in new:
            known[p] = struct.pack(f"<{len(ids := self.piece_ids(p))}i", *ids)
        out = b"".join(map(known.__getitem__, pieces))
        for p in new:
            if len(p) > CACHED_LENGTH:
                del known[p]
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._plain(text), "<i4")
        return np.frombuffer(b"".join(struct.pack("<i", self.specials[part]) if part in self.specials else self._plain(part)
                                      for part in self.special.split(text)), "<i4")

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Bpe:
    return Bpe(os.path.abspath(path))


def _lists(blocks: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, blocks)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, "<i4"), *blocks]), pa.int32()))


def encode_column(text: Column | str, path: str) -> Column:
    """array<int>: the ids of each text."""
    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _lists([vocabulary(path).encode(t.as_py() or "") for t in texts])
    return encoded(text)


def decode_column(ids: Column | str, path: str) -> Column:
    """string: the text of each list of ids."""
    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        return pa.array([None if x.as_py() is None else bpe.decode(x.values.to_numpy(zero_copy_only=False).tolist())
                         for x in lists], pa.string())
    return decoded(ids)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids of each text."""
    return docs.withColumn(out, encode_column(F.col(text), path))


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the text of each list of ids."""
    return docs.withColumn(out, decode_column(F.col(ids), path))


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """docs with the ids of each text and the text that these ids give. decode(encode(docs)) is the same, but Spark
    would run the encoder once for each of the two columns."""
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        blocks = [bpe.encode(t.as_py() or "") for t in texts]
        return pa.StructArray.from_arrays([_lists(blocks), pa.array([bpe.decode(b.tolist()) for b in blocks], pa.string())], fields=list(kind))
    held = docs.withColumn("_b_both", both(F.col(text)))
    return held.withColumns({ids: F.col("_b_both.ids"), decoded: F.col("_b_both.decoded")}).drop("_b_both")
