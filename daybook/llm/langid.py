"""Languages of a document as a mixture.

Learning: hashed n-grams of words are counted per language over a bounded sample of labelled rows, at most SAMPLE
documents expected for each language, chosen by the hash of their text; equal texts count once. The model is a table of BUCKETS rows and one
column per language, however many there are; its size does not depend on the rows.

Prediction: a word's likelihood under each language follows from its n-grams. Expectation-maximisation over the
words estimates the document's language shares. The languages are then taken in order of their shares into a set
that grows while the likelihood of the mixture, less a penalty for each further language, gets better. The
prediction is the language with the largest share in the chosen set; its share is the score.

Defined results: null text, or text without a letter: `und`, score 0, no shares; a table without labelled rows
teaches no language and everything is `und`; ties go to the language that sorts first; repeated rows are judged
alike; existing columns of the outputs' names are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 4000        # labelled documents of a language to learn from
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
SMOOTH = 0.2
ROUNDS = 12          # of expectation-maximisation
PENALTY = 6.0        # log likelihood that a further language must win, times the log of the number of words
KNOWN = 1 << 22      # words times languages a worker remembers
BLOCK = 1 << 22      # words times languages handled at a time
WORD = re.compile(r"[^\W\d_]+")


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, bucket) of every n-gram of the words; a space stands for each end of a word."""
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    spaces = np.cumsum(points == 32)
    of, buckets = [], []
    for n in ORDERS:
        h = np.zeros(max(0, len(points) - n + 1), np.uint64)
        for i in range(n):
            h = (h ^ points[i:i + len(h)]) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
            h ^= h >> np.uint64(29)
        # no end of a word inside: a space is at most the first and the last character
        inside = spaces[n - 2:n - 2 + len(h)] == spaces[:len(h)]
        of.append(spaces[:len(h)][inside] - 1)
        buckets.append((h[inside] >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(of), np.concatenate(buckets).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray                                    # BUCKETS x languages
    rows: dict[str, int] = field(default_factory=dict)   # word -> row of `known`; 0: no letter
    known: np.ndarray | None = None

    def __getstate__(self):
        return {"languages": self.languages, "log_p": self.log_p, "rows": {}, "known": None}

    def words(self, text: str) -> list[int]:
        """Rows of the text's words in `known`."""
        words = WORD.findall(text.lower())
        if new := {w for w in words if w not in self.rows}:
            if self.known is None or len(self.rows) + len(new) >= len(self.known):
                self.rows, new = {}, set(words)
                self.known = np.zeros((max(KNOWN // len(self.languages), 2 * len(new) + 1), len(self.languages)), np.float32)
            spelt = sorted(w for w in new if any(c.isalpha() for c in w))
            if spelt:
                of, buckets = grams(spelt)
                first = len(self.rows) + 1
                for k in range(len(self.languages)):
                    total = np.bincount(of, self.log_p[buckets, k], len(spelt))
                    self.known[first:first + len(spelt), k] = total / len(ORDERS)
                self.rows.update(zip(spelt, range(first, first + len(spelt))))
            self.rows.update(dict.fromkeys(new.difference(spelt), 0))
        return [r for r in map(self.rows.__getitem__, words) if r]


def mixtures(log_p: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language shares and log likelihoods of documents. log_p: words x languages; starts: each document's first word.
    A language with log likelihood -inf throughout takes no part."""
    top = log_p.max(axis=1, keepdims=True)
    p = np.exp(log_p - top)
    lengths = np.diff(np.append(starts, len(log_p)))
    allowed = np.isfinite(log_p[starts])
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        mixed = p * np.repeat(shares.astype(p.dtype), lengths, axis=0)
        mixed /= mixed.sum(axis=1, keepdims=True)
        new = np.add.reduceat(mixed, starts, axis=0) / lengths[:, None]
        done = np.abs(new - shares).max() < 1e-3
        shares = new
        if done:
            break
    mixed = (p * np.repeat(shares.astype(p.dtype), lengths, axis=0)).sum(axis=1)
    return shares, np.add.reduceat(np.log(np.maximum(mixed, 1e-30)) + top[:, 0], starts)


def chosen(log_p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shares of the chosen language sets, 0 outside of them.

    No mixture is likelier than every word in its own best language. Documents for which even that bound does not
    win the penalty over their best language alone need no estimation."""
    lengths = np.diff(np.append(starts, len(log_p)))
    singles = np.add.reduceat(log_p, starts, axis=0)
    best, now = singles.argmax(axis=1), singles.max(axis=1).astype(np.float64)
    penalty = PENALTY * np.log(lengths + 1)
    shares = np.zeros(singles.shape)
    shares[np.arange(len(best)), best] = 1.0

    def of(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.arange(starts[d], starts[d] + lengths[d]) for d in docs]), np.concatenate([[0], np.cumsum(lengths[docs])[:-1]])
    open_ = np.flatnonzero(np.add.reduceat(log_p.max(axis=1), starts) - now > penalty)
    if len(open_):
        words, own = of(open_)
        full = mixtures(log_p[words], own)[0]
        full[np.arange(len(open_)), best[open_]] = 2.0  # the best language alone comes first in the set
        rank = np.zeros(shares.shape, np.int64)
        rank[open_] = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    for size in range(2, log_p.shape[1] + 1):
        if not len(open_):
            break
        words, own = of(open_)
        inside = np.repeat(rank[open_] < size, lengths[open_], axis=0)
        got, value = mixtures(np.where(inside, log_p[words], -np.inf), own)
        better = value - now[open_] > penalty[open_]
        shares[open_[better]], now[open_[better]] = got[better], value[better]
        open_ = open_[better]
    return shares


def predictions(model: Model, texts) -> list[np.ndarray | None]:
    """Shares for each text; None without a letter."""
    out: list[np.ndarray | None] = [None] * len(texts)
    wide, rows, of, blocks, size = max(1, len(model.languages)), [], [], [], 0

    def flush():
        if of:
            starts = np.cumsum([0] + [len(b) for b in blocks[:-1]])
            for row, shares in zip(of, chosen(np.concatenate(blocks), starts)):
                out[row] = shares
    for row, text in enumerate(texts):
        text = text.as_py() if isinstance(text, pa.Scalar) else text
        rows = model.words(text) if text and model.languages else []
        if rows:
            of.append(row)
            blocks.append(model.known[rows])
            size += len(rows) * wide
            if size >= BLOCK:
                flush()
                of, blocks, size = [], [], 0
    flush()
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the rows of docs that have a text and a language."""
    docs = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    per = docs.groupBy("lang").count().collect()  # a row for each language
    if not per:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    fraction = F.create_map(*[x for r in per for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["count"])))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = docs.where(draw < fraction[F.col("lang")]).dropDuplicates(["lang", "text"])  # copies are drawn together

    def counted(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for t, k in zip(batch.column(0), batch.column(1)):
                words.setdefault(k.as_py(), Counter()).update(WORD.findall(t.as_py().lower()))
        for k, seen in words.items():
            of, buckets = grams(list(seen))
            n = np.bincount(buckets, np.array(list(seen.values()))[of], BUCKETS).astype(np.int64)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "bucket", "n"])
    # at most BUCKETS rows of each language reach the driver
    table = drawn.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(r["lang"] for r in per)
    of = table["lang"].combine_chunks().dictionary_encode() if table.num_rows else pa.array([], pa.string()).dictionary_encode()
    at, buckets, n = of.indices.to_numpy(), table["bucket"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(at, kind="stable")
    starts = np.searchsorted(at[order], np.arange(len(of.dictionary) + 1))
    place = {k: i for i, k in enumerate(of.dictionary.to_pylist())}
    log_p = np.empty((BUCKETS, len(languages)), np.float32)
    for i, k in enumerate(languages):  # one column in double precision at a time
        column = np.zeros(BUCKETS)
        if k in place:
            rows = order[starts[place[k]]:starts[place[k] + 1]]
            column[buckets[rows]] = n[rows]
        log_p[:, i] = np.log((column + SMOOTH) / (column.sum() + SMOOTH * BUCKETS))
    return Model(languages, log_p)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, score, and the shares of the chosen languages."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats a language
    share = pa.struct([("lang", pa.string()), ("share", pa.float64())])
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("shares", pa.list_(share))])

    @F.arrow_udf("struct<lang_pred:string,score:double,shares:array<struct<lang:string,share:double>>>")
    def identified(texts: pa.Array) -> pa.Array:
        names, rows = held.value.languages, []
        for shares in predictions(held.value, texts):
            if shares is None:
                rows.append({"lang_pred": "und", "score": 0.0, "shares": []})
            else:
                top = int(shares.argmax())
                rows.append({"lang_pred": names[top], "score": float(min(1.0, max(0.0, shares[top]))),
                             "shares": [{"lang": names[i], "share": float(shares[i])} for i in np.flatnonzero(shares)]})
        return pa.array(rows, kind)
    found = docs.withColumn("_i_found", identified(F.col(text)))
    return found.withColumns({k: F.col(f"_i_found.{k}") for k in ("lang_pred", "score", "shares")}).drop("_i_found")
