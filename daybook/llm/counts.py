"""Token counts of whole texts, without keeping the tokens.

An Arrow function hands the texts to the tokenizer library in batches of about equal bytes and returns lengths
only. Texts beyond LONG characters are cut where no token can cross: at one space between two letters. There the
splitting patterns start a new piece, so the parts' counts add up to the whole text's count. A stretch without
such a place stays whole.

`path`: a .json file of `tokenizers` or a .model file of `sentencepiece`; opened by each Python worker. No begin,
end or added special tokens, no truncation, no padding; special strings inside a text as the library's default.

Defined results: null and empty texts count 0; repeated rows count each for themselves; an existing column of
the output's name is replaced.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = 1 << 16         # characters from which a text is cut
BATCH = 1 << 20        # bytes handed to the library at a time
SAFE = regex.compile(r"(?<=\p{L}) (?=\p{L})")


@lru_cache(maxsize=4)
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """Counts of a batch of texts; whether the space at a cut is dropped (a word mark takes its place)."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], True
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)], False


def parts(text: str, drop: bool, long: int = LONG) -> Iterator[str]:
    """The text, cut at safe places after at least `long` characters each."""
    begin = 0
    while len(text) - begin > long and (cut := SAFE.search(text, begin + long)):
        yield text[begin:cut.start()]
        begin = cut.end() if drop else cut.start()
    yield text[begin:]


def count_texts(texts, path: str, long: int = LONG, batch: int = BATCH) -> np.ndarray:
    """Counts of the texts of one Arrow array or list."""
    count, drop = counter(path)
    totals, rows, waiting, size = np.zeros(len(texts), np.int64), [], [], 0
    for row, text in enumerate(texts):
        text = text.as_py() if isinstance(text, pa.Scalar) else text
        for part in parts(text, drop, long) if text else ():
            rows.append(row)
            waiting.append(part)
            size += len(part.encode())
            if size >= batch:
                np.add.at(totals, rows, count(waiting))
                rows, waiting, size = [], [], 0
    if waiting:
        np.add.at(totals, rows, count(waiting))
    return totals


def count_column(text: Column | str, path: str) -> Column:
    """long: the number of tokens of each text."""
    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(count_texts(texts, path), pa.int64())
    return counted(text)


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each text."""
    return docs.withColumn(out, count_column(F.col(text), path))
