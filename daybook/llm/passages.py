"""Repeated passages: words covered by a window of words that also starts earlier are removed.

A count-min row comes first. A window's cell is the least hash of the GRAM-word runs inside it (its anchor), so some six
neighbouring windows share one counter and equal windows always do: a counter is never smaller than a window's number of
occurrences. Each task counts the anchors of its own documents; the tasks' sketches are merged by a shuffle of the
cells, one row for each cell and task (two where the task saw more), so a hot cell costs a task no more than there are tasks. No sketch of fixed size is
broadcast: the cells that occur are held as rows, of 2^44 possible ones, and grow with the input.

The second pass takes only windows whose cell was counted twice or more, hashes them whole (128 bits), and groups them exactly:
the first document of each window is found with partial aggregation, so frequent passages shrink before they move. A document keeps
the windows it owns where they start first; every other estimated window that is owned by an earlier start is repeated. No
repeated window is lost, and windows that merely share a counter own themselves.

Texts move once, to the task where their row's verdicts arrive.

Defined results: null texts have no words; texts shorter than a window lose nothing; of equal ids, and of null ids, which come
last, the first row in the input's order is the earlier one; repeated rows are documents of their own, so the second loses its
windows; other columns are kept, `n_words`, `n_removed` and `kept` are replaced and columns that begin with `_p_` are dropped; no
rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stage import repeatable, staged

WINDOW, GRAM = 20, 8
PIECE = 1 << 20             # windows (and bytes of text) handled at a time
LOW = np.uint64(20)         # bits that hold a run's place among those of one piece
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LETTERS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0xD6E8FEB86659FD93   # odd, so that it has an inverse modulo 2^64


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.ones(n, np.uint64)
        done = 1
        while done < n:  # the second half is the first half times one power
            more = min(done, n - done)
            p[done:done + more] = p[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        out.append(p)
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * A
    return h ^ (h >> np.uint64(32))


def joined(a: np.ndarray, b: np.ndarray, by: np.uint64 = A) -> np.ndarray:
    return mixed(a * by + b)


def chunks(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    at = 0
    while len(raw) - at > PIECE:
        end = at + PIECE
        while end < len(raw) and not BLANK[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def words(raw: bytes) -> np.ndarray:
    """A hash of each word: a polynomial over its bytes, from sums over the whole text."""
    out = []
    for piece in chunks(raw):
        data = np.frombuffer(piece, np.uint8)
        inside = np.concatenate(([False], ~BLANK[data], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edges[::2], edges[1::2]
        size = max(1 << 12, 1 << int(len(data)).bit_length())
        up, down = powers(size)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(LETTERS[data] * up[:len(data)], out=sums[1:])
        out.append(mixed((sums[ends] - sums[begins]) * down[begins]))
    return out[0] if len(out) == 1 else np.concatenate(out)


def doubled(h: np.ndarray, by: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of GRAM and of WINDOW words, by doubling: 2, 4, 8, 16, and 16 + 4."""
    h2 = joined(h[:-1], h[1:], by)
    h4 = joined(h2[:-2], h2[2:], by)
    h8 = joined(h4[:-4], h4[4:], by)
    h16 = joined(h8[:-8], h8[8:], by)
    return h8, joined(h16[:len(h) - WINDOW + 1], h4[16:], by)


def windows(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """In pieces: of each window the anchor (cell in the upper bits, place in the lower ones) and two hashes; last the number
    of words before the piece."""
    every = words(raw)
    for at in range(0, len(every) - WINDOW + 1, PIECE // 2):
        h = every[at:at + PIECE // 2 + WINDOW - 1]
        h8, first = doubled(h, A)
        _, second = doubled(h, B)
        y = (mixed(h8 ^ B) >> LOW << LOW) | np.arange(len(h8), dtype=np.uint64)
        span = WINDOW - GRAM + 1  # 13 runs in a window: least of 2, 4, 8, then 8 and 8
        m = np.minimum(y[:-1], y[1:])
        m = np.minimum(m[:-2], m[2:])
        m = np.minimum(m[:-4], m[4:])
        yield np.minimum(m[:len(y) - span + 1], m[span - 8:]), first, second, at


def anchors(raw: bytes) -> np.ndarray:
    """The cell of every anchor, once for each place where it stands."""
    found = [np.unique(least) >> LOW for least, *_ in windows(raw)]
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)).astype(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """docs (_p_row, _p_text) with the cells of their anchors: `twice`, those that this task's sketch already counts twice or
    more, and `once`, those to be merged with other tasks (one of each cell)."""
    def counted(batches):
        rows, cells = [], []
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = (text.as_py() or "").encode()
                if len(raw) >= 2 * WINDOW - 1 and len(found := anchors(raw)):
                    rows.append(row)
                    cells.append(found)
        if not rows:
            return
        every = np.concatenate(cells)
        owner = np.repeat(np.arange(len(rows)), [len(c) for c in cells])
        order = np.argsort(every, kind="stable")
        of = every[order]
        new = np.append(True, of[1:] != of[:-1])
        more = np.append(~new[1:], False) | ~new  # equal to a neighbour
        twice = np.zeros(len(every), bool)
        twice[order] = more
        once = np.zeros(len(every), bool)
        once[order] = new
        del cells, order, of, new, more
        ends = np.cumsum(np.bincount(owner, minlength=len(rows)))
        begin = 0
        for some in range(0, len(rows), 1 << 12):
            stop = min(some + (1 << 12), len(rows))
            out = [[], []]
            for i in range(some, stop):
                s = slice(begin, ends[i])
                out[0].append(np.unique(every[s][twice[s]]))
                out[1].append(every[s][once[s]])
                begin = ends[i]
            yield pa.RecordBatch.from_arrays([pa.array(rows[some:stop], pa.int64()), *[
                pa.array(x, pa.list_(pa.int64())) for x in out]], names=["_p_row", "twice", "once"])
    return docs.select("_p_row", "_p_text").mapInArrow(counted, "_p_row long, twice array<long>, once array<long>")


def estimated(docs: DataFrame) -> DataFrame:
    """(_p_row, cells): the cells that the merged sketch counts twice or more, of documents that have some."""
    sketch = staged(sketched(docs))
    # one row for each cell and task; a task's own second one counts through `twice`
    merged = sketch.select("_p_row", F.explode("once").alias("cell")).withColumn("n", F.count("*").over(Window.partitionBy("cell")))
    hot = merged.where("n > 1").groupBy("_p_row").agg(F.collect_list("cell").alias("more"))
    both = sketch.select("_p_row", "twice").join(hot, "_p_row", "left")
    cells = both.select("_p_row", F.concat("twice", F.coalesce("more", F.array().cast("array<long>"))).alias("cells"))
    return staged(cells.where(F.size("cells") > 0))


def chosen(raw: bytes, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and both hashes of the windows whose cell is among the sorted cells."""
    for least, first, second, at in windows(raw):
        cell = (least >> LOW).astype(np.int64)
        near = np.searchsorted(cells, cell)
        near[near == len(cells)] = 0
        some = np.flatnonzero(cells[near] == cell)
        yield some + at, first[some], second[some]


def as_cells(x: pa.Scalar) -> np.ndarray:
    return np.unique(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else np.zeros(0, np.int64)


def suspects(docs: DataFrame) -> DataFrame:
    """docs (no, _p_text, cells) as the windows (a, b, no) that the sketch estimates repeated, each once a document."""
    def hashed(batches):
        for batch in batches:
            out, size = [[], [], []], 0
            for no, text, cells in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                found = list(chosen((text.as_py() or "").encode(), as_cells(cells)))
                both = np.unique(np.stack([np.concatenate([x[i] for x in found]) for i in (1, 2)], axis=1), axis=0)
                out[0].append(both[:, 0].astype(np.int64))
                out[1].append(both[:, 1].astype(np.int64))
                out[2].append(np.full(len(both), no, np.int64))
                size += len(both)
                if size > PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["a", "b", "no"])
                    out, size = [[], [], []], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["a", "b", "no"])
    return docs.select("no", "_p_text", "cells").mapInArrow(hashed, "a long, b long, no long")


def kept(raw: bytes, cells: np.ndarray, owned: np.ndarray) -> np.ndarray:
    """Which words stay: all that no repeated window covers. owned: first hashes of the windows that no earlier document has."""
    n = len(words(raw))
    if not len(cells) or n < WINDOW:
        return np.ones(n, bool)
    found = list(chosen(raw, cells))
    at, first, second = (np.concatenate([x[i] for x in found]) for i in range(3))
    order = np.lexsort((at, second, first))
    a, b = first[order], second[order]
    earliest = np.ones(len(at), bool)
    earliest[order[1:]] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    stays = earliest & np.isin(first.astype(np.int64), owned)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at[~stays], 1)
    np.add.at(cover, at[~stays] + WINDOW, -1)
    return np.cumsum(cover)[:n] == 0


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_words, n_removed and kept, the words that stay, joined by one space."""
    base = repeatable(docs).withColumns({"_p_row": F.monotonically_increasing_id(), "_p_text": F.col(text)})
    cells = estimated(base)
    # documents in order of their ids: a narrow sort over ranges
    order = [F.col(key).isNull(), F.col(key), F.col("_p_row")]
    numbers = base.select(F.col(key), "_p_row").repartitionByRange(*order).sortWithinPartitions(*order)
    numbers = staged(numbers.select(F.col("_p_row").alias("row"), F.monotonically_increasing_id().alias("no")))
    some = staged(cells.join(numbers, cells["_p_row"] == numbers["row"]).select("row", "no", "cells"))
    texts = base.select("_p_row", "_p_text")
    firsts = suspects(texts.join(some, texts["_p_row"] == some["row"])).groupBy("a", "b").agg(F.min("no").alias("no"))
    owned = firsts.groupBy("no").agg(F.collect_list("a").alias("owned"))
    verdicts = some.join(owned, "no", "left").select("row", "cells", "owned")

    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    @F.arrow_udf("struct<n_words:long,n_removed:long,kept:string>")
    def judged(texts: pa.Array, cells: pa.Array, owned: pa.Array) -> pa.Array:
        out = []
        for t, c, o in zip(texts, cells, owned):
            raw = (t.as_py() or "").encode()
            every = raw.split()
            stay = kept(raw, as_cells(c), as_cells(o)) if c.is_valid else None
            left = every if stay is None else list(compress(every, stay.tolist()))
            out.append({"n_words": len(every), "n_removed": len(every) - len(left), "kept": b" ".join(left).decode()})
        return pa.array(out, kind)
    # the function comes last: what it returns is not shuffled again
    rest = base.drop("_p_text", "n_words", "n_removed", "kept")
    done = texts.join(verdicts, texts["_p_row"] == verdicts["row"], "left").select(F.col("_p_row").alias("_p_of"), "_p_text", F.col("cells").alias("_p_cells"), F.col("owned").alias("_p_owned"))
    done = done.join(rest, F.col("_p_row") == F.col("_p_of")).withColumn("_p_done", judged("_p_text", "_p_cells", "_p_owned"))
    return done.select(*[F.col(f"`{c}`") for c in rest.columns if not c.startswith("_p_")], "_p_done.*")


#: op12 over the table documents, window by window.
CHECK_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM d)),
first AS (SELECT k, min({{'d': doc_id, 's': s}}) AS f FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS i FROM win JOIN first USING (k) WHERE doc_id <> f.d OR s <> f.s),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
stay AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(len(w) - coalesce(n, 0) AS bigint) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (doc_id)
"""
