"""Encoding, counting and packing against the library itself."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from conftest import ODD
from daybook.llm import bpe, counts, packing
from daybook.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
BITS = ["a", "aa", "the", " ", "  ", "\n", "'s", "'", "1", "é", "中", "😀", "<|endoftext|>", "<|endof", "ab", "ing", "!!", "\t", "==", "\x1c", " ª", "²"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def random_texts(n):
    r = random.Random(5)
    return ["".join(r.choices(BITS, k=r.randrange(60))) for _ in range(n)]


def test_encoding_is_the_librarys():
    code = bpe.Bpe(PATH)
    for t in random_texts(1500) + ["a" * 3000, "ab" * 2000, " " * 500]:
        ids = code.encode(t).tolist()
        assert ids == ids_of(t) and code.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == t
    r = random.Random(6)
    for _ in range(500):  # ids that no text gives, and broken characters
        ids = [r.randrange(50257) for _ in range(9)]
        assert code.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_character_splits_alike():
    code = bpe.Bpe(PATH)
    for lo in range(0, 0x30000, 256):
        t = "".join(f"a{chr(c)}b 1 {chr(c)}  z" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000)
        assert code.encode(t).tolist() == ids_of(t), hex(lo)


def test_one_encoding_per_piece():
    """Brute force: of all ways to cut a short piece into tokens whose neighbours fit, exactly one is left."""
    code = bpe.Bpe(PATH)
    by_bytes = {t: i for i, t in code.token_bytes.items() if i in code.made_at}

    def cuts(raw):
        if not raw:
            yield ()
        for n in range(1, len(raw) + 1):
            if raw[:n] in by_bytes:
                for rest in cuts(raw[n:]):
                    yield (by_bytes[raw[:n]], *rest)
    for piece in [" there", "aaaaa", "ingly", "1234", "''''", "étés", " \n\n "]:
        fitting = [c for c in cuts(piece.encode()) if all(code.fits(a, b) for a, b in zip(c, c[1:]))]
        assert fitting == [code.piece_ids(piece)]


def test_encode_and_decode_frames(spark, odd, none):
    rows = bpe.decode(bpe.encode(odd, PATH, out="h"), PATH, ids="h").collect()  # replaces the clashing column
    assert sorted((str(r.doc_id), r.text or "", tuple(r.h), r.decoded) for r in rows) == sorted((str(i), t or "", tuple(ids_of(t)), t or "") for i, t, _ in ODD)
    assert sorted((tuple(r.h), r.decoded) for r in rows) == sorted((tuple(r.h), r.decoded) for r in bpe.round_trip(odd, PATH, ids="h").collect())
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == bpe.round_trip(none, PATH).count() == 0
    given = spark.createDataFrame([(None,), ([],), ([255],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(given, PATH).collect()] == [None, "", LIBRARY.decode([255], skip_special_tokens=False)]


def test_op1(spark, docs):
    want = {r.doc_id: r.text for r in docs.collect()}
    got = QUERIES["op1_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want)
    for r in got:
        ids = ids_of(want[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_cut_texts(name, docs):
    texts = [r.text for r in docs.collect()] + random_texts(300) + [t for _, t, _ in ODD]
    whole, _ = counts.counter(P.path(name))
    want = [whole([t])[0] if t else 0 for t in texts]
    assert counts.count_texts(texts, P.path(name), long=40, batch=500).tolist() == want
    assert counts.count_texts(texts, P.path(name)).tolist() == want


def test_op3_and_odd_rows(spark, odd, none, docs):
    got = counts.token_counts(odd, PATH, out="h").collect()
    assert sorted(r.h for r in got) == sorted(len(ids_of(t)) for _, t, _ in ODD)
    assert counts.token_counts(none, PATH).count() == 0
    want = {(r.doc_id, len(r.text.encode()), n := len(ids_of(r.text)), n > 1024) for r in docs.collect()}
    assert {tuple(r) for r in QUERIES["op3_token_counts"](spark, "/root/testdata/sf0.001").collect()} == want


def test_merging_by_rank_is_the_librarys():
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    merge = packing.merger(spec)
    r = random.Random(8)
    pieces = {p for t in random_texts(400) if "<|endoftext|>" not in t for p in bpe.pieces_of(t)}
    pieces |= {"".join(r.choices("aeinrst", k=r.randrange(1, 40))) for _ in range(4000)} | {"a" * n for n in range(1, 65)}
    pieces |= {" " + "".join(chr(r.choice((97, 0xE9, 0x4E2D, 0x1F600)) + r.randrange(20)) for _ in range(r.randrange(1, 12))) for _ in range(2000)}
    for p in sorted(pieces):
        for q in bpe.pieces_of(p):
            assert merge(q.encode()) == ids_of(q), q
    code = packing.Encoder(PATH)
    texts = random_texts(300) + ["a" * 3000, "", " " * 500]
    assert [np.frombuffer(x, "<u4").tolist() for x in code.ids(texts)] == [ids_of(t) for t in texts]
    # merges in another order than their ids, or a token no merge makes: the library does it
    model = spec["model"]
    assert packing.merger(spec | {"model": model | {"merges": model["merges"][::-1]}}) is None
    assert packing.merger(spec | {"model": model | {"merges": model["merges"][:-1]}}) is None
    assert packing.merger(spec | {"model": model | {"ignore_merges": True}}) is None


def check_packing(rows, documents, tiers=packing.TIERS, last=1):
    """Every id once, in order, gapless sequences, padding only in a partition's last window."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    got = sorted((str(i), b"".join(p.ids for p in sorted(ps, key=lambda p: p.start))) for (i, _), ps in pieces.items())
    want = defaultdict(bytes)
    for i, t, *_ in documents:
        raw = np.array([*ids_of(t), 0], "<u4").tobytes()
        want[i, len(raw) // 4] += raw
    if len(want) == len(documents):
        assert got == sorted((str(i), raw) for (i, _), raw in want.items())
    assert sum(len(x) for _, x in got) == sum(map(len, want.values()))
    open_ = 0
    for ps in sequences.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:i]) for i in range(len(ps))]
        assert all(p.length == len(p.ids) // 4 > 0 for p in ps) and len({(p.tier, p.step) for p in ps}) == 1
        size = sum(p.length for p in ps)
        assert size <= max(tiers) and ps[0].tier in tiers
        open_ += size not in tiers
    assert open_ <= last
    return sequences


def test_packing(spark, odd, none, docs):
    check_packing(packing.pack(odd.coalesce(1), PATH).collect(), ODD)
    assert packing.pack(none, PATH).count() == 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sequences = check_packing(packing.pack(docs.coalesce(1), PATH, pool=20000).collect(), rows)
    steps = defaultdict(int)
    for ps in sequences.values():
        steps[ps[0].step] += ps[0].tier
    assert max(steps.values()) <= packing.STEP
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, tiers=(100, 1024))


def test_packing_of_text_ids_over_partitions(spark, docs):
    """Ids of any type; steps go on over partitions, so only a tier's last step holds less."""
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text").repartition(5, "doc_id")
    packed = packing.pack(named, PATH, step=4096).collect()
    sequences = check_packing(packed, [("d%s" % r.doc_id, r.text) for r in docs.collect()], last=5)
    steps = defaultdict(int)
    for ps in sequences.values():
        steps[ps[0].tier, ps[0].step] += ps[0].tier
    for tier in packing.TIERS:
        own = [n for (t, _), n in sorted(steps.items()) if t == tier]
        assert own[:-1] == [4096] * len(own[:-1]) and max(own[-1:], default=0) <= 4096


def test_encoder_that_forgets(monkeypatch):
    """Any number of remembered pieces gives the same ids."""
    texts = random_texts(600)
    for cached in (0, 5, 60, 10 ** 6):
        monkeypatch.setattr(packing, "CACHED", cached)
        code = packing.Encoder(PATH)
        got = [i for at in range(0, 600, 7) for i in code.ids(texts[at:at + 7])]
        assert got == [np.array(ids_of(t), "<u4").tobytes() for t in texts]


def test_packer_cuts_only_to_fill():
    p = packing.Packer()
    out = []
    for i, n in enumerate([600, 424, 128, 1024, 2048 + 5, 700, 300, 30, 512, 90]):
        out += p.add(i, b"\1\0\0\0" * n)
    out += p.pack()
    shapes = sorted(tuple(sorted((x.doc, x.length) for x in ps)) for _, ps in out)
    assert ((2, 128),) in shapes and ((8, 512),) in shapes and ((0, 600), (1, 424)) in shapes
    assert sum(n for ps in shapes for _, n in ps) == 600 + 424 + 128 + 1024 + 2053 + 700 + 300 + 30 + 512 + 90


def test_short_tiers_are_packed_from_pieces():
    """Pieces that no long window takes fill windows of their own tier; only the last window has room."""
    r = random.Random(2)
    for lengths in ((60, 500), (20, 120), (130, 250)):
        p, out = packing.Packer(pool=4000), []
        sizes = [r.randrange(*lengths) for _ in range(300)]
        for i, n in enumerate(sizes):
            out += p.add(i, b"\1\0\0\0" * n)
        out += p.pack()
        assert sum(x.length for _, ps in out for x in ps) == sum(sizes)
        assert sum(sum(x.length for x in ps) != tier for tier, ps in out) <= 1
        assert max(tier for tier, _ in out) == p.tier(max(sizes)) and sum(len(ps) > 1 for _, ps in out) > 20


def test_steps_run_over_partitions(spark):
    rows = [(i, "Some words in a short text. " * (1 + i % 40)) for i in range(600)]
    seen = {(r.sequence_id, r.tier, r.step) for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), PATH, step=4096).collect()}
    assert len({s for s, *_ in seen}) == len(seen) and len({s >> 32 for s, *_ in seen}) == 6
    counts_ = defaultdict(lambda: defaultdict(int))
    for _, tier, step in seen:
        counts_[tier][step] += 1
    assert len(counts_) > 1
    for tier, steps in counts_.items():
        assert sorted(steps) == list(range(min(steps), max(steps) + 1, len(packing.TIERS))) and min(steps) == packing.TIERS.index(tier)
        assert all(n == 4096 // tier for step, n in steps.items() if step != max(steps))


def test_op7(spark, docs):
    want = {r.doc_id: np.array([*ids_of(r.text), 0], "<u4").tobytes() for r in docs.collect()}
    seen = defaultdict(int)
    for r in QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect():
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][4 * r.start:4 * (r.start + r.length)]) and r.doc_tokens == len(want[r.doc_id]) // 4
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) // 4 for i, x in want.items()}
