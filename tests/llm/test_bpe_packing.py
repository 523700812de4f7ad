"""BPE against the tokenizers library; packing against its contract."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from designlab.llm import bpe, packing, registry

from ..conftest import SF_SMALL

EDGE = [None, "", " ", "a", "It's they'll WE'VE don't", "Straße ΑΣΣΟΣ İstanbul ﬁ ǅ", "x<|endoftext|>y <|startoftext|> <|endof",
        "日本語 テスト 12345 ４", "a b c\u0085d​e\x1cf", "é Å ̈́", "é" * 300, "ab" * 400,
        "😀👍🏽 !!! ... ---", "\x00\x01\x7f", "one\r\n\ttwo\x0bthree", "loooong " + "lo" * 5000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_encode_matches_library(library):
    coder = bpe.WordBpe(bpe.default_vocabulary())
    ids, counts = coder.encode_batch(EDGE)
    ends = np.cumsum(counts)
    for text, end, n in zip(EDGE, ends, counts, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        got = ids[end - n:end].tolist()
        assert got == want, text
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_encode_matches_library_on_every_plane_zero_character(library):
    coder = bpe.WordBpe(bpe.default_vocabulary())
    texts = [f"a{chr(c)}B{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    ids, counts = coder.encode_batch(texts)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at:at + n].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        at += n


def test_long_words_merge_alike():
    coder = bpe.WordBpe(bpe.default_vocabulary())
    rng = np.random.default_rng(3)
    for _ in range(50):
        word = "".join(rng.choice(list("thean"), 180))
        raw = word.encode()
        parts = [*map(coder.inner.__getitem__, raw[:-1]), coder.last[raw[-1]]]
        assert coder.merge(list(parts)) == coder._merge_long(list(parts))


def _library_rows(library, rows):
    out = {}
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        out[r["doc_id"]] = ids
    return out


def test_op8_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = _library_rows(library, docs.collect())
    got = registry.queries()["op8_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def check_pieces(rows, want):
    """Each id in one piece, gapless sequences, no padding, right digests."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(want)
    for doc, ids in want.items():
        ids = [*ids, packing.END_ID]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes())
        assert at == len(ids)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.LENGTH and (at & (at - 1) == 0)


def test_op10_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_pieces(registry.queries()["op10_packing"](spark, SF_SMALL).collect(), _library_rows(library, docs.collect()))


def test_assign_balances_cost():
    sizes = np.random.default_rng(1).integers(1, 6000, 500)
    pieces = packing.assign(sizes)
    assert sum(p[2] for p in pieces) == sizes.sum()
    # documents that fit a sequence are rarely cut
    assert len(pieces) < 500 + (sizes // 2048).sum() + len(packing.capacities(int(sizes.sum())))
    assert packing.assign(np.zeros(0, np.int64)) == []


def assign_directly(sizes, length):
    """Each piece, longest first, to the cheapest sequence with room; cut at the cheapest only where none has."""
    room = packing.capacities(int(sizes.sum()), length)
    used, cost, out = [0] * len(room), [0.0] * len(room), []
    todo = sorted((-min(length, int(n) - s), r, s) for r, n in enumerate(sizes) for s in range(0, int(n), length))
    while todo:
        size, row, start = todo.pop(0)
        size = -size
        free = [s for s in range(len(room)) if used[s] < room[s]]
        fit = [s for s in free if room[s] - used[s] >= size]
        s = min(fit or free, key=lambda s: (cost[s], s))
        n = min(size, room[s] - used[s])
        out.append((row, start, n, s, used[s]))
        used[s] += n
        cost[s] += packing.LINEAR * n + packing.QUADRATIC * n * n
        if n < size:
            todo = sorted([*todo, (n - size, row, start + n)])
    return out


def test_assign_cuts_only_where_no_sequence_has_room():
    rng = np.random.default_rng(2)
    for length, sizes in ((2048, rng.lognormal(5, 1.2, 3000).astype(np.int64) + 1), (64, rng.integers(1, 40, 2000)),
                          (2048, rng.integers(1, 9000, 300)), (16, np.array([16, 1, 0, 33, 5, 5, 5])),
                          (2048, np.array([3])), (2048, np.full(500, 300))):
        assert packing.assign(sizes, length) == assign_directly(sizes, length)


def test_empty_and_null_rows(spark):
    schema = "doc_id long, text string, ids string, bin int"
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (3, "a b", None, 1), (3, "a b", None, 1)], schema)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in bpe.op8_report(docs).collect()) == [(1, 0), (2, 0), (3, 2), (3, 2)]
    rows = packing.op10_report(docs).collect()
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in rows if r["start"] == 0) == [(1, 1), (2, 1), (3, 3), (3, 3)]
    empty = docs.limit(0)
    assert bpe.op8_report(empty).count() == 0 and packing.op10_report(empty).count() == 0


def test_equal_rows_are_dealt_to_several_groups(spark):
    text = " ".join(f"word{i}" for i in range(80))
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, text)] * 3000, schema).repartition(24)
    rows = packing.pack(docs, group_bytes=64 << 10).collect()
    groups = {}
    for r in rows:
        groups[r["sequence_id"] >> 32] = groups.get(r["sequence_id"] >> 32, 0) + (r["start"] == 0)
    assert sum(groups.values()) == 3000 and len(groups) > 4 and max(groups.values()) < 1500
