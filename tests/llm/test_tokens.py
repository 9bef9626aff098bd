import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing, token_file
from ledgerloom.llm.arrays import slices
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.llm.tokens import ChunkIds
from tests.llm.fixtures import odd_texts, table

ODD = ["", "Hello, world's 'tis don't!! ", "a≠b .́x ΑΣ.ΒΣ' ΣΑΣ <|endoftext|>x", "x y z　w\u0085q​q", "é ́e tel:+1-2 3.14abc123", "日本語テキスト、です。ab語",
       "각 ﷺ İIı ß ſ", "'S 'LL it'LL x''s --'s .'s", "\x00\x01a\x1fb\x7f", "👩‍👩‍👧 🏳️‍🌈!", "a̸≠ ≠ ≮", "\r\n\t \x0b\x0ca", "word " * 4000]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ENCODER = ChunkIds(tokenizer_path())


def encoded(texts):
    out = []
    for _, n, data, offsets in slices(pa.array(texts, pa.string()), most=5000):
        ids, begin = ENCODER.encode(data, offsets)
        out += [ids[begin[i] : begin[i + 1]].tolist() for i in range(n)]
    return out


def test_chunks_equal_whole_texts(plain):
    assert encoded(ODD) == [plain(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab 'st.!=,̸́Σσé漢\n1"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text_equals_whole(text):
    t = Tokenizer.from_file(tokenizer_path()) if not hasattr(test_any_text_equals_whole, "t") else test_any_text_equals_whole.t
    test_any_text_equals_whole.t = t
    assert encoded([text]) == [t.encode(text, add_special_tokens=False).ids]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "<", "|", ">", "a", "Ab1", " ", "é", "\u0301", "'s", ".", "\n"]), max_size=12).map("".join))
def test_added_tokens_anywhere(text):
    t = Tokenizer.from_file(tokenizer_path()) if not hasattr(test_added_tokens_anywhere, "t") else test_added_tokens_anywhere.t
    test_added_tokens_anywhere.t = t
    assert encoded([text, text]) == [t.encode(text, add_special_tokens=False).ids] * 2


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 5000):
        for ids in (rng.integers(0, 49408, n), rng.geometric(0.01, n), np.full(n, 7), np.where(rng.random(n) < 0.05, 2**32 - 1, rng.integers(0, 9, n))):
            data, begin = token_file.encode_blocks(ids)
            assert (token_file.decode_blocks(data, begin[:-1])[:n] == ids).all() and begin[-1] == len(data)


def test_any_range_is_read_from_its_blocks():
    ids = np.random.default_rng(1).integers(0, 50000, 3000)
    file = token_file.TokenFile(token_file.file_bytes(ids, [5, None], np.array([0, 1200])))
    assert file.doc_ids == [5, None] and file.starts.tolist() == [0, 1200, 3000]
    for a, b in ((0, 3000), (0, 0), (100, 101), (127, 129), (1199, 2999)):
        assert file.ids(a, b).tolist() == ids[a:b].tolist()


def test_files_hold_every_document_in_order(spark, plain, tmp_path):
    texts = odd_texts() + ODD
    ids = [None if i == 5 else 3 if i == 4 else i for i in range(len(texts))]
    manifest = token_file.write_tokens(table(spark, texts, ids), tokenizer_path(), str(tmp_path / "out"), file_ids=2000)
    assert manifest.count() > 2
    rows = sorted(token_file.read_tokens(manifest).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in rows] == sorted(ids, key=lambda x: -1 if x is None else x)
    at, want = 0, defaultdict(list)
    for i, t in zip(ids, texts):
        want[i].append([*plain(t), 2])
    for r in rows:
        own = np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()
        want[r["id"]].remove(own)
        assert r["start"] == at and r["n_tokens"] == len(own)
        at += len(own)
    assert not any(want.values())
    assert token_file.read_tokens(token_file.write_tokens(table(spark, []), tokenizer_path())).count() == 0


def test_packed_sequences_are_whole(spark, plain):
    texts = odd_texts() + ODD
    rows = packing.packed_sequences(table(spark, texts, ids=[None if i == 3 else i for i in range(len(texts))]), tokenizer_path(), capacity=500).collect()
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.frombuffer(bytes(r["ids"]), dtype="<u4")
        assert len(own) == r["length"] and zlib.crc32(bytes(r["ids"])) >= 0
        per_doc[r["doc_id"]].append((r["piece"], r["start"], own.tolist()))
        per_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        parts = sorted(per_doc[None if i == 3 else i])
        assert [p[0] for p in parts] == list(range(len(parts))) and all(len(p[2]) == 500 for p in parts[:-1])
        assert sum((p[2] for p in parts), []) == [*plain(t), 0] and [p[1] for p in parts] == [500 * k for k in range(len(parts))]
    for placed in per_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 500
    total = sum(r["length"] for r in rows)
    assert len(per_sequence) <= -(-total // 500) + 2
    assert packing.packed_sequences(table(spark, []), tokenizer_path()).count() == 0


def test_tree_of_many_partitions(spark):
    """Several rounds of merging: gapless, nothing lost, and nearly as few bins as the sizes allow."""
    sizes = [(k * 7919) % 1500 + 1 for k in range(6000)]
    items = packing.durable(spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "k long, size long").repartition(40))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = packing.pack(items, "size").select("item.*", "sequence_id", "offset").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r["k"] for r in rows) == list(range(6000))
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["size"]))
    for placed in bins.values():
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= packing.CAPACITY
    assert len(bins) <= 1.02 * sum(sizes) / packing.CAPACITY + 1


def test_best_fit_takes_the_tightest_bin():
    bin_of, place, fill = packing.best_fit(np.array([6, 5, 4, 5, 10]), 10)
    assert fill.tolist() == [10, 10, 10] and len(set(bin_of.tolist())) == 3 and place[4] == 0
