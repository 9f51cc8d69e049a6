from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retrocohort.llm import token_store
from retrocohort.llm.token_coder import decode, encode
from retrocohort.llm.token_store import pack, read_token_files, unpack, write_token_files
from retrocohort.llm.texts import table

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "don't DON'T it's 'sure'", "a b c\x1cd\x85e", "é ́x ﬁ Å Σας ΣΑΣ İstanbul", "<|endoftext|>x <|startoftext|>",
    '""" " "quoted" 12345 3.14', "日本語 テキスト 🙂🙂 a🙂b", "\x00 ﻿ x", "tab\tnew\nline\r\x0b\x0c end",
]


def expected(rows):
    """[(doc_id, start, n, crc32)] from whole texts, one after the other."""
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def found(spark, docs, path):
    write_token_files(docs, path, PATH)
    rows = read_token_files(spark, path).collect()
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows), key=lambda r: r[1])


def test_files_hold_the_ids_of_whole_texts(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(spark, docs, f"{tmp_path}/a") == expected(rows)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    tricky = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(tricky).selectExpr("*", "1 AS part", "'x' AS payload")
    rows = [tuple(r)[:2] for r in docs.collect()]
    assert found(spark, docs, f"{tmp_path}/a") == expected(rows)
    assert found(spark, no_docs, f"{tmp_path}/b") == []


def test_small_records_and_forgetting_give_the_same(spark, tmp_path, monkeypatch):
    documents = [np.arange(5), np.zeros(0, dtype=np.int64), np.full(5000, 49_407), np.array([1])]
    doc_ids, back = unpack(pack([3, None, 4, 4], documents))
    assert doc_ids == [3, None, 4, 4]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(documents, back, strict=True))
    monkeypatch.setattr(token_store, "REMEMBERED", 3)
    encoder = token_store._Encoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for text in [*TRICKY, *TRICKY]:
        assert encoder([text], 1)[0].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_damage_is_noticed():
    record = pack([1], [np.arange(3000) % 700])
    for at in (20, 40, len(record) - 40):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            unpack(bytes(broken))
    with pytest.raises(ValueError, match="below"):
        pack([1], [np.array([70_000])])


def test_coder_round_trip():
    draw = np.random.default_rng(2)
    for ids in (
        draw.integers(0, 65_536, (5, 300)),
        np.full((3, 500), 65_535),
        np.tile(np.arange(40), (3, 20)),
        draw.geometric(0.01, (40, 400)) % 65_536,
        draw.integers(0, 3, (7, 1)),
        np.where(draw.random((7, 3000)) < 0.01, draw.integers(0, 65_536, (7, 3000)), 7),
    ):
        codes = encode(ids)
        assert (decode(codes, ids.shape[1]) == ids).all()
        # a block stands by itself
        assert (decode(codes[1:2], ids.shape[1]) == ids[1:2]).all()


def test_repeats_cost_little():
    ids = np.tile(np.arange(100, 164), (16, 32))
    assert sum(map(len, encode(ids))) < 0.3 * ids.size


def test_remembered_ids_outlast_one_other_id():
    """Pairs that nearly always follow each other, broken now and then; a table of 512 places or a guess given up at once costs more."""
    rnd = np.random.default_rng(5)
    follow = rnd.integers(0, 1 << 16, 600)
    blocks = follow[np.arange(4 * 2048).reshape(4, 2048) % 600]
    broken = rnd.random(blocks.shape) < 0.1
    blocks = np.where(broken, rnd.integers(0, 1 << 16, blocks.shape), blocks)
    codes = encode(blocks)
    assert (decode(codes, 2048) == blocks).all()
    assert sum(map(len, codes)) / blocks.size < 1.55


def test_each_part_of_words_is_encoded_once():
    encoder = token_store._Encoder(PATH)
    texts = ["Word, word. (WORD) words; word-word", "WORD! été Été. ÉTÉ", None, "\n word 12 2 日本 日本"]
    tokenizer = Tokenizer.from_file(PATH)
    for found, text in zip(encoder(texts, 1), texts, strict=True):
        assert found.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    assert {p for p in encoder.part if p.isalnum()} == {"word", "words", "été", "1", "2"}
    assert list(encoder.number) == ["日本"]


def test_odd_joins_equal_whole_texts():
    draw = np.random.default_rng(6)
    pieces = ["'", "s", "'LL", "re", "Z", "é", "ÿ", "×", "ª", "µ", "²", "0", ".", "<|endoftext|>", "<|", "|>", "</w>",
              " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "İ", "Σ", "́", "日本", "🙂", "K", "\x00", "-"]
    tokenizer, encoder = Tokenizer.from_file(PATH), token_store._Encoder(PATH)
    for last in (12, len(pieces)):
        texts = ["".join(draw.choice(pieces[:last], 12)) for _ in range(400)]
        expect = [[*e.ids, 1] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder(texts, 1)] == expect


def test_carries_go_through_many_words():
    """Ids at the upper ends of all spans: the low end of the interval is all ones, and often overflows."""
    draw = np.random.default_rng(7)
    ids = np.where(draw.random((64, 900)) < 0.03, draw.integers(0, 1 << 16, (64, 900)), 65_535)
    codes = encode(ids)
    assert (decode(codes, 900) == ids).all()
    assert sum(map(len, codes)) / ids.size < 0.143


def test_records_are_decoded_side_by_side(monkeypatch):
    draw = np.random.default_rng(8)
    given = [
        ([i, None], [draw.integers(0, 49_408, size), np.array([1])])
        for i, size in enumerate((5000, 9000, 3, 3, 4, 100_000, 2500))
    ]
    records = [pack(*x) for x in given] + [pack([7], [np.zeros(0, dtype=np.int64)])]
    calls = []
    monkeypatch.setattr(token_store, "decode", lambda codes, size: calls.append(len(codes)) or decode(codes, size))
    for bound, expect in ((token_store.SIDE_BY_SIDE, [8, 2, 1, 51]), (50, [8, 2, 1, 49, 2])):
        calls.clear()
        monkeypatch.setattr(token_store, "SIDE_BY_SIDE", bound)
        found = list(token_store.unpack_all(records))
        assert calls == expect
        assert found[-1][0] == [7] and [len(d) for d in found[-1][1]] == [0]
        for (doc_ids, documents), (ids, expected_documents) in zip(found[:-1], given, strict=True):
            assert doc_ids == ids
            assert all((a == b).all() and len(a) == len(b) for a, b in zip(documents, expected_documents, strict=True))
    broken = bytearray(records[1])
    broken[-40] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_store.unpack_all([records[0], bytes(broken), records[2]]))
