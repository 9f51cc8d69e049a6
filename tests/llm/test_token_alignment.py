"""Alignment of two tokenizers against whole-text encoding and decoded bytes."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from retrocohort.llm.queries import QUERIES
from retrocohort.llm.token_alignment import Aligner, linked_documents, parts

FOLDER = "/root/testdata/sf0.01"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "b", " ", "\n", "  ", "日", "本", "\U0001f600", "é", "é", "▁", "\t", "　", "\x00", "\x1c", "\x85", "<s>",
        "</s>", "<|endoftext|>", "<0x41>", "don't", "'s", "1", "²", ".", "23", "!", "%%%", "\r\n", "\xa0", "​", "the", "_"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def __call__(self, text):
        """n_a, n_b, groups and linked pairs from one encoding of the whole text."""
        raw = b" " + (text or "").encode()
        a = self.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = self.b.encode(text) if text else []
        a_bytes = [bytes(self.byte.get(c, 0) for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in b)
        ]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return 0, 0, [], []
        ends_a = {e: i for i, e in enumerate(itertools.accumulate(map(len, a_bytes)), 1)}
        ends_b = {e: i for i, e in enumerate(itertools.accumulate(map(len, b_bytes)), 1)}
        cuts = [(ends_a[e], ends_b[e]) for e in sorted(ends_a.keys() & ends_b.keys())]
        groups = [
            f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}"
            for (i, j), (x, y) in itertools.pairwise([(0, 0), *cuts])
        ]
        return len(a), len(b), groups, [(a[x - 1], b[y - 1]) for x, y in cuts]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def plain_rows(plain, rows):
    found = [(doc_id, *plain(text)) for doc_id, text in rows]
    counts = Counter(p for *_, links in found for p in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        (
            (
                doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
                sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links in found
        ),
        key=repr,
    )


def got_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_whole_texts(spark, plain):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = plain_rows(plain, map(tuple, rows))
    assert got_rows(QUERIES["op12_token_alignment"](spark, FOLDER)) == want
    assert any(r[4] for r in want) and any(0 < r[5] < r[4] for r in want)


@pytest.mark.parametrize("broadcast_bytes", [0, 20_000, 1 << 26])
def test_odd_texts_by_broadcast_and_by_shuffle(spark, plain, odd_docs, broadcast_bytes):
    draw = random.Random(5)
    texts = ["".join(draw.choices(BITS, k=draw.randint(0, 14))) for _ in range(1500)]
    rows = [(i, t) for i, t in enumerate(texts)]
    odd = odd_docs.select("doc_id", "text")
    df = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = got_rows(linked_documents(df, *PATHS, broadcast_bytes=broadcast_bytes))
    assert got == plain_rows(plain, [*map(tuple, odd.collect()), *rows])


def test_spans_refine_characters_and_fallback_bytes(plain):
    aligner = Aligner(*PATHS)
    for text in ("a͸b \U0001f600x", "日本語 ͸ é", "͸͸", "<0x41>\x00"):
        found = aligner.align(f" {text}")
        n_a, n_b, groups, links = plain(text)
        assert (found.n_a, found.n_b, found.groups.decode()) == (n_a, n_b, ";".join(groups))
        assert len(found.pairs) == len(links)
    assert aligner.align(" a▁b") is None


def test_parts_join_to_the_text():
    assert parts("one two.\nThree (four)") == [" one", " two", ".", "\n", "Three", " (four)"]
    assert parts("one  two") is None and parts(" one") is None and parts("a\tb") is None
