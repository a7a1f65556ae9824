from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from tests.llm.rows import empty_documents, odd_documents, with_clashes
from tillmart.llm import bpe
from tillmart.llm.queries import QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def own():
    with open(vocabulary_path(), encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_every_code_point_splits_and_encodes_like_the_library(own, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        texts = ["".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}b" for c in points[k:k + 16]) for k in range(at, min(at + 4096, len(points)), 16)]
        assert own.encode_all(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_random_mixtures_encode_and_decode_like_the_library(own, library):
    rng = random.Random(1)
    parts = ["a", "b ", "  ", "\n", "é", "1", "'s", "'LL", "<|endoftext|>", "　", "ß", "!", " ", "\x1f", "\x85", "th", "😀", "<|endof"]
    texts = ["", " ", "a" * 3000, "ab" * 900 + " x", *("".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000))]
    found = own.encode_all(texts)
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(i) for i in found] == [library.decode(i, skip_special_tokens=False) for i in found] == texts


def test_scan_and_heap_give_the_same_merges(own):
    rng = random.Random(2)
    for _ in range(300):
        word = bytes(rng.choices(b"theinganos ", k=rng.randint(1, 90)))
        assert list(own.scan([word])[0]) == own.heap([own.byte_ids[b] for b in word])


def test_bytes_that_are_no_text_decode_like_the_library(own, library):
    rng = random.Random(3)
    for _ in range(300):
        ids = rng.choices(range(50257), k=5) + [60_000]
        assert own.decode(ids) == library.decode(ids[:5], skip_special_tokens=False)


def test_odd_rows(spark, library):
    rows = with_clashes(odd_documents(spark))
    found = bpe.decode(bpe.encode(rows, vocabulary_path()), vocabulary_path(), text="again").collect()
    assert len(found) == rows.count()
    for row in found:
        text = row.text or ""
        assert row.ids == library.encode(text, add_special_tokens=False).ids and row.again == text and row.score == "kept score"
    assert bpe.encode(empty_documents(spark), vocabulary_path()).count() == 0


def test_query_is_the_librarys_round_trip(spark, sample_dir, library):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sample_dir}/documents.parquet").collect()}
    for row in QUERIES["op2_bpe"].run(spark, sample_dir).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
