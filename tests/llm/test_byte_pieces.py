import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from factloom.llm import byte_pieces

RANKS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def library(tokens):
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=RANKS)
def made(request):
    tokens = byte_pieces.read_ranks(public_tokenizers.path(request.param))
    later = byte_pieces.later_letters(public_tokenizers.PATTERN)
    return library(tokens), byte_pieces.encoder(tokens, public_tokenizers.PATTERN, later), byte_pieces.decoder(tokens), later


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_are_the_librarys_and_decode_to_the_text(made):
    library, encode, decode, later = made
    letters = "ab  \n\t\x1c\x85'stéĠ日1²½😀.,!_ſ<|endoftext|>" + later[0] + later[-1]
    chance = random.Random(5)
    texts = ["".join(chance.choices(letters, k=chance.randrange(300))) for _ in range(1500)]
    texts += ["", " ", "\n" * 5000, "ab" * 200_000, "a" * 5000, "\x00\x01", "I'LL we'll  x"]
    for text in texts:
        assert ids(encode(text)) == library.encode_ordinary(text)
        assert decode(encode(text)).decode() == text


def test_every_character_has_the_librarys_kind(made):
    library, encode, _, later = made
    step = [*range(1, 0x3000), *range(0x3000, 0x110000, 61), *map(ord, later[::50])]
    for code in step:
        if not 0xD800 <= code < 0xE000:
            c = chr(code)
            text = f" a{c}a1{c}1!{c}é{c}日 {c}{c}\n{c} 's"
            assert ids(encode(text)) == library.encode_ordinary(text), hex(code)


def test_a_token_that_no_merges_reach_is_itself():
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"zzz"]
    encode = byte_pieces.encoder(tokens, r"\S+|\s+")
    for text in ("abc", "abcabc", "zzz", "zzzz", "xbc abc"):
        assert ids(encode(text)) == tiktoken.Encoding(
            "own", pat_str=r"\S+|\s+", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
        ).encode_ordinary(text)


def test_ranks_must_be_whole(tmp_path):
    file = tmp_path / "ranks"
    file.write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        byte_pieces.read_ranks(str(file))


def test_odd_documents(spark, odd_documents, no_documents):
    path = public_tokenizers.path(RANKS[0])
    encoded = byte_pieces.encode(odd_documents, path, round_trip=True)
    rows = encoded.collect()
    sent = library(byte_pieces.read_ranks(path))
    texts = [(r["doc_id"], r["text"] or "") for r in odd_documents.collect()]
    expected = []
    for key, text in texts:
        found = np.array(sent.encode_ordinary(text), "<u4")
        expected.append((key, len(found), hashlib.sha256(found.tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest(), found.tolist()))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    back = byte_pieces.decode(encoded, path)
    assert sorted((r["doc_id"], r["text"]) for r in back.collect() if r["doc_id"]) == sorted(t for t in texts if t[0])
    assert byte_pieces.encode(no_documents, path).count() == 0
    assert byte_pieces.decode(encoded.limit(0), path).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [200]), (3, [])], "doc_id int, ids array<int>")
    assert {r[0]: (r[1], r[2]) for r in byte_pieces.decode(odd, path).collect()}[3] == (b"", "")
    assert {r[0]: r[1] for r in byte_pieces.decode(odd, path).collect()}[1] is None


def test_query(spark, medium):
    from factloom.llm.registry import queries

    rows = queries["op12_byte_level_bpe"](spark, medium).collect()
    sent = library(byte_pieces.read_ranks(public_tokenizers.path(RANKS[0])))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        found = np.array(sent.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert r["n_tokens"] * 4 == len(found) and r["ids_sha256"] == hashlib.sha256(found).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
