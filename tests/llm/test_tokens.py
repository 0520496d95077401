import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from factloom.llm import byte_pairs, packing, sentence_pieces, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", " ", "  ", "\n", "\t", "▁", "é", "ß", "日本", "😀", "́", "1", "²", "Ⅷ", "'s", "'S", "!",
       "<|endoftext|>", "<s>", "</s>", "<0x41>", "\x1c", "\x85", "\xa0", "　", "​", "the", "_", "\r\n", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def tools():
    content = byte_pairs.vocabulary(BPE)
    whole = byte_pairs.whole_tokens(content)
    return byte_pairs.token_counter(content, whole), byte_pairs.token_packer(content, whole), whole


def test_whole_tokens_are_single_tokens_of_the_library(tools, library):
    _, _, whole = tools
    names = random.Random(1).sample(sorted(whole), 3000)
    for name, found in zip(names, library.encode_batch(names, add_special_tokens=False), strict=True):
        assert found.ids == [whole[name]]


def test_every_character_is_split_as_the_library_does(tools, library):
    count, pack, _ = tools
    points = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b{chr(c)} {chr(c)}1 {chr(c)}{chr(c)}" for c in points]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert pack(text) == struct.pack(f"<{len(found.ids)}I", *found.ids)
        assert count(text) == len(found.ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=25).map("".join))
def test_any_text_is_tokenised_as_the_libraries_do(text):
    text = text.encode("utf-8", "ignore").decode()
    content = byte_pairs.vocabulary(BPE)
    global WHOLE, LIBRARY, SP
    WHOLE = globals().get("WHOLE") or byte_pairs.whole_tokens(content)
    LIBRARY = globals().get("LIBRARY") or Tokenizer.from_file(BPE)
    SP = globals().get("SP") or SentencePieceProcessor(model_file=PIECES)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert byte_pairs.token_packer(content, WHOLE)(text) == struct.pack(f"<{len(ids)}I", *ids)
    pieces = SP.encode(text, add_bos=True, add_eos=True)
    got, decoded = sentence_pieces.segmenter(SP)(text)
    assert got == struct.pack(f"<{len(pieces)}I", *pieces) and decoded == SP.decode(pieces)


def test_counts_of_odd_rows(odd_documents, no_documents, library):
    found = token_counts.count_tokens(odd_documents, BPE, limit=1000)
    rows = sorted(found.collect(), key=str)
    given_rows = odd_documents.select("doc_id", "text").collect()
    expected = []
    for key, text in given_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((key, len((text or "").encode()), n, n > 1000))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert token_counts.count_tokens(no_documents, BPE).count() == 0


def test_pieces_of_odd_rows(odd_documents, no_documents):
    pieces = SentencePieceProcessor(model_file=PIECES)
    found = sentence_pieces.encode_decode(odd_documents, PIECES, with_ids=True)
    expected = []
    for key, text in odd_documents.select("doc_id", "text").collect():
        ids = pieces.encode(text or "", add_bos=True, add_eos=True)
        raw = struct.pack(f"<{len(ids)}I", *ids)
        expected.append((key, len(ids), hashlib.sha256(raw).hexdigest(),
                         hashlib.sha256(pieces.decode(ids).encode()).hexdigest(), ids, pieces.decode(ids)))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert sentence_pieces.encode_decode(no_documents, PIECES).count() == 0


def test_a_model_whose_pieces_cross_markers_is_refused(monkeypatch):
    real = SentencePieceProcessor(model_file=PIECES)

    class Crossing:
        def __init__(self, **_):
            pass

        get_piece_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda i: "a▁b")
        normalize = staticmethod(real.normalize)

    monkeypatch.setattr(sentence_pieces, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError):
        sentence_pieces.load(b"")


def check_packing(rows, capacity):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), by_doc


def test_packing_places_every_piece_once_without_gaps(documents, library):
    rows = packing.pack(documents, BPE, 2048).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    sequences, by_doc = check_packing(rows, 2048)
    total = 0
    crc = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows}
    for key, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        parts = sorted(by_doc[key])
        assert [p for p, _, _ in parts] == list(range(len(parts))) == list(range(-(-len(ids) // 2048)))
        at = 0
        for piece, start, length in parts:
            assert start == at and (length == 2048 or piece == 0)
            raw = struct.pack(f"<{length}I", *ids[start : start + length])
            assert crc[key, piece] == zlib.crc32(raw)
            at += length
        assert at == len(ids)
    assert sequences <= -(-total // 2048) * 1.01 + 1


def test_packing_of_odd_rows_and_sequences(odd_documents, no_documents):
    packed = packing.pack(odd_documents, BPE, 512, with_ids=True).cache()
    sequences, _ = check_packing(packed.withColumnRenamed("doc_id", "doc_id").collect(), 512)
    whole = packing.sequences(packed).collect()
    assert len(whole) == sequences
    lengths = {r["sequence_id"]: len(r["ids"]) for r in whole}
    sums = packed.groupBy("sequence_id").sum("length").collect()
    assert lengths == {r[0]: r[1] for r in sums}
    assert packed.filter("length = 1").count() == 3 and packing.pack(no_documents, BPE).count() == 0


def brute_best(histogram, capacity):
    """Fewest bins, by trying everything."""
    items = sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True)
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= items[k]:
                place(k + 1, [*bins[:i], room - items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 2), max_size=5))
def test_plan_uses_up_the_histogram_and_is_near_the_best(histogram):
    plan = packing.plan_bins(histogram, 20)
    used = {}
    for filled, times in plan:
        assert sum(n * c for n, c in filled.items()) <= 20
        for n, c in filled.items():
            used[n] = used.get(n, 0) + c * times
    assert used == histogram
    assert sum(t for _, t in plan) <= brute_best(histogram, 20) + 1


def test_two_documents_replace_the_smallest():
    # Greedy takes 12 and 6; 5 and 3 fill the gap of 8 that 6 leaves exactly.
    (filled, times), *_ = packing.plan_bins({12: 1, 6: 1, 5: 1, 3: 1}, 20)
    assert dict(filled) == {12: 1, 5: 1, 3: 1} and times == 1
