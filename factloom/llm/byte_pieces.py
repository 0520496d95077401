"""Byte-level BPE encoding and decoding (12) by a SentencePiece model made from the ranks.

The rank file becomes a SentencePiece BPE model as it stands: each token is a piece spelled in
the printable characters that stand for its bytes, its score is its negative rank, and the
normaliser is the identity. Nothing is trained. The model then merges, of all neighbours whose
union is a piece, the one of the best score and of equals the leftmost, which is the rule of
the ranks. Pre-tokens are encoded one by one; ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import unicodedata
from collections.abc import Callable
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from factloom.llm.byte_pairs import NOT_PLAIN, PLAIN_SPLIT, byte_letters, spelled
from factloom.llm.common import Memo, by_batch, per_worker, query, table, texts_of

DEFAULT_RANKS = "byte_bpe_50k.tiktoken"

# Field numbers and kinds of a SentencePiece model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL_PIECE, UNKNOWN_PIECE = 1, 2
MODEL_TYPE, VOCABULARY_SIZE, UNKNOWN_ID, BPE = 3, 4, 40, 2
NAME, DUMMY_PREFIX, DROP_SPACES, ESCAPE_SPACES = 1, 3, 4, 5
UNKNOWN = "<unk>"


def _number(n: int) -> bytes:
    """A base-128 number, lowest digits first."""
    found = bytearray()
    while n > 127:
        found.append(n & 127 | 128)
        n >>= 7
    return bytes([*found, n])


def _field(place: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _number(place << 3 | 2) + _number(len(value)) + value
    if isinstance(value, float):
        return _number(place << 3 | 5) + struct.pack("<f", value)
    return _number(place << 3) + _number(value)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank; ranks must run from 0 and cover every byte."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    ranks = {int(rank): base64.b64decode(token) for token, rank in lines}
    tokens = [ranks.get(i, b"") for i in range(len(ranks))]
    if len(set(tokens) - {b""}) < len(tokens) or not {bytes([b]) for b in range(256)} <= set(tokens):
        raise ValueError(f"{path} has gaps, repeated tokens or lacks single bytes")
    return tokens


def piece_model(tokens: list[bytes]) -> bytes:
    """A SentencePiece BPE model whose ids are the ranks; the unknown piece comes last."""
    letters = byte_letters()
    body = []
    for rank, token in enumerate(tokens):
        shown = token.decode("latin-1").translate(letters).encode()
        body.append(_field(PIECES, _field(PIECE, shown) + _field(SCORE, float(-rank)) + _field(KIND, NORMAL_PIECE)))
    body.append(_field(PIECES, _field(PIECE, UNKNOWN.encode()) + _field(SCORE, 0.0) + _field(KIND, UNKNOWN_PIECE)))
    trainer = (
        _field(MODEL_TYPE, BPE) + _field(VOCABULARY_SIZE, len(tokens) + 1) + _field(UNKNOWN_ID, len(tokens))
    )
    normalizer = (
        _field(NAME, b"identity") + _field(DUMMY_PREFIX, 0) + _field(DROP_SPACES, 0) + _field(ESCAPE_SPACES, 0)
    )
    return b"".join([*body, _field(TRAINER, trainer), _field(NORMALIZER, normalizer)])


# Code points that no edition of Unicode has given a meaning: no letter, number or white space.
NO_KIND = "\u0378"


def later_letters(pattern: str) -> str:
    """Characters that `regex` takes for letters or numbers and the library, being older, does not.

    Only those that Python's own tables do not know yet are tried: next to a letter or number
    they stand in its pre-token if they are of its kind, and merge with it under ranks that
    merge everything.
    """
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([b]) + t: 256 + 2 * b + k for b in range(0x80, 0xC0) for k, t in enumerate((b"a", b"1"))}
    split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = regex.compile(r"[\p{L}\p{N}]")
    new = (chr(c) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn")
    return "".join(
        c for c in new
        if found.match(c)
        and all(len(split.encode_ordinary(c + t)) > len(c.encode()) for t in ("a", "1"))
    )


def splitter(pattern: str, later: str) -> Callable[[str], list[str]]:
    """Text -> pre-tokens; `later` are read as the library reads them, as signs."""
    find = regex.compile(pattern)
    plain = PLAIN_SPLIT.findall if pattern == public_tokenizers.PATTERN else find.findall
    as_signs, no_later = dict.fromkeys(map(ord, later), NO_KIND), frozenset(later).isdisjoint

    def run(text: str) -> list[str]:
        if not NOT_PLAIN.search(text):
            return plain(text)
        if no_later(text):
            return find.findall(text)
        return [text[m.start() : m.end()] for m in find.finditer(text.translate(as_signs))]

    return run


def encoder(tokens: list[bytes], pattern: str, later: str = "") -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit integers."""
    pieces = SentencePieceProcessor(model_proto=piece_model(tokens))
    letters, rank_of = byte_letters(), {t: i for i, t in enumerate(tokens)}
    split = splitter(pattern, later)

    def ids(word: str) -> bytes:
        # A pre-token that is a token is that token, also where no merges would lead to it.
        whole = rank_of.get(word.encode())
        found = pieces.encode(spelled(word, letters)) if whole is None else [whole]
        return struct.pack(f"<{len(found)}I", *found)

    packed = Memo(ids)
    return lambda text: b"".join(map(packed.__getitem__, split(text)))


def decoder(tokens: list[bytes]) -> Callable[[bytes], bytes]:
    """Ids as the encoder gives them -> the bytes of the text."""
    spelling = tokens.__getitem__
    return lambda ids: b"".join(map(spelling, np.frombuffer(ids, "<u4").tolist()))


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str = public_tokenizers.PATTERN,
    key: str = "doc_id",
    text: str = "text",
    round_trip: bool = False,
    with_ids: bool = True,
) -> DataFrame:
    """One row per row of `docs`: key, n_tokens, ids_sha256, with `ids` (array) if asked for.

    `round_trip` decodes the ids again and adds decoded_sha256. A null text counts as empty and
    has no ids; whole texts of any length are encoded. Nulls and repeats in the key pass
    through, other columns are not read. No shuffle: a task holds one batch, the model and a
    bounded table of pre-tokens. The pattern must match every character of every text, as the
    default does: what it leaves out is not encoded.
    """
    value = (read_ranks(ranks), pattern, later_letters(pattern))
    made = per_worker(docs.sparkSession, value, lambda v: (encoder(*v), decoder(v[0])))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def task(batches):
        ids_of, bytes_of = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [ids_of(t) for t in texts_of(batch)]
            columns = {
                key: batch.column("key"),
                "n_tokens": pa.array([len(ids) // 4 for ids in found], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(ids).hexdigest() for ids in found], pa.string()),
            }
            if round_trip:
                digests = [hashlib.sha256(bytes_of(ids)).hexdigest() for ids in found]
                columns["decoded_sha256"] = pa.array(digests, pa.string())
            if with_ids:
                columns["ids"] = pa.array([np.frombuffer(ids, "<i4") for ids in found], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    more = (", decoded_sha256 string" if round_trip else "") + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(task, f"`{key}` {kind}, n_tokens long, ids_sha256 string{more}")


def decode(encoded: DataFrame, ranks: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of `encoded`: key, bytes (binary), text (null where the bytes are no UTF-8).

    Null ids give nulls; an id that is null or no rank is an error, since nothing can stand for it.
    """
    tokens = read_ranks(ranks)
    made = per_worker(encoded.sparkSession, tokens, decoder)
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))

    def readable(found: bytes | None) -> str | None:
        try:
            return None if found is None else found.decode()
        except UnicodeDecodeError:
            return None

    def task(batches):
        bytes_of = made()

        def one(ids: list[int] | None) -> bytes | None:
            if ids is None:
                return None
            if any(i is None or i < 0 for i in ids):
                raise ValueError("an id is null or negative")
            return bytes_of(np.asarray(ids, "<u4").tobytes())

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [one(ids) for ids in batch.column("ids").to_pylist()]
            texts = pa.array([readable(b) for b in found], pa.string())
            return pa.RecordBatch.from_pydict(
                {key: batch.column("key"), "bytes": pa.array(found, pa.binary()), "text": texts}
            )

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(task, f"`{key}` {kind}, bytes binary, text string")


@query("op12_byte_level_bpe")
def op12_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return encode(docs, public_tokenizers.path(DEFAULT_RANKS), round_trip=True, with_ids=False)
