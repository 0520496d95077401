"""SentencePiece encoding and decoding (7) through a table of distinct marked words.

A text becomes words that each begin with the whitespace marker. No piece of the model
has a marker after another character (checked before the job), so no merge crosses a
word's edge: each distinct word is segmented once and its ids are joined back by position.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from factloom.llm.common import Memo, by_batch, per_worker, query, table, texts_of

DEFAULT_MODEL = "piece_bpe_32k.model"
MARK = "▁"


def load(model: bytes) -> SentencePieceProcessor:
    """The processor, once it is known to be one that can be cut at markers."""
    pieces = SentencePieceProcessor(model_proto=model)
    crossing = re.compile(f"[^{MARK}]{MARK}")
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    kept = pieces.normalize(" a  b\t\n c ") == f"{MARK}{MARK}a{MARK}{MARK}b\t\n{MARK}c{MARK}"
    if any(map(crossing.search, names)) or not kept:
        raise ValueError("pieces of this model can cross a whitespace marker")
    return pieces


def segmenter(pieces: SentencePieceProcessor) -> Callable[[str], tuple[bytes, str]]:
    """Text -> (ids with begin and end as little-endian unsigned 32-bit integers, decoded text)."""
    words = re.compile(f"{MARK}+[^{MARK}]*").findall

    def ids_of(word: str) -> bytes:
        # The processor adds the first marker itself.
        ids = pieces.encode(word[1:]) if len(word) > 1 else [pieces.piece_to_id(MARK)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def spoken(word: str) -> str:
        # Decoding drops the first marker of what it is given: a word keeps its own when
        # it stands behind another one.
        ids = list(struct.unpack(f"<{len(segmented[word]) // 4}I", segmented[word]))
        return pieces.decode([anchor, *ids])[1:]

    anchor = pieces.piece_to_id(MARK + "a")
    segmented, decoded = Memo(ids_of), Memo(spoken)
    begin, end = (struct.pack("<I", i) for i in (pieces.bos_id(), pieces.eos_id()))

    def run(text: str) -> tuple[bytes, str]:
        if not text:
            return begin + end, pieces.decode([pieces.bos_id(), pieces.eos_id()])
        found = words(MARK + text.replace(" ", MARK))
        ids = begin + b"".join(map(segmented.__getitem__, found)) + end
        return ids, "".join(map(decoded.__getitem__, found))[1:]

    return run


def encode_decode(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per row of `docs`: key, n_tokens, ids_sha256, decoded_sha256.

    `with_ids` adds `ids` (array) and `decoded`. A null text counts as empty: begin and end
    ids only. Nulls and repeats in the key pass through; other columns are not read. No
    shuffle; a task holds one batch and two bounded tables of words.
    """
    proto = Path(model).read_bytes()
    load(proto)
    made = per_worker(
        docs.sparkSession, proto, lambda value: segmenter(SentencePieceProcessor(model_proto=value))
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def task(batches):
        run = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [run(t) for t in texts_of(batch)]
            columns = {
                key: batch.column("key"),
                "n_tokens": pa.array([len(ids) // 4 for ids, _ in pairs], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in pairs]),
                "decoded_sha256": pa.array(
                    [hashlib.sha256(t.encode()).hexdigest() for _, t in pairs]
                ),
            }
            if with_ids:
                lists = [struct.unpack(f"<{len(ids) // 4}I", ids) for ids, _ in pairs]
                columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                columns["decoded"] = pa.array([t for _, t in pairs])
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if with_ids else ""
    return rows.mapInArrow(
        task, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    )


@query("op7_sentence_pieces")
def op7_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"), public_tokenizers.path(DEFAULT_MODEL))
