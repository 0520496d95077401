"""Byte-level BPE by whole-token shortcut, for token counts (5) and packing (2)."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from pathlib import Path

import regex
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from factloom.llm.common import Memo, per_worker

# Words that a task remembers; about 100 MB.
WORDS_KEPT = 500_000

# Fixed value: the split rule of byte-level BPE with `use_regex`.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same split for the plain `re`, which is faster; it holds for texts without the
# characters below, on whose kind the two differ, or that are beyond the table of bytes.
PLAIN_SPLIT = re.compile(
    r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+| ?\d+|\s+(?!\S)|\s+"
)
NOT_PLAIN = re.compile(r"[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbe\u0100-\U0010ffff]")


def byte_letters() -> dict[int, int]:
    """Byte -> the printable character that stands for it in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


def spelled(text: str, letters: dict[int, int]) -> str:
    return text.encode().decode("latin-1").translate(letters)


def vocabulary(path: str) -> str:
    """The tokenizer file's content, which tasks get with the job; checked to be a byte-level BPE."""
    content = Path(path).read_text(encoding="utf-8")
    rules = json.loads(content)
    split = rules["pre_tokenizer"]
    plain = (
        rules["normalizer"] is None
        and rules["model"]["type"] == "BPE"
        and split["type"] == "ByteLevel"
        and split["use_regex"]
        and not split["add_prefix_space"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is no plain byte-level BPE")
    return content


def whole_tokens(content: str) -> dict[str, int]:
    """Vocabulary strings that the split keeps in one piece and the merges turn into one token.

    Proven by running the merges on each of them, once, before the job.
    """
    tokenizer = Tokenizer.from_str(content)
    letters = byte_letters()
    byte_of = {chr(c): b for b, c in letters.items()}
    split = regex.compile(SPLIT)
    proven = {}
    for shown in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte_of[c] for c in shown).decode()
        except (UnicodeDecodeError, KeyError):
            continue
        if split.findall(text) == [text]:
            tokens = tokenizer.model.tokenize(shown)
            if len(tokens) == 1:
                proven[text] = tokens[0].id
    return proven


class Splitter:
    """Pre-tokens of a text; the vocabulary's special strings come out as they are."""

    def __init__(self, content: str):
        self.special = {t["content"]: t["id"] for t in json.loads(content)["added_tokens"]}
        self.find = regex.compile(SPLIT).findall
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def __call__(self, text: str) -> list[str]:
        if not any(name in text for name in self.special):
            return self.plain(text)
        found = []
        for part in self.cut.split(text):
            if part in self.special:
                found.append(part)
            else:
                found += self.plain(part)
        return found

    def plain(self, text: str) -> list[str]:
        return self.find(text) if NOT_PLAIN.search(text) else PLAIN_SPLIT.findall(text)


def merges(content: str) -> Callable[[str], list[int]]:
    """The library's merges on one pre-token that is no proven whole token."""
    model, letters = Tokenizer.from_str(content).model, byte_letters()
    return lambda word: [t.id for t in model.tokenize(spelled(word, letters))]


def token_counter(content: str, whole: dict[str, int]) -> Callable[[str], int]:
    """Text -> number of tokens."""
    split, merge = Splitter(content), merges(content)
    counts = Memo(lambda word: 1 if word in whole or word in split.special else len(merge(word)), WORDS_KEPT)
    return lambda text: sum(map(counts.__getitem__, split(text)))


def token_packer(content: str, whole: dict[str, int]) -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit integers."""
    split, merge = Splitter(content), merges(content)

    def ids(word: str) -> bytes:
        known = whole.get(word, split.special.get(word))
        found = merge(word) if known is None else [known]
        return struct.pack(f"<{len(found)}I", *found)

    packed = Memo(ids, WORDS_KEPT)
    return lambda text: b"".join(map(packed.__getitem__, split(text)))


def shared(spark: SparkSession, path: str, build: Callable) -> Callable:
    """For tasks: what `build` (one of the two above) makes of the tokenizer, once per worker."""
    content = vocabulary(path)
    return per_worker(spark, (content, whole_tokens(content)), lambda value: build(*value))
