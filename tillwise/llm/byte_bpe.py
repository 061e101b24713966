"""Byte-level BPE encoding and decoding through a sentencepiece model written straight from a rank file.

Each byte of a text stands for one printable character, so a byte-level vocabulary becomes an ordinary
sentencepiece BPE vocabulary: piece ``r`` is the mapped byte string of rank ``r`` with score ``-r``, the
normaliser changes nothing, and the best-scored merge is the merge of lowest rank. The model file is
serialised here as protocol-buffer fields; nothing is trained. Texts are cut into pre-tokens first and each
different pre-token is encoded once per batch; ids go back to bytes through the inverse of the byte mapping.

Defined cases: a null or empty text has no ids; a pre-token that is a vocabulary entry is that entry, as in
rank-based encoders, even if merges would not reach it; rows are independent, so repeated rows, repeated or
null ids and empty tables need no rule. Other columns of the input are ignored. A text is encoded by itself,
at most ``_CACHE`` different pre-tokens are remembered per task, so memory follows the longest text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

_CACHE = 300_000
_TOGETHER = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file (base64 token, rank per line) by a path of the driver; its size is that of a vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def byte_characters() -> list[str]:
    """Character of each byte: printable Latin-1 characters stand for themselves, the rest for U+0100 and up."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece model of a byte-level vocabulary; the unknown piece comes after the last rank."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte needs a rank")
    table = byte_characters()
    pieces = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        text = "".join([table[b] for b in token]).encode()
        pieces.append(_block(1, _block(1, text) + b"\x15" + struct.pack("<f", -rank) + _number(3, 1)))
    pieces.append(_block(1, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + _number(3, 2)))
    trainer = _number(3, 2) + _number(4, len(ranks) + 1) + _number(40, len(ranks))  # type BPE, size, unknown id
    identity = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, identity)


def newer_characters(pattern: str) -> str:
    """Letters and numbers of this machine's Unicode tables that the rank-based encoder's older tables lack.

    Only characters unknown to Python's own tables are tried: a small encoder, in which a letter or digit
    merges with a following byte, shows whether the pattern keeps the character with it.
    """
    import unicodedata

    import regex
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([lead, b]): 256 + 128 * k + b - 128 for k, lead in enumerate(b"a1") for b in range(128, 256)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    unknown = (c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    classes = ((regex.compile(r"\p{L}"), "a"), (regex.compile(r"\p{N}"), "1"))
    return "".join(c for c in unknown for kind, lead in classes if kind.match(c) and probe.encode_ordinary(lead + c)[0] < 256)


def _splitter(pattern: str, newer: str) -> Callable[[str], list[str]]:
    """``findall`` of the pre-token pattern, with shorter classes for texts of ASCII only."""
    import regex

    whole = pattern
    if newer:
        escaped = "".join(f"\\U{ord(c):08x}" for c in newer)
        # a negated class gains the newer characters, the others lose them
        whole = pattern.replace(r"[^\s\p{L}\p{N}]", "[OTHER]").replace(r"\p{L}", rf"[\p{{L}}--[{escaped}]]")
        whole = whole.replace(r"\p{N}", rf"[\p{{N}}--[{escaped}]]").replace("[OTHER]", rf"[[^\s\p{{L}}\p{{N}}]||[{escaped}]]")
    narrow = pattern
    for wide, ascii_class in (
        (r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]"), (r"\p{L}", "[A-Za-z]"), (r"\p{N}", "[0-9]"),
        (r"\S", r"[^\t-\r ]"), (r"\s", r"[\t-\r ]"),
    ):
        narrow = narrow.replace(wide, ascii_class)
    usual, exact, ascii_text = regex.compile(pattern).findall, regex.compile(whole, regex.V1).findall, re.compile(narrow).findall
    first, rare = min(newer, default=chr(sys.maxunicode)), set(newer)

    def split(text: str) -> list[str]:
        if text.isascii():
            return ascii_text(text)
        # the exact classes are slow, and needed only for texts with one of those characters
        return usual(text) if max(text) < first or rare.isdisjoint(text) else exact(text)

    return split


class ByteBpe:
    """Encoder and decoder of one task: serialised model, pre-token pattern, characters that are not yet letters."""

    def __init__(self, model: bytes, pattern: str, newer: str = ""):
        from sentencepiece import SentencePieceProcessor

        self._processor = SentencePieceProcessor(model_proto=model)
        self._split = _splitter(pattern, newer)
        table = byte_characters()
        self._map = dict(enumerate(table))
        inverse = {char: b for b, char in enumerate(table)}
        size = self._processor.get_piece_size() - 1
        self._bytes = [bytes([inverse[c] for c in self._processor.id_to_piece(i)]) for i in range(size)]
        self._whole = {token: np.int32(i).tobytes() for i, token in enumerate(self._bytes)}
        self._known: dict[str, bytes] = {}  # ids of a pre-token, 4 bytes each

    def _learn(self, new: set[str]) -> None:
        raw = {piece: piece.encode() for piece in new}
        merged = [piece for piece, token in raw.items() if token not in self._whole]
        self._known.update((p, self._whole[token]) for p, token in raw.items() if token in self._whole)
        mapped = [raw[piece].decode("latin-1").translate(self._map) for piece in merged]
        if mapped:
            encoded = self._processor.encode(mapped, num_threads=1)
            self._known.update((p, array("i", ids).tobytes()) for p, ids in zip(merged, encoded))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; texts are taken together up to ``_TOGETHER`` characters."""
        waiting, chars = [], 0
        for text in texts:
            waiting.append(text or "")
            chars += len(waiting[-1])
            if chars > _TOGETHER:
                yield from self._encode_now(waiting)
                waiting, chars = [], 0
        yield from self._encode_now(waiting)

    def _encode_now(self, texts: list[str]) -> Iterator[np.ndarray]:
        known = self._known
        pieces = [self._split(text) if text else [] for text in texts]
        new: set[str] = set()
        for own in pieces:
            new.update(set(own).difference(known))
        if len(known) + len(new) > _CACHE:
            known.clear()
            new = set().union(*pieces)
        self._learn(new)
        for own in pieces:
            yield np.frombuffer(b"".join(map(known.__getitem__, own)), np.int32)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_many([text]))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))


class Codec:
    """Columns that encode and decode with one vocabulary; the model travels to the tasks as a broadcast."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        shipped = spark.sparkContext.broadcast((sentencepiece_model(ranks), pattern, newer_characters(pattern)))

        @pandas_udf("array<int>")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = ByteBpe(*shipped.value)
            for texts in batches:
                yield pd.Series(list(codec.encode_many(texts)), index=texts.index, dtype=object)

        @pandas_udf("binary")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = ByteBpe(*shipped.value)
            for lists in batches:
                yield pd.Series([b"" if ids is None else codec.decode(np.asarray(ids)) for ids in lists], index=lists.index, dtype=object)

        @pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            codec = ByteBpe(*shipped.value)
            for texts in batches:
                rows = []
                for ids in codec.encode_many(texts):
                    packed = ids.astype("<u4").tobytes()
                    rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        self._encode, self._decode, self._digests = encode, decode, digests

    def encode(self, text: Column) -> Column:
        """array<int> of ids; an empty array for null."""
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        """Bytes the ids stand for."""
        return self._decode(ids)

    def round_trip(self, text: Column) -> Column:
        """Struct of id count, digest of the ids and digest of the decoded bytes, made where the ids are."""
        return self._digests(text)


def encode_documents(docs: DataFrame, codec: Codec, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, n_tokens)`` of every row."""
    out = docs.select(F.col(id_col), codec.encode(F.col(text_col)).alias("ids"))
    return out.select(id_col, "ids", F.size("ids").cast("bigint").alias("n_tokens"))


def decode_documents(encoded: DataFrame, codec: Codec, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)``; bytes that are not UTF-8 by themselves, as of cut id lists, become replacement characters."""
    return encoded.select(F.col(id_col), F.decode(codec.decode(F.col(ids_col)), "UTF-8").alias("text"))
