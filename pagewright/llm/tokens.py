"""Encoding with public byte-level BPE vocabularies (tiktoken, local rank files).

Texts travel as Arrow buffers; a worker loads a vocabulary once. Long texts are cut before
encoding at places where the vocabulary's pre-tokenizing pattern always ends a piece, so that the
ids of the parts are the ids of the whole; a part is longer than a segment only where a single piece is (a run of
letters without any sign or white space). Decoding concatenates
the raw bytes of the ids; a text cut inside a character stays decodable as bytes.

Defined results: null and empty texts give the empty list (size 0); blank texts have the ids of
their white space; bytes that aren't UTF-8 count as U+FFFD; strings that look like special tokens
are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

DEFAULT_DIR = "/opt/tokenizers"
#: Pre-tokenizing pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 20_000
SEGMENT = 50_000
_SPACE = r"[ \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_SPACE = re.compile(_SPACE + "{5000,}")
#: A piece always ends before white space, between letters and digits, before another sign, and behind one (but for
#: the apostrophe, which may begin a piece with the letters behind it). The separators 1C to 1F count as white
#: space in some libraries only and are no place to cut.
_SAFE = regex.compile(
    rf"(?<=[^\x1c-\x1f{_SPACE[1:-1]}])(?={_SPACE})|(?<=\p{{L}})(?=\p{{N}})|(?<=\p{{N}})(?=\p{{L}})|"
    rf"(?<=[\p{{L}}\p{{N}}])(?=[^\p{{L}}\p{{N}}\x1c-\x1f{_SPACE[1:-1]}])|(?<=[^'\p{{L}}\p{{N}}\x1c-\x1f{_SPACE[1:-1]}])(?=[\p{{L}}\p{{N}}])"
)
_LOADED: dict[str, object] = {}


def tokenizer_dir(spark: SparkSession, path: str | None = None) -> str:
    """`path`, else spark.pagewright.tokenizers, else the default folder."""
    return path or spark.conf.get("spark.pagewright.tokenizers", DEFAULT_DIR)


def load(rank_file: str):
    """The encoder of a local rank file, once per process."""
    if rank_file not in _LOADED:
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[rank_file] = tiktoken.Encoding(os.path.basename(rank_file), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[rank_file]


def segments(text: str, segment: int = SEGMENT) -> Iterator[tuple[str, bool]]:
    """(part, is_one_piece) of a long text, cut only where a piece ends.

    A long run of white space is one piece but for its last character, which may belong to the
    word behind it; it is yielded as such, because the pattern can't backtrack that far."""
    at = 0
    for m in [*_LONG_SPACE.finditer(text), None]:
        end = m.start() if m else len(text)
        while at < end:
            cut = end
            if end - at > segment:
                hit = _SAFE.search(text, at + segment, end)
                cut = hit.start() if hit else end
            yield text[at:cut], False
            at = cut
        if m:
            at = m.end() if m.end() == len(text) else m.end() - 1
            yield text[m.start() : at], True


def encode_ids(enc, text: str) -> np.ndarray:
    """The ids of `text` as int32."""
    if len(text) < LONG:
        return enc.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int32)
    parts = [
        np.array(enc._core_bpe.encode_single_piece(p.encode("utf-8")), dtype=np.int32)
        if whole
        else enc.encode_to_numpy(p, allowed_special=set(), disallowed_special=()).astype(np.int32)
        for p, whole in segments(text)
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The strings of an Arrow column; bytes that aren't UTF-8 become U+FFFD."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    for x in raw:
        v = x.as_buffer()
        yield None if v is None else v.to_pybytes().decode("utf-8", "replace")


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", path: str | None = None) -> DataFrame:
    """(id, ids): the ids of every row's text, without special tokens. A narrow map: no shuffle,
    one row out per row in, rows delivered again included."""
    rank_file = os.path.join(tokenizer_dir(df.sparkSession, path), f"{vocabulary}.tiktoken")
    src = df.select(df[id_col], df[text_col])
    kind = src.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(rank_file)
        for b in batches:
            ids = [encode_ids(enc, t) if t else np.empty(0, np.int32) for t in texts_of(b.column(1))]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, pa.array(values))], [id_col, "ids"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def token_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k", path: str | None = None) -> DataFrame:
    """(id, n_tokens int): as `encode_corpus`, but only the lengths leave the worker."""
    rank_file = os.path.join(tokenizer_dir(df.sparkSession, path), f"{vocabulary}.tiktoken")
    src = df.select(df[id_col], df[text_col])
    kind = src.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(rank_file)
        for b in batches:
            n = [len(encode_ids(enc, t)) if t else 0 for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], [id_col, "n_tokens"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, n_tokens int")


def decode_corpus(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = "byte_bpe_50k", path: str | None = None) -> DataFrame:
    """(id, bytes, text): raw bytes of the ids, and the text with U+FFFD for broken characters.
    Null ids give nulls."""
    rank_file = os.path.join(tokenizer_dir(df.sparkSession, path), f"{vocabulary}.tiktoken")
    src = df.select(df[id_col], df[ids_col])
    kind = src.schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(rank_file)
        for b in batches:
            raw = [None if x is None else enc.decode_bytes(x) for x in b.column(1).to_pylist()]
            text = [None if x is None else x.decode("utf-8", "replace") for x in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array(text, pa.string())], [id_col, "bytes", "text"])

    return src.mapInArrow(run, f"`{id_col}` {kind}, bytes binary, text string")
