"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are the binary digits of
its length (whole sequences of ``max_len`` first, then falling powers of two).
A piece is a sequence of its own, and sequences of equal length form a bucket,
so no sequence crosses documents and none needs padding.

Ids are those of the ``tokenizers`` library without added special tokens: a string of
the file's own added tokens inside a text has that token's id.

Cases: a null or empty text is a document of the end id alone; repeated rows
are packed separately; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import map_batches, slices

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "bucket int, ids array<int>")
# Unicode white space, as the tokenizer's own pattern has it.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
# The split pattern of this tokenizer family (a fixed value).
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CACHE_ENTRIES = 400_000     # per Python worker; the cache starts anew beyond it
_BATCH_CHARS = 1 << 20


class _Chunks(dict):
    """Ids of each chunk, filled as chunks are first met."""

    def __init__(self, one):
        super().__init__()
        self.one = one

    def __missing__(self, chunk: str) -> bytes:
        ids = self.one(chunk)
        out = self[chunk] = pack_ids(f"<{len(ids)}I", *ids)
        return out


_coders: dict[str, _Chunks] = {}


def power_pieces(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the binary pieces of ``n`` ids, longest first."""
    out = [(s, max_len) for s in range(0, n - n % max_len, max_len)]
    start, size = n - n % max_len, max_len >> 1
    while size:
        if n & size:
            out.append((start, size))
            start += size
        size >>= 1
    return out


def _coder(path: str) -> _Chunks:
    """The encoder of a worker and its memory of recent chunks.

    The merges of a byte-level BPE file are ordered by id, so its vocabulary gives
    the same ids through the rank-based encoder, several times faster on words
    that are not yet known.
    """
    if path not in _coders:
        import tiktoken
        from tokenizers import Tokenizer
        vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        shown |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)}
        byte_of = {c: b for b, c in shown.items()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()
                 if all(c in byte_of for c in t)}
        coder = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks,
                                  special_tokens={})
        _coders[path] = _Chunks(coder.encode_ordinary)
    return _coders[path]


_added: dict[str, tuple[re.Pattern, dict[str, bytes]] | None] = {}


def _added_tokens(path: str) -> tuple[re.Pattern, dict[str, bytes]] | None:
    """A pattern of the file's added tokens (the longest first), and their ids."""
    if path not in _added:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tokens = {t.content: (i, t) for i, t in tok.get_added_tokens_decoder().items() if t.content}
        if odd := [c for c, (_, t) in tokens.items()
                   if t.lstrip or t.rstrip or t.single_word or t.normalized and tok.normalizer]:
            raise ValueError(f"added tokens that are not plain strings: {odd}")
        longest = sorted(tokens, key=len, reverse=True)
        _added[path] = (re.compile("|".join(map(re.escape, longest))),
                        {c: pack_ids("<I", i) for c, (i, _) in tokens.items()}) if tokens else None
    return _added[path]


def token_ids(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as the tokenizer gives them: the file's added tokens are cut out
    first, what is between them is encoded as texts of its own."""
    added = _added_tokens(path)
    if added is None:
        return encode(texts, path)
    pattern, ids = added
    between = [pattern.split(t) for t in texts]
    coded = iter(encode([part for parts in between for part in parts], path))
    out = []
    for text, parts in zip(texts, between):
        raw = [next(coded)]
        for token in pattern.findall(text) if len(parts) > 1 else ():
            raw += [ids[token], next(coded)]
        out.append(b"".join(raw))
    return out


def encode(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit bytes; added tokens have no
    meaning here and are encoded as any other characters.

    A byte-level tokenizer of this family never joins a character with white
    space that follows it, so a text is encoded as white space plus the
    characters up to the next white space, each distinct chunk once.
    """
    known = _coder(path)
    if len(known) > _CACHE_ENTRIES:
        known.clear()
    return [b"".join(map(known.__getitem__, _CHUNK.findall(t))) for t in texts]


def pack(docs: DataFrame, tokenizer: str, max_len: int = 1024, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text).

    ``max_len`` is a power of two. Columns: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` (unique), ``offset`` (always
    0), ``bucket`` (log2 of the length) and, if asked for, ``ids``. One pass over
    the input, no shuffle.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, texts = pdf["doc_id"].tolist(), [t or "" for t in pdf["text"]]
            for lo, hi in slices([len(t) for t in texts], _BATCH_CHARS):
                rows = []
                for doc, raw in zip(ids[lo:hi], token_ids(texts[lo:hi], tokenizer)):
                    raw += end
                    n = len(raw) // 4
                    for s, k in power_pieces(n, max_len):
                        part = raw[4 * s:4 * (s + k)]
                        rows.append((doc, s, k, zlib.crc32(part), n, k.bit_length() - 1,
                                     np.frombuffer(part, "<i4") if with_ids else None))
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32",
                                                  "doc_tokens", "bucket", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cut = (map_batches(rows, pieces, PIECE_SCHEMA)
           .withColumn("sequence_id", F.monotonically_increasing_id())
           .withColumn("offset", F.lit(0).cast("long")))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
            "bucket"]
    return cut.select(*cols, *(["ids"] if with_ids else []))
