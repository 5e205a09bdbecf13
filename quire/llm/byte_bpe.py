"""Byte-level BPE encoding and decoding.

The rank file gives the vocabulary; a ``tokenizers`` BPE model is built from it
once per Python worker and run over Arrow batches.  Text is handled as bytes
written in the byte-to-character alphabet of byte-level models (each byte is
one printable character), so tokens may end inside a character.  ``encode``
returns packed ids and, on request, the character span of every token;
``decode`` reverses the byte table, so the bytes come back exactly, and decodes
token by token with an incremental decoder where text pieces are wanted: a
character split over tokens belongs to the token that completes it.

Empty and null texts give no tokens.  Repeated rows are encoded alike and all
kept; every input column stays, unless an output (behind ``prefix``) has the
same name, which replaces it.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.llm.common import bounded_batches, tidy

RANKS = "byte_bpe_50k.tiktoken"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 bytes stand
    for themselves, the others follow from code point 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str):
    """The ``tokenizers`` model of a rank file.

    A pair merges when its concatenation has a rank, lowest rank first: every
    split of a token into two tokens is therefore a merge, in rank order.  A
    whole match that is a token is taken as it is."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(path)
    letters = byte_alphabet()
    spell = {tok: "".join(letters[b] for b in tok) for tok in ranks}
    merges = [
        (spell[tok[:i]], spell[tok[i:]])
        for tok in sorted(ranks, key=ranks.get)
        for i in range(1, len(tok))
        if tok[:i] in ranks and tok[i:] in ranks
    ]
    model = models.BPE(
        vocab={spell[tok]: rank for tok, rank in ranks.items()}, merges=merges, ignore_merges=True
    )
    tok = Tokenizer(model)
    tok.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tok


@lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """Bytes of each id: the byte table read backwards (no model is loaded)."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def encode_texts(texts: list[str], path: str, pattern: str) -> tuple[list, list]:
    """Ids of each text and the (start, end) characters of each token: a token
    that starts or ends inside a character covers it."""
    found = tokenizer(path, pattern).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in found], [e.offsets for e in found]


# A space with white space on both sides: only there can a match of the pattern
# reach over the cut in front of a space.
_RUN = re.compile(r"\s (?:\s|\Z)")
# chunks a worker remembers, about 200 bytes each; forgotten together when full
# and at the end of a task
CACHED_CHUNKS = 800_000
MARKS = (",", ".")
_known: dict[tuple[str, str], dict[str, bytes]] = {}


def chunks(text: str) -> list[str]:
    """Cut before each space: matches of the pattern never hold a space after
    another character that is not white space, so the chunks encode alone."""
    if _RUN.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]]


def pack_texts(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """Packed ids of each text; the model runs on chunks the worker has not seen."""
    known = _known.setdefault((path, pattern), {})
    if len(known) > CACHED_CHUNKS:
        known.clear()
    parts = [chunks(t) for t in texts]
    found = [list(map(known.get, p)) for p in parts]
    new = {c for p, f in zip(parts, found) if None in f for c, x in zip(p, f) if x is None}
    if new:
        # a mark behind an ASCII letter is a match of its own: look the word up without it
        marked = {c for c in new if c[-1:] in MARKS and c[-2:-1].isascii() and c[-2:-1].isalpha()}
        new = list({*MARKS, *(new - marked), *(c[:-1] for c in marked)} - known.keys())
        for c, e in zip(new, tokenizer(path, pattern).encode_batch_fast(new, add_special_tokens=False)):
            known[c] = array("I", e.ids).tobytes()
        for c in marked:
            known[c] = known[c[:-1]] + known[c[-1]]
    return [
        b"".join([known[c] if x is None else x for c, x in zip(p, f)] if None in f else f)
        for p, f in zip(parts, found)
    ]


def decode_bytes(ids, path: str) -> bytes:
    return b"".join(map(byte_table(path).__getitem__, ids))


def decode_pieces(ids, path: str) -> list[str]:
    """The text each token adds; characters split over tokens come with the
    token that completes them, invalid bytes as U+FFFD."""
    table, decoder = byte_table(path), codecs.getincrementaldecoder("utf-8")("replace")
    pieces = [decoder.decode(table[i]) for i in ids]
    tail = decoder.decode(b"", True)
    if tail:
        pieces[-1] += tail
    return pieces


def _append(df: DataFrame, fields: list[T.StructField], run, done=lambda: None) -> DataFrame:
    """``df`` with columns that ``run`` computes from each Arrow batch; ``done``
    is called after the last one of a task."""
    bounded_batches(df.sparkSession)
    out = {f.name.lower() for f in fields}
    stay = [i for i, c in enumerate(df.columns) if c.lower() not in out]
    schema = T.StructType([*(df.schema.fields[i] for i in stay), *fields])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = run(b)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in stay), *columns], names=schema.names
            )
        done()

    return df.mapInArrow(tidy(over), schema)


def encode(
    df: DataFrame,
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    offsets: bool = False,
    prefix: str = "",
    decoded: bool = False,
) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit words), with
    ``offsets`` also ``spans`` (pairs of little-endian 32-bit character
    positions), with ``decoded`` also what ``decode`` makes of the ids, in the same
    pass; each name behind ``prefix``."""
    path = path or public_tokenizers.path(RANKS)
    fields = [
        T.StructField(prefix + "n_tokens", T.LongType()),
        T.StructField(prefix + "ids", T.BinaryType()),
    ] + [T.StructField(prefix + "spans", T.BinaryType())] * offsets
    fields += [T.StructField(prefix + "decoded", T.BinaryType())] * decoded

    def run(b: pa.RecordBatch):
        texts = [t or "" for t in b.column(b.schema.names.index(text)).to_pylist()]
        if offsets:
            ids, spans = encode_texts(texts, path, pattern)
            packed = [np.array(x, "<u4").tobytes() for x in ids]
        else:
            packed = pack_texts(texts, path, pattern)
        out = [pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary())]
        if offsets:
            out.append(pa.array([np.array(x, "<u4").tobytes() for x in spans], pa.binary()))
        if decoded:
            out.append(_decoded(packed, path))
        return out

    # the worker outlives the task: other stages need the memory of what it remembers
    return _append(df, fields, run, _known.clear)


def _decoded(packed: list[bytes | None], path: str) -> pa.Array:
    out = [decode_bytes(np.frombuffer(x or b"", "<u4").tolist(), path) for x in packed]
    return pa.array(out, pa.binary())


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, prefix: str = "") -> DataFrame:
    """Add ``decoded``: the bytes of packed ``ids`` (null: empty)."""
    path = path or public_tokenizers.path(RANKS)

    def run(b: pa.RecordBatch):
        return [_decoded(b.column(b.schema.names.index(ids)).to_pylist(), path)]

    return _append(df, [T.StructField(prefix + "decoded", T.BinaryType())], run)
