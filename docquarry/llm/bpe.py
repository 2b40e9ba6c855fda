"""Byte-level BPE, encoding and decoding over Arrow batches.

The tokenizers library works on characters, so bytes are shown to it as
characters by a table of 256, and ranks become merges.  A batch is cut into
pieces by one vectorised pass over its code points, the library merges each
distinct piece once, and identifiers are laid out again with their offsets.
Tokens may begin or end inside a character; byte lengths tell where.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from docquarry.llm.common import in_arrow, table, text_of

#: The default rank file; every executor must find it under the same path.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes of text worked on at a time; a longer text is one piece of work.
CHUNK = 4 << 20
#: Distinct pieces handed to the library at a time.
PIECES = 20_000
LETTER, NUMBER, SPACE = 1, 2, 3


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the
    others for the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


@cache
def code_point_kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or 0 for every code point, as the library's own
    regular expressions have them."""
    kinds = np.zeros(0x110000, np.uint8)
    for kind, named in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        others = pre_tokenizers.Split(Regex(named), "removed")
        for first in [*range(0, 0xD800, 2048), *range(0xE000, 0x110000, 2048)]:
            inside = np.ones(2048, bool)
            for _, (a, b) in others.pre_tokenize_str("".join(map(chr, range(first, first + 2048)))):
                inside[a:b] = False
            kinds[first : first + 2048][inside] = kind
    return kinds


def piece_starts(codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the matches of ``public_tokenizers.PATTERN`` begin: a flag for each
    code point of texts laid end to end, which begin at ``firsts``.

    A piece is a run of letters, of digits, of white space or of others.  Before
    other text, white space gives up its last character: a blank joins what
    follows, any other stands alone.  An apostrophe that begins a piece takes
    the letters of a contraction with it."""
    n = len(codes)
    begins = np.zeros(n + 3, bool)
    begins[firsts] = True
    begins[n:] = True
    kinds = code_point_kinds()[codes]
    new = begins[:n].copy()
    new[1:] |= kinds[1:] != kinds[:-1]
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~begins[1:n])
    new[last] = True
    new[last[codes[last] == 0x20] + 1] = False
    marks = np.flatnonzero(new & (codes == ord("'")))
    ahead = np.concatenate([codes, np.zeros(2, codes.dtype)])
    one = np.where(begins[marks + 1], 0, ahead[marks + 1])
    two = np.where(begins[marks + 1] | begins[marks + 2], 0, ahead[marks + 2])
    width = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
    for a, b in ("re", "ve", "ll"):
        width[(one == ord(a)) & (two == ord(b))] = 3
    marks, width = marks[width > 0], width[width > 0]
    new[marks + 1] = False
    ends = marks + width
    new[ends[ends < n]] = True
    return new


def ragged(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``firsts[k] ... firsts[k] + counts[k] - 1`` for each k, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(firsts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Codec(NamedTuple):
    merge: Tokenizer
    lengths: np.ndarray  # bytes of each token
    firsts: np.ndarray  # where each token's bytes begin in ``flat``
    flat: np.ndarray


def split_orders(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where ``token`` can be cut into two tokens, the cut whose later part is the
    earliest to come about first."""
    cuts = [k for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
    return sorted(cuts, key=lambda k: (max(ranks[token[:k]], ranks[token[k:]]), k))


@cache
def codec(path: str) -> Codec:
    """The library's model for a rank file, and the table of token bytes.

    Merging by rank may join any two neighbours whose bytes are a token, so all
    cuts of a token are merges, in the order of the ranks; a piece that is a
    token itself is taken whole."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    shown = byte_characters()
    named = {token: "".join([shown[b] for b in token]) for token in ranks}
    ordered = sorted(ranks, key=ranks.get)
    merges = [(named[t[:k]], named[t[k:]]) for t in ordered for k in split_orders(t, ranks)]
    merge = Tokenizer(models.BPE(vocab={named[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    # decoding goes back from the library's own vocabulary by the reversed byte table
    bytes_of = {c: b for b, c in enumerate(shown)}
    back = {number: bytes([bytes_of[c] for c in name]) for name, number in merge.get_vocab().items()}
    tokens = [back.get(k, b"") for k in range(max(back) + 1)]
    lengths = np.array([len(t) for t in tokens], np.int64)
    return Codec(merge, lengths, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(tokens), np.uint8))


def merge_pieces(model: Codec, pieces: pa.Array, mark: str) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens each of ``pieces`` has, and their identifiers end to end.

    The library gets many pieces as one text, held apart by ``mark``, which is
    in none of them; byte lengths tell whose a token is."""
    apart = pre_tokenizers.Split(mark, "removed")
    model.merge.pre_tokenizer = pre_tokenizers.Sequence([apart, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    groups = pa.ListArray.from_arrays([*range(0, len(pieces), PIECES), len(pieces)], pieces)
    texts = pc.binary_join(groups, mark).to_pylist()
    ids = np.concatenate([np.array(model.merge.encode_batch_fast([t], add_special_tokens=False)[0].ids, np.int64) for t in texts])
    sizes = pc.binary_length(pieces).to_numpy()
    upto = np.searchsorted(np.cumsum(model.lengths[ids]), np.cumsum(sizes, dtype=np.int64), side="right")
    return np.diff(upto, prepend=0), ids


class Encoded(NamedTuple):
    counts: np.ndarray  # tokens of each text
    ids: np.ndarray
    starts: np.ndarray  # code points within the text
    ends: np.ndarray
    split: np.ndarray  # begins or ends inside a character


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str = RANKS) -> Encoded:
    """Encode texts that lie end to end as UTF-8 bytes in ``data``."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return Encoded(np.zeros(len(offsets) - 1, np.int64), none, none, none, none.astype(bool))
    model = codec(path)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    leads = (data & 0xC0) != 0x80
    character = np.cumsum(leads, dtype=np.int32) - 1
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    at = np.flatnonzero(leads)[piece_starts(codes, character[filled])]
    cut = np.append(at, len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(cut), pa.py_buffer(data)).dictionary_encode()
    used = set(np.unique(codes[codes >= 0xFDD0]).tolist())
    counts, flat = merge_pieces(model, pieces.dictionary, chr(next(c for c in range(0xFDD0, 0x110000) if c not in used)))
    which = pieces.indices.to_numpy()
    ids = flat[ragged((np.cumsum(counts) - counts)[which], counts[which])]
    end = np.cumsum(model.lengths[ids])
    start = end - model.lengths[ids]
    if end[-1] != len(data):
        raise ValueError(f"{len(data) - end[-1]} bytes have no token in {path}")
    edges = np.append(leads, True)
    upto = np.searchsorted(end, offsets[1:], side="right")
    per_text = np.diff(upto, prepend=0)
    base = np.repeat(character[np.minimum(offsets[:-1], len(data) - 1)], per_text)
    return Encoded(per_text, ids, character[start] - base, character[end - 1] + 1 - base, ~edges[start] | ~edges[end])


def decode_ids(ids: np.ndarray, counts: np.ndarray, path: str = RANKS) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of sequences of ``counts`` identifiers, end to end, and how many
    each has.  They need not be whole characters."""
    model = codec(path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(model.lengths) or not model.lengths[ids].all()):
        raise ValueError("an identifier is not in the vocabulary")
    data = model.flat[ragged(model.firsts[ids], model.lengths[ids])]
    sums = np.concatenate([[0], np.cumsum(model.lengths[ids])])
    upto = np.cumsum(counts)
    return data, sums[upto] - sums[upto - counts]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of an Arrow string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    found = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return found, at - at[0]


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``limit`` by ``sizes``; a larger row is its own."""
    first, held = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Per input row ``doc_id``, ``ids``, ``starts``, ``ends`` (code points of the
    text, end exclusive) and ``n_split`` (tokens that begin or end inside a character).

    A token inside a character has that character's span.  Null and empty texts
    have empty lists; repeated rows are encoded each; other columns are not
    read.  Texts are encoded whole; memory is some 60 bytes for each byte of the
    longest, or of CHUNK.  The text must be valid UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            sizes = np.diff(_texts(batch.column(1))[1])
            for part in _slices(batch, sizes, CHUNK):
                found = encode_texts(*_texts(part.column(1)), path)
                row = np.repeat(np.arange(part.num_rows), found.counts)
                split = np.bincount(row, found.split, part.num_rows).astype(np.int64)
                lists = [_lists(v, found.counts) for v in (found.ids, found.starts, found.ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, pa.array(split)], ["doc_id", "ids", "starts", "ends", "n_split"])

    schema = "doc_id long, ids array<int>, starts array<int>, ends array<int>, n_split long"
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).transform(in_arrow(run, schema))


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """Per row ``doc_id``, ``ids`` and ``decoded``, the bytes that ``ids`` stand for.

    Lists may be cut anywhere: characters that tokens share are whole again once
    their bytes are next to each other; see ``token_texts`` for text token by
    token.  Null and empty lists give no bytes; an identifier outside the
    vocabulary is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for part in _slices(batch, sizes, CHUNK):
                lists = part.column(1)
                counts = lists.value_lengths().to_numpy().astype(np.int64)
                data, lengths = decode_ids(lists.flatten().to_numpy().astype(np.int64), counts, path)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                decoded = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([part.column(0), lists, decoded], ["doc_id", "ids", "decoded"])

    ids = F.coalesce(F.col("ids").cast("array<int>"), F.array().cast("array<int>")).alias("ids")
    return encoded.select(F.col("doc_id").cast("long"), ids).transform(in_arrow(run, "doc_id long, ids array<int>, decoded binary"))


def token_texts(ids: list[int], path: str = RANKS) -> list[str]:
    """The text that each token adds: a character that several share comes with
    the last of them; bytes that are no character become U+FFFD."""
    import codecs

    model, reader = codec(path), codecs.getincrementaldecoder("utf-8")("replace")
    parts = [model.flat[model.firsts[i] : model.firsts[i] + model.lengths[i]].tobytes() for i in ids]
    return [reader.decode(part, final=k + 1 == len(parts)) for k, part in enumerate(parts)]


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``encode`` and ``decode`` of ``documents``, a row per row; null and empty texts
    have no tokens."""
    encoded = encode(table(spark, sf_dir, "documents")).select("doc_id", "ids")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
