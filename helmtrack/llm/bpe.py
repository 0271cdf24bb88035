"""BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can never be merged across, so a text
may be cut between the two bytes and the fragments encoded one by one; the ids of the text are the ids
of its fragments in order. Cuts before a space are used; the distinct fragments of a block of texts are
encoded once and their ids gathered.

The pre-tokenizer must see the same pieces in a fragment as in the whole text. Its pattern looks ahead
only after white space and treats an apostrophe in a special way, so no cut is made after white space,
before an apostrophe that doesn't follow an ASCII letter or digit, or inside a character. Strings of
added tokens are taken out first, as the tokenizers library does.

Defined results: a null text counts as empty and has no ids; other columns are kept as they are, and a
column of the input whose name clashes with an output column is replaced.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Bytes of text that are encoded together.
BLOCK_BYTES = 4_000_000
#: Rows of an Arrow batch that are dealt with at a time.
SLICE_ROWS = 1000
#: Fixed value: the pattern by which byte-level pre-tokenizers split.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: bytes that print stand for
    themselves, the others follow from 256 on in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BoundaryBPE:
    """A byte-level BPE vocabulary with its certain cuts."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        added = self.tokenizer.get_added_tokens_decoder()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        inside = np.zeros(65536, bool)
        for token, i in vocabulary.items():
            if i in added:
                self.pieces[i] = token.encode()
                continue
            piece = bytes(alphabet[c] for c in token)
            self.pieces[i] = piece
            codes = np.frombuffer(piece, np.uint8).astype(np.uint16)
            inside[(codes[:-1] << 8) | codes[1:]] = True
        self.spaced = np.array([p[:1] == b" " for p in self.pieces])
        self.ids = self.fragment_encoder(vocabulary, added)
        self.added = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.special = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + b")") if self.added else None
        self.cuts = self.cut_table(inside)
        self.two_byte_lead = np.zeros(256, bool)
        self.two_byte_lead[0xC3:0xE0] = True

    def fragment_encoder(self, vocabulary: dict, added: dict):
        """Text -> ids for text without added tokens. Where ids follow the order of the merges, as usual for
        byte-level files, tiktoken gives the same ids in less time; else the tokenizers library is called."""
        model = json.loads(self.tokenizer.to_str())
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["model"]["merges"]]
        plain = model["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if plain and model["normalizer"] is None and merged == sorted(merged):
            ranks = {self.pieces[i]: i for i in vocabulary.values() if i not in added}
            return tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def cut_table(inside: np.ndarray) -> np.ndarray:
        """For each byte pair: 1 a certain cut; 2 one if the left byte ends a two-byte letter; else 0."""
        table = (~inside).astype(np.uint8).reshape(256, 256)
        table[:, 0x80:0xC0] = 0
        table[[*range(0x09, 0x0E), *range(0x1C, 0x21)], :] = 0
        word = np.zeros(256, bool)
        word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        table[~word, 0x27] = 0
        spaces = [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]  # last bytes of white space outside ASCII
        table[spaces, :] *= 2
        return table.ravel()

    def certain(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether there is a certain cut before each of the places ``at``."""
        kind = self.cuts[(codes[at - 1].astype(np.uint16) << 8) | codes[at]]
        return (kind == 1) | (kind == 2) & self.two_byte_lead[codes[at - 2]]

    def encode(self, text: bytes) -> bytes:
        """The ids of one text, as little-endian unsigned 32-bit integers."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. Texts are dealt with in blocks of bounded size."""
        out: list[bytes] = []
        block: list[bytes] = []
        size = 0
        for text in texts:
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                out += self.block(block)
                out.append(b"".join(self.added[p] if i % 2 else self.block([p])[0] for i, p in enumerate(parts)))
                block, size = [], 0
                continue
            block.append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                out += self.block(block)
                block, size = [], 0
        return out + self.block(block)

    def block(self, texts: list[bytes]) -> list[bytes]:
        data = b"".join(texts)
        codes = np.frombuffer(data, np.uint8)
        starts = np.cumsum([0, *map(len, texts)])
        if not len(codes):
            return [b""] * len(texts)
        mark = codes == 0x20
        mark[starts[starts < len(codes)]] = False
        at = np.flatnonzero(mark)
        mark[at] = self.certain(codes, at)
        mark[starts[starts < len(codes)]] = True
        bounds = np.flatnonzero(mark)
        offsets = np.append(bounds, len(codes))
        coded = pa.Array.from_buffers(pa.large_binary(), len(bounds), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = coded.indices.to_numpy()
        ids, first, count = self.distinct(coded.dictionary)
        each = count[which]
        ends = np.cumsum(each)
        places = np.arange(ends[-1]) + np.repeat(first[which] - (ends - each), each)
        taken = ids[places].tobytes()
        cut = np.append(0, ends)[np.searchsorted(offsets, starts)] * 4
        return [taken[i:j] for i, j in zip(cut.tolist(), cut[1:].tolist())]

    def distinct(self, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct fragments, and each one's first place and number. Fragments of a space and
        no other are encoded in one call where a certain cut follows each: the only token of such a
        fragment that starts with a space is its first, which tells them apart again."""
        offsets = np.frombuffer(fragments.buffers()[1], "<i8")[fragments.offset : fragments.offset + len(fragments) + 1]
        codes = np.frombuffer(fragments.buffers()[2], np.uint8)
        last, lengths = offsets[1:] - 1, np.diff(offsets)
        kind = self.cuts[(codes[last].astype(np.uint16) << 8) | 0x20]
        ends = (kind == 1) | (kind == 2) & self.two_byte_lead[codes[last - 1]] & (lengths > 1)
        spaces = np.add.reduceat(codes[offsets[0] : offsets[-1]] == 0x20, offsets[:-1] - offsets[0], dtype=np.int64)
        joint = ends & (spaces == 1) & (codes[offsets[:-1]] == 0x20) & (lengths > 1)
        first, count = np.zeros(len(fragments), np.int64), np.zeros(len(fragments), np.int64)
        parts: list[np.ndarray] = []
        done = 0
        if joint.any():
            text = codes[offsets[0] : offsets[-1]][np.repeat(joint, lengths)].tobytes().decode()
            ids = np.array(self.ids(text), "<u4")
            at = np.flatnonzero(self.spaced[ids])
            if len(at) == joint.sum():
                first[joint], count[joint] = at, np.diff(np.append(at, len(ids)))
                parts, done = [ids], len(ids)
            else:
                joint[:] = False
        for i in np.flatnonzero(~joint).tolist():
            ids = np.array(self.ids(codes[offsets[i] : offsets[i + 1]].tobytes().decode()), "<u4")
            first[i], count[i] = done, len(ids)
            parts.append(ids)
            done += len(ids)
        return np.concatenate(parts), first, count

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8; bytes that aren't UTF-8 become U+FFFD, as in the library."""
        out = b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def coder(path: str) -> BoundaryBPE:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return BoundaryBPE(path)


def _mapped(df: DataFrame, steps: list) -> DataFrame:
    """``df`` with binary columns added in one pass over slices of its rows. steps: (source, out, function
    of the list of source values); a source may be an earlier step's out."""
    outs = [out for _, out, _ in steps]
    keep = [c for c in df.columns if c not in outs]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{out}` binary" for out in outs])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = {}
                for source, out, function in steps:
                    found[out] = function(found[source] if source in found else part.column(source).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(found[c], pa.binary()) for c in outs], names=keep + outs)

    return df.mapInArrow(run, schema)


def _encoding(tokenizer: str):
    return lambda values: coder(tokenizer).encode_many([(v or "").encode() for v in values])


def _decoding(tokenizer: str):
    return lambda values: [coder(tokenizer).decode(v or b"") for v in values]


def bpe_encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids_le") -> DataFrame:
    """Adds ``out``: the ids of ``text`` as little-endian unsigned 32-bit integers in one binary value."""
    return _mapped(df, [(text, out, _encoding(tokenizer))])


def bpe_decode(df: DataFrame, tokenizer: str, ids: str = "ids_le", out: str = "decoded") -> DataFrame:
    """Adds ``out``: the text of ``ids`` in UTF-8, as a binary value."""
    return _mapped(df, [(ids, out, _decoding(tokenizer))])


def bpe_round_trip(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds ``ids_le`` and, decoded from it, ``decoded``, with one worker for both."""
    return _mapped(df, [(text, "ids_le", _encoding(tokenizer)), ("ids_le", "decoded", _decoding(tokenizer))])


def bpe_round_trip_digest(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: n_tokens, and digests of its ids and of the text decoded from them."""
    back = bpe_round_trip(documents.select("doc_id", "text"), tokenizer)
    return back.select(
        "doc_id",
        F.expr("CAST(octet_length(ids_le) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
