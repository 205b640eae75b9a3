"""Token ids as length-delimited binary records with masked checksums, and an offset index beside each file."""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, ordered_parts, shared_dir, written
from .pretokens import BYTE_LEVEL, cutter, pieces

#: Fixed values of the record format: the checksum mask, the head (length, masked checksum of it) and the index entry.
MASK, HEAD, TAIL = 0xA282EAD8, struct.Struct("<QI"), struct.Struct("<I")
INDEX = np.dtype([("doc_id", "<i8"), ("null_id", "<u1"), ("offset", "<u8"), ("n_tokens", "<u8")])
#: Pieces and pre-tokens that a Python worker remembers, and characters from which one is too long for that.
REMEMBERED, LONG = 500_000, 64


def masked(data: bytes) -> int:
    """CRC-32 turned right by 15 bits plus a constant, so that checksums of checksums are no trap."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    length = len(data).to_bytes(8, "little")
    return length + TAIL.pack(masked(length)) + data + TAIL.pack(masked(data))


def unframed(read, offset: int) -> bytes:
    """The record at an offset of an open file; a wrong checksum is an error."""
    read.seek(offset)
    length, check = HEAD.unpack(read.read(HEAD.size))
    if masked(length.to_bytes(8, "little")) != check:
        raise ValueError(f"record at {offset}: the length is damaged")
    data = read.read(length)
    if len(data) != length or masked(data) != TAIL.unpack(read.read(4))[0]:
        raise ValueError(f"record at {offset}: the data is damaged")
    return data


token_id = attrgetter("id")


class Letters(dict):
    """A character as letters of the byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""

    ODD = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}

    def __missing__(self, char: str) -> str:
        letters = self[char] = char.encode().decode("latin-1").translate(self.ODD)
        return letters


class TextEncoder:
    """The tokenizers library's model, asked once for each new pre-token; pieces between lone spaces are remembered.

    Added tokens of the file that stand in a text have their own ids, as in the library's encode(): the text is split there.
    What was not used while the younger half filled up is forgotten, so common pieces stay however long a task runs.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        spec = json.loads(self.lib.to_str())
        cut, added = spec.get("pre_tokenizer") or {}, [t for t in spec.get("added_tokens") or [] if t["content"]]
        self.plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and self.lib.normalizer is None
        # the library matches tokens in two rounds, and some take blanks with them or want word borders: those files go by its encode()
        self.plain = self.plain and len({t["normalized"] for t in added}) < 2 and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip"))
        self.kind, self.code = ("<u2", "H") if self.lib.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.cut, self.model = cutter(BYTE_LEVEL), self.lib.model
        self.alphabet = Letters()
        self.added = {t["content"]: np.array([t["id"]], dtype=self.kind).tobytes() for t in added}
        # leftmost, then longest; the group keeps the tokens at odd places
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})").split
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalnum():
            letters = self.alphabet[word[0]] + word[1:]
        else:
            letters = "".join(map(self.alphabet.__getitem__, word))
        ids = array(self.code, map(token_id, self.model.tokenize(letters))).tobytes()
        if len(word) < LONG:
            self.words[word] = ids
        return ids

    def _learn(self, new: set[str]) -> None:
        """Adds the ids of pieces."""
        known, older, words, added, word_ids = self.known, self.older, self.words, self.added, self._word
        if len(words) > REMEMBERED:
            words.clear()
        for piece in new:
            if (ids := older.get(piece)) is not None:
                pass
            elif not self.plain:
                ids = np.array(self.lib.encode(piece, add_special_tokens=False).ids, dtype=self.kind).tobytes()
            elif piece in added:  # no other piece has one in it
                ids = added[piece]
            else:
                cut = self.cut(piece)
                ids = words.get(cut[0]) or word_ids(cut[0])
                for w in cut[1:]:
                    ids += words.get(w) or word_ids(w)
            known[piece] = ids

    def _cut(self, text: str) -> list[str]:
        if not self.plain:
            return [text]
        if not any(a in text for a in self.added):
            return pieces(text)
        return [p for i, part in enumerate(self.split(text)) for p in ([part] if i % 2 else pieces(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Each piece is looked up once; what is new is learned once for all texts; long pieces are forgotten."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        cut = [self._cut(t) for t in texts]
        flat, known = list(chain.from_iterable(cut)), self.known
        found = list(map(known.get, flat))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        new = [flat[i] for i in gaps]
        self._learn(set(new))
        for i, ids in zip(gaps, map(known.__getitem__, new), strict=True):
            found[i] = ids
        for p in new:
            if len(p) >= LONG:
                known.pop(p, None)
        out, at = [], 0
        for c in cut:
            out.append(b"".join(found[at : at + len(c)]))
            at += len(c)
        return out


@lru_cache(2)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def write_records(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' ids in ascending doc_id order; returns the manifest: part, file, kind, rows, tokens, start.

    A file holds one ascending range of ids, a record a document (its ids and end_id, 16 bits each if the vocabulary
    allows), and ``<file>.idx`` an entry a document: id, offset, tokens. Null text counts as empty (end_id alone); null
    ids sort first; repeated ids follow each other by text; an empty table gives an empty manifest. Each attempt of a
    task writes names of its own and only the manifest, written after all tasks succeeded, says which files count: lost
    executors leave no half file in it. ``start`` is the number of ids in all files before.
    """
    folder = folder or shared_dir(docs.sparkSession)
    lowest = -(2**63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cut, bounds = ordered_parts(rows.withColumn("_key", F.coalesce("doc_id", F.lit(lowest))), "_key")
    dealt = cut.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions("_key", "text").select("_part", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, at = fs.FileSystem.from_uri(folder)
        out, entries, part, offset, tokens, encoder = None, [], 0, 0, 0, text_encoder(tokenizer_path)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        width = np.dtype(encoder.kind).itemsize
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(at, recursive=True)
                part = column(batch, "_part")[0].as_py()
                name = f"{part:06d}-{uuid.uuid4().hex}.rec"
                out = store.open_output_stream(f"{at}/{name}")
            for doc_id, data in zip(column(batch, "doc_id").to_pylist(), encoder.encode(column(batch, "text").to_pylist()), strict=True):
                record = framed(data + end)
                out.write(record)
                n = len(data) // width + 1
                entries.append((doc_id or 0, doc_id is None, offset, n))
                offset += len(record)
                tokens += n
        if out is not None:
            out.close()
            with store.open_output_stream(f"{at}/{name}.idx") as index:
                index.write(np.array(entries, dtype=INDEX).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, f"{folder}/{name}", encoder.kind, len(entries), tokens)], names=["part", "file", "kind", "rows", "tokens"])

    files = written(map_batches(dealt, run, "part long, file string, kind string, rows long, tokens long"))
    # a row a file: a window over all of them is small
    from pyspark.sql.window import Window as W

    before = F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return files.withColumn("start", F.coalesce(before, F.lit(0)))


def read_records(manifest: DataFrame) -> DataFrame:
    """The files of a manifest: a row a document, doc_id, start, n_tokens and data (ids as little-endian 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, kind, start in zip(*(column(batch, c).to_pylist() for c in ("file", "kind", "start")), strict=True):
                store, at = fs.FileSystem.from_uri(file)
                with store.open_input_stream(f"{at}.idx") as f:
                    index = np.frombuffer(f.read(), dtype=INDEX)
                starts = start + np.cumsum(index["n_tokens"].astype(np.int64)) - index["n_tokens"].astype(np.int64)
                with store.open_input_file(at) as f:
                    for i in range(0, len(index), 256):
                        part = index[i : i + 256]
                        data = [np.frombuffer(unframed(f, int(o)), dtype=kind).astype("<u4").tobytes() for o in part["offset"]]
                        ids = pa.array(part["doc_id"], mask=part["null_id"].astype(bool))
                        cols = [ids, pa.array(starts[i : i + 256]), pa.array([len(d) // 4 for d in data], pa.int64()), pa.array(data, pa.binary())]
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "data"])

    # a task a file: the number of files is known, and few bytes name them
    return map_batches(manifest.repartition(max(1, manifest.count()), F.col("file")), run, "doc_id long, start long, n_tokens long, data binary")


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes the records, reads them back, and returns doc_id, start, n_tokens, ids_crc32 from the files."""
    return read_records(write_records(docs, tokenizer_path, end_id)).select("doc_id", "start", "n_tokens", F.crc32("data").alias("ids_crc32"))
