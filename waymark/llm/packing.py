"""Bounded-space online packing.

Each partition keeps a fixed number of open windows. A piece goes to the open window it fills best; when none has
room, the fullest is topped up with the head of the piece and emitted. What is open at a partition's end goes, with
its token ids, to fewer tasks in turn: each gets MERGED times the tokens that it can leave open, so every round leaves
a fraction of the one before. The last, a single bounded task, fills one window at a time, of which only the last is padded.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

#: Pieces: final ones have no ids; open ones carry them to the next round, and instead of a sequence's id a negative number of their own.
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


MERGED = 16


def _bytes_of_marks() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as its own character, and the others, in order, as those from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_bpe(tokenizer_path: str) -> Callable[[str], list[int]]:
    """The encoder of a byte-level BPE tokenizer in JSON form. Strings of its added tokens become their ids, as that tokenizer has it."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(tokenizer_path, encoding="utf-8") as f:
        told = json.load(f)
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    byte = _bytes_of_marks()
    ranks = {bytes(byte[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode(text, allowed_special="all") if any(s in text for s in special) else encoding.encode_ordinary(text)


class Packer:
    """Open windows of pieces (doc_id, start, ids, doc_tokens). Emits rows of NAMES."""

    def __init__(self, size: int, open_windows: int, first_id: int):
        self.size, self.most, self.next_id = size, open_windows, first_id
        self.carried = first_id
        self.windows: list[list] = []  # of [filled, pieces]
        self.out: list[tuple] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids) >= self.size:
            self.emit([self.size, [(doc_id, start, ids[: self.size], doc_tokens)]])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            best, best_filled, fullest = None, -1, None
            for w in self.windows:
                if w[0] + len(ids) <= self.size and w[0] > best_filled:
                    best, best_filled = w, w[0]
                if fullest is None or w[0] > fullest[0]:
                    fullest = w
            if best is None and len(self.windows) < self.most:
                best = [0, []]
                self.windows.append(best)
            head = len(ids) if best is not None else self.size - fullest[0]
            window = best if best is not None else fullest
            window[1].append((doc_id, start, ids[:head], doc_tokens))
            window[0] += head
            start, ids = start + head, ids[head:]
            if window[0] == self.size:
                self.windows.remove(window)
                self.emit(window)

    def emit(self, window: list, carry: bool = False) -> None:
        """carry: the pieces stay open and keep their ids."""
        at, sequence = 0, self.next_id
        self.next_id += not carry
        for doc_id, start, ids, doc_tokens in window[1]:
            raw = ids.tobytes()
            if carry:
                self.carried += 1
                sequence = -self.carried
            self.out.append((doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, sequence, None if carry else at, raw if carry else None))
            at += len(ids)

    def close(self, carry: bool) -> None:
        for w in self.windows:
            self.emit(w, carry)
        self.windows = []

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=NAMES)


def first_id(level: int) -> int:
    """Sequence ids of a task: the round, the partition and a running number share 63 bits."""
    return (level << 58) | (TaskContext.get().partitionId() << 34)


def pack(docs: DataFrame, tokenizer_path: str, size: int = 1024, open_windows: int = 16) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, a row for each piece.

    A document is its token ids and id 0; a null or empty text is id 0 alone; a text of any length is cut into as many
    pieces as it needs; of windows that fit equally well the oldest is taken; each id lies in one piece; equal rows are
    packed each; null ids are carried; an empty table gives an empty table; other columns are not read.
    """
    told = docs.select("doc_id", F.col("text").cast("string"))
    kind = told.schema["doc_id"].dataType.simpleString()

    def from_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, id_type = byte_bpe(tokenizer_path), Packer(size, open_windows, first_id(0)), pa.int64()
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = encode(text.as_py() or "")
                ids.append(0)
                packer.add(doc_id, 0, np.array(ids, dtype="<u4"), len(ids))
            if packer.out:
                yield _batch(packer.take(), id_type)
        packer.close(carry=True)
        if packer.out:
            yield _batch(packer.take(), id_type)

    def merging(level: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def from_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer, id_type = Packer(size, 1 if last else open_windows, first_id(level)), pa.int64()
            for b in batches:
                id_type = b.schema.field("doc_id").type
                for doc_id, start, ids, doc_tokens in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
                    packer.add(doc_id, start, np.frombuffer(ids, dtype="<u4"), doc_tokens)
                if packer.out:
                    yield _batch(packer.take(), id_type)
            packer.close(carry=not last)
            if packer.out:
                yield _batch(packer.take(), id_type)

        return from_pieces

    schema = f"doc_id {kind}, {PIECES}"
    packed = materialize(told.mapInArrow(from_text, schema), "packed")
    done, open_, level, leaves = packed.where("sequence_id >= 0"), packed.where("sequence_id < 0"), 0, open_windows * size
    while (n := open_.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) > 0:
        level += 1
        parts = -(-n // (MERGED * leaves))
        key = F.pmod(F.xxhash64("sequence_id"), F.lit(parts))
        packed = materialize(open_.repartition(parts, key).mapInArrow(merging(level, parts == 1), schema), "packed")
        done = done.unionByName(packed.where("sequence_id >= 0"))
        open_ = packed.where("sequence_id < 0")
    return done.drop("ids")
