"""Vector bin packing of token pieces into fixed-length training sequences.

A piece has a size vector: tokens, one segment, loss-bearing tokens. A sequence has a
limit for each. The dot-product heuristic fills the open sequence with the piece, among those that fit,
whose vector has the largest product with what is left (both in shares of the limits); if none fits
the gap is closed with the head of the largest piece, whose rest goes on as
a piece of its own. Documents of a whole sequence or more give full sequences at once.

Each task packs the documents of its own input split in one pass, without a shuffle, from a pool of at most
``pool`` pieces shorter than a sequence. What is left of the last sequence is cut into
lengths that are powers of two, which need no padding. Sequence ids hold
the partition and a counter, so a repeated task gives the same ids.

Rows: a NULL or empty text is its end id alone; ids need not be unique; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.common import data_path

#: Text is handed to the tokenizer in stretches of about so many characters.
STRETCH = 1 << 20
_CUT = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_BLANK = re.compile(r"\s{5000}")
_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


class ByteBpe:
    """The public byte-level BPE; ids as the ``tokenizers`` file gives them without added special tokens.

    The same vocabulary's ranks are run by the faster library; a text with
    very long runs of white space, which that cannot split, goes to the other.
    """

    def __init__(self, json_name: str = "byte_bpe_50k.json", ranks_name: str = "byte_bpe_50k.tiktoken"):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(data_path(json_name))
        with open(data_path(ranks_name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items() if t.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encoded(self, text: str) -> np.ndarray:
        if _BLANK.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")

    def ids(self, text: str) -> np.ndarray:
        parts = [self.encoded(x) for x in stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def stretches(text: str) -> Iterator[str]:
    """The text in parts of about ``STRETCH`` characters, cut before a space between two letters."""
    at = 0
    while len(text) - at > STRETCH:
        m = _CUT.search(text, at + STRETCH)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


@functools.cache
def byte_bpe() -> ByteBpe:
    """One for each Python worker, for all its tasks."""
    return ByteBpe()


@dataclass
class Piece:
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int
    free: int
    """Leading tokens that bear no loss."""

    @property
    def loss(self) -> int:
        return max(0, len(self.ids) - self.free)

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        a = Piece(self.doc, self.start, self.ids[:n], self.doc_tokens, min(self.free, n))
        return a, Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens, max(0, self.free - n))


@dataclass
class Packer:
    """Packs a stream of documents; ``rows`` are finished pieces."""

    limits: Limits
    first_id: int
    pool: int = 512
    rows: list[tuple] = field(default_factory=list)
    held: list[Piece] = field(default_factory=list)
    count: int = 0

    def __post_init__(self) -> None:
        self.size = np.zeros((2 * self.pool + 2, 2), np.int64)
        self.caps = np.array([self.limits.tokens, self.limits.loss], np.float64)

    def emit(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            self.rows.append((p.doc, p.start, len(p.ids), crc, p.doc_tokens, self.first_id + self.count, at, p.loss))
            at += len(p.ids)
        self.count += 1

    def add(self, p: Piece) -> None:
        """Whole sequences leave at once, the rest is held."""
        whole = min(self.limits.tokens, self.limits.loss)
        while len(p.ids) >= whole:
            head, p = p.cut(self.limits.tokens if p.cut(min(len(p.ids), self.limits.tokens))[0].loss <= self.limits.loss else whole)
            self.emit([head])
            if not len(p.ids):
                return
        self.hold(p)
        if len(self.held) >= self.pool:
            while len(self.held) > self.pool // 2:
                self.fill()

    def hold(self, p: Piece) -> None:
        self.size[len(self.held)] = len(p.ids), p.loss
        self.held.append(p)

    def take(self, i: int) -> Piece:
        p, last = self.held[i], self.held.pop()
        if i < len(self.held):
            self.held[i] = last
            self.size[i] = self.size[len(self.held)]
        return p

    def gather(self) -> list[Piece]:
        """One sequence's pieces by the heuristic; it is short only if pieces or segments run out."""
        chosen: list[Piece] = []
        left = np.array([self.limits.tokens, self.limits.loss], np.int64)
        while self.held and left[0] > 0 and left[1] > 0 and len(chosen) < self.limits.segments:
            size = self.size[: len(self.held)]
            fits = (size <= left).all(axis=1)
            if fits.any():
                share = (self.limits.segments - len(chosen)) / self.limits.segments**2
                score = (size / self.caps) @ (left / self.caps) + share
                p = self.take(int(np.where(fits, score, -1.0).argmax()))
            else:
                whole = self.take(int(size[:, 0].argmax()))
                n = int(min(left[0], left[1] + whole.free))
                p, rest = whole.cut(min(n, len(whole.ids)))
                if len(rest.ids):
                    self.hold(rest)
            chosen.append(p)
            left -= (len(p.ids), p.loss)
        return chosen

    def fill(self) -> None:
        self.emit(self.gather())

    def finish(self) -> None:
        while self.held:
            chosen = self.gather()
            total = sum(len(p.ids) for p in chosen)
            if total == self.limits.tokens:
                self.emit(chosen)
                continue
            for bit in range(total.bit_length() - 1, -1, -1):
                room, out = total & (1 << bit), []
                while room:
                    p = chosen.pop(0)
                    if len(p.ids) > room:
                        p, rest = p.cut(room)
                        chosen.insert(0, rest)
                    out.append(p)
                    room -= len(p.ids)
                if out:
                    self.emit(out)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), end_id: int = 0, prompt_tokens: Column | None = None) -> DataFrame:
    """A row for each piece of each document. ``prompt_tokens``: a document's leading tokens without loss (none)."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe()
        packer = Packer(limits, TaskContext.get().partitionId() << 33)

        def out() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in packer.rows], pa.int64()) for k in range(len(names))]
            packer.rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc, text, free in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                ids = np.append(bpe.ids(text), np.uint32(end_id)) if text else np.array([end_id], np.uint32)
                packer.add(Piece(doc.as_py(), 0, ids, len(ids), free.as_py()))
                if len(packer.rows) > 20_000:
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    free = F.lit(0) if prompt_tokens is None else F.coalesce(prompt_tokens, F.lit(0))
    return docs.select("doc_id", "text", free.cast("long").alias("free")).mapInArrow(pack, _SCHEMA)
