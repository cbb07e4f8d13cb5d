"""Packing of token sequences: vector bin packing under limits on tokens, segments and loss-bearing tokens.

A task tokenizes its documents as they come. Whole sequences are cut off at once; what remains of each
document goes to a bounded pool. From the pool the open sequence gets, by the dot-product heuristic, the
example whose demand vector (tokens, segments, loss-bearing tokens, each as a share of its limit) points
best along what the sequence still has room for. Where nothing fits whole and cutting is allowed, the
longest example is cut to fill the sequence. A sequence that can't be filled (the last of a task, or one
that reached the limit of segments) is cut into sequences whose lengths are powers of two, which need no
padding. So a task holds POOL remainders at most and there is no shuffle at all.

Sequence ids are the number of the partition and a counter; a task that runs again gets the same rows and
gives the same ids.

Parts of words are tokenized once and kept in a bounded cache: white space always parts tokens of this
vocabulary, and is dropped, so a text's ids are those of its parts in turn. New parts are merged many at a
time (bpe).

Defined results: a null or empty text is the end id alone; a very long text is tokenized whole and cut; of examples
that fit equally well the first that came is taken; rows with the same doc_id are packed each on
its own; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from weftlink.llm import bpe, common

#: Limits of a sequence, remainders that a task holds, parts of words that a worker keeps, longest of them.
TOKENS, SEGMENTS, LOSS, POOL, CACHE, LONGEST = 4096, 512, 4096, 1024, 600_000, 48
#: Parts that stay when there are too many or a task ends: those that came first, which as a rule are the frequent ones.
STAY = 300_000
#: Characters of the texts whose new parts are tokenized together.
GROUP = 1 << 19
VOCABULARY, END = "word_bpe_49k.json", 2


class Words:
    """ids of texts, by way of a bounded cache of the parts of words."""

    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.kept: dict[str, bytes] = {}
        try:
            self.merges = bpe.Merges(self.tokenizer.to_str())
            known = [w for w in sorted(self.tokenizer.get_vocab())[::97] if w]
            if [x.tobytes() for x in self.several(known)] != self._encode(known):
                self.merges = None
        except (KeyError, ValueError):
            self.merges = None  # a vocabulary of another make

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of(self, parts: set[str]) -> dict[str, bytes]:
        """ids of parts; words that the merges can't serve, and very long ones, go to the library."""
        own = [p for p in parts if p[0] != "\0" and len(p) <= 4 * LONGEST]
        rest = list(parts.difference(own))
        return self.merges.encode(own) | dict(zip(rest, self._encode([p.removeprefix("\0") for p in rest]), strict=True))

    def several(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """ids of each text. New parts of a group of texts are met together; no more texts than a group are held."""
        if not self.merges:
            for some in itertools.batched(texts, 64):
                yield from (np.frombuffer(b, "<u4") for b in self._encode(list(some)))
            return
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > GROUP:
                yield from self._met(group)
                group, size = [], 0
            group.append(bpe.parted(text))
            size += len(text)
        yield from self._met(group)

    def shrink(self) -> None:
        self.kept = dict(itertools.islice(self.kept.items(), STAY))

    def _met(self, group: list[list[str]]) -> Iterator[np.ndarray]:
        new = set().union(*group).difference(self.kept)
        if len(self.kept) + len(new) > CACHE:
            self.shrink()
            new = set().union(*group).difference(self.kept)
        self.kept.update(self._of(new))
        get = self.kept.__getitem__
        for parts in group:
            yield np.frombuffer(b"".join(map(get, parts)), "<u4")
        for p in [p for p in new if len(p) > LONGEST]:
            del self.kept[p]


@functools.cache
def _words(vocabulary: str) -> Words:
    return Words(vocabulary)


@dataclass
class Example:
    """Part of a document: its ids from `start` on; ids from place `loss_from` of the document bear loss."""

    doc_id: int | None
    ids: np.ndarray
    total: int
    start: int = 0
    loss_from: int = 0

    def cut(self, n: int) -> tuple[Example, Example]:
        return (
            Example(self.doc_id, self.ids[:n], self.total, self.start, self.loss_from),
            Example(self.doc_id, self.ids[n:], self.total, self.start + n, self.loss_from),
        )

    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.loss_from))

    def room(self, loss: int) -> int:
        """The most ids from its start that bear up to so much loss."""
        return max(0, self.loss_from - self.start) + loss


@dataclass
class Packer:
    """Sequences from a stream of examples. out: rows of the pieces."""

    limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS)
    cut: bool = True
    pool: int = POOL
    first: int = 0
    waiting: list[Example] = field(default_factory=list)
    out: list[tuple] = field(default_factory=list)

    def add(self, x: Example) -> None:
        whole = self.limits[0]
        while self.cut and len(x.ids) >= whole and x.room(self.limits[2]) >= whole:
            piece, x = x.cut(whole)
            self._write([piece])
        if len(x.ids):
            x.ids = x.ids.copy()  # the rest of a long document needn't stay
            self.waiting.append(x)
        if len(self.waiting) >= self.pool:
            self.flush(self.pool // 2)

    def flush(self, leave: int = 0) -> None:
        """Packs until `leave` examples wait."""
        top = np.array(self.limits, float)
        demand = np.array([(len(x.ids), 1, x.loss()) for x in self.waiting], float).reshape(-1, 3)
        here = np.ones(len(self.waiting), bool)
        while here.sum() > leave:
            room, chosen = top.copy(), []
            while True:
                fits = here & (demand <= room).all(axis=1)
                if fits.any():
                    i = int(np.argmax(np.where(fits, (demand / top) @ (room / top), -1)))
                    chosen.append(self.waiting[i])
                    room -= demand[i]
                    here[i] = False
                    continue
                if chosen and (not self.cut or room[0] < 1 or room[1] < 1) or not here.any():
                    break
                i = int(np.argmax(np.where(here, demand[:, 0], -1)))
                n = len(self.waiting[i].ids) if not self.cut else int(min(room[0], self.waiting[i].room(int(room[2]))))
                if n < 1:
                    break
                if n >= len(self.waiting[i].ids):  # longer than a sequence, and may not be cut
                    chosen.append(self.waiting[i])
                    here[i] = False
                    break
                piece, self.waiting[i] = self.waiting[i].cut(n)
                demand[i] = (len(self.waiting[i].ids), 1, self.waiting[i].loss())
                chosen.append(piece)
                room -= (n, 1, piece.loss())
                if room[0] < 1:
                    break
            self._write(chosen)
        self.waiting = [x for x, h in zip(self.waiting, here, strict=True) if h]

    def _write(self, pieces: list[Example]) -> None:
        """One sequence if it is full or may not be cut; else one for each power of two."""
        n = sum(len(x.ids) for x in pieces)
        sizes = [n] if not self.cut or n >= self.limits[0] else [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
        queue = pieces[::-1]
        for size in sizes:
            at = 0
            while at < size:
                x = queue.pop()
                if len(x.ids) > size - at:
                    x, rest = x.cut(size - at)
                    queue.append(rest)
                crc = zlib.crc32(x.ids.astype("<u4").tobytes())
                self.out.append((x.doc_id, x.start, len(x.ids), crc, x.total, self.first, at))
                at += len(x.ids)
            self.first += 1


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, LOSS), pool: int = POOL) -> DataFrame:
    """A row for each piece of each document of docs (doc_id, text)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = _words(vocabulary), Packer(limits, pool=pool, first=TaskContext.get().partitionId() << 33)

        def ready() -> pa.RecordBatch:
            rows, packer.out = packer.out, []
            made = zip(*rows, strict=True) if rows else [()] * len(COLUMNS)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in made], names=COLUMNS)

        for batch in batches:
            # texts leave the batch a few at a time, so that a worker never holds them twice
            parts = (batch.column("text").slice(at, 64).to_pylist() for at in range(0, batch.num_rows, 64))
            texts = (t or "" for part in parts for t in part)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.several(texts), strict=True):
                ids = np.append(ids, np.uint32(END))
                packer.add(Example(None if doc_id is None else int(doc_id), ids, len(ids)))
                if len(packer.out) >= 8192:
                    yield ready()
        packer.flush()
        yield ready()
        words.shrink()  # the worker waits for other tasks, of this stage or another
        common.trim()

    return docs.select("doc_id", "text").mapInArrow(pack, ", ".join(f"{c} long" for c in COLUMNS))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(common.documents(spark, sf_dir))


QUERIES = {"op10_packing": op10_packing}
SQL: dict = {}
