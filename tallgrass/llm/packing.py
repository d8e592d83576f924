"""Packing documents into sequences of a fixed number of tokens by minimum bin slack.

A document of at least one whole sequence is cut at its front into whole sequences; what remains
of each document waits in a pool.  A window is filled with the largest waiting remainder and the
multiset of other remainders whose lengths come closest to the room left.  Which sums can be
reached is a bitset that the multiset of lengths shifts and joins (counts in binary parts); the
counts are found by going back through the bitsets.  Room that no multiset fills is filled by
cutting a further remainder.  What is left when a partition ends is less than one sequence; it
is cut into sequences whose sizes are powers of two, which need no padding.

Every partition of the table is packed by itself, so no rows move.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.bpe import BytePairCodec, text_slices

#: Remainders that wait before windows are filled, and that are left for the next round.
POOL, REST = 512, 64
#: Characters of text that are encoded together: what a task holds besides its rows grows with them.
SLICE_CHARS = 4_000_000
#: Sequence numbers that one partition may use.
SEQUENCES = 1 << 32

SCHEMA = "doc_id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long"


def best_fill(lengths: Counter, room: int) -> Counter:
    """How many of each length to take so that their sum comes closest to ``room`` from below."""
    mask, reached = (1 << room + 1) - 1, 1
    parts: list[tuple[int, int, int]] = []
    for length in sorted((n for n in lengths if n <= room), reverse=True):
        count, take = min(lengths[length], room // length), 1
        while count > 0 and not reached >> room & 1:
            take = min(take, count)
            parts.append((length, take, reached))
            reached |= reached << take * length & mask
            count -= take
            take *= 2
        if reached >> room & 1:
            break
    at, chosen = reached.bit_length() - 1, Counter()
    for length, take, before in reversed(parts):
        if not before >> at & 1:
            chosen[length] += take
            at -= take * length
    return chosen


class Packer:
    """Fills sequences of ``size`` tokens; ``add`` and ``finish`` return pieces of whole sequences.

    A piece is (document, start, ids, tokens of the document, sequence, offset).
    """

    def __init__(self, size: int, first_sequence: int = 0):
        self.size, self.next = size, first_sequence
        self.waiting: dict[int, list[tuple]] = {}
        self.counts: Counter = Counter()
        self.tokens = 0

    def add(self, doc: object, ids: bytes) -> list[tuple]:
        total, out = len(ids) // 4, []
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            out.append((doc, start, ids[4 * start:4 * (start + self.size)], total, self.next, 0))
            self.next += 1
        if total > whole:
            self._wait((doc, whole, ids[4 * whole:], total))
            if self.counts.total() >= POOL:
                while self.counts.total() > REST and self.tokens >= self.size:
                    out += self._fill()
        return out

    def finish(self) -> list[tuple]:
        out = []
        while self.tokens >= self.size:
            out += self._fill()
        rest = [self._take(n) for n in sorted(self.counts.elements(), reverse=True)]
        left = sum(len(r[2]) // 4 for r in rest)
        while left:
            room = 1 << left.bit_length() - 1
            left -= room
            out += self._sequence(rest, room)
        return out

    def _wait(self, item: tuple) -> None:
        length = len(item[2]) // 4
        self.waiting.setdefault(length, []).append(item)
        self.counts[length] += 1
        self.tokens += length

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
        self.tokens -= length
        return self.waiting[length].pop()

    def _fill(self) -> list[tuple]:
        """One whole sequence."""
        items = [self._take(max(self.counts))]
        room = self.size - len(items[0][2]) // 4
        for length, count in best_fill(self.counts, room).items():
            items += [self._take(length) for _ in range(count)]
            room -= length * count
        if room:
            # every waiting remainder is longer than the room: the shortest one is cut
            items.append(self._take(min(self.counts)))
        out = self._sequence(items, self.size)
        for item in items:
            self._wait(item)
        return out

    def _sequence(self, items: list[tuple], room: int) -> list[tuple]:
        """Pieces from the front of ``items``, which keeps what did not fit."""
        out, offset = [], 0
        while offset < room:
            doc, start, ids, total = items.pop(0)
            fits = ids[:4 * (room - offset)]
            out.append((doc, start, fits, total, self.next, offset))
            if len(fits) < len(ids):
                items.insert(0, (doc, start + len(fits) // 4, ids[len(fits):], total))
            offset += len(fits) // 4
        self.next += 1
        return out


class PieceTokenizer(BytePairCodec):
    """The same ids, with the merges of new pieces done by a compiled tokenizer.

    A vocabulary whose token ids follow the order of its merges can be read as ranks.
    """

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        self.library = None
        if (np.diff(self.merged) > 0).all() and self.byte_ids.max() < self.merged.min(initial=self.size):
            import tiktoken

            special = set(self.special.values())
            ranks = {b: i for i, b in enumerate(self.token_bytes) if b and i not in special}
            self.library = tiktoken.Encoding("pieces", pat_str=self.pretokens.pattern, mergeable_ranks=ranks, special_tokens={})

    def _cut_and_merge(self, text: str) -> np.ndarray:
        if self.library is None:
            return super()._cut_and_merge(text)
        return np.frombuffer(self.library.encode_to_numpy(text, disallowed_special=()), np.uint32)


def pack_documents(
    docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all rows of ``docs``, each with its place in a sequence of at most ``size`` tokens.

    A document is its ids followed by ``end_id``; a null or empty text is that id alone.  Columns:
    doc_id, start (ids of the document before the piece), length, token_ids (unsigned
    little-endian 32-bit), doc_tokens, sequence_id, offset.  Rows that repeat an id are packed one
    by one; other columns are not read; an empty table gives no pieces.  Sequences are full, but
    for at most log2(size) per partition, whose sizes are powers of two.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    tail = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = PieceTokenizer(vocabulary)
        packer = Packer(size, TaskContext.get().partitionId() * SEQUENCES)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, sequence, offset = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()),
                ],
                ["doc_id", "start", "length", "token_ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            for first, texts in text_slices(batch, "text", SLICE_CHARS):
                keys = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                pieces = [p for doc, ids in zip(keys, tokenizer.encode(texts)) for p in packer.add(doc, ids + tail)]
                if pieces:
                    yield rows(pieces)
        if pieces := packer.finish():
            yield rows(pieces)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
