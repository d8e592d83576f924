"""Phrase collocations: frequent phrases found with mergeable Misra-Gries summaries, then counted exactly.

First pass.  Texts are dealt to blocks of bounded size.  A block counts its phrases of one to
four words under a key (a hash) and cuts the keys into hash partitions; each cut is a summary
that has lost nothing yet.  All summaries of a hash partition are merged into one of
``mass // least + 1`` counters, mass being all occurrences in the partition.  A merge that leaves
more counters takes the greatest surplus count off all of them, so the summary falls short of
a true count by less than mass / counters < least: every phrase with ``least`` occurrences survives.

Second pass.  Each block gets back those of its own keys that survived, goes over its texts
again and counts the words themselves, so equal keys of different phrases do no harm.  These
counts are added up by phrase, again by hash partition, and what stays below ``least`` goes.

No task holds more than a block or a hash partition, nothing is broadcast, and a phrase that
makes up a third of all texts is one counter in a block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.plans.lineage import cut_lineage
from tallgrass.plans.ordering import rank_in_group

#: Bytes of text in a block; a single piece of text may pass it.
BLOCK_BYTES = 2 << 20
#: Bytes of text for each hash partition.
PARTITION_BYTES = 8 << 20
#: Bits of a key beyond those that number the occurrences.
SPARE_BITS = 6

#: Hash partitions that are added up together in the end.
JOINED = 4

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2

_PAYLOAD = -1
_SCHEMA = "block long, part int, lang string, data binary, counts binary"
_EMPTY = b""


def words_of(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word number at each place, and the number of the piece it lies in."""
    buffer = np.frombuffer(text.lower(), np.uint8)
    kind = _KIND[buffer]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    letters = np.ascontiguousarray(buffer[inside])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    pieces = np.cumsum(kind == 2, dtype=np.int32)[starts]
    return words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), pieces


def phrase_keys(words: pa.Array, at: np.ndarray, pieces: np.ndarray, lang: str, longest: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words: the places where such a phrase starts, and the phrases' keys."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    hashed = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)
    own = hashed[at] if len(at) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(at), np.uint64)
    for size in range(1, longest + 1):
        if len(at) < size:
            return
        last = len(at) - size + 1
        rolled = rolled[:last] * np.uint64(0x9E3779B97F4A7C15) + own[size - 1 :]
        places = np.flatnonzero(pieces[:last] == pieces[size - 1 :])
        mixed = rolled[places] + np.uint64(size)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        yield size, places, mixed >> np.uint64(64 - bits)


def _pack(keys: np.ndarray) -> bytes:
    """Ascending keys as gaps, byte planes one after the other, compressed."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _cuts(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in parts of about ``size`` bytes, cut where no phrase can cross."""
    while len(text) > size:
        cut = max(text.rfind(bytes([b]), 0, size) for b in _BREAKS)
        if cut <= 0:
            later = [p for p in (text.find(bytes([b]), size) for b in _BREAKS) if p > 0]
            if not later:
                break
            cut = min(later)
        yield text[:cut]
        text = text[cut + 1 :]
    yield text


def _bounds(parts: int, bits: int) -> np.ndarray:
    """The first key of each hash partition but the first."""
    return np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)


def _summaries(parts: int, bits: int, longest: int, block_bytes: int):
    """Map (lang, text) to the payloads and the summaries of blocks."""
    bounds = _bounds(parts, bits)

    def flush(block: int, texts: dict[str, list[bytes]]) -> pa.RecordBatch:
        rows: dict[str, list] = {"part": [], "lang": [], "data": [], "counts": []}
        keys = []
        for lang, found in texts.items():
            joined = b"\n".join(found)
            keys.extend(k for _, _, k in phrase_keys(*words_of(joined), lang, longest, bits))
            rows["part"].append(_PAYLOAD)
            rows["lang"].append(lang)
            rows["data"].append(zstandard.ZstdCompressor(level=3).compress(joined))
            rows["counts"].append(_EMPTY)
        distinct, counts = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
        edges = np.concatenate([[0], np.searchsorted(distinct, bounds), [len(distinct)]])
        for part in np.flatnonzero(np.diff(edges)):
            own = slice(edges[part], edges[part + 1])
            rows["part"].append(int(part))
            rows["lang"].append("")
            rows["data"].append(_pack(distinct[own]))
            rows["counts"].append(_pack_counts(counts[own]))
        n = len(rows["part"])
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array(rows["part"], pa.int32()), pa.array(rows["lang"], pa.string()),
             pa.array(rows["data"], pa.binary()), pa.array(rows["counts"], pa.binary())],
            names=["block", "part", "lang", "data", "counts"],
        )

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        texts: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                name = lang.as_py()
                for cut in _cuts(text.as_buffer().to_pybytes(), block_bytes):
                    texts.setdefault(name, []).append(cut)
                    size += len(cut)
                    if size >= block_bytes:
                        yield flush(block, texts)
                        block, texts, size = block + 1, {}, 0
        if texts:
            yield flush(block, texts)

    return summarise


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters that others are merged into.

    A counter is at most its key's true count, and falls short of it by at most ``missing``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.missing = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._length = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._length += len(keys)
        if self._length >= self.capacity:
            self.settle()

    def settle(self) -> None:
        """Add up what waits, then cut down to the capacity."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting, self._length = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = keys[starts], np.add.reduceat(counts, starts)
        if len(self.keys) > self.capacity:
            # the greatest count beyond the capacity is taken off every counter
            surplus = len(self.counts) - self.capacity - 1
            cut = np.partition(self.counts, surplus)[surplus]
            stay = self.counts > cut
            self.keys, self.counts, self.missing = self.keys[stay], self.counts[stay] - cut, self.missing + int(cut)

    def survivors(self, least: int) -> np.ndarray:
        """Every key that can have ``least`` occurrences."""
        self.settle()
        return self.keys[self.counts + self.missing >= least]


def _contained(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys occur among the ascending ones."""
    if not len(among):
        return np.zeros(len(keys), bool)
    return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys


def _survivors(least: int):
    """All summaries of one hash partition to the surviving keys of each block."""

    def merge(table: pa.Table) -> pa.Table:
        counts = table.column("counts").to_pylist()
        mass = sum(int(_unpack_counts(c).sum()) for c in counts)
        summary = Summary(mass // least + 1)
        for data, own in zip(table.column("data"), counts):
            summary.merge(_unpack(data.as_py()), _unpack_counts(own))
        kept = summary.survivors(least)
        blocks, found = [], []
        for block, data in zip(table.column("block"), table.column("data")):
            keys = _unpack(data.as_py())
            keys = keys[_contained(keys, kept)]
            if len(keys):
                blocks.append(block.as_py())
                found.append(_pack(keys))
        n = len(blocks)
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "part": pa.array([0] * n, pa.int32()), "lang": pa.array([""] * n, pa.string()),
            "data": pa.array(found, pa.binary()), "counts": pa.array([_EMPTY] * n, pa.binary()),
        })

    return merge


def _count_block(parts: int, bits: int, longest: int):
    """The texts of a block and its surviving keys to exact counts of the phrases with such keys.

    A row holds the phrases of one language in a few neighbouring hash partitions, one a line, and
    their counts: what survived is little, and longer rows compress better.
    """
    bounds = _bounds(parts, bits)[JOINED - 1 :: JOINED]
    parts = len(bounds) + 1

    def count(table: pa.Table) -> pa.Table:
        kinds = table.column("part").to_pylist()
        data = table.column("data")
        kept = [_unpack(data[i].as_py()) for i, p in enumerate(kinds) if p != _PAYLOAD]
        allowed = np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)
        rows: dict[str, list] = {"part": [], "lang": [], "data": [], "counts": []}

        def add(part: int, lang: str, phrases: list[bytes], counts: np.ndarray) -> None:
            rows["part"].append(part)
            rows["lang"].append(lang)
            rows["data"].append(zstandard.ZstdCompressor(level=3).compress(b"\n".join(phrases)))
            rows["counts"].append(_pack_counts(counts))

        for i, kind in enumerate(kinds):
            if kind != _PAYLOAD:
                continue
            lang = table.column("lang")[i].as_py()
            words, at, pieces = words_of(zstandard.ZstdDecompressor().decompress(data[i].as_py()))
            names = words.to_pylist()
            # the empty phrase stands for all words
            add(xxhash.xxh3_64_intdigest(lang.encode()) % parts, lang, [_EMPTY], np.array([len(at)]))
            spelled: list[bytes] = []
            numbers, where = [], []
            for size, places, keys in phrase_keys(words, at, pieces, lang, longest, bits):
                stay = _contained(keys, allowed)
                places, keys = places[stay], keys[stay]
                # a number per distinct phrase, one word at a time, so that words decide and not keys
                code = at[places]
                for step in range(1, size):
                    code = np.unique(code, return_inverse=True)[1] * len(names) + at[places + step]
                _, first, n = np.unique(code, return_index=True, return_counts=True)
                spelled.extend(b" ".join([names[w] for w in row]) for row in at[places[first][:, None] + np.arange(size)].tolist())
                numbers.append(n)
                where.append(np.searchsorted(bounds, keys[first], side="right"))
            if not spelled:
                continue
            n, part = np.concatenate(numbers), np.concatenate(where)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edges)):
                own = order[edges[p] : edges[p + 1]]
                add(int(p), lang, [spelled[j] for j in own.tolist()], n[own])
        return pa.table({
            "part": pa.array(rows["part"], pa.int32()), "lang": pa.array(rows["lang"], pa.string()),
            "data": pa.array(rows["data"], pa.binary()), "counts": pa.array(rows["counts"], pa.binary()),
        })

    return count


def _totals(least: int):
    """All counts of one hash partition, added up by phrase."""

    def add(table: pa.Table) -> pa.Table:
        lines = [zstandard.ZstdDecompressor().decompress(d).split(b"\n") for d in table.column("data").to_pylist()]
        counts = [_unpack_counts(c) for c in table.column("counts").to_pylist()]
        langs = table.column("lang").combine_chunks().take(pa.array(np.repeat(np.arange(len(lines)), [len(c) for c in counts])))
        found = pa.table({"lang": langs, "phrase": pa.array([x for line in lines for x in line], pa.binary()), "n": pa.array(np.concatenate(counts))})
        total = found.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        phrase, n = total.column("phrase").combine_chunks(), total.column("n_sum").combine_chunks()
        stay = pc.or_(pc.greater_equal(n, least), pc.equal(pc.binary_length(phrase), 0))
        return pa.table({
            "lang": total.column("lang").combine_chunks().filter(stay), "phrase": phrase.filter(stay).cast(pa.string()), "n": n.filter(stay).cast(pa.int64()),
        })

    return add


def frequent_phrases(
    docs: DataFrame, least: int = 30, longest: int = 4, block_bytes: int = BLOCK_BYTES, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """Exact counts (lang, words, phrase, n) of all phrases of 1 to ``longest`` words with n >= ``least``.

    One more row per language, with 0 words and an empty phrase, counts all its words.  Words are cut at
    spaces and tabs, phrases end at ``.,;:!?`` and line ends, A-Z count as a-z.  NULL text is
    empty, NULL language is ``und``.  Repeated rows count each time.  A text without words adds
    nothing; a language without words has only its row of 0.  No rows give no rows.
    """
    if least < 1 or longest < 1:
        raise ValueError("least and longest must be at least 1")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    volume = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(16, math.ceil(volume / partition_bytes))
    # an occurrence starts at a byte, so volume x longest bounds the mass
    bits = min(64, math.ceil(math.log2(volume * longest + 2)) + SPARE_BITS)
    blocks = cut_lineage(texts.mapInArrow(_summaries(parts, bits, longest, block_bytes), _SCHEMA))
    summaries = blocks.where(F.col("part") != _PAYLOAD)
    kept = summaries.groupBy("part").applyInArrow(_survivors(least), _SCHEMA)
    both = blocks.where(F.col("part") == _PAYLOAD).unionByName(kept)
    counted = both.groupBy("block").applyInArrow(_count_block(parts, bits, longest), "part int, lang string, data binary, counts binary")
    total = counted.groupBy("part").applyInArrow(_totals(least), "lang string, phrase string, n long")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return total.select("lang", words.alias("words"), "phrase", "n")


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def collocations(counts: DataFrame, scale: int = 2_000_000, cover: int = 80) -> DataFrame:
    """Scored phrases of two and more words: (lang, phrase, words, a, l, r, n, score).

    ``counts`` as ``frequent_phrases`` gives them, holding every part of every phrase.  Each cut of a phrase
    gives floor(scale * a / (l + r)) from its own count and those of its two parts; the lowest cut
    counts, the shortest first part among equal ones.  Phrases that lie inside a longer one with
    100 * its count >= ``cover`` * a go, whether or not that longer one stays.  Products are
    decimals of 38 digits.
    """
    words = F.split("phrase", " ")
    phrases = counts.where("words > 0")
    pool = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    def part(first: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, first, length), " ")

    cuts = pool.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    left = phrases.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r"))
    both = (
        cuts.withColumn("_first", part(F.lit(1), F.col("k"))).withColumn("_rest", part(F.col("k") + 1, F.col("words") - F.col("k")))
        .join(left, ["lang", "_first"]).join(right, ["lang", "_rest"])
    )
    # the integer division of decimals is exact
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {scale} div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))
    inner = (
        pool.where("words > 2")
        .select("lang", "words", "a", words.alias("_words"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("_length"))
        .select("lang", "words", "a", "_words", "_length", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("_length") + 1)).alias("_at"))
        .select("lang", F.array_join(F.slice("_words", F.col("_at"), F.col("_length")), " ").alias("phrase"), F.col("a").alias("_longer"))
        .groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    )
    covered = _wide(F.col("_longer")) * 100 >= _wide(F.col("a")) * cover
    totals = counts.where("words = 0").select("lang", F.col("n").alias("n"))
    return (
        lowest.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
        .join(totals, "lang")
        .select("lang", "phrase", "words", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))
    )


def top_collocations(docs: DataFrame, least: int = 30, longest: int = 4, first: int = 2000, **sizes: int) -> DataFrame:
    """The best phrases of each language by score, count, then bytes of the phrase, ranked from 1."""
    counts = cut_lineage(frequent_phrases(docs, least, longest, **sizes))
    # ranks from one order over all languages: none of them is put in order in a single task
    ranked = rank_in_group(collocations(counts), ["lang"], [F.desc("score"), F.desc("a"), "phrase"])
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
