"""Language-model scores by stupid backoff over bigrams, from counts dealt by n-gram.

Texts are put into blocks.  A block keeps its words as numbers of its own vocabulary and hands on each
different n-gram once, with its count in the block, to the part that the n-gram's hash names.  A part adds up
its n-grams over all blocks and returns the sums to the blocks, which score their documents.  A frequent
n-gram is one entry a block, so no part or block outgrows the others.

Every pair of the corpus is counted, unless ``least`` asks for more than one occurrence: the word of a pair
that occurs less often is scored by ``alpha`` times its share of all words.  With ``least`` = 1 the pairs are
those of the scored texts themselves, so none backs off, and nothing is joined or shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.llm.shingles import mix

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_U = np.uint64
#: Words of a block, about; a longer text is a block of its own.
BLOCK_WORDS = 1 << 20
#: Parts that the n-grams are dealt over.
PARTS = 1024
#: Blocks of one task are numbered below this.
_TASK_BLOCKS = 1 << 32
#: The hash of the n-gram that stands for every word: its count is that of all words.
_ALL = _U(0x5851F42D4C957F2D)
#: A row of a block's n-grams in one part, of their sums, or (part below 0) of a block's words.
_ROWS = "part long, block long, grams binary, counts binary, ids binary, sizes binary, words binary"


def words_of(text: Column) -> Column:
    """Runs of other characters than blank, tab, LF, VT, FF, CR, with A-Z lower-cased."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(folded, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _small(values: np.ndarray) -> bytes:
    """Numbers from 0, packed: 1, 2, 4 or 8 bytes a number, all first bytes before all second ones."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    head = np.array([len(values) * 16 + width], "<u8").tobytes()
    return head + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _large(raw: bytes) -> np.ndarray:
    n, width = divmod(int(np.frombuffer(raw, "<u8", count=1)[0]), 16)
    planes = np.frombuffer(pa.decompress(raw[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64)


def _dealt(marks: np.ndarray, words: np.ndarray, sizes: np.ndarray):
    """The pairs of a block and the part of each n-gram, by the marks of the vocabulary's words.

    n-grams are the pairs, then the vocabulary, then the one for all words.  Also: the n-grams in order of
    their part, the words that have one before them, the number of the pair of each, and how often pairs occur.
    """
    follows = np.ones(len(words), bool)
    follows[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(follows)
    pairs, pair, times = np.unique(words[at - 1] * len(marks) + words[at], return_inverse=True, return_counts=True)
    before, word = marks[pairs // len(marks)].astype(np.uint64), marks[pairs % len(marks)].astype(np.uint64)
    spread = np.concatenate([mix((before << _U(16)) + word), mix(marks.astype(np.uint64) + _ALL), [_ALL]])
    part = (spread % _U(PARTS)).astype(np.int16)
    return pairs, part, np.argsort(part, kind="stable"), at, pair, times


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 5
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _ROWS.split(", ")])


def _blocks(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of blocks of documents with words, from (doc_id, words).

        A frequent word has a small number.  A block keeps 16 bits of each word's hash, which tell the parts.
        n-grams are told apart by a hash of their whole words and by the part.
        """
        number = TaskContext.get().partitionId() * _TASK_BLOCKS
        held: list[tuple] = []

        def made() -> pa.RecordBatch:
            ids, sizes, words = (np.concatenate(c) for c in zip(*held))
            vocabulary, words, n_word = np.unique(words, return_inverse=True, return_counts=True)
            ranked = np.argsort(-n_word, kind="stable")
            place = np.empty(len(ranked), np.int64)
            place[ranked] = np.arange(len(ranked))
            vocabulary, n_word, words = vocabulary[ranked], n_word[ranked], place[words]
            marks = (mix(vocabulary ^ _U(0xA0761D6478BD642F)) >> _U(48)).astype(np.uint16)
            pairs, part, order, _, _, times = _dealt(marks, words, sizes)
            before, word = vocabulary[pairs // len(vocabulary)], vocabulary[pairs % len(vocabulary)]
            hashes = np.concatenate([mix(mix(before) * _U(0x9E3779B97F4A7C15) + word), mix(vocabulary + _U(0x8EBC6AF09C88C6E3)), [_ALL]])[order]
            counts, part = np.concatenate([times, n_word, [len(words)]])[order], part[order]
            rows = [(-1 - number, number, marks.tobytes(), None, ids.tobytes(), _small(sizes), _small(words))]
            begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for low, high in zip(begins, np.append(begins[1:], len(part))):
                rows.append((int(part[low]), number, hashes[low:high].tobytes(), _small(counts[low:high]), None, None, None))
            return _table(rows)

        waiting = 0
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            words = lists.flatten().to_numpy().view(np.uint64)
            ids = np.zeros(len(sizes), [("id", "<i8"), ("known", "?")])
            ids["known"] = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids["id"] = batch.column(0).fill_null(0).to_numpy()
            ids, sizes = ids[sizes > 0], sizes[sizes > 0]
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes):
                done = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + block_words - waiting, side="right")))
                held.append((ids[first:last], sizes[first:last], words[done:ends[last - 1]].copy()))
                waiting += int(ends[last - 1]) - done
                first = last
                if waiting >= block_words or first < len(sizes):
                    yield made()
                    number, held, waiting = number + 1, [], 0
        if held:
            yield made()

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The n-grams of a part with their sums over all blocks; a block's words as they are."""
    if table.column("part")[0].as_py() < 0:
        return table
    grams = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
    sizes = np.array([len(g) for g in grams])
    _, gram = np.unique(np.concatenate(grams), return_inverse=True)
    counts = np.concatenate([_large(c) for c in table.column("counts").to_pylist()])
    total = np.zeros(int(gram.max()) + 1, np.int64)
    np.add.at(total, gram, counts)
    total = np.split(total[gram], np.cumsum(sizes)[:-1])
    rows = zip(table.column("part").to_pylist(), table.column("block").to_pylist(), total)
    return pa.Table.from_batches([_table([(part, block, None, _small(n), None, None, None) for part, block, n in rows])])


def _scored(alpha: float, least: int):
    def run(table: pa.Table) -> pa.Table:
        """Every document of a block: words, words that back off, and the sum of the logs."""
        parts = table.column("part").to_numpy()
        own = int(np.flatnonzero(parts < 0)[0])
        marks = np.frombuffer(table.column("grams")[own].as_py(), np.uint16)
        ids = np.frombuffer(table.column("ids")[own].as_py(), [("id", "<i8"), ("known", "?")])
        sizes, words = (_large(table.column(c)[own].as_py()) for c in ("sizes", "words"))
        pairs, _, order, at, pair, _ = _dealt(marks, words, sizes)
        counts = table.column("counts")
        n = np.empty(len(order), np.int64)
        n[order] = np.concatenate([_large(counts[int(i)].as_py()) for i in np.argsort(parts, kind="stable") if i != own])
        n_pair, n_word, total = n[:len(pairs)], n[len(pairs):-1], n[-1]
        share = np.log(n_word / total)
        seen = n_pair >= least
        follow = np.where(seen, np.log(n_pair / n_word[pairs // len(marks)]), np.log(alpha) + share[pairs % len(marks)])
        # (the first word of a text has no context)
        value, back = share[words], np.zeros(len(words), np.int64)
        value[at], back[at] = follow[pair], ~seen[pair]
        begin = np.cumsum(sizes) - sizes
        columns = [
            pa.array(ids["id"], pa.int64(), mask=~ids["known"]), pa.array(sizes),
            pa.array(np.add.reduceat(back, begin)), pa.array(np.add.reduceat(value, begin)),
        ]
        return pa.table(columns, ["doc_id", "n_words", "n_backoff", "value"])

    return run


def backoff_scores(
    docs: DataFrame, alpha: float = 0.4, least: int = 1, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, n_words, n_backoff and score, the mean log of the words' scores, of every row.

    The first word of a text has no context and is scored by its share.  Null and empty texts have
    no words and a null score.  Rows that repeat an id are scored as one document; rows with a
    null id count towards the model and are one document without an id.  Other columns are not
    read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.transform(words_of(F.col(text_col)), lambda w: F.xxhash64(w)).alias("words"))
    dealt = rows.mapInArrow(_blocks(block_words), _ROWS)
    summed = dealt.groupBy("part").applyInArrow(_summed, _ROWS)
    scored = summed.groupBy("block").applyInArrow(_scored(alpha, least), "doc_id long, n_words long, n_backoff long, value double")
    whole = scored.groupBy("doc_id").agg(
        F.sum("n_words").alias("n_words"), F.sum("n_backoff").alias("n_backoff"), (F.sum("value") / F.sum("n_words")).alias("score")
    )
    ids = docs.select(F.col(id_col).cast("long").alias("id")).distinct()
    return ids.join(whole, ids["id"].eqNullSafe(whole["doc_id"]), "left").select(
        F.col("id").alias("doc_id"), F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("n_backoff", F.lit(0)).alias("n_backoff"), "score"
    )
