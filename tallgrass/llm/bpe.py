"""Byte-pair encoding and decoding with segment trees over the ranks of adjacent pairs.

For each pre-token a tree holds, per position, the rank of the pair that begins there; an inner
node holds the least of its two children, with the position as second key.  So the root yields
the leftmost pair of lowest rank.  Merging it changes three leaves (the pair itself, the pair
before it, the position that vanishes), and each change climbs to the root in logarithmic time.
The trees of many pre-tokens are advanced together, one merge each per round, as NumPy rows;
pre-tokens of about the same length share a block.

Texts are cut at blanks first, because a pre-token never goes on beyond a blank that stands
alone: each distinct piece of a batch is encoded once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: How byte-level vocabularies of this kind cut a text into pre-tokens (fixed value).
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text that are encoded together.
BATCH_CHARS = 12_000_000
#: Tree nodes held at once.
NODES = 2_000_000
#: Blocks of fewer pre-tokens are walked one by one with plain integers, larger ones as NumPy rows.
FEW_ROWS = 48

_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabularies, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def string_buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each string begins (and the last ends) in the bytes of all."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    return ends, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)


def ragged(flat: np.ndarray, first: np.ndarray, count: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs ``flat[first:first + count]`` that ``index`` names, one after the other."""
    n = count[index]
    begin = np.cumsum(n) - n
    return flat[np.arange(n.sum()) + np.repeat(first[index] - begin, n)]


class BytePairCodec:
    """Encoder and decoder for one vocabulary (the JSON text of a byte-level BPE tokenizer)."""

    def __init__(self, vocabulary: str):
        import regex

        spec = json.loads(vocabulary)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * self.size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        of_byte = {b: ids[c] for c, b in letters.items() if c in ids}
        self.byte_ids = np.array([of_byte[b] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self._rank_of = dict(zip(self.keys[::-1].tolist(), self.ranks[::-1].tolist()))
        self.pretokens = regex.compile(PRETOKENS)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        # white space beside which the plain cut at blanks may not be right
        self.other_space = re.compile(r"[^\S \n]")
        self.lengths = np.array([len(b) for b in self.token_bytes])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or _NONE."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of each pre-token of a string array: all ids, and each word's first id and count."""
        ends, raw = string_buffers(words)
        lengths = np.diff(ends)
        first = np.zeros(len(words), np.int64)
        count = np.minimum(lengths, 1)
        flats = [np.zeros(0, np.uint32)]
        held = 0
        single = np.nonzero(lengths == 1)[0]
        if len(single):
            flats.append(self.byte_ids[raw[ends[single]]].astype(np.uint32))
            first[single] = np.arange(len(single))
            held = len(single)
        # a tree of 2 ** height leaves takes len - 1 pairs
        heights = np.ceil(np.log2(np.maximum(lengths - 1, 1))).astype(np.int64)
        heights[lengths < 2] = -1
        for height in np.unique(heights[heights >= 0]):
            members = np.nonzero(heights == height)[0]
            step = max(1, NODES >> (int(height) + 1))
            for i in range(0, len(members), step):
                part = members[i:i + step]
                work = self._block if len(part) >= FEW_ROWS else self._one_by_one
                flat, n = work(raw, ends[part], lengths[part], int(height))
                flats.append(flat)
                count[part] = n
                first[part] = held + np.cumsum(n) - n
                held += len(flat)
        return np.concatenate(flats), first, count

    def _block(self, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
        leaves, n, width = 1 << height, len(begins), int(lengths.max())
        place = np.arange(width)
        live = place[None, :] < lengths[:, None]
        ids = self.byte_ids[raw[np.minimum(begins[:, None] + place, len(raw) - 1)]]
        # neighbours of each position: width stands for the end, -1 for the start
        after = np.tile(place + 1, (n, 1))
        after[place[None, :] + 1 >= lengths[:, None]] = width
        before = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * leaves), _NONE)
        pairs = self.rank(ids[:, :-1], ids[:, 1:])
        pairs[~live[:, 1:]] = _NONE
        tree[:, leaves:leaves + width - 1] = np.where(pairs == _NONE, _NONE, pairs * leaves + place[:-1])
        level = leaves
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root != _NONE], root[root != _NONE]
            if not len(rows):
                break
            at, token = root % leaves, self.merged[root // leaves]
            gone = after[rows, at]
            follow, lead = after[rows, gone], before[rows, at]
            ids[rows, at] = token
            live[rows, gone] = False
            after[rows, at] = follow
            some = follow < width
            before[rows[some], follow[some]] = at[some]
            right = np.full(len(rows), _NONE)
            right[some] = self.rank(token[some], ids[rows[some], follow[some]])
            self._update(tree, rows, at, right, leaves)
            # the vanished position begins no pair (the last position never does)
            some = gone < leaves
            self._update(tree, rows[some], gone[some], np.full(int(some.sum()), _NONE), leaves)
            some = lead >= 0
            self._update(tree, rows[some], lead[some], self.rank(ids[rows[some], lead[some]], token[some]), leaves)
        return ids[live].astype(np.uint32), live.sum(axis=1)

    def _one_by_one(self, raw: np.ndarray, begins: np.ndarray, lengths: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``_block``, each pre-token by itself."""
        done = [self._single(self.byte_ids[raw[b:b + n]], 1 << height) for b, n in zip(begins.tolist(), lengths.tolist())]
        return np.concatenate(done), np.array([len(d) for d in done], np.int64)

    def _single(self, start: np.ndarray, leaves: int) -> np.ndarray:
        """Ids of one pre-token; the tree is a list, and a climb ends where nothing changes."""
        none, size, merged, rank = int(_NONE), self.size, self.merged, self._rank_of
        length = len(start)
        pairs = self.rank(start[:-1], start[1:])
        level = np.full(leaves, _NONE)
        level[:length - 1] = np.where(pairs == _NONE, _NONE, pairs * leaves + np.arange(length - 1))
        levels = [level]
        while len(level) > 1:
            level = np.minimum(level[::2], level[1::2])
            levels.append(level)
        tree = [none, *np.concatenate(levels[::-1]).tolist()]
        ids = start.tolist()
        after, before = list(range(1, length + 1)), list(range(-1, length - 1))

        def put(at: int, found: int | None) -> None:
            value = none if found is None else found * leaves + at
            node = at + leaves
            while tree[node] != value:
                tree[node] = value
                if node == 1:
                    return
                other = tree[node ^ 1]
                value = other if other < value else value
                node >>= 1

        while tree[1] != none:
            place, at = divmod(tree[1], leaves)
            ids[at] = token = int(merged[place])
            gone = after[at]
            follow = after[at] = after[gone]
            ids[gone] = -1
            if follow < length:
                before[follow] = at
                put(at, rank.get(token * size + ids[follow]))
            else:
                put(at, None)
            if gone < leaves:
                put(gone, None)
            lead = before[at]
            if lead >= 0:
                put(lead, rank.get(ids[lead] * size + token))
        left = np.array(ids, np.int64)
        return left[left >= 0].astype(np.uint32)

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, rank: np.ndarray, leaves: int) -> None:
        """Set leaves and climb to the root."""
        node = at + leaves
        tree[rows, node] = np.where(rank == _NONE, _NONE, rank * leaves + at)
        node >>= 1
        while len(node) and node[0]:
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node >>= 1

    def _cut_and_merge(self, text: str) -> np.ndarray:
        """Ids of a text: pre-tokens by pattern, each distinct one merged once."""
        words = pa.array(self.pretokens.findall(text), pa.string()).dictionary_encode()
        return ragged(*self.merge(words.dictionary), words.indices.to_numpy())

    def _pieces(self, pieces: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces that follow a blank (lead " ") or begin a text (lead line feed, whose id is left out).

        The pieces are put together, each after its lead, and encoded as one text: a pre-token
        begins at every lead.  A piece ends where as many bytes are used up.
        """
        ids = self._cut_and_merge(lead + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), lead)[0].as_py())
        used = np.cumsum(self.lengths[ids])
        ends = np.cumsum(np.diff(string_buffers(pieces)[0]) + 1)
        stop = np.searchsorted(used, ends) + 1
        begin = np.concatenate([[0], stop[:-1]])
        if lead != " ":
            begin = begin + 1
        return ids, begin, np.maximum(stop - begin, 0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as unsigned little-endian 32-bit integers."""
        plan: list[list[bytes | None]] = []
        even: list[str] = []
        for text in texts:
            steps: list[bytes | None] = []
            for k, part in enumerate(self.cut_special.split(text) if self.cut_special else [text]):
                if k % 2:
                    steps.append(self.special[part].to_bytes(4, "little"))
                elif part and self._is_uneven(part):
                    steps.append(self._cut_and_merge(part).tobytes())
                elif part:
                    steps.append(None)
                    even.append(part)
            plan.append(steps)
        done = iter(self._encode_even(even) if even else ())
        return [b"".join([next(done) if s is None else s for s in steps]) for steps in plan]

    def _encode_even(self, texts: list[str]) -> list[bytes]:
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        distinct = parts.values.dictionary_encode()
        flat, begin, count = self._pieces(distinct.dictionary, " ")
        index = distinct.indices.to_numpy().astype(np.int64)
        # the first piece of a text follows no blank
        heads = parts.values.take(pa.array(offsets[:-1])).dictionary_encode()
        head_flat, head_begin, head_count = self._pieces(heads.dictionary, "\n")
        index[offsets[:-1]] = heads.indices.to_numpy() + len(begin)
        begin, count = np.concatenate([begin, head_begin + len(flat)]), np.concatenate([count, head_count])
        ids = ragged(np.concatenate([flat, head_flat]), begin, count, index).astype("<u4").tobytes()
        ends = 4 * np.concatenate([[0], np.cumsum(count[index])])[offsets]
        return [ids[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _is_uneven(self, text: str) -> bool:
        """Has white space at an end or beside a blank, or other than blanks and line feeds."""
        return (
            text[0].isspace() or text[-1].isspace() or any(two in text for two in ("  ", " \n", "\n ")) or self.other_space.search(text) is not None
        )

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def text_slices(batch: pa.RecordBatch, column: str, chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of about ``chars`` characters, as first row and texts; null is the empty text."""
    texts, first, held = [], 0, 0
    for k, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        texts.append(text)
        held += len(text)
        if held >= chars:
            yield first, texts
            texts, first, held = [], k + 1, 0
    if texts:
        yield first, texts


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, token_ids (binary, unsigned little-endian 32-bit) and decoded text of every row.

    ``vocabulary`` is the JSON text of the tokenizer; it travels with the tasks.  Null and empty
    texts have no ids and decode to the empty text.  Repeated rows and null ids stay as they are;
    other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec(vocabulary)
        for batch in batches:
            for first, texts in text_slices(batch, "text"):
                ids = codec.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(i) for i in ids], pa.string()),
                    ],
                    ["doc_id", "token_ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, token_ids binary, decoded string")
