"""Language by cross parsing: the language whose text explains a document in the fewest phrases.

For each language a suffix automaton is built over labelled text.  A document is parsed greedily
into phrases, each the longest match with any place of the language's text; the automaton tells
the length of the match by how far it can be followed from its root.  The language with the
fewest phrases per letter wins.

The automaton is laid out as a table, with the restart at the root already written into the
missing transitions, so that many documents advance together, one letter per step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallgrass.llm.bpe import text_slices

UNDETERMINED = "und"
#: Labelled documents and characters that a language's automaton is built over, at most.
TRAIN_DOCS, TRAIN_CHARS = 64, 32_768
#: Slices in which a long document's share of these characters is taken.
SLICES = 4
#: Letters that have a transition of their own; all others are one letter that no text has.
LETTERS = 125
#: Texts advance together while there are so many, the rest of longer ones is walked text by text.
FEW_TEXTS = 32
#: Characters of text parsed together.
BATCH_CHARS = 2_000_000
_SPACE, _OTHER = 0, 1


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for code in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in step[at]:
            step[at][code] = new
            at = link[at]
        if at >= 0:
            to = step[at][code]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                split = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = split
                while at >= 0 and step[at].get(code) == to:
                    step[at][code] = split
                    at = link[at]
        last = new
    return step


class CrossParser:
    """Phrases per letter of texts, for each language of ``samples`` (language -> text)."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        plain = {k: self._plain(t) for k, t in samples.items()}
        common = Counter("".join(plain.values()))
        common.pop(" ", None)
        letters = [c for c, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]
        self.width = len(letters) + 2
        code = {" ": _SPACE} | {c: i + 2 for i, c in enumerate(letters)}
        # code of each character of the first plane: its lower case, if that is one character
        self.code_of = np.full(0x10000, _SPACE, np.uint8)
        for i in range(0x10000):
            c = chr(i)
            if c.isalpha():
                self.code_of[i] = code.get(c.lower(), _OTHER)
        self.tables = [self._table(suffix_automaton([code.get(c, _OTHER) for c in plain[k]])) for k in self.languages]

    @staticmethod
    def _plain(text: str) -> str:
        return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())

    def _table(self, steps: list[dict[int, int]]) -> np.ndarray:
        """next state * 2 + (1 if a phrase begins), for each state and code.

        The last state stands for "no phrase is open": a text begins there, and a letter that the
        language lacks, a phrase by itself, leads there.
        """
        closed = len(steps)
        fresh = np.full(self.width, 2 * closed + 1, np.int32)
        for code, to in steps[0].items():
            fresh[code] = 2 * to + 1
        fresh[_OTHER] = 2 * closed + 1
        table = np.tile(fresh, (closed + 1, 1))
        at = np.repeat(np.arange(closed), [len(s) for s in steps])
        codes = np.array([c for s in steps for c in s], np.int64)
        table[at, codes] = 2 * np.array([t for s in steps for t in s.values()], np.int64)
        table[:, _OTHER] = 2 * closed + 1
        return table.reshape(-1)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts, a space between words, and where each text ends."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        codes = self.code_of[np.minimum(points, 0xFFFF)]
        for i in np.nonzero(points >= 0x10000)[0]:
            codes[i] = _OTHER if chr(points[i]).isalpha() else _SPACE
        ends = np.cumsum([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        # one space of each run of them
        keep = codes != _SPACE
        keep[1:] |= (codes[:-1] != _SPACE) & (owner[1:] == owner[:-1])
        return codes[keep], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by text and language, and letters by text."""
        codes, ends = self.codes(texts)
        begins = np.concatenate([[0], ends[:-1]])
        letters = np.add.reduceat(np.append(codes, 0) != _SPACE, np.minimum(begins, len(codes))) if len(codes) else np.zeros(len(texts), np.int64)
        letters = np.where(ends > begins, letters, 0)
        size = ends - begins
        order = np.argsort(-size, kind="stable")  # the longest first: short ones drop out at the end
        first, size = begins[order], size[order]
        # the texts advance together, letter by letter, until only few of them go on
        together = int(size[FEW_TEXTS - 1]) if len(size) >= FEW_TEXTS else 0
        live = np.searchsorted(-size, -np.arange(together), side="left")  # texts longer than the step
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        columns = [codes[first[:n] + j].astype(np.int32) for j, n in enumerate(live)]
        for k, table in enumerate(self.tables):
            state = np.full(len(first), len(table) // self.width - 1, np.int32)
            count = np.zeros(len(first), np.int64)
            for column in columns:
                n = len(column)
                to = table[state[:n] * self.width + column]
                count[:n] += to & 1
                state[:n] = to >> 1
            steps, width = memoryview(table), self.width
            for i in np.nonzero(size > together)[0].tolist():
                # the rest of a long text, from the state it has reached
                at, more = int(state[i]), 0
                for code in codes[first[i] + together:first[i] + size[i]].tolist():
                    to = steps[at * width + code]
                    more += to & 1
                    at = to >> 1
                count[i] += more
            out[order, k] = count
        return out, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and certainty: the share of the winner when a phrase more halves a language's weight."""
        count, letters = self.phrases(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        gap = count - count.min(axis=1, keepdims=True)
        score = 1 / np.exp2(-np.minimum(gap, 1000).astype(float)).sum(axis=1)
        best = count.argmin(axis=1)
        known = letters > 0
        return [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)], np.where(known, score, 0.0)


def labelled_sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, str]:
    """Text per language of at most TRAIN_DOCS documents, chosen by a hash of the id, and TRAIN_CHARS characters.

    Each chosen document has an equal share of the characters; from a longer text the share is
    taken in SLICES slices, spread evenly over it.  Rows without text or language are left out; an
    empty table gives no languages.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("order"),
    )
    # the first rows of each language are taken in every task before they are shuffled
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    chosen = rows.withColumn("place", place).where(F.col("place") <= TRAIN_DOCS)
    share = (F.lit(TRAIN_CHARS) / F.count(F.lit(1)).over(Window.partitionBy("lang"))).cast("int")
    chosen = chosen.withColumn("share", share).withColumn("slice", (F.col("share") / SLICES).cast("int"))
    starts = [(F.lit(1) + (F.length("text") - F.col("slice")) * i / (SLICES - 1)).cast("int") for i in range(SLICES)]
    spread = F.concat_ws(" ", *[F.substr("text", start, F.col("slice")) for start in starts])
    part = F.when(F.length("text") <= F.col("share"), F.col("text")).otherwise(spread)
    text: dict[str, str] = {}
    for row in chosen.select("lang", "place", part.alias("text")).orderBy("lang", "place").collect():
        text[row["lang"]] = (text[row["lang"]] + " " if row["lang"] in text else "") + row["text"]
    return text


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row, over its whole text.

    A text that is null, empty or without letters is ``und`` with score 0, and so is every text
    if there are no samples.  Equal phrase counts go to the language that comes first by name.
    Repeated rows and null ids stay; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_language(rows, samples, drop=["text"])


def with_language(
    docs: DataFrame, samples: dict[str, str], text_col: str = "text", names: Sequence[str] = ("lang_pred", "score"), drop: Sequence[str] = ()
) -> DataFrame:
    """Every row with its language and score in the columns ``names`` behind its other columns, without those in ``drop``."""
    kept = [f for f in docs.schema.fields if f.name not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = CrossParser(samples)
        for batch in batches:
            for first, texts in text_slices(batch, text_col, BATCH_CHARS):
                lang, score = parser.predict(texts)
                columns = [batch.column(f.name).slice(first, len(texts)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score)], [*(f.name for f in kept), *names])

    return docs.mapInArrow(run, StructType([*kept, StructField(names[0], StringType()), StructField(names[1], DoubleType())]))
