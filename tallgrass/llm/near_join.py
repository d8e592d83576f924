"""Exact Jaccard similarity join on word shingles with PartEnum signatures, and its components.

Sets are put into bands of similar size.  Within a band two sets of the wanted similarity differ
in at most k elements.  The feature domain is cut by a hash into n1 first-level partitions, each
into n2 second-level ones.  With n1 * (k2 + 1) > k some first-level partition holds at most k2 of
the differences, so n2 - k2 of its second-level partitions agree in full.  One signature is made
for each first-level partition and each subset of n2 - k2 of its second-level partitions; sets
that are similar enough share one.

Equal sets are one node.  A set with a link shares most of its elements with another one, so a
set is left out first if too many of a fixed sample of its elements are in no other set.  Sets that share a signature are first compared with the smallest id
under that signature; what the links found so far hold together needs no further comparison.
Only where a signature still has sets of different components are those compared with each
other, block by block inside tasks.  Every comparison is exact in the end: a parity sketch first
rules out pairs that must differ in too many elements, then the sets are intersected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.bpe import text_slices
from tallgrass.llm.shingles import Shingler, mix, runs_of, sum_runs
from tallgrass.plans.lineage import cut_lineage

_U = np.uint64
BATCH_CHARS = 1_500_000
#: Ratio of the largest to the smallest size in a band, as a power of 1 / similarity.
BAND_POWER = 2
#: Sets of one signature that are compared with each other in one step.
BLOCK = 128
#: A signature with so many sets in one run of documents is dealt over PARTS more parts.
MANY_SETS, PARTS = 8, 64
#: Words of sketches that are compared at once.
COMPARED_WORDS = 1 << 21
#: Ids that may be broadcast to pick the documents whose sets are compared (a long each).
BROADCAST_IDS = 2_000_000
#: Part of all elements that is sampled, as a multiple of the part in which a set may differ from
#: a similar one: with 1.5, a set is left out if more than about two thirds of its elements are its own.
SAMPLED = 1.5
#: Edges whose components one task works out before tasks are joined.
TASK_EDGES = 500_000


class PartEnum:
    """Signatures for the similarity num / den."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.num, self.den = num, den
        self.k2 = 1
        # lower similarities leave fewer elements in a partition: more are joined in a signature
        self.n2 = 2 if num * 10 >= den * 9 else 3
        self.bounds = [1]  # first size of each band

    def _band(self, sizes: np.ndarray) -> np.ndarray:
        while self.bounds[-1] <= sizes.max(initial=1):
            low = self.bounds[-1]
            self.bounds.append(max(low, int(low * (self.den / self.num) ** BAND_POWER), low * self.den // self.num) + 1)
        return np.searchsorted(np.array(self.bounds), sizes, side="right") - 1

    def differences(self, band: int) -> int:
        """Most elements in which two similar sets differ of which the larger is in ``band``."""
        self._band(np.array([self.bounds[-1]]) if band + 1 >= len(self.bounds) else np.array([1]))
        largest = self.bounds[band + 1] - 1
        return 2 * largest * (self.den - self.num) // (self.den + self.num)

    def signatures(self, sets: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of all sets, and which set each belongs to."""
        sizes, owners, out = count, [], []
        band = self._band(np.append(sizes, sizes.max(initial=1) * self.den // self.num + 1))[:-1]
        following = np.array(self.bounds + [np.iinfo(np.int64).max])[band + 1]
        begin = runs_of(count)
        for up in (0, 1):
            # a set is in the instance of its own band, and of the next if a set there can be similar
            here = np.nonzero((sizes > 0) if not up else (sizes > 0) & (sizes * self.den // self.num >= following))[0]
            for b in np.unique(band[here]):
                members = here[band[here] == b]
                k = self.differences(int(b) + up)
                if k == 0:
                    continue  # only equal sets, which are one node
                signed = self._instance(sets, begin[members], count[members], int(b) + up, k)
                out.append(signed.reshape(-1))
                owners.append(np.repeat(members, signed.shape[1]))
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(out), np.concatenate(owners)

    def _instance(self, sets: np.ndarray, begin: np.ndarray, count: np.ndarray, band: int, k: int) -> np.ndarray:
        n1 = -(-(k + 1) // (self.k2 + 1))
        parts = n1 * self.n2
        total = int(count.sum())
        elements = sets[np.arange(total) + np.repeat(begin - runs_of(count), count)]
        spread = mix(elements + _U((band * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        place = np.repeat(np.arange(len(count)) * parts, count) + ((spread >> _U(32)) % _U(parts)).astype(np.int64)
        held = np.zeros(len(count) * parts, np.uint64)
        np.add.at(held, place, mix(spread))
        held = held.reshape(len(count), n1, self.n2)
        base = np.arange(n1, dtype=np.uint64)[None, :] + _U(band << 32)
        signed = []
        for s, subset in enumerate(combinations(range(self.n2), self.n2 - self.k2)):
            value = mix(base * _U(0xD6E8FEB86659FD93) + _U(s + 1))
            value = np.broadcast_to(value, (len(count), n1))
            for j in subset:
                value = mix(value * _U(0x9E3779B97F4A7C15) + held[:, :, j])
            signed.append(value)
        return np.concatenate(signed, axis=1)


def sketch_words(size: int) -> int:
    """64-bit words of the parity sketch of a set: about two bits an element, a power of two."""
    return 1 << max(0, (max(size, 1) - 1).bit_length() - 5)


def sketch(elements: np.ndarray, words: int) -> np.ndarray:
    """Bit i is the parity of the elements that fall on it; differing bits cannot outnumber differing elements."""
    bits = np.bincount((mix(elements ^ _U(0xA0761D6478BD642F)) >> _U(20)).astype(np.int64) % (words * 64), minlength=words * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def fold_sketch(a: np.ndarray, words: int) -> np.ndarray:
    """The sketch with fewer words of the same set: bits that fall together are added modulo 2."""
    return np.bitwise_xor.reduce(a.reshape(-1, words), axis=0)


def _sets(docs: DataFrame, width: int, make, schema: str) -> DataFrame:
    """Rows made by ``make(ids, sets, count)`` from the shingle sets of runs of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for first, texts in text_slices(batch, "text", BATCH_CHARS):
                sets, count = shingler.sets(texts)
                yield make(batch.column("doc_id").slice(first, len(texts)), sets, count)

    return docs.mapInArrow(run, schema)


def _keys(sets: np.ndarray, count: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number of each set, whatever its order."""
    return mix(sum_runs(mix(sets * _U(2 * seed + 0x9FB21C651E98DF25)), count) + count.astype(np.uint64)).view(np.int64)


def _sampled(sets: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which elements are in the sample; it depends on the element alone."""
    share = min(1.0, SAMPLED * (den - num) / den)
    return (mix(sets + _U(0x8CB92BA72F3D8DD7)) >> _U(32)) < _U(int(share * (1 << 32)))


def _profiles(rows: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows with the size and key of their set, one row per key, and the seed under which keys tell sets apart."""
    seed = 0
    while True:
        def profile(ids: pa.Array, sets: np.ndarray, count: np.ndarray, seed: int = seed) -> pa.RecordBatch:
            sampled = sum_runs(_sampled(sets, num, den).astype(np.uint64), count).view(np.int64)
            columns = [ids, count.astype(np.int64), sampled, _keys(sets, count, seed), _keys(sets, count, seed + 1000)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "n_shingles", "sampled", "key", "check"])

        profiles = cut_lineage(_sets(rows, width, profile, "doc_id long, n_shingles long, sampled long, key long, check long"))
        able = profiles.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        classes = cut_lineage(able.groupBy("key").agg(
            F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("n_shingles").alias("n"), F.min("sampled").alias("sampled"),
            (F.min("check") != F.max("check")).alias("mixed"),
        ))
        if classes.where("mixed").isEmpty():
            return profiles, classes.drop("mixed"), seed
        seed += 1


def _deal(sig: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """Different (sig, key) of a run of documents, and the part of the signature each row goes to.

    Part 0 has all that may be alone.  Of a signature with many sets in this run only the first goes
    there; all of its sets are known to have company and are dealt over the other parts.
    """
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    fresh = np.append(True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]))[:len(sig)]
    sig, key = sig[fresh], key[fresh]
    begins = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[:len(sig)])
    sizes = np.diff(np.append(begins, len(sig)))
    many = np.repeat(sizes >= MANY_SETS, sizes)
    alone = ~many
    alone[begins] = True
    part = np.concatenate([np.zeros(int(alone.sum()), np.int32), 1 + (mix(key[many].view(np.uint64)) % _U(PARTS)).astype(np.int32)])
    sig, key = np.concatenate([sig[alone], sig[many]]), np.concatenate([key[alone], key[many]])
    return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(key), pa.array(part)], ["sig", "key", "part"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (sig, key) of signatures with several sets, from rows in order of sig, part and key."""
    held = (0, 0, False, False)  # the last row, if there is one, and whether it has gone out
    for batch in batches:
        sig, key, part = (batch.column(c).to_numpy() for c in ("sig", "key", "part"))
        sure = part > 0
        if held[2]:
            sig, key, sure = np.append(held[0], sig), np.append(held[1], key), np.append(held[3], sure)
        elif not len(sig):
            continue
        # (parts of one signature in one task are one run, and its set of part 0 has company then)
        other = (sig[1:] == sig[:-1]) & (key[1:] != key[:-1])
        same = (sig[1:] == sig[:-1]) & (key[1:] == key[:-1])
        joined = sure | np.append(False, other) | np.append(other, False)
        # equal rows share what is known of one of them
        run = np.cumsum(np.append(True, ~same)) - 1
        joined = np.bincount(run, weights=joined, minlength=run[-1] + 1)[run] > 0
        # the last row waits for what follows
        out = joined.copy()
        out[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(sig[out]), pa.array(key[out])], ["sig", "key"])
        held = (sig[-1], key[-1], True, bool(joined[-1]))
    if held[2] and held[3]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], ["sig", "key"])


def _suspects(rows: DataFrame, classes: DataFrame, seed: int, width: int, num: int, den: int) -> DataFrame:
    """Ids (_id) of the first document of each set that may have a link.

    Of n elements, a set with a link has at most n * (den - num) / den that the other one lacks.  So a
    set with more sampled elements that no other set has cannot have one.  (Elements that are met
    more than once for copies of a set only make it stay.)
    """

    def look(ids: pa.Array, sets: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        chosen = _sampled(sets, num, den)
        return _deal(sets[chosen].view(np.int64), np.repeat(_keys(sets, count, seed), count)[chosen])

    dealt = _sets(rows, width, look, "sig long, key long, part int").repartition("sig", "part").sortWithinPartitions("sig", "part", "key")
    known = dealt.mapInArrow(_shared, "sig long, key long").groupBy("key").agg(F.count(F.lit(1)).alias("known"))
    own = F.col("sampled") - F.coalesce("known", F.lit(0))
    return classes.join(known, "key", "left").where(own * den <= F.col("n") * (den - num)).select(F.col("id").alias("_id"))


def _of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is an _id of ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, rows["doc_id"] == F.col("_id"), "left_semi")


def linked_pairs(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity num / den; ``sets`` has key and elements (binary).

    The set of ``a`` comes before the sets it is compared with; many of them are cut into groups.
    """
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)))
    firsts = pairs.select("a", "salt").distinct()
    rows = (
        firsts.join(sets, firsts["a"] == sets["key"]).select("a", "salt", F.lit(None).cast("long").alias("b"), "elements")
        .union(pairs.join(sets, pairs["b"] == sets["key"]).select("a", "salt", "b", "elements"))
        .repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = np.zeros(0, np.uint64)
        for batch in batches:
            found: list[tuple] = []
            for a, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "elements"))):
                other = np.frombuffer(raw, np.uint64)
                if b is None:
                    current = other
                else:
                    both = len(np.intersect1d(current, other, assume_unique=True))
                    if den * both >= num * (len(current) + len(other) - both):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task as stars: every id with the smallest id it is connected to in the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    ids = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([root(x) for x in ids], pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every id in ``edges`` (a, b).

    Tasks of at most TASK_EDGES edges first reduce theirs to stars; what several tasks hold is
    then joined by least labels and shortcuts.
    """
    edges = edges.select("a", "b")
    tasks = -(-edges.count() // TASK_EDGES)
    stars = cut_lineage(edges.coalesce(max(1, tasks)).mapInArrow(_forest, "a long, b long"))
    if tasks <= 1:
        return stars.toDF("id", "component")
    both = cut_lineage(stars.union(stars.select("b", "a")).where("a <> b").distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        # the label of the label
        jump = step.select(F.col("id").alias("at"), F.col("component").alias("further"))
        step = step.join(jump, step["component"] == jump["at"]).select("id", "old", F.least("component", "further").alias("component"))
        step = cut_lineage(step)
        labels = step.select("id", "component")
        if step.where(F.col("old") != F.col("component")).isEmpty():
            return labels


def _may_link(a: bytes, na: int, b: bytes, nb: int, num: int, den: int) -> bool:
    if min(na, nb) * den < max(na, nb) * num:
        return False
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    differ = int(np.bitwise_count(fold_sketch(x, words) ^ fold_sketch(y, words)).sum())
    return differ * (den + num) <= (na + nb) * (den - num)


def _plausible(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that the sizes and sketches do not rule out."""
    left = sketches.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sa", "na", "sb", "nb")]
            keep = pa.array([_may_link(*row, num, den) for row in zip(*columns)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _meeting(left: pa.StructArray, right: pa.StructArray, num: int, den: int, thorough: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys (a < b) of the pairs of two blocks of members that _cross_pairs asks for, and whether others were left out."""
    x, y = ({c: block.field(c).to_numpy(zero_copy_only=False) for c in ("key", "component", "n")} for block in (left, right))
    size = np.minimum(x["n"][:, None], y["n"][None, :]) * den >= np.maximum(x["n"][:, None], y["n"][None, :]) * num
    apart = x["component"][:, None] != y["component"][None, :]
    i, j = np.nonzero(np.triu(apart & size) if left is right else apart & size)
    sketches = [[np.frombuffer(raw, np.uint64) for raw in block.field("sketch").to_pylist()] for block in (left, right)]
    words = [np.array([len(s) for s in side]) for side in sketches]
    keep = np.zeros(len(i), bool)
    # pairs of equal sketch lengths together, the longer sketches folded to the shorter ones
    for w in np.unique(np.minimum(words[0][i], words[1][j])):
        chosen = np.flatnonzero(np.minimum(words[0][i], words[1][j]) == w)
        sides = []
        for side, at in ((0, i[chosen]), (1, j[chosen])):
            rows, place = np.unique(at, return_inverse=True)
            sides.append((np.array([fold_sketch(sketches[side][r], w) for r in rows]), place))
        (one, p), (two, q) = sides
        step = max(1, COMPARED_WORDS // int(w))
        for k in range(0, len(chosen), step):
            differ = np.bitwise_count(one[p[k:k + step]] ^ two[q[k:k + step]]).sum(axis=1, dtype=np.int64)
            part = chosen[k:k + step]
            keep[part] = differ * (den + num) <= (x["n"][i[part]] + y["n"][j[part]]) * (den - num)
    i, j = i[keep], j[keep]
    few = thorough or len(i) <= len(x["key"]) + len(y["key"])
    if not few:
        low, high = np.minimum(x["component"][i], y["component"][j]), np.maximum(x["component"][i], y["component"][j])
        order = np.lexsort((high, low))
        new = np.append(True, (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0))[:len(order)]
        i, j = i[order[new]], j[order[new]]
    return np.minimum(x["key"][i], y["key"][j]), np.maximum(x["key"][i], y["key"][j]), not few


def _cross_pairs(members: DataFrame, sketches: DataFrame, num: int, den: int, thorough: bool) -> DataFrame:
    """Pairs (a < b) of different components under one signature that may link, and cut; ``members`` has sig, key, component.

    All of them if ``thorough``; else blocks that have more such pairs than members give one for
    every two components that meet, marked as cut.  The members of a signature are dealt over
    blocks; every two of its blocks meet in one task row.
    """
    sizes = members.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = cut_lineage(members.join(sizes, "sig").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")))
    # dealt before the lists are made: rows in order of their key, with equal sketches, pack well
    rows = dealt.join(sketches, "key").repartition("sig", "block")
    blocks = rows.groupBy("sig", "block", "blocks").agg(F.collect_list(F.struct("key", "component", "n", "sketch")).alias("rows"))
    # a signature of one block meets itself as it lies
    one = blocks.where("blocks = 1").select(F.col("rows").alias("left"), F.lit(None).cast(blocks.schema["rows"].dataType).alias("right"))
    many = blocks.where("blocks > 1")
    left = many.select("sig", F.col("block").alias("i"), F.col("rows").alias("left"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = many.select(F.col("sig").alias("sig2"), F.col("block").alias("j2"), F.col("rows").alias("right"))
    met = one.union(left.join(right, (F.col("sig") == F.col("sig2")) & (F.col("j") == F.col("j2"))).select("left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                block = left.values
                found.append(_meeting(block, right.values if right.is_valid else block, num, den, thorough))
            a, b = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (0, 1))
            cut = np.repeat(np.array([f[2] for f in found], bool), [len(f[0]) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(cut)], ["a", "b", "cut"])

    return met.mapInArrow(run, "a long, b long, cut boolean").groupBy("a", "b").agg(F.max("cut").alias("cut"))


def near_groups(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, by links of similarity num / den or more.

    A text that is null, empty or without words has no shingles and no links: it is its own
    component.  Rows that repeat an id are labelled one by one, each by the links of its own text.  A
    row with a null id has no links and a null component.  Other columns are not read; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profiles, classes, seed = _profiles(rows, width, num, den)
    edges = _links(rows.where(F.col("doc_id").isNotNull()), classes, seed, width, num, den)

    # only sets that have a link or copies belong to another document than themselves
    joined = components(edges)
    of_class = classes.join(joined.withColumnRenamed("id", "key"), "key", "left").select(
        "key", "id", "copies", "component", F.coalesce("component", "key").alias("group")
    ).where("component is not null or copies > 1")
    smallest = of_class.groupBy("group").agg(F.min("id").alias("component_id"))
    named = of_class.join(smallest, "group").select(F.col("key").alias("_key"), "component_id")
    matched = (F.col("key") == F.col("_key")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return profiles.join(named, matched, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _links(rows: DataFrame, classes: DataFrame, seed: int, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between keys of different sets, enough of them that all linked sets are connected."""

    def sign(ids: pa.Array, sets: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        # (bands depend on sizes alone, so every task has the same)
        signature, owner = PartEnum(num, den).signatures(sets, count)
        return _deal(signature.view(np.int64), _keys(sets, count, seed)[owner])

    rows = _of_ids(rows, cut_lineage(_suspects(rows, classes, seed, width, num, den)))
    # dealt once by signature; most signatures belong to one set and end in the task that sorts them
    signed = _sets(rows, width, sign, "sig long, key long, part int")
    dealt = signed.repartition("sig", "part").sortWithinPartitions("sig", "part", "key")
    members = cut_lineage(dealt.mapInArrow(_shared, "sig long, key long").distinct())
    # the set that meets most others is the likeliest centre of its group: it stands for the signature
    sizes = members.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    degree = members.join(sizes, "sig").groupBy("key").agg(F.sum("size").alias("degree"))
    centre = members.join(degree, "key").groupBy("sig").agg(F.max(F.struct("degree", "key"))["key"].alias("a"))
    others = cut_lineage(members.join(centre, "sig").where("key <> a"))

    # the sets that share any signature, from the document with the smallest id of each
    wanted = cut_lineage(members.select("key").distinct().join(classes, "key").select(F.col("id").alias("_id")).distinct())

    def hold(ids: pa.Array, sets: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        ends = np.cumsum(count)
        each = [sets[e - n:e] for e, n in zip(ends, count)]
        columns = [
            pa.array(_keys(sets, count, seed)), pa.array(count.astype(np.int64)),
            pa.array([sketch(x, sketch_words(len(x))).tobytes() for x in each], pa.binary()), pa.array([x.tobytes() for x in each], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "n", "sketch", "elements"])

    held = _sets(_of_ids(rows, wanted), width, hold, "key long, n long, sketch binary, elements binary")
    held = cut_lineage(held.where("n > 0"))
    sketches = held.select("key", "n", "sketch").dropDuplicates(["key"])
    sets = held.select("key", "elements")

    star = others.select("a", F.col("key").alias("b")).distinct()
    star = cut_lineage(_plausible(star, sketches, num, den))
    links = cut_lineage(linked_pairs(star, sets, num, den).distinct())
    compared = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    # signatures that still have sets of different components besides their centre: where many pairs
    # are left, one for every two components first; when no such pair is a link, or all of them were
    # compared before, all pairs that are left
    members, thorough = others.select("sig", "key"), False
    while True:
        label = components(links).select(F.col("id").alias("key"), "component")
        placed = members.join(label, "key", "left").select("sig", "key", F.coalesce("component", "key").alias("component"))
        still = placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        rest = cut_lineage(placed.join(still.where("low < high").select("sig"), "sig"))
        # components only grow: what is settled stays so
        members = rest.select("sig", "key")
        met = cut_lineage(_cross_pairs(rest, sketches, num, den, thorough))
        pairs = cut_lineage(met.select("a", "b").join(compared, ["a", "b"], "left_anti"))
        found = cut_lineage(linked_pairs(pairs, sets, num, den))
        if thorough or met.where("cut").isEmpty():
            return links.union(found)
        none = found.isEmpty()
        compared = compared.union(pairs)
        thorough = none
        if not none:
            links = cut_lineage(links.union(found))
