"""Near-duplicate documents by the Jaccard similarity of their word shingles, with signature trees.

1. **Sets.** Every document becomes the set of its 5-word shingle hashes; equal sets are one node from here on, so
   copies are never expanded into pairs.
2. **Regions.** Nodes that share a min-hash band fall into one region, found as connected components of band
   leaders. Two sets at the threshold t miss each other in all bands with probability (1 - t**BAND)**BANDS, which is
   6e-16 at 0.75. Every node belongs to one region, so its set is shipped once.
3. **Tree.** Nodes of a region form a signature tree: leaves of neighbouring sets, inner nodes with the OR of the token
   bitmaps below and the range of set sizes. A dual traversal from the root skips a pair of nodes if the sizes or the
   maximum possible overlap rule out the threshold, or if all documents below are in one component already. What is
   left at the leaves is compared exactly.
4. **Components** of the links found.

A region of more than ``UNIT_SHINGLES`` shingles is split by size band (neighbours differ by the factor t) and by hash;
pairs of its parts, of equal or neighbouring bands, are units of work of bounded size.

A document of fewer than ``n`` words has its whole word sequence as one shingle. Null, empty or wordless texts have the
empty set and link with nothing. Rows with equal ids count as one document for linking. A null id gets a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.words import LOWER, SAME, grams, mix, signed, slices, stretches, words_of
from tidemark.session import settled

PERCENT = 75
SHINGLE_WORDS = 5
BANDS, BAND = 64, 3
#: Shingles of a unit of work: 8 MB of hashes.
UNIT_SHINGLES = 1_000_000
LEAF, FANOUT, MOST_BITS = 16, 8, 8192

_SEEDS = mix(np.arange(1, BANDS * BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
SETS = "doc_id long, n long, set_a long, set_b long, bands array<long>"


def _shingles(data: np.ndarray, offsets: np.ndarray, n: int, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every row, sorted by row and hash, and the bounds of the rows."""
    words = words_of(data, offsets, fold=fold)
    at, gram = grams(words, n)
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    whole = mix(stretches(words, words.first[short], words.first[short] + words.count[short]) ^ words.count[short].astype(np.uint64))
    row, gram = np.r_[words.row[at], short], np.r_[gram, whole]
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    return gram, np.searchsorted(row, np.arange(len(offsets)))


def _sets(n: int, fold: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in slices(batch.column("text")):
                gram, bound = _shingles(data, offsets, n, fold)
                rows = len(offsets) - 1
                size = np.diff(bound)
                full = np.flatnonzero(size)
                a, b = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                bands = np.zeros((len(full), BANDS), np.uint64)
                if len(full):
                    start = bound[:-1][full]
                    a[full] = np.add.reduceat(mix(gram), start)
                    b[full] = np.add.reduceat(mix(gram ^ np.uint64(0x5851F42D4C957F2D)), start)
                    for i in range(BANDS):
                        for j in range(BAND):
                            low = np.minimum.reduceat(gram * _SEEDS[i * BAND + j], start)
                            bands[:, i] = mix(bands[:, i] ^ low ^ np.uint64(i + 1))
                ends = np.zeros(rows + 1, np.int32)
                ends[1:] = np.cumsum((size > 0) * BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, rows),
                        pa.array(size, pa.int64()),
                        pa.array(signed(a)),
                        pa.array(signed(b)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(bands.ravel()))),
                    ],
                    names=["doc_id", "n", "set_a", "set_b", "bands"],
                )

    return run


def _payload(n: int, fold: np.ndarray):
    """The sets themselves, as sorted 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                gram, bound = _shingles(data, offsets, n, fold)
                sets = [gram[bound[i] : bound[i + 1]].tobytes() for i in range(len(offsets) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(row, len(sets)) for c in ("doc_id", "region", "units")),
                        pa.array(sets, pa.binary()),
                    ],
                    names=["doc_id", "region", "units", "hashes"],
                )

    return run


class _Tree:
    """A signature tree over sets: level 0 has the leaves, each higher level the OR and the size range of FANOUT nodes."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        bits = 64
        while bits < min(4 * self.size.max(), MOST_BITS):
            bits *= 2
        self.bitmap = np.zeros((len(sets), bits // 64), np.uint64)
        for i, s in enumerate(sets):
            at = s & np.uint64(bits - 1)
            np.bitwise_or.at(self.bitmap[i], at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        #: Tokens beyond the set bits; the overlap of two sets is at most the common bits plus the lesser excess.
        self.excess = self.size - np.bitwise_count(self.bitmap).sum(axis=1).astype(np.int64)
        self.bounds = [np.r_[np.arange(0, len(sets), LEAF), len(sets)]]
        while len(self.bounds[-1]) > 2:
            below = self.bounds[-1]
            self.bounds.append(np.r_[below[:-1:FANOUT], len(sets)])
        self.ored = [np.bitwise_or.reduceat(self.bitmap, b[:-1], axis=0) for b in self.bounds]
        self.least = [np.minimum.reduceat(self.size, b[:-1]) for b in self.bounds]
        self.most = [np.maximum.reduceat(self.size, b[:-1]) for b in self.bounds]
        self.spare = [np.maximum.reduceat(self.excess, b[:-1]) for b in self.bounds]

    def children(self, level: int, k: int) -> range:
        return range(k * FANOUT, min((k + 1) * FANOUT, len(self.bounds[level - 1]) - 1))

    def possible(self, level: int, a: int, b: int, percent: int) -> bool:
        """Whether sets below two nodes can reach the threshold."""
        least, most = self.least[level], self.most[level]
        if 100 * most[a] < percent * least[b] or 100 * most[b] < percent * least[a]:
            return False
        overlap = np.bitwise_count(self.ored[level][a] & self.ored[level][b]).sum() + min(self.spare[level][a], self.spare[level][b])
        return (100 + percent) * min(overlap, most[a], most[b]) >= percent * (least[a] + least[b])


def tree_links(sets: list[np.ndarray], label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets of at least the similarity ``percent``; ``label`` holds the components so far."""
    if len(sets) < 2:
        return []
    tree, links = _Tree(sets), []

    def settled_pair(low: int, high: int, low2: int, high2: int) -> bool:
        first = label[low]
        return bool((label[low:high] == first).all() and (label[low2:high2] == first).all())

    stack = [(len(tree.bounds) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        bound = tree.bounds[level]
        if settled_pair(bound[a], bound[a + 1], bound[b], bound[b + 1]) or not tree.possible(level, a, b, percent):
            continue
        if level:
            left, right = tree.children(level, a), tree.children(level, b)
            pairs = [(level - 1, i, j) for i in left for j in right if a != b or i < j]
            stack += pairs + [(level - 1, i, i) for i in left if a == b]  # each node by itself comes first
            continue
        i, j = np.meshgrid(np.arange(bound[a], bound[a + 1]), np.arange(bound[b], bound[b + 1]), indexing="ij")
        keep = (label[i] != label[j]) & ((a != b) | (i < j))
        i, j = i[keep], j[keep]
        both = np.bitwise_count(tree.bitmap[i] & tree.bitmap[j]).sum(axis=1) + np.minimum(tree.excess[i], tree.excess[j])
        both = np.minimum(both, np.minimum(tree.size[i], tree.size[j]))
        keep = (100 + percent) * both >= percent * (tree.size[i] + tree.size[j])
        for x, y in zip(i[keep], j[keep], strict=True):
            if label[x] != label[y]:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    links.append((int(x), int(y)))
                    label[label == label[y]] = label[x]
    return links


def _unit_links(percent: int):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(h, np.uint64) for h in unit["hashes"]]
        order = sorted(range(len(sets)), key=lambda k: (int(mix(sets[k]).min()), len(sets[k])))
        ids = unit["doc_id"].to_numpy()[order]
        _, label = np.unique(ids, return_inverse=True)
        links = tree_links([sets[k] for k in order], label.copy(), percent)
        return pd.DataFrame({"a": [ids[x] for x, _ in links], "b": [ids[y] for _, y in links]}, dtype="int64")

    return run


def _units(active: DataFrame, unit_shingles: int, percent: int) -> DataFrame:
    """``units`` of each node: the keys of the units of work that need its set."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    active = active.withColumn("band", band)
    whole = active.groupBy("region").agg(F.sum("n").alias("total"))
    large = whole.where(F.col("total") > unit_shingles).select("region")
    parts = (
        active.join(large, "region")
        .groupBy("region", "band")
        .agg(F.ceil(F.sum("n") / unit_shingles).cast("int").alias("parts"))
    )
    near = lambda shift, name: parts.select("region", (F.col("band") + shift).alias("band"), F.col("parts").alias(name))
    layout = parts.join(near(-1, "up"), ["region", "band"], "left").join(near(1, "down"), ["region", "band"], "left")
    own = F.pmod(F.xxhash64("doc_id", "n"), F.col("parts")).cast("int")
    key = lambda b1, c1, b2, c2: F.concat_ws(".", b1, c1, b2, c2)
    to = lambda count: F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    at = F.col("band")
    inside = F.transform(to(F.col("parts")), lambda j: key(at, F.least(own, j), at, F.greatest(own, j)))
    above = F.transform(to(F.coalesce("up", F.lit(0))), lambda j: key(at, own, at + 1, j))
    below = F.transform(to(F.coalesce("down", F.lit(0))), lambda j: key(at - 1, j, at, own))
    return (
        active.join(layout, ["region", "band"], "left")
        .select(
            "doc_id",
            "region",
            F.when(F.col("parts").isNull(), F.array(F.lit(""))).otherwise(F.concat(inside, above, below)).alias("units"),
        )
    )


def linked(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle_words: int = SHINGLE_WORDS,
    lower: bool = True,
    unit_shingles: int = UNIT_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) of every row."""
    fold = LOWER if lower else SAME
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = settled(texts.mapInArrow(_sets(shingle_words, fold), SETS), "sets")
    identity = ["n", "set_a", "set_b"]
    nodes = (
        sets.where("n > 0 and doc_id is not null")
        .groupBy(*identity)
        .agg(F.min("doc_id").alias("leader"), F.first("bands").alias("bands"))
    )
    nodes = settled(nodes, "nodes")
    # Both sides of the two large joins grow with the corpus: a sort-merge join at every size, whose skewed parts can be split.
    keys = nodes.select(F.col("leader").alias("doc_id"), F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key", "lo")
    # Ids that stand on several different texts are one node, and need no region of their own.
    regions = components(keys.join(heads.hint("merge"), "key").where("doc_id > lo").select(F.col("doc_id").alias("a"), F.col("lo").alias("b")))
    heads_too = regions.select("node", "component").unionByName(
        regions.select(F.col("component").alias("node"), "component").distinct()
    )
    active = nodes.join(heads_too, F.col("leader") == F.col("node")).select(
        F.col("leader").alias("doc_id"), F.col("component").alias("region"), "n"
    )
    sized = active.groupBy("doc_id", "region").agg(F.max("n").alias("n"))
    units = settled(_units(settled(sized, "active"), unit_shingles, percent), "units")
    hashes = texts.join(units.hint("merge"), "doc_id").select("doc_id", "text", "region", "units").mapInArrow(
        _payload(shingle_words, fold), "doc_id long, region long, units array<string>, hashes binary"
    )
    found = (
        hashes.select("doc_id", "region", F.explode("units").alias("unit"), "hashes")
        .where(F.length("hashes") > 0)
        .groupBy("region", "unit")
        .applyInPandas(_unit_links(percent), "a long, b long")
    )
    groups = components(found)
    classes = nodes.select(*identity, "leader").join(groups, F.col("leader") == F.col("node"), "left")
    classes = classes.select(*identity, F.coalesce("component", "leader").alias("component"))
    return sets.join(classes, identity, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )
