"""Repeated passages, by seed and extend.

**Seeds.** Of every run of ``min_words`` words, the winnowed anchor is the word gram with the least hash in
it (the leftmost of equals). Equal runs choose equal anchors, so no repeat of ``min_words`` words goes unseen.
One row stands for all neighbouring windows that chose the same anchor.

**Join.** Rows of one anchor meet. Where all of them have the same surroundings (exact and near copies), the
extension of each to both sides is the whole stretch, and every document but the first has it repeated.

**Extend.** Where surroundings differ, one document of each kind of surroundings is extended word by word to both
sides: each window that holds the anchor is compared by hash with the same window of the other kinds, through a
grouping, never through pairs. Touching windows merge into maximal repeats.

Hashes are 64 bits for the anchor and 64 more for what surrounds it, and both must agree.

Documents with equal ids are not compared with one another. A null id is never an earlier document and loses
nothing. A null or empty text has no words. Repeated rows give one result row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import grams, signed, slices, stretches, window_minimum, words_of
from tidemark.session import settled

MIN_WORDS = 50
ANCHOR_WORDS = 25
#: Bits of the position in a selection key: runs of up to 2**28 words in one slice keep leftmost order.
_POSITION_BITS = 28

SEEDS = "doc_id long, text_hash long, anchor long, around long, first int, last int"
WINDOWS = "doc_id long, text_hash long, anchor long, content long, first int, last int"
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"
SPANS = "doc_id long, text string, n_words long, spans array<struct<start:int,stop:int>>"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )


def _seeds(min_words: int, anchor_words: int):
    width = min_words - anchor_words + 1
    low_bits = np.uint64((1 << _POSITION_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text_hash").to_numpy()
            for row, data, offsets in slices(batch.column("text")):
                words = words_of(data, offsets)
                at, gram = grams(words, anchor_words)
                if len(at) < width:
                    continue
                # Grams of a row are neighbours in `at`; a window must not reach into the next row.
                key = (gram & ~low_bits) | (np.arange(len(at), dtype=np.uint64) & low_bits)
                chosen = (window_minimum(key, width) & low_bits).astype(np.int64)
                base = np.arange(len(chosen), dtype=np.int64)
                chosen += (base >> _POSITION_BITS) << _POSITION_BITS
                of = words.row[at]
                inside = np.flatnonzero(of[: len(chosen)] == of[width - 1 :])
                if not len(inside):
                    continue
                chosen, start = chosen[inside], at[inside]
                new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (np.diff(inside) != 1)])
                end = np.r_[new[1:], len(inside)] - 1
                first, last, spot = start[new], start[end], at[chosen[new]]
                around = stretches(words, first, last + min_words) ^ (spot - first).astype(np.uint64)
                owner = words.row[first]
                begin = words.first[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row + owner], pa.int64()),
                        pa.array(texts[row + owner], pa.int64()),
                        pa.array(signed(gram[chosen[new]]), pa.int64()),
                        pa.array(signed(around), pa.int64()),
                        pa.array((first - begin).astype(np.int32), pa.int32()),
                        pa.array((last - begin).astype(np.int32), pa.int32()),
                    ],
                    names=["doc_id", "text_hash", "anchor", "around", "first", "last"],
                )

    return run


def _extended(min_words: int):
    """Each window of the seeds of a document, with the hash of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            seeds = batch.column("seeds")
            lists = seeds.offsets.to_numpy()
            flat = seeds.values
            anchor, first, last = (flat.field(k).to_numpy() for k in range(3))
            for row, data, offsets in slices(batch.column("text")):
                words = words_of(data, offsets)
                rows = len(offsets) - 1
                low, high = lists[row], lists[row + rows]
                owner = np.repeat(np.arange(rows), np.diff(lists[row : row + rows + 1]))
                if not len(owner):
                    continue
                many = (last[low:high] - first[low:high] + 1).astype(np.int64)
                which = np.repeat(np.arange(len(many)), many)
                step = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                start = first[low:high][which] + step
                at = words.first[owner[which]] + start
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row + owner[which]], pa.int64()),
                        pa.array(texts[row + owner[which]], pa.int64()),
                        pa.array(anchor[low:high][which], pa.int64()),
                        pa.array(signed(stretches(words, at, at + min_words)), pa.int64()),
                        pa.array(start.astype(np.int32), pa.int32()),
                        pa.array(start.astype(np.int32), pa.int32()),
                    ],
                    names=["doc_id", "text_hash", "anchor", "content", "first", "last"],
                )

    return run


def _merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted((r["start"], r["stop"]) for r in ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str | None, list[bytes], list[tuple[int, int]]]]:
    """Text, words and merged repeats of each row."""
    for text, marks in zip(batch.column("text"), batch.column("marks").to_pylist(), strict=True):
        plain = text.as_py()
        yield plain, (plain or "").encode().split(), _merged(marks) if marks else []


def _without(words: list[bytes], spans: list[tuple[int, int]]) -> bytes:
    for start, stop in reversed(spans):
        del words[start:stop]
    return b" ".join(words)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        counts, spans = [], []
        for _, words, repeats in _rows(batch):
            counts.append(len(words))
            spans.append([{"start": a, "stop": b} for a, b in repeats])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64()), pa.array(spans, kind)],
            names=["doc_id", "text", "n_words", "spans"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests = [], [], []
        for _, words, repeats in _rows(batch):
            counts.append(len(words))
            removed.append(sum(b - a for a, b in repeats))
            digests.append(hashlib.sha256(_without(words, repeats)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


@F.pandas_udf(T.StringType())
def cut(texts: pd.Series, marks: pd.Series) -> pd.Series:
    """Texts without their marked words: the kept words joined by one space. Unmarked texts stay as they are."""
    return pd.Series(
        [
            text if spans is None or not len(spans) else _without((text or "").encode().split(), _merged(spans)).decode()
            for text, spans in zip(texts, marks, strict=True)
        ],
        dtype=object,
    )


def repeat_marks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    anchor_words: int = ANCHOR_WORDS,
) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text) and the ranges of repeated words, unmerged, of rows that have any.

    A word is in a range if a window of ``min_words`` words around it also occurs in a document with a smaller id.
    """
    if not 0 < anchor_words <= min_words:
        raise ValueError("anchor_words must lie between 1 and min_words")
    keyed = _keyed(docs, id_col, text_col)
    seeds = settled(
        keyed.where(F.col("doc_id").isNotNull()).mapInArrow(_seeds(min_words, anchor_words), SEEDS), "seeds"
    )
    shared = (
        seeds.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("around").alias("a0"), F.max("around").alias("a1"))
        .where("lo < hi")
        .select("anchor", "lo", (F.col("a0") == F.col("a1")).alias("uniform"))
    )
    met = settled(seeds.join(shared, "anchor").where("doc_id > lo or not uniform"), "met")
    mixed = met.where("not uniform")
    kinds = mixed.groupBy("anchor", "around").agg(F.min("doc_id").alias("leader"))
    ranked = settled(
        mixed.select("doc_id", "text_hash", "anchor", "around", "first", "last").join(kinds, ["anchor", "around"]), "kinds"
    )
    seeded = (
        ranked.where("doc_id = leader")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("anchor", "first", "last")).alias("seeds"))
    )
    windows = settled(
        keyed.join(seeded, ["doc_id", "text_hash"])
        .select("doc_id", "text_hash", "text", "seeds")
        .mapInArrow(_extended(min_words), WINDOWS),
        "windows",
    )
    earliest = windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("hi"))
    late = windows.join(earliest.where("leader < hi"), ["anchor", "content"]).where("doc_id > leader")
    place = ["doc_id", "text_hash", "first", "last"]
    return (
        met.where("uniform")
        .select(*place)
        .unionByName(ranked.where("doc_id > leader").select(*place))
        .unionByName(late.select(*place))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct(F.col("first").alias("start"), (F.col("last") + min_words).alias("stop"))).alias("marks"))
    )


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, text_hash, text and marks (null: none) of every row."""
    marks = repeat_marks(docs, id_col, text_col, **options)
    return _keyed(docs, id_col, text_col).join(marks, ["doc_id", "text_hash"], "left").select("doc_id", "text_hash", "text", "marks")


def repeated_spans(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text, n_words and the maximal repeats (ranges of word numbers) of every row."""
    return marked(docs, **options).mapInArrow(_spans, SPANS)


def removal_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by one space."""
    return marked(docs, **options).mapInArrow(_digest, DIGEST)
