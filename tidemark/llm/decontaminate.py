"""Benchmark decontamination with one Aho-Corasick automaton.

Items and texts are normalised alike: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one
space. The patterns are all runs of ``window`` item words (an item of fewer words is one pattern), with a space at
both ends so that only whole words match. Every text is scanned once; matches map back to word numbers, and through
the word starts to character offsets of the original text.

The patterns travel to the tasks, so their size is checked: up to ``AUTOMATON_BYTES`` of item text make one
automaton, more items make several, each scanned in its own pass over the texts, and the passes are put together
by document. Items with a null id or without words match nothing. Null texts have no words.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 10
#: Item text per automaton; its states take about 50 times as much in each Python worker.
AUTOMATON_BYTES = 2 << 20

#: Separators become spaces and A-Z becomes a-z, byte by byte; bytes of other letters stay.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)
#: Words in the original text, where A-Z are letters too.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_AUTOMATA: dict[str, object] = {}

SCANNED = "doc_id long, text_hash long, n_words long, spans array<struct<start:int,stop:int>>, item_ids array<string>"


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode().translate(_FOLD).split())


def _patterns(items: list[tuple[str, str]], window: int) -> dict[str, list[str]]:
    found: dict[str, set[str]] = {}
    for item, text in items:
        words = normalised(text).decode().split(" ") if normalised(text) else []
        for i in range(max(min(len(words), 1), len(words) - window + 1)):
            found.setdefault(" ".join(["", *words[i : i + window], ""]), set()).add(item)
    return {k: sorted(v) for k, v in found.items()}


def _automaton(patterns: dict[str, list[str]]):
    import ahocorasick

    key = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        made = ahocorasick.Automaton()
        for pattern, items in patterns.items():
            made.add_word(pattern, (len(pattern), items))
        made.make_automaton()
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


def _scan(patterns: dict[str, list[str]]):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(patterns) if patterns else None
        for batch in batches:
            counts, spans, items = [], [], []
            for value in batch.column("text"):
                plain = normalised(value.as_py())
                counts.append(plain.count(b" ") + 1 if plain else 0)
                hits, ids = [], set()
                if automaton is not None and plain:
                    padded = f" {plain.decode()} "
                    found = list(automaton.iter(padded))
                    if found:
                        starts = [i for i, c in enumerate(padded) if c == " "]
                        for end, (length, names) in found:
                            a, b = bisect_right(starts, end - length + 1) - 1, bisect_right(starts, end) - 1
                            ids.update(names)
                            if hits and a <= hits[-1][1]:
                                hits[-1][0], hits[-1][1] = min(hits[-1][0], a), max(hits[-1][1], b)
                            else:
                                hits.append([a, b])
                spans.append([{"start": a, "stop": b} for a, b in joined(hits)])
                items.append(sorted(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, kind),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text_hash", "n_words", "spans", "item_ids"],
            )

    return run


def joined(ranges) -> list[tuple[int, int]]:
    """Ranges of word numbers, touching and overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, ranges)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def offsets_of(text: str, spans) -> list[tuple[int, int]]:
    """Character ranges of word ranges in the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [(at[s["start"]][0], at[s["stop"] - 1][1]) for s in spans]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """doc_id, text_hash, n_words, the hit word ranges and the ids (as strings) of the items that occur, for every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // automaton_bytes))

    def scanned(own: DataFrame) -> DataFrame:
        return texts.mapInArrow(_scan(_patterns([tuple(r) for r in own.collect()], window)), SCANNED)

    if parts == 1:
        return scanned(items)
    passes = [scanned(items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)) for part in range(parts)]
    # Repeated rows are scanned in every pass, so each pass has all of them: one row of each kind, and their number.
    return (
        reduce(DataFrame.unionByName, passes)
        .groupBy("doc_id", "text_hash", "n_words")
        .agg(
            F.flatten(F.collect_set("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
            (F.count("*") / parts).cast("int").alias("copies"),
        )
        .mapInArrow(_combined, SCANNED)
    )


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of several automata as one list, and a row for each copy."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            spans = [{"start": a, "stop": b} for a, b in joined((s["start"], s["stop"]) for s in row["spans"])]
            rows += [row | {"spans": spans}] * row["copies"]
        kinds = [batch.schema.field(n) for n in ("doc_id", "text_hash", "n_words", "spans", "item_ids")]
        yield pa.RecordBatch.from_pylist([{f.name: r[f.name] for f in kinds} for r in rows], schema=pa.schema(kinds))


def contamination_digest(found: DataFrame) -> DataFrame:
    """The counts of a scan, and a digest of the sorted item ids."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")).cast("binary"), 256).alias("items_sha256"),
        (F.size("item_ids") > 0).alias("contaminated"),
    )


@F.pandas_udf(T.StringType())
def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their hit words, cut out by their character offsets; texts without hits stay as they are."""
    out = []
    for text, hits in zip(texts, spans, strict=True):
        for a, b in reversed(offsets_of(text, hits) if hits is not None and len(hits) else []):
            text = text[:a] + text[b:]
        out.append(text)
    return pd.Series(out, dtype=object)
