import random

import brute
from cases import FOLDER, HARD, WORDS, documents, duck, hard, nothing, rows_of, same  # noqa: F401
import numpy as np
import pytest

from tidemark.llm import jaccard_join, substring_dedup, workload
from tidemark.llm.components import components

OP3 = ("doc_id", "n_words", "n_removed", "kept_sha256")
OP4 = ("doc_id", "n_shingles", "component_id")


def test_repeats_of_the_whole_table(spark, documents):
    same(rows_of(workload.op3_substring_dedup(spark, FOLDER), *OP3), brute.op3(documents))


def test_repeats_of_hard_rows(hard, nothing):
    same(rows_of(substring_dedup.removal_digest(hard), *OP3), brute.op3(HARD))
    assert substring_dedup.removal_digest(nothing).collect() == []


@pytest.mark.parametrize("anchor", [1, 3, 5])
def test_short_windows_over_few_words(spark, anchor):
    rng = random.Random(anchor)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randrange(0, 14)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.removal_digest(docs, min_words=5, anchor_words=anchor)
    same(rows_of(found, *OP3), brute.op3(rows, 5))


def test_spans_are_maximal(spark):
    a, b = WORDS[:100], WORDS[200:260]
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join([*b, *a[10:90], *b]))], "doc_id long, text string")
    spans = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in substring_dedup.repeated_spans(docs).collect()}
    assert spans == {1: [], 2: [(60, 140)]}


def test_links_of_the_whole_table(spark, documents):
    same(rows_of(workload.op4_ngram_jaccard(spark, FOLDER), *OP4), brute.op4(documents))


def hard_links():
    """Rows without an id are linked with nothing."""
    found = brute.op4([r for r in HARD if r[0] is not None])
    return [(d, n, c if n else d) for d, n, c in found] + [(None, len(brute.shingles(t)), None) for d, t in HARD if d is None]


def test_links_of_hard_rows(hard, nothing):
    same(rows_of(jaccard_join.linked(hard), *OP4), hard_links())
    assert jaccard_join.linked(nothing).collect() == []


def test_large_regions_are_split_without_losing_links(spark):
    rng = random.Random(4)
    base = [rng.choices(WORDS, k=60) for _ in range(3)]
    rows = []
    for i in range(90):
        words = list(base[i % 3])
        for _ in range(i % 4):
            words[rng.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(words[: 60 - i % 9])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(rows_of(jaccard_join.linked(docs, unit_shingles=200), *OP4), brute.op4(rows))


def test_signature_tree_connects_like_all_pairs():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = np.unique(rng.integers(0, 2**63, 80).astype(np.uint64))
        for _ in range(8):
            keep = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.2])]
            sets.append(np.unique(np.r_[keep, rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)]))

    def classes(links):
        label = list(range(len(sets)))
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    pairs = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if 100 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 75 * (len(sets[a]) + len(sets[b]) - n)
    ]
    assert classes(jaccard_join.tree_links(sets, np.arange(len(sets)), 75)) == classes(pairs)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, k) for k in range(101, 120)] + [(7, 7), (None, 3), (50, 40), (51, 40)]
    found = dict(rows_of(components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert found == {k: 10 for k in [*range(11, 41), 50, 51]} | {k: 100 for k in range(101, 120)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
