import hashlib
import zlib

from cases import FOLDER, HARD, duck, hard, nothing, rows_of, same, whole  # noqa: F401
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, workload

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(digests):
    """The root and, for each leaf, what stands before and after it in each run."""
    paths, spots, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for i, spot in enumerate(spots):
            run = nodes[spot // 8 * 8 : spot // 8 * 8 + 8]
            paths[i].append(("".join(run[: spot % 8]), "".join(run[spot % 8 + 1 :])))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        spots = [s // 8 for s in spots]
    return (nodes[0] if nodes else None), paths


def plain(rows):
    """(doc_id, source, lang, n_chars, text) rows, audited one by one."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for g in names}
    trees = {g: tree_of([leaf_of(r) for r in ordered[g]]) for g in names}
    root, above = tree_of([trees[g][0] for g in names])
    out = []
    for g, upper in zip(names, above, strict=True):
        for row, path in zip(ordered[g], trees[g][1], strict=True):
            text, path = row[4], [*path, *upper]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf_of((*row[:4], text))
            for before, after in path:
                now = h(before, now, after)
            proof = h(*(before + after for before, after in path))
            out.append((row[0], leaf_of(row), trees[g][0], root, proof, now, now == root))
    return out


def order(docs):
    return docs.select("doc_id", "source", "lang", "n_chars", "text")


def test_the_whole_table(spark, duck, whole):
    found = rows_of(workload.op12_merkle_manifest(spark, FOLDER), *COLUMNS)
    same(found, plain([tuple(r) for r in order(whole).collect()]))
    wanted = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({workload.ORACLES['op12_merkle_manifest']})").fetchall()
    same(found, wanted)
    assert {r[-1] for r in found} == {True, False}


def test_hard_rows(hard, nothing):
    same(rows_of(merkle.audited(hard), *COLUMNS), plain([(d, "s", "en", 1, t) for d, t in HARD]))
    assert merkle.audited(nothing).collect() == []


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 130])
def test_many_groups_of_many_sizes(spark, n):
    langs = [None, "", "-", "=", "a", "ä", "z", "語"]
    rows = [(i, None, langs[i % 3] if i % 2 else "most", i, f"Text {i}" if i % 5 else None) for i in range(n)]
    rows += [(3, "s", lang, 1, "One") for lang in langs]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    same(rows_of(merkle.audited(docs), *COLUMNS), plain(rows))


def test_columns_of_other_names_do_not_matter(spark):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    extra = ["tree", "key", "leaf", "rank", "n", "lo", "hi", "children", "path", "of", "file_no", "altered"]
    wide = docs.select("*", *(F.lit(1).alias(c) for c in extra))
    same(rows_of(merkle.audited(wide), *COLUMNS), plain(rows))


def test_ranks_have_no_gaps_where_keys_repeat(spark):
    rows = [("t" if i % 3 else "u", 5 if i < 150 else i) for i in range(400)]
    docs = spark.createDataFrame(rows, "tree string, key long")
    stored = merkle.settled(docs.repartition(9), "rows")
    found = merkle.ranked(stored, [F.col("key")]).collect()
    for tree in "tu":
        ranked = sorted((r["rank"], r["key"]) for r in found if r["tree"] == tree)
        assert [r for r, _ in ranked] == list(range(len(ranked)))
        assert [k for _, k in ranked] == sorted(k for t, k in rows if t == tree)
        assert {r["n"] for r in found if r["tree"] == tree} == {len(ranked)}


def test_a_changed_row_changes_only_its_own_branch(spark):
    rows = [(i, "s", "en" if i < 50 else "de", 1, f"text {i}") for i in range(70)]
    kinds = "doc_id long, source string, lang string, n_chars long, text string"
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    first = merkle.manifest(spark.createDataFrame(rows, kinds), "doc_id", "lang", fields)
    rows[20] = (*rows[20][:4], "other")
    second = merkle.manifest(spark.createDataFrame(rows, kinds), "doc_id", "lang", fields)
    assert first.root != second.root
    for old, new, changed in ((first.runs[0], second.runs[0], 1), (first.runs[1], second.runs[1], 1)):
        assert new.join(old, ["tree", "lo", "hi", "digest"], "left_anti").count() == changed
