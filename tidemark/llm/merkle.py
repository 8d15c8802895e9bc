"""Merkle manifest of a table: a digest for every row, every run of rows and the whole, with proofs that rows belong.

Rows of a group, in the order of their key, are the leaves of a tree; every ``FAN`` consecutive nodes are one run, whose
digest is a node of the next level.  Groups, in the order of their names, are the leaves of a last tree.  A node is
labelled with the interval of leaf ranks it covers.  Ranks come from a range sort and the counts of its files, so a
group that holds most rows is spread over many tasks.  Ancestors are attached from the top down, level by level: a node
joins the runs of its own bucket of ranks and takes the one whose interval contains its own; its siblings are what that
interval holds beside it.  Rows follow the leaves; what all proofs share is joined where there are eight times fewer.

Rows: nulls in any column are part of the digest, a null key comes first, a null group is a group.  Rows of one key are
ordered by digest; equal rows are leaves of their own, with proofs for their own places.  An empty table has no digest
and no rows.  Columns that are not named are neither read nor returned.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path, settled

#: Nodes of a run.
FAN = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the groups; names of groups begin with another character.
TOP = ""


class Manifest(NamedTuple):
    """``leaves``: tree, rank, n, leaf and the carried columns; ``runs`` and ``top``: the nodes of each level from 1 on."""

    leaves: DataFrame
    runs: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """The text of a field in a leaf: ``-`` for null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tree_name(group: Column) -> Column:
    """A name that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``rank`` (from 0 along ``order`` within ``tree``) and ``n`` (the rows of the tree) to a stored table.

    The rows are range-sorted into files, the place in the stored table being the last key, so that equal rows are
    spread too.  Counts are kept per file and tree; no task sees more of a tree than a file.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "ranked")
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    rows.orderBy("tree", *order, *place).write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    placed = stored.select("*", number.alias("file_no"), F.col("_metadata.row_index").alias("row_no"))
    counts = placed.groupBy("file_no", "tree").agg(F.count("*").alias("part"), F.min("row_no").alias("first_row"))
    per_tree = Window.partitionBy("tree")
    before = F.sum("part").over(per_tree.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        "file_no", "tree", (F.coalesce(before, F.lit(0)) - F.col("first_row")).alias("start"), F.sum("part").over(per_tree).alias("n")
    )
    joined = placed.join(starts, ["file_no", "tree"])
    return joined.select(*rows.columns, (F.col("start") + F.col("row_no")).alias("rank"), "n")


def _width(level: int) -> int:
    return FAN**level


def _alone(level: int) -> Column:
    """Whether a tree has a single node at this level."""
    return F.col("n") <= _width(level)


def _bucket(level: int) -> Column:
    return F.floor(F.col("lo") / _width(level))


def _nodes(leaves: DataFrame) -> DataFrame:
    return leaves.select("tree", "n", F.col("rank").alias("lo"), F.col("rank").alias("hi"), F.col("leaf").alias("digest"))


def _levels(leaves: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, and the last node of each tree."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, runs, level = _nodes(leaves), [], 0
    ends = nodes.where(_alone(0))
    while most > _width(level):
        level += 1
        grouped = nodes.where(~_alone(level - 1)).groupBy("tree", "n", _bucket(level).alias("bucket"))
        run = grouped.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        run = run.select(
            "tree",
            "n",
            F.col("children")[0]["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"),
            F.sha2(F.concat_ws("", F.col("children.digest")), 256).alias("digest"),
            "children",
        )
        nodes = settled(run, f"{label}-{level}")
        runs.append(nodes)
        ends = ends.unionByName(nodes.where(_alone(level)).drop("children"))
    return runs, ends


def manifest(rows: DataFrame, key: str, group: str, fields: list[str], **carried: Column) -> Manifest:
    """The manifest of ``rows``: leaves digest ``fields`` in their order; ``carried`` columns stay beside the leaves."""
    leaf = digest(*(field(F.col(f"`{name}`")) for name in fields))
    named = [column.alias(name) for name, column in carried.items()]
    leaves = settled(rows.select(tree_name(F.col(group)).alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"), *named), "leaves")
    leaves = settled(ranked(leaves, [F.col("key").asc_nulls_first(), F.col("leaf")]), "ranked-leaves")
    runs, ends = _levels(leaves, "runs")
    roots = settled(ends.select(F.lit(TOP).alias("tree"), F.col("tree").alias("member"), F.col("digest").alias("leaf")), "subroots")
    roots = settled(ranked(roots, [F.col("member")]), "ranked-subroots")
    top, last = _levels(roots, "top")
    root = last.first()
    return Manifest(leaves, runs, roots, top, root["digest"] if root else None)


def _steps(nodes: DataFrame, level: int, runs: DataFrame) -> DataFrame:
    """Adds ``path`` to nodes of a level: what stands before and after them in their run, then the run's own path.

    The run is found among those of the bucket, by containment; the siblings are its children outside the node's interval.
    """
    run = runs.select(
        F.col("tree").alias("of"),
        _bucket(level + 1).alias("bucket"),
        F.col("lo").alias("first"),
        F.col("hi").alias("last"),
        F.col("children").alias("members"),
        F.col("path").alias("above"),
    )
    inside = (F.col("first") <= F.col("lo")) & (F.col("hi") <= F.col("last"))
    same = (F.col("tree") == F.col("of")) & (_bucket(level + 1) == F.col("bucket"))
    before = F.filter("members", lambda c: c["hi"] < F.col("lo"))
    after = F.filter("members", lambda c: c["lo"] > F.col("hi"))

    def text(side: Column) -> Column:
        return F.concat_ws("", F.transform(side, lambda c: c["digest"]))

    step = F.array(F.struct(text(before).alias("before"), text(after).alias("after")))
    kept = [nodes[c] for c in nodes.columns]
    return nodes.join(run, same & inside).select(*kept, F.concat(step, "above").alias("path"))


def _no_path() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def _paths(leaves: DataFrame, runs: list[DataFrame], ends: DataFrame | None) -> DataFrame:
    """Adds ``path`` to leaves (with lo and hi); ``ends`` gives the path of each tree's last node (None: empty)."""
    levels, above = [leaves, *runs], None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        single = nodes.where(_alone(level))
        single = single.select("*", _no_path().alias("path")) if ends is None else single.join(ends, "tree").select(*nodes.columns, "path")
        below = nodes.where(~_alone(level))
        above = single if above is None else single.unionByName(_steps(below, level, above))
    return above


def proofs(made: Manifest) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: from the leaf to the root, the digests before and after it in each run."""
    spans = [F.col("rank").alias("lo"), F.col("rank").alias("hi")]
    roots = _paths(made.subroots.select("*", *spans), made.top, None)
    ends = settled(roots.select(F.col("member").alias("tree"), F.col("leaf").alias("subroot"), "path"), "paths")
    found = _paths(made.leaves.select("*", *spans), made.runs, ends.select("tree", "path"))
    return found.join(ends.select("tree", "subroot"), "tree").drop("lo", "hi")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda known, step: digest(step["before"], known, step["after"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))), 256)


def audited(docs: DataFrame) -> DataFrame:
    """Every document with its proof, and what the proof says after a third of the texts was lower-cased (A-Z).

    Texts of documents whose crc32 of the decimal doc_id divides by 3 are altered; a null doc_id has none.
    """
    altered = digest(
        *(field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), field(F.translate("text", UPPER, LOWER))
    )
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    made = manifest(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], altered=F.when(hit, altered))
    root = F.lit(made.root).cast("string")
    tested = folded(F.coalesce("altered", "leaf"), F.col("path"))
    found = proofs(made).select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        tested.alias("folded_root"),
    )
    return found.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))
