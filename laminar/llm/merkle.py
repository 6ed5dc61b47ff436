"""Merkle manifest of a dataset: a content-addressed DAG, proofs by descent, and folding of proofs.

A row's leaf digest is the SHA-256 of its fields.  The leaves of one group (ascending by id) form a tree: every
``ARITY`` consecutive nodes become the digest of their digests as hex text, level by level, until one is left; the
last run of a level may be shorter.  The tops of the groups, ordered by group, form the tree of the root.

Building.  Leaves are range-partitioned by (group, id), and a leaf's rank is its place in its partition plus the
counts of the partitions before, so a group that holds a third of all rows is ranked by many tasks.
``SPAN`` levels are built at a time inside blocks of ``ARITY ** SPAN`` nodes; each pass stores, for each
height, records ``digest -> children``.

Proving.  Requests start at the root and go down one height at a time: a record looked up by digest gives the
children, the digit of the requested rank selects one, and the unselected ones are collected.  Requests that go
through the same node travel as one row until they part, so all leaves together cost half as many lookups as
leaves.  Segments are collected from the root down and reversed at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminar.llm.common import partitions, settle

ARITY = 3
SPAN = 5  # levels built in one pass: blocks of 243 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PART_BITS = 33  # monotonically_increasing_id keeps the partition above this bit
_SEGMENTS = "array<struct<left:string,right:string>>"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of the values in turn: ``-`` for null, else UTF-8 byte count, ``:``, the value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the segments of its path (from the leaf up) lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


@dataclass
class Manifest:
    """Written tables of a dataset's DAG.

    ``leaves(tree, rank, leaf, *kept)``, ``trees(rank, tree, digest, depth)`` with one row per group, ``root`` with
    at most one row ``(digest, depth)``, and the passes whose columns ``r1..`` hold the records of each height.
    """

    leaves: DataFrame
    trees: DataFrame
    root: DataFrame
    tree_passes: list[DataFrame]
    root_passes: list[DataFrame]
    tree_height: int
    root_height: int


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows(tree, ...)`` written in the order (tree, *order), with ``rank`` from 0 and ``n`` within each tree."""
    keys = ["tree", *order]
    placed = settle(rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", _PART_BITS)
    runs = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("low"), F.count("*").alias("in_run"))
    # one row per tree and partition it touches: a tree has at most as many as there are partitions
    of_tree = Window.partitionBy("tree")
    before = F.sum("in_run").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("tree").alias("run_tree"), "part", "low", F.coalesce(before, F.lit(0)).alias("before"),
                       F.sum("in_run").over(of_tree).alias("n"))
    return (placed.withColumn("part", part).alias("p")
            .join(runs.alias("r"), F.col("tree").eqNullSafe(F.col("run_tree")) & (F.col("p.part") == F.col("r.part")))
            .withColumn("rank", F.col("at") - F.col("low") + F.col("before")).drop("run_tree", "part", "low", "before", "at"))


def _grow(nodes: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame], int]:
    """Tops ``(tree, digest, depth)`` of ``nodes(tree, rank, n, digest)``, the passes with the records, the largest depth."""
    passes, size = [], ARITY ** SPAN
    nodes = nodes.select("tree", "rank", "n", "digest", F.lit(0).alias("depth"))
    while True:
        block = (nodes.groupBy("tree", F.floor(F.col("rank") / size).alias("rank"))
                 .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"),
                      F.first("n").alias("n"), F.first("depth").alias("depth"))
                 .withColumn("nodes", F.transform("nodes", lambda x: x["digest"])))
        for height in range(1, SPAN + 1):
            more = F.col("n") > 1  # the tree still has several nodes at this height
            last = F.floor((F.size("nodes") - 1) / ARITY)
            block = block.withColumn("runs", F.when(more, F.transform(
                F.sequence(F.lit(0).cast("long"), last), lambda i: F.slice("nodes", (i * ARITY + 1).cast("int"), ARITY))))
            block = block.withColumn(f"r{height}", F.transform("runs", lambda r: F.struct(
                F.sha2(F.array_join(r, ""), 256).alias("digest"), r.alias("children"))))
            block = block.select(
                "tree", "rank", *[f"r{h}" for h in range(1, height + 1)],
                F.when(more, F.transform(f"r{height}", lambda r: r["digest"])).otherwise(F.col("nodes")).alias("nodes"),
                F.when(more, F.ceil(F.col("n") / ARITY)).otherwise(F.col("n")).alias("n"),
                (F.col("depth") + more.cast("int")).alias("depth"))
        done = settle(block.withColumn("digest", F.col("nodes")[0]).drop("nodes"), name)
        passes.append(done)
        nodes = done.select("tree", "rank", "n", "digest", "depth")
        widest, deepest = nodes.agg(F.max("n"), F.max("depth")).first()
        if (widest or 0) <= 1:
            return nodes.select("tree", "digest", "depth"), passes, deepest or 0


def build_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id",
                   keep: tuple[str, ...] = ("doc_id",)) -> Manifest:
    """The DAG of all rows of ``docs``; ``keep`` names columns to hold beside each leaf.

    A null group is a group of its own, before all others; null ids come first in their group, and rows with equal
    ids are ordered by their leaf digests, so repeated rows are leaves of their own and the root does not
    depend on the order of rows.  An empty table has no trees and no root.  Columns not named are ignored.
    """
    named = docs.select(F.col(group).cast("string").alias("tree"), F.col(order).alias("by"),
                        leaf_digest(*[F.col(f) for f in fields]).alias("leaf"),
                        F.struct(*[F.col(k) for k in keep]).alias("kept"))
    # digests first, so that sampling the ranges does not hash every text again
    leaves = _ranked(settle(named, "leaves"), ["by", "leaf"], "ranged")
    tops, tree_passes, tree_height = _grow(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")), "trees")
    # the tops in the order of their groups are the leaves of one more tree
    named_tops = tops.select(F.lit(0).alias("tree"), F.col("tree").alias("by"), "digest", "depth")
    trees = settle(_ranked(named_tops, ["by"], "tops"), "ranked-tops")
    root, root_passes, root_height = _grow(trees.select("tree", "rank", "n", "digest"), "root")
    return Manifest(leaves.select("tree", "rank", "leaf", "kept"),
                    trees.select("rank", F.col("by").alias("tree"), "digest", "depth"), root.drop("tree"),
                    tree_passes, root_passes, tree_height, root_height)


def _records(passes: list[DataFrame], height: int) -> DataFrame:
    """``digest -> children`` of one height (only that column is read); equal content is stored once."""
    at, column = (height - 1) // SPAN, f"r{(height - 1) % SPAN + 1}"
    return (passes[at].select(F.explode(column).alias("r")).select("r.digest", "r.children")
            .dropDuplicates(["digest"]))


def _segment(digit: Column) -> Column:
    """What is left unselected of ``children``, as an array of one segment."""
    left = F.array_join(F.slice("children", F.lit(1), digit), "")
    right = F.array_join(F.slice("children", digit + 2, F.lit(ARITY)), "")
    return F.array(F.struct(left.alias("left"), right.alias("right"))).cast(_SEGMENTS)


def _descend(requests: DataFrame, records: DataFrame) -> DataFrame:
    """``requests(digest, rank, path, ...)`` one height lower."""
    others = [c for c in requests.columns if c not in ("digest", "rank", "path")]
    found = requests.join(records, "digest")
    parted = found.select(*others, "rank", "path", "children", F.posexplode("children").alias("digit", "digest"))
    return parted.select(*others, "digest", (F.col("rank") * ARITY + F.col("digit")).alias("rank"),
                         F.concat("path", _segment(F.col("digit"))).alias("path"))


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``(tree, rank, leaf, kept, subroot, root, path)``: the way of every leaf, or of the ``wanted(tree, rank)``.

    ``path`` goes from the leaf up, with the siblings to the left and to the right at each level.
    """
    at_root = manifest.root.select("digest", F.col("digest").alias("root"), F.lit(0).cast("long").alias("rank"),
                                   F.array().cast(_SEGMENTS).alias("path"))
    for height in range(manifest.root_height, 0, -1):
        at_root = _descend(at_root, _records(manifest.root_passes, height))
    entering = settle(at_root.withColumnRenamed("digest", "subroot").join(
        manifest.trees.select("rank", "tree", F.col("digest"), "depth"), "rank").select(
        "tree", "root", "subroot", "digest", "depth", F.lit(0).cast("long").alias("rank"), "path"), "entering")

    def asked(requests: DataFrame, height: int) -> DataFrame:
        if wanted is None:
            return requests
        nodes = wanted.select(F.col("tree").alias("w"), F.floor(F.col("rank") / ARITY ** height).alias("at")).distinct()
        return requests.join(nodes, F.col("tree").eqNullSafe(F.col("w")) & (F.col("rank") == F.col("at")), "left_semi")

    here = None
    for height in range(manifest.tree_height, 0, -1):
        new = entering.where(F.col("depth") == height).drop("depth")
        here = asked(new if here is None else here.unionByName(new), height)
        if height > 1:
            here = _descend(here, _records(manifest.tree_passes, height))
            if height % SPAN == 1:  # through one pass's records: a written table keeps the plan short
                here = settle(here, f"height{height - 1}")
    alone = asked(entering.where(F.col("depth") == 0).drop("depth"), 0).withColumn(
        "children", F.lit(None).cast("array<string>"))
    runs = alone if here is None else here.join(_records(manifest.tree_passes, 1), "digest").unionByName(alone)
    # the last selection meets the leaves as runs, so a path is sent once per run
    rows = manifest.leaves.groupBy(F.col("tree").alias("leaf_tree"), F.floor(F.col("rank") / ARITY).alias("run")).agg(
        F.collect_list(F.struct("rank", "leaf", "kept")).alias("rows"))
    met = (runs.withColumnRenamed("rank", "run_rank")
           .join(rows, F.col("tree").eqNullSafe(F.col("leaf_tree")) & (F.col("run_rank") == F.col("run")))
           .select("tree", "root", "subroot", "path", "children", F.explode("rows").alias("row")))
    last = F.when(F.col("children").isNotNull(), _segment((F.col("row.rank") % ARITY).cast("int")))
    out = met.select("tree", "row.rank", "row.leaf", "row.kept", "subroot", "root",
                     F.reverse(F.concat("path", F.coalesce(last, F.array().cast(_SEGMENTS)))).alias("path"))
    return asked(out, 0)
