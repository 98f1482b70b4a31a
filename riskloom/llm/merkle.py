"""Merkle manifest of a dataset with a proof per row, made by pointer jumping.

Every row is a leaf; the rows of a group (a language) form a tree whose inner nodes are digests of up to ``FANOUT``
consecutive nodes, and the groups' roots form one more tree. Trees are built level by level, each level an aggregate over
one eighth of the rows of the level below. Then every inner node holds a pointer to its parent and the segment of siblings
on the way there. A round joins the nodes with themselves: a node takes over the pointer of its ancestor and appends the
ancestor's segment to its own, so that the distance doubles until all pointers reach the root. The leaves join last, run
by run: their rows, seven eighths of all nodes, move once instead of once per round.

The order within a group is that of the key, null first, then of the digest; rows equal in both are interchangeable. A
null group is a group, before all others. Null values of a leaf are told from empty ones. Repeated rows are leaves each;
an empty table gives an empty manifest. Columns other than those named are not read.

Everything is a DataFrame expression. Digests are kept as 32 bytes and hashed as 64 hex digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import free_shuffles
from riskloom.llm.ordering import numbered
from riskloom.session import stored

FANOUT = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Number of the tree over the groups' roots; the groups' own trees count from 0.
TOP = -1
PATH = "array<struct<left:binary,right:binary>>"


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: per value ``-`` for null, else its length in bytes, a colon and the value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return _digest(F.concat(*[part(v) for v in values]))


def _joined(members: Column) -> Column:
    """Hex digits of the digests of ``members``, in their order."""
    return F.array_join(F.transform(members, lambda m: hex_of(m["digest"])), "")


def _sides(members: Column, idx: Column) -> Column:
    """Siblings before and behind member ``idx`` of a run, as bytes."""
    return F.struct(
        F.unhex(_joined(F.filter(members, lambda m: m["idx"] < idx))).alias("left"),
        F.unhex(_joined(F.filter(members, lambda m: m["idx"] > idx))).alias("right"),
    )


def _grow(nodes: DataFrame, label: str, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, and (tree, digest) of every tree's root. ``nodes``: tree, idx, size, digest, payload.

    ``size`` is the number of nodes of the tree on this level. A run: tree, up (its place on the next level), size (of
    the next level), members, digest.
    """
    levels, roots = [], nodes.where("size = 1").select("tree", "digest")
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        members = F.array_sort(F.collect_list(F.struct("idx", "digest", *(payload if not levels else []))))
        runs = nodes.where("size > 1").groupBy(
            "tree", F.floor(F.col("idx") / FANOUT).alias("up"), F.ceil(F.col("size") / FANOUT).alias("size")
        ).agg(members.alias("members")).withColumn("digest", _digest(_joined(F.col("members"))))
        levels.append(stored(runs, f"{label}-{len(levels)}"))
        nodes = levels[-1].select("tree", F.col("up").alias("idx"), "size", "digest")
        roots = roots.unionAll(nodes.where("size = 1").select("tree", "digest"))
        most = math.ceil(most / FANOUT)
    return levels, roots


def _parent(level: int) -> Column:
    """Node above the members of a run of ``level``. The root of a group's tree is a leaf of the tree over the groups."""
    above = F.struct(F.col("tree"), F.lit(level + 1).alias("level"), F.col("up").alias("idx"))
    root = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"))
    return F.when((F.col("size") == 1) & (F.col("tree") != TOP), root).otherwise(above)


def _pointers(runs: DataFrame, level: int) -> DataFrame:
    """(node, anc, path) of the members of all runs of a level: pointers to the parent."""
    return runs.select(_parent(level).alias("anc"), "tree", "members", F.explode("members").alias("m")).select(
        F.struct("tree", F.lit(level).alias("level"), F.col("m.idx").alias("idx")).alias("node"), "anc",
        F.array(_sides(F.col("members"), F.col("m.idx"))).alias("path"),
    )


def jumped(pointers: DataFrame, height: int) -> DataFrame:
    """Pointers of all nodes to the root, by doubling; ``height`` is the greatest distance to it."""
    for _ in range(max(height - 1, 0).bit_length()):
        ancestors = pointers.select(F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("path").alias("more"))
        pointers = stored(pointers.join(ancestors, "anc", "left").select(
            "node", F.coalesce("next", "anc").alias("anc"),
            F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("path", "more")).alias("path"),
        ), "pointers")
    return pointers


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, columns: tuple[str, ...] = LEAF_COLUMNS,
             group: str = "lang", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, leaf, altered, subroot, root (32 bytes each) and path.

    ``path`` lists the siblings left and right of the way from the leaf to the root. ``altered`` is the leaf with some
    columns replaced by other expressions, as it would be had the row been changed after the manifest was made.
    """
    spark = docs.sparkSession
    changed = [(altered or {}).get(c, F.col(c)) for c in columns]
    rows = stored(docs.select(
        F.col(key).alias("key"), F.col(group).alias("group"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        leaf_digest(changed).alias("altered"), F.monotonically_increasing_id().alias("row"),
    ), "leaves")
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]
    leaves = numbered(rows, ["group"], order, "leaf-order")
    groups = leaves.where("idx = 0").select("group", F.lit(0).alias("all"))
    trees = stored(numbered(groups, ["all"], [F.col("group").asc_nulls_first()], "group-order").select(
        F.col("group").alias("g"), F.col("idx").alias("tree"), F.col("size").alias("trees")), "trees")
    leaves = stored(leaves.join(trees, F.col("group").eqNullSafe(F.col("g"))).select(
        "tree", "idx", "size", "digest", "key", "altered"), "placed-leaves")
    free_shuffles(spark)

    levels, subroots = _grow(leaves, "level", ["key", "altered"])
    subroots = stored(subroots, "subroots")
    tops, roots = _grow(subroots.join(trees.select("tree", "trees"), "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("size"), "digest"), "top", [])
    root = roots.first()
    pointers = spark.createDataFrame(
        [], "node struct<tree:bigint,level:int,idx:bigint>, anc struct<tree:bigint,level:int,idx:bigint>, path " + PATH)
    for level, runs in [*list(enumerate(levels))[1:], *enumerate(tops)]:
        pointers = pointers.unionAll(_pointers(runs, level))
    pointers = jumped(stored(pointers, "pointers"), max(len(levels) - 1, 0) + len(tops))
    free_shuffles(spark)

    lone = leaves.where("size = 1").select(
        "tree", F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx")).alias("node"),
        F.array(F.struct("idx", "digest", "key", "altered")).alias("members"), F.lit(True).alias("lone"))
    runs = lone if not levels else lone.unionAll(levels[0].select("tree", _parent(0).alias("node"), "members", F.lit(False)))
    nothing = F.array().cast(PATH)
    return runs.join(pointers.select("node", "path"), "node", "left").join(
        subroots.withColumnRenamed("digest", "subroot"), "tree"
    ).select(
        "lone", "members", "subroot", F.coalesce("path", nothing).alias("path"), F.explode("members").alias("m")
    ).select(
        F.col("m.key").alias(key), F.col("m.digest").alias("leaf"), F.col("m.altered").alias("altered"), "subroot",
        (F.lit(bytes(root["digest"])) if root else F.lit(None).cast("binary")).alias("root"),
        F.concat(F.when(F.col("lone"), nothing).otherwise(F.array(_sides(F.col("members"), F.col("m.idx")))), "path").alias("path"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda h, s: _digest(hex_of(F.concat(s["left"], h, s["right"]))))


def siblings(path: Column) -> Column:
    """Hex digits of all siblings of a path, level by level."""
    return F.array_join(F.transform(path, lambda s: hex_of(F.concat(s["left"], s["right"]))), "")


def tampered_text() -> Column:
    """The text in lower case (A-Z only) where 3 divides the checksum of the doc_id; a row without doc_id stays."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest in hex, with the digest of each proof and what it yields for a row tampered with."""
    rows = manifest(docs, {"text": tampered_text()}).select(
        "doc_id", *[hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        hex_of(folded(F.col("altered"), F.col("path"))).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
