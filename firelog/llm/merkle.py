"""Merkle manifest of a table, and the audit of every leaf by a recursive climb (operator 12).

Rows are leaves; the leaves of one group (a source), in order, form a tree:
while several nodes remain, each 16 consecutive ones become their parent. What
remains is the group's subroot; the subroots, in order of their groups, form
the top tree in the same way, up to the root.

Leaves are placed by one range shuffle: a row's place is the number of rows in
earlier partitions (one row per partition, summed up) plus its number in its
own. A hot group lies in many ranges, and its rows learn where it begins from
one row per (partition, group). Levels are built from the leaves up, each
written to the shared folder, and stored as node rows with a link to their
parent, its slot under it and the digests of their own children.

The audit starts from the runs of up to 16 leaves. Leaves of a run share all
siblings above it, so a run climbs as one row of a recursive query: each step
joins its parent's node row, appends the siblings, and folds the digests of
the run's leaves as they are and as altered. Every node is stored once per
``CLIMBERS`` runs below it and a run picks its copy by hash, so that no join
key gathers more, the root's included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firelog.llm.common import stored

FANOUT = 16
DIGEST = 32
# Runs that meet in one copy of a node row.
CLIMBERS = 4096
TOP = -1  # the tree of subroots


def digest_of(text: Column) -> Column:
    """Digest (32 bytes) of a text."""
    return F.unhex(F.sha2(text, 256))


def fold(digests: Column) -> Column:
    """Digest of consecutive digests, taken as lower-case hex text."""
    return digest_of(F.lower(F.hex(digests)))


def leaf_text(values: list[Column]) -> Column:
    """Values one after the other: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    def one(v: Column) -> Column:
        s = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.concat(*(one(v) for v in values))


def leaves(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source",
           altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``(doc_id, grp, leaf, altered, salt)`` of every row of ``docs``.

    ``leaf`` is the digest of ``columns``; ``altered`` that of the row as it
    is claimed to be: with the columns named in ``altered`` replaced where
    ``where`` holds, null elsewhere (nothing is claimed). ``salt`` tells equal
    rows apart.
    """
    as_is = leaf_text([docs[c] for c in columns])
    changed = F.lit(None).cast("binary")
    if altered:
        changed = F.when(F.lit(True) if where is None else where, digest_of(leaf_text([altered.get(c, docs[c]) for c in columns])))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[group_col].cast("string").alias("grp"),
                       digest_of(as_is).alias("leaf"), changed.alias("altered"), F.monotonically_increasing_id().alias("salt"))


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``part`` and ``place``, the number of rows before it in the order of all."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number and row number in it, in one value
    ranged = stored(ranged.select(F.monotonically_increasing_id().alias("at"), *rows.columns), name)
    ranged = ranged.select(F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at"), *rows.columns)
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
              .select("part", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("before")))
    # one row per partition of the shuffle, whatever the number of rows
    return ranged.join(F.broadcast(before), "part").select("part", (F.col("before") + F.col("at")).alias("place"), *rows.columns)


def _above(nodes: DataFrame, name: str) -> DataFrame:
    """Parents of items (g_tree, g_pos, g_level, count, tree, level, pos, hash, children, weight), with their items as ``kids``."""
    kid = F.struct("g_pos", "tree", "level", "pos", "hash", "children", "weight")
    up = nodes.groupBy("g_tree", "g_level", "count", F.floor(F.col("g_pos") / FANOUT).cast("long").alias("up_pos")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"), F.sum("weight").alias("weight"))
    up = up.withColumn("children", F.aggregate("kids", F.lit(b""), lambda a, k: F.concat(a, k["hash"])))
    return stored(up.select(
        "kids", F.col("g_tree").alias("tree"), (F.col("g_level") + 1).alias("level"), F.col("up_pos").alias("pos"),
        F.ceil(F.col("count") / FANOUT).cast("long").alias("count"), fold(F.col("children")).alias("hash"), "children", "weight"), name)


def _items(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("tree").alias("g_tree"), F.col("level").alias("g_level"), F.col("pos").alias("g_pos"), "count",
                        "tree", "level", "pos", "hash", "children", "weight")


def _copies(weight: Column) -> Column:
    return F.ceil(weight / CLIMBERS).cast("long")


def _links(parents: DataFrame) -> DataFrame:
    """Node rows of the children of ``parents``."""
    k = parents.select("tree", "level", "pos", "weight", F.explode("kids").alias("k"))
    return k.select("k.tree", "k.level", "k.pos", "k.hash", "k.children", "k.weight", F.pmod("k.g_pos", F.lit(FANOUT)).cast("int").alias("slot"),
                    F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("pos").alias("up_pos"),
                    _copies(F.col("weight")).alias("up_copies"), ((F.col("k.tree") != TOP) & (F.col("tree") == TOP)).alias("is_subroot"))


@dataclass
class Manifest:
    """``runs``: up to 16 leaves with the digests; ``nodes``: parent-linked node rows; ``root``: hex, None for an empty table."""

    runs: DataFrame
    nodes: DataFrame
    root: str | None


def build(leaf_rows: DataFrame) -> Manifest:
    """The manifest of leaves ``(doc_id, grp, leaf, altered, salt)``.

    Leaves of a group stand in order of ``doc_id`` (null first), then leaf;
    rows equal in both may stand either way, the digests are the same. Groups
    stand in bytewise order, null first.
    """
    spark = leaf_rows.sparkSession
    rows = placed(stored(leaf_rows, "merkle-leaves"), ["grp", "doc_id", "leaf", "salt"], "merkle-placed")
    spans = stored(rows.groupBy("part", "grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-spans")
    groups = stored(placed(spans.groupBy("grp").agg(F.min("first").alias("first"), F.sum("n").alias("n")), ["grp"], "merkle-order")
                    .select("grp", "first", "n", F.col("place").alias("tree")), "merkle-groups")
    total = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    most, trees = total[0] or 0, total[1]
    of_span = spans.select("part", F.col("grp").alias("s_grp")).join(
        groups.withColumnRenamed("grp", "g_grp"), F.col("s_grp").eqNullSafe(F.col("g_grp"))).drop("g_grp").withColumnRenamed("part", "s_part")
    leaf = rows.join(of_span, (F.col("part") == F.col("s_part")) & F.col("grp").eqNullSafe(F.col("s_grp")))
    leaf = leaf.select("tree", "n", (F.col("place") - F.col("first")).alias("pos"), "doc_id", "leaf", "altered")
    runs = leaf.groupBy("tree", "n", F.floor(F.col("pos") / FANOUT).cast("long").alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "altered"))).alias("leaves"))
    runs = runs.withColumn("children", F.aggregate("leaves", F.lit(b""), lambda a, k: F.concat(a, k["leaf"])))
    lone = F.col("n") == 1
    runs = stored(runs.select(
        "tree", F.lit(1).alias("level"), F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).cast("long").alias("count"), lone.alias("lone"),
        F.when(lone, F.col("children")).otherwise(fold(F.col("children"))).alias("hash"), "children", F.lit(1).cast("long").alias("weight"), "leaves"),
        "merkle-runs")
    if not trees:
        return Manifest(runs, _links(_above(_items(runs), "merkle-level")), None)
    one = F.col("count") == 1
    level, links, tops, width = runs, [], [runs.where(one)], -(-most // FANOUT)
    while width > 1:
        level = _above(_items(level.where(~one)), "merkle-level")
        links.append(_links(level))
        tops.append(level.where(one))
        width = -(-width // FANOUT)
    columns = ["tree", "level", "pos", "count", "hash", "children", "weight"]
    top = tops[0].select(*columns)
    for more in tops[1:]:
        top = top.unionByName(more.select(*columns))
    if trees > 1:
        items = top.select(F.lit(TOP).cast("long").alias("g_tree"), F.lit(0).alias("g_level"), F.col("tree").alias("g_pos"),
                           F.lit(trees).cast("long").alias("count"), "tree", "level", "pos", "hash", "children", "weight")
        top = _above(items, "merkle-top")
        links.append(_links(top))
        width = -(-trees // FANOUT)
        while width > 1:
            top = _above(_items(top), "merkle-top")
            links.append(_links(top))
            width = -(-width // FANOUT)
    none = F.lit(None).cast("long")
    links.append(top.select("tree", "level", "pos", "hash", "children", "weight", F.lit(0).alias("slot"), none.alias("up_tree"),
                            F.lit(None).cast("int").alias("up_level"), none.alias("up_pos"), F.lit(1).cast("long").alias("up_copies"),
                            (F.col("tree") != TOP).alias("is_subroot")))
    nodes = links[0]
    for more in links[1:]:
        nodes = nodes.unionByName(more)
    root = top.select(F.lower(F.hex("hash"))).first()[0]
    return Manifest(runs, stored(nodes, "merkle-nodes"), root)


_CLIMB = """
    WITH RECURSIVE climb(tree, pos, folded, above, subroot, slot, up_tree, up_level, up_pos, pick) AS (
        SELECT tree, pos, folded, above, subroot, slot, up_tree, up_level, up_pos, pick FROM {anchors}
        UNION ALL
        SELECT c.tree, c.pos,
               transform(c.folded, f -> unhex(sha2(lower(hex(concat(
                   substring(n.children, 1, c.slot * 32), f, substring(n.children, c.slot * 32 + 33)))), 256))),
               concat(c.above, substring(n.children, 1, c.slot * 32), substring(n.children, c.slot * 32 + 33)),
               coalesce(c.subroot, if(n.is_subroot, n.hash, NULL)),
               n.slot, n.up_tree, n.up_level, n.up_pos, pmod(xxhash64(c.tree, c.pos), n.up_copies)
        FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND c.pick = n.copy)
    SELECT tree, pos, folded, above, subroot FROM climb WHERE up_tree IS NULL"""


def climb(manifest: Manifest) -> DataFrame:
    """``(tree, pos, folded, above, subroot)`` of every run, at the root.

    ``folded`` holds the roots that follow from the run as it is and with each
    altered leaf in its place, ``above`` the siblings over the run, level by
    level, left to right.
    """
    spark = manifest.runs.sparkSession
    own = manifest.nodes.where(F.col("level") == 1).where(F.col("tree") != TOP).select(
        F.col("tree").alias("n_tree"), F.col("pos").alias("n_pos"), "slot", "up_tree", "up_level", "up_pos", "up_copies", "is_subroot")
    changed = F.filter("leaves", lambda k: k["altered"].isNotNull())
    at = lambda k: F.pmod(k["pos"], F.lit(FANOUT)).cast("int")

    def in_place(k):
        c = F.col("children")
        return fold(F.concat(F.substring(c, F.lit(1), at(k) * DIGEST), k["altered"], F.substring(c, at(k) * DIGEST + DIGEST + 1, F.lit(FANOUT * DIGEST))))

    as_is = F.when(F.col("lone"), F.col("children")).otherwise(fold(F.col("children")))
    folded = F.concat(F.array(as_is), F.transform(changed, lambda k: F.when(F.col("lone"), k["altered"]).otherwise(in_place(k))))
    anchors = manifest.runs.join(own, (F.col("tree") == F.col("n_tree")) & (F.col("pos") == F.col("n_pos"))).select(
        "tree", "pos", folded.alias("folded"), F.lit(b"").alias("above"), F.when(F.col("is_subroot"), F.col("hash")).alias("subroot"),
        "slot", "up_tree", "up_level", "up_pos", F.pmod(F.xxhash64("tree", "pos"), F.col("up_copies")).alias("pick"))
    nodes = manifest.nodes.where(F.col("children").isNotNull()).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("weight")) - 1)).alias("copy"))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        return stored(spark.sql(_CLIMB, anchors=anchors, nodes=nodes), "merkle-climb")
    finally:
        spark.conf.set(limit, before)


def audit(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, siblings, folded_root, verified)``, one row per leaf.

    ``leaf``, ``subroot`` and ``root`` are those of the manifest, in hex,
    ``siblings`` the hex digests from the leaf's own run up to the root;
    ``folded_root`` is what the altered leaf (without one: the leaf) folds to
    with them.
    """
    if manifest.root is None:
        spark = manifest.runs.sparkSession
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, siblings string, folded_root string, verified boolean")
    up = climb(manifest).select(F.col("tree").alias("c_tree"), F.col("pos").alias("c_pos"), "folded", "above", "subroot")
    runs = manifest.runs.select("tree", "pos", "children", "leaves").join(up, (F.col("tree") == F.col("c_tree")) & (F.col("pos") == F.col("c_pos")))
    hexed = lambda c: F.lower(F.hex(c))
    # the altered leaves' folds stand after the first, in the order of leaves
    number = F.size(F.filter("leaves", lambda k: k["altered"].isNotNull() & (k["pos"] <= F.col("k.pos"))))
    each = runs.select("children", "folded", "above", "subroot", "leaves", F.explode("leaves").alias("k"))
    slot = F.pmod("k.pos", F.lit(FANOUT)).cast("int")
    beside = F.concat(F.substring(F.col("children"), F.lit(1), slot * DIGEST),
                      F.substring(F.col("children"), slot * DIGEST + DIGEST + 1, F.lit(FANOUT * DIGEST)), F.col("above"))
    picked = F.when(F.col("k.altered").isNull(), F.col("folded")[0]).otherwise(F.get("folded", number))
    out = each.select(F.col("k.doc_id").alias("doc_id"), hexed("k.leaf").alias("leaf"), hexed("subroot").alias("subroot"),
                      F.lit(manifest.root).alias("root"), hexed(beside).alias("siblings"), hexed(picked).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
