"""Merkle manifest of a table: a tree for each group, and one over their roots.

Every ``FAN`` consecutive nodes of a level become their digest, until one is left. Only every ``KEPT``-th
level is stored, as rows of one aligned subtree each (``FAN ** KEPT`` nodes, fewer at the end). A proof
regenerates the levels between inside its subtree, takes the siblings from them and forgets the rest, so
that no task holds more than one subtree and the siblings above it.

Digests are SHA-256 in lowercase hex, over digests as hex text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import shuffle_width, written
from statlake.operators.ranking import number_rows

#: Children of a node; levels from one stored level to the next.
FAN, KEPT = 8, 3
#: A proof: for each level the left and the right siblings' digests, each as one text.
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def row_digest(fields: Sequence[Column]) -> Column:
    """Digest of the values: each ``-`` if null, else its count of UTF-8 bytes, a colon and itself."""
    texts = [field.cast("string") for field in fields]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*[F.coalesce(t, F.lit("-")) for t in sized])


@dataclass
class Forest:
    """Stored levels of the trees of one table, lowest first.

    ``levels[0]`` has (tree, block, height, nodes, rows): an aligned run of leaves and what came with
    them; the others (tree, block, height, nodes), the nodes being the tops of the blocks below.
    ``height`` is the number of levels that a block reaches up. ``roots`` has (tree, root, group).
    """

    levels: list[DataFrame]
    roots: DataFrame


def _parents(nodes: Column) -> Column:
    """The next level above ``nodes``."""
    last = ((F.size(nodes) + (FAN - 1)) / FAN).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256))


def _regenerated(blocks: DataFrame) -> DataFrame:
    """With ``n0`` to ``n<KEPT>``: the levels of each block; above its height its top again."""
    out = blocks.withColumn("n0", F.col("nodes"))
    for level in range(KEPT):
        below = F.col(f"n{level}")
        out = out.withColumn(f"n{level + 1}", F.when(F.col("height") > level, _parents(below)).otherwise(below))
    return out


def _heights(nodes: DataFrame) -> DataFrame:
    """(tree, height): levels above ``nodes`` in one step, ``KEPT`` unless the tree ends sooner."""
    n = F.col("n")
    height = F.lit(KEPT)
    for level in reversed(range(KEPT)):
        height = F.when(n <= FAN**level, F.lit(level)).otherwise(height)
    return nodes.groupBy("tree").agg(F.count("*").alias("n")).select("tree", height.alias("height"))


def _blocks(nodes: DataFrame, carried: Sequence[str], label: str) -> DataFrame:
    """Rows (tree, place, digest, ...) as stored blocks of aligned subtrees."""
    width = FAN**KEPT
    cut = nodes.withColumn("block", F.floor(F.col("place") / width).cast("bigint"))
    run = F.sort_array(F.collect_list(F.struct("place", "digest", *carried)))
    grouped = cut.groupBy("tree", "block").agg(run.alias("run")).join(_heights(nodes), "tree")
    digests = F.transform("run", lambda r: r["digest"]).alias("nodes")
    if carried:
        return written(grouped.select("tree", "block", "height", digests, F.transform("run", lambda r: F.struct(*[r[c].alias(c) for c in carried])).alias("rows")), label)
    return written(grouped.select("tree", "block", "height", digests), label)


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``place``, from 0 within each group along ``order``, nulls first.

    Rows are dealt by ranges of (group, order), so that a group of any size is numbered in slices.
    """
    ranged = df.repartitionByRange(shuffle_width(df), *group, *order).withColumn("__part", F.spark_partition_id())
    # Written before it is numbered: a task run again must not deal rows anew.
    held = written(ranged, "merkle-ranges")
    return number_rows(held, group, [F.col(c) for c in order], [F.col("__part")], "place", start=0).drop("__part")


def plant(leaves: DataFrame, group: str, order: Sequence[str], carried: Sequence[str]) -> Forest:
    """The trees over ``leaves`` (with column ``digest``), one for each value of ``group``, null too."""
    ordered = written(placed(leaves, [group], [*order, "digest"]), "merkle-leaves")
    names = ordered.groupBy(group).agg(F.count("*").alias("n"))
    trees = written(placed(names, [], [group]).withColumnRenamed("place", "tree"), "merkle-trees")
    found = trees.select(F.col(group).alias("__group"), "tree")
    joined = ordered.join(found, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    levels = [_blocks(joined.select("tree", "place", "digest", *carried), carried, "merkle-level")]
    most = trees.agg(F.max("n")).first()[0] or 0
    while most > 1:
        most = -(-most // FAN**KEPT)
        tops = _regenerated(levels[-1]).select("tree", F.col("block").alias("place"), F.col(f"n{KEPT}")[0].alias("digest"))
        if most > 1:
            levels.append(_blocks(tops, [], "merkle-level"))
    top = _regenerated(levels[-1]).select("tree", F.col(f"n{KEPT}")[0].alias("root"))
    return Forest(levels, written(top.join(trees.select("tree", F.col(group).alias("group")), "tree"), "merkle-roots"))


def _siblings(level: int, at: Column) -> Column:
    """Left and right siblings of node ``at`` of ``n<level>``."""
    nodes = F.col(f"n{level}")
    inside = at % FAN
    left = F.array_join(F.slice(nodes, at - inside + 1, inside), "")
    right = F.array_join(F.slice(nodes, at + 2, F.lit(FAN - 1) - inside), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _steps(at: Column) -> Column:
    """The proof inside a block for node ``at`` of its lowest level."""
    found = F.lit(None).cast(PROOF)
    for height in range(KEPT + 1):
        steps = [_siblings(level, F.floor(at / FAN**level).cast("int")) for level in range(height)]
        found = F.when(F.col("height") == height, F.array(*steps) if steps else F.array().cast(PROOF)).otherwise(found)
    return found


def proofs(forest: Forest) -> DataFrame:
    """(tree, every carried column, leaf, proof): a proof from each leaf to the root of its tree.

    From the top level down each block's siblings follow those found above it; a block's proof is
    joined to the block, not to its leaves.
    """
    above = None
    for number in reversed(range(len(forest.levels))):
        blocks = _regenerated(forest.levels[number])
        if above is None:
            blocks = blocks.withColumn("above", F.array().cast(PROOF))
        else:
            blocks = blocks.join(above, ["tree", "block"])
        rest = F.col("above")
        if number:
            at = F.col("block") * FAN**KEPT
            found = F.transform("nodes", lambda _, i: F.struct((at + i).alias("block"), F.concat(_steps(i), rest).alias("above")))
            above = blocks.select("tree", F.explode(found).alias("f")).select("tree", "f.block", "f.above")
    found = F.transform("rows", lambda r, i: F.struct(r.alias("row"), F.col("nodes")[i].alias("leaf"), F.concat(_steps(i), rest).alias("proof")))
    return blocks.select("tree", F.explode(found).alias("f")).select("tree", "f.row.*", "f.leaf", "f.proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and a proof give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one text, level by level."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(leaves: DataFrame, group: str, order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Every leaf with its proof up to the one root of the table.

    ``leaves`` has ``digest``, the ``group`` whose value names its tree, the columns of its ``order``
    there, and columns that are carried along. Returns the carried columns, leaf, subroot, root, proof.
    The trees' roots are the leaves of the tree above, ordered by group, nulls first.
    """
    forest = plant(leaves, group, order, carried)
    tops = forest.roots.select(F.lit(0).alias("all"), F.col("group"), F.col("tree").alias("of"), F.col("root").alias("digest"))
    crown = plant(tops, "all", ["group"], ["of"])
    over = proofs(crown).join(crown.roots.select("tree", "root"), "tree")
    over = over.select(F.col("of").alias("tree"), F.col("leaf").alias("subroot"), "root", F.col("proof").alias("__over"))
    joined = proofs(forest).join(over, "tree")
    return joined.select(*carried, "leaf", "subroot", "root", F.concat("proof", "__over").alias("proof"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified(docs: DataFrame, tampered: Column, fields: Sequence[str] = FIELDS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: each row checked against the manifest.

    ``tampered`` is the text that a reader holds now; its leaf is folded with the siblings of the
    original. Trees are by ``lang`` and ordered by ``doc_id``, rows of equal id by their digest, null ids
    first; a null lang has a tree of its own. Nulls in any field have their own digest, repeated rows are
    leaves of their own, other columns are ignored, and an empty table gives an empty result.
    """
    table = docs.select(*[F.col(f"`{name}`") for name in fields])
    now = [tampered if name == "text" else F.col(name) for name in fields]
    leaves = table.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang",
        row_digest([F.col(name) for name in fields]).alias("digest"), row_digest(now).alias("held"),
    )
    found = manifest(written(leaves, "merkle-digests"), "lang", ["doc_id"], ["doc_id", "held"])
    checked = found.withColumn("folded_root", folded(F.col("held"), F.col("proof")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings(F.col("proof"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def every_third_lowered() -> Column:
    """The text with A-Z in lower case where 3 divides the CRC-32 of the decimal doc_id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(chosen, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
