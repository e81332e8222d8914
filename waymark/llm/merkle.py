"""Merkle dataset manifest with parent-preimage paths.

A leaf is the hash of a document's fields; every FAN consecutive nodes of a source, in order, become the hash of
their concatenation until one is left, its subroot; the sources' subroots in turn become the root. What a parent is hashed
from, its children's hashes one after the other, is stored per parent. A leaf's path is its ancestors' preimages:
cutting its own slot of 64 characters out of each gives its siblings, splicing another hash in and hashing folds it upward.

Nodes are grouped by BLOCK consecutive ones of a source, so that a source of any size is many bounded groups, several
levels are made in a row without a shuffle, and each further round has a BLOCK-th of the rows. A block keeps each preimage
once; its nodes' paths are put together as it is taken apart, and are never stored, sorted or sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import in_order, before_parts, join_to_groups, materialize, numbered

FAN, LEVELS = 3, 5
BLOCK = FAN**LEVELS
DIGEST = 64  # characters of a hash
#: Of a stored row group of blocks, each some 70 KB.
GROUP_BYTES = 16 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a path: where a node's slot begins in its parent's preimage, counted from 0, and the preimage.
PATH = "array<struct<slot:int,preimage:string>>"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """'-' for null, else its length in bytes, a colon and itself, so that no two rows concatenate alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of FIELDS, some of them changed."""
    return sha256(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]))


def siblings(step: Column) -> Column:
    """A preimage without the node's own slot."""
    return F.concat(F.substring(step["preimage"], F.lit(1), step["slot"] * DIGEST), F.substring(step["preimage"], (step["slot"] + 1) * DIGEST + 1, F.char_length(step["preimage"])))


def proof(path: Column) -> Column:
    """All siblings, level by level upward, left to right."""
    return F.array_join(F.transform(path, siblings), "")


def folded(node: Column, path: Column) -> Column:
    """The root that a node comes to: its hash is spliced into each preimage, whose hash goes on."""
    spliced = lambda h, s: F.concat(F.substring(s["preimage"], F.lit(1), s["slot"] * DIGEST), h, F.substring(s["preimage"], (s["slot"] + 1) * DIGEST + 1, F.char_length(s["preimage"])))
    return F.aggregate(path, node, lambda h, s: sha256(spliced(h, s)))


def levels_above(n: Column) -> Column:
    """How often n nodes become a FAN-th until one is left."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k) for k in range(39)]), lambda reach: reach < n))


def blocks(nodes: DataFrame, label: str) -> DataFrame:
    """group, block, root, above, pre, e for nodes (group, idx, n, hash, own), where idx counts from 0 to n - 1 within a group.

    e: the block's nodes in order (idx, hash, own); pre: the block's preimages by level; above: the path from the block's top to the group's root.
    """
    entry = F.struct("idx", "hash", "own")
    made = nodes.groupBy("group", "n", F.floor(F.col("idx") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    made = made.withColumn("h0", F.col("e.hash")).withColumn("levels", F.least(levels_above(F.col("n")), F.lit(LEVELS)))
    for k in range(LEVELS):  # each level is a projection of its own, so that no hash is worked out twice; beyond the last, hashes pass on
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(f"h{k}") - 1) / FAN).cast("int")), lambda i: F.array_join(F.slice(f"h{k}", i * FAN + 1, F.lit(FAN)), ""))  # noqa: B023
        made = made.withColumn(f"p{k}", F.when(F.col("levels") > k, runs)).withColumn(f"h{k + 1}", F.when(F.col("levels") > k, F.transform(f"p{k}", sha256)).otherwise(F.col(f"h{k}")))
    pre = F.filter(F.array(*[f"p{k}" for k in range(LEVELS)]), lambda p: p.isNotNull())
    made = materialize(made.select("group", "n", "block", F.element_at(f"h{LEVELS}", 1).alias("top"), pre.alias("pre"), "e"), label, GROUP_BYTES)
    none = F.array().cast(PATH)
    upper = made.where(F.col("n") > BLOCK).select("group", F.col("block").alias("idx"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("top").alias("hash"), F.lit(0).alias("own"))
    if not upper.take(1):
        return made.select("group", "block", F.col("top").alias("root"), none.alias("above"), "pre", "e")
    above = nodes_of(blocks(upper, f"{label}-above")).select("group", F.col("idx").alias("block"), F.col("path").alias("above"), "root")
    return made.join(above, ["group", "block"], "left").select("group", "block", F.coalesce("root", "top").alias("root"), F.coalesce("above", none).alias("above"), "pre", "e")


def nodes_of(made: DataFrame, *more: str) -> DataFrame:
    """group, root, idx, hash, own, path and more for each node of blocks()."""
    slot = lambda k, i: F.pmod(F.floor(i / F.pow(F.lit(FAN), k)), F.lit(FAN)).cast("int")
    step = lambda p, k, i: F.struct(slot(k, i).alias("slot"), F.element_at(p, (F.floor(i / F.pow(F.lit(FAN), k + 1)) + 1).cast("int")).alias("preimage"))
    placed = F.transform("e", lambda e, i: F.struct(e["idx"].alias("idx"), e["hash"].alias("hash"), e["own"].alias("own"), F.transform("pre", lambda p, k: step(p, k, i)).alias("path")))
    each = made.select("group", "root", "above", *more, F.explode(placed).alias("e"))
    return each.select("group", "root", *more, "e.idx", "e.hash", "e.own", F.concat("e.path", "above").cast(PATH).alias("path"))


def manifest(docs: DataFrame, **carried: Column) -> DataFrame:
    """doc_id, idx (within its source), leaf, subroot, root and path for every row of docs, with carried columns over docs.

    A null field is told from an empty one. Sources stand by their bytes, null first; within a source leaves stand by doc_id,
    null first, those of one doc_id by their hash, so that equal rows have equal leaves and places next to each other. A lone
    leaf is its subroot, a lone subroot the root. Texts of any length are hashed whole, once, and never shuffled. An
    empty table gives an empty table. Columns besides FIELDS and those that carried names are not read.
    """
    told = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf().alias("leaf"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in carried.items()]).alias("more")), "merkle-leaves")
    placed = in_order(told, [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf")], "merkle-places")
    placed = placed.join(before_parts(placed, {"at": F.lit(1).cast("long")}), "part").withColumn("at", F.col("at") + F.col("place"))
    sources = numbered(placed.groupBy("source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), [F.col("source").asc_nulls_first()], "merkle-sources", "group")
    leaves = join_to_groups(placed, sources, "source", F.col("at"))
    nodes = leaves.select("group", "n", (F.col("at") - F.col("first")).alias("idx"), F.col("leaf").alias("hash"), F.struct("doc_id", "more").alias("own"))
    made = blocks(nodes, "merkle-blocks")
    subroots = made.where("block = 0").select(F.lit(0).alias("group"), F.col("group").alias("idx"), F.col("root").alias("hash"), F.lit(0).alias("own"))
    subroots = subroots.join(F.broadcast(sources.agg(F.count(F.lit(1)).alias("n"))))  # one row
    tops = materialize(nodes_of(blocks(subroots, "merkle-tops")).select(F.col("idx").alias("group"), F.struct("root", "path").alias("top")), "merkle-root")
    out = nodes_of(join_to_groups(made, tops, "group", F.col("block")), "top")
    return out.select("own.doc_id", "idx", F.col("hash").alias("leaf"), F.col("root").alias("subroot"), F.col("top.root").alias("root"), F.concat("path", "top.path").alias("path"), *[F.col(f"own.more.{n}").alias(n) for n in carried])


def verified(told: DataFrame, node: str) -> DataFrame:
    """told, of manifest(), with folded_root, which the leaf in column node comes to along the stored path, and verified, whether that is the root."""
    return told.withColumn("folded_root", folded(F.col(node), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))


def without_newlines() -> Column:
    """A leaf after tampering: where 2 divides the CRC-32 of the decimal doc_id, the text has lost its newlines."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return leaf(text=F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text")))
