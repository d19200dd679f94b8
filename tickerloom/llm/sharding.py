"""Sharding by a hierarchical weighted hash tree [native].

A row descends region, rack and shard. At every node each child draws ``-ln(u) / weight``, with ``u``
a hash of the row's key and the child's path, and the smallest draw wins, so a child is chosen with
probability proportional to its weight. A node weighs what its shards weigh. As a draw depends on
the key, the child's path and the child's weight only, a changed weight moves rows into or out of
the subtrees whose weight changed and nowhere else.

Defined cases: a null key counts as the empty text (all such rows go to one shard, their slots still
count apart); a null text has no bytes; repeated rows each get a slot; no rows give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import fresh, materialise


@dataclass(frozen=True)
class Node:
    """A shard (``shard`` set) or an inner node; paths are ``region/rack/shard``."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(regions: dict[str, dict[str, dict[int, float]]]) -> Node:
    """``{region: {rack: {shard: weight}}}`` as a tree; a weight of 0 takes no rows."""
    return Node(
        "",
        tuple(
            Node(region, tuple(Node(rack, tuple(Node(str(s), (), s, float(w)) for s, w in shards.items())) for rack, shards in racks.items()))
            for region, racks in regions.items()
        ),
    )


def grown(regions: dict, shard: int, weight: float = 1.0) -> dict:
    """The same tree with one more shard, in a region and rack of its own.

    In a rack of its own the shard is all of the subtree whose weight changes. Added to an existing
    rack it would make that rack heavier, and rows that come into the rack could land in its old shards.
    """
    return {**regions, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def _draw(key: Column, path: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(path + "|"), key)), 11)
    return -F.ln((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(weight)


def _levels(root: Node) -> list[list[tuple[str, Node]]]:
    """Inner nodes with their paths, level by level."""
    levels, now = [], [("", root)]
    while now := [(p, n) for p, n in now if n.children]:
        levels.append(now)
        now = [(f"{p}/{c.name}", c) for p, n in now for c in n.children]
    return levels


def with_shard(rows: DataFrame, key: Column, root: Node, out: str) -> DataFrame:
    """``rows`` with the shard of each row in ``out`` (int)."""
    path = fresh(f"{out}_path", rows.columns)
    frame = rows.withColumn(path, F.lit(""))
    key = F.coalesce(key.cast("string"), F.lit(""))
    for level in _levels(root):
        chosen = None
        for at, node in level:
            live = [c for c in node.children if c.weight > 0]
            if not live:
                continue
            draws = [F.struct(_draw(key, f"{at}/{c.name}", c.weight).alias("d"), F.lit(f"{at}/{c.name}").alias("p")) for c in live]
            best = F.array_min(F.array(*draws))["p"]
            chosen = F.when(F.col(path) == at, best) if chosen is None else chosen.when(F.col(path) == at, best)
        frame = frame.withColumn(path, chosen.otherwise(F.col(path)))
    leaves = [(f"{p}/{c.name}", c.shard) for level in _levels(root) for p, n in level for c in n.children if not c.children]
    shards = F.create_map(*(F.lit(x) for leaf in leaves for x in leaf))
    return frame.withColumn(out, shards[F.col(path)].cast("int")).drop(path)


def assign_shards(docs: DataFrame, regions: dict, new_shard: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots are counted by two-pass prefix sums: rows are ranked within (shard, input partition), and an
    input partition starts where the earlier ones of the shard end. No task gets more of a shard than
    one input partition has, however many rows the shard or a key holds.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("position"),
    )
    rows = with_shard(rows, F.col("doc_id"), tree(regions), "shard")
    rows = materialise(with_shard(rows, F.col("doc_id"), tree(grown(regions, new_shard)), "grown_shard"))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("shard", "part").orderBy("position")) - 1
    return (
        rows.withColumn("rank", rank)
        .join(starts, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"), "grown_shard")
    )
