"""Order-free digests of key ranges as a tree: equal ranges of two snapshots are found without reading their rows.

A leaf is a block of keys with its number of rows and three sums over row hashes, which do not depend on the order of the rows. A
block of the level above is ``FANOUT`` blocks added up. Two trees are compared from the top; only children of differing blocks go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import SEQ
from tidemark.operators.compare import snapshot_changes
from tidemark.session import materialise

BLOCK, LEVEL = "_block", "_level"
FANOUT, DEPTH = 16, 3
#: Differing blocks up to which their folders are named to the scan; beyond it they are joined.
NAMED_BLOCKS = 10_000
_SUMS = ("n", "low", "high", "mark")


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of the values and of which of them are NULL."""
    return F.xxhash64(F.lit(seed), *sorted(columns), *[F.col(c).isNull() for c in sorted(columns)])


def leaf_digests(df: DataFrame, columns: Sequence[str], block: Column) -> DataFrame:
    """(_block, n, low, high, mark): one row a block; combined before the shuffle. Halves of the hash are added, so that sums stay whole numbers."""
    h = row_hash(columns, 1)
    return df.groupBy(block.cast("bigint").alias(BLOCK)).agg(
        F.count("*").alias("n"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high"),
        F.bit_xor(row_hash(columns, 2)).alias("mark"))


def digest_tree(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Leaves and ``depth`` levels above them, as rows (_level, _block, sums)."""
    tree = leaves.withColumn(LEVEL, F.lit(0))
    for level in range(1, depth + 1):
        up = leaves.groupBy(F.floor(F.col(BLOCK) / FANOUT ** level).cast("bigint").alias(BLOCK)).agg(
            *[F.sum(c).alias(c) for c in _SUMS[:-1]], F.bit_xor("mark").alias("mark"))
        tree = tree.unionByName(up.withColumn(LEVEL, F.lit(level)))
    return tree.select(LEVEL, BLOCK, *_SUMS)


def changed_blocks(stored: DataFrame, current: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Leaf blocks whose digests differ or that only one of the trees has."""
    parents = None
    for level in range(depth, -1, -1):
        sides = [side.where(F.col(LEVEL) == level).drop(LEVEL) for side in (stored, current)]
        if parents is not None:
            up = parents.select(F.col(BLOCK).alias("_up"))
            sides = [s.join(up, F.floor(F.col(BLOCK) / FANOUT) == F.col("_up"), "left_semi") for s in sides]
        old = sides[0].select(BLOCK, F.struct(*_SUMS).alias("_old"))
        new = sides[1].select(BLOCK, F.struct(*_SUMS).alias("_new"))
        parents = old.join(new, BLOCK, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(BLOCK)
    return parents


def write_snapshot(df: DataFrame, path: str, block: Column, depth: int = DEPTH) -> None:
    """Rows by block, then their digests: a snapshot without digests is not there yet.

    ``block`` maps a key to the number of its block; blocks should hold some thousand rows up to a file's worth.
    """
    df.withColumn(BLOCK, block.cast("bigint")).repartition(BLOCK).write.partitionBy(BLOCK).parquet(f"{path}/rows")
    digest_tree(materialise(leaf_digests(df, df.columns, block), "leaves"), depth).write.parquet(f"{path}/digests")


def stored_rows(spark: SparkSession, path: str, blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of some blocks of a snapshot; files of other blocks are not opened."""
    rows = spark.read.parquet(f"{path}/rows")
    named = blocks.limit(NAMED_BLOCKS + 1).collect()
    if len(named) <= NAMED_BLOCKS:
        return rows.where(F.col(BLOCK).isin([r[BLOCK] for r in named])).select(*columns)
    return rows.join(blocks, BLOCK, "left_semi").select(*columns)


def changes_since(spark: SparkSession, path: str, current: DataFrame, keys: Sequence[str], block: Column, seq: int = 1, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(change log from the stored snapshot to ``current``, differing blocks). Of both sides only rows of differing blocks are compared."""
    # the digests are few: written once, they are compared level by level without another scan of the rows
    tree = digest_tree(materialise(leaf_digests(current, current.columns, block), "leaves"), depth)
    blocks = materialise(changed_blocks(spark.read.parquet(f"{path}/digests"), tree, depth), "blocks")
    fresh = current.withColumn(BLOCK, block.cast("bigint")).join(blocks, BLOCK, "left_semi").drop(BLOCK)
    log = snapshot_changes(stored_rows(spark, path, blocks, current.columns), fresh, keys, seq)
    return log.withColumn(SEQ, F.lit(seq).cast("bigint")), blocks
