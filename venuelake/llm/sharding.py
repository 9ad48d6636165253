"""Documents in shards of bounded size by extendible hashing, in DataFrame functions.

A document's bits are 60 bits of a digest of its id, then 60 bits of a digest of its input
row, which tell apart rows that share an id. The directory starts as one bucket; a bucket
over the byte limit is split on its next bit, all others stay, so a shard is the shortest
prefix of bits whose documents fit. Sizes are summed by a prefix that is some bits finer
than even shards would need, and the directory is read off these sums; only rows of cells
that are still too large take part in the next round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.llm.tables import numbered, written

LIMIT_BYTES = 2 << 20
DIGEST_BITS = 60
#: Bits by which cells are finer than even shards, and bits added in each further round.
FINER = 3


def digest_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 digest of a text, as text."""
    number = F.conv(F.substring(F.md5(value), 1, DIGEST_BITS // 4), 16, 2)
    return F.lpad(number, DIGEST_BITS, "0")


def _directory(cells: DataFrame, base: int, depth: int, limit: int, last: bool) -> DataFrame:
    """For every cell (a prefix of ``depth`` bits) the shortest prefix from ``base`` bits on that fits, or null."""
    prefix = F.substring("cell", 1, F.col("d")).alias("shard")
    above = cells.select("*", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("d")).select("*", prefix)
    sizes = above.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.lit(last) & (F.length("shard") == depth))
    found = above.select("cell", "d", "shard").join(sizes.where(fits), "shard")
    best = found.groupBy("cell").agg(F.min_by(F.struct("shard", "shard_bytes", "shard_rows"), "d").alias("s"))
    return cells.select("cell").join(best, "cell", "left").select("cell", "s.*")


def assign_shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES, row: str | None = None
) -> DataFrame:
    """Rows (row, doc_id, bytes, shard, shard_bytes, shard_rows), one per document.

    ``shard`` is the bucket's bits; the empty text while one bucket takes all. ``bytes`` are those
    of the text in UTF-8, 0 for null. A shard exceeds the limit only if it is one document that
    does. Null ids share one digest and are told apart by row, like repeated ids. Other columns
    are not read; an empty table gives no rows. ``row`` names a column that numbers the rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    own = docs.select(
        number.alias("row"), F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes"),
    )
    ident = digest_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = written(
        own.withColumn("bits", F.concat(ident, digest_bits(F.col("row").cast("string")))), "sharding-rows"
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth, base, open_rows, done = max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER, 0, rows, []
    while True:
        last = depth >= 2 * DIGEST_BITS
        depth = min(depth, 2 * DIGEST_BITS)
        keyed = open_rows.withColumn("cell", F.substring("bits", 1, depth))
        cells = written(
            keyed.groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "sharding-cells"
        )
        directory = written(_directory(cells, base, depth, limit, last), "sharding-directory")
        placed = keyed.join(directory, "cell").drop("cell")
        done.append(placed.where("shard is not null"))
        if last or directory.where("shard is null").isEmpty():
            break
        open_rows = written(placed.where("shard is null").select(*rows.columns), "sharding-open")
        base, depth = depth + 1, depth + 1 + FINER
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row", "doc_id", "bytes", "shard", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES) -> None:
    """One folder ``_shard=b...`` per shard below ``path``, all given columns kept; each shard is one file.

    A shard is bounded by ``limit`` and so is what a task writes of it.
    """
    rows = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "sharding-input", "row")
    flat = rows.select("row", F.col(f"doc.`{doc_id}`").alias("doc_id"), F.col(f"doc.`{text}`").alias("text"))
    shards = assign_shards(flat, limit=limit, row="row").select("row", F.concat(F.lit("b"), "shard").alias("_shard"))
    placed = rows.join(shards, "row").select("_shard", "doc.*")
    placed.repartitionByRange("_shard").write.partitionBy("_shard").parquet(path)
