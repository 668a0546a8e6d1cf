"""ORD1/RET5 without a global sort: a table of lines, clustered by file and sorted by offset.

A file's lines are cut into parts of ``part_bytes``, and a part lies whole in one bucket of the table, sorted: so
a file with a third of all lines is many parts in many buckets.  The bucket follows from path and part alone, so a file or
a line is found by reading the buckets of its parts; and whatever is computed per part (line numbers, neighbours)
needs no exchange, because Spark knows that a bucket holds whole parts.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

PART_BYTES = 64 << 20
#: About this many bytes of lines per bucket.
BUCKET_BYTES = 64 << 20
#: Row groups of this size, so that a scan splits a bucket's file into many tasks.
ROW_GROUP_BYTES = 8 << 20
#: A file of more parts is read in order by a sort of its own instead of a union with a branch per part.
MAX_BRANCHES = 200
LINES = T.StructType().add("slot", "long").add("path", "string").add("part", "long").add("offset", "long").add("line", "string")
PARTS = T.StructType().add("path", "string").add("part", "long").add("lines", "long").add("before", "long")
META = T.StructType().add("buckets", "long").add("part_bytes", "long")


def slot(path, part):
    """What a part's bucket is derived from."""
    return F.xxhash64(path, part)


class LineStore:
    """The table under ``out``: ``lines`` (bucketed), ``parts`` (a row per part) and ``meta``."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.buckets, self.part_bytes = spark.read.schema(META).json(f"{self.out}/meta").first()

    @classmethod
    def write(cls, docs: DataFrame, out: str, buckets: int | None = None, part_bytes: int = PART_BYTES, size: int | None = None) -> "LineStore":
        """Write ``docs`` (path, offset, line).  The number of buckets follows from the bytes of the lines, their ends
        included, which are counted unless ``size`` gives them."""
        spark, out = docs.sparkSession, out.rstrip("/")
        if buckets is None:
            if size is None:
                size = docs.agg(F.sum(F.octet_length("line") + 1)).first()[0] or 0
            buckets = max(1, -(-size // BUCKET_BYTES))
        part = F.floor(F.col("offset") / part_bytes).cast("long")
        rows = docs.select("path", part.alias("part"), "offset", "line").select(slot("path", "part").alias("slot"), "path", "part", "offset", "line")
        order = ["slot", "path", "part", "offset"]
        name = f"linedocs_write_{uuid.uuid4().hex}"
        # dealt as the buckets are, so a task writes one file per bucket of its own
        (rows.repartition(buckets, "slot").sortWithinPartitions(*order).write.format("parquet")
             .option("parquet.block.size", ROW_GROUP_BYTES).bucketBy(buckets, "slot").sortBy(*order).option("path", f"{out}/lines").saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
        spark.createDataFrame([(buckets, part_bytes)], META).coalesce(1).write.mode("overwrite").json(f"{out}/meta")
        store = cls(spark, out)
        counts = store.lines().groupBy("slot", "path", "part").agg(F.count("*").alias("lines"))
        before = F.sum("lines").over(Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        counts.select("path", "part", "lines", F.coalesce(before, F.lit(0)).alias("before")).write.mode("overwrite").parquet(f"{out}/parts")
        return store

    def lines(self) -> DataFrame:
        """All lines, with the bucketing declared (tables are known to their session only)."""
        name = "linedocs_lines_" + uuid.uuid5(uuid.NAMESPACE_URL, f"{self.out}?{self.buckets}").hex
        quoted = self.out.replace("\\", "\\\\").replace("'", "\\'")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LINES)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (slot) SORTED BY (slot, path, part, `offset`) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{quoted}/lines'")
        return self.spark.table(name)

    def parts(self) -> DataFrame:
        return self.spark.read.schema(PARTS).parquet(f"{self.out}/parts")

    def numbered(self) -> DataFrame:
        """ORD1: path, line_no (from 0), offset, line.  Numbers within a part come from its order in the bucket, those of
        the parts before it from the parts table: no line is exchanged."""
        within = Window.partitionBy("slot", "path", "part").orderBy("offset")
        own = self.lines().withColumn("k", F.row_number().over(within) - 1)
        # only files of several parts have lines before a part
        later = self.parts().where("before > 0").select(slot("path", "part").alias("_slot"), F.col("path").alias("_path"), F.col("part").alias("_part"), "before")
        on = (F.col("slot") == F.col("_slot")) & F.col("path").eqNullSafe(F.col("_path")) & (F.col("part") == F.col("_part"))
        return own.join(later, on, "left").select("path", (F.coalesce("before", F.lit(0)) + F.col("k")).cast("long").alias("line_no"), "offset", "line")

    def _of_parts(self, path: str, parts: list[int]) -> DataFrame:
        """Lines of some parts of a file: only their buckets are read."""
        slots = [r[0] for r in self.spark.createDataFrame([(path, p) for p in parts], "path string, part long").select(slot("path", "part")).collect()]
        return self.lines().where(F.col("slot").isin(slots) & (F.col("path") == path) & F.col("part").isin(parts)).select("path", "part", "offset", "line")

    def file_in_order(self, path: str) -> DataFrame:
        """ORD1 of one file: its lines, in order, a partition per part and no exchange."""
        parts = sorted(r["part"] for r in self.parts().where(F.col("path") == path).select("part").collect())
        if not parts:
            return self.lines().where("false").select("path", "offset", "line")
        if len(parts) > MAX_BRANCHES:
            return self._of_parts(path, parts).orderBy("offset").select("path", "offset", "line")
        ordered = [self._of_parts(path, [p]).coalesce(1).sortWithinPartitions("offset") for p in parts]
        return reduce(DataFrame.union, ordered).select("path", "offset", "line")

    def at(self, path: str, offset: int) -> DataFrame:
        """RET5: the line at an offset of a file, from one bucket."""
        return self._of_parts(path, [offset // self.part_bytes]).where(F.col("offset") == offset).select("path", "offset", "line")
