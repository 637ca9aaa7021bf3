"""Which URLs earlier runs have had, kept as sorted segments behind bitmap filters.

A run adds one segment: its new URLs, dealt into slots by hash. Beside each segment lies a filter
of sixteen bits a URL. A batch asks the filters first, and opens only the slots of segments whose
filter says that they may hold one of its URLs; so a run does not read what earlier runs wrote,
beyond the filters and what it has in common with them. Segments are merged by levels (see
``operators.segments``).

A run's segment, filter and rows count together; a run that is repeated gives the rows it gave
before. URLs are compared as they are; hashes only lead to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.urls import url_base
from stormledger.operators.dedup import keep_first
from stormledger.operators.segments import FANOUT, Segment, Segments
from stormledger.storage import durable

SLOTS = 64
BITS_PER_URL = 16
BUCKET_BITS = 15  # a row of a filter has so many bits, as Spark's bitmaps have
_KEYS = ("_base", "_hash", "slot_")  # a folder named _slot=… would be hidden
_KEY_DDL = "_base string, _hash bigint, slot_ int"


class SeenUrls:
    """The index below one folder."""

    def __init__(self, spark: SparkSession, root: str, slots: int = SLOTS, fanout: int = FANOUT):
        self.spark, self.slots = spark, slots
        self.table = Segments(spark, root, ("segments", "filters"), ("rows",), fanout)
        self.opened: list[tuple[str, int]] = []  # (segment, slot) that the last batch looked into

    def add(self, run_id: str, batch: DataFrame, url: str, *order: Column | str) -> DataFrame:
        """The batch's first row of every URL (without its query part) that no earlier run had.

        ``order`` says which row of a batch is the first. Rows with a NULL URL count as one URL.
        The names ``_base``, ``_hash`` and ``slot_`` must be free.
        """

        def write(folder: dict[str, str]) -> dict:
            based = batch.withColumn("_base", url_base(F.col(url)))
            placed = keep_first(based, ["_base"], *order).withColumn("_hash", F.xxhash64("_base"))
            slot = F.pmod("_hash", F.lit(self.slots)).cast("int")
            first = durable(placed.withColumn("slot_", slot))
            known = self._known(first.select(*_KEYS))
            fresh = first.alias("f").join(known.alias("k"), _same_url("f", "k"), "left_anti")
            fresh.write.parquet(folder["rows"])
            return self._write_segment(
                self.spark.read.parquet(folder["rows"]).select(*_KEYS), folder
            )

        self.table.add(run_id, write)
        self.table.merge_levels(self._merge)
        return self.rows(run_id)

    def rows(self, run_id: str) -> DataFrame:
        """What a run added."""
        return self.spark.read.parquet(self.table.path("rows", run_id)).drop(*_KEYS)

    def segments(self) -> list[Segment]:
        return self.table.live()

    def _write_segment(self, keys: DataFrame, folder: dict[str, str]) -> dict:
        size = keys.count()
        bits = 1 << max(BUCKET_BITS, (BITS_PER_URL * size - 1).bit_length())
        dealt = keys.repartition("slot_").sortWithinPartitions("slot_", "_hash")
        dealt.write.partitionBy("slot_").parquet(folder["segments"])
        place = F.col("_hash").bitwiseAND(F.lit(bits - 1))
        (
            keys.groupBy(F.shiftright(place, BUCKET_BITS).alias("bucket"))
            .agg(F.bitmap_construct_agg(_bit(place)).alias("bits"))
            .write.parquet(folder["filters"])
        )
        return {"rows": size, "bits": bits}

    def _merge(self, run_ids: list[str], folder: dict[str, str]) -> dict:
        return self._write_segment(self.table.read("segments", run_ids, _KEY_DDL), folder)

    def _filters(self, live: list[Segment]) -> DataFrame:
        out = None
        for s in live:
            part = self.table.read("filters", [s.run_id], "bucket bigint, bits binary")
            part = part.withColumn("segment", F.lit(s.run_id))
            out = part if out is None else out.unionByName(part)
        return out

    def _known(self, keys: DataFrame) -> DataFrame:
        """The keys that the live segments hold."""
        live = self.segments()
        self.opened = []
        if not live:
            return keys.limit(0)
        named = [
            F.struct(
                F.lit(s.run_id).alias("segment"),
                F.lit(s.totals["bits"]).cast("bigint").alias("size"),
            )
            for s in live
        ]
        asked = keys.select(*_KEYS, F.explode(F.array(*named)).alias("s")).select(
            *_KEYS, "s.segment", F.expr("_hash & (s.size - 1)").alias("place")
        )
        byte = F.hex(F.expr("substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)"))
        maybe = durable(
            asked.select(
                *_KEYS,
                "segment",
                F.shiftright("place", BUCKET_BITS).alias("bucket"),
                _bit(F.col("place")).alias("bit"),
            )
            .join(self._filters(live), ["segment", "bucket"])
            .withColumn("byte", F.conv(byte, 16, 10).cast("int"))
            .where("shiftright(byte, CAST(bit % 8 AS INT)) & 1 = 1")
            .select(*_KEYS, "segment")
        )
        places = maybe.select("segment", "slot_").distinct().collect()
        self.opened = sorted((r.segment, r.slot_) for r in places)
        found = keys.limit(0)
        for name in sorted({segment for segment, _ in self.opened}):
            slots = [slot for segment, slot in self.opened if segment == name]
            held = self.table.read("segments", [name], _KEY_DDL).where(F.col("slot_").isin(slots))
            asked_of = maybe.where(F.col("segment") == name).select(*_KEYS)
            found = found.unionByName(
                asked_of.alias("f").join(held.alias("k"), _same_url("f", "k"), "left_semi")
            )
        return found


def _bit(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))


def _same_url(left: str, right: str) -> Column:
    return (F.col(f"{left}._hash") == F.col(f"{right}._hash")) & F.col(f"{left}._base").eqNullSafe(
        F.col(f"{right}._base")
    )
