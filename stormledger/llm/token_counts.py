"""Token counts by source, language and tokenizer version, maintained by deltas.

A batch of changes is signed rows: an inserted document adds one document and its tokens, a
deleted one takes them away, a revised one does both. Rows are summed per key, in each task
before the shuffle, and a batch is kept as the sums it adds. Totals are the sum over the
committed batches, so batches may come in any order.

A batch is written below ``sums/`` and then named by a one-row file below ``commits/``; it
counts from that file on. A batch that is already named is not written again, so repeating
one after a failure, or by mistake, changes nothing; one that failed half-way is written
anew. ``compact`` folds committed batches into one that names those it replaces. One writer
commits to a store at a time.

Null text is empty (no tokens, one document); null source and language are keys like others;
repeated rows count each; an empty batch is committed and adds nothing; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.llm.tokens import Encoder

KEYS = ("source", "lang", "version")
SUMS = "batch string, source string, lang string, version string, docs bigint, tokens bigint"
COMMITS = "batch string, replaces array<string>"


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(doc_id, source, lang, version, tokens) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            sizes = [len(encoder.encode(t or "")) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([version] * batch.num_rows, pa.string()),
                    pa.array(sizes, pa.int64()),
                ],
                ["doc_id", "source", "lang", "version", "tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), "text"
    ).mapInArrow(rows, f"doc_id {kind}, source string, lang string, version string, tokens bigint")


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counted documents as changes: sign 1 inserts them, -1 deletes them."""
    return counts.select(
        *KEYS, F.lit(sign).cast("bigint").alias("docs"), (F.col("tokens") * sign).alias("tokens")
    )


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that take the old counts away and add the new ones."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollup:
    """The store of sums at a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def is_committed(self, batch: str) -> bool:
        return not self._read("commits", COMMITS).where(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame, replaces: tuple[str, ...] = ()) -> bool:
        """Add a batch of changes; False where it had been committed before."""
        if self.is_committed(batch):
            return False
        sums = changes.groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        sums.where("docs <> 0 OR tokens <> 0").write.mode("overwrite").parquet(
            f"{self.path}/sums/batch={batch}"
        )
        named = self.spark.range(1).select(
            F.array(*[F.lit(r) for r in replaces]).cast("array<string>").alias("replaces")
        )
        named.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")
        return True

    def live(self) -> DataFrame:
        """Sums of the committed batches that no other replaces."""
        commits = self._read("commits", COMMITS)
        gone = commits.select(F.explode("replaces").alias("batch"))
        valid = commits.select("batch").join(gone, "batch", "left_anti")
        return self._read("sums", SUMS).join(valid, "batch", "left_semi")

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of what is there now."""
        return (
            self.live()
            .groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 OR tokens <> 0")
        )

    def compact(self, batch: str) -> bool:
        """Fold the batches that count now into one; the totals stay the same."""
        now = tuple(sorted(r.batch for r in self.live().select("batch").distinct().collect()))
        return self.commit(batch, self.live().where(F.col("batch").isin(*now)), now)
