"""A stored positional index: which texts hold which phrases, without reading the texts.

A run's texts become postings, one row for each word of each text, with the word's positions as
differences. Postings are dealt into slots by word, a frequent word over several files, and merged
by levels (see ``operators.segments``). A phrase is answered from the slots of its words alone: the
texts that hold its rarest word come first, and the positions of each further word, moved back to
where the phrase would begin, are intersected with theirs. Words are compared as they are, so
there are no false hits.

Case and punctuation do not count and words match whole, as in ``operators.phrases``. A text's ids
may occur in one run only. NULL texts have no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.functions.arrays import let, running
from stormledger.operators.phrases import normalized
from stormledger.operators.segments import FANOUT, Segment, Segments
from stormledger.storage import durable

SLOTS = 64
SPREAD = 4  # files that a slot's postings are dealt over


def _words(text: Column) -> Column:
    return F.array_remove(F.split(normalized(text), " "), "")


def _postings(words: Column) -> Column:
    """array<struct<word, steps>>: the places of every different word, each as its distance from
    the one before (the first from -1). One sort of the words with their places."""

    def runs(placed: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(placed) - 1)
        starts = F.filter(
            places,
            lambda i: (i == 0) | (F.get(placed, i)["word"] != F.get(placed, i - 1)["word"]),
        )

        def one(start: Column, next_start: Column) -> Column:
            at = lambda i: F.get(placed, i)["at"]
            steps = F.transform(  # over places of the one sorted list: no part of it is copied
                F.sequence(start, next_start - 1),
                lambda i: at(i) - F.when(i == start, F.lit(-1)).otherwise(at(i - 1)),
            )
            return F.struct(F.get(placed, start)["word"].alias("word"), steps.alias("steps"))

        return let(
            starts,
            lambda s: F.transform(
                s, lambda start, k: one(start, F.coalesce(F.get(s, k + 1), F.size(placed)))
            ),
        )

    placed = F.sort_array(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    )
    none = F.array().cast("array<struct<word:string,steps:array<int>>>")
    return let(placed, lambda p: F.when(F.size(p) > 0, runs(p)).otherwise(none))


def _places(steps: Column, back: Column | int) -> Column:
    """Positions from their steps, moved back by so many words.

    Most words occur once in a text, and their one step is the position.
    """
    several = F.transform(running(steps, lambda a, b: a + b), lambda p: p - 1 - back)
    return F.when(F.size(steps) == 1, F.array(F.get(steps, F.lit(0)) - 1 - back)).otherwise(several)


class PositionalIndex:
    """The index below one folder. ``ids`` are the columns that name a text, as DDL."""

    def __init__(
        self, spark: SparkSession, root: str, ids: str, slots: int = SLOTS, fanout: int = FANOUT
    ):
        self.spark, self.slots = spark, slots
        self.ids = [f.name for f in spark.createDataFrame([], ids).schema]
        self.ddl = f"word string, {ids}, steps array<int>, slot_ int"
        self.table = Segments(spark, root, ("postings",), fanout=fanout)

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64("word"), F.lit(self.slots)).cast("int")

    def add(self, run_id: str, texts: DataFrame, text: str) -> dict:
        """Index a run's texts. Returns the number of postings."""

        def write(folder: dict[str, str]) -> dict:
            made = F.explode(_postings(_words(F.col(text)))).alias("p")
            rows = texts.select(*self.ids, made).select("p.word", *self.ids, "p.steps")
            return self._write(rows.withColumn("slot_", self._slot()), folder)

        totals = self.table.add(run_id, write)
        self.table.merge_levels(
            lambda run_ids, folder: self._write(
                self.table.read("postings", run_ids, self.ddl), folder
            )
        )
        return totals

    def _write(self, rows: DataFrame, folder: dict[str, str]) -> dict:
        """Postings by slot, sorted by word; a slot's rows are dealt over several files."""
        part = F.pmod(F.xxhash64(*self.ids), F.lit(SPREAD))
        dealt = rows.repartition("slot_", part).sortWithinPartitions("slot_", "word")
        dealt.write.partitionBy("slot_").parquet(folder["postings"])
        written = self.spark.read.schema(self.ddl).parquet(folder["postings"])
        return {"postings": written.count()}

    def segments(self) -> list[Segment]:
        return self.table.live()

    def find(self, phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
        """(ids, phrase, places): every text that holds a phrase, and the words it begins at."""
        listed = durable(
            phrases.select(F.col(phrase).alias("_phrase"))
            .distinct()
            .select("_phrase", _words(F.col("_phrase")).alias("_words"))
            .where(F.size("_words") > 0)
        )
        wanted = listed.select(F.explode("_words").alias("word")).distinct()
        slots = [r[0] for r in wanted.select(self._slot()).distinct().collect()]  # of few
        postings = self.table.read("postings", [s.run_id for s in self.segments()], self.ddl)
        held = durable(
            postings.where(F.col("slot_").isin(slots)).join(wanted, "word", "left_semi").drop("slot_")
        )
        spread = held.groupBy("word").agg(F.count("*").alias("texts"))
        rarest = (
            listed.select("_phrase", "_words", F.posexplode("_words").alias("at", "word"))
            .join(spread, "word")
            .groupBy("_phrase", "_words")
            .agg(
                F.min(F.struct("texts", "at", "word")).alias("first"),
                F.count("*").alias("known"),
            )
            .where(F.col("known") == F.size("_words"))
            .select("_phrase", "_words", F.col("first.at").alias("_at"), "first.word")
        )
        begun = rarest.join(held, "word").select(
            *self.ids, "_phrase", "_words", "_at", _places(F.col("steps"), F.col("_at")).alias("_places")
        )
        single = begun.where(F.size("_words") == 1).select(*self.ids, "_phrase", "_places")
        others = (
            begun.where(F.size("_words") > 1)
            .select("*", F.posexplode("_words").alias("_next", "word"))
            .where("_next <> _at")
        )
        met = (
            others.join(held, ["word", *self.ids])
            .withColumn("_both", F.array_intersect("_places", _places(F.col("steps"), F.col("_next"))))
            .where(F.size("_both") > 0)
            .groupBy(*self.ids, "_phrase", "_words")
            .agg(F.collect_list("_both").alias("_sets"))
            .where(F.size("_sets") == F.size("_words") - 1)
        )
        common = F.aggregate(
            F.slice("_sets", F.lit(2), F.size("_sets")), F.get("_sets", F.lit(0)), F.array_intersect
        )
        several = met.select(*self.ids, "_phrase", common.alias("_places")).where(
            F.size("_places") > 0
        )
        found = single.unionByName(several)
        return found.select(
            *self.ids, F.col("_phrase").alias(phrase), F.sort_array("_places").alias("places")
        )
