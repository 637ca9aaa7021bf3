"""Which texts contain which phrases, as an equality join instead of text x phrase."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.storage import durable


def normalized(text: Column) -> Column:
    """Lower-case runs of letters and digits, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _anchored(phrases: DataFrame, phrase: str) -> DataFrame:
    """(_phrase, _whole, _word): each phrase and that of its words that the fewest phrases have,
    the longest of such."""
    listed = (
        phrases.select(F.col(phrase).alias("_phrase"))
        .distinct()
        .withColumn("_whole", normalized(F.col("_phrase")))
        .where("_whole != ''")
    )
    words = listed.select("*", F.explode(F.array_distinct(F.split("_whole", " "))).alias("_word"))
    shared = words.groupBy("_word").agg(F.count("*").alias("_shared"))
    rank = F.struct("_shared", (-F.length("_word")).alias("_length"), "_word")
    return (
        words.join(shared, "_word")
        .groupBy("_phrase", "_whole")
        .agg(F.min(rank).alias("_rank"))
        .select("_phrase", "_whole", "_rank._word")
    )


def find_phrases(
    texts: DataFrame, ids: Sequence[str], text: str, phrases: DataFrame, phrase: str = "phrase"
) -> DataFrame:
    """Distinct (ids, phrase) where the phrase's words occur in the text, next to each
    other and in order. Case and punctuation do not count; words match whole.

    Text and phrase meet by one word of the phrase, that which the fewest phrases share; a
    text gives each of its different words once. Phrases of one word are found by that. For
    the others, the texts that hold the word are read again and searched. What was met is
    written down, so that its size is known when they are fetched: where it is small they
    are filtered where they lie.
    """
    listed = durable(_anchored(phrases, phrase))
    spelled = texts.select(*ids, normalized(F.col(text)).alias("_text")).where("_text != ''")
    words = F.explode(F.array_distinct(F.split("_text", " "))).alias("_word")
    met = durable(
        spelled.select(*ids, words)
        .join(listed, "_word")
        .select(*ids, "_phrase", (F.col("_whole") == F.col("_word")).alias("_single"))
        .distinct()
    )
    whole = normalized(F.col("_phrase"))  # spelled again here, instead of sent along
    whole_words = F.contains(
        F.concat(F.lit(" "), "_text", F.lit(" ")), F.concat(F.lit(" "), whole, F.lit(" "))
    )
    searched = spelled.join(met.where("NOT _single"), list(ids)).where(whole_words)
    found = met.where("_single").select(*ids, "_phrase").unionByName(searched.select(*ids, "_phrase"))
    return found.distinct().withColumnRenamed("_phrase", phrase)
