"""Quality rules with thresholds learnt per language and source. Native expressions only.

Each document gets four base counts and a few ratios. The ratios' distribution per
(language, source) is kept as a sketch: counts over geometric bins, so that any two
sketches merge by adding, in any order, to the same result, and a quantile is right within
the bins' relative width. From the merged sketch come the quartiles, and from these each
group's own upper limit: the upper quartile plus ``SPREADS`` times the quartiles' distance.

A group's sketch is merged with that of its language, scaled to ``PRIOR_DOCS`` documents, and a
language's with that of the corpus likewise. So few documents lean on their language, and
this fades as a group grows, without a size at which its limits switch.

Documents then join the limits of their group. A ratio is a count of events over a number of
units, and what a document shows by chance varies with the root of its count. It is beyond the
limit if its count less ``SURE`` roots still is. No cutoff is fixed for any ratio.

Null text is empty and fails (no words); null language and source are groups like others;
equal rows are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormledger.functions.arrays import let
from stormledger.llm.common import (
    SPACES,
    grams,
    space_words,
    text_or_empty,
    whole_row,
    word_hashes,
)
from stormledger.storage import durable

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
BIN_GROWTH = 1.05  # quantiles are right within 5 %
SMALLEST = 1e-4  # ratios below count as zero
SPREADS = 3.0  # a limit lies this many interquartile ranges above the upper quartile
SURE = 3.0  # roots of its count that a document's count is lowered by before it is judged
PRIOR_DOCS = 100  # documents that the sketch of the language, or of the corpus, counts as
_WEIGHT = 1 << 20  # one document in merged sketches; whole numbers add alike in any order
RATIOS = ("symbol_ratio", "capital_ratio", "dup_line_ratio", "repeat_ratio", "word_length")
_POSITION = (1 << 21) - 1


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more."""
    return let(grams(word_hashes(words), 3), _repeated)


def _repeated(windows: Column) -> Column:
    n = F.size(windows)
    hash_and_place = F.transform(
        windows, lambda h, i: h.bitwiseAND(F.lit(~_POSITION)).bitwiseOR(i.cast("bigint"))
    )
    long = F.transform(
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        lambda x: x["i"],
    )
    short = let(
        F.sort_array(hash_and_place),
        lambda ranked: F.when(F.size(_mixed(ranked, windows)) > 0, long).otherwise(
            F.transform(ranked, _place)
        ),
    )
    order = F.when(n <= _POSITION, short).otherwise(long)
    found = let(order, lambda o: _equal_neighbours(o, windows))
    return F.when(F.size(F.array_distinct(windows)) == n, F.lit(0)).otherwise(
        let(F.sort_array(found), _covered)
    )


def _place(ranked: Column) -> Column:
    return ranked.bitwiseAND(F.lit(_POSITION)).cast("int")


def _mixed(ranked: Column, windows: Column) -> Column:
    """Neighbours that agree in the bits beside the place but not in the whole hash: there,
    equal windows may lie apart."""
    return F.filter(
        ranked,
        lambda x, k: (F.shiftright(x, 21) == F.shiftright(F.get(ranked, k + 1), 21))
        & (F.get(windows, _place(x)) != F.get(windows, _place(F.get(ranked, k + 1)))),
    )


def _equal_neighbours(order: Column, windows: Column) -> Column:
    """Places, in order of their windows' hashes, whose window occurs at a neighbour too."""
    return let(
        F.transform(order, lambda i: F.get(windows, i)),
        lambda hashes: F.filter(
            order,
            lambda i, k: (F.get(hashes, k) == F.get(hashes, k - 1))
            | (F.get(hashes, k) == F.get(hashes, k + 1)),
        ),
    )


def _covered(places: Column) -> Column:
    steps = F.transform(
        places,
        lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))),
    )
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _events(c: Column) -> dict[str, tuple[Column, Column]]:
    """Ratio -> its events and its units. Words are repeated by lines, so all words of two
    equal lines are one event."""
    return {
        "symbol_ratio": (c["n_symbols"], c["word_chars"]),
        "capital_ratio": (c["n_capitals"], c["word_chars"]),
        "dup_line_ratio": (c["n_dup_lines"], c["n_lines"]),
        "repeat_ratio": (_share(c["n_repeat_words"] * c["n_lines"], 2 * c["n_words"]), c["n_lines"] / 2),
        "word_length": (c["word_chars"], c["n_words"]),
    }


def _sure(events: Column, units: Column) -> Column:
    """The ratio that the document surely has, whatever chance added."""
    return _share(events - F.lit(SURE) * F.sqrt(events), units)


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The table with its base counts and ratios in one column ``q``."""
    text = text_or_empty(text_column)
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    letters = F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    counted = let(
        F.struct(space_words(text).alias("words"), lines.alias("lines")),
        lambda x: F.struct(
            F.size(x["words"]).cast("bigint").alias("n_words"),
            F.length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, "")))
            .cast("bigint")
            .alias("n_symbols"),
            (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"])))
            .cast("bigint")
            .alias("n_dup_lines"),
            F.size(x["lines"]).cast("bigint").alias("n_lines"),
            (F.length(text) - letters).cast("bigint").alias("n_capitals"),
            repeated_words(x["words"]).cast("bigint").alias("n_repeat_words"),
        ),
    )
    q = let(
        counted,
        lambda c: F.struct(
            *[c[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines")],
            c["n_repeat_words"].alias("n_repeat_words"),
            *[_share(*of).alias(name) for name, of in _events(c).items()],
            F.struct(*[_sure(*of).alias(name) for name, of in _events(c).items()]).alias("sure"),
            (
                (c["n_words"] < 50) | (c["n_repeat_words"] * 100 > c["n_words"] * 50)
            ).alias("base_failed"),
        ),
    )
    return docs.withColumn("q", q)


def _bin(ratio: Column) -> Column:
    """Number of the geometric bin; bin 0 holds everything up to the smallest ratio."""
    steps = F.ceil(F.log(ratio / F.lit(SMALLEST)) / F.log(F.lit(BIN_GROWTH)))
    return F.when(ratio <= SMALLEST, F.lit(0)).otherwise(steps.cast("int"))


def sketch(measured: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Counts per (language, source, ratio, bin): summing rows merges sketches."""
    wide = measured.select(
        F.col(keys[0]).alias("lang"),
        F.col(keys[1]).alias("source"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("ratio"), _bin(F.col(f"q.{name}")).alias("bin"))
                    for name in RATIOS
                ]
            )
        ).alias("s"),
    )
    return wide.groupBy("lang", "source", "s.ratio", "s.bin").agg(F.count("*").alias("n"))


def _quantile(bins: Column, q: float) -> Column:
    """Upper edge of the first bin at which the running count reaches the share q."""
    total = F.aggregate(bins, F.lit(0).cast("bigint"), lambda a, b: a + b["n"])
    state = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(-1).alias("at"))
    found = F.aggregate(
        bins,
        state,
        lambda a, b: F.struct(
            (a["seen"] + b["n"]).alias("seen"),
            F.when(a["at"] >= 0, a["at"])
            .when((a["seen"] + b["n"]) >= total * F.lit(q), b["bin"])
            .otherwise(F.lit(-1))
            .alias("at"),
        ),
    )["at"]
    return F.when(found == 0, F.lit(0.0)).otherwise(
        F.lit(SMALLEST) * F.pow(F.lit(BIN_GROWTH), found)
    )


def _merged(counts: DataFrame, keys: list[str], prior: DataFrame, of: list[str]) -> DataFrame:
    """(keys, ratio, bin, n) in parts of a document: each key's own sketch and that of its
    ``prior``, which has columns ``of``, scaled to ``PRIOR_DOCS`` documents."""
    total = prior.groupBy(*of, "ratio").agg(F.sum("n").alias("_all"))
    scaled = prior.join(total, [*of, "ratio"]).select(
        *of, "ratio", "bin", F.expr(f"CAST({PRIOR_DOCS * _WEIGHT} * (n / _all) AS bigint)").alias("n")
    )
    own = counts.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))
    lent = own.select(*keys, "ratio").distinct().join(scaled, [*of, "ratio"])
    both = own.withColumn("n", F.col("n") * _WEIGHT).unionByName(lent.select(own.columns))
    return both.groupBy(*keys, "ratio", "bin").agg(F.sum("n").alias("n"))


def limits(counts: DataFrame) -> DataFrame:
    """(lang, source, limits): each group's limit of every ratio.

    A group has at most as many bins as ratios times a few hundred, so its arrays are small
    at any number of documents.
    """
    known = counts.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("l"),  # a null is a key too
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s"),
        "ratio",
        "bin",
        "n",
    )
    everything = known.groupBy("ratio", "bin").agg(F.sum("n").alias("n"))
    langs = _merged(known, ["l"], everything, [])
    bins = _merged(known, ["l", "s"], langs, ["l"])
    quartiles = (
        bins.groupBy("l", "s", "ratio")
        .agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
        .select(
            "l",
            "s",
            "ratio",
            _quantile(F.col("bins"), 0.25).alias("low"),
            _quantile(F.col("bins"), 0.75).alias("high"),
        )
    )
    limit = F.col("high") + F.lit(SPREADS) * (F.col("high") - F.col("low"))
    made = quartiles.groupBy("l", "s").agg(
        F.map_from_entries(F.collect_list(F.struct("ratio", limit))).alias("limits")
    )

    def back(key: str) -> Column:
        return F.when(F.col(key) != "", F.substr(F.col(key), F.lit(2)))

    return made.select(back("l").alias("lang"), back("s").alias("source"), "limits")


def judge(measured: DataFrame, limits: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """The measured table with ``q.kept`` decided; ``limits`` is small or joins by shuffle."""
    named = limits.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("limits").alias("_l")
    )
    beyond = F.lit(False)
    for name in RATIOS:
        beyond = beyond | (F.col(f"q.sure.{name}") > F.element_at("_l", F.lit(name)))
    met = measured.join(
        named,
        measured[keys[0]].eqNullSafe(F.col("_lang"))
        & measured[keys[1]].eqNullSafe(F.col("_source")),
        "left",
    )
    kept = ~F.col("q.base_failed") & ~F.coalesce(beyond, F.lit(False))
    return met.withColumn("q", F.col("q").withField("kept", kept)).drop("_lang", "_source", "_l")


def quality(docs: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row per document with its counts and the verdict; texts are read once."""
    counted = durable(measure(docs.select("doc_id", "text", *keys)).drop("text"))
    judged = judge(counted, durable(limits(sketch(counted, keys))), keys)
    return judged.select("doc_id", "q.*")


def keep_good(docs: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The documents that pass, with all their columns. Texts are measured once; the rows are
    kept with their numbers in the shared folder, and not shuffled unless the limits are too
    many to broadcast."""
    plain = docs.select(whole_row(docs).alias("row"))
    narrow = plain.select(
        F.col("row.text").alias("text"),
        F.col(f"row.{keys[0]}").alias("lang"),
        F.col(f"row.{keys[1]}").alias("source"),
        "row",
    )
    of = ("lang", "source")
    counted = durable(measure(narrow).drop("text"))
    judged = judge(counted, durable(limits(sketch(counted, of))), of)
    return judged.where(F.col("q.kept")).select("row.*")
