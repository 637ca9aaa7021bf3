"""Information-theoretic sanitisation of personal data. Native expressions only.

Protected entities are the e-mail addresses, IP addresses, card numbers and phone numbers that
fixed patterns find, each a span of code points. What else these texts say may give them
away too. For every entity in at least ``LEAST_TEXTS`` different texts, all terms of its
texts are judged by the corpus, however far from the entity; rarer entities are not judged: a term's pointwise mutual information with the entity, against
the entity's own information -log2 p(entity), says which share of it the term discloses.
Terms at or above ``DISCLOSURE`` are sanitised as well, wherever they stand in the texts
that hold the entity: numbers are generalised to [NUMBER], others replaced by [TERM].

All counts are over all documents. Pairs of entity and term are summed in each task before
the shuffle, for entities in enough texts alone. The corpus's words are summed in each task
too, after meeting the candidate terms where these were counted and are few enough to be
broadcast, before it where not. Entities are hashes there, not texts.

Patterns are written with possessive quantifiers and start only where a run starts, so that
matching takes linear time and no deep recursion on long runs.

Null text is empty and has no spans; null ids are carried; equal rows get equal spans; an
empty table gives no rows; other columns are kept by ``sanitise`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormledger.functions.arrays import let, running
from stormledger.llm.common import letter_words, text_or_empty, whole_row
from stormledger.storage import durable

#: Java forms of the base patterns: same matches, leftmost and not overlapping.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

DISCLOSURE = 0.85  # share of an entity's information that a term may not reach
LEAST_TEXTS = 3  # different texts that must hold entity and term together
BROADCAST_TERMS = 500_000
BLOCK = 4096  # code points


def _spans(text: Column, pattern: Column) -> Column:
    """array<struct<start, end, value>> of the matches, in code points."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)

    def placed(m: Column) -> Column:
        lengths = F.zip_with(
            F.slice(pieces, 1, F.size(m)), m, lambda gap, value: F.length(gap) + F.length(value)
        )
        ends = running(lengths, lambda total, x: total + x)
        return F.zip_with(
            ends,
            m,
            lambda end, value: F.struct(
                (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def check(reverse: Column) -> Column:
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(reverse)),
            F.lit(0),
            lambda a, i: a
            + let(
                F.substr(reverse, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2),
                lambda d: F.when(d > 9, d - 9).otherwise(d),
            ),
        )
        return total % 10 == 0

    return let(F.reverse(_digits(value)), check)


def _parts_small(value: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))

    return F.forall(F.split(value, r"\."), small)


def base_spans(text: Column) -> Column:
    """struct of the four kinds' spans."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def when(maybe: Column, spans: Column) -> Column:
        return F.when(maybe, spans).otherwise(none)

    email = when(F.contains(text, F.lit("@")), _spans(text, F.lit(EMAIL)))
    ip = when(
        F.rlike(text, F.lit(r"[0-9]\.[0-9]")),
        F.filter(_spans(text, F.lit(IP)), lambda s: _parts_small(s["value"])),
    )
    card = when(
        F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")),
        F.filter(_spans(text, F.lit(CARD)), lambda s: _luhn(s["value"])),
    )
    phone = when(
        F.contains(text, F.lit("+")),
        F.filter(
            _spans(text, F.lit(PHONE)), lambda s: F.length(_digits(s["value"])).between(9, 15)
        ),
    )
    return F.struct(email.alias("email"), ip.alias("ip"), card.alias("card"), phone.alias("phone"))


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
        ),
    )


def _all(base: Column) -> Column:
    return F.concat(*[_tagged(base[k], k) for k in KINDS])


def holders(docs: DataFrame) -> DataFrame:
    """(text_key, text, entities, docs): each different text with an entity, and its documents."""
    rows = docs.select(F.xxhash64("text").alias("text_key"), text_or_empty("text").alias("text"))
    held = rows.withColumn("spans", _all(base_spans(F.col("text")))).where(F.size("spans") > 0)
    entity = F.transform("spans", lambda s: F.xxhash64(s["kind"], F.lower(s["value"])))
    return (
        held.withColumn("entities", F.array_distinct(entity))
        .groupBy("text_key")
        .agg(
            F.first("text").alias("text"),
            F.first("entities").alias("entities"),
            F.count("*").alias("docs"),
        )
    )


def _if_few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_TERMS else rows


def disclosing(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(text_key, terms): the terms that give an entity of this text away.

    The counts of entities and of terms with them are over texts with multiplicity: every
    document counts. Support is over different texts.
    """
    held = durable(holders(docs))
    keys = held.select("text_key", "docs", F.explode("entities").alias("entity"))
    entities = durable(
        keys.groupBy("entity")
        .agg(F.sum("docs").alias("n_entity"), F.count("*").alias("texts"))
        .where(F.col("texts") >= LEAST_TEXTS)
        .drop("texts")
    )
    judgeable = (
        keys.join(_if_few(entities.select("entity")), "entity")
        .groupBy("text_key")
        .agg(F.collect_set("entity").alias("judged"))
    )
    terms_of = F.array_distinct(letter_words(F.col("text")))
    pairs = (
        held.join(judgeable, "text_key")
        .select("text_key", "docs", "judged", terms_of.alias("terms"))
        .select("text_key", "docs", "terms", F.explode("judged").alias("entity"))
        .select("text_key", "docs", "entity", F.explode("terms").alias("term"))
    )
    together = (
        pairs.groupBy("entity", "term")
        .agg(F.sum("docs").alias("n_both"), F.count("*").alias("texts"))
        .where(F.col("texts") >= LEAST_TEXTS)
    )
    candidates = durable(together.join(entities, "entity"))
    terms = candidates.select("term").distinct()
    few = terms.count() <= BROADCAST_TERMS
    words = docs.select(
        F.explode(F.array_distinct(letter_words(text_or_empty("text")))).alias("term")
    )
    met = words.join(F.broadcast(terms), "term") if few else words
    counted = met.groupBy("term").agg(F.count("*").alias("n_term"))
    total = F.lit(float(max(1, docs.count())))
    shared = F.log2(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    judged = durable(
        candidates.join(counted, "term")
        .where(
            (F.col("n_entity") < total)
            & (shared >= F.lit(disclosure) * F.log2(total / F.col("n_entity")))
        )
        .select("entity", "term")
    )
    return (
        pairs.join(_if_few(judged), ["entity", "term"])
        .groupBy("text_key")
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))
    )


def term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Places of these terms as whole words, apart from what lies in another span."""
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pattern = F.concat(
        F.lit(f"(?i)(?<!{word})(?:"), F.array_join(terms, "|"), F.lit(f")(?!{word})")
    )
    return F.filter(
        _spans(text, pattern),
        lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )


def _with_terms(docs: DataFrame, disclosure: float) -> DataFrame:
    """(row, spans): every row with all its spans, by kind as listed and then by start."""
    rows = docs.select(
        whole_row(docs).alias("row"), F.xxhash64("text").alias("text_key")
    )
    terms = durable(disclosing(docs, disclosure))
    terms = terms.withColumnRenamed("text_key", "k")
    met = rows.join(terms, F.col("text_key") == F.col("k"), "left")
    text = text_or_empty("row.text")
    return met.select("row", let(base_spans(text), _all).alias("base"), "terms").select(
        "row",
        F.when(
            F.col("terms").isNotNull(),
            F.concat("base", _tagged(term_spans(text, F.col("terms"), F.col("base")), "term")),
        )
        .otherwise(F.col("base"))
        .alias("spans"),
    )


def find(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(doc_id, spans): array<struct<start, end, kind, value>> by kind, then start."""
    found = _with_terms(docs.select("doc_id", "text"), disclosure)
    return found.select(F.col("row.doc_id").alias("doc_id"), "spans")


def _replacement(span: Column) -> Column:
    number = F.rlike(span["value"], F.lit("^[0-9]+$"))
    return (
        F.when((span["kind"] == "term") & number, "[NUMBER]")
        .otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
    )


def _cleaned(text: Column, spans: Column) -> Column:
    """The text with its spans, in order of their starts, replaced. It is cut into blocks first,
    as finding a place in a string takes longer the further back it lies."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.substr(text, at, F.lit(BLOCK)))
    reach = running(F.transform(spans, lambda s: s["end"]), F.greatest)

    def joined(x: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK).cast("int")
            number = F.floor(end / BLOCK).cast("int") - first + 1
            near = F.array_join(F.slice(x["blocks"], first + 1, number), "")
            return F.substr(near, start - first * BLOCK + 1, end - start)

        def replaced(span: Column, i: Column) -> Column:
            done = F.coalesce(F.get(x["reach"], i - 1), F.lit(0))
            return F.when(
                span["start"] >= done, F.concat(piece(done, span["start"]), _replacement(span))
            ).otherwise("")

        last = F.get(x["reach"], F.size(x["reach"]) - 1)
        return F.concat(
            F.array_join(F.transform(spans, replaced), ""), piece(last, F.length(text))
        )

    return let(F.struct(blocks.alias("blocks"), reach.alias("reach")), joined)


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """The table with each span replaced by its kind; ``n_chars`` of changed texts follows, if any.

    Where spans overlap, the first to start names the whole stretch.
    """
    found = _with_terms(docs, disclosure)
    text = F.col("row.text")
    clean = let(F.array_sort("spans"), lambda spans: _cleaned(text, spans))
    done = found.select(
        "row", F.when(F.size("spans") > 0, clean).otherwise(text).alias("text"), "spans"
    )
    kinds = {f.name: f.dataType for f in docs.schema}
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("text"))
        elif name == "n_chars":
            size = F.when(F.size("spans") > 0, F.length("text").cast(kinds[name]))
            columns.append(size.otherwise(F.col("row")[name]).alias(name))
        else:
            columns.append(F.col("row")[name].alias(name))
    return done.select(*columns)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
