"""Question routing as a batch text-classification job.

Each question scores every tool by the summed length of the tool's keywords
that occur in its lower-cased text (plain substring match); the highest score
wins, ties go to registry order, no match -> the default tool. Entities (first
region / mode by whole word, up to two segments by token) come from the same
text; two segments force the segment comparison, and the matched terms stay
those of the winning tool. All of it is column expressions in one narrow stage
(no join, no UDF), projected step by step so that the text, the matches and the
best score are each computed once.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

_WORD = r"[^\p{L}\p{N}_]"


def _word_pattern(term: str) -> str:
    """Whole-word match of a vocabulary term (letters / spaces only)."""
    return f"(^|{_WORD}){term.lower()}({_WORD}|$)"


def _first(matches: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(cond, F.lit(value)) for cond, value in matches])


def route(questions: DataFrame, text_col: str = "question") -> DataFrame:
    """X1 + X2: add tool, score, matched_terms (comma-joined), region,
    transport_mode, segment_a, segment_b. Columns of the questions whose names
    begin with ``_rt_`` are not allowed."""
    kept = [F.col(f"`{c}`") for c in questions.columns]
    low = F.col("_rt_low")

    def found(terms) -> Column:
        """The terms that occur in the text, in their order."""
        return F.array_compact(F.array(*[F.when(F.instr(low, t) > 0, F.lit(t)) for t in terms]))

    def length(terms: Column) -> Column:
        return F.aggregate(terms, F.lit(0), lambda n, t: n + F.length(t))

    def whole_word(term: str) -> Column:
        # cheap substring test first; the regex only runs on candidate texts
        return (F.instr(low, term.lower()) > 0) & low.rlike(_word_pattern(term))

    def any_token(tokens) -> Column:
        return functools.reduce(operator.or_, [F.instr(low, t) > 0 for t in tokens])

    names = [name for name, _ in C.ROUTING_TOOLS]
    text = questions.select(*kept, F.trim(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
                            .alias("_rt_low"))
    matched = text.select(
        *kept, "_rt_low",
        *[found(keywords).alias(f"_rt_terms_{name}") for name, keywords in C.ROUTING_TOOLS],
        F.array_compact(F.array(*[F.when(any_token(tokens), F.lit(segment))
                                  for segment, tokens in C.SEGMENT_TOKENS])).alias("_rt_segments"))
    scored = matched.select("*", *[length(F.col(f"_rt_terms_{n}")).alias(f"_rt_score_{n}")
                                   for n in names])
    best = scored.select("*", F.greatest(*[F.col(f"_rt_score_{n}") for n in names]).alias("_rt_best"))
    winner = best.select("*", F.when(F.col("_rt_best") > 0, _first(
        [(F.col(f"_rt_score_{n}") == F.col("_rt_best"), n) for n in names])).alias("_rt_tool"))
    terms = F.coalesce(*[F.when(F.col("_rt_tool") == n, F.col(f"_rt_terms_{n}")) for n in names])
    segment = [F.try_element_at("_rt_segments", F.lit(i)) for i in (1, 2)]
    return winner.select(
        *kept,
        F.when(F.col("_rt_tool").isNull(), F.lit(C.DEFAULT_TOOL))
        .when(segment[1].isNotNull(), F.lit("compare_segments"))
        .otherwise(F.col("_rt_tool")).alias("tool"),
        F.col("_rt_best").alias("score"),
        F.coalesce(F.array_join(terms, ", "), F.lit("")).alias("matched_terms"),
        _first([(whole_word(r), r) for r in C.REGIONS]).alias("region"),
        _first([(whole_word(m), m) for m in C.TRANSPORT_MODES]).alias("transport_mode"),
        segment[0].alias("segment_a"), segment[1].alias("segment_b"))


_PIECES = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"


def _pieces(text: Column) -> Column:
    """The lower-cased text cut into words and what stands between them, in turn."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_PIECES), F.lit(0))


def find_entities(questions: DataFrame, vocabulary: DataFrame, keys: list[str],
                  text_col: str = "question") -> DataFrame:
    """X2 for any vocabulary: the terms that stand in a text as whole words.

    ``vocabulary`` has kind and value; a term of several words matches with what stands between
    them in the value, in any case. A mention that lies inside a longer one does not count; equal
    mentions of several kinds all do. Returns keys, kind, value, first_word (from 1), n_words, each
    mention once; rows with equal ``keys`` are one question (their mentions are put together), null
    and empty texts, and values that don't begin and end with a word, have none.

    The runs of words of a text, up to the words of the longest term, join the vocabulary by equality.
    Only the keys travel with them, not the text.
    """
    by = [F.col(f"`{k}`") for k in keys]
    terms = (vocabulary.where(F.col("value").isNotNull())
             .select(F.lower("value").alias("_en_text"), "kind", "value").distinct())
    spans = F.size(_pieces(F.col("value")))
    longest = terms.agg(F.max(spans)).first()[0] or 0
    sizes = range(1, longest + 1, 2)                 # words and what is between them
    if not sizes:
        return questions.select(*by, *(F.lit(None).cast(t).alias(c) for c, t in _MENTION)).limit(0)
    cut = questions.select(*by, _pieces(F.col(f"`{text_col}`")).alias("_en_pieces"))

    def runs(piece: Column, i: Column) -> Column:
        found = [F.when((i + n <= F.size("_en_pieces")), F.struct(
            i.alias("at"), F.lit(n).alias("n"),
            F.array_join(F.slice("_en_pieces", i + 1, n), "").alias("text"))) for n in sizes]
        return F.when(piece.rlike(r"^[\p{L}\p{N}_]"), F.array_compact(F.array(*found)))

    places = (cut.select(*by, F.explode(F.flatten(F.array_compact(F.transform("_en_pieces", runs)))).alias("_en_run"))
              .select(*by, F.col("_en_run.at").alias("_en_at"), F.col("_en_run.n").alias("_en_n"),
                      F.col("_en_run.text").alias("_en_text")))
    # what one span means is bounded by the kinds and spellings of one term
    mentions = (places.join(terms, "_en_text").groupBy(*by, "_en_at", "_en_n")
                .agg(F.collect_set(F.struct("kind", "value")).alias("_en_means")))
    before = (Window.partitionBy(*by).orderBy("_en_at", F.desc("_en_n"))
              .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.max(F.col("_en_at") + F.col("_en_n")).over(before)
    return (mentions.withColumn("_en_reach", reach)
            .where(F.col("_en_reach").isNull() | (F.col("_en_reach") < F.col("_en_at") + F.col("_en_n")))
            .select(*by, F.inline("_en_means"),
                    (F.floor(F.col("_en_at") / 2) + 1).cast("long").alias("first_word"),
                    F.floor((F.col("_en_n") + 1) / 2).cast("long").alias("n_words")))


_MENTION = (("kind", "string"), ("value", "string"), ("first_word", "long"), ("n_words", "long"))


def vocabulary_of(journeys: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """kind, value: the different values of the columns, from one scan."""
    value = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns]))
    return (journeys.select(value.alias("_en")).select("_en.kind", "_en.value")
            .where(F.col("value").isNotNull()).distinct())


def dimension_questions(journeys: DataFrame) -> DataFrame:
    """A question about each region, mode and segment, all known, that meet in a journey."""
    met = journeys.select("region", "transport_mode", "customer_segment").dropna().distinct()
    return met.select(F.format_string(
        "How do %s in the %s region rate the %s, and where is satisfaction falling?",
        "customer_segment", "region", "transport_mode").alias("question"))


def user_questions(conversations: DataFrame) -> DataFrame:
    """The user turns of the conversations table as a question batch."""
    return conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"))
