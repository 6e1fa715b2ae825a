"""Phrase collocation mining by prefix-free parsing.

A text is parsed into chunks: a word whose hash is zero modulo PERIOD begins one, so copies
are cut alike wherever they stand. A chunk holds its own words, its core, and the next
words of the same piece up to one less than the longest phrase: every phrase lies inside the
chunk in whose core it begins, and is counted there and nowhere else. Equal chunks are
one row of the dictionary with their number, and phrases are counted in the dictionary,
weighted by it.

A phrase with ``least`` occurrences has only parts with as many. So lengths are counted
one after the other: occurrences, pre-added in the tasks, are summed by the phrase's
64-bit hash (with its language), and those that reach ``least`` become a bitmap of hashed
buckets, of a fixed size (BUCKETS / 8 bytes), that goes to every task: only phrases whose
parts pass it are counted in the next length. A bucket that several phrases share costs work,
never a wrong count. A sum carries one place where its phrase stands, and only the words of
those places are read in the end.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm import common as C

PERIOD = 32              # words of a chunk on average
CHUNK_WORDS = 1024       # a longer stretch without a first word is cut into chunks of this
BUCKETS = 1 << 26        # bits of a bitmap of phrases or chunks: 8 MB
HELD = 1 << 22           # occurrences a task adds up before it emits sums
_WORD_BITS = 10          # of a place: the word's number in its chunk's core
UNKNOWN = "und"
# Products of up to 38 digits, divided as integers.
SCORE = ("(cast(a as decimal(17)) * cast(n as decimal(16)) * 1000BD)"
         " div (cast(l as decimal(19)) * cast(r as decimal(19)))")

_CHUNK = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("core", pa.int32())])
_SUM = pa.schema([("hash", pa.int64()), ("weight", pa.int64()), ("place", pa.int64())])


def _words(batch: pa.RecordBatch, column: str) -> tuple[C.Words, np.ndarray]:
    """The words of a column's texts and for each the last word (its index) of its piece."""
    data, offsets = C.text_bytes(batch.column(column))
    words = C.Words(data, offsets, "phrases")
    if not len(words):
        return words, np.zeros(0, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    marks = np.cumsum(C.piece_ends()[data[lo:hi]], dtype=np.int64)[words.start - lo]
    begin = np.ones(len(words), bool)
    begin[1:] = marks[1:] != marks[:-1]
    begin[words.first[:-1][words.count > 0]] = True
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(words)) - 1
    return words, np.repeat(last, last - first + 1)


def _chunks(batches: Iterator[pa.RecordBatch], longest: int, period: int) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to rows (lang, chunk, core)."""
    _, fold = C.byte_tables("phrases")
    for batch in C.slices(batches, "text"):
        words, last = _words(batch, "text")
        if not len(words):
            continue
        begin = words.hash % np.uint64(period) == 0
        begin[words.first[:-1][words.count > 0]] = True
        start = np.flatnonzero(begin)
        stop = np.append(start[1:], len(words))
        for lo, hi in zip(start[stop - start > CHUNK_WORDS], stop[stop - start > CHUNK_WORDS], strict=True):
            begin[lo:hi:CHUNK_WORDS] = True
        start = np.flatnonzero(begin)
        stop = np.append(start[1:], len(words))
        end = np.minimum(stop + longest - 2, last[stop - 1])     # the last word of the overlap
        low, size = words.start[start], words.stop[end] - words.start[start]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) - np.repeat(ends - size - low, size)
        text = pa.Array.from_buffers(pa.large_string(), len(start), [
            None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(fold[words.data[at]])])
        doc = words.doc()[start]
        yield C.arrow_rows({"lang": batch.column("lang").take(pa.array(doc)), "chunk": text.cast(pa.string()),
                            "core": (stop - start).astype(np.int32)}, _CHUNK)


def _grams(words: C.Words, last: np.ndarray, core: np.ndarray, lang: np.ndarray,
           passed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the phrases that begin in a core, one word longer than there are bitmaps,
    and whose parts pass them. A text's index in its chunk tells what begins in the core."""
    doc = words.doc()
    fits = np.ones(len(words) + 1, bool)    # positions, overlaps too, whose n - 1 words pass
    for n in range(1, len(passed) + 2):
        size = max(0, len(words) - n + 1)
        at = np.flatnonzero((np.arange(size) + n - 1 <= last[:size]) & fits[:size] & fits[1:size + 1])
        hashes = np.zeros(len(at), np.uint64)
        for j in range(n):
            hashes = hashes * C.ODD + words.hash[at + j]
        hashes = C.mix(hashes ^ lang[doc[at]])
        if n <= len(passed):
            fits = np.zeros(len(words) + 1, bool)
            fits[at[_in(passed[n - 1], hashes)]] = True
    mine = at - words.first[doc[at]] < core[doc[at]]
    return at[mine], hashes[mine]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bucket = _bucket(hashes, 64 * len(bitmap))
    return (bitmap[bucket >> 6] >> (bucket & 63)) & 1 == 1


def _lang_hashes(column: pa.Array) -> np.ndarray:
    """A hash for the language of every row, by its name alone."""
    column = column.cast(pa.string()).dictionary_encode()
    names = [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest()) for name in column.dictionary.to_pylist()]
    return np.array(names, np.uint64)[column.indices.to_numpy(zero_copy_only=False)]


def _sums(batches: Iterator[pa.RecordBatch], passed: list[Broadcast]) -> Iterator[pa.RecordBatch]:
    """Rows (at, lang, chunk, core, times) to sums (hash, weight, place) of the next length."""
    bitmaps = [b.value for b in passed]
    held, count = [], 0

    def emit():
        hashes, weight, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(hashes)
        hashes, weight, place = hashes[order], weight[order], place[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        return C.arrow_rows({"hash": hashes[first].view(np.int64), "weight": np.add.reduceat(weight, first),
                             "place": place[first]}, _SUM)

    for batch in C.slices(batches, "chunk"):
        words, last = _words(batch, "chunk")
        at, hashes = _grams(words, last, batch.column("core").to_numpy(), _lang_hashes(batch.column("lang")), bitmaps)
        if len(at):
            doc = words.doc()[at]
            place = (batch.column("at").to_numpy()[doc] << _WORD_BITS) + (at - words.first[doc])
            held.append((hashes, batch.column("times").to_numpy()[doc], place))
            count += len(at)
        if count >= HELD:
            yield emit()
            held, count = [], 0
    if count:
        yield emit()


def _picked(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """The chunks whose number is in the bitmap."""
    for batch in batches:
        yield batch.filter(pa.array(_in(wanted.value, C.mix(batch.column("at").to_numpy().astype(np.uint64)))))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk numbers to the hashes that ``_picked`` looks for."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array(C.mix(batch.column("at").to_numpy().astype(np.uint64)).view(np.int64))], ["hash"])


def _bitmap(hashes: DataFrame, buckets: int) -> Broadcast:
    """One bit per bucket that holds a hash: buckets / 64 rows at most reach the driver."""
    bucket = F.expr(f"cast(hash & {buckets - 1}L as int)")
    words = (hashes.select(F.shiftright(bucket, 6).alias("word"), (bucket.bitwiseAND(63)).alias("bit")).groupBy("word")
             .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow())
    out = np.zeros(buckets // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(out)


def parse(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 5,
          period: int = PERIOD) -> DataFrame:
    """The dictionary, to be stored: at (a number), lang, chunk, core (words that belong to it), times."""
    slim = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(f"`{text}`").alias("text")).where("text is not null")
    return (slim.mapInArrow(lambda b: _chunks(b, longest, period), "lang string, chunk string, core int")
            .groupBy("lang", "chunk", "core").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("at", F.monotonically_increasing_id()))


def count_phrases(chunks: DataFrame, *, longest: int = 5, least: int = 100, buckets: int = BUCKETS) -> DataFrame:
    """lang, size, phrase (words joined by one space), f: all phrases of up to ``longest`` words with
    ``least`` occurrences or more. ``chunks`` is a stored dictionary; it is read once per length."""
    passed: list[Broadcast] = []
    found: list[DataFrame] = []
    for n in range(1, longest + 1):
        sums = chunks.mapInArrow(lambda b, p=tuple(passed): _sums(b, p), "hash long, weight long, place long")
        found.append(C.stored(sums.groupBy("hash").agg(F.sum("weight").alias("f"), F.min("place").alias("place"))
                              .where(F.col("f") >= least).withColumn("size", F.lit(n)), "phrase-sums"))
        if n < longest:
            passed.append(_bitmap(found[-1], buckets))
    places = functools.reduce(DataFrame.unionByName, found).select(
        "size", "f", F.shiftright("place", _WORD_BITS).alias("at"),
        F.col("place").bitwiseAND((1 << _WORD_BITS) - 1).alias("word"))
    wanted = _bitmap(places.select("at").mapInArrow(_numbers, "hash long"), buckets)
    picked = chunks.select("at", "lang", "chunk").mapInArrow(lambda b: _picked(b, wanted), "at long, lang string, chunk string")
    return (picked.join(places, "at")
            .withColumn("words", F.regexp_extract_all("chunk", F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"), F.lit(0)))
            .select("lang", "size", F.expr("array_join(slice(words, cast(word as int) + 1, size), ' ')").alias("phrase"), "f"))


def find_collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 5, least: int = 100,
                      percent: int = 100, top: int = 2000, period: int = PERIOD, buckets: int = BUCKETS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the ``top`` phrases of 2 to ``longest`` words.

    Words and pieces are those of A-Z lowered texts: pieces end at . , ; : ! ? and line ends, words at
    spaces and tabs. a is the phrase's number of occurrences, ``least`` or more; l and r those of its
    parts at its lowest-scoring cut (ties: the first); n all words of the language; the score
    floor(1000 a n / (l r)), in exact arithmetic. A phrase goes if a longer one around it has
    ``percent`` of its occurrences. A null language is ``und``; null and empty texts have no words,
    and a table without phrases gives no rows. Repeated rows count each time. Other columns are not read.
    ``buckets`` is a power of two, 64 or more.
    """
    chunks = C.stored(parse(docs, text=text, lang=lang, longest=longest, period=period), "chunks")
    totals = C.stored(chunks.groupBy("lang").agg(F.sum(F.col("core") * F.col("times")).alias("n")), "word-counts")
    counts = C.stored(count_phrases(chunks, longest=longest, least=least, buckets=buckets), "phrases")
    long = counts.where("size > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
    cuts = long.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    scored = (cuts.withColumn("left", F.expr("array_join(slice(words, 1, k), ' ')"))
              .withColumn("right", F.expr("array_join(slice(words, k + 1, size(words)), ' ')")).drop("words")
              .join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
              .join(totals, "lang")
              .withColumn("score", F.expr(SCORE)))
    best = (scored.groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*"))
    inner = (long.where("size > 2")
             .select("lang", F.col("a").alias("longer"), F.explode(F.expr(
                 "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), "
                 "i -> array_join(slice(words, i, m), ' '))))")).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def oracle(longest: int = 5, least: int = 100, percent: int = 100, top: int = 2000) -> str:
    """DuckDB SQL for the columns of query op12: every phrase of every piece is listed and counted."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array({lowered}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, m AS size, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {longest} + 1)) AS m)),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {least}),
p AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM p),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ') JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT s.lang, s.phrase FROM p s JOIN p g ON g.lang = s.lang AND g.size > s.size
  AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * g.a >= {percent} * s.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
  FROM best ANTI JOIN inner_ USING (lang, phrase))
SELECT * FROM ranked WHERE rank <= {top}"""
