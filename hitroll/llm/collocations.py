"""Phrase collocations of two to four words by the stripes pattern.

A *stripe* is a prefix (up to three words) with an associative counter of the words that follow
it. Tasks count their windows of text into stripes; a shuffle by (language, prefix, slice) brings
those of one prefix together and they are added element by element. Level after level:

* level 1 is the stripe of the empty prefix: the words of a language, and their number;
* the stripes of level k are counted only where the phrase without its last and the one without
  its first word are frequent, since no frequent phrase holds one that is not. Tasks ask a Bloom
  filter of the level before, whose size follows the number of frequent phrases up to
  ``MAX_FILTER_BITS``. It has no false negatives, so a full filter costs rows, not results;
* the stripes of hot prefixes, the empty one among them, are dealt over slices by their next words.
  Hot prefixes have a ``1 / SLICES`` share of all words or more, so no more than ``SLICES`` of a
  level are broadcast.

Everything else is read off the merged stripes: extensions (their entries), prefix totals (the
entry of the shorter prefix), and the greatest entry that subsumes a phrase, as its extension to
the right (the maximum of its own stripe) or to the left. A longer phrase by two words needs no
look: the one between has at least its count.

Words keep their bytes, phrases are compared whole, and counts are 64-bit integers; products are
taken in decimals. Defined results: null or empty text has no words; a null language is ``und``;
rows with equal ``doc_id`` are separate documents; an empty table gives no rows; other columns are
ignored. Equal scores are ordered by count, then by the phrase's bytes.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitroll.llm.common import cut, table

MIN_COUNT, TOP, MAX_WORDS = 30, 2000, 4
SUBSUMED_PERCENT = 80
WINDOW_BYTES = 6 << 20              # of text, counted together in a task
HELD_PHRASES = 3_000_000            # different ones that a task holds before it emits stripes
SLICES = 1024
FILTER_HASHES, FILTER_SLICES = 3, 256
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 16, 1 << 30
SALTS = 64

_CUT = b"\xff"                      # in no UTF-8 text
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9
               else b + 32 if 65 <= b < 91 else b for b in range(256))


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of UTF-8 ``texts`` as numbers in order, and the words by number. Number 0 is the
    cut between pieces, which also stands between texts, first and last."""
    text = b" \xff ".join(t.translate(_TABLE).replace(_CUT, b" \xff ") for t in texts)
    data = np.frombuffer(b"\xff " + text + b" \xff ", np.uint8)
    space = data == 0x20
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    data, space = data[keep], space[keep]               # every word ends in one space now
    ends = np.flatnonzero(space).astype(np.int64) + 1
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [
        None, pa.py_buffer(np.r_[np.int64(0), ends]), pa.py_buffer(data)]).dictionary_encode()
    return words.indices.to_numpy(), [w[:-1] for w in words.dictionary.to_pylist()]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last."""
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) + word)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _phrase_hashes(langs: list[bytes], phrases: list[bytes]) -> np.ndarray:
    """Hashes of phrases of equally many words."""
    h = np.array([_word_hash(lang) for lang in langs], np.uint64)
    for column in zip(*(p.split(b" ") for p in phrases)):
        h = _extended(h, np.array([_word_hash(w) for w in column], np.uint64))
    return h


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)
            for i in range(FILTER_HASHES)]


def _in_filter(h: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether the phrases may be in the filter ``held`` (bytes of bits)."""
    out = np.ones(len(h), bool)
    for at in _places(h, 8 * len(held)):
        out &= (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return out


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """Bloom filter of ``lang, phrase`` rows, all of equally many words. Its parts are made in groups of one slice each; at
    most ``MAX_FILTER_BITS`` / 8 bytes reach the driver."""
    n = phrases.count()
    bits = 1 << min(max(16 * n, MIN_FILTER_BITS) - 1, MAX_FILTER_BITS - 1).bit_length()
    size = bits // FILTER_SLICES

    def places(batches):
        for batch in batches:
            h = _phrase_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            at = np.unique(np.concatenate(_places(h, bits)) if len(h) else np.empty(0, np.int64))
            slices, first = np.unique(at // size, return_index=True)
            parts = [p.astype(np.int32).tolist() for p in np.split(at % size, first[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(slices.astype(np.int32)),
                pa.array(parts[:len(slices)], pa.list_(pa.int32()))], names=["slice", "places"])

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(size, bool)
        for p in group["places"]:
            held[p] = True
        return pd.DataFrame({"slice": group["slice"].iloc[:1],
                             "held": [np.packbits(held, bitorder="little").tobytes()]})

    rows = (phrases.select(F.col("lang").cast("binary"), F.col("phrase").cast("binary"))
            .mapInArrow(places, "slice int, places array<int>")
            .groupBy("slice").applyInPandas(fill, "slice int, held binary").collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        at = r["slice"] * (size // 8)
        out[at:at + size // 8] = np.frombuffer(r["held"], np.uint8)
    return out


def _added(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of word numbers once, in ascending order, with the sums of their ``n``."""
    if not len(rows):
        return rows, n
    base = int(rows.max()) + 1
    code, size = rows[:, 0].astype(np.int64), base
    for i in range(1, rows.shape[1]):
        if size * base >= 1 << 63:                      # ranks of the first words keep it small
            kinds, code = np.unique(code, return_inverse=True)
            size = len(kinds)
        code, size = code * base + rows[:, i], size * base
    order = np.argsort(code, kind="stable")
    code = code[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return rows[order[starts]], np.add.reduceat(n[order], starts)


def _counted(ids: np.ndarray, names: list[bytes], lang: bytes, level: int,
             held: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases of ``level`` words in a window of word numbers, as rows of numbers, and
    their counts."""
    if level == 1:
        word, n = np.unique(ids[ids > 0], return_counts=True)
        return word[:, None], n
    hashes = np.array([_word_hash(w) for w in names], np.uint64)
    size = max(0, len(ids) - level + 1)
    inside = np.ones(size, bool)
    for i in range(level):
        inside &= ids[i:size + i] > 0
    at = np.flatnonzero(inside)
    for first in (0, 1):                    # without the last word, without the first word
        h = np.full(len(at), _word_hash(lang), np.uint64)
        for i in range(first, first + level - 1):
            h = _extended(h, hashes[ids[at + i]])
        at = at[_in_filter(h, held)]
    return _added(ids[at[:, None] + np.arange(level)], np.ones(len(at), np.int64))


class _Held:
    """Phrases of one language counted so far in a task, with numbers of their own."""

    def __init__(self):
        self.number: dict[bytes, int] = {b"": 0}
        self.rows, self.n, self.size = [], [], 0

    def add(self, rows: np.ndarray, n: np.ndarray, names: list[bytes]) -> None:
        used, place = np.unique(rows, return_inverse=True)
        mine = np.array([self.number.setdefault(names[w], len(self.number)) for w in used], np.int32)
        self.rows.append(mine[place].reshape(rows.shape))
        self.n.append(n)
        self.size += len(n)

    def merge(self) -> None:
        rows, n = _added(np.concatenate(self.rows), np.concatenate(self.n))
        self.rows, self.n, self.size = [rows], [n], len(n)


def _batches(lang: str, held: _Held, level: int, hot: list[tuple[str, int]], schema):
    """The stripes of ``held`` as rows of ``schema``."""
    held.merge()
    rows, n = held.rows[0], held.n[0]
    if not len(rows):
        return
    texts = pa.array(list(held.number), pa.binary()).cast(pa.string())
    word = lambda i: texts.take(pa.array(rows[:, i]))
    nexts, prefix = word(level - 1), word(0) if level > 1 else pa.array([""] * len(rows))
    for i in range(1, level - 1):
        prefix = pa.compute.binary_join_element_wise(prefix, word(i), " ")
    new = np.zeros(len(rows), bool)
    new[0] = True
    for i in range(level - 1):
        new[1:] |= rows[1:, i] != rows[:-1, i]
    # Stripes are runs of rows; hot ones are dealt over slices by their next word.
    slices = np.zeros(len(rows), np.int32)
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(rows)]
    found = pa.compute.index_in(prefix.take(pa.array(starts)), pa.array([p for p, _ in hot], pa.string()))
    for k in np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False)):
        a, b, parts = starts[k], ends[k], hot[found[k].as_py()][1]
        slices[a:b] = [_word_hash(w.encode()) % parts for w in nexts.slice(a, b - a).to_pylist()]
    if slices.any():
        run_of = np.cumsum(new)
        order = np.lexsort((slices, run_of))
        slices, run_of, n = slices[order], run_of[order], n[order]
        new[1:] = (run_of[1:] != run_of[:-1]) | (slices[1:] != slices[:-1])
        prefix, nexts = prefix.take(pa.array(order)), nexts.take(pa.array(order))
        starts = np.flatnonzero(new)
    at = np.r_[starts, len(n)].astype(np.int32)
    for a in range(0, len(starts), 1 << 16):
        part = at[a:a + (1 << 16) + 1]
        first = pa.array(part[:-1])
        lists = [pa.ListArray.from_arrays(pa.array(part - part[0]),
                                          v.slice(part[0], part[-1] - part[0]))
                 for v in (nexts, pa.array(n, pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(first)), prefix.take(first),
             pa.array(slices[part[:-1]], pa.int32()), *lists], schema=schema)


def _stripes(docs: DataFrame, level: int, held: np.ndarray | None, hot: dict) -> DataFrame:
    """Each task's stripes of ``level``: ``lang, prefix, slice, nexts, counts``. At level 1 the
    entry "" counts all words of the language."""
    shared = docs.sparkSession.sparkContext.broadcast((held, hot))
    schema = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("slice", pa.int32()),
                        ("nexts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches):
        filter_, hot = shared.value
        waiting, counted = {}, {}           # language: texts and their bytes; phrases

        def count(lang):
            ids, names = numbered(waiting.pop(lang)[0])
            rows, n = _counted(ids, names, lang.encode(), level, filter_)
            if level == 1:
                names[0] = b""              # the cut's number
                rows, n = np.r_[np.zeros((1, 1), rows.dtype), rows], np.r_[n.sum(), n]
            mine = counted.setdefault(lang, _Held())
            mine.add(rows, n, names)
            if mine.size >= HELD_PHRASES:
                mine.merge()
            while sum(h.size for h in counted.values()) >= HELD_PHRASES:
                yield from emit(max(counted, key=lambda x: counted[x].size))

        def emit(lang):
            mine = [("", SLICES)] if level == 1 else hot.get(lang, [])
            yield from _batches(lang, counted.pop(lang), level, mine, schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts, n = waiting.get(lang) or ([], 0)
                texts.append(text.as_py() or b"")
                waiting[lang] = (texts, n + len(texts[-1]) + 1)
                if waiting[lang][1] >= WINDOW_BYTES:
                    yield from count(lang)
                elif sum(x[1] for x in waiting.values()) >= 2 * WINDOW_BYTES:
                    yield from count(max(waiting, key=lambda x: waiting[x][1]))
        for lang in list(waiting):
            yield from count(lang)
        for lang in list(counted):
            yield from emit(lang)

    return (docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                        F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "lang string, prefix string, slice int, nexts array<string>, "
                             "counts array<long>"))


def _merged(stripes: DataFrame, min_count: int) -> DataFrame:
    """``lang, prefix, next, a``: stripes of one prefix and slice added element by element, where
    the shuffle of the stripes has put them together; frequent entries only."""
    together = stripes.repartition("lang", "prefix", "slice")
    return (together.select("lang", "prefix", "slice", F.inline(F.arrays_zip("nexts", "counts")))
            .groupBy("lang", "prefix", "slice", "nexts").agg(F.sum("counts").alias("a"))
            .where((F.col("a") >= min_count) | (F.col("nexts") == ""))
            .select("lang", "prefix", F.col("nexts").alias("next"), "a"))


def _phrase(prefix: str = "prefix", last: str = "next") -> Column:
    return F.when(F.col(prefix) == "", F.col(last)).otherwise(F.concat_ws(" ", prefix, last))


def _exact(c, by: int) -> Column:
    return F.lit(by).cast("decimal(10,0)") * c.cast("decimal(20,0)")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, words, prefix, next, phrase, f`` of every phrase of one to four words that occurs at
    least ``min_count`` times, and a row with 0 words and the number of words per language."""
    out = held = None
    hot, total = {}, None
    for level in range(1, MAX_WORDS + 1):
        here = cut(_merged(_stripes(docs, level, held, hot), min_count), f"stripes-{level}")
        phrases = here.where("next <> ''").select("lang", _phrase().alias("phrase"), "a")
        rows = here.select("lang", F.when(F.col("next") == "", 0).otherwise(level).alias("words"),
                           "prefix", "next", _phrase().alias("phrase"), F.col("a").alias("f"))
        out = rows if out is None else out.unionByName(rows)
        if level == MAX_WORDS:
            break
        if total is None:
            total = here.where("next = ''").agg(F.sum("a")).first()[0] or 0
        if not total:
            break
        held = phrase_filter(phrases)
        # The counts of one level add up to at most ``total``: no more than SLICES of them are hot.
        hot = defaultdict(list)
        for r in phrases.where(F.col("a") * SLICES >= F.lit(total)).collect():
            hot[r["lang"]].append((r["phrase"], math.ceil(r["a"] * SLICES / total) + 1))
    return out


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of every language."""
    counts = phrase_counts(docs, min_count)
    known = counts.where("words > 0").select("lang", "phrase", "f")
    candidates = counts.where("words > 1").select("lang", "phrase", "words", "prefix",
                                                  F.col("f").alias("a"))
    # The greatest extension of every phrase: right ones are in its own stripe, left ones not.
    tail = F.expr("substring(phrase, char_length(substring_index(phrase, ' ', 1)) + 2)")
    longer = (candidates.where("words > 2")
              .select("lang", F.explode(F.array("prefix", tail)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    kept = (candidates.join(longer, ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | (_exact(F.col("most"), 100)
                                             < _exact(F.col("a"), SUBSUMED_PERCENT))))
    halves = kept.select("lang", "phrase", "a", F.explode(F.sequence(
        F.lit(1), F.col("words") - 1)).alias("k"))
    head = F.expr("substring_index(phrase, ' ', k)")
    rest = F.expr("substring(phrase, char_length(substring_index(phrase, ' ', k)) + 2)")
    halves = halves.withColumns({"head": head, "rest": rest})
    side = lambda part, count: known.select(
        "lang", F.col("phrase").alias(part), F.col("f").alias(count))
    scored = (halves.join(side("head", "l"), ["lang", "head"]).join(side("rest", "r"), ["lang", "rest"])
              .withColumn("score", F.expr(
                  "cast((cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0))) div "
                  "(cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)"))
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score",
                           F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    # A language's best are among the best of each of its salted parts.
    best = scored.withColumn("rank", rank("lang", "salt")).where(F.col("rank") <= top)
    best = best.withColumn("rank", rank("lang")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
b AS (SELECT lang, phrase, max(f) AS most FROM
      (SELECT lang, a AS f, unnest([array_to_string(ws[:k - 1], ' '), array_to_string(ws[2:], ' '),
              array_to_string(ws[:2], ' '), array_to_string(ws[2:3], ' '),
              array_to_string(ws[3:], ' ')]) AS phrase FROM c WHERE k > 2) GROUP BY ALL),
x AS (SELECT c.*, unnest(range(1, k)) AS j FROM c LEFT JOIN b USING (lang, phrase)
      WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT),
s AS (SELECT x.lang, x.phrase, x.a, j, l.f AS l, r.f AS r,
             ((2000000::HUGEINT * x.a) // (l.f + r.f))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(ws[:j], ' ')
             JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS cut FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM o WHERE cut = 1)
SELECT t.lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
