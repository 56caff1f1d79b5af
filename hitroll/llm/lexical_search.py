"""Ranked lexical search by pipelined term partitioning.

1. One pass over the documents counts the occurrences of the items' terms. Its rows hold *runs* of
   documents (a bounded number of rows of one task) with their postings; the number of documents
   of every term, the number of documents and their length are added up.
2. Terms are dealt to owners: one stage of terms for each share of documents that hold them, the
   rarest terms first; an owner holds a stage's postings of one run, with their integer impacts.
3. Bundles of items visit the owners stage after stage. A bundle carries a sparse accumulator of
   (item, document) scores; ``cogroup`` brings it together with the owner of its next terms, which
   adds their contributions and sends it on. After each stage the k-th best score of every item so
   far is known. An accumulator leaves when the most that later terms could add (their greatest
   impacts) keeps it below that score, and new documents enter only while they could still reach
   it. Both are exact: scores only grow.
4. The last stage returns each run's k best documents per item; the k best of all are selected.

Items are taken in blocks of ``BLOCK_BYTES`` of text (all documents are searched for each block),
so that what is collected and broadcast, the terms of one block, is bounded at any size.

Defined results: null or empty text has no terms; an item without terms has no rows; rows with
equal ``doc_id`` or ``item_id`` are separate documents and items; a document without ``doc_id``
counts in the statistics but is not returned; equal scores come by ascending ``doc_id``; an empty
table of either kind gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitroll.llm.common import cut, table

BLOCK_BYTES = 1 << 20              # of item text searched together
BUNDLE_ITEMS = 256                 # of one accumulator
RUN_DOCS, RUN_POSTINGS = 4096, 1 << 21
STAGE_SHARES = (1 / 64, 1 / 16, 1 / 4, 1.0)   # of documents that hold a stage's terms, at most

#: Bytes of terms, lower-cased; everything else is a space.
_TERM = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32
              for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 ``text`` in order."""
    return (text or b"").translate(_TERM).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


_INDEX = ("run long, docs long, length long, ids binary, sizes binary, terms binary, "
          "places binary, tfs binary, df_terms array<int>, df array<long>")


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Runs of documents with the postings of ``vocabulary`` (term to number, from 1), sorted by
    term; and one row per task with its number of documents per term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        look = shared.value.get
        held = np.zeros(len(shared.value) + 1, np.int64)
        names, k = [f.split()[0] for f in _INDEX.split(", ")], 0
        base = TaskContext.get().partitionId() << 32
        ids, sizes, found, counts, total = [], [], [], [], 0

        def flush():
            nonlocal k, ids, sizes, found, counts, total
            term = np.concatenate(found) if found else np.empty(0, np.int64)
            place = np.repeat(np.arange(len(found)), [len(x) for x in found])
            tf = np.concatenate(counts) if counts else np.empty(0, np.int64)
            order = np.argsort(term, kind="stable")
            np.add.at(held, term, 1)
            row = [base + k, sum(s > 0 for s in sizes), sum(sizes),
                   np.array(ids, np.int64).tobytes(), np.array(sizes, np.int64).tobytes(),
                   term[order].astype(np.int32).tobytes(), place[order].astype(np.int32).tobytes(),
                   tf[order].astype(np.int64).tobytes(), None, None]
            k += 1
            ids, sizes, found, counts, total = [], [], [], [], 0
            return batch_of([row])

        def batch_of(rows):
            types = [pa.int64()] * 3 + [pa.binary()] * 5 + [pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms(text)
                mine = np.fromiter(filter(None, map(look, words)), np.int64)
                term, tf = np.unique(mine, return_counts=True)
                ids.append(_NO_ID if doc is None else doc)
                sizes.append(len(words))
                found.append(term)
                counts.append(tf)
                total += len(term)
                if len(ids) >= RUN_DOCS or total >= RUN_POSTINGS:
                    yield flush()
        if ids:
            yield flush()
        there = np.flatnonzero(held)
        yield batch_of([[None] * 8 + [there.astype(np.int32), held[there]]])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
            .mapInArrow(run, _INDEX))


_NO_ID = np.iinfo(np.int64).min


def _owners(index: DataFrame, n_docs: int, length: int, stage_of: np.ndarray,
            bundle_terms: list[np.ndarray]) -> DataFrame:
    """Postings dealt to owners: per stage, bundle and run the terms, places and impacts; and one
    row per task with its greatest impact of every term."""
    shared = index.sparkSession.sparkContext.broadcast((stage_of, bundle_terms))

    def run(batches):
        stages, bundles = shared.value
        greatest = np.zeros(len(stages), np.int64)
        wanted = [np.isin(np.arange(len(stages)), t) for t in bundles]
        for batch in batches:
            for r in batch.to_pylist():
                term = np.frombuffer(r["terms"], np.int32)
                place = np.frombuffer(r["places"], np.int32)
                sizes = np.frombuffer(r["sizes"], np.int64)
                m = np.array([75 + 25 * int(n) * n_docs // length if length else 0 for n in sizes],
                             np.int64)
                gain = impacts(np.frombuffer(r["tfs"], np.int64), m[place])
                np.maximum.at(greatest, term, gain)
                out = []
                for s in range(len(STAGE_SHARES)):
                    for b, want in enumerate(wanted):
                        keep = (stages[term] == s) & want[term]
                        if keep.any():
                            out.append((s, b, r["run"], r["ids"], term[keep].tobytes(),
                                        place[keep].tobytes(), gain[keep].astype(np.int32).tobytes(),
                                        None, None))
                if out:
                    yield pd.DataFrame(out, columns=names)
        there = np.flatnonzero(greatest)
        yield pd.DataFrame([(None,) * 7 + (there.astype(np.int32), greatest[there])], columns=names)

    names = ["stage", "bundle", "run", "ids", "terms", "places", "gains", "max_terms", "max_gains"]

    def frames(batches):
        schema = pa.schema([("stage", pa.int32()), ("bundle", pa.int32()), ("run", pa.int64()),
                            *[(n, pa.binary()) for n in names[3:7]],
                            ("max_terms", pa.list_(pa.int32())), ("max_gains", pa.list_(pa.int64()))])
        for frame in run(batches):
            yield from pa.Table.from_pandas(frame, schema, preserve_index=False).to_batches()

    return index.where("run IS NOT NULL").mapInArrow(
        frames, "stage int, bundle int, run long, ids binary, terms binary, places binary, "
                "gains binary, max_terms array<int>, max_gains array<long>")


_BUNDLE = ("run long, bundle int, ids binary, items binary, places binary, scores binary, "
           "top_items array<int>, top_docs array<long>, top_scores array<long>")


def _visit(bundles: DataFrame | None, owners: DataFrame, members, floor: np.ndarray,
           before: np.ndarray, after: np.ndarray, k: int) -> DataFrame:
    """The bundles after their owners of one stage have added to them. ``members``: per bundle and
    term, the (item place in the bundle, weight) pairs. ``floor``: the k-th best score of every
    item so far; ``before`` and ``after``: the most that this and later, or only later, stages
    can add."""
    spark = owners.sparkSession
    shared = spark.sparkContext.broadcast((members, floor, before, after))
    if bundles is None:
        bundles = spark.createDataFrame([], _BUNDLE)

    def add(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        of, least, most_now, most_later = shared.value
        ids = np.frombuffer((right if len(right) else left)["ids"].iloc[0], np.int64)
        mine = np.arange(key[1] * BUNDLE_ITEMS, min((key[1] + 1) * BUNDLE_ITEMS, len(least)))
        score = np.zeros((len(mine), len(ids)), np.int64)
        if len(left):
            score[np.frombuffer(left["items"].iloc[0], np.int32),
                  np.frombuffer(left["places"].iloc[0], np.int32)] = np.frombuffer(
                      left["scores"].iloc[0], np.int64)
        score[score + most_now[mine, None] < least[mine, None]] = 0
        there = (score > 0) | (most_now >= least)[mine, None]
        if len(right):
            term = np.frombuffer(right["terms"].iloc[0], np.int32)
            place = np.frombuffer(right["places"].iloc[0], np.int32)
            gain = np.frombuffer(right["gains"].iloc[0], np.int32).astype(np.int64)
            starts = np.r_[0, np.flatnonzero(np.diff(term)) + 1, len(term)]
            for a, b in zip(starts[:-1], starts[1:]):
                for item, w in of[key[1]].get(int(term[a]), ()):
                    score[item, place[a:b]] += w * gain[a:b]     # a document once per term
        score[~there | (score + most_later[mine, None] < least[mine, None])] = 0
        tops = ([], [], [])
        named = ids != _NO_ID
        for i, row in enumerate(score):
            at = np.flatnonzero((row > 0) & named)
            if len(at) > k:
                edge = np.partition(row[at], len(at) - k)[len(at) - k]
                at = at[row[at] >= edge]
            at = at[np.lexsort((ids[at], -row[at]))[:k]]
            for out, v in zip(tops, (np.full(len(at), mine[i]), ids[at], row[at])):
                out.append(v)
        items, places = np.nonzero(score)
        tops = [np.concatenate(t) for t in tops]
        return pd.DataFrame([(key[0], key[1], ids.tobytes(), items.astype(np.int32).tobytes(),
                              places.astype(np.int32).tobytes(), score[items, places].tobytes(),
                              tops[0].astype(np.int32), tops[1], tops[2])],
                            columns=[f.split()[0] for f in _BUNDLE.split(", ")])

    return (bundles.groupBy("run", "bundle").cogroup(owners.groupBy("run", "bundle"))
            .applyInPandas(add, _BUNDLE))


def _best(bundles: DataFrame, k: int) -> DataFrame:
    """``item, doc_id, score, rank`` of the k best of every item over all runs."""
    each = bundles.select(F.inline(F.arrays_zip("top_items", "top_docs", "top_scores")))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return (each.toDF("item", "doc_id", "score")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def _search_block(docs: DataFrame, items: list[bytes | None], k: int) -> DataFrame | None:
    """``item`` (place in ``items``), ``doc_id, score, rank``; None without any term."""
    asked = [Counter(terms(t)) for t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)), 1)}
    if not vocabulary:
        return None
    index = cut(_index(docs, vocabulary), "index")
    n_docs, length = index.agg(F.sum("docs"), F.sum("length")).first()
    if not n_docs:
        return None
    held = np.zeros(len(vocabulary) + 1, np.int64)      # one number per term of the block
    for term, df in (index.where("df IS NOT NULL").select(F.inline(F.arrays_zip("df_terms", "df")))
                     .groupBy("df_terms").agg(F.sum("df")).collect()):
        held[term] = df
    weight = [term_weight(n_docs, int(df)) for df in held]
    stage_of = np.searchsorted(np.array(STAGE_SHARES) * n_docs, held).astype(np.int32)
    stage_of = np.minimum(stage_of, len(STAGE_SHARES) - 1)

    bundles = range(0, len(items), BUNDLE_ITEMS)
    members = [defaultdict(list) for _ in bundles]
    for place, counts in enumerate(asked):
        for t, times in counts.items():
            if held[vocabulary[t]] and weight[vocabulary[t]]:
                members[place // BUNDLE_ITEMS][vocabulary[t]].append(
                    (place % BUNDLE_ITEMS, times * weight[vocabulary[t]]))
    owners = cut(_owners(index, n_docs, length, stage_of,
                         [np.array(sorted(m), np.int64) for m in members]), "owners", "stage")
    greatest = np.zeros(len(vocabulary) + 1, np.int64)
    for term, gain in (owners.where("max_terms IS NOT NULL")
                       .select(F.inline(F.arrays_zip("max_terms", "max_gains")))
                       .groupBy("max_terms").agg(F.max("max_gains")).collect()):
        greatest[term] = gain

    # The most that the terms of every stage can add to an item.
    most = np.zeros((len(STAGE_SHARES) + 1, len(items)), np.int64)
    for b, of in enumerate(members):
        for t, pairs in of.items():
            for place, w in pairs:
                most[stage_of[t], b * BUNDLE_ITEMS + place] += w * greatest[t]
    left = most[::-1].cumsum(axis=0)[::-1]
    floor, state = np.zeros(len(items), np.int64), None
    for s in sorted({int(stage_of[t]) for of in members for t in of}):
        here = owners.where(F.col("stage") == s).drop("stage", "max_terms", "max_gains")
        state = cut(_visit(state, here, members, floor, left[s], left[s + 1], k), "bundles")
        if left[s + 1].any():
            for item, score in (_best(state, k).where(F.col("rank") == k)
                                .select("item", "score").collect()):   # one row per item at most
                floor[item] = score
    return None if state is None else _best(state, k)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every item."""
    spark, id_type = docs.sparkSession, items.schema["item_id"].dataType
    asked = items.select("item_id", F.col("text").cast("binary").alias("text"))
    size = asked.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    out = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = _search_block(docs, [r["text"] for r in rows], k)
        if found is None:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      _pairs(id_type))
        found = found.join(names, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame(
        [], f"item_id {id_type.simpleString()}, rank int, doc_id long, score long")


def _pairs(id_type) -> str:
    return f"item int, item_id {id_type.simpleString()}"


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                  table(spark, sf_dir, "benchmark").select("item_id", "text"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = ("unnest(regexp_extract_all(" + _LOWER
          + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")
OP13_SQL = f"""
WITH t AS (SELECT doc_id, {_TERMS.format("coalesce(text, '')")} AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM n),
q AS (SELECT item_id, term, count(*) AS times FROM
      (SELECT item_id, {_TERMS.format("coalesce(text, '')")} AS term FROM benchmark) GROUP BY 1, 2),
p AS (SELECT term, doc_id, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY 1, 2),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), s),
m AS (SELECT doc_id, 75 + (25 * n * nn) // ll AS m FROM n, s),
c AS (SELECT q.item_id, p.doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
   FROM c WHERE score > 0) WHERE rank <= 20
"""
