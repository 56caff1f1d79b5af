"""Jaccard self-join of word shingle sets with adaptive multi-match prefixes.

1. Every text becomes the set of its distinct k-word shingles (64-bit hashes). Equal sets are one
   class from here on, whose node is its smallest ``doc_id``. The same pass counts all shingles,
   and all words, in ``BUCKETS`` hash buckets each.
2. A shingle is in no more documents than its bucket counts, nor than the bucket of its rarest
   word does. Shingles are ordered by the lower of the two, then by hash: a global order, rare
   ones first. Two sets that link share at least m shingles among the first
   ``n - ceil(t n) + m`` of each, for every m. Each set picks its own m by estimated cost: the
   postings that its prefix emits, and the candidates that it would verify, fewer the more shared
   shingles they need. Costly sets thus get longer prefixes, and a pair must share as many prefix
   shingles as the less demanding of the two asks.
3. Postings that more than one set shares are candidates; sets with too few of them to meet their
   own condition leave, and the rest is counted again. Then, ``STAR_ROUNDS`` times, each posting
   list pairs its members with one hub and with their neighbours: as many pairs as postings. Where
   lists still join different components, pairs across components are compared, in blocks where a
   list is long, and only those that pass leave a block. Pairs that meet the prefix condition, and
   whose places in the order leave room for enough shared shingles, are verified. So a large group of near copies costs a few pairs per member, and no link that
   joins different components can be lost.

Verification compares whole sets. Defined results: null, empty or blank text has the empty set and
links with nothing; fewer than k words are one shingle; equal sets link; rows that share a
``doc_id`` are one document with several texts; a null ``doc_id`` has no component; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitroll.llm.common import WHITE, cut, discard, tuck, untuck
from hitroll.session import scratch_path
from hitroll.llm.components import components
from hitroll.llm.shingles import WordHasher, documents, shingle_set, weighted_shingles

BUCKETS = 1 << 20         # bytes on the driver and in each task, per table of counts
SLICES = 64
SALTS = 1024
MIN_MATCH, MAX_MATCH = 4, 16
POSTING_COST = 8          # of a posting, in units of comparing one shingle
CORE_ROUNDS = 1
STAR_ROUNDS = 2
SHORT_LIST = 8            # members of a posting list that is joined with itself
CHUNK_NODES = 1024        # of a longer list, sent together to meet as many
TILE_NODES = 256          # of those, compared at a time with as many
BLOCK_TOKENS = 1 << 13


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def set_digests(docs: DataFrame, k: int) -> DataFrame:
    """Rows ``doc_id, n, digest`` per document (digest null for the empty set), and per task rows
    ``slice, counts`` with its share of the bucket counts (shingles, then words)."""

    def run(batches):
        hasher, counts = WordHasher(), np.zeros((2, BUCKETS), np.uint32)
        for batch in batches:
            ids, sizes, digests, pending, held = batch.column(0), [], [], ([], []), 0
            for _, words in documents(batch.column(1), hasher):
                s = shingle_set(words, k)
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                pending[0].append(s)
                pending[1].append(np.unique(words))
                held += len(s)
                if held > 1 << 18:
                    counts += [_bucketed(p) for p in pending]
                    pending, held = ([], []), 0
            if held:
                counts += [_bucketed(p) for p in pending]
            nothing = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), nothing,
                 pa.nulls(len(sizes), pa.binary())], names=names)
        parts = [p.tobytes() for p in counts.reshape(2 * SLICES, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()),
             pa.nulls(len(parts), pa.binary()), pa.array(range(len(parts)), pa.int32()),
             pa.array(parts, pa.binary())], names=names)

    names = ["doc_id", "n", "digest", "slice", "counts"]
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n long, digest binary, slice int, counts binary"))


def _bucketed(sets: list[np.ndarray]) -> np.ndarray:
    h = np.concatenate(sets)
    return np.bincount(_bucket(h), minlength=BUCKETS).astype(np.uint32)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket_weights(digests: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents per bucket of shingles and of words, on a logarithmic scale of one byte per
    bucket. The per-task counts are added in two levels; two times ``BUCKETS`` bytes reach the
    driver at any size."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BUCKETS // SLICES, np.uint64)
        for blob in group["counts"]:
            total += np.frombuffer(blob, np.uint64 if len(blob) == 8 * len(total) else np.uint32)
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "salt": group["salt"].iloc[:1],
                             "counts": [total.tobytes()]})

    def scale(group: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(add(group)["counts"].iloc[0], np.uint64)
        byte = np.minimum(255, np.round(8 * np.log2(1.0 + total))).astype(np.uint8)
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "w": [byte.tobytes()]})

    parts = (digests.where("slice IS NOT NULL")
             .select("slice", F.pmod(F.xxhash64("counts"), F.lit(SALTS)).cast("int").alias("salt"),
                     "counts"))
    parts = parts.groupBy("slice", "salt").applyInPandas(add, "slice int, salt int, counts binary")
    rows = parts.groupBy("slice").applyInPandas(scale, "slice int, w binary").collect()
    out = np.zeros((2 * SLICES, BUCKETS // SLICES), np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["w"], np.uint8)
    return tuple(out.reshape(2, BUCKETS))


def least_match(n, percent: int):
    """What any partner of a set of ``n`` shingles asks for at least: it has ``t n`` shingles or
    more itself, and every set asks for ``MIN_MATCH`` or for all that a partner must share."""
    return min(MIN_MATCH, -(-percent * percent * n // 10_000))


def chosen_match(estimates: np.ndarray, n: int, need: int) -> int:
    """The number m of shared prefix shingles with the least estimated cost, for a set of ``n``
    shingles of which a partner shares ``need``. ``estimates``: others that hold the shingle, in
    prefix order. A candidate shares m of the postings and costs a comparison of whole sets;
    chance sharers thin out with the square of m."""
    upto = np.cumsum(estimates)
    choices = range(min(MIN_MATCH, need), min(MAX_MATCH, need) + 1)
    return min(choices, key=lambda m: POSTING_COST * m + n * upto[n - need + m - 1] / m ** 2)


def prefix_postings(docs: DataFrame, k: int, percent: int, weights) -> DataFrame:
    """``token, doc_id, n, pos, match``: the prefix shingles of every set and their places in the
    order, from 1. A task emits a set that it meets again only once."""
    others = np.maximum(0.0, np.exp2(np.arange(256) / 8.0) - 2.0)   # besides the set itself
    shared = docs.sparkSession.sparkContext.broadcast(weights)      # 2 * BUCKETS bytes

    def run(batches):
        hasher, seen = WordHasher(), set()
        by_shingle, by_word = shared.value
        for batch in batches:
            tokens, owners, sizes, places, matches = [], [], [], [], []
            ids = batch.column(0).to_pylist()
            for row, words in documents(batch.column(1), hasher):
                s, least = weighted_shingles(words, k, by_word[_bucket(words)])
                n = len(s)
                if not n or (digest := _digest(s)) in seen:
                    continue
                seen.add(digest)
                w = np.minimum(least, by_shingle[_bucket(s)])
                order = np.argsort(w, kind="stable")         # equal weights stay in hash order
                need = -(-percent * n // 100)
                longest = n - need + min(MAX_MATCH, need)
                first = order[:longest]
                match = chosen_match(others[w[first]], n, need)
                size = n - need + match
                tokens.append(s[first[:size]])
                places.append(np.arange(1, size + 1))
                owners.append(np.full(size, ids[row], np.int64))
                sizes.append(np.full(size, n))
                matches.append(np.full(size, match))
            if owners:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.concatenate(owners)),
                    pa.array(np.concatenate(sizes), pa.int64()),
                    pa.array(np.concatenate(places), pa.int32()),
                    pa.array(np.concatenate(matches), pa.int8())],
                    names=["token", "doc_id", "n", "pos", "match"])

    return (docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
            .mapInArrow(run, "token long, doc_id long, n long, pos int, match byte"))


def _shared_only(postings: DataFrame) -> DataFrame:
    sharing = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return postings.withColumn("sharing", sharing).where("sharing > 1").drop("sharing")


def _core(lists: DataFrame, percent: int) -> DataFrame:
    """The posting lists without sets that cannot meet the prefix condition with anyone: for some
    m from the least that a partner may ask up to their own, m shared postings of level m."""
    upto = [F.sum(F.when(F.col("level") <= m, 1).otherwise(0)).alias(f"c{m}")
            for m in range(1, MAX_MATCH + 1)]
    per = lists.groupBy("node").agg(F.max("n").alias("n"), F.max("match").alias("top"), *upto)
    least = F.least(F.lit(MIN_MATCH), F.ceil(percent * percent * F.col("n") / 10_000))
    enough = F.lit(False)
    for m in range(1, MAX_MATCH + 1):
        enough |= (F.lit(m) >= least) & (F.lit(m) <= F.col("top")) & (F.col(f"c{m}") >= m)
    return _shared_only(lists.join(per.where(enough).select("node"), "node", "left_semi"))


def class_sets(docs: DataFrame, k: int) -> DataFrame:
    """``node, s``: the whole set of each given document, as an array of hashes. A task emits
    equal rows once."""

    def rows(nodes, sets):
        ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
            names=["node", "s"])

    def run(batches):
        hasher, seen, nodes, sets, held = WordHasher(), set(), [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, words in documents(batch.column(1), hasher):
                s = shingle_set(words, k).view(np.int64)
                key = (ids[row], _digest(s))
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                nodes.append(ids[row])
                sets.append(s)
                held += len(s)
                if held > 1 << 18:                              # 2 MB at a time for the JVM
                    yield rows(nodes, sets)
                    nodes, sets, held = [], [], 0
        if nodes:
            yield rows(nodes, sets)

    return docs.select("node", "text").mapInArrow(run, "node long, s array<long>")


def _prefix_met(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs that share as many prefix shingles as the less demanding of the two asks, and
    that can link: up to the last shared place all that is shared is seen, and behind it at most
    the rest of either set is."""
    side = lambda x: prefixes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"),
                                     F.col("match").alias(f"m{x}"), F.col("held").alias(f"h{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("need", F.least("ma", "mb"))
    fit = lambda held: F.filter(held, lambda t: t["level"] <= F.col("need"))
    tokens = lambda held: F.transform(held, lambda t: t["token"])
    # Postings are in the global order, so the last of those in common is the last place of both.
    place = lambda x: F.get(f"h{x}", (F.array_position(
        f"t{x}", F.get("shared", F.size("shared") - 1)) - 1).cast("int"))["pos"]
    both = both.withColumns({"ha": fit("ha"), "hb": fit("hb")})
    both = both.withColumns({"ta": tokens("ha"), "tb": tokens("hb")})
    both = both.withColumn("shared", F.array_intersect("ta", "tb"))
    both = both.where((F.size("shared") >= F.col("need")) & (F.size("shared") > 0))
    most = F.size("shared") + F.least(F.col("na") - place("a"), F.col("nb") - place("b"))
    both = both.select("a", "b", (F.col("na") + F.col("nb")).alias("sum"), most.alias("most"))
    return (both.where(100 * F.col("most") >= percent * (F.col("sum") - F.col("most")))
            .select("a", "b"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    size = lambda s: F.size(s).cast("long")
    both = size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b")
            .select("a", "b", both.alias("both"), (size("sa") + size("sb")).alias("sum"))
            .where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both")))
            .select("a", "b").distinct())


def _by_node(df: DataFrame, name: str) -> DataFrame:
    """``df`` written bucketed and sorted by node: the joins that follow do not move it again."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "node").sortBy("node")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def _close(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _star_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """Per posting list: every member with the list's hub, and with its next neighbour. The first
    hub is the set with the least of its own in its prefix, which near copies are closest to;
    later ones come in a hash order."""
    order = [F.xxhash64("node", F.lit(turn)), F.col("node")]
    if turn == 0:
        order = [F.asc(F.col("own") / F.col("n")), *order]
    w = Window.partitionBy("token").orderBy(*order)
    one = F.struct("node", "n", "component")
    rows = lists.withColumns({"hub": F.first(one).over(w), "before": F.lag(one).over(w)})
    pair = F.explode(F.array("hub", "before"))
    return (rows.select("node", "n", "component", pair.alias("o"))
            .where((F.col("o.component") != F.col("component")) & _close("n", "o.n", percent))
            .select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b"))
            .distinct())


def _cross_pairs(lists: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Every pair across components that meets the prefix condition. Short lists are joined with
    themselves (a posting makes ``SHORT_LIST`` / 2 rows at most); long ones are compared in blocks
    that return only the pairs that pass."""
    size = cut(lists.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
               .where(F.col("size") > SHORT_LIST), "long-lists")
    sized = lists.join(size, "token", "left")
    short, long = sized.where("size IS NULL").drop("size"), sized.where("size IS NOT NULL")
    side = lambda x: short.select("token", *[F.col(c).alias(f"{c}_{x}") for c in
                                             ("node", "n", "pos", "level", "match", "component")])
    need = F.least("match_a", "match_b")
    # Not more is shared than lies before the lesser and behind the later of the two places.
    room = F.least("pos_a", "pos_b") + F.least(F.col("n_a") - F.col("pos_a"),
                                               F.col("n_b") - F.col("pos_b"))
    few = (side("a").join(side("b"), "token")
           .where((F.col("node_a") < F.col("node_b"))
                  & (F.col("component_a") != F.col("component_b")) & _close("n_a", "n_b", percent)
                  & (F.greatest("level_a", "level_b") <= need)
                  & (100 * room >= percent * (F.col("n_a") + F.col("n_b") - room)))
           .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
    few = _prefix_met(few, prefixes, percent)
    return few.unionByName(_block_pairs(long, lists, percent)).distinct()


def _block_pairs(long: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The same for long lists, dealt into chunks of about ``CHUNK_NODES`` members; each pair of
    chunks is one group. Members bring their open prefix postings along, so that a group can tell
    how many prefix shingles a pair shares; of the lists that a pair meets in, the one of its first
    shared shingle returns it."""
    held = lists.groupBy("node").agg(F.array_sort(F.collect_list(
        F.struct("pos", "token", "level"))).alias("held"))
    chunks = F.ceil(F.col("size") / CHUNK_NODES).cast("int")
    mine = F.pmod(F.xxhash64("node"), chunks).cast("int")
    rows = (long.join(held, "node")
            .select("token", "node", F.col("n").cast("long").alias("n"), "pos", "level", "match",
                    "component", *[F.col(f"held.{c}").alias(f"held_{c}")
                                   for c in ("token", "pos", "level")],
                    mine.alias("chunk"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
            .withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
            .drop("other"))

    def compare(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [pair for across, rows in _tiles(pdf, key[1] != key[2])
                 for pair in _met_in_block(across, rows, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("token", "low", "high").applyInPandas(compare, "a long, b long")


def _tiles(rows: pd.DataFrame, across: bool):
    """Every two parts of ``TILE_NODES`` members that have pairs to compare, as one frame by node;
    and whether only pairs of different ``chunk`` count (numbered here by part)."""
    sides = [side for _, side in rows.groupby("chunk")]
    parts = [[side.iloc[k:k + TILE_NODES] for k in range(0, len(side), TILE_NODES)]
             for side in sides]
    if across and len(sides) < 2:                       # no member fell to the other chunk
        return
    for i, a in enumerate(parts[0]):
        if not across:
            yield False, a.sort_values("node", ignore_index=True)
        for b in parts[1] if across else parts[0][i + 1:]:
            both = pd.concat([a.assign(chunk=0), b.assign(chunk=1)])
            yield True, both.sort_values("node", ignore_index=True)


def _met_in_block(across: bool, rows: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Pairs of nodes of one list (``rows`` by node; of different chunks if ``across``) that meet
    the prefix condition and whose first shared shingle is the list's."""
    node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
    match, chunk = rows["match"].to_numpy(), rows["chunk"].to_numpy()
    component = rows["component"].to_numpy()
    ok = np.triu(np.ones((len(rows),) * 2, bool), 1) & (component[:, None] != component)
    ok &= 100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n)
    need = np.minimum.outer(match, match)
    ok &= np.maximum.outer(rows["level"].to_numpy(), rows["level"].to_numpy()) <= need
    if across:
        ok &= chunk[:, None] != chunk
    if not ok.any():
        return []
    sizes = [len(x) for x in rows["held_token"]]
    who = np.repeat(np.arange(len(rows)), sizes)
    token, pos, level = (np.concatenate(rows[f"held_{c}"].to_numpy()) for c in ("token", "pos", "level"))
    _, place, times = np.unique(token, return_inverse=True, return_counts=True)
    both = times[place] > 1                              # the others are shared by no pair
    who, pos, level, place = who[both], pos[both], level[both], place[both]
    kinds, place = np.unique(place, return_inverse=True)
    early = pos < rows["pos"].to_numpy()[who]

    def shared(some: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows),) * 2, np.float32)
        for first in range(0, len(kinds), BLOCK_TOKENS):
            here = some & (place >= first) & (place < first + BLOCK_TOKENS)
            block = np.zeros((len(rows), min(BLOCK_TOKENS, len(kinds) - first)), np.float32)
            block[who[here], place[here] - first] = 1
            out += block @ block.T
        return out

    total = np.zeros((len(rows),) * 2, np.float32)
    for m in np.unique(need[ok]):
        of_m = ok & (need == m)
        seen = shared(level <= m)
        ok[of_m & ((seen < m) | (shared((level <= m) & early) > 0))] = False
        total[of_m] = seen[of_m]
    out = []
    held = list(zip(rows["held_token"], rows["held_pos"], rows["held_level"]))
    for i, j in zip(*np.nonzero(ok)):
        m = need[i, j]
        (ti, pi, li), (tj, pj, lj) = held[i], held[j]
        _, x, y = np.intersect1d(ti[li <= m], tj[lj <= m], return_indices=True)
        most = int(total[i, j]) + min(n[i] - pi[li <= m][x].max(), n[j] - pj[lj <= m][y].max())
        if 100 * most >= percent * (n[i] + n[j] - most):
            out.append((node[i], node[j]))
    return out


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (doc_id, text): sets of distinct
    ``k``-word shingles link from a Jaccard similarity of ``percent`` / 100 on."""
    first = cut(set_digests(docs, k), "digests")
    weights = bucket_weights(first)
    sized = cut(first.where("slice IS NULL").select("doc_id", "n", "digest"), "sets-sized")
    discard(first)
    # Written, so that the joins with it can split the digest of a large group of copies.
    classes = cut(sized.where("digest IS NOT NULL").groupBy("digest")
                  .agg(F.min("doc_id").alias("node")), "classes")
    node_of = (sized.where("doc_id IS NOT NULL").join(classes, "digest")
               .select("doc_id", "n", "node").distinct())
    postings = prefix_postings(docs, k, percent, weights).repartition("token")
    free = F.col("n") - F.ceil(percent * F.col("n") / 100)
    lists = _shared_only(postings).join(node_of, ["doc_id", "n"]).drop("doc_id")
    lists = _shared_only(lists.dropDuplicates(["token", "node"]))
    lists = cut(lists.withColumn("level", F.greatest(F.lit(1), F.col("pos") - free).cast("int")),
                "postings")
    for _ in range(CORE_ROUNDS):
        before, lists = lists, cut(_core(lists, percent), "postings")
        discard(before)
    prefixes = cut(lists.groupBy("node").agg(
        F.max("n").alias("n"), F.max("match").alias("match"),
        F.array_sort(F.collect_list(F.struct("pos", "token", "level"))).alias("held")), "prefixes")
    own = (free + F.col("match") - F.size("held")).alias("own")
    before, lists = lists, cut(lists.join(prefixes.select("node", own), "node")
                               .withColumn("component", F.col("node")), "postings")
    discard(before)
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    sets = _by_node(class_sets(texts.join(prefixes.select("node"), "node", "left_semi"), k), "sets")

    links = found = None
    for turn in range(STAR_ROUNDS + 1):
        open_lists = _open(lists if found is None else _relabelled(lists, found))
        if turn < STAR_ROUNDS:
            pairs = _prefix_met(_star_pairs(open_lists, percent, turn), prefixes, percent)
        else:
            open_lists = cut(open_lists, "open-postings")
            discard(lists)
            pairs = _cross_pairs(open_lists, prefixes, percent)
        pairs = cut(pairs, "pairs")
        more = cut(_verified(pairs, sets, percent), "links")
        discard(pairs)
        links = more if links is None else links.unionByName(more)
        found = cut(components(links), "components")

    own = sized.join(classes, "digest", "left")
    return (own.join(found, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "node", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every group of linked ones: that of the smallest ``doc_id``, once.
    Rows that link with nothing stay, those with a null ``doc_id`` too. Different texts of one
    ``doc_id`` are told apart here: each stays unless it links."""
    rows, several = _own_ids(tuck(docs, "doc_id", "text"))
    named = rows.where("doc_id IS NOT NULL")
    group = (near_duplicates(named.select(F.col("__id").alias("doc_id"), "text"), k, percent)
             .select(F.col("doc_id").alias("__id"), "component_id").distinct())
    if several:
        first = F.min(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "__id"))
        kept = (named.select("doc_id", "__id").join(group, "__id").groupBy("component_id")
                .agg(first.alias("first")).select(F.col("first.__id").alias("__id")))
    else:
        kept = group.where("__id = component_id").select("__id")
    named = named.join(kept, "__id", "left_semi").dropDuplicates(["__id"])
    return untuck(named.unionByName(rows.where("doc_id IS NULL")), docs)


def _own_ids(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` with ``__id``: the ``doc_id``, but a hash for all but one of several texts that
    share it; and whether there are any such. Blank texts are one text."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), f"^{WHITE}$", "")
    rows = rows.withColumn("__id", F.col("doc_id").cast("long"))
    hashed = rows.withColumn("__text", F.xxhash64(text))
    several = cut(hashed.where("__id IS NOT NULL").groupBy("__id")
                  .agg(F.min("__text").alias("__one"), F.max("__text").alias("__last"))
                  .where("__one <> __last").drop("__last"), "several")
    if several.isEmpty():
        return rows, False
    own = F.when(F.col("__text") != F.col("__one"), F.xxhash64("__id", "__text"))
    return (hashed.join(several, "__id", "left").withColumn("__id", F.coalesce(own, "__id"))
            .drop("__one", "__text")), True


def _open(lists: DataFrame) -> DataFrame:
    """The posting lists that still hold more than one component."""
    w = Window.partitionBy("token")
    return (lists.withColumns({"lo": F.min("component").over(w), "hi": F.max("component").over(w)})
            .where("lo <> hi").drop("lo", "hi"))


def _relabelled(lists: DataFrame, found: DataFrame) -> DataFrame:
    lists = lists.drop("component")
    return (lists.join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node")))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, k=3, percent=90)


OP5_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t-\\r]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g
      AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * k >= 90 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION
      SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       (SELECT min(root) FROM r WHERE r.node = d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
