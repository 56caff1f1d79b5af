"""Quality rules with adaptive thresholds. DataFrame functions only.

Base counts per document come first (words, symbols, repeated lines and 8-word windows). The
verdict then compares a few ratios with fences learned from the corpus itself: for every language
and source, each ratio is folded into a relative-error quantile sketch (counts of logarithmic
bins). Sketches merge by adding counts. A group's quartiles are pooled with those of the merged
sketch one level up, with the weight of ``POOL`` documents: a source of few documents mostly follows
its language, a language of few the corpus, and the more documents a group has, the more it follows
its own, without a size at which it switches. A fence is the upper
quartile plus ``reach`` inter-quartile ranges plus a small margin. The fences are joined to the
documents by language and source, and documents beyond any fence are rejected.

Defined results: null text has no words (base failed); null language or source is a group of its
own; repeated rows are judged alike; an empty table gives no rows; other columns stay as they are
(in :func:`filter_quality`) or are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitroll.llm.common import NOT_WHITE, cut, lines_of, tuck, untuck, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
GAMMA = 1.02          # width of a sketch bin: quantiles are right to 1 %
TINY = 1e-6           # ratios up to here share the lowest bin
POOL = 50             # documents that the merged sketch one level up counts for


@dataclass(frozen=True)
class Rule:
    """One judged ratio. ``margin`` keeps the fence off the bulk when the quartiles coincide."""
    name: str
    margin: float
    reach: float = 6.0


RULES = (
    Rule("symbol_ratio", 0.05),
    Rule("dup_line_ratio", 0.50),
    Rule("repeat_word_ratio", 0.25),
    Rule("word_length", 4.0),
    Rule("stutter_ratio", 0.25),
)


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts and ratios in columns that start with ``__``."""
    lines = F.filter(lines_of(F.col("text")), lambda line: line.rlike(NOT_WHITE))
    df = docs.withColumns({"__w": words_of(F.col("text")), "__lines": lines})
    df = df.withColumns({
        "__n_words": F.size("__w").cast("long"),
        "__word_chars": F.char_length(F.array_join("__w", "")).cast("long"),
        "__n_symbols": F.char_length(F.regexp_replace(
            F.coalesce("text", F.lit("")), r"[^#*$%&|<>]+", "")).cast("long"),
        "__n_lines": F.size("__lines").cast("long"),
        "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__h": F.transform("__w", lambda w: F.xxhash64(w)),
    }).drop("__w", "__lines")
    df = df.withColumn("__win", F.when(F.size("__h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__h") - WINDOW),
        lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(WINDOW)]))))
    df = df.withColumn("__n_stutter", F.size(F.filter(
        "__h", lambda h, i: F.get("__h", i - 1).eqNullSafe(h))).cast("long"))
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__win")) < F.size("__win"),
        F.array_sort(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("__starts", F.array_sort(F.transform(
        F.filter("__sorted", lambda x, j: F.get("__sorted", j - 1)["h"].eqNullSafe(x["h"])
                 | F.get("__sorted", j + 1)["h"].eqNullSafe(x["h"])),
        lambda x: x["i"])))
    steps = F.transform("__starts", lambda x, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get("__starts", j + 1) - x, F.lit(WINDOW))))
    df = df.withColumn("__n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    return df.drop("__h", "__win", "__sorted", "__starts").withColumns({
        "__base_failed": (F.col("__n_words") < MIN_WORDS)
        | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PCT * F.col("__n_words")),
        "__symbol_ratio": _ratio("__n_symbols", "__word_chars"),
        "__dup_line_ratio": _ratio("__n_dup_lines", "__n_lines"),
        "__repeat_word_ratio": _ratio("__n_repeat_words", "__n_words"),
        "__word_length": _ratio("__word_chars", "__n_words"),
        "__stutter_ratio": _ratio("__n_stutter", "__n_words"),
    })


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def sketches(judged: DataFrame, rules=RULES) -> DataFrame:
    """Mergeable sketch rows ``rule, lang, source, bin, n``."""
    bins = F.array(*[F.struct(
        F.lit(r.name).alias("rule"),
        F.ceil(F.log(F.greatest(F.col(f"__{r.name}"), F.lit(TINY))) / F.log(F.lit(GAMMA)))
        .cast("int").alias("bin")) for r in rules])
    return (judged.where(~F.col("__base_failed"))
            .select("lang", "source", F.inline(bins))
            .groupBy("rule", "lang", "source", "bin").agg(F.count(F.lit(1)).alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy("rule", *keys)
    cum = (sketch.groupBy("rule", *keys, "bin").agg(F.sum("n").alias("n"))
           .withColumns({"total": F.sum("n").over(w), "upto": F.sum("n").over(w.orderBy("bin"))}))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.pow(
        F.lit(GAMMA), F.col("bin"))))
    return cum.groupBy("rule", *keys).agg(F.max("total").alias("total"), at(0.25).alias("q1"),
                                          at(0.75).alias("q3"))


def fences(sketch: DataFrame, rules=RULES, pool: int = POOL) -> DataFrame:
    """``lang, source`` and one upper fence per rule, from the group's quartiles pooled with its
    language's, and those with the corpus's."""
    every = _quartiles(sketch, []).select("rule", F.col("q1").alias("q1_all"),
                                          F.col("q3").alias("q3_all"))
    by_lang = _quartiles(sketch, ["lang"]).select(
        "rule", F.col("lang").alias("l"), F.col("total").alias("n_lang"),
        F.col("q1").alias("q1_lang"), F.col("q3").alias("q3_lang"))
    own = _quartiles(sketch, ["lang", "source"])
    joined = (own.join(by_lang, (own["rule"] == by_lang["rule"])
                       & own["lang"].eqNullSafe(by_lang["l"])).drop(by_lang["rule"])
              .join(every, "rule"))

    def pooled(q):
        lang = (F.col("n_lang") * F.col(f"{q}_lang") + pool * F.col(f"{q}_all")) / (F.col("n_lang") + pool)
        return (F.col("total") * F.col(q) + pool * lang) / (F.col("total") + pool)
    fence = pooled("q3") + F.col("reach") * (pooled("q3") - pooled("q1")) + F.col("margin")
    knobs = F.map_from_entries(F.array(*[F.struct(
        F.lit(r.name), F.struct(F.lit(r.margin).alias("margin"), F.lit(r.reach).alias("reach")))
        for r in rules]))
    return (joined.withColumn("knob", F.element_at(knobs, F.col("rule")))
            .withColumns({"margin": F.col("knob.margin"), "reach": F.col("knob.reach")})
            .groupBy("lang", "source").agg(*[
                F.max(F.when(F.col("rule") == r.name, fence)).alias(f"__fence_{r.name}")
                for r in rules]))


def judge(docs: DataFrame, rules=RULES, pool: int = POOL,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the base columns and the verdict
    ``__kept``. The counted documents are written once: the sketches then read only their few
    columns, and nothing is counted twice."""
    keep = list(docs.columns if keep is None else keep)
    counted = base_counts(docs)
    own = [c for c in counted.columns if c not in docs.columns]
    counted = cut(counted.select(*dict.fromkeys([*keep, "lang", "source", *own])), "quality")
    limits = cut(fences(sketches(counted, rules), rules, pool), "quality-fences")
    limits = limits.withColumnsRenamed({"lang": "__l", "source": "__s"})
    inside = F.lit(True)
    for r in rules:
        inside &= F.coalesce(F.col(f"__{r.name}") <= F.col(f"__fence_{r.name}"), F.lit(True))
    return (counted.join(limits, counted["lang"].eqNullSafe(F.col("__l"))
                         & counted["source"].eqNullSafe(F.col("__s")), "left")
            .withColumn("__kept", ~F.col("__base_failed") & inside).drop("__l", "__s"))


def filter_quality(docs: DataFrame, rules=RULES, pool: int = POOL) -> DataFrame:
    """The documents that pass, with their own columns."""
    return untuck(judge(tuck(docs, "text", "lang", "source"), rules, pool).where("__kept"),
                  docs)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = (spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text", "lang", "source"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept")
    return judge(docs, keep=["doc_id"]).select(
        "doc_id", *[F.col(f"__{n}").alias(n) for n in names])


def _op8_sql() -> str:
    ratios = {"symbol_ratio": ("n_symbols", "word_chars"),
              "dup_line_ratio": ("n_dup_lines", "n_full_lines"),
              "repeat_word_ratio": ("n_repeat_words", "n_words"),
              "word_length": ("word_chars", "n_words"),
              "stutter_ratio": ("n_stutter", "n_words")}
    cols = ", ".join(f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END AS {n}"
                     for n, (a, b) in ratios.items())
    long = " UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, lang, source, "
        f"CAST(ceil(ln(greatest({r.name}, {TINY!r})) / ln({GAMMA})) AS INTEGER) AS bin, "
        f"{r.margin} AS margin, {r.reach} AS reach FROM judged WHERE NOT base_failed"
        for r in RULES)

    def quartiles(name, keys):
        k = "".join(f", {x}" for x in keys)
        return f"""
{name}_c AS (SELECT rule{k}, bin, count(*) AS n FROM long GROUP BY rule{k}, bin),
{name}_u AS (SELECT *, sum(n) OVER (PARTITION BY rule{k}) AS total,
             sum(n) OVER (PARTITION BY rule{k} ORDER BY bin) AS upto FROM {name}_c),
{name} AS (SELECT rule{k}, max(total) AS total,
           min(pow({GAMMA}, bin)) FILTER (WHERE upto >= 0.25 * total) AS q1,
           min(pow({GAMMA}, bin)) FILTER (WHERE upto >= 0.75 * total) AS q3
           FROM {name}_u GROUP BY rule{k})"""
    def pooled(q):
        lang = f"((l.total * l.{q} + {POOL} * e.{q}) / (l.total + {POOL}))"
        return f"((o.total * o.{q} + {POOL} * {lang}) / (o.total + {POOL}))"
    ok = " AND ".join(
        f"coalesce({r.name} <= (SELECT fence FROM fences f WHERE f.rule = '{r.name}' "
        "AND f.lang IS NOT DISTINCT FROM j.lang AND f.source IS NOT DISTINCT FROM j.source), true)"
        for r in RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text
           FROM documents),
w AS (SELECT rid, doc_id, lang, source, text,
             list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)),
                         lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls FROM d),
p AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, string_agg(word, ' ') OVER win AS gram, count(*) OVER win AS k FROM p
      WINDOW win AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS times FROM g WHERE k = {WINDOW}),
c AS (SELECT rid, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {WINDOW}))
             AS covered FROM r WHERE times >= 2),
q AS (SELECT rid, i, word = lag(word) OVER (PARTITION BY rid ORDER BY i) AS again FROM p),
t AS (SELECT rid, count(*) FILTER (WHERE again) AS n_stutter FROM q GROUP BY rid),
n AS (SELECT rid, CAST(sum(covered) AS BIGINT) AS n_repeat_words FROM c GROUP BY rid),
b AS (SELECT w.rid, doc_id, lang, source, len(ws) AS n_words,
             length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(ls) AS n_full_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stutter, 0) AS n_stutter
      FROM w LEFT JOIN n ON w.rid = n.rid LEFT JOIN t ON w.rid = t.rid),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words
                  AS base_failed, {cols} FROM b),
long AS ({long}),{quartiles("own", ["lang", "source"])},{quartiles("bylang", ["lang"])},{
        quartiles("every", [])},
knobs AS (SELECT DISTINCT rule, margin, reach FROM long),
fences AS (SELECT o.rule, o.lang, o.source,
                  {pooled("q3")} + reach * ({pooled("q3")} - {pooled("q1")}) + margin AS fence
           FROM own o JOIN bylang l ON o.rule = l.rule AND o.lang IS NOT DISTINCT FROM l.lang
           JOIN every e ON o.rule = e.rule JOIN knobs k ON o.rule = k.rule)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {ok} AS kept
FROM judged j
"""


OP8_SQL = _op8_sql()
