r"""Chat formatting with schema fingerprints. DataFrame functions only.

Records of different layouts (prompt and completion, instruction, message lists, turn rows) become
canonical turns. A record's fingerprint hashes the paths of its nested fields; it selects one of
the declared :data:`MAPPINGS`, each of which says in column expressions where the turns are. For
JSON strings the paths come from each row's own schema, for typed columns from the column's type.
Rows with an unknown fingerprint keep a null mapping, so that they can be counted and reported.

A turn is written ``<turn role="ROLE">TEXT</turn>\n``. In ROLE and TEXT, ``\`` becomes ``\b`` and
``<`` becomes ``\l`` (in ROLE also ``"`` ``\q``); an escaped string holds no ``<``, so only control strings start with one,
and the escape is undone exactly. The loss mask lists the code point spans of assistant texts.

Defined results: null text or role is empty; turns are ordered by turn, then role, then text, null
turns first; repeated rows are turns of their own; a null ``conv_id`` is a conversation of its own;
an empty table gives the added conversation alone (or no rows); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

OPEN, CLOSE_ROLE, END = '<turn role="', '">', "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit('"'), F.lit("\\q"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\q"), F.lit('"')))


# ------------------------------------------------------------------------------ fingerprints

def paths_of_type(t: T.DataType, at: str = "$") -> list[str]:
    """Paths of all nested fields, sorted; leaves of any primitive type look alike."""
    if isinstance(t, T.StructType):
        return sorted(p for f in t.fields for p in paths_of_type(f.dataType, f"{at}.{f.name}"))
    if isinstance(t, T.ArrayType):
        return paths_of_type(t.elementType, f"{at}[]")
    return [at]


def fingerprint_of_type(t: T.DataType) -> str:
    return hashlib.md5("\n".join(paths_of_type(t)).encode()).hexdigest()


def fingerprint_of_json(value: Column) -> Column:
    """Hash of the row's own nested field paths, whatever the leaves' types; null if no JSON."""
    schema = F.schema_of_variant(F.try_parse_json(value))
    return F.md5(F.regexp_replace(
        schema, r"(?<=[:<] ?)(STRING|VOID|BIGINT|DOUBLE|BOOLEAN|DECIMAL\(\d+,\s?\d+\)|FLOAT)(?=[,>]|$)",
        "LEAF"))


@dataclass(frozen=True)
class Mapping:
    """``like`` is a record of the layout (its fingerprint selects the mapping); ``turns`` builds
    the canonical turns from a function that gets a field of the record as a given type."""
    name: str
    like: str
    turns: Callable[[Callable[[str, str], Column]], Column]


def _pair(user: Column, assistant: Column) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), user.alias("text")),
                   F.struct(F.lit("assistant").alias("role"), assistant.alias("text")))


def _listed(field: str, role: str, text: str):
    def turns(get):
        known = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
        return F.transform(get(field, f"array<struct<{role}:string,{text}:string>>"),
                           lambda m: F.struct(
                               F.coalesce(F.element_at(known, m[role]), m[role], F.lit(""))
                               .alias("role"), m[text].alias("text")))
    return turns


MAPPINGS = (
    Mapping("messages", '{"messages":[{"role":"user","content":"x"}]}',
            _listed("messages", "role", "content")),
    Mapping("conversations", '{"conversations":[{"from":"human","value":"x"}]}',
            _listed("conversations", "from", "value")),
    Mapping("turns", '{"turns":[{"turn":0,"role":"user","text":"x"}]}',
            lambda get: F.transform(F.array_sort(get(
                "turns", "array<struct<turn:bigint,role:string,text:string>>")),
                lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))),
    Mapping("instruction", '{"instruction":"x","output":"x"}',
            lambda get: _pair(get("instruction", "string"), get("output", "string"))),
    Mapping("instruction_input", '{"instruction":"x","input":"x","output":"x"}',
            lambda get: _pair(
                F.when(F.coalesce(get("input", "string"), F.lit("")) == "",
                       get("instruction", "string"))
                .otherwise(F.concat_ws("\n\n", get("instruction", "string"),
                                       get("input", "string"))),
                get("output", "string"))),
    Mapping("prompt_completion", '{"prompt":"x","completion":"x"}',
            lambda get: _pair(get("prompt", "string"), get("completion", "string"))),
    Mapping("prompt_response", '{"prompt":"x","response":"x"}',
            lambda get: _pair(get("prompt", "string"), get("response", "string"))),
)

#: Typed tables with a row per turn: fingerprint of ``(turn, role, text)``.
TURN_ROW = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                         T.StructField("text", T.StringType())])


def turns_from_json(records: DataFrame, conv_id: str, value: str) -> DataFrame:
    """Turn rows ``conv_id, turn, role, text, mapping`` of JSON records of any declared layout.
    A record whose layout is not declared gives one row with null mapping and turn."""
    v = F.try_parse_json(F.col(value))
    get = lambda field, kind: F.try_variant_get(v, f"$.{field}", kind)
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for m in reversed(MAPPINGS):
        own = F.col("__print") == fingerprint_of_json(F.lit(m.like))
        turns = F.when(own, m.turns(get).cast(TURNS)).otherwise(turns)
        name = F.when(own, F.lit(m.name)).otherwise(name)
    return (records.withColumn("__print", fingerprint_of_json(F.col(value)))
            .select(F.col(conv_id).alias("conv_id"), name.alias("mapping"), turns.alias("__t"))
            .select("conv_id", "mapping", F.posexplode_outer("__t").alias("turn", "__m"))
            .select("conv_id", F.col("turn").cast("long").alias("turn"),
                    F.col("__m.role").alias("role"), F.col("__m.text").alias("text"), "mapping"))


#: Fingerprints of typed layouts: how to get turn rows from a table of that type.
TYPED = {
    fingerprint_of_type(TURN_ROW): lambda df, key: df.select(
        F.col(key).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"),
    fingerprint_of_type(T.StructType([T.StructField("prompt", T.StringType()),
                                      T.StructField("completion", T.StringType())])):
        lambda df, key: df.select(F.col(key).alias("conv_id"), F.posexplode(
            _pair(F.col("prompt"), F.col("completion"))).alias("turn", "__m")).select(
            "conv_id", F.col("turn").cast("long").alias("turn"), "__m.role", "__m.text"),
    fingerprint_of_type(T.StructType([T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])))])):
        lambda df, key: df.select(F.col(key).alias("conv_id"), F.posexplode("messages")
                                  .alias("turn", "__m")).select(
            "conv_id", F.col("turn").cast("long").alias("turn"), "__m.role",
            F.col("__m.content").alias("text")),
}


def turns_from_table(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Turn rows of a typed table; the fingerprint of ``columns`` selects the mapping."""
    layout = T.StructType([df.schema[c] for c in columns])
    found = TYPED.get(fingerprint_of_type(layout))
    if found is None:
        raise ValueError(f"no mapping for the layout {paths_of_type(layout)}")
    return found(df.select(key, *columns), key)


# ---------------------------------------------------------------------------------- template

def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, marks``. ``marks`` has, per turn in order,
    where its piece and its text begin and end in ``formatted`` (code points, end exclusive) and
    whether the text is under the loss mask."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), escape_role(F.col("role")),
                                            F.lit(CLOSE_ROLE)))
    rows = rows.withColumn("body", escape(F.col("text")))
    size = F.char_length("head") + F.char_length("body") + len(END)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumns({
        "n": F.row_number().over(order),
        "piece_at": F.coalesce(F.sum(size.cast("long")).over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))})
    at = F.col("piece_at") + F.char_length("head")
    parts = F.array_sort(F.collect_list(F.struct(
        "n", F.concat("head", "body", F.lit(END)).alias("piece"), "piece_at", at.alias("start"),
        (at + F.char_length("body")).alias("end"), (F.col("role") == "assistant").alias("loss"))))
    return (rows.groupBy("conv_id").agg(parts.alias("parts"))
            .select("conv_id",
                    F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
                    F.transform("parts", lambda p: F.struct(
                        p["piece_at"].alias("piece_at"), p["start"].alias("start"),
                        p["end"].alias("end"), p["loss"].alias("loss"))).alias("marks")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts recovered from ``formatted`` and ``marks`` alone."""
    df = formatted.withColumn("pieces", F.split("formatted", END, -1))
    df = df.withColumn("pieces", F.slice("pieces", 1, F.size("pieces") - 1))
    role = lambda p: unescape_role(F.substring_index(
        F.substring(p, len(OPEN) + 1, 1 << 30), CLOSE_ROLE, 1))
    text = lambda p: unescape(F.substring(
        p, F.instr(p, CLOSE_ROLE) + len(CLOSE_ROLE), F.lit(1 << 30)))
    masked = F.zip_with("pieces", "marks", lambda p, m: F.when(m["loss"], unescape(F.substring(
        p, (m["start"] - m["piece_at"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))))
    return df.select("conv_id", "formatted", "marks",
                     F.transform("pieces", lambda p: F.struct(
                         role(p).alias("role"), text(p).alias("text"))).alias("turns"),
                     F.array_join(masked, "").alias("loss_text"))


CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = turns_from_table(spark.read.parquet(f"{sf_dir}/conversations.parquet"), "conv_id",
                             ["turn", "role", "text"])
    extra = spark.sql("SELECT id AS turn FROM range(2)").select(
        F.lit(-7).cast("long").alias("conv_id"), "turn",
        F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    back = read_back(format_turns(given.unionByName(extra)))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


_ESC = r"replace(replace({0}, '\', '\b'), '<', '\l')"
OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(OPEN) + len(CLOSE_ROLE) + len(END)} + length(replace({_ESC.format('role')}, '"', '\\q'))
           + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
