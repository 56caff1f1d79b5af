"""Scalar column helpers. All of them are built-in Spark expressions (codegen, no Python).

They re-express the per-row rules of the hit parser (SURVEY 2.0, rules R9, R16, R18, R21):
how a score is read as a float, how the classification code is read from the JSON cell, and how
a structure id is derived from a file name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitroll.fixed import CODE_KEY, HIT_FILE_SUFFIX, MEAN_MARKER  # noqa: F401 (re-exported)

# A float literal as Python's float() reads it: optional sign, digits with single underscores
# between them, optional fraction and exponent, or inf / infinity / nan in any case, with
# surrounding whitespace allowed. Java-side try_cast alone would accept "90d" and reject "1_0".
_DIGITS = r"\d(?:_?\d)*"
_NUMBER = rf"(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
PY_FLOAT_RE = rf"^\s*[+-]?(?:{_NUMBER}|(?i:inf|infinity|nan))\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_float(c) -> Column:
    """Parse text as a double the way Python ``float`` does; NULL when it would raise."""
    s = F.trim(_c(c))
    is_nan = F.lower(F.regexp_replace(s, r"^[+-]", "")) == F.lit("nan")
    cast = F.regexp_replace(s, "_", "").try_cast("double")
    return (F.when(~F.coalesce(s.rlike(PY_FLOAT_RE), F.lit(False)), F.lit(None).cast("double"))
             .when(is_nan, F.lit(float("nan")))
             .otherwise(cast))


# Reasons a JSON metadata cell is unusable, in the order the checks apply.
R_JSON, R_KEY, R_NESTED = "bad_json", "missing_key", "nested_value"


_STRICT_QUOTES = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def _python_json(cell: Column, alone: Column, member: Column, key: str) -> Column:
    """What ``json.loads`` reads from a cell that the strict parser refuses for a repeated key or a
    ``NaN``: ``ok`` (one object and nothing else), ``present``, ``value`` and, for strings as they
    are and for anything else as JSON, ``raw`` of the last ``key``."""
    typed = T.ArrayType(T.StructType([T.StructField(key, T.VariantType())]))
    texts = T.MapType(T.StringType(), T.StringType())
    values = F.from_json(alone, typed, _STRICT_QUOTES)
    entries = F.from_json(alone, T.ArrayType(texts), _STRICT_QUOTES)
    within = F.from_json(member, T.MapType(T.StringType(), texts), _STRICT_QUOTES)
    # Outside strings, a valid cell has a plus sign in exponents only.
    bare = F.regexp_replace(F.regexp_replace(cell, r"(?s)\\.", ""), '"[^"]*"', "")
    ok = ((F.size(entries) == 1) & F.get(entries, F.lit(0)).isNotNull() & values.isNotNull()
          & within.isNotNull() & ~bare.rlike(r"INF|(?<![eE])\+"))
    of_key = F.filter(F.map_entries(F.get(entries, F.lit(0))), lambda e: e["key"] == key)
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), (F.size(of_key) > 0).alias("present"),
                    F.get(values, F.lit(0))[key].alias("value"),
                    F.try_element_at(of_key, F.lit(-1))["value"].alias("raw"))


def with_json_check(df: DataFrame, cell: str, key: str = CODE_KEY, code_col: str = "_code",
                    reason_col: str = "_json_reason") -> DataFrame:
    """Code and reason columns for a JSON metadata cell, following ``str(json.loads(cell)[key])``.

    The code is NULL exactly when the reason is set: not JSON or not one object, key absent, or
    the value is an object or array (unhashable as a dict key). JSON null becomes the text
    ``None``, booleans ``True`` / ``False``, and ``NaN`` and the infinities ``nan``, ``inf`` and
    ``-inf``, as Python prints them (R9). Of a repeated key the last value counts, and text after
    the object makes the cell bad (R21).

    The cell is parsed once into a variant column and every test reads that column. (Catalyst
    keeps the stages apart because it does not duplicate costly expressions when collapsing
    projections.) The parser stops behind the first value, so it is given the cell between
    brackets; a cell that has a bracket of its own is also tried as the member of an object, since
    text that closes one of the two early leaves the other one broken. Only cells that the parser
    refuses are read again, with repeated keys and ``NaN`` allowed. Helper columns start with
    ``_j``."""
    text = F.col(cell)
    alone = F.concat(F.lit("["), text, F.lit("]"))
    member = F.concat(F.lit('{"":'), text, F.lit("}"))
    v = df.withColumn("_jv", F.try_parse_json(alone))
    v = v.withColumn("_jl", F.when(F.col("_jv").isNull() & text.isNotNull(),
                                   _python_json(text, alone, member, key)))
    v = v.withColumn("_jdata", F.try_variant_get("_jv", "$[0]", "variant"))
    single = (F.schema_of_variant("_jdata").startswith("OBJECT")
              & F.try_variant_get("_jv", "$[1]", "variant").isNull()
              & (~F.contains(text, F.lit("]")) | F.try_parse_json(member).isNotNull()))
    again = F.col("_jl").isNotNull()
    v = v.withColumn("_jok", F.coalesce(F.when(again, F.col("_jl.ok")).otherwise(single), F.lit(False)))
    v = v.withColumn("_jval", F.when(again, F.col("_jl.value")).otherwise(
        F.try_variant_get("_jdata", f"$.{key}", "variant")))
    v = v.withColumn("_jvkind", F.schema_of_variant("_jval"))
    val, vkind, raw = F.col("_jval"), F.col("_jvkind"), F.col("_jl.raw")
    printed = F.try_variant_get(val, "$", "string")
    # A value with repeated keys of its own has a raw text only; an earlier one may stand in its place.
    lost = raw.rlike(r"^[{\[]") & ~raw.eqNullSafe(printed)
    nested = vkind.startswith("OBJECT") | vkind.startswith("ARRAY") | F.coalesce(lost, F.lit(False))
    present = F.when(again, F.col("_jl.present")).otherwise(val.isNotNull())
    reason = (F.when(~F.col("_jok"), F.lit(R_JSON)).when(~present, F.lit(R_KEY))
               .when(nested, F.lit(R_NESTED)))
    # These are the only values that are a string, yet raw has quotes about it.
    number = again & (raw == F.concat(F.lit('"'), printed, F.lit('"')))
    text = (F.when(val.isNull() | (vkind == "VOID"), F.lit("None"))
             .when(vkind == "BOOLEAN",
                   F.when(F.try_variant_get(val, "$", "boolean"), F.lit("True"))
                    .otherwise(F.lit("False")))
             .when(number & (printed == "NaN"), F.lit("nan"))
             .when(number & (printed == "Infinity"), F.lit("inf"))
             .when(number & (printed == "-Infinity"), F.lit("-inf"))
             .otherwise(printed))
    v = v.withColumn(reason_col, reason)
    v = v.withColumn(code_col, F.when(F.col(reason_col).isNull(), text))
    return v.drop("_jv", "_jl", "_jdata", "_jok", "_jval", "_jvkind")


def structure_id(name, suffix: str = HIT_FILE_SUFFIX) -> Column:
    """Structure id from a hit file name: the literal suffix removed (R16 fixed; the reference
    strips a character set, so ``sample_search.tsv`` would become ``sampl`` there)."""
    pat = suffix.replace(".", r"\.") + "$"
    return F.regexp_replace(_c(name), pat, "")


def basename(path) -> Column:
    """Last path component (SC1)."""
    return F.regexp_extract(_c(path), r"([^/]*)/*$", 1)


def normalise_name(c) -> Column:
    """Dataset names are compared stripped and lower-cased (R14)."""
    return F.lower(F.trim(_c(c)))


def percent_difference(a, b) -> Column:
    """SC13: how far ``b`` lies from ``a``, in percent of ``a``; NULL where ``a`` is 0."""
    return F.try_divide(_c(b) - _c(a), _c(a)) * F.lit(100.0)
