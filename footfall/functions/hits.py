"""First hit of a visit.

The ``hits`` text is a Python literal: a list of dicts, or one dict.  Only its first
hit is kept, but the whole text has to be a valid literal, so all of it is parsed.
"""

import ast
import json
import math
import re
import sys
import warnings
from collections.abc import Callable, Iterable
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.contract import HIT_COLUMNS, HIT_SCHEMA

# Ship the code below with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_HIT = (None, None, None, None)

# Unclosed strings, and words that are values in JSON but not in a Python literal.
_NOT_OUTSIDE = ("'", '"', "true", "false", "null", "NaN", "Infinity")
_STRING = re.compile(r"""('[^']*'|"[^"]*")""")
_NOT_BRACKETS = re.compile(r"[^\[\]{}]+")
# The Python parser gives up at 200 nested brackets, the JSON parser only later.
_SAFE_DEPTH = 100


def _nesting(outside: str) -> int:
    depth = deepest = 0
    for bracket in _NOT_BRACKETS.sub("", outside):
        depth += 1 if bracket in "[{" else -1
        deepest = max(deepest, depth)
    return deepest


def _respell_as_json(text: str) -> str | None:
    """The same literal as JSON text, or None if that could change its meaning.

    Without backslashes a string ends at its own quote, so the text splits into strings
    (odd pieces) and all else (even pieces); if all strings are single-quoted, a plain
    split at the quotes will do.  What is no JSON after that fails to parse (adjacent or
    triple-quoted strings, say); what is, means the same in both languages.
    """
    if text[0] not in "[{" or text[-1] not in "]}" or "\\" in text or "\0" in text:
        return None
    if '"' in text:
        pieces = _STRING.split(text)
        pieces[1::2] = [string[1:-1].replace('"', '\\"') for string in pieces[1::2]]
    else:
        pieces = text.split("'")
    outside = "\0".join(pieces[::2])
    for unexpected in _NOT_OUTSIDE:
        if unexpected in outside:
            return None
    if outside.count("[") + outside.count("{") > _SAFE_DEPTH and _nesting(outside) > _SAFE_DEPTH:
        return None
    outside = outside.replace("True", "true").replace("False", "false").replace("None", "null")
    pieces[::2] = outside.split("\0")
    return '"'.join(pieces)


def _parse_literal(text: str):
    """``ast.literal_eval``, with a much faster way for literals that respell as JSON."""
    as_json = _respell_as_json(text)
    if as_json is not None:
        try:
            return json.loads(as_json)
        except ValueError:
            pass
    return ast.literal_eval(text)


def _as_text(value) -> str | None:
    """A value as Spark shows it in a string column (``true``, ``1.0E10``)."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return _float_text(value)
    return str(value)


def _float_text(value: float) -> str:
    if math.isinf(value):
        return "Infinity" if value > 0 else "-Infinity"
    if value == 0 or 1e-3 <= abs(value) < 1e7:
        return repr(value)
    sign, digits, exponent = Decimal(repr(value)).normalize().as_tuple()
    head, *tail = map(str, digits)
    fraction = "".join(tail) or "0"
    return f"{'-' if sign else ''}{head}.{fraction}E{exponent + len(digits) - 1}"


def first_hit_of_literal(text: str | None) -> tuple:
    """(hitType, pagePath, isInteraction, referer) of one ``hits`` text, else four Nones."""
    if not text:
        return NO_HIT
    try:
        hits = _parse_literal(text)
        first = hits if isinstance(hits, dict) else hits[0] if isinstance(hits, list) else None
        if not isinstance(first, dict):
            return NO_HIT
        page = first.get("page", {})
        if not isinstance(page, dict):
            return NO_HIT
        found = (first.get("type"), page.get("pagePath"), first.get("isInteraction"),
                 first.get("referer"))
        return tuple(map(_as_text, found))
    except Exception:  # any malformed text means "no hit", whatever it trips over
        return NO_HIT


@F.arrow_udf(HIT_SCHEMA)
def _first_hit_of_literals(texts: pa.Array) -> pa.Array:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SyntaxWarning)
        rows = [first_hit_of_literal(text) for text in texts.to_pylist()]
    columns = zip(*rows) if rows else [()] * len(HIT_COLUMNS)
    return pa.StructArray.from_arrays(
        [pa.array(column, pa.string()) for column in columns], names=HIT_COLUMNS)


# --- plain literals without Python ------------------------------------------------------------

_WORDS = {"True": "true", "False": "false", "None": "null"}
_TEXT_TYPES = ("VOID", "STRING", "BOOLEAN", "BIGINT")
_END = "$['\x01']"
_PATHS = ["$.type", "$.page.pagePath", "$.isInteraction", "$.referer"]


def _only(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, however often the function names it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _contains_any(text: Column, parts: Iterable[str]) -> Column:
    return reduce(Column.__or__, (F.contains(text, F.lit(part)) for part in parts))


def _plain_as_json(text: Column) -> Column:
    """A literal whose strings all are in single quotes, without escapes, as JSON text; else NULL.

    What is no JSON after respelling does not parse; what is, means the same in both languages, but
    for words that are values in JSON alone and for nesting that Python's parser refuses.  The
    words are respelled within strings too, which is the caller's to notice.  The literal is put
    into an object before an entry ``_END`` that it cannot hold itself, as the parser does not mind
    what follows a whole value.
    """
    brackets = F.length(text) * 2 - F.length(F.replace(text, F.lit("["), F.lit(""))) - F.length(
        F.replace(text, F.lit("{"), F.lit("")))
    plain = (
        F.substring(text, 1, 1).isin("[", "{") & ~_contains_any(text, ["\\", '"', *_WORDS.values()])
        & ((brackets <= _SAFE_DEPTH) | (F.length(_without_leaves(text)) == 0))
    )
    json_text = F.replace(text, F.lit("'"), F.lit('"'))
    for literal, word in _WORDS.items():
        json_text = F.replace(json_text, F.lit(literal), F.lit(word))
    return F.when(plain, F.concat(F.lit('{"hits":'), json_text, F.lit(',"\\u0001":0}')))


def _without_leaves(outside: Column) -> Column:
    """The brackets that are left once innermost pairs are taken away, some levels of them."""
    brackets = F.regexp_replace(outside, r"[^\[\]{}]+", "")
    for _ in range(6):
        brackets = F.regexp_replace(brackets, r"(\[\]|\{\})+", "")
    return brackets


def _hit_of_variant(hits: Column, text: Column) -> Column:
    """The first hit, or NULL where a value is no plain text, truth value or whole number, or may have
    been respelled."""
    def found(hit: Column) -> Column:
        values = [F.variant_get(hit, path, "variant") for path in _PATHS]
        kinds = [F.coalesce(F.schema_of_variant(value), F.lit("VOID")) for value in values]
        texts = [F.variant_get(hit, path, "string") for path in _PATHS]
        plain = [kind.isin(*_TEXT_TYPES) & ~((kind == "STRING") & _contains_any(value, _WORDS.values()))
                 for kind, value in zip(kinds, texts, strict=True)]
        page = F.coalesce(F.schema_of_variant(F.variant_get(hit, "$.page", "variant")), F.lit("OBJECT"))
        none = F.struct(*(F.lit(None).cast("string").alias(name) for name in HIT_COLUMNS))
        own = F.struct(*(value.alias(name) for value, name in zip(texts, HIT_COLUMNS, strict=True)))
        usable = F.coalesce(F.schema_of_variant(hit).startswith("OBJECT"), F.lit(False)) & page.startswith("OBJECT")
        return F.when(~usable, none).when(reduce(Column.__and__, plain), own)

    whole = F.variant_get(hits, _END, "int").isNotNull()
    hit = F.when(text.startswith("{"), F.variant_get(hits, "$.hits", "variant")).otherwise(
        F.variant_get(hits, "$.hits[0]", "variant"))
    return F.when(hits.isNotNull() & whole, _only(hit, found))


def _first_hit_of_plain(text: Column) -> Column:
    """The first hit of a plain literal by built-in functions; NULL for all other texts."""
    return _only(F.try_parse_json(_plain_as_json(text)), lambda hits: _hit_of_variant(hits, text))


_JSON_HIT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("page", T.StructType([T.StructField("pagePath", T.StringType())])),
    T.StructField("isInteraction", T.StringType()),
    T.StructField("referer", T.StringType()),
])


def _first_hit_of_json(text: Column) -> Column:
    hit = F.get(F.from_json(text, T.ArrayType(_JSON_HIT)), F.lit(0))
    paths = ["type", "page.pagePath", "isInteraction", "referer"]
    fields = []
    for name, path in zip(HIT_COLUMNS, paths):
        field = hit
        for part in path.split("."):
            field = field.getField(part)
        fields.append(field.alias(name))
    return F.struct(*fields)


def first_hit(hits: Column, dialect: str = "python_literal") -> Column:
    """Struct ``hitType, pagePath, isInteraction, referer`` of the first hit.

    ``python_literal`` follows the exports: a malformed text, an empty list or a
    ``page`` that is no dict gives four NULLs; JSON's ``true``/``null`` are malformed.
    ``json`` reads true JSON with built-in functions only; there a ``page`` that is no
    object merely leaves ``pagePath`` NULL.
    """
    if dialect == "python_literal":
        return _first_hit_of_literals(hits)
    if dialect == "json":
        return _first_hit_of_json(hits)
    raise ValueError(f"unknown hits dialect {dialect!r}")


def with_first_hit(df: DataFrame, hits: str, name: str, dialect: str = "python_literal") -> DataFrame:
    """Add the struct of :func:`first_hit`, with Python only for literals that need it.

    Plain literals (strings in single quotes without escapes, as exports write them) are respelled as
    JSON and parsed by built-in functions, whose strictness decides; Python gets the texts that
    do not parse so, and NULL for all others.  For sessions where Python workers are dear: parsing
    so is faster than Python's, but ``replace`` is slow, and all in all :func:`first_hit` took
    half as long (4.1 to 5.5 against 8.4 to 11 s for 160 MB of hits on eight cores).
    """
    if dialect != "python_literal":
        return df.withColumn(name, first_hit(F.col(hits), dialect))
    plain = df.withColumn(_PLAIN, _first_hit_of_plain(F.col(hits)))
    rest = F.when(F.col(_PLAIN).isNull(), F.col(hits))
    return plain.withColumn(name, F.coalesce(F.col(_PLAIN), _first_hit_of_literals(rest))).drop(_PLAIN)


_PLAIN = "_plain hit"
