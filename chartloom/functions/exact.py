"""JSON text with its numbers as they were written.

Spark prints the numbers of a nested JSON text through doubles, so 1.50 comes out as 1.5 and twenty decimal places as
seventeen digits; variants drop zeros as well and sort the fields. Here a document with numbers at risk is parsed once
more with all its numbers marked as texts, and its nested texts are taken from there, the marks removed. Documents
without such numbers are parsed once, as before.

A document that holds U+E000 itself is left to Spark's printing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "\ue000"
# A string, or a number outside of strings. All repetition is possessive, so long texts need no stack.
_TOKEN = r'("(?:[^"\\]++|\\.)*+")|(-?\d[\d.eE+\-]*+)'
# Numbers that a double prints in another way: zeros at the end, exponents, many digits, very small ones.
_AT_RISK = (
    r"[:\[,]\s*-?(?:\d+\.\d*0(?!\d)|\d+(?:\.\d+)?[eE]|\d+\.\d{9}|\d{7,}\.|0\.00)[\d.eE+\-]*\s*[,}\]]"
)
_UNMARK = f'"?{MARK}([^"]*)"?'


def at_risk(text: Column) -> Column:
    """Whether a JSON text may hold numbers that do not come out of a double as they went in."""
    reserved = F.contains(text, F.lit(MARK)) | text.rlike(r"\\u[eE]000")
    return text.rlike(_AT_RISK) & ~reserved


def marked(text: Column) -> Column:
    """JSON text whose numbers are strings that start with the mark."""
    apart = F.regexp_replace(text, _TOKEN, f"$1{MARK}$2{MARK}")
    numbers = F.replace(apart, F.lit(MARK * 2), F.lit(""))
    return F.regexp_replace(numbers, f"{MARK}([^{MARK}]*){MARK}", f'"{MARK}$1"')


def unmarked(text: Column) -> Column:
    """A piece of a marked text with the numbers as they were."""
    return F.when(F.contains(text, F.lit(MARK)), F.regexp_replace(text, _UNMARK, "$1")).otherwise(text)


def marked_where_needed(text: Column) -> Column:
    return F.when(at_risk(text), marked(text)).otherwise(text)


def text_part(kind: T.DataType) -> T.DataType | None:
    """The strings of a type and what leads to them; None if there are none."""
    if isinstance(kind, T.StringType):
        return kind
    if isinstance(kind, T.ArrayType):
        element = text_part(kind.elementType)
        return element and T.ArrayType(element)
    if isinstance(kind, T.StructType):
        fields = [(f.name, text_part(f.dataType)) for f in kind.fields]
        kept = [T.StructField(name, part) for name, part in fields if part is not None]
        return T.StructType(kept) if kept else None
    return None


def merged_sql(texts: T.DataType, plain: str, exact: str, kind: T.DataType, depth: int = 0) -> str:
    """SQL of a parsed value (`plain`, of type `kind`) with its `texts` from the value parsed with marks (`exact`)."""
    if isinstance(kind, T.ArrayType):
        x, i = f"x{depth}", f"i{depth}"
        item = merged_sql(texts.elementType, x, f"get({exact}, {i})", kind.elementType, depth + 1)
        return f"transform({plain}, ({x}, {i}) -> {item})"
    if isinstance(kind, T.StructType):
        fields = []
        for field in kind.fields:
            value, other = f"{plain}.`{field.name}`", f"{exact}.`{field.name}`"
            if field.name in texts.fieldNames():
                value = merged_sql(texts[field.name].dataType, value, other, field.dataType, depth)
            fields.append(f"'{field.name}', {value}")
        return f"if({plain} IS NULL, NULL, named_struct({', '.join(fields)}))"
    return f"coalesce(regexp_replace({exact}, r'{_UNMARK}', '$1'), {plain})"
