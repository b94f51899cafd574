"""The three shared long tables: coded concepts, references and identifiers.

A parsed document carries its shared rows as one array per table, numbered inside the
array. The long tables are plain explodes of those arrays, so numbering and the largest
number per resource need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.catalog import SHARED_TABLES, Catalog, Element
from chartloom.functions.dates import fhir_timestamp_sql
from chartloom.operators.flatten import (
    any_present,
    chosen_elements,
    parse_documents,
    resource_columns,
    without_empty_entries,
)
from chartloom.operators.frames import explode_present

# Value columns of each table, after id, field_name and seq_no.
VALUE_COLUMNS = {
    "codeableconcept": ["system", "version", "code", "display", "userselected", "text", "extension"],
    "reference": ["reference", "type", "identifier", "display", "extension"],
    "identifier": [
        "use", "type", "system", "value", "period_start", "period_end", "assigner", "extension",
    ],
}


def _struct(values: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {text}" for name, text in values.items()) + ")"


def _coding(coding: str, text: str, extension: str) -> str:
    fields = {c: f"{coding}.{c}" for c in ("system", "version", "code", "display")}
    fields["userselected"] = f"{coding}.userSelected"
    return _struct({**fields, "text": text, "extension": extension})


def merged_extension(concept: str, coding: str, position: str) -> str:
    """Extension list of one coding, with the concept's own extensions handed out.

    With extensions on both levels, the i-th one of the concept joins the i-th coding and
    codings past the shorter list get none. Without any on the codings, the first coding
    takes the concept's whole list.
    """
    own = f"{concept}.extension"
    joined = f"concat(coalesce({coding}.extension, array()), array(get({own}, {position})))"
    return f"""CASE
        WHEN {own} IS NULL THEN {coding}.extension
        WHEN exists({concept}.coding, x -> x.extension IS NOT NULL)
          THEN if({position} < size({own}), {joined}, NULL)
        WHEN {position} = 0 THEN {own} END"""


def concept_rows(concept: str) -> str:
    """One row per coding; a concept without a coding list stands for itself."""
    codings = _coding("g", f"{concept}.text", merged_extension(concept, "g", "p"))
    itself = _coding(concept, f"{concept}.text", f"{concept}.extension")
    return f"""if({concept}.coding IS NULL, array({itself}),
               transform({concept}.coding, (g, p) -> {codings}))"""


def reference_rows(reference: str) -> str:
    return f"array({_struct({c: f'{reference}.{c}' for c in VALUE_COLUMNS['reference']})})"


def identifier_rows(identifier: str) -> str:
    values = {c: f"{identifier}.{c}" for c in VALUE_COLUMNS["identifier"]}
    values["period_start"] = fhir_timestamp_sql(f"{identifier}.period.start")
    values["period_end"] = fhir_timestamp_sql(f"{identifier}.period.end")
    return f"array({_struct(values)})"


ROW_BUILDERS = {
    "codeableconcept": concept_rows,
    "reference": reference_rows,
    "identifier": identifier_rows,
}


def melted(elements: list[Element]) -> str:
    """Array of (field_name, items), one entry per element, scalars wrapped to a list."""
    entries = [
        _struct({"field_name": f"'{e.column}'", "items": _items(f"`{e.name}`", e.repeats)})
        for e in elements
    ]
    return f"filter(array({', '.join(entries)}), e -> e.items IS NOT NULL)"


def _items(value: str, repeats: bool) -> str:
    return value if repeats else f"if({value} IS NULL, NULL, array({value}))"


def numbered_rows(table: str, elements: list[Element]) -> str:
    """All shared rows of a document for one table, with dense numbers per field from 0."""
    columns = VALUE_COLUMNS[table]
    present = any_present([f"r.{c}" for c in columns])
    built = f"flatten(transform(f.items, v -> {ROW_BUILDERS[table]('v')}))"
    numbered = {"field_name": "f.field_name", "seq_no": "i", **{c: f"r.{c}" for c in columns}}
    rows = f"transform(filter({built}, r -> {present}), (r, i) -> {_struct(numbered)})"
    return f"flatten(transform({melted(elements)}, f -> {rows}))"


def normalize(
    lines: DataFrame,
    resource: str,
    catalog: Catalog,
    only: list[str] | None = None,
    tables: tuple[str, ...] = SHARED_TABLES,
) -> DataFrame:
    """Parse documents and lay out everything they hold in one row per document.

    The result has the wide columns, and per shared table the array `<table>_rows` and
    its `<table>_max_array_size`: the largest row number, 0 without rows. `only` limits the
    elements, `tables` the shared tables. Columns of the input other than `value` stay.
    """
    kept = [c for c in lines.columns if c != "value"]
    parsed = parse_documents(lines, resource, catalog, only)
    cleaned = without_empty_entries(parsed, resource, catalog, only)
    chosen = chosen_elements(resource, catalog, only)
    arrays, sizes = [], []
    for table in tables:
        elements = [e for e in chosen if catalog.shape(e) == table]
        if elements:
            arrays.append(f"{numbered_rows(table, elements)} AS {table}_rows")
            sizes.append(
                f"coalesce(array_max({table}_rows.seq_no), 0) AS {table}_max_array_size"
            )
    columns = resource_columns(resource, catalog, only)
    return cleaned.selectExpr(*kept, "id", *columns, *arrays).selectExpr("*", *sizes)


def shared_table(normalized: DataFrame, table: str) -> DataFrame:
    """Long rows of one shared table, keyed by (id, field_name, seq_no)."""
    return (
        explode_present(normalized.select("id", f"{table}_rows"), f"{table}_rows", "row")
        .select("id", "row.*")
        .withColumn("record_id", F.concat_ws("_", "id", "field_name", "seq_no"))
    )


def resource_table(normalized: DataFrame) -> DataFrame:
    """The wide table: everything but the row arrays."""
    return normalized.drop(*[f"{table}_rows" for table in SHARED_TABLES])
