"""Wide resource tables: one projection from a parsed document to its columns.

The projection is generated from the catalogue as SQL text, which costs one call per column
instead of one per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.catalog import PRIMITIVE_COLUMN_TYPES, Catalog, Element
from chartloom.functions.dates import fhir_timestamp_sql
from chartloom.functions.exact import at_risk, marked, merged_sql


def chosen_elements(resource: str, catalog: Catalog, only: list[str] | None) -> list[Element]:
    return [e for e in catalog.elements(resource) if only is None or e.name in only]


def parse_documents(
    lines: DataFrame, resource: str, catalog: Catalog, only: list[str] | None = None
) -> DataFrame:
    """Parse the `value` column once; other columns stay. `only` prunes the parsed elements.

    Written as a generator of one row, because the optimizer copies the expression behind a
    plain column into every filter and join condition on it, and would parse again there.
    """
    schema, texts = catalog.struct_type(resource, only), catalog.json_texts(resource, only)
    kept = [c for c in lines.columns if c != "value"]
    doc, value = F.from_json("value", schema), F.col("value")
    if not texts.fields:
        return lines.select(*kept, F.inline(F.array(doc)))
    # Nested texts keep their numbers as written.
    exact = F.when(at_risk(value), F.from_json(marked(value), texts))
    both = lines.select(*kept, F.inline(F.array(F.struct(doc.alias("_doc"), exact.alias("_exact")))))
    columns = []
    for field in schema.fields:
        plain = f"_doc.`{field.name}`"
        if field.name in texts.fieldNames():
            found = merged_sql(texts[field.name].dataType, plain, f"_exact.`{field.name}`", field.dataType)
            plain = f"if(_exact IS NULL, {plain}, {found})"
        columns.append(f"{plain} AS `{field.name}`")
    return both.selectExpr(*kept, *columns)


def any_present(names: list[str]) -> str:
    """SQL condition: at least one of the values is not null."""
    return " OR ".join(f"{name} IS NOT NULL" for name in names)


def without_empty_entries(
    parsed: DataFrame, resource: str, catalog: Catalog, only: list[str] | None = None
) -> DataFrame:
    """Remove entries without any child from repeating complex values, and lists left empty.

    A step of its own, so that the columns cut from one value share the filtered list.
    """
    filtered = {}
    for element in chosen_elements(resource, catalog, only):
        children = catalog.children(element)
        if catalog.shape(element) == "array_complex" and children:
            present = any_present([f"e.`{c.name}`" for c in children])
            kept = f"filter(`{element.name}`, e -> {present})"
            filtered[element.name] = F.expr(f"nullif({kept}, array())")
    return parsed.withColumns(filtered) if filtered else parsed


def whole_number(value: str, depth: int) -> str:
    """Integers out of parsed doubles, through `depth` levels of arrays; NaN becomes null."""
    if depth:
        item = f"n{depth}"
        return f"transform({value}, {item} -> {whole_number(item, depth - 1)})"
    return f"try_cast(nullif({value}, double('NaN')) AS int)"


def _typed(value: str, element: Element, depth: int) -> str:
    """Target type of a primitive; dates inside arrays stay text."""
    column_type = PRIMITIVE_COLUMN_TYPES.get(element.fhir_type)
    if column_type == "INTEGER":
        return whole_number(value, depth)
    if column_type == "DECIMAL(20,10)":
        return f"try_cast({value} AS {'array<' * depth}decimal(20,10){'>' * depth})"
    if column_type == "DATETIME" and not depth:
        return fhir_timestamp_sql(value)
    return value


def element_columns(element: Element, catalog: Catalog) -> list[str]:
    """Columns an element contributes to the wide table; shared elements give none.

    A primitive, an extension list and a repeating backbone are one column each. All other
    complex values give a `parent_child` column per child: of the child itself when the
    value occurs once, else an aligned array, where a missing child is a null entry.
    """
    shape, name = catalog.shape(element), f"`{element.name}`"
    if shape in ("codeableconcept", "reference", "identifier"):
        return []
    children = catalog.children(element)
    if shape == "primitive":
        return [f"{_typed(name, element, int(element.repeats))} AS `{element.column}`"]
    if shape == "extension" or not children or (shape == "backbone" and element.repeats):
        return [f"{name} AS `{element.column}`"]
    outer = int(shape == "array_complex")
    return [
        f"{_typed(f'{name}.`{c.name}`', c, outer + int(c.repeats))} AS `{element.column}_{c.column}`"
        for c in children
    ]


def resource_columns(
    resource: str, catalog: Catalog, only: list[str] | None = None
) -> list[str]:
    """All wide columns of a resource type as SQL texts, in catalogue order."""
    return [
        column
        for element in chosen_elements(resource, catalog, only)
        for column in element_columns(element, catalog)
    ]


def flatten(
    lines: DataFrame, resource: str, catalog: Catalog, only: list[str] | None = None
) -> DataFrame:
    """Wide columns of documents, without the shared tables; other input columns stay."""
    kept = [c for c in lines.columns if c != "value"]
    parsed = parse_documents(lines, resource, catalog, only)
    cleaned = without_empty_entries(parsed, resource, catalog, only)
    return cleaned.selectExpr(*kept, "id", *resource_columns(resource, catalog, only))
