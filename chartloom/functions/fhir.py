"""Values out of parsed FHIR elements, as columns."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.keys import hash64

ADDRESS_TEXTS = ["use", "type", "text", "city", "district", "state", "postalCode", "country"]
NAME_TEXTS = ["use", "text", "family"]


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _path_value(extension: Column, path: str) -> Column:
    """JSON text at a dotted path. A list on the way stands for its entries' values.

    Any step but the last may meet an object or a list, so every combination is tried.
    """
    *inner, last = path.split(".")
    ways = product(*[(step, f"{step}[*]") for step in inner])
    return F.coalesce(*[F.get_json_object(extension, ".".join(["$", *way, last])) for way in ways])


def extension_display(extensions: Column, urls: list[str], paths: list[str]) -> Column:
    """Display of the first top-level extension with one of the urls and a value at a path.

    Extensions are JSON texts. A list value counts by its first entry; a value that is no
    object has no display.
    """

    def value_of(extension: Column) -> Column:
        return F.coalesce(*[_path_value(extension, path) for path in paths])

    fitting = F.filter(
        extensions,
        lambda e: F.get_json_object(e, "$.url").isin(urls) & value_of(e).isNotNull(),
    )
    value = value_of(first(fitting))
    return F.coalesce(
        F.get_json_object(value, "$.display"), F.get_json_object(value, "$[0].display")
    )


def reference_key(references: Column, resource_type: str) -> Column:
    """64-bit key of the first reference to the given type."""
    fitting = F.filter(references, lambda r: F.contains(r["reference"], F.lit(resource_type)))
    return hash64(F.get(F.split(first(fitting)["reference"], "/"), F.lit(1)))


def address_parts(addresses: Column) -> Column:
    """First address as a struct of texts, missing ones empty, with a key of its lines."""
    address = first(addresses)
    line_1 = _text(F.get(address["line"], F.lit(0)))
    line_2 = _text(F.get(address["line"], F.lit(1)))
    texts = {c: _text(address[c]) for c in ADDRESS_TEXTS}
    parts = F.struct(
        hash64(F.concat(line_1, line_2, texts["postalCode"])).alias("location_id"),
        line_1.alias("address_1"),
        line_2.alias("address_2"),
        *[value.alias(c.lower()) for c, value in texts.items()],
    )
    return F.when(address.isNotNull(), parts)


def human_name_parts(names: Column) -> Column:
    """First name as a struct, with a full name of prefix, given names, family and suffix."""
    name = first(names)
    prefix, suffix = _text(first(name["prefix"])), _text(first(name["suffix"]))
    given = F.coalesce(name["given"], F.array().cast("array<string>"))
    pieces = F.concat(F.array(prefix), given, F.array(name["family"], suffix))
    spoken = F.filter(pieces, lambda p: p.isNotNull() & (p != ""))
    return F.struct(
        *[_text(name[c]).alias(c) for c in NAME_TEXTS],
        _text(first(name["given"])).alias("given"),
        prefix.alias("prefix"),
        suffix.alias("suffix"),
        _text(name["period"]).alias("period"),
        F.trim(F.array_join(spoken, " ")).alias("full_name"),
    )


def identifier_value(identifiers: Column, system: str) -> Column:
    return first(F.filter(identifiers, lambda i: i["system"] == system))["value"]


def coding_display(codings: Column) -> Column:
    return first(codings)["display"]


def concept_display(concepts: Column) -> Column:
    """Display of the first coding of the first concept."""
    return coding_display(first(concepts)["coding"])


def annotation_text(annotations: Column) -> Column:
    """First text that is not empty."""
    return first(F.filter(annotations, lambda a: a["text"] != ""))["text"]


def quantity_value(quantities: Column) -> Column:
    return first(quantities)["value"]


# How a child of a backbone element is read. A child that may occur once or many times is
# read through `one_or_many`, which gives a list either way.
CHILD_TYPES = {
    "Reference": "struct<reference:string>",
    "CodeableConcept": "struct<coding:array<struct<display:string>>>",
    "SimpleQuantity": "struct<value:decimal(20,10)>",
}


def one_or_many(json_text: Column, item_type: str) -> Column:
    """A list from JSON text holding either a list or a single object."""
    listed = F.from_json(json_text, f"array<{item_type}>")
    single = F.from_json(json_text, item_type)
    return F.when(F.ltrim(json_text).startswith("["), listed).when(
        json_text.isNotNull(), F.array(single)
    )


def backbone_child(
    elements: Column, child: str, child_type: str, resource_type: str | None = None
) -> Column:
    """Child of the first backbone element (JSON texts): key, display or value by its type."""
    items = one_or_many(F.get_json_object(first(elements), f"$.{child}"), CHILD_TYPES[child_type])
    if child_type == "Reference":
        return reference_key(items, resource_type)
    if child_type == "CodeableConcept":
        return concept_display(items)
    return quantity_value(items)
