"""The catalogue, built in and read from a schema document."""

import pytest

from chartloom.catalog import Catalog
from chartloom.operators.shared import normalize, resource_table, shared_table

REF = "#/definitions/"
SCHEMA = {
    "discriminator": {"mapping": {"Shelf": "x"}},
    "definitions": {
        "Shelf": {
            "properties": {
                "resourceType": {"const": "Shelf"},
                "id": {"$ref": REF + "id"},
                "contained": {"items": {"$ref": REF + "ResourceList"}, "type": "array"},
                "_status": {"$ref": REF + "Element"},
                "status": {"enum": ["a"]},
                "count": {"type": "number"},
                "sizeInteger": {"type": "number"},
                "when": {"$ref": REF + "dateTime"},
                "topic": {"items": {"$ref": REF + "CodeableConcept"}, "type": "array"},
                "owner": {"$ref": REF + "Reference"},
                "span": {"items": {"$ref": REF + "Period"}, "type": "array"},
                "rack": {"$ref": REF + "Shelf_Rack"},
                "bin": {"items": {"$ref": REF + "Shelf_Bin"}, "type": "array"},
            }
        },
        "Shelf_Rack": {
            "properties": {
                "extension": {"items": {"$ref": REF + "Extension"}, "type": "array"},
                "height": {"$ref": REF + "decimal"},
                "bin": {"items": {"$ref": REF + "Shelf_Bin"}, "type": "array"},
                "use": {"items": {"$ref": REF + "CodeableConcept"}, "type": "array"},
            }
        },
        "Shelf_Bin": {"properties": {"label": {"$ref": REF + "string"}}},
        "CodeableConcept": {"properties": {"text": {"$ref": REF + "string"}}},
        "Reference": {"properties": {"reference": {"$ref": REF + "string"}}},
        "Period": {
            "properties": {"start": {"$ref": REF + "dateTime"}, "end": {"$ref": REF + "dateTime"}}
        },
        "decimal": {"type": "number"},
    },
}


def test_schema_document_gives_a_working_catalog(lines):
    catalog = Catalog.from_schema(SCHEMA)
    document = {
        "resourceType": "Shelf", "id": "s", "status": "a", "count": 2.5, "sizeInteger": 3,
        "when": "2024-01", "topic": [{"text": "t"}], "owner": {"reference": "Person/1"},
        "span": [{"start": "2020"}, {"end": "2021"}],
        "rack": {"height": 1.5, "bin": [{"label": "l"}], "use": [{"text": "u"}]},
        "bin": [{"label": "x"}],
    }
    normalized = normalize(lines(document), "Shelf", catalog)
    row = resource_table(normalized).first()
    assert (float(row["count"]), row.sizeinteger, row.when.month) == (2.5, 3, 1)
    assert (row.span_start, row.span_end) == (["2020", None], [None, "2021"])
    assert float(row.rack_height) == 1.5 and row.rack_bin == ['{"label":"l"}']
    assert row.rack_use == '[{"text":"u"}]' and row.bin == ['{"label":"x"}']
    assert "rack_extension" not in row.asDict()
    assert shared_table(normalized, "codeableconcept").first().text == "t"
    assert shared_table(normalized, "reference").first().reference == "Person/1"


def test_unknown_resource_type_says_what_to_do(catalog):
    with pytest.raises(KeyError, match="from_schema"):
        catalog.elements("Spaceship")


def test_columns_of_every_builtin_type_are_lower_case_and_unique(lines, catalog):
    for resource in catalog.resources:
        columns = resource_table(normalize(lines({"id": "x"}), resource, catalog)).columns
        assert columns == [c.lower() for c in columns] and len(set(columns)) == len(columns)
