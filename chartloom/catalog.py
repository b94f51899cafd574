"""Element catalogue: which elements a resource has, of what type and cardinality.

The built-in part covers the resource types loaded by default. Any other type comes from
the FHIR JSON schema that HL7 publishes: `Catalog.from_schema(path)` reads that document.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chartloom.functions.exact import text_part

# ---------------------------------------------------------------------------------------
# Elements from the public FHIR R4 specification, and below them the column types
# that the produced tables have to have. One element per line entry:
# `name type`, with `*` for a repeating element. `Patient_Contact` and the like are the
# backbone types of a resource.
# ---------------------------------------------------------------------------------------

# Elements every resource type starts with.
COMMON_ELEMENTS = "meta Meta, language code, text Narrative, extension Extension*"

RESOURCES = {
    "Patient": """
        identifier Identifier*, active boolean, name HumanName*, telecom ContactPoint*, gender enum,
        birthDate date, deceasedBoolean boolean, deceasedDateTime string, address Address*,
        maritalStatus CodeableConcept, multipleBirthBoolean boolean, multipleBirthInteger integer,
        photo Attachment*, contact Patient_Contact*, communication Patient_Communication*,
        generalPractitioner Reference*, managingOrganization Reference, link Patient_Link*
    """,
    "Encounter": """
        identifier Identifier*, status enum, statusHistory Encounter_StatusHistory*, class Coding,
        classHistory Encounter_ClassHistory*, type CodeableConcept*, serviceType CodeableConcept,
        priority CodeableConcept, subject Reference, episodeOfCare Reference*, basedOn Reference*,
        participant Encounter_Participant*, appointment Reference*, period Period, length Duration,
        reasonCode CodeableConcept*, reasonReference Reference*, diagnosis Encounter_Diagnosis*,
        account Reference*, hospitalization Encounter_Hospitalization, location Encounter_Location*,
        serviceProvider Reference, partOf Reference
    """,
    "Observation": """
        identifier Identifier*, basedOn Reference*, partOf Reference*, status enum,
        category CodeableConcept*, code CodeableConcept, subject Reference, focus Reference*,
        encounter Reference, effectiveDateTime string, effectivePeriod Period,
        effectiveTiming Timing, effectiveInstant string, issued instant, performer Reference*,
        valueQuantity Quantity, valueCodeableConcept CodeableConcept, valueString string,
        valueBoolean boolean, valueInteger integer, valueRange Range, valueRatio Ratio,
        valueSampledData SampledData, valueTime string, valueDateTime string, valuePeriod Period,
        dataAbsentReason CodeableConcept, interpretation CodeableConcept*, note Annotation*,
        bodySite CodeableConcept, method CodeableConcept, specimen Reference, device Reference,
        referenceRange Observation_ReferenceRange*, hasMember Reference*, derivedFrom Reference*,
        component Observation_Component*
    """,
    "Condition": """
        identifier Identifier*, clinicalStatus CodeableConcept, verificationStatus CodeableConcept,
        category CodeableConcept*, severity CodeableConcept, code CodeableConcept,
        bodySite CodeableConcept*, subject Reference, encounter Reference, onsetDateTime string,
        onsetAge Age, onsetPeriod Period, onsetRange Range, onsetString string,
        abatementDateTime string, abatementAge Age, abatementPeriod Period, abatementRange Range,
        abatementString string, recordedDate dateTime, recorder Reference, asserter Reference,
        stage Condition_Stage*, evidence Condition_Evidence*, note Annotation*
    """,
}

# First-level children of the complex types above, and of the backbones that occur once.
DATATYPES = {
    "Meta": """
        extension Extension*, versionId id, lastUpdated instant, source uri, profile canonical*,
        security Coding*, tag Coding*
    """,
    "Narrative": "extension Extension*, status enum, div xhtml",
    "Extension": "",
    "Coding": """
        extension Extension*, system uri, version string, code code, display string,
        userSelected boolean
    """,
    "CodeableConcept": "extension Extension*, coding Coding*, text string",
    "Reference": """
        extension Extension*, reference string, type uri, identifier Identifier, display string
    """,
    "Identifier": """
        extension Extension*, use enum, type CodeableConcept, system uri, value string,
        period Period, assigner Reference
    """,
    "HumanName": """
        extension Extension*, use enum, text string, family string, given string*, prefix string*,
        suffix string*, period Period
    """,
    "ContactPoint": """
        extension Extension*, system enum, value string, use enum, rank positiveInt, period Period
    """,
    "Address": """
        extension Extension*, use enum, type enum, text string, line string*, city string,
        district string, state string, postalCode string, country string, period Period
    """,
    "Attachment": """
        extension Extension*, contentType code, language code, data base64Binary, url url,
        size unsignedInt, hash base64Binary, title string, creation dateTime
    """,
    "Annotation": """
        extension Extension*, authorReference Reference, authorString string, time dateTime,
        text markdown
    """,
    "Period": "extension Extension*, start dateTime, end dateTime",
    "Quantity": """
        extension Extension*, value decimal, comparator enum, unit string, system uri, code code
    """,
    "Duration": """
        extension Extension*, value decimal, comparator enum, unit string, system uri, code code
    """,
    "Age": """
        extension Extension*, value decimal, comparator enum, unit string, system uri, code code
    """,
    "Range": "extension Extension*, low Quantity, high Quantity",
    "Ratio": "extension Extension*, numerator Quantity, denominator Quantity",
    "SampledData": """
        extension Extension*, origin Quantity, period decimal, factor decimal, lowerLimit decimal,
        upperLimit decimal, dimensions positiveInt, data string
    """,
    "Timing": """
        extension Extension*, event dateTime*, repeat Timing_Repeat, code CodeableConcept
    """,
    "Encounter_Hospitalization": """
        preAdmissionIdentifier Identifier, origin Reference, admitSource CodeableConcept,
        reAdmission CodeableConcept, dietPreference CodeableConcept*,
        specialCourtesy CodeableConcept*, specialArrangement CodeableConcept*,
        destination Reference, dischargeDisposition CodeableConcept
    """,
}

# Elements that never become columns.
IGNORED_ELEMENTS = ("resourceType", "implicitRules", "contained", "modifierExtension", "id")

# FHIR primitive type -> column type.
PRIMITIVE_COLUMN_TYPES = {
    "positiveInt": "INTEGER",
    "unsignedInt": "INTEGER",
    "integer": "INTEGER",
    "number": "DECIMAL(20,10)",
    "boolean": "BOOLEAN",
    "decimal": "DECIMAL(20,10)",
    "dateTime": "DATETIME",
    "date": "DATETIME",
    "time": "STRING",
    "uuid": "VARCHAR(100)",
    "id": "VARCHAR(100)",
    "uri": "STRING",
    "url": "STRING",
    "code": "STRING",
    "enum": "STRING",
    "canonical": "STRING",
    "instant": "STRING",
    "base64Binary": "STRING",
    "markdown": "STRING",
    "string": "STRING",
    "oid": "STRING",
    "xhtml": "STRING",
}

# ---------------------------------------------------------------------------------------

CONCEPT_TYPES = ("CodeableConcept", "Coding")
SHARED_TABLES = ("codeableconcept", "reference", "identifier")


@dataclass(frozen=True)
class Element:
    """One element of a resource or data type."""

    owner: str
    name: str
    fhir_type: str
    repeats: bool

    @property
    def column(self) -> str:
        return self.name.lower()


def _elements(owner: str, text: str) -> list[Element]:
    entries = [entry.split() for entry in text.split(",") if entry.strip()]
    return [Element(owner, name, kind.rstrip("*"), kind.endswith("*")) for name, kind in entries]


def _schema_element(owner: str, name: str, spec: dict) -> Element:
    """Type and cardinality of one JSON-schema property."""
    items = spec.get("items", {})
    target = spec.get("$ref") or items.get("$ref")
    if target:
        fhir_type = target.rsplit("/", 1)[-1]
    elif "enum" in spec or "enum" in items:
        fhir_type = "enum"
    else:
        fhir_type = items.get("type") or spec.get("type", "string")
        if fhir_type == "number" and name.endswith("Integer"):
            fhir_type = "integer"
    return Element(owner, name, fhir_type, spec.get("type") == "array")


class Catalog:
    """Elements by resource type, and children by data type."""

    def __init__(self, resources: dict[str, list[Element]], datatypes: dict[str, list[Element]]):
        self.resources = resources
        self.datatypes = datatypes

    @classmethod
    def builtin(cls) -> Catalog:
        common = COMMON_ELEMENTS
        return cls(
            {name: _elements(name, f"{common}, {text}") for name, text in RESOURCES.items()},
            {name: _elements(name, text) for name, text in DATATYPES.items()},
        )

    @classmethod
    def from_schema(cls, document: str | dict) -> Catalog:
        """Read a FHIR JSON schema: a path, or the parsed document."""
        if isinstance(document, str):
            with open(document, encoding="utf-8") as handle:
                document = json.load(handle)
        names = set(document.get("discriminator", {}).get("mapping", {}))
        resources, datatypes = {}, {}
        for owner, definition in document.get("definitions", {}).items():
            kept = [
                _schema_element(owner, name, spec)
                for name, spec in definition.get("properties", {}).items()
                if name not in IGNORED_ELEMENTS and not name.startswith("_")
            ]
            if owner in names:
                resources[owner] = kept
            elif definition.get("properties") is not None and owner[0].isupper():
                is_backbone = owner.split("_")[0] in names
                datatypes[owner] = [e for e in kept if not (is_backbone and e.name == "extension")]
        return cls(resources, datatypes)

    def elements(self, resource: str) -> list[Element]:
        if resource not in self.resources:
            raise KeyError(f"no catalogue for resource type {resource!r}; load one with from_schema")
        return self.resources[resource]

    def shape(self, element: Element) -> str:
        """How an element is laid out in the target tables."""
        kind = element.fhir_type
        if kind in CONCEPT_TYPES:
            return "codeableconcept"
        if kind in ("Reference", "Identifier", "Extension"):
            return kind.lower()
        if kind.startswith(f"{element.owner}_"):
            return "backbone"
        if kind in self.datatypes or kind[:1].isupper():
            return "array_complex" if element.repeats else "complex"
        return "primitive"

    def of_shape(self, resource: str, *shapes: str) -> list[Element]:
        return [e for e in self.elements(resource) if self.shape(e) in shapes]

    def children(self, element: Element) -> list[Element]:
        return self.datatypes.get(element.fhir_type, [])

    def rows(self, spark: SparkSession, children: bool = False) -> DataFrame:
        """The catalogue, or its data types, as rows (resource, element, fhir_type, is_array).

        Literal rows, so that Spark knows their size when it plans a join with them.
        """
        source = self.datatypes if children else self.resources
        listed = ", ".join(
            f"('{e.owner}', '{e.name}', '{e.fhir_type}', {str(e.repeats).lower()})"
            for group in source.values()
            for e in group
        )
        return spark.sql(f"SELECT * FROM VALUES {listed} AS t(resource, element, fhir_type, is_array)")

    # --- schemas for parsing ----------------------------------------------------------

    def parse_type(self, element: Element, nested: bool = False) -> T.DataType:
        """Type to parse an element with. Nested complex values stay JSON text."""
        if element.fhir_type in PRIMITIVE_COLUMN_TYPES:
            base = _PARSED.get(PRIMITIVE_COLUMN_TYPES[element.fhir_type], T.StringType())
        elif nested:
            base = T.StringType()
        else:
            base = self._parse_complex(element)
        return T.ArrayType(base) if element.repeats else base

    def _parse_complex(self, element: Element) -> T.DataType:
        shape = self.shape(element)
        if shape in SHARED_TABLES:
            return SHARED_PARSE_TYPES[shape]
        children = self.children(element)
        if shape == "extension" or (shape == "backbone" and element.repeats) or not children:
            return T.StringType()
        return T.StructType([T.StructField(c.name, self._child_type(element, c)) for c in children])

    def _child_type(self, element: Element, child: Element) -> T.DataType:
        # Inside a backbone a complex value is one JSON text, also when it repeats.
        if self.shape(element) == "backbone" and child.fhir_type in self.datatypes:
            if not child.fhir_type.startswith(f"{element.owner}_"):
                return T.StringType()
        return self.parse_type(child, nested=True)

    def struct_type(self, resource: str, only: list[str] | None = None) -> T.StructType:
        """Schema of a document: its id and the chosen elements, or all of them."""
        chosen = [e for e in self.elements(resource) if only is None or e.name in only]
        fields = [T.StructField("id", T.StringType())]
        return T.StructType(fields + [T.StructField(e.name, self.parse_type(e)) for e in chosen])

    def json_texts(self, resource: str, only: list[str] | None = None) -> T.StructType:
        """The part of a document's schema that holds nested JSON texts: strings of its complex elements."""
        complex_ = [
            T.StructField(e.name, text_part(self.parse_type(e)))
            for e in self.elements(resource)
            if (only is None or e.name in only) and self.shape(e) != "primitive"
        ]
        return T.StructType([f for f in complex_ if f.dataType is not None])


# Integers are read as doubles, so that 1.0 and NaN can be told apart and coerced. Decimals are
# read wider than their column, so that a value too large for it is null and its row stays.
_PARSED = {
    "INTEGER": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DECIMAL(20,10)": T.DecimalType(38, 10),
}

_JSON_ARRAY = T.ArrayType(T.StringType())

# One coding, or the concept itself when it carries the fields of a coding.
CODING_TYPE = T.StructType(
    [
        T.StructField("system", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("display", T.StringType()),
        T.StructField("userSelected", T.BooleanType()),
        T.StructField("extension", _JSON_ARRAY),
    ]
)

SHARED_PARSE_TYPES = {
    "codeableconcept": T.StructType(
        [T.StructField("coding", T.ArrayType(CODING_TYPE)), T.StructField("text", T.StringType())]
        + CODING_TYPE.fields
    ),
    "reference": T.StructType(
        [
            T.StructField("reference", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("identifier", T.StringType()),
            T.StructField("display", T.StringType()),
            T.StructField("extension", _JSON_ARRAY),
        ]
    ),
    "identifier": T.StructType(
        [
            T.StructField("use", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("system", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField(
                "period",
                T.StructType(
                    [T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]
                ),
            ),
            T.StructField("assigner", T.StringType()),
            T.StructField("extension", _JSON_ARRAY),
        ]
    ),
}
