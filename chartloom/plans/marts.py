"""Curated tables over parsed resources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.catalog import Catalog
from chartloom.functions import fhir
from chartloom.functions.dates import date_parts, fhir_timestamp, stamp_parts
from chartloom.operators.flatten import parse_documents


def location_dimension(patients: DataFrame, catalog: Catalog) -> DataFrame:
    """Distinct addresses by their key, with the number of residents."""
    parsed = parse_documents(patients, "Patient", catalog, ["address"])
    located = parsed.select(fhir.address_parts(F.col("address")).alias("a")).select("a.*")
    return (
        located.where(F.col("location_id").isNotNull())
        .groupBy("location_id", "address_1", "address_2", "postalcode")
        .agg(
            F.count(F.lit(1)).alias("residents"),
            F.min("city").alias("city"),
            F.min("country").alias("country"),
        )
    )


def patient_dimension(patients: DataFrame, catalog: Catalog, id_system: str) -> DataFrame:
    """One row per patient."""
    elements = ["name", "birthDate", "identifier", "address", "maritalStatus", "gender"]
    parsed = parse_documents(patients, "Patient", catalog, elements)
    pieces = parsed.select(
        "id",
        "gender",
        fhir.human_name_parts(F.col("name")).alias("n"),
        date_parts("birthDate").alias("b"),
        fhir.identifier_value(F.col("identifier"), id_system).alias("external_id"),
        fhir.address_parts(F.col("address"))["location_id"].alias("location_id"),
        fhir.concept_display(F.array("maritalStatus")).alias("marital_status"),
    )
    return pieces.select(
        "id",
        "gender",
        F.col("n.full_name").alias("full_name"),
        F.col("n.family").alias("family"),
        F.col("n.given").alias("given"),
        F.col("b.year").alias("birth_year"),
        F.col("b.month").alias("birth_month"),
        F.col("b.day").alias("birth_day"),
        "external_id",
        "location_id",
        "marital_status",
    )


def observation_rows(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """Observations with patient key, code display, value, date and first note."""
    elements = ["code", "subject", "valueQuantity", "effectiveDateTime", "note"]
    parsed = parse_documents(observations, "Observation", catalog, elements)
    return parsed.select(
        "id",
        fhir.reference_key(F.array("subject"), "Patient").alias("patient_key"),
        fhir.concept_display(F.array("code")).alias("code_display"),
        fhir.quantity_value(F.array("valueQuantity")).cast("double").alias("value"),
        fhir_timestamp("effectiveDateTime").alias("effective"),
        fhir.annotation_text(F.col("note")).alias("note"),
    )


def observation_fact(observations: DataFrame, catalog: Catalog) -> DataFrame:
    """Observations rolled up per patient and code."""
    rows = observation_rows(observations, catalog)
    return (
        rows.groupBy("patient_key", "code_display")
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.count("value").alias("measured"),
            F.max("value").alias("max_value"),
            F.max("effective").alias("last_seen"),
            F.min("note").alias("first_note"),
        )
        .withColumn("last_day", stamp_parts(F.col("last_seen"))["date"])
        .drop("last_seen")
    )


def extension_cohorts(
    patients: DataFrame, catalog: Catalog, urls: list[str], paths: list[str]
) -> DataFrame:
    """Patients per display of an extension."""
    parsed = parse_documents(patients, "Patient", catalog, ["extension"])
    display = fhir.extension_display(F.col("extension"), urls, paths)
    return parsed.groupBy(display.alias("cohort")).agg(F.count(F.lit(1)).alias("patients"))


def encounter_backbone_fact(encounters: DataFrame, catalog: Catalog) -> DataFrame:
    """Encounters with the key of their first location and of their first participant."""
    parsed = parse_documents(encounters, "Encounter", catalog, ["location", "participant"])
    place, person = F.col("location"), F.col("participant")
    return parsed.select(
        "id",
        fhir.backbone_child(place, "location", "Reference", "Location").alias("location_key"),
        fhir.backbone_child(person, "individual", "Reference", "Practitioner").alias("person_key"),
        fhir.backbone_child(person, "type", "CodeableConcept").alias("role"),
    )
