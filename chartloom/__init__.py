"""Spark jobs that turn HL7 FHIR R4 resources into analytical tables and keep them current."""
