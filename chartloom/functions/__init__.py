"""Column functions over parsed FHIR values."""
