"""Scalar functions on single values."""

import datetime
import hashlib
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartloom.functions import fhir
from chartloom.functions.dates import date_parts, fhir_timestamp
from chartloom.functions.keys import hash64, row_digest, uuid5_dns


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2021", "2021-01-01 00:00:00"),
        ("2021-06", "2021-06-01 00:00:00"),
        ("06-2021", "2021-06-01 00:00:00"),
        ("6/2021", "2021-06-01 00:00:00"),
        ("2021/6/1", "2021-06-01 00:00:00"),
        ("2021-6-1", "2021-06-01 00:00:00"),
        (" 2021-06-10 ", "2021-06-10 00:00:00"),
        ("2021-06-10T12:34:56Z", "2021-06-10 12:34:56"),
        ("2021-06-10T12:34:56.789Z", "2021-06-10 12:34:56"),
        ("2021-06-10T12:34:56+01:00", "2021-06-10 11:34:56"),
        ("2021-06-10T12:34:56", "2021-06-10 12:34:56"),
        ("2021-06-10 12:34:56", "2021-06-10 12:34:56"),
        ("June 10, 2021", "2021-06-10 00:00:00"),
        ("20210610", "2021-06-10 00:00:00"),
        ("0001-01-01", None),
        ("0001-01-01T00:00:00Z", None),
        ("2021-13", None),
        ("2021-02-30", None),
        ("13-2021", None),
        ("12:30", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_date_forms(spark, text, expected):
    row = spark.createDataFrame([(text,)], "d string").select(date_parts("d").alias("p")).first().p
    assert row.datetime == expected
    if expected:
        assert (row.year, row.date, row.time) == (int(expected[:4]), expected[:10], expected[11:])


def test_timestamp_keeps_fractions(spark):
    frame = spark.createDataFrame([("2021-06-10T12:34:56.789Z",)], "d string")
    stamp = frame.select(fhir_timestamp("d").alias("t")).first().t
    assert stamp == datetime.datetime(2021, 6, 10, 12, 34, 56, 789000)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=20))
def test_keys_equal_their_definitions(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", uuid5_dns(F.col("t")).alias("u"), hash64(F.col("t")).alias("h")).collect()
    for row in rows:
        assert row.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, row.t))
        assert int(row.h) == int(hashlib.md5(row.t.encode()).hexdigest()[:16], 16)


def test_digest_ignores_key_order_but_not_values(spark):
    texts = ['{"a":1,"b":[1,2]}', '{"b":[1,2],"a":1}', '{"a":1,"b":[2,1]}']
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    one, other, different = [r[0] for r in frame.select(row_digest(F.col("t"))).collect()]
    assert one == other != different


ADDRESS = "array<struct<use:string,type:string,text:string,line:array<string>,city:string," + (
    "district:string,state:string,postalCode:string,country:string>>"
)


@pytest.mark.parametrize("lines", [[], ["1 Main St"], ["1 Main St", "Apt 2"]])
def test_address_with_lines(spark, lines):
    text = '[{"line":[' + ",".join(f'"{x}"' for x in lines) + '],"postalCode":"123"}]'
    frame = spark.createDataFrame([(text,)], "v string").select(F.from_json("v", ADDRESS).alias("a"))
    row = frame.select(fhir.address_parts(F.col("a")).alias("p")).first().p
    first, second = (lines + ["", ""])[:2]
    assert (row.address_1, row.address_2, row.postalcode, row.city) == (first, second, "123", "")
    expected = int(hashlib.md5((first + second + "123").encode()).hexdigest()[:16], 16)
    assert int(row.location_id) == expected


def test_extension_value_that_is_no_object_has_no_display(spark):
    extensions = ['{"url":"a","valueString":"x"}', '{"url":"b","valueCoding":[{"display":"d"}]}']
    frame = spark.createDataFrame([(extensions,)], "e array<string>")
    row = frame.select(
        fhir.extension_display(F.col("e"), ["a"], ["valueString"]).alias("plain"),
        fhir.extension_display(F.col("e"), ["b"], ["valueCoding"]).alias("listed"),
        fhir.extension_display(F.col("e"), ["c"], ["valueCoding"]).alias("missing"),
    ).first()
    assert (row.plain, row.listed, row.missing) == (None, "d", None)


def test_extension_path_through_a_list(spark):
    extension = '{"url":"race","extension":[{"url":"x"},{"url":"y","valueCoding":{"display":"d"}}]}'
    frame = spark.createDataFrame([([extension],)], "e array<string>")
    display = fhir.extension_display(F.col("e"), ["race"], ["extension.valueCoding"])
    assert frame.select(display.alias("d")).first().d == "d"


def test_extension_path_through_objects_and_lists(spark):
    extension = '{"url":"e","extension":[{"url":"x","valueCodeableConcept":{"coding":[{"display":"d"}]}}]}'
    frame = spark.createDataFrame([([extension],)], "e array<string>")
    display = fhir.extension_display(F.col("e"), ["e"], ["extension.valueCodeableConcept.coding"])
    assert frame.select(display.alias("d")).first().d == "d"


def test_first_extension_with_a_value_wins(spark):
    extensions = ['{"url":"a"}', '{"url":"a","valueCoding":{"display":"second"}}']
    frame = spark.createDataFrame([(extensions,)], "e array<string>")
    display = fhir.extension_display(F.col("e"), ["a"], ["valueCode", "valueCoding"])
    assert frame.select(display.alias("d")).first().d == "second"
