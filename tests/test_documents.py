"""Edge cases of flattening, on documents written out by hand."""

import datetime

from chartloom.operators.flatten import flatten
from chartloom.operators.shared import normalize, resource_table, shared_table
from chartloom.sources.bundles import explode_bundles
from chartloom.sources.ndjson import batch_documents, good_documents, rejected_lines, scan_documents


def concepts(lines, catalog, resource, *documents):
    rows = shared_table(normalize(lines(*documents), resource, catalog), "codeableconcept")
    return {(r.id, r.field_name, r.seq_no): r for r in rows.collect()}


def test_text_only_concept_is_one_row(lines, catalog):
    rows = concepts(lines, catalog, "Condition", {"id": "c", "code": {"text": "flu"}})
    assert list(rows) == [("c", "code", 0)]
    assert rows["c", "code", 0].text == "flu" and rows["c", "code", 0].code is None


def test_empty_coding_list_gives_no_row(lines, catalog):
    assert concepts(lines, catalog, "Condition", {"id": "c", "code": {"coding": [], "text": "flu"}}) == {}


def test_codings_share_the_text_and_are_numbered_over_concepts(lines, catalog):
    document = {
        "id": "c",
        "category": [
            {"coding": [{"code": "a"}, {"code": "b"}], "text": "t"},
            {"coding": [{"code": "d"}]},
        ],
    }
    rows = concepts(lines, catalog, "Condition", document)
    assert [(k[2], r.code, r.text) for k, r in sorted(rows.items())] == [
        (0, "a", "t"), (1, "b", "t"), (2, "d", None),
    ]


def test_empty_coding_object_survives_only_with_text(lines, catalog):
    with_text = {"id": "a", "code": {"coding": [{}], "text": "t"}}
    without = {"id": "b", "code": {"coding": [{}]}}
    assert [k[0] for k in concepts(lines, catalog, "Condition", with_text, without)] == ["a"]


def test_coding_field_becomes_a_concept_row(lines, catalog):
    rows = concepts(
        lines, catalog, "Encounter", {"id": "e", "class": {"code": "AMB", "userSelected": True}}
    )
    assert rows["e", "class", 0].code == "AMB" and rows["e", "class", 0].userselected is True


def test_concept_extensions_alone_go_to_the_first_coding(lines, catalog):
    code = {"coding": [{"code": "a"}, {"code": "b"}], "extension": [{"url": "x"}, {"url": "y"}]}
    rows = concepts(lines, catalog, "Condition", {"id": "c", "code": code})
    assert rows["c", "code", 0].extension == ['{"url":"x"}', '{"url":"y"}']
    assert rows["c", "code", 1].extension is None


def test_extensions_of_both_levels_pair_up_and_the_shorter_side_wins(lines, catalog):
    code = {
        "coding": [{"code": "a", "extension": [{"url": "own"}]}, {"code": "b"}],
        "extension": [{"url": "x"}],
    }
    rows = concepts(lines, catalog, "Condition", {"id": "c", "code": code})
    assert rows["c", "code", 0].extension == ['{"url":"own"}', '{"url":"x"}']
    assert rows["c", "code", 1].extension is None


def test_logical_reference_is_kept_and_two_extensions_stay_one_row(lines, catalog):
    subject = {"identifier": {"value": "7"}, "extension": [{"url": "x"}, {"url": "y"}]}
    wide = normalize(lines({"id": "o", "subject": subject}), "Observation", catalog)
    rows = shared_table(wide, "reference").collect()
    assert len(rows) == 1
    assert rows[0].identifier == '{"value":"7"}' and len(rows[0].extension) == 2


def test_identifier_period_and_nested_values(lines, catalog):
    identifier = {"system": "s", "period": {"start": "2021-06"}, "assigner": {"display": "d"}}
    wide = normalize(lines({"id": "p", "identifier": [identifier, {}]}), "Patient", catalog)
    rows = shared_table(wide, "identifier").collect()
    assert len(rows) == 1
    assert rows[0].period_start == datetime.datetime(2021, 6, 1) and rows[0].period_end is None
    assert rows[0].assigner == '{"display":"d"}'


def test_array_struct_keeps_positions_and_drops_empty_entries(lines, catalog):
    names = [{"family": "A", "given": ["x", "y"]}, {}, {"given": ["z"]}, {"text": "t"}]
    row = flatten(lines({"id": "p", "name": names}), "Patient", catalog, ["name"]).first()
    assert row.name_family == ["A", None, None]
    assert row.name_given == [["x", "y"], ["z"], None]
    assert row.name_text == [None, None, "t"]


def test_list_of_empty_entries_is_null(lines, catalog):
    documents = lines({"id": "a", "name": [{}]}, {"id": "b", "name": []}, {"id": "c", "name": [{"use": "u"}]})
    rows = flatten(documents, "Patient", catalog, ["name"]).orderBy("id").collect()
    assert [r.name_use for r in rows] == [None, None, ["u"]]


def test_sizes_are_zero_without_rows(lines, catalog):
    row = resource_table(normalize(lines({"id": "p"}), "Patient", catalog)).first()
    assert (row.codeableconcept_max_array_size, row.reference_max_array_size) == (0, 0)
    assert row.identifier_max_array_size == 0


def test_backbone_keeps_nested_values_as_json(lines, catalog):
    stay = {"origin": {"reference": "L/1"}, "dietPreference": [{"text": "v"}]}
    row = flatten(lines({"id": "e", "hospitalization": stay}), "Encounter", catalog).first()
    assert row.hospitalization_origin == '{"reference":"L/1"}'
    assert row.hospitalization_dietpreference == '[{"text":"v"}]'


def test_decimals_keep_their_value(lines, catalog):
    wide = flatten(lines({"id": "o", "valueQuantity": {"value": 1.25}}), "Observation", catalog)
    assert float(wide.first().valuequantity_value) == 1.25


def test_a_decimal_too_large_for_its_column_is_null_and_the_row_stays(lines, catalog):
    texts = lines({"id": "o", "status": "final", "valueQuantity": {"value": 12345678901234567.5}})
    scanned = scan_documents(texts, "Observation", catalog)
    assert [r.error_code for r in scanned.collect()] == [None]
    row = flatten(texts, "Observation", catalog).first()
    assert row.status == "final" and row.valuequantity_value is None


def test_bad_lines_are_set_aside_and_blank_ones_skipped(lines, catalog):
    texts = lines(
        {"id": "good", "gender": "male"},
        "",
        '{"id": "cut',
        {"id": "shape", "name": {"family": "x"}},
        {"id": "unknown", "shoeSize": 44},
        {"gender": "male"},
        {"id": "ignored", "implicitRules": "r", "_gender": {}, "contained": []},
    )
    scanned = scan_documents(texts, "Patient", catalog)
    assert {r.id for r in good_documents(scanned).collect()} == {"good", "ignored"}
    codes = sorted(r.error_code for r in rejected_lines(scanned).collect())
    assert codes == ["601", "602", "602", "602"]


def test_batches_as_list_or_lines(lines):
    rows = batch_documents(lines('[{"id":"a"},{"id":"b"}]', '{"id":"c"}\n\n{"id":"d"}\n'))
    assert sorted(r.document for r in rows.collect()) == [f'{{"id":"{c}"}}' for c in "abcd"]


def test_bundle_takes_any_next_link_and_skips_entries_without_resource(lines):
    page = {
        "entry": [{"resource": {"id": "a"}}, {"fullUrl": "u"}],
        "link": [{"relation": "self", "url": "s"}, {"relation": "next", "url": "n"}],
    }
    rows = explode_bundles(lines(page, {"entry": [{"resource": {"id": "b"}}]})).collect()
    assert [(r.value, r.next_url) for r in rows] == [('{"id":"a"}', "n"), ('{"id":"b"}', None)]


def test_parsing_happens_once_per_document(lines, catalog):
    rows = shared_table(normalize(lines({"id": "p"}), "Patient", catalog), "reference")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # Once for all, and once more under the test for numbers that a double would print in another way.
    assert plan.count("from_json") == 2 and plan.count("CASE WHEN (RLIKE(value") == 1


def test_lines_of_white_space_are_skipped(lines, catalog):
    found = scan_documents(lines("\t", "\r", " \t\r", '{"resourceType":"Patient","id":"a"}'), "Patient", catalog)
    assert found.count() == 1 and rejected_lines(found).count() == 0


NUMBERS = ["1.50", "0.12345678901234567890", "1e3", "-1.0E+10", "100000000.5", "0.0001", "12345678901234567890123", "7", "-0.0"]


def test_numbers_of_nested_texts_come_out_as_written(lines, catalog):
    entries = ",".join(f'{{"n":{n},"s":"x: {n}, \\"{n}\\" \\\\"}}' for n in NUMBERS)
    document = f'{{"id":"p","extension":[{entries}],"contact":[{{"x":[{", ".join(NUMBERS)}]}}],"multipleBirthInteger":2}}'
    wide = flatten(lines(document), "Patient", catalog, ["extension", "contact", "multipleBirthInteger"]).first()
    assert ",".join(wide.extension) == entries
    assert wide.contact == [f'{{"x":[{",".join(NUMBERS)}]}}'] and wide.multiplebirthinteger == 2
    scanned = scan_documents(lines(document), "Patient", catalog).first()
    assert scanned.error_code is None and ",".join(scanned.doc.extension) == entries
    listed = batch_documents(lines(f"[{document}, {document}]")).collect()
    assert len(listed) == 2 and all(entries in r.document and ",".join(NUMBERS) in r.document for r in listed)
    page = f'{{"entry":[{{"resource":{document}}}]}}'
    assert entries in explode_bundles(lines(page)).first().value


def test_texts_with_the_mark_itself_are_left_to_spark(lines, catalog):
    for mark in ("\\ue000", "\ue000"):
        document = f'{{"id":"p","extension":[{{"n":1.50,"s":"{mark}1"}}]}}'
        wide = flatten(lines(document), "Patient", catalog, ["extension"]).first()
        assert wide.extension == ['{"n":1.5,"s":"1"}']


def test_long_strings_with_many_escapes_are_marked_without_a_deep_stack(lines, catalog):
    text = "\\n\\\"" * 50_000
    document = f'{{"id":"p","extension":[{{"s":"{text}","n":2.50}}]}}'
    wide = flatten(lines(document), "Patient", catalog, ["extension"]).first()
    assert wide.extension[0].endswith('"n":2.50}') and len(wide.extension[0]) > 200_000
