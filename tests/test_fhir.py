"""Bundles: one hand-written document with the odd cases of every resource type."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from cohortweave.operators.fhir import flatten_bundles, long_observations, pivot_observations, repeated_observations
from cohortweave.sources.bronze import read_bundles

LOINC, SNOMED = "http://loinc.org", "http://snomed.info/sct"

RESOURCES = [
    {"resourceType": "Patient", "id": "p1", "gender": "male", "birthDate": "1980-06-30",
     "name": [{"given": ["Ann", "B"], "family": "Lee"}, {"family": "Other"}],
     "extension": [
         {"url": "x/us-core-race", "extension": [{"url": "ombCategory", "valueCoding": {"display": "First"}},
                                                 {"url": "ombCategory", "valueCoding": {"display": "Last"}}]},
         {"url": "x/us-core-ethnicity"}, {"url": "x/other"}]},
    {"resourceType": "Patient", "birthDate": "1980-05"},
    {"resourceType": "Observation", "status": "final", "effectiveDateTime": "t1",
     "code": {"text": "T", "coding": [{"system": LOINC, "code": "1-1", "display": "Some Display"},
                                      {"system": LOINC, "code": "8867-4"}]},
     "valueQuantity": {"value": 72, "unit": "bpm"}},
    {"resourceType": "Observation", "code": {"coding": [{"system": LOINC, "code": "2-2", "display": "Iron In Blood"}]},
     "valueCodeableConcept": {"coding": [{"display": "High"}]}, "effectiveDateTime": "t1"},
    {"resourceType": "Observation", "code": {"coding": []}, "valueString": "free"},
    {"resourceType": "Observation", "code": {"coding": [{"system": LOINC, "code": "9-9"}]}, "valueQuantity": {"value": 1.50}},
    {"resourceType": "Condition", "code": {"text": "T", "coding": [{"system": "icd-10", "code": "I1", "display": "Icd"},
                                                                   {"system": SNOMED, "code": "S1"}]},
     "clinicalStatus": {"coding": [{"code": "active"}]}},
    {"resourceType": "Condition", "code": {"text": "Only Text"}},
    {"resourceType": "MedicationRequest", "medicationCodeableConcept": {"text": "Pill", "coding": [
        {"system": "rxnorm", "code": "R", "display": "Drug"}, {"system": "ndc"}]}, "dosageInstruction": []},
    {"resourceType": "MedicationRequest", "medicationCodeableConcept": {"text": "Tea"},
     "dosageInstruction": [{"text": "daily", "doseAndRate": [{"doseQuantity": {"value": 2.5, "unit": "mg"}}]}]},
    {"resourceType": "MedicationRequest"},
    {"resourceType": "Procedure", "code": {"text": "P", "coding": [{"system": "CPT", "code": "C"}, {"system": "x", "display": "D"}]},
     "performedPeriod": {"start": "2020"}},
    {"resourceType": "Encounter", "id": "e1", "class": {"code": "AMB"}, "period": {"start": "a", "end": "b"},
     "type": [{"coding": [{"display": "Visit"}]}]},
    {"resourceType": "Encounter"},
    {"resourceType": "Device"},
]


@pytest.fixture(scope="module")
def bundles(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("fhir")
    bundle = {"resourceType": "Bundle", "entry": [{"resource": r} for r in RESOURCES]}
    (folder / "sub-01_ses-2.json").write_text(json.dumps(bundle, indent=1))
    (folder / "sub-02.json").write_text(json.dumps({"resourceType": "Patient", "id": "alone"}, indent=1))
    return read_bundles(spark, str(folder)).withColumn("path", F.col("_source.file"))


@pytest.fixture(scope="module")
def rows(spark, bundles):
    registry = spark.createDataFrame([("8867-4", "Heart_Rate BPM")], "loinc_code string, standard_name string")
    as_of = F.lit(datetime.date(2020, 6, 29))
    return [r.asDict() for r in flatten_bundles(bundles, registry, as_of, "path").orderBy("entry_position").collect()]


def test_only_known_resources_of_bundles(rows):
    assert [r["entry_position"] for r in rows] == list(range(14))
    assert {r["participant_id"] for r in rows} == {"sub-01"} and {r["visit_session"] for r in rows} == {"ses-2"}
    assert [r["modality_category"] for r in rows] == (
        ["demographics"] * 2 + ["vital_signs"] + ["lab_results"] * 3 + ["diagnoses"] * 2 + ["pharmacy"] * 3
        + ["procedures"] + ["encounters"] * 2
    )


def test_patients(rows):
    days = (datetime.date(2020, 6, 29) - datetime.date(1980, 6, 30)).days
    first, second = rows[0], rows[1]
    assert (first["participant_sex"], first["participant_age"]) == ("male", days // 365)
    assert (first["participant_race"], first["participant_ethnicity"]) == ("Last", None)
    assert first["_pii_patient_name"] == "Ann B Lee" and first["patient_fhir_id"] == "p1"
    assert (second["participant_sex"], second["participant_age"], second["birth_date"]) == ("unknown", None, "1980-05")
    assert (second["_pii_patient_name"], second["patient_fhir_id"]) == (None, "")


def test_observations(rows):
    named = [(r["observation_name"], r["loinc_code"], r["observation_value"], r["observation_unit"]) for r in rows[2:6]]
    assert named == [
        ("Heart_Rate BPM", "8867-4", "72", "bpm"), ("iron_in_blood", "2-2", "High", "categorical"),
        ("obs_", "", "free", "text"), ("obs_9-9", "9-9", "1.5", ""),
    ]
    assert rows[0]["observation_name"] is None


def test_conditions(rows):
    assert [rows[6][k] for k in ("diagnosis_icd10", "diagnosis_snomed", "diagnosis_display", "diagnosis_status")] == ["I1", "S1", "Icd", "active"]
    assert [rows[7][k] for k in ("diagnosis_icd10", "diagnosis_display", "diagnosis_status")] == [None, "Only Text", ""]


def test_medications(rows):
    keys = ("medication_rxnorm", "medication_ndc", "medication_name", "medication_dose_text", "medication_dose_value", "medication_dose_unit")
    assert [rows[8][k] for k in keys] == ["R", "", "Pill", None, None, None]
    assert [rows[9][k] for k in keys] == [None, None, "Tea", "daily", "2.5", "mg"]
    assert [rows[10][k] for k in keys] == [None, None, "", "", "", ""]


def test_procedures_and_encounters(rows):
    assert [rows[11][k] for k in ("procedure_cpt", "procedure_snomed", "procedure_display", "procedure_date")] == ["C", None, "D", "2020"]
    assert [rows[12][k] for k in ("encounter_class", "encounter_start", "encounter_type")] == ["AMB", "a", "Visit"]
    assert [rows[13][k] for k in ("encounter_id", "encounter_class", "encounter_type")] == ["", "", None]


def test_long_and_pivot(bundles):
    documents = bundles.filter("resourceType = 'Bundle'")
    long = long_observations(documents, "path", F.lit("now"))
    rows = [(r["variable"], r["value"], r["timestamp"]) for r in long.orderBy("position").collect()]
    assert rows == [
        ("subject_id", "p1", "now"), ("biological_sex", "1", "now"), ("some_display", "72", "t1"),
        ("iron_in_blood", None, "t1"), (None, None, None), ("9-9", "1.5", None),
    ]
    wide = pivot_observations(long, ["path", "timestamp"], ["some_display", "biological_sex"], ["position"])
    found = {r["timestamp"]: (r["some_display"], r["biological_sex"]) for r in wide.collect()}
    assert found == {"now": (None, "1"), "t1": ("72", None), None: (None, None)}
    assert repeated_observations(long, ["path", "timestamp"]).count() == 0
    assert repeated_observations(long.union(long), ["path", "timestamp"]).count() == 6


def test_flattening_has_no_shuffle_and_no_python(spark, bundles):
    registry = spark.createDataFrame([("1", "n")], "loinc_code string, standard_name string")
    plan = flatten_bundles(bundles, registry, F.current_date(), "path")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan and plan.count("Generate") == 1
