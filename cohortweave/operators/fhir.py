"""Clinical bundles -> one row per resource, and the long and pivoted observation forms.

All resource types are flattened by one projection over one exploded scan: a column that does
not belong to a row's resource type is null. The columns are SQL text, which the driver builds
faster than nested column objects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.constants import MODALITY, PARTICIPANT, SESSION, VITAL_SIGN_WORDS
from cohortweave.functions.names import c, quoted, snake
from cohortweave.functions.paths import session_of, subject_of
from cohortweave.functions.values import full_date, number_text_sql, whole_years
from cohortweave.operators.variables import standard_names_by_code

def _blank(value: str) -> str:
    return f"coalesce({value}, '')"


def _system(*words: str) -> str:
    """Condition on a coding x that its system contains one of the words."""
    return "(" + " OR ".join(f"contains(lower({_blank('x.system')}), '{word}')" for word in words) + ")"


def _last(array: str, condition: str | None = None) -> str:
    """Last element (that satisfies a condition on x), or null."""
    return f"try_element_at(filter({array}, x -> {condition or 'true'}), -1)"


def _first(array: str) -> str:
    return f"get({array}, 0)"


def _last_code(codings: str, condition: str) -> str:
    """Code of the last coding of a system: blank if it has none, null if there is no such coding."""
    return f"CASE WHEN exists({codings}, x -> {condition}) THEN {_blank(_last(codings, condition) + '.code')} END"


def _omb_category(condition: str) -> str:
    """Display of the last category below the extensions whose url satisfies a condition on x."""
    categories = (
        f"flatten(transform(filter(resource.extension, x -> {condition}), "
        "x -> filter(coalesce(x.extension, array()), y -> y.url = 'ombCategory')))"
    )
    return f"CASE WHEN size({categories}) > 0 THEN {_blank(_last(categories) + '.valueCoding.display')} END"


def _display_of_last(concept: str) -> str:
    return f"coalesce({_last(concept + '.coding')}.display, {concept}.text, '')"


def _stated(array: str, value: str) -> str:
    """A part of a list's first element: blank if the list is not there, null if it is empty."""
    return f"CASE WHEN {array} IS NULL OR size({array}) > 0 THEN {value} END"


def _dose(part: str) -> str:
    rates = _first("resource.dosageInstruction") + ".doseAndRate"
    value = f"{_first(rates)}.doseQuantity.{part}"
    spelled = number_text_sql(value) if part == "value" else value
    return _stated("resource.dosageInstruction", _stated(rates, _blank(spelled)))


_CODINGS = "resource.code.coding"
_DRUGS = "resource.medicationCodeableConcept.coding"
_CONCEPT = "resource.valueCodeableConcept"
_IS_LOINC, _IS_ICD, _IS_SNOMED = _system("loinc"), _system("icd"), _system("snomed")
_IS_RXNORM, _IS_NDC, _IS_PROCEDURE = _system("rxnorm"), _system("ndc"), _system("cpt", "hcpcs")

# A SNOMED coding without a display keeps the display of the coding before it.
_DIAGNOSIS = f"""coalesce(
    aggregate(coalesce({_CODINGS}, array()), CAST(NULL AS STRING), (seen, x) ->
        CASE WHEN {_IS_ICD} THEN {_blank('x.display')}
             WHEN {_IS_SNOMED} THEN coalesce(x.display, seen, '') ELSE seen END),
    resource.code.text, '')"""

_OBSERVED = f"""CASE WHEN resource.valueQuantity IS NOT NULL THEN {number_text_sql('resource.valueQuantity.value')}
    WHEN {_CONCEPT} IS NOT NULL THEN coalesce({_CONCEPT}.text, {_first(_CONCEPT + '.coding')}.display, '')
    ELSE resource.valueString END"""

_OBSERVED_UNIT = f"""CASE WHEN resource.valueQuantity IS NOT NULL THEN {_blank('resource.valueQuantity.unit')}
    WHEN {_CONCEPT} IS NOT NULL THEN 'categorical' WHEN resource.valueString IS NOT NULL THEN 'text' END"""

_RACE = f"contains({_blank('x.url')}, 'race')"
_ETHNICITY = f"contains({_blank('x.url')}, 'ethnicity') AND NOT {_RACE}"
_NAME = _first("resource.name")
_TYPE = _first("resource.`type`")

# Columns of each resource type as SQL over its resource; `_display` is dropped in the end.
FIELDS: dict[str, dict[str, str]] = {
    "Patient": {
        "patient_fhir_id": _blank("resource.id"),
        "participant_sex": "coalesce(resource.gender, 'unknown')",
        "birth_date": _blank("resource.birthDate"),
        "participant_race": _omb_category(_RACE),
        "participant_ethnicity": _omb_category(_ETHNICITY),
        "_pii_patient_name": f"""CASE WHEN size(resource.name) > 0 THEN
            concat({_blank(f"array_join({_NAME}.given, ' ')")}, ' ', {_blank(_NAME + '.family')}) END""",
    },
    "Observation": {
        "loinc_code": _blank(_last_code(_CODINGS, _IS_LOINC)),
        "_display": f"coalesce({_last(_CODINGS, _IS_LOINC + ' AND x.display IS NOT NULL')}.display, resource.code.text)",
        "observation_value": _OBSERVED,
        "observation_unit": _OBSERVED_UNIT,
        "observation_status": _blank("resource.status"),
        "observation_datetime": _blank("resource.effectiveDateTime"),
    },
    "Condition": {
        "diagnosis_icd10": _last_code(_CODINGS, _IS_ICD),
        "diagnosis_snomed": _last_code(_CODINGS, f"{_IS_SNOMED} AND NOT {_IS_ICD}"),
        "diagnosis_display": _DIAGNOSIS,
        "diagnosis_status": _blank(_first("resource.clinicalStatus.coding") + ".code"),
        "diagnosis_onset": _blank("resource.onsetDateTime"),
        "diagnosis_recorded": _blank("resource.recordedDate"),
    },
    "MedicationRequest": {
        "medication_rxnorm": _last_code(_DRUGS, _IS_RXNORM),
        "medication_ndc": _last_code(_DRUGS, f"{_IS_NDC} AND NOT {_IS_RXNORM}"),
        "medication_name": _display_of_last("resource.medicationCodeableConcept"),
        "medication_status": _blank("resource.status"),
        "medication_intent": _blank("resource.intent"),
        "medication_dose_text": _stated(
            "resource.dosageInstruction", _blank(_first("resource.dosageInstruction") + ".text")
        ),
        "medication_dose_value": _dose("value"),
        "medication_dose_unit": _dose("unit"),
        "medication_authored": _blank("resource.authoredOn"),
    },
    "Procedure": {
        "procedure_cpt": _last_code(_CODINGS, _IS_PROCEDURE),
        "procedure_snomed": _last_code(_CODINGS, f"{_IS_SNOMED} AND NOT {_IS_PROCEDURE}"),
        "procedure_display": _display_of_last("resource.code"),
        "procedure_status": _blank("resource.status"),
        "procedure_date": "coalesce(resource.performedDateTime, resource.performedPeriod.start, '')",
    },
    "Encounter": {
        "encounter_id": _blank("resource.id"),
        "encounter_status": _blank("resource.status"),
        "encounter_class": _blank("resource.`class`.code"),
        "encounter_start": _blank("resource.period.start"),
        "encounter_end": _blank("resource.period.`end`"),
        "encounter_type": f"""CASE WHEN size(resource.`type`) > 0 THEN
            coalesce({_TYPE}.text, {_first(_TYPE + '.coding')}.display, '') END""",
    },
}

RESOURCE_MODALITIES = {
    "Patient": "demographics",
    "Condition": "diagnoses",
    "MedicationRequest": "pharmacy",
    "Procedure": "procedures",
    "Encounter": "encounters",
}
OBSERVATION = "Observation"


def entries(bundles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per bundle entry with its position; documents that are not bundles give none."""
    return (
        bundles.filter(c("resourceType") == "Bundle")
        .select(*[c(k) for k in keep], F.posexplode("entry").alias("entry_position", "_entry"))
        .select(*[c(k) for k in keep], "entry_position", c("_entry").getField("resource").alias("resource"))
    )


def flatten_bundles(
    bundles: DataFrame, registry: DataFrame, as_of: Column, path: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of all known resources of all bundles, tagged with their modality.

    `as_of` is the date ages are counted to. With a `path` column, participant and session are
    taken from it; `keep` names further bundle columns to carry along.
    """
    carried = [*keep, *([path] if path else [])]
    known = [*RESOURCE_MODALITIES, OBSERVATION]
    resource_type = c("resource").getField("resourceType")
    rows = entries(bundles, carried).filter(resource_type.isin(known))
    columns = [
        f"CASE WHEN resource.resourceType = '{resource}' THEN {value} END AS {name}"
        for resource, fields in FIELDS.items()
        for name, value in fields.items()
    ]
    flat = rows.selectExpr(
        *map(quoted, carried), "entry_position", "resource.resourceType AS fhir_resource_type", *columns
    ).withColumn("participant_age", whole_years(full_date(c("birth_date")), as_of))

    named = standard_names_by_code(flat, registry, "loinc_code", output="_registered", once=True)
    name = F.coalesce(
        c("_registered"), F.nullif(snake(c("_display")), F.lit("")), F.concat(F.lit("obs_"), c("loinc_code"))
    )
    modality = F.when(c("fhir_resource_type") == OBSERVATION, observation_modality(c("observation_name")))
    for resource, tag in RESOURCE_MODALITIES.items():
        modality = modality.when(c("fhir_resource_type") == resource, F.lit(tag))
    result = named.withColumn(
        "observation_name", F.when(c("fhir_resource_type") == OBSERVATION, name)
    ).withColumn(MODALITY, modality)
    if path:
        result = result.withColumn(PARTICIPANT, subject_of(c(path))).withColumn(SESSION, session_of(c(path)))
    return result.drop("_registered", "_display")


def observation_modality(name: Column) -> Column:
    """Vital sign if the observation's name contains one of the known words, else lab result."""
    return F.when(F.lower(name).rlike("|".join(VITAL_SIGN_WORDS)), F.lit("vital_signs")).otherwise(
        F.lit("lab_results")
    )


def long_observations(bundles: DataFrame, bundle_id: str, as_of: Column) -> DataFrame:
    """(bundle, subject, variable, value, timestamp, position): subject, sex and every observation.

    Each bundle's first patient names the subject. The two patient rows carry `as_of` as their
    timestamp and come before the observations.
    """
    resources = F.transform(c("entry"), lambda e: e["resource"])
    patient = F.get(F.filter(resources, lambda r: r["resourceType"] == "Patient"), F.lit(0))
    header = bundles.select(
        c(bundle_id), "entry", F.coalesce(patient["id"], F.lit("unknown_subject")).alias("subject_id"),
        patient["gender"].alias("_gender"),
    )
    stamp = as_of.cast("string")
    about = header.select(
        c(bundle_id), "subject_id",
        F.inline(F.array_compact(F.array(
            F.struct(F.lit("subject_id").alias("variable"), c("subject_id").alias("value"),
                     stamp.alias("timestamp"), F.lit(-2).alias("position")),
            F.when(F.coalesce(c("_gender"), F.lit("")) != "",
                   F.struct(F.lit("biological_sex").alias("variable"), sex_code(c("_gender")).alias("value"),
                            stamp.alias("timestamp"), F.lit(-1).alias("position"))),
        ))),
    )
    exploded = header.select(c(bundle_id), "subject_id", F.posexplode("entry").alias("position", "_entry"))
    resource = c("_entry").getField("resource")
    first = F.get(resource["code"]["coding"], F.lit(0))
    observed = exploded.filter(resource["resourceType"] == OBSERVATION).select(
        c(bundle_id), "subject_id",
        F.coalesce(F.nullif(snake(first["display"]), F.lit("")), first["code"]).alias("variable"),
        F.expr(number_text_sql("_entry.resource.valueQuantity.value")).alias("value"),
        resource["effectiveDateTime"].alias("timestamp"), "position",
    )
    return about.unionByName(observed)


def sex_code(gender: Column) -> Column:
    """'1' for male, '2' for anything else that is stated."""
    return F.when(gender == "male", F.lit("1")).otherwise(F.lit("2"))


def pivot_observations(
    long: DataFrame,
    index: Sequence[str],
    variables: Sequence[str],
    order_by: Sequence[str],
    *,
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """One row per index, one column per variable. Of several values, the first by `order_by`.

    The variable list is given, so no job is needed to find it; values are combined before the
    shuffle.
    """
    order = F.struct(*[c(o) for o in order_by])
    return (
        long.groupBy(*[c(i) for i in index])
        .pivot(variable, list(variables))
        .agg(F.min_by(c(value), order))
    )


def repeated_observations(long: DataFrame, index: Sequence[str], variable: str = "variable") -> DataFrame:
    """(index, variable, rows) that occur more than once: what a strict pivot would reject."""
    return (
        long.groupBy(*[c(i) for i in index], c(variable))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
    )
