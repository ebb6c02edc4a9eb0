"""Bundles, observations, telemetry arrays and notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table
from cohortweave.functions.names import c
from cohortweave.functions.text import note_codes
from cohortweave.functions.values import array_mean as mean_of
from cohortweave.functions.values import stage_share as share_of
from cohortweave.operators import fhir
from cohortweave.sources.bronze import read_bundles
from cohortweave.sources.workspace import new_folder

AS_OF = "2020-06-30"

# One JSON document per order with the fields of each resource.
BUNDLE_JSON = """
    concat('{"o_orderkey":', o_orderkey, ',"path":"/bronze/ehr/sub-', o_custkey, '_ses-', o_orderkey, '.json",',
    CASE WHEN o_orderkey % 10 = 9 THEN '"resourceType":"Other","entry":[{"resource":{"resourceType":"Patient"}}]}' ELSE
    concat('"resourceType":"Bundle","entry":[',
        '{"resource":{"resourceType":"Patient","id":"pt-', o_custkey, '"',
            CASE WHEN o_custkey % 3 = 0 THEN ',"gender":"male"' WHEN o_custkey % 3 = 1 THEN ',"gender":"female"' ELSE '' END,
            ',"birthDate":"', CASE WHEN o_orderkey % 4 = 0 THEN '1980-05' ELSE concat('19', 40 + o_custkey % 50, '-03-1', o_custkey % 10) END, '"',
            ',"name":[{"given":["Ann","', o_orderstatus, '"],"family":"Lee"}]',
            ',"extension":[{"url":"http://x/us-core-race","extension":[{"url":"text"},{"url":"ombCategory","valueCoding":{"display":"', o_orderpriority, '"}}]},{"url":"http://x/us-core-ethnicity","extension":[{"url":"ombCategory","valueCoding":{}}]}]}}',
        ',{"resource":{"resourceType":"Observation","status":"final","code":{"text":"Fallback Text","coding":[{"system":"http://loinc.org","code":"1-1","display":"Old Name"},{"system":"http://LOINC.org","code":"', o_custkey, '-', o_orderkey % 10, '"',
            CASE WHEN o_orderkey % 2 = 0 THEN ',"display":"Body Weight Now"' ELSE '' END, '},{"system":"local","code":"z","display":"Zed"}]},"valueQuantity":{"value":', o_orderkey, ',"unit":"kg"},"effectiveDateTime":"2024-01-01"}}',
        ',{"resource":{"resourceType":"Observation","code":{"coding":[]},"valueCodeableConcept":{"coding":[{"display":"', o_orderstatus, '"}]}}}',
        ',{"resource":{"resourceType":"Observation","code":{"text":"Serum Iron"},"valueString":"', o_orderpriority, '"}}',
        ',{"resource":{"resourceType":"Condition","code":{"text":"t","coding":[{"system":"ICD-10","code":"I', o_orderkey % 100, '","display":"Icd ', o_orderstatus, '"},{"system":"snomed","code":"S', o_custkey, '"}]},"clinicalStatus":{"coding":[{"code":"active"}]},"onsetDateTime":"2001"}}',
        ',{"resource":{"resourceType":"MedicationRequest","status":"on","intent":"order","medicationCodeableConcept":{"text":"Pill","coding":[{"system":"rxnorm","code":"R', o_custkey % 20, '","display":"Drug"},{"system":"ndc","code":"N"}]},"dosageInstruction":',
            CASE WHEN o_orderkey % 3 = 0 THEN '[]' WHEN o_orderkey % 3 = 1 THEN '[{"text":"daily","doseAndRate":[{"doseQuantity":{"value":2.50,"unit":"mg"}}]}]' ELSE '[{"text":"none","doseAndRate":[]}]' END, '}}',
        ',{"resource":{"resourceType":"Procedure","code":{"coding":[{"system":"urn:HCPCS","code":"H1","display":"Scan"},{"system":"snomed","code":"S2"}]},"performedPeriod":{"start":"2020-', o_orderkey % 10, '"}}}',
        ',{"resource":{"resourceType":"Encounter","id":"e', o_orderkey, '","class":{"code":"AMB"},"period":{"start":"a"},"type":[{"coding":[{"display":"Visit"}]}]}}',
        ',{"resource":{"resourceType":"Device","id":"ignored"}}',
    ']}') END)
"""


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bundle per order, a tenth of them other documents: written as JSON lines and read back.

    The documents are many times larger than the orders, so orders are spread out first.
    """
    folder = new_folder(spark, "bundles")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    spread = orders.repartition(spark.sparkContext.defaultParallelism)
    spread.select(F.expr(BUNDLE_JSON)).write.option("compression", "gzip").text(folder)
    return read_bundles(spark, folder, one_per_line=True, extra="o_orderkey bigint, path string")


def code_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as coded variables: even keys are known under codes ending in -4."""
    return table(spark, sf_dir, "customer").filter(c("c_custkey") % 2 == 0).select(
        F.concat("c_custkey", F.lit("-4")).alias("loinc_code"),
        F.concat(F.lit("heart_rate_"), "c_mktsegment").alias("standard_name"),
    )


TEXT_COLUMNS = (
    "patient_fhir_id", "participant_sex", "birth_date", "participant_race", "participant_ethnicity",
    "_pii_patient_name", "loinc_code", "observation_name", "observation_value", "observation_unit",
    "observation_status", "observation_datetime", "diagnosis_icd10", "diagnosis_snomed", "diagnosis_display",
    "diagnosis_status", "diagnosis_onset", "diagnosis_recorded", "medication_rxnorm", "medication_ndc",
    "medication_name", "medication_status", "medication_intent", "medication_dose_text", "medication_dose_value",
    "medication_dose_unit", "medication_authored", "procedure_cpt", "procedure_snomed", "procedure_display",
    "procedure_status", "procedure_date", "encounter_id", "encounter_status", "encounter_class",
    "encounter_start", "encounter_end", "encounter_type",
)


def _resource_sql(position: int, resource: str, modality: str, **values: str) -> str:
    listed = ", ".join(f"{values.get(name, 'NULL')}::VARCHAR AS {name}" for name in TEXT_COLUMNS)
    age = values.get("participant_age", "NULL")
    return f"""
        SELECT o_orderkey, {position} AS entry_position, '{resource}' AS fhir_resource_type, {listed},
               CAST({age} AS BIGINT) AS participant_age, {modality} AS modality_category,
               'sub-' || o_custkey AS participant_id, 'ses-' || o_orderkey AS visit_session
        FROM bundled"""


_BIRTH = "'19' || (40 + o_custkey % 50) || '-03-1' || (o_custkey % 10)"
_NAME = """coalesce('heart_rate_' || segment, CASE WHEN o_orderkey % 2 = 0 THEN 'body_weight_now' ELSE 'old_name' END)"""
_DOSE = "CASE o_orderkey % 3 WHEN 1 THEN '{one}' WHEN 2 THEN {two} END"

FLATTEN_SQL = """
    WITH bundled AS (
        SELECT o.*, c_mktsegment AS segment
        FROM orders o LEFT JOIN customer
            ON c_custkey = o_custkey AND c_custkey % 2 = 0 AND o_orderkey % 10 = 4
        WHERE o_orderkey % 10 <> 9)
""" + " UNION ALL ".join((
    _resource_sql(
        0, "Patient", "'demographics'", patient_fhir_id="'pt-' || o_custkey",
        participant_sex="CASE o_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unknown' END",
        birth_date=f"CASE WHEN o_orderkey % 4 = 0 THEN '1980-05' ELSE {_BIRTH} END",
        participant_race="o_orderpriority", participant_ethnicity="''",
        _pii_patient_name="'Ann ' || o_orderstatus || ' Lee'",
        participant_age=f"CASE WHEN o_orderkey % 4 <> 0 THEN (DATE '{AS_OF}' - CAST({_BIRTH} AS DATE)) // 365 END",
    ),
    _resource_sql(
        1, "Observation",
        f"CASE WHEN {_NAME} SIMILAR TO '.*(heart_rate|weight).*' THEN 'vital_signs' ELSE 'lab_results' END",
        loinc_code="o_custkey || '-' || (o_orderkey % 10)", observation_name=_NAME, observation_value="o_orderkey",
        observation_unit="'kg'", observation_status="'final'", observation_datetime="'2024-01-01'",
    ),
    _resource_sql(
        2, "Observation", "'lab_results'", loinc_code="''", observation_name="'obs_'",
        observation_value="o_orderstatus", observation_unit="'categorical'", observation_status="''",
        observation_datetime="''",
    ),
    _resource_sql(
        3, "Observation", "'lab_results'", loinc_code="''", observation_name="'serum_iron'",
        observation_value="o_orderpriority", observation_unit="'text'", observation_status="''",
        observation_datetime="''",
    ),
    _resource_sql(
        4, "Condition", "'diagnoses'", diagnosis_icd10="'I' || (o_orderkey % 100)", diagnosis_snomed="'S' || o_custkey",
        diagnosis_display="'Icd ' || o_orderstatus", diagnosis_status="'active'", diagnosis_onset="'2001'",
        diagnosis_recorded="''",
    ),
    _resource_sql(
        5, "MedicationRequest", "'pharmacy'", medication_rxnorm="'R' || (o_custkey % 20)", medication_ndc="'N'",
        medication_name="'Pill'", medication_status="'on'", medication_intent="'order'", medication_authored="''",
        medication_dose_text=_DOSE.format(one="daily", two="'none'"),
        medication_dose_value=_DOSE.format(one="2.5", two="NULL"),
        medication_dose_unit=_DOSE.format(one="mg", two="NULL"),
    ),
    _resource_sql(
        6, "Procedure", "'procedures'", procedure_cpt="'H1'", procedure_snomed="'S2'", procedure_display="''",
        procedure_status="''", procedure_date="'2020-' || (o_orderkey % 10)",
    ),
    _resource_sql(
        7, "Encounter", "'encounters'", encounter_id="'e' || o_orderkey", encounter_status="''",
        encounter_class="'AMB'", encounter_start="'a'", encounter_end="''", encounter_type="'Visit'",
    ),
))


@query(FLATTEN_SQL)
def bundle_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = fhir.flatten_bundles(
        bundles(spark, sf_dir), code_registry(spark, sf_dir), F.lit(AS_OF).cast("date"), "path", ["o_orderkey"]
    )
    return flat.drop("path")


@query(f"""
    WITH bundled AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 9)
    SELECT o_orderkey, 'pt-' || o_custkey AS subject_id, 'subject_id' AS variable, 'pt-' || o_custkey AS value,
           '{AS_OF}' AS timestamp FROM bundled
    UNION ALL
    SELECT o_orderkey, 'pt-' || o_custkey, 'biological_sex', CASE o_custkey % 3 WHEN 0 THEN '1' ELSE '2' END, '{AS_OF}'
    FROM bundled WHERE o_custkey % 3 <> 2
    UNION ALL
    SELECT o_orderkey, 'pt-' || o_custkey, 'old_name', o_orderkey::VARCHAR, '2024-01-01' FROM bundled
    UNION ALL
    SELECT o_orderkey, 'pt-' || o_custkey, NULL, NULL, NULL FROM bundled
    UNION ALL
    SELECT o_orderkey, 'pt-' || o_custkey, NULL, NULL, NULL FROM bundled
""")
def long_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = bundles(spark, sf_dir).filter(c("resourceType") == "Bundle")
    return fhir.long_observations(documents, "o_orderkey", F.lit(AS_OF)).drop("position")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("SELECT strftime(ts, '%Y-%m-%d') AS timestamp, " + ", ".join(
    f"arg_min(value, row(ts, event_id)) FILTER (event_type = '{t}') AS {t}" for t in EVENT_TYPES
) + " FROM events GROUP BY 1")
def observation_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("timestamp"), c("event_type").alias("variable"), "value", "ts", "event_id"
    )
    return fhir.pivot_observations(observed, ["timestamp"], EVENT_TYPES, ["ts", "event_id"])


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS timestamp, event_type AS variable, count(*) AS rows
    FROM events GROUP BY 1, 2 HAVING count(*) > 1
""")
def repeated_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("timestamp"), c("event_type").alias("variable")
    )
    return fhir.repeated_observations(observed, ["timestamp"])


@query("SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 6) AS mean_hr FROM embeddings")
def array_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(mean_of(c("embedding")), 6).alias("mean_hr"))


@query("""
    WITH words AS (SELECT conv_id, turn, string_split(lower(text), ' ') AS stages FROM conversations)
    SELECT conv_id, turn, round(100.0::DOUBLE * len(list_filter(stages, lambda s: s IN ('the', 'la', 'of'))) / len(stages), 6)
           AS sleep_efficiency
    FROM words
""")
def stage_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(F.lower("text"), " ")
    share = share_of(words, ["the", "la", "of"])
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.round(share, 6).alias("sleep_efficiency"))


NOTE_WORDS = (("the", "SNOMED:1"), ("la", "SNOMED:2"), ("license", "SNOMED:3"))


@query("""
    SELECT doc_id, coalesce(nullif(concat_ws(';', CASE WHEN contains(lower(text), 'the') THEN 'SNOMED:1' END,
                                             CASE WHEN contains(lower(text), 'la') THEN 'SNOMED:2' END,
                                             CASE WHEN contains(lower(text), 'license') THEN 'SNOMED:3' END), ''), 'NONE')
           AS extracted_snomed,
           coalesce(nullif(concat_ws(';', CASE WHEN contains(lower(text), 'insomnia') THEN 'SNOMED:193462001' END,
                                     CASE WHEN contains(lower(text), 'anxiety') THEN 'SNOMED:197480006' END), ''), 'NONE')
           AS default_codes
    FROM documents
""")
def note_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", note_codes(c("text"), NOTE_WORDS).alias("extracted_snomed"), note_codes(c("text")).alias("default_codes")
    )
