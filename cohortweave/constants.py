"""Every word list, pattern, name and text that results depend on."""

# System columns of every harmonized row.
PARTICIPANT = "participant_id"
SESSION = "visit_session"
MODALITY = "modality_category"
HASH = "provenance_hash_sha256"
KEYS = (PARTICIPANT, SESSION)
SYSTEM_FIELDS = (MODALITY, PARTICIPANT, SESSION)

NONSTANDARD_PREFIX = "nonstandard_"
DEFAULT_SESSION = "ses-01"
UNKNOWN_SUBJECT = "sub-unknown"
UNKNOWN_MODALITY = "unknown"

# Where a row came from: file, block and position, written at ingest.
SOURCE = "_source"

# The 18 strings that mean "missing" in harmonized and cohort files.
CLINICAL_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "nan", "null",
)

# Raw CSV files use the wider default list, which also knows lower-case "n/a".
RAW_NA = CLINICAL_NA + ("n/a",)

# Strings that look like a missing marker but were kept as text (compared in lower case).
NA_LIKE = ("n/a", "na", "none", "null", "")

# Path entities.
SUBJECT_PATTERN = r"(sub-[a-zA-Z0-9]+)"
SESSION_PATTERN = r"(ses-[a-zA-Z0-9]+)"

# First directory level below the bronze folder -> plugin; None means no tabular plugin.
DIRECTORY_PLUGINS = {
    "genomics": "omics",
    "proteomics": "omics",
    "metabolomics": "omics",
    "assessments": "assessments",
    "biospecimens": "biospecimens",
    "ehr_notes": "nlp",
    "wearables": "wearables",
    "ehr": None,
    "pharmacy": None,
    "demographics": None,
}

# Extensions that decide a plugin on their own.
EXTENSION_PLUGINS = {".parquet": "omics"}

# A JSON document with one of these keys is wearable data.
WEARABLE_KEYS = ("heart_rate_array", "sleep_stages_array", "device_brand")

# Omics columns that decide the modality, in order.
OMICS_MARKERS = (
    ("rsid", "genomics"),
    ("protein_id", "proteomics"),
    ("metabolite_name", "metabolomics"),
)

# Score columns that make a survey a psychometric one.
PSYCHOMETRIC_MARKERS = ("phq9_total", "gad7_total")
SURVEY_PSYCHOMETRIC = "clinical_survey_psychometrics"
SURVEY_GENERAL = "clinical_survey_general"

# Specimen words, in order of precedence.
SPECIMEN_WORDS = (
    ("blood", "biospecimen_blood"),
    ("saliva", "biospecimen_saliva"),
    ("urine", "biospecimen_urine"),
    ("csf", "biospecimen_csf"),
)
SPECIMEN_UNKNOWN = "biospecimen_unknown"
SPECIMEN_UNSPECIFIED = "biospecimen_unspecified"

WEARABLE_MODALITY = "digital_biomarker_wearable"
NOTES_MODALITY = "unstructured_clinical_nlp"

# Note keywords and the codes they stand for, in output order.
NOTE_CODES = (
    ("insomnia", "SNOMED:193462001"),
    ("anxiety", "SNOMED:197480006"),
)
NO_CODES = "NONE"

RESTORATIVE_STAGES = ("deep", "rem")

# Words in an observation name that make it a vital sign.
VITAL_SIGN_WORDS = (
    "heart_rate", "blood_pressure", "temperature", "respiratory",
    "spo2", "weight", "height", "bmi",
)

# Column names that are explicit identifiers.
EXPLICIT_IDENTIFIERS = (
    "patient_name", "patient_mrn", "social_security_number",
    "phone_number", "email_address", "street_address",
    "health_plan_beneficiary_number", "account_number",
    "certificate_license_number", "vehicle_identifier",
    "device_identifier", "web_url", "ip_address",
    "biometric_identifier", "full_face_photo",
)
PII_NAME_PATTERN = r"(name|mrn|ssn|phone|email|address|ip_addr|mac_addr|_pii)"
DATE_NAME_PATTERN = r"(date|time|dob|birth)"
AGE_CAP_ABOVE = 89
AGE_CAP_VALUE = 90

REDACTED_NAME = "[REDACTED NAME]"
REDACTED_DATE = "[DATE SHIFTED]"

# Registry contract.
REQUIRED_REGISTRY_COLUMNS = (
    "original_variable_name", "standard_name", "loinc_code", "sdtm_variable",
    "omop_concept_id", "datatype", "modality", "vocabulary",
)
REGISTRY_DATATYPES = (
    "nominal", "ordinal", "ratio", "interval", "pii_name", "pii_date", "pii_note",
)
NOISY_DATATYPES = ("ratio", "interval")
LOINC_PATTERN = r"^\d{1,7}-\d$"

# Message formats of the registry check.
SCHEMA_MESSAGE = "SCHEMA ERROR: Missing columns: %s"
LOINC_MESSAGE = "DATA ERROR [%s]: Invalid LOINC format '%s'"
OMOP_MESSAGE = "DATA ERROR [%s]: OMOP Concept ID '%s' must be an integer"
DATATYPE_MESSAGE = "DATA ERROR [%s]: Invalid datatype '%s'"

# Message formats of the quality report.
LOW_COMPLETENESS_MESSAGE = "Low completeness (%d%%) for '%s'"
OUTLIER_MESSAGE = "%d outlier(s) in '%s'"
LOW_COMPLETENESS = 0.5
OUTLIER_Z = 3
SAMPLE_VALUES = 5

# Registry search.
FUZZY_MATCHES = 5
FUZZY_CUTOFF = 0.6

# Text for a file that no plugin handles.
SKIP_MESSAGE = "No plugin mapped for %s in %s/"
