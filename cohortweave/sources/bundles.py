"""Schema of the clinical bundles that are read from JSON."""

# The parts of a bundle that are read. Values of mixed type are kept as the text in the file.
BUNDLE_DDL = """
    resourceType string,
    entry array<struct<resource: struct<
        resourceType: string, id: string, status: string, gender: string, birthDate: string,
        name: array<struct<given: array<string>, family: string>>,
        extension: array<struct<url: string,
            extension: array<struct<url: string, valueCoding: struct<display: string>>>>>,
        code: struct<text: string, coding: array<struct<system: string, code: string, display: string>>>,
        valueQuantity: struct<value: string, unit: string>,
        valueCodeableConcept: struct<text: string, coding: array<struct<display: string>>>,
        valueString: string,
        effectiveDateTime: string,
        clinicalStatus: struct<coding: array<struct<code: string>>>,
        onsetDateTime: string, recordedDate: string,
        medicationCodeableConcept: struct<text: string,
            coding: array<struct<system: string, code: string, display: string>>>,
        intent: string, authoredOn: string,
        dosageInstruction: array<struct<text: string,
            doseAndRate: array<struct<doseQuantity: struct<value: string, unit: string>>>>>,
        performedDateTime: string, performedPeriod: struct<start: string>,
        class: struct<code: string>,
        period: struct<start: string, `end`: string>,
        type: array<struct<text: string, coding: array<struct<display: string>>>>
    >>>
"""
