"""Catalogue names of the analyses that every event table has."""

# The wording under which results are known, irregular as it is.
DOMAIN_NAMES: dict[int, str] = {
    200: "Number of persons with at least one visit occurrence, by visit_concept_id",
    201: "Number of visit occurrence records, by visit_concept_id",
    202: "Number of persons by visit occurrence start month, by visit_concept_id",
    203: "Number of distinct visit occurrence concepts per person",
    204: "Number of persons with at least one visit occurrence, by visit_concept_id by calendar year by gender by age decile",
    206: "Distribution of age by visit_concept_id",
    207: "Number of visit records with invalid person_id",
    208: "Number of visit records outside valid observation period",
    209: "Number of visit records with end date < start date",
    210: "Number of visit records with invalid care_site_id",
    220: "Number of visit occurrence records by visit occurrence start month",
    400: "Number of persons with at least one condition occurrence, by condition_concept_id",
    401: "Number of condition occurrence records, by condition_concept_id",
    402: "Number of persons by condition occurrence start month, by condition_concept_id",
    403: "Number of distinct condition occurrence concepts per person",
    404: "Number of persons with at least one condition occurrence, by condition_concept_id by calendar year by gender by age decile",
    405: "Number of condition occurrence records, by condition_concept_id by condition_type_concept_id",
    406: "Distribution of age by condition_concept_id",
    409: "Number of condition occurrence records with invalid person_id",
    410: "Number of condition occurrence records outside valid observation period",
    411: "Number of condition occurrence records with end date < start date",
    412: "Number of condition occurrence records with invalid provider_id",
    413: "Number of condition occurrence records with invalid visit_id",
    420: "Number of condition occurrence records by condition occurrence start month",
    600: "Number of persons with at least one procedure occurrence, by procedure_concept_id",
    601: "Number of procedure occurrence records, by procedure_concept_id",
    602: "Number of persons by procedure occurrence start month, by procedure_concept_id",
    603: "Number of distinct procedure occurrence concepts per person",
    604: "Number of persons with at least one procedure occurrence, by procedure_concept_id by calendar year by gender by age decile",
    605: "Number of procedure occurrence records, by procedure_concept_id by procedure_type_concept_id",
    606: "Distribution of age by procedure_concept_id",
    609: "Number of procedure occurrence records with invalid person_id",
    610: "Number of procedure occurrence records outside valid observation period",
    612: "Number of procedure occurrence records with invalid provider_id",
    613: "Number of procedure occurrence records with invalid visit_id",
    620: "Number of procedure occurrence records  by procedure occurrence start month",
    700: "Number of persons with at least one drug exposure, by drug_concept_id",
    701: "Number of drug exposure records, by drug_concept_id",
    702: "Number of persons by drug exposure start month, by drug_concept_id",
    703: "Number of distinct drug exposure concepts per person",
    704: "Number of persons with at least one drug exposure, by drug_concept_id by calendar year by gender by age decile",
    705: "Number of drug exposure records, by drug_concept_id by drug_type_concept_id",
    706: "Distribution of age by drug_concept_id",
    709: "Number of drug exposure records with invalid person_id",
    710: "Number of drug exposure records outside valid observation period",
    711: "Number of drug exposure records with end date < start date",
    712: "Number of drug exposure records with invalid provider_id",
    713: "Number of drug exposure records with invalid visit_id",
    720: "Number of drug exposure records  by drug exposure start month",
    800: "Number of persons with at least one observation occurrence, by observation_concept_id",
    801: "Number of observation occurrence records, by observation_concept_id",
    802: "Number of persons by observation occurrence start month, by observation_concept_id",
    803: "Number of distinct observation occurrence concepts per person",
    804: "Number of persons with at least one observation occurrence, by observation_concept_id by calendar year by gender by age decile",
    805: "Number of observation occurrence records, by observation_concept_id by observation_type_concept_id",
    806: "Distribution of age by observation_concept_id",
    807: "Number of observation occurrence records, by observation_concept_id and unit_concept_id",
    809: "Number of observation records with invalid person_id",
    810: "Number of observation records outside valid observation period",
    812: "Number of observation records with invalid provider_id",
    813: "Number of observation records with invalid visit_id",
    820: "Number of observation records  by observation start month",
    900: "Number of persons with at least one drug era, by drug_concept_id",
    901: "Number of drug era records, by drug_concept_id",
    902: "Number of persons by drug era start month, by drug_concept_id",
    903: "Number of distinct drug era concepts per person",
    904: "Number of persons with at least one drug era, by drug_concept_id by calendar year by gender by age decile",
    906: "Distribution of age by drug_concept_id",
    908: "Number of drug eras without valid person",
    909: "Number of drug eras outside valid observation period",
    910: "Number of drug eras with end date < start date",
    920: "Number of drug era records  by drug era start month",
    1000: "Number of persons with at least one condition era, by condition_concept_id",
    1001: "Number of condition era records, by condition_concept_id",
    1002: "Number of persons by condition era start month, by condition_concept_id",
    1003: "Number of distinct condition era concepts per person",
    1004: "Number of persons with at least one condition era, by condition_concept_id by calendar year by gender by age decile",
    1006: "Distribution of age by condition_concept_id",
    1008: "Number of condition eras without valid person",
    1009: "Number of condition eras outside valid observation period",
    1010: "Number of condition eras with end date < start date",
    1020: "Number of condition era records by condition era start month",
    1800: "Number of persons with at least one measurement, by measurement_concept_id",
    1801: "Number of measurement occurrence records, by measurement_concept_id",
    1802: "Number of persons by measurement start month, by measurement_concept_id",
    1803: "Number of distinct measurement concepts per person",
    1804: "Number of persons with at least one measurement, by measurement_concept_id by calendar year by gender by age decile",
    1805: "Number of measurement records, by measurement_concept_id by measurement_type_concept_id",
    1806: "Distribution of age by measurement_concept_id",
    1807: "Number of measurement records, by measurement_concept_id and unit_concept_id",
    1809: "Number of measurement records with invalid person_id",
    1810: "Number of measurement records outside valid observation period",
    1812: "Number of measurement records with invalid provider_id",
    1813: "Number of measurement records with invalid visit_id",
    1820: "Number of measurement records by measurement start month",
}
