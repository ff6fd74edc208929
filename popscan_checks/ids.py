"""Fixed values of the quality rules, kept apart from the engine's so that the check SQL does not depend on them."""

ACCEPTED = {
    7: ((2,), "domain_id", ("gender",), ""),
    8: ((4,), "domain_id", ("race",), ""),
    9: ((5,), "domain_id", ("ethnicity",), " (CMS Ethnicity)"),
    10: ((202,), "domain_id", ("visit",), ""),
    11: ((301,), "domain_id", ("provider specialty",), " (Specialty)"),
    12: ((400, 1000), "domain_id", ("condition", "condition/drug", "condition/meas", "condition/obs", "condition/procedure"), ""),
    13: ((700, 900), "domain_id", ("drug", "condition/drug", "device/drug", "drug/measurement", "drug/obs", "drug/procedure"), ""),
    14: ((600,), "domain_id", ("procedure", "condition/procedure", "device/procedure", "drug/procedure", "obs/procedure"), ""),
    15: ((800,), "vocabulary_id", ("0", "6"), " (LOINC)"),
    16: ((1609,), "vocabulary_id", ("0", "40"), " (DRG)"),
    17: ((1610,), "domain_id", ("revenue code",), " (revenue code)"),
}
AFTER_DEATH = (511, 512, 513, 514, 515)
BY_CONCEPT = (2, 4, 5, 200, 301, 400, 500, 505, 600, 700, 800, 900, 1000, 1609, 1610)
BY_CONCEPT_AND_MONTH = (402, 602, 702, 802, 902, 1002)
BY_MONTH = (420, 620, 720, 820, 920, 1020)
BY_TYPE = (405, 605, 705, 805)
COUNTED_DEFECTS = (7, 8, 9, 114, 115, 118, 207, 208, 209, 210, 302, 409, 410, 411, 412, 413, 509, 510, 609, 610,
    612, 613, 709, 710, 711, 712, 713, 809, 810, 812, 813, 814, 908, 909, 910, 1008, 1009, 1010, 1415, 1500, 1501,
    1600, 1601, 1701)
NEVER_NEGATIVE = (103, 105, 206, 406, 506, 606, 706, 715, 716, 717, 806, 906, 907, 1006, 1007, 1502, 1503, 1504,
    1505, 1506, 1507, 1508, 1509, 1510, 1511, 1602, 1603, 1604, 1605, 1606, 1607, 1608)
