"""Fixed values of the staging pipelines: labels, word lists, patterns and source tags.

They must stay exactly as listed for labels, filters, hash keys and hash diffs to come out equal
to the warehouse loads. Source tags that identify a deployment (the owning corporation used by the
market competitor flag) are arguments of the pipelines, not constants.
"""

# CRM product regions (one source table each, same layout).
CRM_REGIONS = ("apcnbrcem", "jpopp8us", "itawri", "latam")

# Therapy-area names that label a CRM product TA (and keep it from being a BRAND).
THERAPY_AREAS = (
    "DERMATOLOGY", "ENDOCRINOLOGY", "GASTROENTEROLOGY", "NEUROLOGY", "OPTHALMOLOGY",
    "RHEUMATOLOGY", "UROLOGY",
)

# CRM name deny-list (LIKE patterns on upper(trim(name))).
NAME_DENY_PATTERNS = ("%DUPLICATE TO%", "<NOT SPECIFIED>", "%DELETE%", "%NOT SPECIFIED%", "BI %")

# CRM product-type / MDM-type values used by the label rules.
BRAND_MDM_TYPES = ("LOCAL BRAND", "GLOBAL BRAND")
NOT_BRAND_MDM_TYPES = ("MEDICAL SEGMENT", "INDICATION")
PMP_PRODUCT_TYPES = ("FORM", "ORDER", "SAMPLE", "SAMPLE PRODUCT GROUP")

# LIKE patterns with '!' as escape character: 'B!_%' is a literal underscore; '10_%' a wildcard.
BRAND_EXTERNAL_ID = "B!_%"
GB_INDICATION_EXTERNAL_ID = "GB!_%"
CODE_INDICATION_EXTERNAL_ID = "10_%"

# Labels.
BRAND, IND, PMP, TA, MP = "BRAND", "IND", "PMP", "TA", "MP"

# Source tags.
CRM_DATASET = "CRM"
CRM_SOURCE = "VEEVA_CRM"
MARKET_DATASET = "PRESCRIPTIONDATA"
MARKET_SOURCE = "CLOSEUP_MARKET"
CATALOGUE_SOURCE = "GOB360_PM"
CATALOGUE_COUNTRY = "MX"
LEGACY_SOURCE = "ATV"

# Relationship types.
GLOBAL_ROLLUP = "GlobalRollup"
PMP_TO_BRAND = "PMPtoBRAND"
BRAND_TO_TA = "BRANDtoTA"
BRANDIND_TO_BRAND = "BRANDINDtoBRAND"
MP_TO_BRAND = "MPtoBRAND"

# Market flags.
BRAND_ID_PREFIX = "BRAND_"
MARKET_NAME_CUT = 3          # market brand names carry a 3-character suffix that is cut off
STATUS_ACTIVE = "A"
