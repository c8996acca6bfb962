"""Values that the oracle SQL states on its own, apart from the implementation.

Fixed values: the warehouse's column lists, hash ingredient orders, labels, word lists and source
tags, and the test bed's dates and names. A change in the implementation's copy makes queries differ.
"""

from __future__ import annotations

from types import SimpleNamespace
from typing import NamedTuple


class Entity(NamedTuple):
    columns: tuple
    key_cols: tuple
    diff_cols: tuple
    required_cols: tuple
    reject_id_cols: tuple
    date_cols: tuple

    def with_diff(self, diff: tuple) -> "Entity":
        return self._replace(diff_cols=diff)


SAT_META = tuple("hashkey hashdiff start_datetime load_datetime end_datetime updated_datetime etl_batch_id record_source".split())

PRODUCT_DATE_COLUMNS = tuple("effective_date end_date approved_date marketing_start_date marketing_end_date expiration_date".split())

PRODUCT = Entity(
    columns=tuple("""
        geographic_id dataset_id source_dataset_id dataset_product_id product_type_code product_name
        standardized_product_name description product_status_code effective_date end_date brand_name
        generic_names approved_date marketing_start_date marketing_end_date expiration_date substance
        dose_form_code strength route_of_administration_code pharmaceutical_product_quantity
        unit_of_presentation_code primary_package_quantity primary_package_type_code
        secondary_package_quantity secondary_package_type_code package_quantity shelf_life_quantity
        shelf_life_unit_of_measure_code sample_indicator competitor_indicator generic_indicator
        prescription_required_indicator atc_code who_code nfc_code chc_nec_code usc_code manufacturer_id
        manufacturer corporation daily_dosage_quantity is_imported generic_product_description channel
        chc_flag""".split()),
    key_cols=tuple("geographic_id dataset_id source_dataset_id dataset_product_id".split()),
    diff_cols=tuple("""
        geographic_id dataset_id source_dataset_id product_type_code dataset_product_id product_name
        standardized_product_name description product_status_code generic_names effective_date end_date
        brand_name approved_date marketing_start_date marketing_end_date expiration_date substance
        dose_form_code strength route_of_administration_code pharmaceutical_product_quantity
        unit_of_presentation_code primary_package_quantity primary_package_type_code
        secondary_package_quantity secondary_package_type_code package_quantity shelf_life_quantity
        shelf_life_unit_of_measure_code sample_indicator competitor_indicator generic_indicator
        prescription_required_indicator atc_code who_code nfc_code chc_nec_code usc_code manufacturer_id
        daily_dosage_quantity corporation manufacturer is_imported generic_product_description channel
        chc_flag""".split()),
    required_cols=("geographic_id", "product_name", "dataset_product_id"),
    reject_id_cols=("dataset_product_id",),
    date_cols=PRODUCT_DATE_COLUMNS,
)

# The CRM diff has no standardized_product_name.
PRODUCT_DIFF_CRM = tuple("""
    geographic_id dataset_id source_dataset_id product_type_code dataset_product_id product_name
    description product_status_code generic_names effective_date end_date
    brand_name approved_date marketing_start_date marketing_end_date expiration_date substance
    dose_form_code strength route_of_administration_code pharmaceutical_product_quantity
    unit_of_presentation_code primary_package_quantity primary_package_type_code
    secondary_package_quantity secondary_package_type_code package_quantity shelf_life_quantity
    shelf_life_unit_of_measure_code sample_indicator competitor_indicator generic_indicator
    prescription_required_indicator atc_code who_code nfc_code chc_nec_code usc_code manufacturer_id
    daily_dosage_quantity corporation manufacturer is_imported generic_product_description channel
    chc_flag""".split())

# The legacy diff has generic_names right after brand_name.
PRODUCT_DIFF_LEGACY = tuple("""
    geographic_id dataset_id source_dataset_id product_type_code dataset_product_id product_name
    standardized_product_name description product_status_code effective_date end_date
    brand_name generic_names approved_date marketing_start_date marketing_end_date expiration_date substance
    dose_form_code strength route_of_administration_code pharmaceutical_product_quantity
    unit_of_presentation_code primary_package_quantity primary_package_type_code
    secondary_package_quantity secondary_package_type_code package_quantity shelf_life_quantity
    shelf_life_unit_of_measure_code sample_indicator competitor_indicator generic_indicator
    prescription_required_indicator atc_code who_code nfc_code chc_nec_code usc_code manufacturer_id
    daily_dosage_quantity corporation manufacturer is_imported generic_product_description channel
    chc_flag""".split())

_IDENTIFIER = tuple("""geographic_id dataset_id dataset_product_id identifier_type_code identifier_id status_code
    effective_date end_date""".split())
IDENTIFIER = Entity(
    columns=_IDENTIFIER,
    key_cols=("geographic_id", "dataset_id", "dataset_product_id", "identifier_id"),
    diff_cols=_IDENTIFIER,
    required_cols=("geographic_id", "dataset_product_id", "identifier_id"),
    reject_id_cols=("dataset_product_id",),
    date_cols=("effective_date", "end_date"),
)

_RELATIONSHIP = tuple("""parent_geographic_id child_geographic_id parent_dataset_id child_dataset_id
    parent_dataset_product_id child_dataset_product_id relationship_type_code status_code effective_date end_date""".split())
RELATIONSHIP = Entity(
    columns=_RELATIONSHIP,
    key_cols=("parent_geographic_id", "child_geographic_id", "parent_dataset_product_id", "child_dataset_product_id"),
    diff_cols=_RELATIONSHIP,
    required_cols=("parent_geographic_id", "child_geographic_id", "parent_dataset_product_id", "child_dataset_product_id"),
    reject_id_cols=("parent_dataset_product_id", "child_dataset_product_id"),
    date_cols=("effective_date", "end_date"),
)

LEGACY_NULL_COLUMNS = tuple("""who_code nfc_code chc_nec_code usc_code manufacturer corporation daily_dosage_quantity
    is_imported generic_product_description channel chc_flag""".split())
INDICATORS = ("competitor_indicator", "generic_indicator", "prescription_required_indicator")
QUANTITIES = tuple("""pharmaceutical_product_quantity primary_package_quantity secondary_package_quantity package_quantity
    shelf_life_quantity""".split())

LABELS = SimpleNamespace(
    CRM_REGIONS=("apcnbrcem", "jpopp8us", "itawri", "latam"),
    THERAPY_AREAS=("DERMATOLOGY", "ENDOCRINOLOGY", "GASTROENTEROLOGY", "NEUROLOGY", "OPTHALMOLOGY", "RHEUMATOLOGY", "UROLOGY"),
    NAME_DENY_PATTERNS=("%DUPLICATE TO%", "<NOT SPECIFIED>", "%DELETE%", "%NOT SPECIFIED%", "BI %"),
    BRAND="BRAND", IND="IND", PMP="PMP", TA="TA", MP="MP",
    CRM_SOURCE="VEEVA_CRM", MARKET_SOURCE="CLOSEUP_MARKET", CATALOGUE_SOURCE="GOB360_PM", LEGACY_SOURCE="ATV",
    CATALOGUE_COUNTRY="MX", MARKET_DATASET="PRESCRIPTIONDATA", CRM_DATASET="CRM",
    GLOBAL_ROLLUP="GlobalRollup", PMP_TO_BRAND="PMPtoBRAND", BRAND_TO_TA="BRANDtoTA", BRANDIND_TO_BRAND="BRANDINDtoBRAND",
    MP_TO_BRAND="MPtoBRAND",
)

BED = SimpleNamespace(
    RUN_TS="2025-01-02 03:04:05", DAY1_TS="2025-01-01 00:00:00", HIST0_END_TS="2024-12-31 00:00:00",
    DAY1_BATCH="B20250101", DAY2_BATCH="B20250102", RECORD_SOURCE="CRM", STAGING_MODEL="STG_CUSTOMER",
)
