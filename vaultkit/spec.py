"""Entity specifications and the per-load context.

An ``EntitySpec`` says which columns make an entity's hash key and hash diff, which attributes its
satellite carries, which fields are required and which ids are checked against the reject set.
A ``LoadContext`` carries what a load takes from its environment: batch id, run time, record source.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Conformed column lists and hash ingredient orders. They must stay exactly as
# listed (names and order) for hash keys and hash diffs to equal those of the warehouse loads.
# ---------------------------------------------------------------------------------------------

# Conformed product schema, 47 business columns in mart order.
PRODUCT_COLUMNS = (
    "geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id", "product_type_code",
    "product_name", "standardized_product_name", "description", "product_status_code",
    "effective_date", "end_date", "brand_name", "generic_names", "approved_date",
    "marketing_start_date", "marketing_end_date", "expiration_date", "substance", "dose_form_code",
    "strength", "route_of_administration_code", "pharmaceutical_product_quantity",
    "unit_of_presentation_code", "primary_package_quantity", "primary_package_type_code",
    "secondary_package_quantity", "secondary_package_type_code", "package_quantity",
    "shelf_life_quantity", "shelf_life_unit_of_measure_code", "sample_indicator",
    "competitor_indicator", "generic_indicator", "prescription_required_indicator", "atc_code",
    "who_code", "nfc_code", "chc_nec_code", "usc_code", "manufacturer_id", "manufacturer",
    "corporation", "daily_dosage_quantity", "is_imported", "generic_product_description",
    "channel", "chc_flag",
)

# Product columns typed DATE; every other product column is text.
PRODUCT_DATE_COLUMNS = (
    "effective_date", "end_date", "approved_date", "marketing_start_date", "marketing_end_date",
    "expiration_date",
)

PRODUCT_KEY = ("geographic_id", "dataset_id", "source_dataset_id", "dataset_product_id")

# Product hash diff, standard order (market, catalogue, legacy market/catalogue sources).
PRODUCT_DIFF = (
    "geographic_id", "dataset_id", "source_dataset_id", "product_type_code", "dataset_product_id",
    "product_name", "standardized_product_name", "description", "product_status_code",
    "generic_names", "effective_date", "end_date", "brand_name", "approved_date",
    "marketing_start_date", "marketing_end_date", "expiration_date", "substance", "dose_form_code",
    "strength", "route_of_administration_code", "pharmaceutical_product_quantity",
    "unit_of_presentation_code", "primary_package_quantity", "primary_package_type_code",
    "secondary_package_quantity", "secondary_package_type_code", "package_quantity",
    "shelf_life_quantity", "shelf_life_unit_of_measure_code", "sample_indicator",
    "competitor_indicator", "generic_indicator", "prescription_required_indicator", "atc_code",
    "who_code", "nfc_code", "chc_nec_code", "usc_code", "manufacturer_id",
    "daily_dosage_quantity", "corporation", "manufacturer", "is_imported",
    "generic_product_description", "channel", "chc_flag",
)

# CRM variant: standardized_product_name is not part of the diff.
PRODUCT_DIFF_CRM = tuple(c for c in PRODUCT_DIFF if c != "standardized_product_name")

# Legacy product-history variant: generic_names comes right after brand_name.
PRODUCT_DIFF_LEGACY = (
    "geographic_id", "dataset_id", "source_dataset_id", "product_type_code", "dataset_product_id",
    "product_name", "standardized_product_name", "description", "product_status_code",
    "effective_date", "end_date", "brand_name", "generic_names", "approved_date",
    "marketing_start_date", "marketing_end_date", "expiration_date", "substance", "dose_form_code",
    "strength", "route_of_administration_code", "pharmaceutical_product_quantity",
    "unit_of_presentation_code", "primary_package_quantity", "primary_package_type_code",
    "secondary_package_quantity", "secondary_package_type_code", "package_quantity",
    "shelf_life_quantity", "shelf_life_unit_of_measure_code", "sample_indicator",
    "competitor_indicator", "generic_indicator", "prescription_required_indicator", "atc_code",
    "who_code", "nfc_code", "chc_nec_code", "usc_code", "manufacturer_id",
    "daily_dosage_quantity", "corporation", "manufacturer", "is_imported",
    "generic_product_description", "channel", "chc_flag",
)

IDENTIFIER_COLUMNS = (
    "geographic_id", "dataset_id", "dataset_product_id", "identifier_type_code", "identifier_id",
    "status_code", "effective_date", "end_date",
)
IDENTIFIER_KEY = ("geographic_id", "dataset_id", "dataset_product_id", "identifier_id")
IDENTIFIER_DIFF = IDENTIFIER_COLUMNS

RELATIONSHIP_COLUMNS = (
    "parent_geographic_id", "child_geographic_id", "parent_dataset_id", "child_dataset_id",
    "parent_dataset_product_id", "child_dataset_product_id", "relationship_type_code",
    "status_code", "effective_date", "end_date",
)
RELATIONSHIP_KEY = (
    "parent_geographic_id", "child_geographic_id", "parent_dataset_product_id",
    "child_dataset_product_id",
)
RELATIONSHIP_DIFF = RELATIONSHIP_COLUMNS

# Metadata every staging frame carries after its business columns.
STAGING_META = ("source_lastmodifieddate", "hashkey", "hashdiff", "load_datetime", "etl_batch_id", "record_source")

# Vault table layouts.
HUB_COLUMNS = ("hashkey", "start_datetime", "load_datetime", "record_source", "etl_batch_id", "origin_stg")
SAT_META = (
    "hashkey", "hashdiff", "start_datetime", "load_datetime", "end_datetime", "updated_datetime",
    "etl_batch_id", "record_source",
)
REJECT_COLUMNS = (
    "reject_key", "dataset_product_id", "source_country_code", "dataset_id", "source_dataset_id",
    "error_level", "error_code", "error_message", "load_datetime", "source_lastmodifieddate",
    "hashkey", "hashdiff", "etl_batch_id", "record_source", "reject_source_model", "rejected_record",
)
PROCESS_LOG_COLUMNS = (
    "etl_batch_id", "layer_name", "model_name", "source_system", "process_status",
    "start_timestamp", "end_timestamp", "rows_processed", "error_message",
    "delta_inserted_rows", "delta_updated_rows",
)
BATCH_CONTROL_COLUMNS = (
    "etl_batch_id", "pipeline_name", "total_rejected_records", "start_timestamp",
    "end_timestamp", "process_status", "error_message",
)
WATERMARK_COLUMNS = (
    "source_system", "source_object", "watermark_column", "watermark_value", "updated_at",
    "etl_batch_id",
)

# Load defaults.
DEFAULT_LOOKBACK_MINUTES = 5
WATERMARK_FLOOR = "1900-01-01 00:00:00"
DEFAULT_RECORD_SOURCE_MAX_LEN = 255


@dataclass(frozen=True)
class EntitySpec:
    """What distinguishes the product, identifier and relationship loads."""

    name: str                       # process-log model name, e.g. SAT_PRODUCT
    origin: str                     # hub ORIGIN_STG constant
    columns: tuple[str, ...]        # business columns of staging, satellite and mart
    key_cols: tuple[str, ...]       # hash key ingredients, in order
    diff_cols: tuple[str, ...]      # hash diff ingredients, in order
    required_cols: tuple[str, ...]  # DQ: not NULL and not blank
    reject_id_cols: tuple[str, ...]  # ids that must not be in the reject set
    date_cols: tuple[str, ...] = ()
    dedupe: bool = True             # one row per hash key before the merge (latest load, highest diff)

    def with_diff(self, diff_cols: tuple[str, ...]) -> "EntitySpec":
        return replace(self, diff_cols=diff_cols)

    def optional(self, *cols: str) -> "EntitySpec":
        """Same spec with ``cols`` no longer required (e.g. a parent id that may be missing)."""
        return replace(self, required_cols=tuple(c for c in self.required_cols if c not in cols))


PRODUCT = EntitySpec(
    name="SAT_PRODUCT",
    origin="PRODUCT",
    columns=PRODUCT_COLUMNS,
    key_cols=PRODUCT_KEY,
    diff_cols=PRODUCT_DIFF,
    required_cols=("geographic_id", "product_name", "dataset_product_id"),
    reject_id_cols=("dataset_product_id",),
    date_cols=PRODUCT_DATE_COLUMNS,
)

IDENTIFIER = EntitySpec(
    name="SAT_IDENTIFIER",
    origin="IDENTIFIER",
    columns=IDENTIFIER_COLUMNS,
    key_cols=IDENTIFIER_KEY,
    diff_cols=IDENTIFIER_DIFF,
    required_cols=("geographic_id", "dataset_product_id", "identifier_id"),
    reject_id_cols=("dataset_product_id",),
    date_cols=("effective_date", "end_date"),
)

RELATIONSHIP = EntitySpec(
    name="SAT_RELATIONSHIP",
    origin="RELATIONSHIP",
    columns=RELATIONSHIP_COLUMNS,
    key_cols=RELATIONSHIP_KEY,
    diff_cols=RELATIONSHIP_DIFF,
    required_cols=(
        "parent_geographic_id", "child_geographic_id", "parent_dataset_product_id",
        "child_dataset_product_id",
    ),
    reject_id_cols=("parent_dataset_product_id", "child_dataset_product_id"),
    date_cols=("effective_date", "end_date"),
)


@dataclass(frozen=True)
class LoadContext:
    """Run-time inputs of one load: one fixed run time per load keeps every output repeatable."""

    batch_id: str
    run_ts: _dt.datetime
    record_source: str
    source_system: str | None = None
    source_object: str = "STG"
    watermark_column: str = "source_lastmodifieddate"
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES
    use_watermark: bool = True
    record_source_max_len: int = DEFAULT_RECORD_SOURCE_MAX_LEN
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def system(self) -> str:
        return (self.source_system or self.record_source).strip().upper()

    @property
    def object_name(self) -> str:
        return self.source_object.strip().upper()

    @property
    def watermark_name(self) -> str:
        return self.watermark_column.upper()

    def ts(self) -> Column:
        """The run time as a timestamp_ntz literal (UTC wall clock)."""
        return F.lit(self.run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    def batch(self) -> Column:
        return F.lit(self.batch_id)
