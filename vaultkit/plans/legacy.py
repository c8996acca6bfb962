"""Legacy history staging: product, identifier and relationship snapshots kept as text tables.

Three product variants (``legacy`` / ``market`` / ``catalogue``) differ in casing, date typing and
the hash-diff order; see each function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.dates import try_date
from vaultkit.functions.predicates import not_placeholder, present
from vaultkit.functions.text import upper_trim
from vaultkit.plans import constants as K
from vaultkit.plans.common import finish
from vaultkit.spec import IDENTIFIER, PRODUCT, PRODUCT_DATE_COLUMNS, PRODUCT_DIFF_LEGACY, RELATIONSHIP, LoadContext

# Product columns a legacy history table does not carry (NULL in staging).
LEGACY_NULL_COLUMNS = (
    "who_code", "nfc_code", "chc_nec_code", "usc_code", "manufacturer", "corporation",
    "daily_dosage_quantity", "is_imported", "generic_product_description", "channel", "chc_flag",
)
INDICATORS = ("competitor_indicator", "generic_indicator", "prescription_required_indicator")
QUANTITIES = ("pharmaceutical_product_quantity", "primary_package_quantity", "secondary_package_quantity",
              "package_quantity", "shelf_life_quantity")


def _product_cols(variant: str) -> list:
    out = []
    for c in PRODUCT.columns:
        if c in LEGACY_NULL_COLUMNS:
            continue
        if c in PRODUCT_DATE_COLUMNS:
            e = F.col(c).cast("date") if variant == "catalogue" else try_date(c)
        elif variant == "market" and c in ("geographic_id", "dataset_product_id", *INDICATORS):
            e = upper_trim(c)
        elif variant == "legacy" and c == "competitor_indicator":
            e = F.col(c).cast("string")
        elif variant == "catalogue" and c == "product_status_code":
            e = F.lit(K.STATUS_ACTIVE)
        elif variant == "catalogue" and c == "substance":
            e = F.trim(F.coalesce(F.col("substance"), F.col("brand_name")))
        elif variant == "catalogue" and c in QUANTITIES:
            e = F.col(c).cast("string")
        else:
            e = F.trim(c)
        out.append(e.alias(c))
    return out


def legacy_products(table: DataFrame, ctx: LoadContext, variant: str = "legacy") -> DataFrame:
    """variant ``legacy``: id and name ('-' counts as missing) required, diff order with generic
    names after brand name. ``market``: upper-cased country/id/indicators, only the id required.
    ``catalogue``: status forced 'A', substance falls back to brand name, dates taken as stored."""
    if variant == "market":
        rows = table.where(present("dataset_product_id"))
    else:
        rows = table.where(present("dataset_product_id") & not_placeholder("product_name"))
    rows = rows.select(*_product_cols(variant), ctx.ts().alias("source_lastmodifieddate"))
    diff = PRODUCT_DIFF_LEGACY if variant == "legacy" else PRODUCT.diff_cols
    source = {"legacy": K.LEGACY_SOURCE, "market": K.MARKET_SOURCE, "catalogue": K.CATALOGUE_SOURCE}[variant]
    return finish(rows, PRODUCT, ctx, source, diff)


def legacy_identifiers(table: DataFrame, ctx: LoadContext, record_source: str = K.LEGACY_SOURCE) -> DataFrame:
    rows = table.where(present("dataset_product_id") & not_placeholder("identifier_id")).select(
        *[F.trim(c).alias(c) for c in ("geographic_id", "dataset_id", "dataset_product_id", "identifier_type_code",
                                       "identifier_id", "status_code")],
        try_date("effective_date").alias("effective_date"), try_date("end_date").alias("end_date"),
        ctx.ts().alias("source_lastmodifieddate"),
    )
    return finish(rows, IDENTIFIER, ctx, record_source)


def legacy_relationships(table: DataFrame, ctx: LoadContext, variant: str = "market") -> DataFrame:
    """variant ``market``: countries and parent id upper-cased, dates parsed from text.
    ``catalogue``: values only trimmed, dates as stored."""
    rows = table.where(present("parent_dataset_product_id") & present("child_dataset_product_id"))
    up = (lambda c: upper_trim(c)) if variant == "market" else (lambda c: F.trim(c))
    dates = (lambda c: try_date(c)) if variant == "market" else (lambda c: F.col(c).cast("date"))
    rows = rows.select(
        up("parent_geographic_id").alias("parent_geographic_id"),
        up("child_geographic_id").alias("child_geographic_id"),
        F.trim("parent_dataset_id").alias("parent_dataset_id"),
        F.trim("child_dataset_id").alias("child_dataset_id"),
        up("parent_dataset_product_id").alias("parent_dataset_product_id"),
        F.trim(F.col("child_dataset_product_id").cast("string")).alias("child_dataset_product_id"),
        F.trim("relationship_type_code").alias("relationship_type_code"),
        F.trim("status_code").alias("status_code"),
        dates("effective_date").alias("effective_date"), dates("end_date").alias("end_date"),
        ctx.ts().alias("source_lastmodifieddate"),
    )
    source = K.MARKET_SOURCE if variant == "market" else K.CATALOGUE_SOURCE
    return finish(rows, RELATIONSHIP, ctx, source)
