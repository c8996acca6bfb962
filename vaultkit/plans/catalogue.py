"""Catalogue staging: one public catalogue table of product codes (``catalogue_claves``)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.predicates import not_placeholder, present
from vaultkit.functions.text import upper_trim
from vaultkit.plans import constants as K
from vaultkit.plans.common import finish
from vaultkit.spec import IDENTIFIER, PRODUCT, RELATIONSHIP, LoadContext


def usable_codes(tables: Mapping[str, DataFrame]) -> DataFrame:
    c = tables["catalogue_claves"]
    return c.where(present("clave") & not_placeholder("nombre") & not_placeholder("forma_farma")
                   & not_placeholder("concentracion"))


def catalogue_products(tables: Mapping[str, DataFrame], ctx: LoadContext, strict_nulls: bool = False) -> DataFrame:
    """Product staging: name = the four text columns joined by blanks ('-' presentation dropped).

    ``strict_nulls=True`` makes a missing presentation blank out the whole name (as a NULL-
    propagating concatenation does), which then fails the product-name rule downstream.
    """
    c = usable_codes(tables).select(*[F.trim(x).alias(x) for x in ("clave", "nombre", "forma_farma", "concentracion", "presentacion")])
    parts = [F.col("nombre"), F.col("forma_farma"), F.col("concentracion"), F.nullif(F.col("presentacion"), F.lit("-"))]
    joined = F.concat_ws(" ", *parts)
    if strict_nulls:
        any_null = reduce(lambda a, b: a | b, [p.isNull() for p in parts])
        joined = F.when(any_null, F.lit(None).cast("string")).otherwise(joined)
    name = F.upper(F.trim(joined))
    rows = c.select(
        F.lit(K.CATALOGUE_COUNTRY).alias("geographic_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("dataset_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("source_dataset_id"),
        upper_trim("clave").alias("dataset_product_id"),
        F.lit(K.PMP).alias("product_type_code"),
        name.alias("product_name"), name.alias("description"),
        F.lit(K.STATUS_ACTIVE).alias("product_status_code"),
        upper_trim("nombre").alias("substance"),
        ctx.ts().alias("source_lastmodifieddate"),
    )
    return finish(rows, PRODUCT, ctx, K.CATALOGUE_SOURCE)


def catalogue_identifiers(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    c = usable_codes(tables)
    rows = c.select(
        F.lit(K.CATALOGUE_COUNTRY).alias("geographic_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("dataset_id"),
        upper_trim("clave").alias("dataset_product_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("identifier_type_code"),
        F.concat(F.lit(K.CATALOGUE_COUNTRY + "_"), upper_trim("clave")).alias("identifier_id"),
        ctx.ts().alias("source_lastmodifieddate"),
    )
    return finish(rows, IDENTIFIER, ctx, K.CATALOGUE_SOURCE)


def catalogue_relationships(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    """Codes as PMP children of an unknown brand (parent id NULL; load with the parent id optional)."""
    c = tables["catalogue_claves"].where(present("clave") & present("nombre"))
    rows = c.select(
        F.lit(K.CATALOGUE_COUNTRY).alias("parent_geographic_id"),
        F.lit(K.CATALOGUE_COUNTRY).alias("child_geographic_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("parent_dataset_id"),
        F.lit(K.CATALOGUE_SOURCE).alias("child_dataset_id"),
        F.lit(None).cast("string").alias("parent_dataset_product_id"),
        upper_trim("clave").alias("child_dataset_product_id"),
        F.lit(K.PMP_TO_BRAND).alias("relationship_type_code"),
        ctx.ts().alias("source_lastmodifieddate"),
    )
    return finish(rows, RELATIONSHIP, ctx, K.CATALOGUE_SOURCE)
