"""CRM staging: products, identifiers and relationships from the four regional product tables.

Tables: ``crm_product_<region>`` for each region in ``CRM_REGIONS`` and ``dim_country``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultkit.functions.dates import latest_of
from vaultkit.functions.predicates import is_empty_or_null, like_escaped, like_none, present
from vaultkit.functions.text import clean_name, upper_trim
from vaultkit.operators.dedupe import latest_by, lookup_parent, union_all
from vaultkit.operators.labels import label_rows
from vaultkit.operators.quality import keep_known_countries
from vaultkit.plans import constants as K
from vaultkit.plans.common import finish
from vaultkit.session import materialize
from vaultkit.spec import IDENTIFIER, PRODUCT, PRODUCT_DIFF_CRM, RELATIONSHIP, LoadContext

SOURCE_COLS = (
    "country_code_bi__c", "id", "name", "description_vod__c", "external_id_vod__c", "product_type_vod__c",
    "active_bi__c", "therapeutic_area_vod__c", "mdm_product_type_bi__c", "isdeleted", "parent_product_vod__c",
)


REGION = "__region"


def region_table(tables: Mapping[str, DataFrame], region: str) -> DataFrame:
    return tables[f"crm_product_{region}"]


def all_regions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The regional tables as one frame tagged with the region (parents are looked up per region)."""
    return union_all(
        region_table(tables, r).select(*SOURCE_COLS, "lastmodifieddate").withColumn(REGION, F.lit(r)) for r in K.CRM_REGIONS
    )


def with_parents(tables: Mapping[str, DataFrame], latest: bool, cols: list[str]) -> DataFrame:
    """Each row with its parent's columns from the same region: one self-join on (region, id).

    ``latest``: the parent is the latest row of that id; otherwise every row of that id joins.
    The rows are needed as children, as parents and as rows without a parent, so they are landed first:
    each regional table is read once, whatever stands behind it.
    """
    rows = materialize(all_regions(tables), "crm-regions")
    order = ["lastmodifieddate", "name"] if latest else None
    found = lookup_parent(rows.where("parent_product_vod__c IS NOT NULL"), rows.select(REGION, "id", "name", "lastmodifieddate"),
                          [REGION, "parent_product_vod__c"], [REGION, "id"], cols, latest_order=order)
    # Rows without a parent need no lookup; in the join they would all hash to one place per region.
    alone = rows.where("parent_product_vod__c IS NULL")
    alone = alone.select("*", *[F.lit(None).cast(alone.schema[c].dataType).alias(f"parent_{c}") for c in cols])
    return found.unionByName(alone).drop(REGION)


# --- label rules -------------------------------------------------------------------------------

def _u(c: str) -> Column:
    return F.upper(F.col(c))


def brand_rule(with_exclusions: bool = True) -> Column:
    rule = (
        (_u("product_type_vod__c") == "DETAIL")
        & (_u("mdm_product_type_bi__c").isin(*K.BRAND_MDM_TYPES) | like_escaped("external_id_vod__c", K.BRAND_EXTERNAL_ID))
    )
    if with_exclusions:
        rule = rule & ~_u("mdm_product_type_bi__c").isin(*K.NOT_BRAND_MDM_TYPES) & ~_u("name").isin(*K.THERAPY_AREAS)
    return rule


def indication_rule() -> Column:
    no_mdm = is_empty_or_null("mdm_product_type_bi__c")
    return (
        (_u("mdm_product_type_bi__c") == "INDICATION")
        | ((_u("product_type_vod__c") == "DETAIL") & no_mdm & (F.col("country_code_bi__c") == "GB")
           & like_escaped("external_id_vod__c", K.GB_INDICATION_EXTERNAL_ID))
        | (is_empty_or_null(_u("product_type_vod__c")) & no_mdm
           & F.col("external_id_vod__c").like(K.CODE_INDICATION_EXTERNAL_ID))
    )


def pmp_rule() -> Column:
    brc = _u("product_type_vod__c") == "BRC"
    return (
        _u("product_type_vod__c").isin(*K.PMP_PRODUCT_TYPES)
        | (brc & (F.col("country_code_bi__c") != "CH"))
        | (brc & (F.col("country_code_bi__c") == "CH") & F.col("external_id_vod__c").like("%SAMPLE%"))
    )


def ta_rule() -> Column:
    return (_u("mdm_product_type_bi__c") == "MEDICAL SEGMENT") | _u("name").isin(*K.THERAPY_AREAS)


def label_rules(brand_exclusions: bool = True) -> list[tuple[str, Column]]:
    live = F.col("isdeleted") == F.lit(False)
    return [
        (K.BRAND, live & brand_rule(brand_exclusions)),
        (K.IND, live & indication_rule()),
        (K.PMP, live & pmp_rule()),
        (K.TA, live & ta_rule()),
    ]


def usable(df: DataFrame, countries: DataFrame) -> DataFrame:
    """Country, id and name present; name not on the deny-list; country known."""
    out = df.where(present("country_code_bi__c") & present("id") & present("name")
                   & like_none(upper_trim("name"), K.NAME_DENY_PATTERNS))
    return keep_known_countries(out, countries, "country_code_bi__c")


# --- products (J1) -----------------------------------------------------------------------------

def crm_products(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    """Product staging: raw parent lookup per region, distinct union, labels, filters, N() names."""
    union = with_parents(tables, False, ["name"]).distinct()
    labelled = label_rows(union, label_rules(True), "product_type_code", distinct=False)   # the rows are distinct already
    kept = usable(labelled, tables["dim_country"])
    label = F.col("product_type_code")
    rows = kept.select(
        upper_trim("country_code_bi__c").alias("geographic_id"),
        F.lit(K.CRM_DATASET).alias("dataset_id"),
        F.lit(K.CRM_SOURCE).alias("source_dataset_id"),
        F.col("id").alias("dataset_product_id"),
        label.alias("product_type_code"),
        clean_name("name").alias("product_name"),
        clean_name("name").alias("standardized_product_name"),
        clean_name(F.coalesce(F.col("description_vod__c"), F.col("name"))).alias("description"),
        F.when(label == K.PMP, clean_name("parent_name")).when(label == K.BRAND, clean_name("name")).alias("brand_name"),
        F.lit("N").alias("competitor_indicator"),
        F.col("lastmodifieddate").cast("timestamp_ntz").alias("source_lastmodifieddate"),
    )
    return finish(rows, PRODUCT, ctx, K.CRM_SOURCE, PRODUCT_DIFF_CRM, collapse_versions=True)


# --- identifiers (J5) --------------------------------------------------------------------------

def _latest_parent_regions(tables: Mapping[str, DataFrame], with_dates: bool) -> DataFrame:
    return with_parents(tables, True, ["name", "lastmodifieddate"] if with_dates else ["name"])


def crm_identifiers(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    """Identifier staging: latest parent per region, labels and filters as products, one row per
    (country, product, identifier) with the latest modification time."""
    labelled = label_rows(_latest_parent_regions(tables, False), label_rules(True), "product_type_code", distinct=True)
    kept = usable(labelled, tables["dim_country"])
    geo = upper_trim("country_code_bi__c")
    rows = kept.select(
        geo.alias("geographic_id"),
        F.lit(K.CRM_SOURCE).alias("dataset_id"),
        F.trim("id").alias("dataset_product_id"),
        F.lit(K.CRM_SOURCE).alias("identifier_type_code"),
        F.concat(geo, F.lit("_"), F.trim("id")).alias("identifier_id"),
        F.lit(None).cast("string").alias("status_code"),
        F.lit(None).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.col("lastmodifieddate").cast("timestamp_ntz").alias("source_lastmodifieddate"),
    ).distinct()
    one = latest_by(rows, ["geographic_id", "dataset_product_id", "identifier_id"], ["source_lastmodifieddate"])
    return finish(one, IDENTIFIER, ctx, K.CRM_SOURCE)


# --- relationships (J8) ------------------------------------------------------------------------

def node_rows(filtered: DataFrame) -> DataFrame:
    """(country, id, parent) with the latest modification time per node set it belongs to, or NULL.

    One grouped pass computes every set (partial aggregation map-side).
    """
    mod = latest_of(["parent_lastmodifieddate_src", "child_lastmodifieddate"])
    live = F.col("isdeleted") == F.lit(False)
    mdm = _u("mdm_product_type_bi__c")
    flags = {
        "global": mdm == "GLOBAL BRAND",
        "local": mdm == "LOCAL BRAND",
        "brand": mdm.isin(*K.BRAND_MDM_TYPES),
        "pmp": F.col("product_type_code") == K.PMP,
        "ta": live & ta_rule(),
        "ind": live & indication_rule(),
    }
    base = filtered.select(
        upper_trim("country_code_bi__c").alias("geographic_id"),
        F.col("id").alias("dataset_product_id"),
        F.col("parent_product_vod__c").alias("parent_product_id"),
        *[F.when(pred, mod).alias(name) for name, pred in flags.items()],
    )
    grouped = base.groupBy("geographic_id", "dataset_product_id", "parent_product_id").agg(
        *[F.max(name).alias(name) for name in flags]
    )
    return grouped


# Edge type -> node set of the child, node set of the parent, whether the parent set is kept per
# (country, id) only; the others are kept per (country, id, parent).
EDGES = {
    K.GLOBAL_ROLLUP: ("local", "global", True),
    K.PMP_TO_BRAND: ("pmp", "brand", False),
    K.BRAND_TO_TA: ("brand", "ta", True),
    K.BRANDIND_TO_BRAND: ("ind", "brand", False),
}


def _ends(nodes: DataFrame, end: int) -> DataFrame:
    """The child (0) or parent (1) ends of all edge types, one row per node and type."""
    kinds = F.array(*[F.when(F.col(sets[end]).isNotNull(), F.struct(F.lit(kind).alias("kind"), F.col(sets[end]).alias("modified")))
                      for kind, sets in EDGES.items()])
    rows = nodes.select("geographic_id", "dataset_product_id", "parent_product_id",
                        F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("e"))
    return rows.select("geographic_id", "dataset_product_id", "parent_product_id", "e.*")


def edge_rows(nodes: DataFrame) -> DataFrame:
    """All edges in one join on (edge type, child.parent = parent.id), so the nodes are read twice only."""
    rolled = [kind for kind, sets in EDGES.items() if sets[2]]
    parents = _ends(nodes, 1)
    own = F.when(~F.col("kind").isin(*rolled), F.col("parent_product_id"))
    p = parents.groupBy("kind", "geographic_id", "dataset_product_id", own.alias("own")).agg(F.max("modified").alias("modified")).alias("p")
    c = _ends(nodes, 0).alias("c")
    return c.join(p, (F.col("c.kind") == F.col("p.kind")) & (F.col("c.parent_product_id") == F.col("p.dataset_product_id"))).select(
        F.col("p.geographic_id").alias("parent_geographic_id"),
        F.col("c.geographic_id").alias("child_geographic_id"),
        F.lit(K.CRM_SOURCE).alias("parent_dataset_id"),
        F.lit(K.CRM_SOURCE).alias("child_dataset_id"),
        F.col("p.dataset_product_id").alias("parent_dataset_product_id"),
        F.col("c.dataset_product_id").alias("child_dataset_product_id"),
        F.col("c.kind").alias("relationship_type_code"),
        F.lit(None).cast("string").alias("status_code"),
        F.lit(None).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.greatest(F.col("p.modified"), F.col("c.modified")).alias("source_lastmodifieddate"),
    ).distinct()


def crm_relationships(tables: Mapping[str, DataFrame], ctx: LoadContext) -> DataFrame:
    """Relationship staging: node sets joined child.parent = parent.id (id only, any country).

    The node set feeds both ends of the edges, so it is landed once."""
    src = _latest_parent_regions(tables, True).withColumnsRenamed(
        {"lastmodifieddate": "child_lastmodifieddate", "parent_lastmodifieddate": "parent_lastmodifieddate_src"})
    labelled = label_rows(src, label_rules(False), "product_type_code", distinct=True)
    edges = edge_rows(materialize(node_rows(usable(labelled, tables["dim_country"])), "crm-nodes"))
    return finish(edges, RELATIONSHIP, ctx, K.CRM_SOURCE)
