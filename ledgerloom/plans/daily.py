"""The daily run: load, gate, build, check, publish."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import checks as c
from ledgerloom.plans import products as p
from ledgerloom.plans import suites
from ledgerloom.plans.contracts import fact_contract
from ledgerloom.sources import layers, releases, statistics
from ledgerloom.sources.seeds import Seeds, built_in_seeds
from ledgerloom.sources.snapshots import (
    chosen_partition,
    conform_to_raw,
    extract_snapshot,
    load_date_before,
    newest_load_date,
    switch_partition,
    write_partition,
)

RAW_TABLE = "raw.products"
RAW_STATISTICS = "raw.products_statistics"
#: What is checked by product, and the column that holds its key.
BUCKET_KEYS = {"stg_products": "barcode", "dim_product": "product_key", "fct_nutrition": "product_key"}


@dataclass(frozen=True)
class Build:
    """What one build produced: the check results, paths of failing rows by check, the tables."""

    results: list
    audit: dict[str, str]
    tables: dict[str, DataFrame]


def load(
    spark: SparkSession,
    source: DataFrame,
    load_date: dt.date,
    loaded_at: dt.datetime,
    tag: str | None = "en:netherlands",
) -> None:
    """Replace one dated load of the raw table, and its statistics.

    The statistics are made from the written version and name that version.
    """
    layers.create_layers(spark)
    path = write_partition(extract_snapshot(source, load_date, tag, loaded_at), RAW_TABLE, load_date)
    rows = spark.read.schema(spark.table(RAW_TABLE).drop("load_date").schema).parquet(path)
    switch_partition(spark, RAW_TABLE, load_date, path)
    statistics.store(suites.raw_statistics(rows), RAW_STATISTICS, load_date, path)


def check_load(
    spark: SparkSession, load_date: dt.date, as_of: dt.datetime, **options
) -> list:
    """Stop unless the load passes all raw checks. Run again it gives the same answer."""
    stored = spark.table(RAW_TABLE)
    previous = load_date_before(spark, RAW_TABLE, load_date)
    n_before = statistics.stored_rows(spark, RAW_TABLE, RAW_STATISTICS, previous) if previous else None
    checks, tables = suites.raw_gate(
        conform_to_raw(stored), load_date, as_of, previous=previous, previous_rows=n_before, **options
    )
    # The conformed table has every column, so the stored one is asked for them.
    checks = [replace(k, table="stored") if isinstance(k, c.ColumnsCheck) else k for k in checks]
    tables["stored"] = stored
    results = c.evaluate(checks, tables).collect()  # one row per check
    c.gate(results)
    return results


def build(
    spark: SparkSession,
    root: str,
    as_of: dt.datetime,
    load_date: dt.date | None = None,
    seeds: Seeds | None = None,
) -> Build:
    """Build all models from one load, check them, publish the marts.

    Staged products and the marts are written once and read from there. The keys
    are computed anew for each mart: that costs less than writing the nested
    measures a second time. What is checked by product is written in buckets of the product's
    key, so that those checks shuffle nothing. All marts and the audit are one release, which
    readers see by one write, after every check ran; if one ended in an error, the audit alone is
    released.
    """
    layers.create_layers(spark)
    seeds = seeds or built_in_seeds(spark)
    load_date = load_date or newest_load_date(spark, RAW_TABLE)
    raw = conform_to_raw(spark.table(RAW_TABLE))
    # The partition column is a literal here, so only this load is scanned.
    one_load = chosen_partition(raw, load_date)

    written: dict[str, str] = {}
    try:
        return _build(spark, root, as_of, one_load, raw, seeds, written)
    finally:
        for name, path in written.items():
            layers.end_work(spark, name, path)


def _build(
    spark: SparkSession, root: str, as_of: dt.datetime, one_load: DataFrame, raw: DataFrame, seeds: Seeds,
    written: dict[str, str],
) -> Build:
    """Build, check and release; paths of keyed versions go to ``written``."""

    def write(df: DataFrame, layer: str, name: str) -> DataFrame:
        if name not in BUCKET_KEYS:
            table, paths[name] = layers.write_version(df, root, layer, name)
        else:
            table, paths[name] = layers.write_keyed_version(df, root, layer, name, BUCKET_KEYS[name])
            written[name] = paths[name]
        return table

    paths: dict[str, str] = {}
    staged = write(p.stg_products(one_load), "staging", "stg_products")
    keyed = p.products_with_keys(staged, seeds)
    marts = {
        "dim_category": p.dim_category(seeds),
        "dim_brand": p.dim_brand(staged),
        "dim_product": p.dim_product(keyed),
        "fct_nutrition": p.fct_nutrition(keyed, seeds),
    }
    contract = fact_contract()
    contract.require_layout(marts["fct_nutrition"])
    versions = {name: write(df, "marts", name) for name, df in marts.items()}

    tables = {
        # Freshness is that of the whole source, so an older load can be built again.
        "raw": chosen_partition(raw, newest_load_date(spark, RAW_TABLE)),
        "stg_products": staged,
        "stg_product_nutrients": p.stg_product_nutrients(staged),
        "rejected_amounts": p.rejected_amounts(staged),
        "int_products_categorised": p.int_products_categorised(staged, seeds),
        "category_taxonomy": seeds.category_taxonomy,
        "category_mapping": seeds.category_mapping,
        "nutrient_reference": seeds.nutrient_reference,
        **versions,
    }
    flagged = {**tables, "fct_nutrition": suites.with_mass_flag(tables["fct_nutrition"], seeds)}
    model_checks = suites.model_checks()
    other_checks = [suites.source_freshness(as_of), contract.age_check(as_of), *contract.checks()]
    # One row per check comes back.
    results = c.evaluate([*model_checks, *other_checks], flagged).collect()
    # The contract repeats rules of the models, so its failing rows are in the audit already.
    audit = c.write_audit(
        model_checks, flagged, results, lambda name: layers.new_version(root, "audit", name)
    )
    failing = {("audit", name): path for name, path in audit.items()}
    try:
        c.gate(results)
    except c.GateFailed:
        releases.release(spark, root, failing, whole_layers=("audit",))
        raise
    published = {("marts", name): paths[name] for name in versions}
    releases.release(spark, root, {**failing, **published}, whole_layers=("audit",))
    for name in ("stg_products", "stg_product_nutrients", "rejected_amounts", "int_products_categorised"):
        layers.save_view(tables[name], name)
    return Build(results, audit, tables)


def run(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    load_date: dt.date,
    loaded_at: dt.datetime,
    as_of: dt.datetime,
    **gate_options,
) -> Build:
    load(spark, source, load_date, loaded_at)
    check_load(spark, load_date, as_of, **gate_options)
    return build(spark, root, as_of, load_date)
