"""Locations: what evidence on them allows, what it proposes, and rows that name one they don't belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Levels at which a source may tell prices apart, and those that evidence may name; degrees of confidence.
LEVELS = ("city", "store", "online", "unknown")
NAMED = ("city", "store", "unknown")
CONFIDENCE = ("none", "weak", "strong")
SOURCE_KEY = r"^[A-Za-z][A-Za-z0-9_]*:[a-z0-9]+:sha256:[0-9a-f]{64}\z"


def _kind(body: Column, path: str) -> Column:
    """The type of what is at the path: STRING, BOOLEAN, VOID, ...; null where nothing is."""
    return F.schema_of_variant(F.try_variant_get(body, path, "variant"))


def _text(body: Column, path: str) -> Column:
    """The text at the path, null for anything else than text."""
    return F.when(_kind(body, path) == "STRING", F.try_variant_get(body, path, "string"))


def _is_false(body: Column, path: str) -> Column:
    return F.coalesce((_kind(body, path) == "BOOLEAN") & ~F.try_variant_get(body, path, "boolean"), F.lit(False))


def _none(body: Column, path: str) -> Column:
    return F.coalesce(_kind(body, path), F.lit("VOID")) == "VOID"


def transitions(artifacts: DataFrame, host: str, city: str) -> DataFrame:
    """What each sanitised artifact (location_id, body: JSON text) says of its location; it never enables reading.

    Returns location_id; status: city_binding_ready, store_binding_discovery_required, inconclusive or rejected; reason (the first
    rule that a rejected one breaks, else empty); granularity, confidence, source_location_key, selected_store (null where rejected);
    artifact_sha256 of the body with keys in order and without spaces, and evidence_ref (both null for what isn't a JSON object).
    Null and malformed bodies are rejected as `artifact_mapping_required`, repeated rows give repeated answers, other columns are ignored.
    """
    v, report = F.col("v"), "$.binding_report"
    parsed = artifacts.select("location_id", F.try_parse_json("body").alias("v"))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    rows = parsed.select(
        "location_id", "v", is_object.alias("is_object"), F.when(is_object, F.sha2(F.to_json(v), 256)).alias("artifact_sha256"),
        _text(v, f"{report}.granularity_candidate").alias("granularity"), _text(v, f"{report}.confidence").alias("confidence"),
        F.when(_kind(v, f"{report}.technical_binding_observed") == "BOOLEAN", F.try_variant_get(v, f"{report}.technical_binding_observed", "boolean")).alias("technical"),
        _text(v, f"{report}.source_location_key_candidate").alias("source_location_key"), _text(v, "$.selected_store").alias("selected_store"),
        F.when(_kind(v, "$.store_selection_observed") == "BOOLEAN", F.try_variant_get(v, "$.store_selection_observed", "boolean")).alias("selected"),
    )
    level, confidence, key, store = F.col("granularity"), F.col("confidence"), F.col("source_location_key"), F.col("selected_store")
    strong = F.coalesce((confidence == "strong") & F.col("technical") & key.isNotNull(), F.lit(False))
    equals = lambda path, wanted: F.coalesce(_text(v, path) == wanted, F.lit(False))
    rules: list[tuple[str, Column]] = [
        ("artifact_mapping_required", F.col("is_object")),
        ("live_evidence_required", equals("$.mode", "live")),
        ("successful_capture_required", _none(v, "$.stop_reason")),
        ("unexpected_target_host", equals("$.target_host", host)),
        ("unexpected_target_city", equals("$.target_city", city)),
        *((f"{c}_must_be_false", _is_false(v, f"$.{c}")) for c in ("production_authority", "catalog_accepted", "extraction_enabled")),
        ("binding_report_required", F.coalesce(_kind(v, report).startswith("OBJECT"), F.lit(False))),
        ("sanitized_binding_report_required", _is_false(v, f"{report}.raw_values_exposed")),
        ("granularity_candidate_invalid", F.coalesce(level.isin(*LEVELS), F.lit(False))),
        ("granularity_candidate_unsupported", level.isin(*NAMED)),
        ("binding_confidence_invalid", F.coalesce(confidence.isin(*CONFIDENCE), F.lit(False))),
        ("technical_binding_observed_invalid", F.col("technical").isNotNull()),
        ("source_location_key_candidate_invalid", _none(v, f"{report}.source_location_key_candidate") | F.coalesce(key.rlike(SOURCE_KEY), F.lit(False))),
        ("text_field_invalid", _none(v, "$.selected_store") | F.coalesce(store.rlike(r"^\S(?s:.*\S)?\z"), F.lit(False))),
        ("store_selection_observed_invalid", F.col("selected").isNotNull()),
        ("strong_store_binding_required", (level != "store") | strong),
        ("selected_store_evidence_required", (level != "store") | (F.col("selected") & store.isNotNull())),
        ("strong_city_binding_required", (level != "city") | strong),
        ("unknown_binding_must_remain_non_authoritative", (level != "unknown") | ~(F.col("technical") | key.isNotNull() | (confidence == "strong"))),
    ]
    broken = F.coalesce(*(F.when(~holds, name) for name, holds in rules), F.lit(""))
    judged = rows.withColumn("reason", broken)
    fine = F.col("reason") == ""
    status = F.when(~fine, "rejected").when(level == "city", "city_binding_ready").when(level == "store", "store_binding_discovery_required").otherwise("inconclusive")
    said = [F.when(fine, F.col(c)).alias(c) for c in ("granularity", "confidence", "source_location_key", "selected_store")]
    return judged.select("location_id", status.alias("status"), "reason", *said, "artifact_sha256", F.concat(F.lit("location_binding_radiography:sha256:"), "artifact_sha256").alias("evidence_ref"))


def proposed(locations: DataFrame, found: DataFrame) -> DataFrame:
    """The locations as ready transitions propose them, and `proposal`: what came of it.

    Args:
        locations: location_id (unique), granularity, technical_binding_confirmed, source_location_key, evidence, extraction_enabled; other
            columns pass.
        found: the rows of transitions().

    proposal is `proposed`, `none` (nothing ready), `enabled` (a location that is read already doesn't change) or `conflict` (ready artifacts
    name different keys). Of several artifacts with one key that with the least digest is the evidence. Nothing enables reading.
    """
    ready = found.filter("status = 'city_binding_ready'").groupBy("location_id").agg(
        F.min("source_location_key").alias("_least"), F.max("source_location_key").alias("_most"), F.min("evidence_ref").alias("_ref")
    )
    joined = locations.join(ready, "location_id", "left")
    proposal = F.when(F.col("_ref").isNull(), "none").when(F.col("_least") != F.col("_most"), "conflict").when(F.coalesce("extraction_enabled", F.lit(True)), "enabled").otherwise("proposed")
    new = {"granularity": F.lit("city"), "technical_binding_confirmed": F.lit(True), "source_location_key": F.col("_least"), "evidence": F.col("_ref")}
    marked = joined.withColumn("proposal", proposal)
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    kept = [F.when(F.col("proposal") == "proposed", new[c]).otherwise(F.col(c)).alias(c) if c in new else quoted(c) for c in locations.columns]
    return marked.select(*kept, "proposal")


def blocked(locations: DataFrame, markets: DataFrame) -> DataFrame:
    """The locations with `block`: the first reason not to read them, empty if there is none.

    locations: location_id, market_id, is_available, in_scope, granularity, technical_binding_confirmed, extraction_enabled; markets: market_id (unique),
    is_active, selection_mode. A null flag counts as false, an unknown market as not active.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    joined = locations.join(markets.select("market_id", F.col("is_active").alias("_active"), F.col("selection_mode").alias("_mode")), "market_id", "left")
    reason = (
        F.when(~yes("_active"), "supermarket_inactive")
        .when(~yes("is_available"), "location_unavailable")
        .when(~yes("in_scope"), "location_out_of_scope")
        .when(F.coalesce("granularity", F.lit("unknown")) == "unknown", "location_granularity_unconfirmed")
        .when((F.col("_mode") == "source_selection_required") & ~yes("technical_binding_confirmed"), "technical_location_binding_unconfirmed")
        .when(~yes("extraction_enabled"), "extraction_disabled")
        .otherwise("")
    )
    return joined.withColumn("block", reason).drop("_active", "_mode")


def placed(rows: DataFrame, locations: DataFrame, markets: DataFrame) -> DataFrame:
    """The rows (location_id, market_id, and others) with `fault`: unknown_location, unknown_market, other_market (the location belongs to
    another one) or empty. Null ids are unknown. Rows of a location that isn't read are fine: failed runs are recorded too."""
    homes = locations.select("location_id", F.col("market_id").alias("_home"), F.lit(True).alias("_located"))
    joined = rows.join(homes, "location_id", "left").join(markets.select("market_id", F.lit(True).alias("_known")), "market_id", "left")
    fault = F.when(F.col("_located").isNull(), "unknown_location").when(F.col("_known").isNull(), "unknown_market").when(~F.col("_home").eqNullSafe(F.col("market_id")), "other_market").otherwise("")
    return joined.withColumn("fault", fault).drop("_home", "_located", "_known")
