"""Deterministic identities: canonical JSON, digests and canonical addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track visitors.
TRACKING = r"^(utm_.*|gclid|fbclid|msclkid|mc_cid|mc_eid)$"


def canonical_json(**fields: Column) -> Column:
    """JSON with the fields in order of their names, nulls included, without spaces."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def digest(**fields: Column) -> Column:
    return F.sha2(canonical_json(**fields), 256)


def stable_id(prefix: str, **fields: Column) -> Column:
    """The prefix and 32 hex digits that depend on the fields alone."""
    return F.concat(F.lit(prefix), F.substring(digest(**fields), 1, 32))


def decimal_text(x: Column) -> Column:
    """A decimal without trailing zeros."""
    text = x.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _encoded(x: Column) -> Column:
    """A decoded part of a query as forms encode it: spaces as plus signs, all but letters, digits and _.-~ in per cent."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(x: Column) -> Column:
    """Lower-case scheme and host, no fragment, no slash at the end but of the root, no tracking parameters, and the other
    parameters encoded anew in their order. Null for what isn't an absolute http or https address."""
    bare = F.regexp_replace(F.trim(x), r"(?s)#.*$", "")
    site = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]+)", 1))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)", 1), "/+$", "")
    parts = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: p != "")
    decoded = lambda p: F.coalesce(F.try_url_decode(p), p)
    pairs = F.transform(parts, lambda p: F.struct(decoded(F.split(p, "=", 2)[0]).alias("k"), decoded(F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit(""))).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).rlike(TRACKING))
    asked = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    whole = F.concat(site, F.when(path == "", "/").otherwise(path), F.when(asked == "", "").otherwise(F.concat(F.lit("?"), asked)))
    return F.when(site.rlike("^https?://"), whole)
