"""Identity of a listing: its id, else its URL, else a hash of its content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def identity() -> dict[str, Column]:
    """dedup_key and dedup_method over canonical columns; a key that came with the row stays."""
    source = F.coalesce(_s("source"), F.lit("unknown_source"))
    by_id = F.concat_ws("::", source, F.nullif(F.trim(_s("listing_id")), F.lit("")))
    has_id = F.length(F.trim(_s("listing_id"))) > 0
    has_url = F.length(F.trim(_s("listing_url"))) > 0
    url = F.regexp_replace(F.lower(F.regexp_extract(_s("listing_url"), r"^[^?#]+", 0)), "/+$", "")
    content = F.concat_ws("||", source, *(F.coalesce(x, F.lit("")) for x in (F.lower(F.trim(_s("title_raw"))), F.lower(F.trim(_s("district_norm"))), _s("area_m2"), _s("price_vnd"))))
    made = F.when(has_id, by_id).when(has_url, F.concat_ws("::", source, url)).otherwise(F.concat_ws("::", source, F.sha2(content, 256)))
    how = F.when(has_id, "listing_id").when(has_url, "listing_url").otherwise("content_hash")
    given, named = blank_to_null(F.trim(_s("dedup_key"))), blank_to_null(F.trim(_s("dedup_method")))
    method = F.coalesce(named, F.when(given.isNotNull(), "preexisting").otherwise(how))
    return {"dedup_key": F.coalesce(given, made), "dedup_method": method}


def api_key(source: Column, listing_id: Column, url: Column) -> Column:
    """The key of an API row: by id, else by URL up to its `?`, else null."""
    some = F.when(F.trim(listing_id) != "", F.concat_ws("::", source, F.trim(listing_id)))
    return F.coalesce(some, F.when(F.trim(url) != "", F.concat_ws("::", source, F.substring_index(F.trim(url), "?", 1))))
