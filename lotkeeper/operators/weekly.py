"""A snapshot's way into the listing table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lotkeeper.operators.clean import clean_columns, clean_listings
from lotkeeper.operators.merge import upsert_listings
from lotkeeper.operators.schema import prepare_listings


def merge_snapshot(state: DataFrame, scanned: DataFrame, category: str, now: str,
                   preserve_status: bool = False) -> DataFrame:
    """Scanned snapshot rows (text, ``file``, ``present``, ``ingest_seq``) merged into the table.

    Rows are brought into shape and their columns cleaned, which types them, before they meet the
    state: a price of ``RM 3,500`` arrives as 3500.
    """
    typed = clean_columns(prepare_listings(scanned, category, now, "file"), category)
    return upsert_listings(state, typed, present="present", preserve_status=preserve_status)


def weekly_table(state: DataFrame, scanned: DataFrame, category: str, now: str) -> DataFrame:
    """The merged table without rows that lack an identity and without reposts."""
    return clean_listings(merge_snapshot(state, scanned, category, now), category, "ads_id")
