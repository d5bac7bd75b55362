"""Attribution of bookings and spend to a marketing channel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheduling-link id -> channel. A link id wins over the utm tag.
LINK_CHANNELS = {
    "d639ecd3-8718-4068-955a-436b10d72c78": "facebook",
    "dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098": "youtube",
    "bb339e98-7a67-4af2-b584-8dbf95564312": "tiktok",
}

# Ad-platform name in the spend files -> channel (matched case-sensitively).
SPEND_CHANNELS = {
    "facebook_paid_ads": "facebook",
    "youtube_paid_ads": "youtube",
    "tiktok_paid_ads": "tiktok",
}

UNKNOWN = "unknown"


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.create_map(*entries)[key]


def uri_tail(uri: Column) -> Column:
    """Text after the last slash; '' for a trailing slash, null for null."""
    return F.substring_index(uri, "/", -1)


def booking_channel(link_id: Column, utm_source: Column) -> Column:
    return F.coalesce(
        _lookup(LINK_CHANNELS, F.lower(link_id)), F.lower(utm_source), F.lit(UNKNOWN)
    )


def known_channel(channel: Column) -> Column:
    """Lower-cased channel with null shown as unknown."""
    return F.coalesce(F.lower(channel), F.lit(UNKNOWN))


def spend_channel(channel: Column) -> Column:
    """Channel a spend row belongs to; a null name stays null and matches no booking."""
    return F.coalesce(_lookup(SPEND_CHANNELS, channel), F.lower(channel))
