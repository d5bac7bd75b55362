"""Typed run settings, read from key=value arguments."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Iterable

REPORT_ZONE = "America/New_York"  # fixed value: zone of all local times


@dataclasses.dataclass(frozen=True)
class RunConfig:
    """Paths, dates and switches of one run; from arguments, `run_date` defaults to yesterday (UTC).

    `landed` builds silver from the table the ingest wrote instead of the raw files: from the
    state of the load before the run date and the arrivals it has not read, or with `rebuild` from
    all arrivals; `buckets` is the number of parts that silver is kept in by key, about one per gigabyte; `dedupe_memory`, `max_file_age` and `max_batch_bytes` are settings of the ingest;
    `incremental` moves the counts of gold on by what a load changed, instead of counting all events;
    `active_only` leaves canceled bookings out of gold; `spend_from` and `spend_to` widen the
    spend beyond the run date; `by_day` picks the older summary; `input_gb` sizes shuffles.
    """

    run_date: str
    webhooks_path: str = "bronze/webhooks"
    spend_path: str = "bronze/marketing_spend"
    flat_events_path: str = "bronze/events"
    landed_path: str = "bronze/landed"
    vendor_spend_path: str = "bronze/vendor_spend"
    vendor_landed_path: str = "bronze/vendor_landed"
    vendor_totals_path: str = "quality_vendor_totals"
    judged_path: str = "bronze/judged"
    silver_vendor_path: str = "silver/vendor_spend"
    silver_events_path: str = "silver/events"
    silver_spend_path: str = "silver/marketing_spend"
    flat_silver_path: str = "silver/flat_events"
    flat_gold_path: str = "gold/flat_events"
    gold_path: str = "gold"
    gold_state_path: str = "gold_state"
    metrics_path: str = "quality_metrics"
    checkpoint_path: str = "checkpoints/landed"
    database: str = "bookings"
    zone: str = REPORT_ZONE
    fmt: str = "parquet"
    multiline: bool = True
    spend_from: str = ""
    spend_to: str = ""
    backfill_path: str = "silver/events_copy"
    backfill_fmt: str = "orc"
    landed: bool = False
    active_only: bool = False
    rebuild: bool = False
    buckets: int = 1
    incremental: bool = False
    dedupe_memory: str = "7 days"
    max_file_age: str = "36500d"
    max_batch_bytes: int = 1 << 36
    by_day: bool = True
    input_gb: int = 0

    def __post_init__(self):
        dt.date.fromisoformat(self.run_date)
        if not 1 <= self.buckets <= 99999:
            raise ValueError(f"buckets: expected 1 to 99999, got {self.buckets}")

    @classmethod
    def from_args(cls, args: Iterable[str]) -> RunConfig:
        known = {f.name: f for f in dataclasses.fields(cls)}
        values: dict[str, object] = {}
        for arg in args:
            key, eq, text = arg.partition("=")
            key = key.lstrip("-")
            if not eq or key not in known:
                raise ValueError(f"unknown setting: {arg!r}")
            values[key] = _PARSERS[known[key].type](text)
        values.setdefault("run_date", _yesterday())
        return cls(**values)


def _yesterday() -> str:
    return (dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)).isoformat()


def _as_bool(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise ValueError(f"expected true or false, got {text!r}")
    return text.lower() == "true"


_PARSERS = {"str": str, "int": int, "bool": _as_bool}
