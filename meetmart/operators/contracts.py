"""Contract checks of landed JSON: each row gets the list of reasons it breaks its contract.

The body is parsed once into a variant; every rule is an expression on that variant, so missing
fields, wrong JSON types and unknown keys can be told apart, which a typed read would blur.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetmart.functions.landing import parsed_body
from meetmart.functions.measures import money_total
from meetmart.functions.timeparts import day, instant, is_date_time
from meetmart.operators.dedupe import keep_latest

REASONS = "reasons"
BRONZE, DEAD_LETTER = "bronze", "dead_letter"
SKEW_DAYS = 7  # fixed value: allowed distance of a record's times from its webhook
TOTALS_TOLERANCE = 0.02  # fixed value: allowed relative difference of spend totals


def _is_kind(found: Column, kind: str) -> Column:
    """Whether a described variant is of a JSON kind; plain comparisons, no patterns."""
    if kind in ("number", "integer"):
        return found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")
    if kind in ("object", "array"):
        return found.startswith(kind.upper())
    return found == kind.upper()


@dataclasses.dataclass(frozen=True)
class Field:
    path: str
    kind: str | Sequence[str] = "string"  # several kinds are alternatives
    required: bool = False
    nullable: bool = False
    one_of: Sequence[str] = ()
    form: str = ""  # "time" or "day"
    lengths: tuple[int | None, int | None] = (None, None)  # fewest and most characters
    only: Sequence[str] | None = None  # keys an object may have, if it is closed
    items: str = ""  # kind of the elements of an array
    limits: tuple[float | None, float | None] = (None, None)  # smallest and largest number
    pattern: str = ""  # found anywhere in the text
    at: str = ""  # path within the variant, if not `path` as it is

    @property
    def kinds(self) -> tuple[str, ...]:
        return (self.kind,) if isinstance(self.kind, str) else tuple(self.kind)

    def readings(self, body: Column) -> dict[str, Column]:
        """What the rules look at: JSON kind (null if absent) and, where needed, text and keys."""
        at = self.at or (f"$.{self.path}" if self.path else "$")
        kind = F.schema_of_variant(F.try_variant_get(body, at, "variant"))
        if "object" in self.kinds:
            # Casting to a struct of one field is the cheap way to tell an object: describing
            # a whole object costs as much as a dozen other readings.
            probe = F.try_variant_get(body, at, "struct<_:string>")
            kind = F.when(probe.isNotNull(), F.lit("OBJECT")).otherwise(kind)
        found = {"kind": kind}
        if self.one_of or self.form or self.pattern or self.lengths != (None, None):
            found["text"] = F.try_variant_get(body, at, "string")
        if "integer" in self.kinds or self.limits != (None, None):
            found["number"] = F.try_variant_get(body, at, "double")
        if self.only is not None:
            found["keys"] = F.map_keys(F.try_variant_get(body, at, "map<string,variant>"))
        if self.items:
            found["items"] = F.try_variant_get(body, at, "array<variant>")
        return found

    def reasons(self, found: dict[str, Column]) -> list[Column]:
        kind, text = found["kind"], found.get("text")
        fits = functools.reduce(Column.__or__, [_is_kind(kind, k) for k in self.kinds])
        if "integer" in self.kinds and "number" not in self.kinds:
            fits = fits & ~(_is_kind(kind, "number") & (F.floor(found["number"]) != found["number"]))
        is_text = kind == "STRING"
        rules: list[tuple[str, Column]] = []
        if self.required:
            rules.append(("missing", kind.isNull()))
        rules.append(("type", ~(fits | (kind == "VOID")) if self.nullable else ~fits))
        if self.one_of:
            rules.append(("value", is_text & ~text.isin(list(self.one_of))))
        if self.form:
            right = is_date_time(text) if self.form == "time" else day(text).isNotNull()
            rules.append(("format", is_text & ~right))
        if self.pattern:
            rules.append(("pattern", is_text & ~text.rlike(self.pattern)))
        if self.lengths != (None, None):
            rules.append(("length", is_text & _outside(F.char_length(text), self.lengths)))
        if self.limits != (None, None):
            rules.append(("range", _is_kind(kind, "number") & _outside(found["number"], self.limits)))
        if self.only is not None:
            allowed = F.array(*[F.lit(n) for n in self.only]).cast("array<string>")
            rules.append(("unknown_key", F.size(F.array_except(found["keys"], allowed)) > 0))
        if self.items:
            odd = F.exists(
                found["items"], lambda e: ~_is_kind(F.schema_of_variant(e), self.items)
            )
            rules.append(("item_type", odd))
        where = self.path or "body"
        return [F.when(broken, F.lit(f"{name}:{where}")) for name, broken in rules]


def _outside(value: Column, limits: tuple) -> Column:
    """Below the first limit or above the second, where there is one."""
    low, high = limits
    below = F.lit(False) if low is None else value < low
    return below if high is None else below | (value > high)


# ---- contracts written as JSON Schema documents

_ANNOTATIONS = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}
_KEYWORDS = {
    "type", "enum", "const", "format", "pattern", "minLength", "maxLength", "minimum", "maximum", "required",
    "properties", "additionalProperties", "items",
}
_KINDS = {"string", "number", "integer", "boolean", "object", "array", "null"}
_FORMS = {"date-time": "time", "date": "day"}


class SchemaError(ValueError):
    """A document holds what no rule stands for."""


def compiled(document: Mapping) -> tuple[Field, ...]:
    """The rules of a JSON Schema document for an object, outer fields before inner ones.

    Known are types and unions of them, enumerations and constants of texts, `date` and `date-time`, patterns,
    lengths, limits of numbers, required and closed properties at any depth, and the type of an array's elements.
    Annotations are passed over. Anything else raises `SchemaError`, since a rule that is silently left out would
    let broken rows through. Null is allowed by a union with `null` only; a text's rules apply to texts alone.
    """
    if document.get("type") != "object":
        raise SchemaError("a contract describes an object")
    return tuple(_fields(document, (), False))


def _fields(node: Mapping, path: tuple[str, ...], required: bool) -> Iterator[Field]:
    where = ".".join(path) or "body"
    unknown = set(node) - _KEYWORDS - _ANNOTATIONS
    if unknown:
        raise SchemaError(f"{where}: {', '.join(sorted(unknown))}")
    kinds = _types(node, where)
    inner = node.get("properties", {})
    needed = node.get("required", [])
    if set(needed) - set(inner):
        raise SchemaError(f"{where}: required, but not described: {', '.join(sorted(set(needed) - set(inner)))}")
    if node.get("additionalProperties", True) not in (True, False):
        raise SchemaError(f"{where}: additionalProperties is true or false")
    if node.get("format", "date") not in _FORMS:
        raise SchemaError(f"{where}: format {node['format']}")
    values = node.get("enum", [node["const"]] if "const" in node else [])
    if any(v is not None and not isinstance(v, str) for v in values):
        raise SchemaError(f"{where}: only texts can be listed")
    yield Field(
        ".".join(path),
        tuple(k for k in kinds if k != "null"),
        required=required,
        nullable="null" in kinds,
        one_of=tuple(v for v in values if v is not None),
        form=_FORMS.get(node.get("format", ""), ""),
        lengths=(node.get("minLength"), node.get("maxLength")),
        only=None if node.get("additionalProperties", True) else tuple(inner),
        items=_element(node["items"], where) if "items" in node else "",
        limits=(node.get("minimum"), node.get("maximum")),
        pattern=node.get("pattern", ""),
        at="$" + "".join(_step(name) for name in path),
    )
    for name, child in inner.items():
        yield from _fields(child, (*path, name), name in needed)


def _types(node: Mapping, where: str) -> tuple[str, ...]:
    kinds = node.get("type", ())
    kinds = (kinds,) if isinstance(kinds, str) else tuple(kinds)
    if not set(kinds) - {"null"} or set(kinds) - _KINDS:
        raise SchemaError(f"{where}: type {', '.join(kinds) or 'is missing'}")
    return kinds


def _element(node: Mapping, where: str) -> str:
    kinds = _types(node, f"{where}[]")
    if len(kinds) != 1 or set(node) - {"type"} - _ANNOTATIONS:
        raise SchemaError(f"{where}[]: elements have one type and no further rule")
    return kinds[0]


def _step(name: str) -> str:
    """A name within a path; brackets allow any characters but quotes."""
    if "'" in name or "\\" in name:
        raise SchemaError(f"name with a quote: {name}")
    return f"['{name}']"


def schema_reasons(df: DataFrame, document: Mapping, body: str = "body") -> DataFrame:
    """Adds `reasons` to rows judged by a JSON Schema document; see `compiled` for what it may hold."""
    return _with_reasons(df, body, [(f.readings, f.reasons) for f in compiled(document)])


_TEXT = {"type": "string"}
_TEXT_OR_NULL = {"type": ["string", "null"]}
_FLAG_OR_NULL = {"type": ["boolean", "null"]}
_NUMBER_OR_NULL = {"type": ["number", "null"]}
_TIME = {"type": "string", "format": "date-time"}
_TIME_OR_NULL = {"type": ["string", "null"], "format": "date-time"}


def _object(properties: Mapping, required: Sequence[str] = (), closed: bool = False) -> dict:
    return {
        "type": "object", "properties": dict(properties), "required": list(required), "additionalProperties": not closed,
    }


def _each(names: Sequence[str], node: Mapping) -> dict:
    return dict.fromkeys(names, node)


# The webhook contract.
_TAGS = ("utm_campaign", "utm_source", "utm_medium", "utm_content", "utm_term", "salesforce_uuid")
_PAYLOAD_TEXTS = (
    "event", "email", "name", "first_name", "last_name", "timezone", "text_reminder_number",
    "cancel_url", "reschedule_url", "new_invitee", "old_invitee",
)
WEBHOOK_DOCUMENT = _object(
    {
        "event": {
            "type": "string",
            "enum": ["invitee.created", "invitee.canceled", "routing_form_submission.created"],
        },
        "created_at": _TIME,
        "created_by": _TEXT_OR_NULL,
        "payload": _object(
            {
                "uri": _TEXT,
                **_each(_PAYLOAD_TEXTS, _TEXT_OR_NULL),
                "status": {"type": ["string", "null"], "enum": ["active", "canceled", None]},
                "canceled": _FLAG_OR_NULL,
                "rescheduled": _FLAG_OR_NULL,
                "questions_and_answers": {"type": "array", "items": {"type": "object"}},
                "tracking": _object(_each(_TAGS, _TEXT_OR_NULL)),
                "created_at": _TIME_OR_NULL,
                "updated_at": _TIME_OR_NULL,
            },
            required=["uri"],
        ),
    },
    required=["event", "created_at", "payload"],
)
WEBHOOK_CONTRACT = compiled(WEBHOOK_DOCUMENT)

# The vendor spend contract.
_LEVELS = ("account", "campaign", "adset", "adgroup", "ad", "creative")
_METRICS = ("impressions", "clicks", "reach", "video_views", "conversions", "revenue", "leads")
SPEND_DOCUMENT = _object(
    {
        "source": {
            "type": "string",
            "enum": ["google_ads", "meta_ads", "linkedin_ads", "tiktok_ads", "bing_ads", "other"],
        },
        "granularity": {"type": "string", "enum": ["day", "campaign", "adset", "ad", "creative"]},
        "date": {"type": "string", "format": "date"},
        "timezone": _TEXT_OR_NULL,
        "ids": _object(_each([f"{n}_id" for n in _LEVELS], _TEXT_OR_NULL), closed=True),
        "names": _object(_each([f"{n}_name" for n in _LEVELS], _TEXT_OR_NULL), closed=True),
        "metrics": _object(
            {"spend": {"type": "number"}, **_each(_METRICS, _NUMBER_OR_NULL)}, required=["spend"], closed=True
        ),
        "currency": {"type": "string", "minLength": 3, "maxLength": 3},
        "attribution": _object(_each(["window", "model"], _TEXT_OR_NULL)),
        "provenance": _object(
            {"load_id": _TEXT, "source_file": _TEXT_OR_NULL, "extracted_at": _TIME_OR_NULL}, closed=True
        ),
        "extra": _object({}),
    },
    required=["source", "date", "ids", "metrics", "currency"],
    closed=True,
)
SPEND_CONTRACT = compiled(SPEND_DOCUMENT)


# Flat spend and flat events.
FLAT_SPEND_CONTRACT = compiled(
    _object({"date": {"type": "string", "format": "date"}, "channel": _TEXT_OR_NULL, "spend": _NUMBER_OR_NULL}, ["date"])
)
_FLAT_EVENT_TEXTS = (
    "event_type", "event_start_time", "event_end_time", "created_at", "organizer_email", "invitee_email",
)
FLAT_EVENT_CONTRACT = compiled(_object(_each(_FLAT_EVENT_TEXTS, _TEXT_OR_NULL)))


# Rules on spend beyond the contract: upper-case currency code, no negative measure.
def _spend_readings(body: Column) -> dict[str, Column]:
    found = {"currency": F.try_variant_get(body, "$.currency", "string")}
    for metric in ("spend", *_METRICS):
        found[metric] = F.try_variant_get(body, f"$.metrics.{metric}", "double")
    return found


def _spend_quality(found: dict[str, Column]) -> list[Column]:
    code = found["currency"].rlike("^[A-Z]{3}$")
    negative = [
        F.when(found[m] < 0, F.lit(f"negative:metrics.{m}")) for m in ("spend", *_METRICS)
    ]
    return [F.when(~code, F.lit("format:currency")), *negative]


Reader = Callable[[Column], dict[str, Column]]
Judge = Callable[[dict[str, Column]], list[Column]]


def _with_reasons(df: DataFrame, body: str, checks: Sequence[tuple[Reader, Judge]]) -> DataFrame:
    """Parse once, take every reading once, then judge: three projections that Spark keeps apart."""
    parsed = df.withColumn("_parsed", parsed_body(F.col(body)))
    taken: dict[str, Column] = {"_broken": F.col("_parsed").isNull()}
    reasons: list[Column] = []
    for i, (read, judge) in enumerate(checks):
        found = read(F.col("_parsed"))
        taken.update({f"_{i}_{name}": reading for name, reading in found.items()})
        reasons += judge({name: F.col(f"_{i}_{name}") for name in found})
    judged = F.when(F.col("_broken"), F.array(F.lit("malformed"))).otherwise(_present(reasons))
    return (
        parsed.withColumns(taken).withColumn(REASONS, judged).select(*df.columns, REASONS)
    )


def _present(reasons: Sequence[Column]) -> Column:
    """The reasons that apply; unlike `array_compact` this stays inside code generation."""
    return F.array_remove(F.array(*[F.coalesce(r, F.lit("")) for r in reasons]), "")


def webhook_reasons(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds `reasons`; an empty list means the body keeps the webhook contract."""
    return _with_reasons(df, body, [(f.readings, f.reasons) for f in WEBHOOK_CONTRACT])


def spend_reasons(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds `reasons`; an empty list means the body keeps the spend contract."""
    checks = [(f.readings, f.reasons) for f in SPEND_CONTRACT]
    return _with_reasons(df, body, [*checks, (_spend_readings, _spend_quality)])


def flat_spend_reasons(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds `reasons` to flat spend records."""
    return _with_reasons(df, body, [(f.readings, f.reasons) for f in FLAT_SPEND_CONTRACT])


def flat_event_reasons(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds `reasons` to flat events."""
    return _with_reasons(df, body, [(f.readings, f.reasons) for f in FLAT_EVENT_CONTRACT])


def route_of(reasons: str) -> Column:
    """Where a judged row belongs."""
    return F.when(F.size(reasons) == 0, F.lit(BRONZE)).otherwise(F.lit(DEAD_LETTER))


def reason_counts(judged: DataFrame) -> DataFrame:
    """Rows per reason. The outer explode keeps Spark from judging twice, once more to filter."""
    return (
        judged.select(F.explode_outer(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("reason IS NOT NULL")
    )


# ---- rules on parsed webhooks


def unique_webhooks(webhooks: DataFrame) -> DataFrame:
    """One webhook per invitee uri and kind, the first sent; later copies are no-ops.

    Copies sent at one instant are told apart by their JSON text, so the survivor does not depend
    on the order of the input.
    """
    whole = F.to_json(F.struct(*webhooks.columns))
    order = [instant(F.col("created_at")).asc_nulls_last(), whole]
    return keep_latest(webhooks, [F.col("payload.uri"), F.col("event")], order)


def webhook_flags(webhooks: DataFrame) -> DataFrame:
    """Adds `flags`: doubtful times and reschedules without a link. Flagged rows are kept."""
    sent = instant(F.col("created_at"))
    rules = []
    for name in ("created_at", "updated_at"):
        text = F.col(f"payload.{name}")
        at = instant(text)
        rules.append(F.when(text.isNotNull() & at.isNull(), F.lit(f"time:{name}")))
        skew = F.abs(F.unix_seconds(sent) - F.unix_seconds(at))
        rules.append(F.when(skew > SKEW_DAYS * 86400, F.lit(f"skew:{name}")))
    unlinked = (
        F.col("payload.rescheduled")
        & F.col("payload.new_invitee").isNull()
        & F.col("payload.old_invitee").isNull()
    )
    rules.append(F.when(unlinked, F.lit("reschedule_unlinked")))
    return webhooks.withColumn("flags", _present(rules))


def reschedule_pairs(webhooks: DataFrame) -> DataFrame:
    """Canceled invitee -> the invitee that replaces it, if the replacement has landed.

    Links are read from both sides; a cancellation is proof of its own that the invitee is canceled, so only the links
    that creations hold are looked up among the canceled. Uris are distinct where a join could multiply rows.
    """
    flat = webhooks.select("event", "payload.uri", "payload.old_invitee", "payload.new_invitee").where("uri IS NOT NULL")
    created, canceled = flat.where("event = 'invitee.created'"), flat.where("event = 'invitee.canceled'")
    forward = canceled.where("new_invitee IS NOT NULL").select(
        F.col("uri").alias("canceled_uri"), F.col("new_invitee").alias("created_uri")
    )
    backward = created.where("old_invitee IS NOT NULL").select(
        F.col("old_invitee").alias("canceled_uri"), F.col("uri").alias("created_uri")
    )
    gone = canceled.select(F.col("uri").alias("canceled_uri"))
    links = forward.unionByName(backward.join(gone, "canceled_uri", "left_semi")).distinct()
    there = created.select(F.col("uri").alias("created_uri")).distinct().withColumn("paired", F.lit(True))
    return links.join(there, "created_uri", "left").select(
        "canceled_uri", "created_uri", F.coalesce("paired", F.lit(False)).alias("paired")
    )


def active_invitees(webhooks: DataFrame) -> DataFrame:
    """Created invitees that no canceled webhook names: one active meeting per reschedule chain."""
    flat = webhooks.select("event", "payload.uri")
    created = flat.where("event = 'invitee.created'").select("uri").distinct()
    canceled = flat.where("event = 'invitee.canceled'").select("uri")
    return created.join(canceled, "uri", "left_anti")


def active_bookings(events: DataFrame) -> DataFrame:
    """Silver events without canceled records and without the bookings they cancel."""
    gone = F.lit(False)
    for column, value in (("webhook_event", "invitee.canceled"), ("invitee_status", "canceled")):
        gone = gone | F.coalesce(F.col(column) == value, F.lit(False))
    canceled = events.where(gone).select("invitee_uri").distinct()
    active = events.where(~gone).join(canceled, "invitee_uri", "left_anti")
    return active.select(*events.columns)


def with_enrichment_status(flat: DataFrame, meetings: DataFrame) -> DataFrame:
    """Marks rows whose meeting is in the table of scheduled events (column `uri`)."""
    known = meetings.select(F.col("uri").alias("scheduled_event_uri")).distinct()
    return flat.join(known.withColumn("_known", F.lit(True)), "scheduled_event_uri", "left").select(
        *flat.columns,
        F.when(F.col("_known"), F.lit("ok")).otherwise(F.lit("failed")).alias("enrichment_status"),
    )


def spend_totals_check(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Spend per source, day and account on both sides, with the difference judged within 2 %.

    An account present on one side only counts as 0 on the other. Both frames are flat.
    """
    keys = ["source", "date", "account_id"]

    def totals(flat: DataFrame, side: str) -> DataFrame:
        amount = money_total(F.col("spend")).alias(f"{side}_spend")
        return flat.groupBy(*[F.col(k).alias(f"{side}_{k}") for k in keys]).agg(amount)

    same = [F.col(f"bronze_{k}").eqNullSafe(F.col(f"silver_{k}")) for k in keys]
    both = totals(bronze, "bronze").join(totals(silver, "silver"), same, "full_outer")
    both = both.select(
        *[F.coalesce(f"bronze_{k}", f"silver_{k}").alias(k) for k in keys],
        *[F.coalesce(f"{s}_spend", F.lit(0.0)).alias(f"{s}_spend") for s in ("bronze", "silver")],
    )
    gap = F.abs(F.col("silver_spend") - F.col("bronze_spend"))
    return both.withColumn("within", gap <= F.abs(F.col("bronze_spend")) * TOTALS_TOLERANCE)
