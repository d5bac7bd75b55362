import pathlib

import pytest
from pyspark.sql import functions as F
from webhooks import frame, texts, webhook

from meetmart.operators import chains, contracts

SPEND = {
    "source": "bing_ads", "granularity": "day", "date": "2031-02-03", "timezone": None,
    "ids": {"account_id": "1", "ad_id": None}, "names": {"account_name": "Nimbus"},
    "metrics": {"spend": 3.25, "clicks": 9, "reach": None}, "currency": "USD",
    "attribution": {"window": "30d", "other": 1}, "provenance": {"load_id": "L"}, "extra": {"zone": 4},
}


def reasons(df):
    return [r.reasons for r in df.collect()]


def test_webhook_contract(spark):
    cases = [
        (webhook(), []),
        (webhook(payload__status=None, payload__tracking={}, extra_key=1), []),
        (webhook(event="invitee.moved"), ["value:event"]),
        (webhook(event=...), ["missing:event"]),
        (webhook(event=5), ["type:event"]),
        (webhook(created_at="noon"), ["format:created_at"]),
        (webhook(payload=...), ["missing:payload", "missing:payload.uri"]),
        (webhook(payload="x"), ["type:payload", "missing:payload.uri"]),
        (webhook(payload__uri=...), ["missing:payload.uri"]),
        (webhook(payload__uri=None), ["type:payload.uri"]),
        (webhook(payload__status="maybe"), ["value:payload.status"]),
        (webhook(payload__canceled="yes"), ["type:payload.canceled"]),
        (webhook(payload__questions_and_answers=[1]), ["item_type:payload.questions_and_answers"]),
        (webhook(payload__updated_at="never"), ["format:payload.updated_at"]),
        ({"title": "Not Found", "message": "?"}, ["missing:event", "missing:created_at",
                                                   "missing:payload", "missing:payload.uri"]),
        ('{"event": "invitee.cre', ["malformed"]),
        ("[1]", ["type:body", "missing:event", "missing:created_at", "missing:payload",
                 "missing:payload.uri"]),
    ]
    got = reasons(contracts.webhook_reasons(texts(spark, [c[0] for c in cases])))
    assert got == [c[1] for c in cases]


def test_spend_contract(spark):
    def spend(**changes):
        return {k: v for k, v in {**SPEND, **changes}.items() if v is not ...}

    cases = [
        (spend(), []),
        (spend(granularity=...), []),
        (spend(source="paper"), ["value:source"]),
        (spend(date="31.05.2025"), ["format:date"]),
        (spend(currency="usd"), ["format:currency"]),
        (spend(currency="US"), ["length:currency", "format:currency"]),
        (spend(metrics={"spend": -1, "clicks": -2}),
         ["negative:metrics.spend", "negative:metrics.clicks"]),
        (spend(metrics={"clicks": 2}), ["missing:metrics.spend"]),
        (spend(metrics={"spend": "12"}), ["type:metrics.spend"]),
        (spend(surprise=1), ["unknown_key:body"]),
        (spend(ids={"shoe": "1"}), ["unknown_key:ids"]),
        (spend(ids=...), ["missing:ids"]),
        (spend(names=None), ["type:names"]),
    ]
    got = reasons(contracts.spend_reasons(texts(spark, [c[0] for c in cases])))
    assert got == [c[1] for c in cases]


def test_reason_counts(spark):
    judged = contracts.webhook_reasons(texts(spark, [webhook(), "x", "y", webhook(event=...)]))
    counts = {r.reason: r.rows for r in contracts.reason_counts(judged).collect()}
    assert counts == {"malformed": 2, "missing:event": 1}


def test_flags(spark):
    late = "2025-07-17T06:04:35Z"
    bodies = [
        webhook(),
        webhook(payload__rescheduled=True),
        webhook(payload__rescheduled=True, payload__old_invitee="I0"),
        webhook(payload__updated_at=late, payload__created_at="noon"),
        webhook(payload__created_at=None),
    ]
    got = [r.flags for r in contracts.webhook_flags(frame(spark, bodies)).collect()]
    assert got == [[], ["reschedule_unlinked"], [], ["time:created_at", "skew:updated_at"], []]


@pytest.fixture(scope="module")
def chain(spark):
    """old -> new by both links, twice landed; lost names a successor that never arrived."""
    old = webhook(event="invitee.canceled", payload__uri="old", payload__new_invitee="new",
                  payload__rescheduled=True, payload__scheduled_event=...)
    new = webhook(payload__uri="new", payload__old_invitee="old", payload__rescheduled=True)
    first = webhook(payload__uri="old")
    lost = webhook(event="invitee.canceled", payload__uri="lost", payload__new_invitee="nowhere")
    only_back = webhook(event="invitee.canceled", payload__uri="b1")
    back = webhook(payload__uri="b2", payload__old_invitee="b1")
    return frame(spark, [old, old, new, new, first, lost, only_back, back, webhook(payload__uri="solo")])


def test_reschedules(chain):
    pairs = {tuple(r) for r in contracts.reschedule_pairs(chain).collect()}
    assert pairs == {("old", "new", True), ("lost", "nowhere", False), ("b1", "b2", True)}
    active = [r.uri for r in contracts.active_invitees(chain).collect()]
    assert sorted(active) == ["b2", "new", "solo"]
    unique = contracts.unique_webhooks(chain)
    assert unique.count() == 7


def test_active_bookings(spark, chain):
    from meetmart.operators import silver

    events = silver.silver_events(chain, "2025-07-10")
    left = contracts.active_bookings(events)
    assert left.columns == events.columns
    assert sorted(r.invitee_uri for r in left.collect()) == ["b2", "new", "solo"]
    anonymous = events.limit(1).withColumns(
        {"invitee_uri": F.lit(None).cast("string"), "webhook_event": F.lit(None).cast("string"),
         "invitee_status": F.lit(None).cast("string")}
    )
    assert contracts.active_bookings(anonymous).count() == 1


def test_enrichment(spark):
    flat = spark.createDataFrame([("m1",), ("m2",), (None,)], "scheduled_event_uri string")
    meetings = spark.createDataFrame([("m1",), ("m1",)], "uri string")
    got = {r[0]: r[1] for r in contracts.with_enrichment_status(flat, meetings).collect()}
    assert got == {"m1": "ok", "m2": "failed", None: "failed"}


def test_spend_totals(spark):
    schema = "source string, date string, account_id string, spend double"
    bronze = [("a", "d", "1", 60.0), ("a", "d", "1", 40.0), ("a", "d", "2", 100.0),
              ("a", "d", None, 100.0), ("b", "d", "1", 5.0)]
    silver = [("a", "d", "1", 101.9), ("a", "d", "2", 97.9), ("a", "d", None, 100.0),
              ("c", "d", "1", 5.0)]
    got = contracts.spend_totals_check(
        spark.createDataFrame(bronze, schema), spark.createDataFrame(silver, schema)
    )
    assert {(r.source, r.account_id): r.within for r in got.collect()} == {
        ("a", "1"): True, ("a", "2"): False, ("a", None): True, ("b", "1"): False, ("c", "1"): False,
    }


def test_no_python_functions_in_the_package():
    root = pathlib.Path(contracts.__file__).parents[1]
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert "udf(" not in text and "localCheckpoint" not in text, path


def _steps(spark, links, created=(), lost=()):
    """Webhooks of reschedules a -> b: each a is canceled and names b; `created` have landed as created too."""
    bodies = [webhook(event="invitee.canceled", payload__uri=a, payload__new_invitee=b) for a, b in links]
    bodies += [webhook(payload__uri=u) for u in created]
    return frame(spark, bodies)


def _chains(spark, hooks):
    return sorted(tuple(r) for r in chains.reschedule_chains(hooks).collect())


def test_chains_of_any_length_have_one_active_booking_at_their_end(spark):
    long = [(f"L{n:03}", f"L{n + 1:03}") for n in range(37)]
    hooks = _steps(spark, [*long, ("A", "B"), ("X", "Y")], ["L037", "L004", "L005", "A", "B", "single"])
    assert _chains(spark, hooks.union(hooks)) == [
        ("A", "B", 2, True, False), ("L000", "L037", 38, True, False), ("X", "Y", 2, False, False),
    ]
    assert contracts.active_invitees(hooks).join(chains.followed_links(hooks), "uri").isEmpty()


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 8, 9])
def test_rounds_suffice_for_each_length(spark, length):
    links = [(f"N{n:02}", f"N{n + 1:02}") for n in range(length)]
    assert _chains(spark, _steps(spark, links)) == [("N00", f"N{length:02}", length + 1, False, False)]


def test_cycles_end_and_are_never_active(spark):
    links = [("C1", "C2"), ("C2", "C3"), ("C3", "C1"), ("S", "S"), ("P", "Q"), ("Q", "P"), ("A", "B"), ("B", "D")]
    assert _chains(spark, _steps(spark, links, ["C1", "D"])) == [
        ("A", "D", 3, True, False), ("C1", "C1", 3, False, True), ("P", "P", 2, False, True),
    ]


def test_branches_follow_one_link(spark):
    """A names two successors, of which one has landed; two name C, of which the smaller one leads to it."""
    hooks = _steps(spark, [("A", "B0"), ("A", "B1"), ("K", "C"), ("J", "C")], ["B1", "C"])
    assert _chains(spark, hooks) == [("A", "B1", 2, True, False), ("J", "C", 2, True, False)]
    assert _chains(spark, frame(spark, [webhook()])) == []


def test_documents_with_rules_that_are_not_known_are_refused():
    def made(**node):
        return {"type": "object", "properties": {"a": node}}

    for broken in (
        made(type="string", uniqueItems=True), made(type="text"), made(), made(type="null"), made(type="string", format="email"),
        made(type="number", enum=[1]), made(type="array", items={"type": "object", "properties": {}}),
        made(type="object", additionalProperties={"type": "string"}), made(type="object", required=["b"]),
        {"type": "object", "properties": {"it's": {"type": "string"}}}, {"type": "array"}, {"anyOf": []},
    ):
        with pytest.raises(contracts.SchemaError):
            contracts.compiled(broken)


def test_rows_are_judged_by_a_document(spark):
    document = {
        "type": "object",
        "required": ["n"],
        "properties": {
            "n": {"type": ["integer", "null"], "minimum": 0, "maximum": 9, "description": "passed over"},
            "a key.b": {"type": ["string", "boolean"], "minLength": 2, "pattern": "x"},
            "kind": {"type": "string", "const": "k"},
            "list": {"type": "array", "items": {"type": "integer"}},
            "in": {"type": "object", "additionalProperties": False, "properties": {"at": {"type": "string", "format": "date"}}},
        },
    }
    cases = [
        ({"n": 3, "a key.b": "ax", "kind": "k", "list": [1, 2], "in": {"at": "2031-01-02"}, "more": 1}, []),
        ({"n": None, "a key.b": True, "list": []}, []),
        ({"n": 4.0}, []),
        ({}, ["missing:n"]),
        ({"n": 4.5}, ["type:n"]),
        ({"n": 10}, ["range:n"]),
        ({"n": -1}, ["range:n"]),
        ({"n": "3"}, ["type:n"]),
        ({"n": 1, "a key.b": "y"}, ["pattern:a key.b", "length:a key.b"]),
        ({"n": 1, "a key.b": 2}, ["type:a key.b"]),
        ({"n": 1, "kind": "other"}, ["value:kind"]),
        ({"n": 1, "list": [1, "2"]}, ["item_type:list"]),
        ({"n": 1, "in": {"at": "soon", "b": 1}}, ["unknown_key:in", "format:in.at"]),
    ]
    got = reasons(contracts.schema_reasons(texts(spark, [c[0] for c in cases]), document))
    assert got == [c[1] for c in cases]
