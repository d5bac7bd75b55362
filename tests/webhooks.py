"""Invented webhooks."""

import copy
import json

from pyspark.sql import functions as F

from meetmart import schemas
from meetmart.functions.channels import LINK_CHANNELS

LINK = next(iter(LINK_CHANNELS))


def webhook(**changes):
    """A full webhook; keys like payload__uri change or, with None, blank nested members."""
    body = {
        "created_at": "2025-07-08T17:45:10.000000Z",
        "created_by": "https://api.test/users/U1",
        "event": "invitee.created",
        "payload": {
            "uri": "https://api.test/scheduled_events/E1/invitees/I1",
            "event": "https://api.test/scheduled_events/E1",
            "email": "ada@mail.test",
            "name": "Ada Example",
            "timezone": "Europe/Paris",
            "status": "active",
            "canceled": False,
            "rescheduled": False,
            "new_invitee": None,
            "old_invitee": None,
            "questions_and_answers": [{"question": "Topic?", "answer": "Data", "position": 0}],
            "tracking": {"utm_source": "Newsletter", "utm_medium": None},
            "scheduled_event": {
                "uri": "https://api.test/scheduled_events/E1",
                "name": "Intro",
                "event_type": f"https://api.test/event_types/{LINK}",
                "status": "active",
                "start_time": "2025-07-09T02:30:00.000000Z",
                "end_time": "2025-07-09T03:00:00.000000Z",
                "event_memberships": [
                    {"user": "https://api.test/users/H1", "user_email": "h@test", "user_name": "Host One"}
                ],
            },
            "created_at": "2025-07-08T17:41:00.000000Z",
            "updated_at": "2025-07-08T17:41:00.000000Z",
        },
    }
    body = copy.deepcopy(body)
    for key, value in changes.items():
        *path, last = key.split("__")
        spot = body
        for step in path:
            spot = spot[step]
        if value is ...:
            del spot[last]
        else:
            spot[last] = value
    return body


def frame(spark, bodies):
    """Webhooks as the typed frame."""
    return (
        spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
        .select(F.from_json("body", schemas.WEBHOOK).alias("w"))
        .select("w.*")
    )


def texts(spark, bodies):
    rows = [(b if isinstance(b, str) else json.dumps(b),) for b in bodies]
    return spark.createDataFrame(rows, "body string")
