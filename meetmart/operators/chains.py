"""Chains of rescheduled bookings: from the first one canceled to the one that stands."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetmart.operators.contracts import active_invitees, reschedule_pairs
from meetmart.operators.dedupe import keep_latest
from meetmart.sources.scratch import materialized


def followed_links(webhooks: DataFrame) -> DataFrame:
    """(uri, next): one successor per canceled invitee and one predecessor per successor.

    Of several, a successor that has landed goes before one that has not, then the smaller uri. A link that is not
    followed ends no chain: its successor starts one of its own.
    """
    pairs = reschedule_pairs(webhooks).where("canceled_uri <> created_uri")
    landed = F.col("paired").desc()
    one = keep_latest(pairs, ["canceled_uri"], [landed, F.col("created_uri")])
    one = keep_latest(one, ["created_uri"], [F.col("canceled_uri")])
    return one.select(F.col("canceled_uri").alias("uri"), F.col("created_uri").alias("next"))


def ends_of(links: DataFrame) -> DataFrame:
    """(uri, last, steps, cycle) for each uri that has a link; uri and next are unique in `links`.

    Pointers double: in each round every unfinished row takes over the pointer of the row it points to, so a chain of n
    links takes log2(n) rounds. A row that has reached an end goes aside, so no two rows ever join on the same
    pointer, however many belong to one chain. What is left after log2 of all links goes round: the smallest
    uri of a cycle, found on the way, stands for its end. Each round is a written table.
    """
    one = F.lit(1).cast("long")
    now = links.select("uri", F.col("next").alias("at"), one.alias("steps"), F.least("uri", "next").alias("least"))
    now = materialized(now, "chains")
    rounds = math.ceil(math.log2(max(now.count(), 1))) + 1
    done = None
    for _ in range(rounds):
        ahead = now.select(
            F.col("uri").alias("at"), F.col("at").alias("then"), F.col("steps").alias("more"), F.col("least").alias("least_then")
        )
        joined = now.join(ahead, "at", "left")
        ended = joined.where("then IS NULL").select("uri", F.col("at").alias("last"), "steps")
        if done is not None:  # pointers to rows that ended in an earlier round lead on to their end
            behind = done.select(F.col("uri").alias("last"), F.col("last").alias("end"), F.col("steps").alias("rest"))
            ended = ended.join(behind, "last", "left").select(
                "uri", F.coalesce("end", "last").alias("last"), (F.col("steps") + F.coalesce("rest", F.lit(0))).alias("steps")
            )
        ended = materialized(ended, "ended")
        done = ended if done is None else done.unionByName(ended)
        going = joined.where("then IS NOT NULL").select(
            "uri", F.col("then").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), F.least("least", "least_then").alias("least")
        )
        now = materialized(going, "chains")
        if now.isEmpty():
            break
    round_ = now.select("uri", F.col("least").alias("last"), F.lit(None).cast("long").alias("steps"))
    return done.withColumn("cycle", F.lit(False)).unionByName(round_.withColumn("cycle", F.lit(True)))


def reschedule_chains(webhooks: DataFrame) -> DataFrame:
    """(first_uri, last_uri, length, active, cycle): one row per chain of two bookings or more.

    `active` tells whether the last one stands: it has landed and is not canceled; no other booking of a
    chain can, since all others were canceled. A cycle has its smallest uri as both ends and is never active.
    """
    links = materialized(followed_links(webhooks), "links")
    ends = ends_of(links)
    later = links.select(F.col("next").alias("uri"))
    open_ = ends.where(~F.col("cycle")).join(later, "uri", "left_anti").select(
        F.col("uri").alias("first_uri"), F.col("last").alias("last_uri"), (F.col("steps") + 1).alias("length"), "cycle"
    )
    round_ = ends.where("cycle").groupBy(F.col("last").alias("first_uri")).agg(F.count(F.lit(1)).alias("length"))
    chains = open_.unionByName(
        round_.select("first_uri", F.col("first_uri").alias("last_uri"), "length", F.lit(True).alias("cycle"))
    )
    standing = active_invitees(webhooks).select(F.col("uri").alias("last_uri"), F.lit(True).alias("active"))
    return chains.join(standing, "last_uri", "left").select(
        "first_uri", "last_uri", "length", F.coalesce("active", F.lit(False)).alias("active"), "cycle"
    )
