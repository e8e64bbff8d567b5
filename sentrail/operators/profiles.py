"""Roll raw logs up into activity profiles per actor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrail.functions.rules import ACTORS, DAY_COLS, OS_LOG_RULES, PROFILE_COUNTERS, ActivityRules
from sentrail.functions.text import drop_leading_list, size_list
from sentrail.session import materialise

# Profile window lengths, aligned to the epoch.
WINDOW_LENGTHS = {"hour": "1 hour", "day": "1 day", "week": "7 days", "month": "30 days"}


def present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def daily_activity(
    events: DataFrame,
    rules: ActivityRules = OS_LOG_RULES,
    actors: Mapping[str, str] = ACTORS,
    day_cols: Sequence[str] = DAY_COLS,
) -> DataFrame:
    """Daily counters per actor name and type, from one pass over the raw events.

    Only events that name every actor count. The counter flags are worked out once per event;
    the actors are grouping sets over the same scan, so adding an actor type adds no scan, and
    map-side sums reduce a busy actor to one row per task before the shuffle.
    """
    days, columns = list(day_cols), list(actors.values())
    complete = present(columns[0])
    for column in columns[1:]:
        complete = complete & present(column)
    flagged = events.where(complete).select(*columns, *days, *rules.flags())

    totals = [F.count(F.lit(1)).alias("total_events")]
    totals += [F.sum(name).alias(name) for name in rules.counters]
    grouped = [F.grouping(column).alias(f"_without_{column}") for column in columns]
    rolled = flagged.groupingSets([[column, *days] for column in columns], *columns, *days).agg(*totals, *grouped)

    kind = F.coalesce(*[F.when(F.col(f"_without_{column}") == 0, F.lit(name)) for name, column in actors.items()])
    return rolled.select(
        F.coalesce(*columns).alias("name"), kind.alias("type"), *days, "total_events", *rules.counters
    )


def counter_rollup(
    counters: DataFrame,
    actor: str,
    lower: bool = False,
    num_cols: Sequence[str] = PROFILE_COUNTERS,
) -> DataFrame:
    """Sum the counters per actor; ``lower`` merges spellings that differ in case."""
    name = F.lower(actor) if lower else F.col(actor)
    return counters.groupBy(name.alias(actor)).agg(*[F.sum(c).cast("long").alias(c) for c in num_cols])


def mail_profile(mails: DataFrame, sizes: str = "mail_size", senders: str = "ext_sndrs") -> DataFrame:
    """Mail count, total and mean size and external senders per mailbox.

    Each record holds a comma list of sizes; a list that starts with a comma counts by its last
    entry only. Entries are summed inside the record and then per mailbox, so no mailbox's list
    is ever gathered in one place.
    """
    listed = F.col("_sizes")
    per_record = (
        mails.where(F.length(F.trim(F.col(sizes))) > 0)
        .withColumn("_sizes", size_list(drop_leading_list(F.col(sizes))))
        .select(
            "mail_id",
            F.size(listed).alias("_emails"),
            F.aggregate(
                listed, F.lit(0).cast("long"), lambda total, size: total + F.coalesce(size, F.lit(0))
            ).alias("_bytes"),
            F.expr(f"try_cast({senders} as bigint)").alias("_senders"),
        )
    )
    return (
        per_record.groupBy("mail_id")
        .agg(
            F.sum("_emails").alias("no_of_emails"),
            F.sum("_bytes").alias("tot_email_size"),
            F.sum("_senders").alias("ext_sndrs"),
        )
        .withColumn("avg_email_size", F.round(F.expr("try_divide(tot_email_size, no_of_emails)"), 4))
    )


def assemble_attributes(
    values: DataFrame,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    actor: str = "actor",
    attribute: str = "attribute",
    value: str = "value",
) -> DataFrame:
    """One row per actor that has every attribute, from a long (actor, attribute, value) table.

    Same result as inner-joining one table per attribute on the actor: an actor without a name or
    without one of the attributes has no row, one with repeated attributes has a row per
    combination. Numbers that can't be read are null. Actors seen once per attribute take one
    shuffle however many attributes there are; only rows of the others are joined attribute by
    attribute. Runs a job when called, to write the grouped rows.
    """
    wanted = [*num_cols, *cat_cols]
    name = F.col(attribute)
    cells = [F.max(F.when(name == c, F.col(value))).alias(c) for c in wanted]
    seen = [F.count(F.when(name == c, 1)).alias(f"_n{i}") for i, c in enumerate(wanted)]
    named = values.where(name.isin(*wanted) & F.col(actor).isNotNull())
    fewest, most = F.array_min("_seen"), F.array_max("_seen")
    counted = named.groupBy(actor).agg(*cells, *seen).withColumn("_seen", F.array(*[f"_n{i}" for i in range(len(wanted))]))
    wide = materialise(counted.where(fewest > 0).select(actor, *[f"`{c}`" for c in wanted], most.alias("_most")), "attributes")
    rows = wide.where("_most = 1").drop("_most")
    repeated = wide.where("_most > 1").select(actor)
    if not repeated.isEmpty():
        theirs = materialise(named.join(repeated, actor, "left_semi").select(actor, attribute, value), "repeated-attributes")
        parts = [theirs.where(name == c).select(actor, F.col(value).alias(c)) for c in wanted]
        rows = rows.unionByName(reduce(lambda left, right: left.join(right, actor), parts))
    return rows.select(
        actor, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in num_cols], *[F.col(f"`{c}`") for c in cat_cols]
    )


def windowed_profiles(
    events: DataFrame, ts: str, keys: Sequence[str], length: str, aggregates: Mapping[str, Column]
) -> DataFrame:
    """Tumbling-window profiles. ``length`` is a name from WINDOW_LENGTHS or an interval.

    Works on batch and streaming frames alike; streams need a watermark on ``ts`` first.
    """
    window = F.window(ts, WINDOW_LENGTHS.get(length, length)).alias("_window")
    return (
        events.groupBy(window, *keys)
        .agg(*[column.alias(name) for name, column in aggregates.items()])
        .select(*keys, F.col("_window.start").alias("window_start"), *aggregates)
    )


def all_windows(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    lengths: Mapping[str, str] = WINDOW_LENGTHS,
) -> DataFrame:
    """Event count and sums for every window length from a single pass over the events.

    The shortest windows are built from the events and written once; longer windows, which are
    whole multiples of it, add those up instead of reading the events again.
    """
    names = ["events", *sums]
    (first, base), *longer = lengths.items()
    counters = {"events": F.count(F.lit(1)), **{name: F.sum(column) for name, column in sums.items()}}
    shortest = materialise(windowed_profiles(events, ts, keys, base, counters), f"profiles-{first}")
    result = shortest.withColumn("time_window", F.lit(first))
    for name, length in longer:
        rolled = windowed_profiles(shortest, "window_start", keys, length, {c: F.sum(c) for c in names})
        result = result.unionByName(rolled.withColumn("time_window", F.lit(name)))
    return result.select("time_window", "window_start", *keys, *names)
