"""Outbound-message consent: express consent, opt-out and local quiet hours."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import compact, element_rows, filled, string_array, utc_wall_clock
from wardline.functions.lookups import ROWS_PER_TASK, last_per_key, lookup_join
from wardline.functions.text import short_hash_token

# Regional and universal zones; names that only some engines know are left out.
ZONES = tuple(sorted(z for z in available_timezones()
                     if z == "UTC" or z.split("/")[0] in reg.ZONE_REGIONS))


MAX_CAMPAIGNS = 10_000


def consent_registry(contacts: DataFrame) -> DataFrame:
    """One record per contact; a later duplicate replaces an earlier one."""
    return last_per_key(contacts, ["contact_id"])


def registry_violations(contacts: DataFrame) -> DataFrame:
    """Contacts that can never be cleared as they are: seq, contact_id and what is wrong."""
    wrong = compact([
        F.when(F.col("contact_id").isNull(), F.lit("no contact id")),
        F.when(~usable_zone(), F.concat(F.lit("unusable time zone: "),
                                        F.coalesce("timezone", F.lit("none")))),
        F.when(~F.coalesce(F.col("consent").isin(*reg.CONSENT_STATES), F.lit(False)), F.concat(
            F.lit("unknown consent: "), F.coalesce("consent", F.lit("none on record"))))])
    return element_rows(contacts, ["seq", "contact_id"], wrong, "violation")


def usable_zone() -> Column:
    """Whether the record's zone is one that local time can be computed in."""
    return F.coalesce(F.col("timezone").isin(*ZONES), F.lit(False))


def campaign_sends(registry: DataFrame, campaign: str, send_ts: Column) -> DataFrame:
    """One send of a campaign to every registered contact, with the contact's record."""
    return registry.select("seq", "contact_id", F.lit(campaign).alias("campaign"),
                           send_ts.alias("send_ts"), "timezone", "consent",
                           F.lit(True).alias("known"))


def table_sends(registry: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One send of every campaign (campaign, send_ts) to every registered contact.

    The campaigns are few: more than ``MAX_CAMPAIGNS`` are refused, so the broadcast is bounded.
    """
    few = campaigns.select("campaign", "send_ts")
    if few.limit(MAX_CAMPAIGNS + 1).count() > MAX_CAMPAIGNS:
        raise ValueError(f"more than {MAX_CAMPAIGNS} campaigns; send them in parts")
    listed = few.agg(F.collect_list(F.struct("campaign", "send_ts")).alias("_all"))
    each = registry.withColumn("_one", F.lit(1)).join(
        F.broadcast(listed.withColumn("_one", F.lit(1))), "_one")
    sends = element_rows(each, ["seq", "contact_id", "timezone", "consent"], F.col("_all"), "_c")
    return sends.select("seq", "contact_id", "_c.campaign", "_c.send_ts", "timezone", "consent",
                        F.lit(True).alias("known"))


def with_contact(sends: DataFrame, registry: DataFrame, *,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left lookup of each send's contact; ``known`` tells whether there is a record."""
    records = registry.select("contact_id", "timezone", "consent", F.lit(True).alias("known"))
    plain = sends.drop("timezone", "consent", "known")  # the registry decides, not the send
    return (lookup_join(plain, records, ["contact_id"], rows_per_task=rows_per_task)
            .withColumn("known", F.coalesce("known", F.lit(False))))


def consent_reason() -> Column:
    """NULL when consent is affirmative; a missing or unknown state is none."""
    return (F.when(F.col("known") & (F.col("consent") == "opted_out"), F.lit(reg.OPTED_OUT_REASON))
            .when(~F.coalesce(F.col("known") & (F.col("consent") == "opted_in"), F.lit(False)),
                  F.lit(reg.NO_CONSENT_REASON)))


def with_local_time(joined: DataFrame) -> DataFrame:
    utc = utc_wall_clock(F.col("send_ts"), joined.schema["send_ts"].dataType)
    zone = F.when(usable_zone(), F.col("timezone")).otherwise(F.lit("UTC"))
    return joined.withColumn("local_ts", F.when(
        F.col("known") & usable_zone(), F.convert_timezone(F.lit("UTC"), zone, utc)))


def quiet_hours_reason(start_hour: int = reg.QUIET_START_HOUR,
                       end_hour: int = reg.QUIET_END_HOUR) -> Column:
    """NULL inside the local window, or when there is no record to take a zone from.

    A record whose local time cannot be told (no usable zone, no time of sending) is blocked.
    """
    hour = F.hour("local_ts")
    inside = (hour >= start_hour) & (hour < end_hour)
    return (F.when(F.col("known") & F.col("local_ts").isNull(), F.lit(reg.NO_LOCAL_TIME_REASON))
            .when(F.col("known") & ~inside, filled(
                reg.QUIET_HOURS_REASON, time=F.date_format("local_ts", "HH:mm"),
                zone=F.col("timezone"))))


def evaluated_sends(sends: DataFrame, registry: DataFrame, *,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Adds ``allowed`` and ordered ``reasons`` to every send."""
    return judged_sends(with_contact(sends, registry, rows_per_task=rows_per_task))


def judged_sends(joined: DataFrame) -> DataFrame:
    """As ``evaluated_sends``, for sends that carry their contact's record already."""
    return (with_local_time(joined).withColumn("_why", compact([consent_reason(), quiet_hours_reason()]))
            .withColumn("allowed", F.size("_why") == 0)
            .withColumn("reasons", F.when(F.col("allowed"), F.array(F.lit(reg.CLEARED_REASON)))
                        .otherwise(F.col("_why")))
            .drop("_why"))


def evidence_records(evaluated: DataFrame, evaluated_at: Column) -> DataFrame:
    """Evidence table: the contact appears only as a token."""
    return evaluated.select(
        "seq", short_hash_token("tok_contact_", F.col("contact_id")).alias("contact_token"),
        "campaign",
        F.when(F.col("allowed"), F.lit("ALLOW")).otherwise(F.lit("BLOCK")).alias("decision"),
        "reasons",
        F.lit(reg.CONSENT_CONTROL).alias("control"),
        string_array(reg.CONSENT_EVIDENCE).alias("evidence_for"),
        evaluated_at.alias("evaluated_at"),
    )


def campaign_totals(evaluated: DataFrame) -> DataFrame:
    return evaluated.groupBy("campaign").agg(
        F.count_if("allowed").alias("cleared"), F.count_if(~F.col("allowed")).alias("blocked"),
        F.count(F.lit(1)).alias("total"))
