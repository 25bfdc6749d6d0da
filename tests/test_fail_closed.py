"""What is missing or unknown must block, deny or be reported."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wardline.functions import identity as idn
from wardline.operators import access, consent, governance, incidents, remediation, web

NIGHT = dt.datetime(2026, 6, 22, 3)
NOON = dt.datetime(2026, 6, 22, 17)


def sends(spark, zone, state, when=NOON):
    registry = spark.createDataFrame([(1, "c", zone, state)],
                                     "seq bigint, contact_id string, timezone string, consent string")
    return consent.judged_sends(consent.campaign_sends(
        registry, "x", F.lit(when).cast("timestamp_ntz"))).first()


@pytest.mark.parametrize("zone, state, when, allowed", [
    ("America/New_York", "opted_in", NOON, True), ("America/New_York", "opted_in", NIGHT, False),
    (None, "opted_in", NIGHT, False), (None, "opted_in", NOON, False),
    ("Mars/Base", "opted_in", NOON, False), ("America/New_York", None, NOON, False),
    ("America/New_York", "maybe", NOON, False), ("America/New_York", "opted_in", None, False)])
def test_a_send_needs_a_zone_a_time_and_consent(spark, zone, state, when, allowed):
    row = sends(spark, zone, state, when)
    assert row.allowed is allowed and row.reasons


def test_every_listed_zone_is_known_to_the_engine(spark):
    zones = spark.createDataFrame([(z,) for z in consent.ZONES], "z string")
    local = F.convert_timezone(F.lit("UTC"), F.col("z"), F.lit(NOON).cast("timestamp_ntz"))
    assert zones.filter(local.isNotNull()).count() == len(consent.ZONES) > 300


def test_registry_violations(spark):
    rows = [(1, "a", "UTC", "opted_in"), (2, "b", None, "opted_out"), (3, None, "UTC", "what")]
    contacts = spark.createDataFrame(rows, "seq bigint, contact_id string, timezone string, consent string")
    found = consent.registry_violations(contacts).collect()
    assert sorted((r.seq, r.violation) for r in found) == [
        (2, "unusable time zone: none"), (3, "no contact id"), (3, "unknown consent: what")]


def test_a_table_of_campaigns_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(consent, "MAX_CAMPAIGNS", 2)
    registry = spark.createDataFrame([(1, "c", "UTC", "opted_in")],
                                     "seq bigint, contact_id string, timezone string, consent string")
    campaigns = spark.range(3).select(F.col("id").cast("string").alias("campaign"),
                                      F.lit(NOON).cast("timestamp_ntz").alias("send_ts"))
    with pytest.raises(ValueError):
        consent.table_sends(registry, campaigns)
    two = consent.table_sends(registry, campaigns.limit(2))
    assert sorted(r.campaign for r in consent.judged_sends(two).filter("allowed").collect()) == ["0", "1"]


def test_a_missing_prompt_is_blocked_and_audited(spark):
    schema = ("request_id string, prompt string, actor_chain array<struct<actor:string,role:string,"
              "intent:string>>, destination string, cost_center string, chain_tokens array<string>")
    rows = [("n", None, [], "cursor", "x", None), ("d", "hello", [], None, "x", None)]
    governed = governance.govern(spark.createDataFrame(rows, schema), b"key", F.lit(0))
    audit = {r.request_id: r for r in governance.audit_records(governed, F.lit("t")).collect()}
    assert audit["n"].allowed is False and audit["n"].actions == ["BLOCK"]
    assert audit["d"].allowed is False and audit["d"].actions == ["ROUTE"]
    reasons = governance.decision_rows(spark.createDataFrame(rows, schema)).collect()
    assert all(r.reason for r in reasons)


def test_missing_connector_action_or_principal_is_denied(spark):
    requests = spark.createDataFrame(
        [(1, None, "crm", "read"), (2, "p", None, "read"), (3, "p", "crm", None), (4, "p", "crm", "read")],
        "seq bigint, principal string, connector string, action string")
    grants = spark.createDataFrame([(1, "p", "crm", ["read"])],
                                   "seq bigint, principal string, connector string, scopes array<string>")
    rows = {r.seq: r for r in access.authorized(requests, grants).collect()}
    assert {s: r.allowed for s, r in rows.items()} == {1: False, 2: False, 3: False, 4: True}
    assert all(r.reason and r.audit_reason and r.principal_token for r in rows.values())


def test_responses_without_status_or_headers_are_reported(spark):
    rows = spark.createDataFrame(
        [(1, True, "/admin", 200, None, ""), (2, False, "/admin", None, {}, ""), (3, None, "/admin", 200, {}, "")],
        "seq bigint, authed boolean, endpoint string, status int, headers map<string,string>, body string")
    found = {(r.seq, r.rule) for r in web.finding_rows(rows).collect()}
    assert found == {(1, "missing-security-headers"), (2, "missing-authentication"), (3, "missing-authentication")}


def test_unrated_work_is_not_on_time(spark):
    rows = spark.createDataFrame(
        [(1, "Critical", dt.date(2020, 1, 1), "unassigned", "open"),
         (2, "low", dt.date(2026, 6, 1), "me", "open")],
        "seq bigint, severity string, discovered date, owner string, status string")
    row = remediation.summary(rows, dt.date(2026, 6, 2)).first()
    assert (row.open, row.overdue, row.unrated_open, row.on_time_pct) == (2, 0, 1, 50)


def test_incident_ids_of_a_table_are_distinct(spark):
    detections = spark.range(100_000).select(F.col("id").alias("seq"), F.lit(NOON).cast("timestamp_ntz").alias("ts"))
    ids = incidents.declared(detections).select("incident_id")
    assert ids.distinct().count() == 100_000
    short = incidents.declared(detections.limit(1), id_digits=6).first().incident_id
    assert len(short) == len("INC-") + 6


def test_no_token_without_a_time_and_no_check_without_a_clock(spark):
    key = b"k"
    hops = spark.createDataFrame([("a", "r", "i")], "actor string, role string, intent string")

    def minted(when):
        token = idn.mint(F.col("actor"), F.col("role"), F.col("intent"), F.lit("x"), when, key)
        return hops.select(token.alias("t")).first().t

    assert minted(F.lit(None).cast("bigint")) is None
    body = F.lit(json.dumps({"actor": "a", "role": "r", "exp": None}))
    encoded = idn.base64url(F.encode(body, "UTF-8"))
    unexpiring = hops.select(F.concat(encoded, F.lit("."), idn.sign(encoded, key)).alias("t")).first().t
    year_2096, none = F.lit(4_000_000_000), F.lit(None).cast("bigint")
    for token, clock, error in ((unexpiring, year_2096, "no expiry"), (unexpiring, none, "no expiry"), (minted(F.lit(1000)), none, "no clock"),
                                (minted(F.lit(1000)), year_2096, "expired"), (None, F.lit(1), "bad signature"),
                                (minted(F.lit(1000)), F.lit(1001), None)):
        df = spark.createDataFrame([(token,)], "t string")
        got = df.select(idn.verify(F.col("t"), key, clock).alias("c")).first().c
        assert got.error == error and (got.claims is None) == (error is not None)
        chain = df.select(idn.verify_chain(F.array("t"), key, clock).alias("c")).first().c
        assert chain.verified == (error is None)


def test_work_of_an_unknown_status_is_listed_and_not_on_time(spark):
    rows = [(1, "critical", "reopened"), (2, "critical", None), (3, "low", "remediated"), (4, "odd", "Open")]
    df = spark.createDataFrame([(s, "x", sev, dt.date(2020, 1, 1), "me", st) for s, sev, st in rows],
                               "seq long, id string, severity string, discovered date, owner string, status string")
    today = dt.date(2026, 1, 1)
    total = remediation.summary(df, today).first()
    assert (total.open, total.closed, total.unknown_status, total.overdue, total.on_time_pct) == (0, 1, 3, 2, 0)
    assert [r.seq for r in remediation.worklist(df, today).collect()] == [1, 2, 4]
