"""The registered queries: one per operator, over the derived views.

Outputs are plain scalars: arrays are exploded or joined into text, timestamps are
formatted, so two engines can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions import text
from wardline.operators import (access, consent, findings, governance, identity, incidents,
                                line_scans, outputs, posture, registers, release, remediation, response,
                                scans, web)
from wardline.plans import views as v
from wardline.session import scratch_path
from wardline.sources import tables
from wardline.sources.tables import read_parquet
from wardline.streaming import expiring, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def now() -> Column:
    return F.lit(v.NOW)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined(column: str, separator: str = ", ") -> Column:
    return F.array_join(column, separator).alias(column)


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


# --- sources and sinks ----------------------------------------------------------------------
@query
def src_1_load_findings(spark, folder):
    path = scratch_path(spark, "findings")
    df = v.load(spark, folder, "findings")
    tables.write_records(df, path)
    return tables.load_findings(spark, path, lines=True, schema="seq bigint, release_id string, "
                                + tables.FINDING_SCHEMA)


@query
def src_2_load_contacts(spark, folder):
    path = scratch_path(spark, "contacts")
    tables.write_records(v.load(spark, folder, "contact_updates"), path)
    contacts = tables.load_contacts(spark, path, lines=True,
                                    schema="seq bigint, " + tables.CONTACT_SCHEMA)
    return consent.consent_registry(contacts).drop("consent_date")


@query
def src_3_load_pentest(spark, folder):
    path = scratch_path(spark, "pentest")
    tables.write_records(v.load(spark, folder, "pentest"), path)
    df = tables.load_pentest(spark, path, lines=True, schema="seq bigint, " + tables.PENTEST_SCHEMA)
    return df.select("seq", "id", "severity", F.col("discovered").cast("string").alias("discovered"),
                     "owner", "status")


@query
def src_4_read_source_files(spark, folder):
    """Writes the corpus as text files, reads them back whole and scans their lines."""
    path = scratch_path(spark, "corpus")
    tables.write_records(v.load(spark, folder, "source").select("content"), path, fmt="text",
                         maxRecordsPerFile=500)
    files = tables.read_source_files(spark, path)
    return (scans.line_finding_rows(files).groupBy("rule", "severity")
            .agg(F.count(F.lit(1)).alias("findings")))


@query
def src_4_file_contents(spark, folder):
    """Writes the corpus as numbered text files and reads each back whole, path and content."""
    path = scratch_path(spark, "numbered")
    corpus = v.load(spark, folder, "source").select(
        "seq", "content", F.call_function("div", F.col("seq"), F.lit(200)).alias("part"))
    (corpus.repartition("part").sortWithinPartitions("part", "seq").select("part", "content")
     .write.partitionBy("part").text(path))
    files = tables.read_source_files(spark, f"{path}/*")
    return files.select(
        F.regexp_extract("path", r"/part=(\d+)/[^/]+$", 1).cast("bigint").alias("part"),
        F.length("content").cast("bigint").alias("length"), F.sha2("content", 256).alias("digest"))


@query
def src_5_write_records(spark, folder):
    path = scratch_path(spark, "records")
    written = tables.write_records(v.load(spark, folder, "findings"), path)
    stored = spark.read.schema(tables.FINDING_SCHEMA).json(path)
    return stored.agg(F.count(F.lit(1)).alias("stored")).withColumn(
        "written", F.lit(written).cast("bigint"))


# --- prompt governance --------------------------------------------------------------------------
def prompts(spark, folder):
    """For the costly text operators; cheap projections read the view as it is."""
    return v.load_spread(spark, folder, "requests")


def _requests(spark, folder):
    return v.load(spark, folder, "requests")


@query
def gov_1_secret_spans(spark, folder):
    return governance.secret_span_rows(prompts(spark, folder))


@query
def gov_2_merged_spans(spark, folder):
    return governance.merged_span_rows(prompts(spark, folder))


def _detections(spark, folder, expression):
    rows = governance.detection_rows(prompts(spark, folder), expression)
    return rows.select("request_id", "ordinal", "snippet", "reason")


@query
def gov_3_secret_detections(spark, folder):
    return _detections(spark, folder, text.secret_detections(F.col("prompt")))


@query
def gov_4_luhn(spark, folder):
    return governance.card_candidate_rows(prompts(spark, folder))


@query
def gov_5_card_detections(spark, folder):
    return _detections(spark, folder, text.card_detections(F.col("prompt")))


@query
def gov_6_ssn_detections(spark, folder):
    return _detections(spark, folder, text.ssn_detections(F.col("prompt")))


@query
def gov_7_sensitive_terms(spark, folder):
    return _detections(spark, folder, text.first_match_detections(F.col("prompt"), "sensitive"))


@query
def gov_8_customer_terms(spark, folder):
    return _detections(spark, folder, text.first_match_detections(F.col("prompt"), "customer"))


@query
def gov_9_production_logs(spark, folder):
    return _detections(spark, folder, text.first_match_detections(F.col("prompt"), "prod_log"))


@query
def gov_10_source_code(spark, folder):
    return _detections(spark, folder, text.first_match_detections(F.col("prompt"), "source_code"))


@query
def gov_11_classification(spark, folder):
    return governance.detection_rows(prompts(spark, folder), text.classify(F.col("prompt")))


@query
def gov_12_cost_estimate(spark, folder):
    return governance.with_cost(_requests(spark, folder)).select(
        "request_id", "est_tokens", "est_cost_micro_usd",
        F.col("est_cost_usd").cast("string").alias("est_cost_usd"))


@query
def gov_13_pass_through(spark, folder):
    df = governance.govern(_requests(spark, folder), v.SIGNING_KEY, now(), mode="bad")
    return df.select("request_id", "allowed", "sanitized_prompt",
                     F.size("detections").alias("detections"),
                     F.col("decisions")[0]["reason"].alias("decision_reason"),
                     F.size("vault").alias("vault"), "audit_note", "est_tokens")


@query
def gov_14_value_tokens(spark, folder):
    return governance.value_token_rows(prompts(spark, folder))


@query
def gov_15_destinations(spark, folder):
    return governance.with_destination(_requests(spark, folder)).select(
        "request_id", "destination", "destination_approved", "zero_retention", "dpa")


@query
def gov_15_destinations_as_of(spark, folder):
    """By a register with versions; the number of a request stands for its time, which some lack."""
    asked = _requests(spark, folder).withColumn("asked_at", F.when(F.col("seq") % 71 != 4, F.col("seq")))
    return governance.with_destination_as_of(asked, v.load(spark, folder, "postures")).select(
        "request_id", "destination", "destination_approved", "zero_retention", "dpa")


@query
def gov_16_decisions(spark, folder):
    return governance.decision_rows(prompts(spark, folder))


@query
def gov_17_sanitized_prompts(spark, folder):
    df = governance.with_detections(prompts(spark, folder))
    return df.select("request_id", text.sanitize(F.col("prompt"), F.col("detections"))
                     .alias("sanitized_prompt"))


@query
def gov_18_vault(spark, folder):
    return governance.vault_rows(prompts(spark, folder))


@query
def gov_18_vault_table(spark, folder):
    return governance.vault_table(prompts(spark, folder))


def governed(spark, folder):
    return governance.govern(v.requests(spark, folder), v.SIGNING_KEY, v.clock())


@query
def gov_19_verdicts(spark, folder):
    return governed(spark, folder).select("request_id", "blocked", "rerouted", "allowed")


@query
def gov_20_audit_records(spark, folder):
    df = governance.audit_records(governed(spark, folder), F.lit(v.RECORDED_AT))
    return df.select(
        "request_id", "timestamp", joined("actor_chain", " > "), "chain_verified", "chain_reason",
        "intent", "destination", "destination_approved", joined("data_classes"),
        joined("actions"), "allowed", joined("tokens_redacted"), "est_tokens",
        "est_cost_micro_usd", F.col("est_cost_usd").cast("string").alias("est_cost_usd"),
        "cost_center", "control", joined("evidence_for"))


@query
def gov_21_spend(spark, folder):
    return governance.spend_by_cost_center(_requests(spark, folder))


# --- signed identity ---------------------------------------------------------------------------------
def _minted(spark, folder):
    return identity.with_minted_chain(v.chains(spark, folder), v.issue_time(), v.SIGNING_KEY)


@query
def idn_1_signatures(spark, folder):
    return identity.signature_rows(identity.token_rows(_minted(spark, folder)), v.SIGNING_KEY)


@query
def idn_2_minted_tokens(spark, folder):
    return identity.token_rows(_minted(spark, folder))


@query
def idn_3_verified_tokens(spark, folder):
    tokens = identity.token_rows(v.with_tokens(v.chains(spark, folder)))
    return identity.verified_token_rows(tokens, v.SIGNING_KEY, v.clock())


@query
def idn_4_audiences(spark, folder):
    return identity.audience_rows(v.chains(spark, folder))


@query
def idn_5_verified_chains(spark, folder):
    chains = v.with_tokens(v.chains(spark, folder))
    return identity.verified_chain_rows(chains, v.SIGNING_KEY, v.clock()).select(
        "seq", "verified", joined("chain"), "reason")


def _token_log(spark, folder):
    """The tokens of all chains as rows, and the requests they belong to."""
    chains = v.with_tokens(v.chains(spark, folder))
    return chains, identity.checked_log(identity.token_rows(chains), v.SIGNING_KEY, v.clock())


@query
def idn_5_log_verdicts(spark, folder):
    chains, checked = _token_log(spark, folder)
    return identity.log_verdicts(checked, chains)


@query
def idn_5_log_chains(spark, folder):
    _, checked = _token_log(spark, folder)
    return identity.log_chain_rows(checked, identity.log_verdicts(checked))


# --- model input and output -----------------------------------------------------------------------------
def _turns(spark, folder, role):
    return v.load_spread(spark, folder, "turns").filter(F.col("role") == role)


@query
def red_1_injections(spark, folder):
    return outputs.injection_rows(_turns(spark, folder, "user"))


@query
def red_2_data_leaks(spark, folder):
    return _turns(spark, folder, "assistant").select("seq", outputs.leaks_data(F.col("text"))
                                                     .alias("leaks"))


@query
def red_3_revealed_instructions(spark, folder):
    return _turns(spark, folder, "assistant").select(
        "seq", outputs.reveals_instructions(F.col("text")).alias("reveals"))


@query
def red_4_unauthorized_tools(spark, folder):
    return outputs.unauthorized_tool_rows(_turns(spark, folder, "assistant"), v.ALLOWED_TOOLS)


def _verdicts(spark, folder, allowed_tools):
    df = outputs.output_verdicts(_turns(spark, folder, "assistant"), allowed_tools)
    return df.select("seq", "allowed", joined("reasons", " | "))


@query
def red_5_verdicts(spark, folder):
    return _verdicts(spark, folder, v.ALLOWED_TOOLS)


@query
def red_5_verdicts_any_tool(spark, folder):
    return _verdicts(spark, folder, None)


# --- consent ---------------------------------------------------------------------------------------------------
def _contacts(spark, folder):
    contacts = v.load(spark, folder, "contacts")
    return consent.consent_registry(contacts.select("seq", "contact_id", "timezone", "consent"))


def _sends(spark, folder):
    return v.load(spark, folder, "sends")


def _evaluated(spark, folder):
    return consent.evaluated_sends(_sends(spark, folder), _contacts(spark, folder))


@query
def con_1_consent_status(spark, folder):
    df = consent.with_contact(_sends(spark, folder), _contacts(spark, folder))
    return df.select("seq", "known", consent.consent_reason().alias("reason"))


@query
def con_2_quiet_hours(spark, folder):
    df = consent.with_local_time(
        consent.with_contact(_sends(spark, folder), _contacts(spark, folder)))
    return df.select("seq", F.date_format("local_ts", "yyyy-MM-dd HH:mm").alias("local_time"),
                     consent.quiet_hours_reason().alias("reason"))


@query
def con_3_send_decisions(spark, folder):
    return _evaluated(spark, folder).select("seq", "allowed", joined("reasons", " | "))


@query
def con_4_evidence(spark, folder):
    df = consent.evidence_records(_evaluated(spark, folder), F.lit(v.RECORDED_AT))
    return df.select("seq", "contact_token", "campaign", "decision", joined("reasons", " | "),
                     "control", joined("evidence_for"), "evaluated_at")


@query
def con_5_campaign_totals(spark, folder):
    return consent.campaign_totals(_evaluated(spark, folder))


@query
def con_6_campaign_fan_out(spark, folder):
    registry = _contacts(spark, folder)
    sends = consent.campaign_sends(registry, "Brand_X_Outreach",
                                   F.lit("2026-06-22 13:00:00").cast("timestamp_ntz"))
    return consent.judged_sends(sends).select(
        "seq", "contact_id", "campaign", stamp("send_ts"), "allowed")


@query
def con_6_campaign_table(spark, folder):
    """Every campaign of a table to every contact; the campaigns are the regions' names."""
    hours = F.make_dt_interval(hours=F.col("r_regionkey").cast("int") * 5)
    campaigns = read_parquet(spark, folder, "region").select(
        F.col("r_name").alias("campaign"),
        (F.lit("2026-06-22 03:00:00").cast("timestamp_ntz") + hours).alias("send_ts"))
    sends = consent.table_sends(_contacts(spark, folder), campaigns)
    return consent.judged_sends(sends).select(
        "seq", "contact_id", "campaign", stamp("send_ts"), "allowed")


@query
def con_7_registry_violations(spark, folder):
    return consent.registry_violations(v.load(spark, folder, "contacts"))


# --- triage ------------------------------------------------------------------------------------------------------
def _findings(spark, folder):
    return v.load(spark, folder, "findings")


@query
def tri_1_risk_scores(spark, folder):
    return _findings(spark, folder).select("seq", "id", findings.risk_score().alias("risk_score"))


@query
def tri_2_factors(spark, folder):
    return _findings(spark, folder).select("seq", findings.factors().alias("factors")).select(
        "seq", joined("factors"))


@query
def tri_3_attack_paths(spark, folder):
    return _findings(spark, folder).filter(findings.is_attack_path()).select("seq", "id", "owner")


@query
def tri_4_risk_bands(spark, folder):
    return _findings(spark, folder).select(
        "seq", findings.risk_band(findings.risk_score()).alias("risk_band"))


@query
def tri_5_vendor_order(spark, folder):
    return findings.vendor_ranked(_findings(spark, folder)).select(
        "seq", "id", "vendor_severity", "position")


@query
def tri_6_risk_order(spark, folder):
    return findings.risk_ranked(_findings(spark, folder)).select("seq", "id", "position")


@query
def tri_7_deduped(spark, folder):
    return findings.deduped(_findings(spark, folder).select(
        "seq", "id", "title", "resource", "vendor_severity", "owner"))


@query
def tri_8_top_queue(spark, folder):
    return findings.top_queue(_findings(spark, folder), v.QUEUE_LENGTH).select(
        "position", "id", "label", "risk_score", "owner", joined("factors"))


@query
def tri_9_totals(spark, folder):
    return findings.totals(_findings(spark, folder))


# --- remediation ------------------------------------------------------------------------------------------------------
def _tracked(spark, folder):
    return remediation.tracked(v.load(spark, folder, "pentest"), v.PENTEST_TODAY)


@query
def pen_1_due_dates(spark, folder):
    return _tracked(spark, folder).select("seq", "id", F.col("sla_due").cast("string").alias("sla_due"))


@query
def pen_1_due_dates_as_of(spark, folder):
    df = remediation.with_due_dates_as_of(v.load(spark, folder, "pentest"), v.load(spark, folder, "deadlines"))
    return df.select("seq", "id", F.col("sla_due").cast("string").alias("sla_due"))


@query
def pen_2_overdue(spark, folder):
    return _tracked(spark, folder).select("seq", "id", "overdue")


@query
def pen_3_days_left(spark, folder):
    return _tracked(spark, folder).select("seq", "id", "days_left")


@query
def pen_4_summary(spark, folder):
    return remediation.summary(v.load(spark, folder, "pentest"), v.PENTEST_TODAY)


@query
def pen_5_worklist(spark, folder):
    df = remediation.ranked_worklist(v.load(spark, folder, "pentest"), v.PENTEST_TODAY)
    return df.select("position", "seq", "id", "overdue", "days_left")


# --- release gate ---------------------------------------------------------------------------------------------------------
def _candidates(spark, folder):
    return release.candidates(_findings(spark, folder))


def _judged(spark, folder):
    return release.judged(_candidates(spark, folder), v.load(spark, folder, "exceptions"),
                          v.GATE_DATE)


@query
def rel_1_candidates(spark, folder):
    return _candidates(spark, folder)


@query
def rel_2_blocking(spark, folder):
    return _candidates(spark, folder).filter(release.is_blocking()).select("release_id", "id")


@query
def rel_3_valid_exceptions(spark, folder):
    return release.valid_exceptions(v.load(spark, folder, "exceptions"), v.GATE_DATE)


@query
def rel_4_accepted_or_blocker(spark, folder):
    return _judged(spark, folder).select("seq", "release_id", "id", "accepted")


@query
def rel_5_gate(spark, folder):
    return release.gate(_judged(spark, folder), v.load(spark, folder, "releases"))


@query
def rel_5_gate_lists(spark, folder):
    return release.gate_lists(_judged(spark, folder))


# --- connector access -------------------------------------------------------------------------------------------------------
def _access(spark, folder):
    return v.load(spark, folder, "access")


def _grants(spark, folder):
    return v.grants_of(v.load(spark, folder, "grants"))


def _history(spark, folder):
    return _access(spark, folder).filter(
        F.col("ts") < F.lit(v.HISTORY_BEFORE).cast("timestamp_ntz"))


def _authorized(spark, folder):
    return access.authorized(_access(spark, folder), _grants(spark, folder),
                             _history(spark, folder))


@query
def aut_1_registry_check(spark, folder):
    return _access(spark, folder).select(
        "seq", access.known_connector().alias("known_connector"),
        access.valid_scope().alias("valid_scope"), access.registry_error().alias("error"))


@query
def aut_2_first_grants(spark, folder):
    return access.first_grants(_grants(spark, folder)).select(
        "principal", "connector", joined("scopes"))


@query
def aut_3_decisions(spark, folder):
    return _authorized(spark, folder).select("seq", "allowed", "reason")


@query
def aut_4_high_risk(spark, folder):
    return _access(spark, folder).select("seq", access.is_high_risk().alias("high_risk"))


@query
def aut_5_first_time_access(spark, folder):
    return _authorized(spark, folder).select("seq", "anomalous")


@query
def aut_6_audit_records(spark, folder):
    df = access.audit_records(_authorized(spark, folder))
    return df.withColumn("evidence_for", F.array_join("evidence_for", ", "))


# --- detection response -------------------------------------------------------------------------------------------------------
def _detected(spark, folder):
    return v.load(spark, folder, "detections")


@query
def rsp_1_matched_rules(spark, folder):
    df = response.with_defaults(_detected(spark, folder))
    return df.select("seq", response.matched_rule().alias("rule_no"),
                     F.array_join(response.destructive_actions(), ", ").alias("actions"))


def _probed(spark, folder):
    """Detections, and probes whose types only rules of the table know."""
    return _detected(spark, folder).select("seq", "type", "severity", "resource").unionByName(
        v.load(spark, folder, "probes").withColumn("seq", F.col("seq") + 1_000_000_000))


@query
def rsp_1_rule_table(spark, folder):
    df = response.with_rules(response.with_defaults(_probed(spark, folder)), v.response_rules(spark, folder))
    return df.select("seq", "rule_no", joined("actions"))


@query
def rsp_2_rule_table_plans(spark, folder):
    return response.plan_rows(_probed(spark, folder), rules=v.response_rules(spark, folder))


@query
def rsp_2_plans(spark, folder):
    return response.plan_rows(_detected(spark, folder))


@query
def rsp_3_defaults(spark, folder):
    return response.with_defaults(_detected(spark, folder)).select(
        "seq", "type", "severity", "resource")


@query
def rsp_4_destructive(spark, folder):
    return response.with_plan(_detected(spark, folder)).select(
        "seq", response.took_destructive_action().alias("destructive"))


# --- configuration ---------------------------------------------------------------------------------------------------------------
def _accounts(spark, folder):
    return v.accounts_of(v.load(spark, folder, "accounts"))


@query
def cfg_1_compliance(spark, folder):
    return posture.evaluated(_accounts(spark, folder))


@query
def cfg_2_noncompliant(spark, folder):
    return posture.noncompliant(_accounts(spark, folder))


@query
def cfg_3_unknown_threats(spark, folder):
    known = [t[0] for t in reg.THREATS]
    return posture.unknown_threat_policies(v.policies(spark, folder), known).select(
        "account_id", "policy_id", "prevents")


@query
def cfg_4_repeated_state_keys(spark, folder):
    return posture.repeated_state_keys(v.account_rules(spark, folder))


# --- source scan --------------------------------------------------------------------------------------------------------------------
def _files(spark, folder):
    return v.load_spread(spark, folder, "source")


@query
def scn_1_line_findings(spark, folder):
    return scans.line_finding_rows(_files(spark, folder))


@query
def scn_2_open_routes(spark, folder):
    return scans.open_route_rows(_files(spark, folder))


@query
def scn_3_scan(spark, folder):
    return scans.finding_rows(_files(spark, folder))


@query
def scn_4_file_summaries(spark, folder):
    return scans.summaries(_files(spark, folder))


@query
def scn_5_gate(spark, folder):
    return scans.gates(_files(spark, folder))


@query
def scn_5_corpus_gate(spark, folder):
    return scans.corpus_gate(_files(spark, folder))


def _large_files(spark, folder):
    """The corpus in files of 200 texts, each text ending its last line."""
    path = scratch_path(spark, "large-files")
    corpus = v.load(spark, folder, "source").select(
        "seq", "content", F.call_function("div", F.col("seq"), F.lit(200)).alias("part"))
    (corpus.repartition("part").sortWithinPartitions("part", "seq").select("part", "content")
     .write.partitionBy("part").text(path))
    return f"{path}/*"


def _by_part(rows):
    part = F.regexp_extract("path", r"/part=(\d+)/[^/]+$", 1).cast("bigint")
    return rows.select(part.alias("part"), *[c for c in rows.columns if c != "path"])


@query
def scn_3_line_scan(spark, folder):
    """Writes the corpus as large text files and scans them by lines, in as many splits as Spark makes."""
    lines = tables.read_source_lines(spark, _large_files(spark, folder))
    return _by_part(line_scans.finding_rows(lines))


@query
def scn_4_line_summaries(spark, folder):
    path = _large_files(spark, folder)
    found = line_scans.finding_rows(tables.read_source_lines(spark, path))
    return _by_part(line_scans.summaries(found, tables.list_source_files(spark, path)))


# --- http responses --------------------------------------------------------------------------------------------------------------------
def _http(spark, folder):
    return v.http_of(v.load(spark, folder, "http"))


@query
def web_1_missing_authentication(spark, folder):
    return web.finding_rows(_http(spark, folder), [web.missing_authentication])


@query
def web_2_missing_headers(spark, folder):
    return web.finding_rows(_http(spark, folder), [web.missing_security_headers])


@query
def web_3_error_leakage(spark, folder):
    return web.finding_rows(_http(spark, folder), [web.error_leakage])


@query
def web_4_findings(spark, folder):
    return web.finding_rows(_http(spark, folder))


@query
def web_4_summary(spark, folder):
    return web.summary(_http(spark, folder))


# --- registers and incidents ----------------------------------------------------------------------------------------------------------------
@query
def reg_1_threat_coverage(spark, folder):
    return registers.threat_coverage(v.threats(spark, folder))


@query
def reg_1_coverage_rows(spark, folder):
    return registers.coverage_rows(v.threats(spark, folder), v.coverage_register(spark))


@query
def reg_3_controls_not_in_register(spark, folder):
    return registers.unknown_references(v.threats(spark, folder), v.known_controls(spark), "control", "name").select(
        "org_id", "threat_id", "control")


@query
def cfg_3_threats_not_in_register(spark, folder):
    """Policies of accounts that name a threat which no organisation's register holds."""
    known = v.threats(spark, folder).select("threat_id")
    return registers.unknown_references(v.policies(spark, folder), known, "prevents", "threat_id").select(
        "account_id", "policy_id", "prevents")


@query
def reg_2_open_gaps(spark, folder):
    return registers.open_gaps(v.threats(spark, folder)).select(
        "org_id", "threat_id", "stride", "component", "description", "control", "status")


@query
def reg_3_unknown_controls(spark, folder):
    return registers.unknown_controls(v.threats(spark, folder)).select(
        "org_id", "threat_id", "control")


@query
def reg_4_missing_stride(spark, folder):
    return registers.missing_stride_classes(v.threats(spark, folder))


@query
def reg_5_violations(spark, folder):
    return registers.violations(v.threats(spark, folder))


@query
def reg_6_control_coverage(spark, folder):
    return registers.control_coverage(v.controls(spark, folder))


@query
def reg_7_evidence_map(spark, folder):
    return registers.evidence_map(v.controls(spark, folder))


def _incidents(spark, folder):
    return incidents.declared(_detected(spark, folder))


@query
def inc_1_timelines(spark, folder):
    return incidents.timeline_rows(_incidents(spark, folder)).select(
        "seq", "incident_id", "step_no", stamp("at"), "actor", "action", "evidence")


@query
def inc_2_records(spark, folder):
    df = incidents.records(incidents.declared(v.load_spread(spark, folder, "detections")))
    steps = F.transform("timeline", lambda t: F.concat_ws(
        " | ", t["at"], t["actor"], t["action"], t["evidence"]))
    roles = F.transform(F.map_entries("roles"), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return df.select("seq", "id", "title", "severity", "severity_meaning", "declared_at", "status",
                     F.array_join(roles, "; ").alias("roles"),
                     F.array_join(steps, "; ").alias("timeline"),
                     joined("postmortem_actions", "; "), joined("evidence_for"))


# --- streaming ----------------------------------------------------------------------------------------------------------------------------------
def _guardrail_stream(spark, folder):
    """The three tables of the guardrail, from one classification of each request."""
    def transform(batch: DataFrame) -> DataFrame:
        requests = v.with_tokens(v.with_chain(
            v.from_table(batch.sparkSession, "requests", batch)))
        # what no table holds is not carried to them, the raw prompt least of all
        return governance.govern(requests, v.SIGNING_KEY, v.clock()).drop("seq", "prompt", "chain_tokens")

    return streams.run_to_sinks(
        spark, streams.parquet_stream(spark, f"{folder}/documents.parquet"), transform, {
            "audit": lambda df: governance.audit_records(df, F.lit(v.RECORDED_AT)),
            "sanitized": lambda df: df.select("request_id", "sanitized_prompt"),
            "vault": governance.governed_vault_rows}, "guardrail")


@query
def str_1_guardrail_stream(spark, folder):
    return _guardrail_stream(spark, folder)["audit"].select(
        "request_id", joined("data_classes"), joined("actions"), "allowed",
        "chain_verified", "est_tokens", "cost_center")


@query
def str_1_sanitized_stream(spark, folder):
    return _guardrail_stream(spark, folder)["sanitized"]


@query
def str_1_vault_stream(spark, folder):
    return _guardrail_stream(spark, folder)["vault"]


@query
def str_2_response_stream(spark, folder):
    def transform(batch: DataFrame) -> DataFrame:
        return response.plan_rows(v.from_table(spark, "detections", batch))

    return streams.run_to_end(
        spark, streams.parquet_stream(spark, f"{folder}/events.parquet"), transform, "responses")


@query
def str_3_first_seen_stream(spark, folder):
    cut = F.lit(v.HISTORY_BEFORE).cast("timestamp_ntz")
    events = streams.parquet_stream(spark, f"{folder}/events.parquet").filter(F.col("ts") >= cut)
    accesses = v.from_table(spark, "access", events)
    return streams.first_seen(spark, accesses, _history(spark, folder)).select(
        "seq", "principal", "connector")


@query
def str_3_expiring_stream(spark, folder):
    """As above with a state that keeps a pair for thirty days."""
    cut = F.lit(v.HISTORY_BEFORE).cast("timestamp_ntz")
    events = streams.parquet_stream(spark, f"{folder}/events.parquet").filter(F.col("ts") >= cut)
    return expiring.first_seen(spark, v.from_table(spark, "access", events), _history(spark, folder),
                               keep=dt.timedelta(days=30)).select("seq", "principal", "connector")
