"""Prompt governance: classify, decide, verify identity, sanitize, audit, attribute spend.

Input ``requests``: request_id, prompt, actor_chain array<struct<actor,role,intent>>,
destination, cost_center, chain_tokens array<string> (NULL = unsigned). Every step up to
the audit record is a projection; only the spend totals and the vault table aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions import text
from wardline.functions.asof import as_of_join
from wardline.functions.exprs import element_rows, empty_array, filled, lookup, string_array
from wardline.functions.identity import verify_chain

DECISION = "struct<action:string,data_class:string,reason:string>"


# --- classification -----------------------------------------------------------------
def with_detections(requests: DataFrame, column: str = "prompt") -> DataFrame:
    """A missing text has no detections; that it was not checked is for the decisions to say."""
    return requests.withColumn("detections", F.coalesce(
        text.classify(F.col(column)), empty_array(text.DETECTION)))


def detection_rows(requests: DataFrame, detections: Column, key: str = "request_id") -> DataFrame:
    """One row per detection with its 0-based ordinal."""
    return (element_rows(requests, [key], detections, "d", "ordinal")
            .select(key, "ordinal", "d.data_class", "d.snippet", "d.confidence", "d.reason"))


def secret_span_rows(requests: DataFrame) -> DataFrame:
    return (element_rows(requests, ["request_id", "prompt"], text.secret_spans(F.col("prompt")), "s")
            .select("request_id", F.col("s.label").alias("rule"), F.col("s.start").alias("start_pos"),
                    F.col("s.stop").alias("end_pos"),
                    F.substring("prompt", F.col("s.start") + 1, F.col("s.stop") - F.col("s.start"))
                    .alias("match_text")))


def merged_span_rows(requests: DataFrame) -> DataFrame:
    return (element_rows(requests, ["request_id"], text.merged_secret_spans(F.col("prompt")), "s")
            .select("request_id", F.col("s.start").alias("start_pos"),
                    F.col("s.stop").alias("end_pos"),
                    F.array_join("s.labels", " + ").alias("labels")))


def card_candidate_rows(requests: DataFrame) -> DataFrame:
    return (element_rows(requests, ["request_id"], text.card_candidates(F.col("prompt")),
                         "candidate", "ordinal")
            .withColumn("digits", text.ascii_digits(F.col("candidate")))
            .withColumn("luhn_valid", text.is_luhn_valid(F.col("candidate"))))


def value_token_rows(requests: DataFrame) -> DataFrame:
    rows = detection_rows(requests, text.classify(F.col("prompt")))
    return rows.select("request_id", "ordinal", "data_class",
                       text.value_token(F.col("data_class"), F.col("snippet")).alias("token"))


# --- destination and policy ------------------------------------------------------------
def with_destination(requests: DataFrame, tools: Mapping[str, tuple] = reg.TOOLS) -> DataFrame:
    """Data-handling posture of the destination; an unlisted one is unapproved."""
    def flag(position: int) -> Column:
        column = {name: posture[position] for name, posture in tools.items()}
        return F.coalesce(lookup(F.col("destination"), column), F.lit(False))

    return requests.withColumns({"destination_approved": flag(0), "zero_retention": flag(1),
                                 "dpa": flag(2)})


def with_destination_as_of(requests: DataFrame, postures: DataFrame, *, at: str = "asked_at") -> DataFrame:
    """The posture that was valid when a request was made, from a register with versions.

    ``postures`` (destination, valid_from, approved, zero_retention, dpa) may hold any number of tools and versions. A tool is
    unapproved before its first version, and without a time of the request.
    """
    found = as_of_join(requests, postures.select("destination", "valid_from", "approved", "zero_retention", "dpa"),
                       key="destination", at=at, valid_from="valid_from")
    return found.withColumns({
        "destination_approved": F.coalesce("approved", F.lit(False)),
        "zero_retention": F.coalesce("zero_retention", F.lit(False)), "dpa": F.coalesce("dpa", F.lit(False))}).drop("approved")


def _decision(action: str, data_class: Column, reason: Column) -> Column:
    return F.struct(F.lit(action).alias("action"), data_class.cast("string").alias("data_class"),
                    reason.alias("reason"))


def decisions(detections: Column, destination: Column, approved: Column, dpa: Column) -> Column:
    """Ordered policy decisions of one request."""
    none, nothing = F.lit(None), empty_array(DECISION)
    secret = F.lit("secret")
    has_secret = F.exists(detections, lambda d: d["data_class"] == "secret")
    regulated = F.filter(detections, lambda d: d["data_class"].isin(*reg.REDACTED_CLASSES))
    block = F.array(
        _decision("BLOCK", secret, F.lit(reg.BLOCK_REASON)),
        _decision("TICKET", secret, F.lit(reg.TICKET_REASON)))
    redact = F.transform(regulated, lambda d: _decision(
        "REDACT", d["data_class"],
        filled(reg.REDACT_REASON, data_class=d["data_class"])))
    destination = F.coalesce(destination, F.lit(reg.NOT_GIVEN))
    unapproved = _decision("ROUTE", none, filled(reg.UNAPPROVED_REASON, destination=destination))
    uncovered = _decision("ROUTE", none, filled(reg.UNCOVERED_REASON, destination=destination))
    route = (F.when(~approved, F.array(unapproved))
             .when((F.size(regulated) > 0) & ~dpa, F.array(uncovered))
             .otherwise(nothing))
    log = _decision("LOG", none, F.lit(reg.LOG_REASON))
    allow = _decision("ALLOW", none, F.lit(reg.ALLOW_REASON))
    found = F.size(detections) > 0
    closing = (F.when(found, F.array(log))
               .when(approved, F.array(allow))     # nothing found and nothing routed
               .otherwise(nothing))
    return F.concat(F.when(has_secret, block).otherwise(nothing), redact, route, closing)


def with_decisions(requests: DataFrame, tools: Mapping[str, tuple] = reg.TOOLS) -> DataFrame:
    """Adds detections, destination posture and content/destination decisions.

    A request without a prompt is blocked: nothing of it was checked.
    """
    checked = decisions(F.col("detections"), F.col("destination"), F.col("destination_approved"),
                        F.col("dpa"))
    unread = F.array(_decision("BLOCK", F.lit(None), F.lit(reg.NO_PROMPT_REASON)))
    return with_destination(with_detections(requests), tools).withColumn(
        "decisions", F.when(F.col("prompt").isNull(), unread).otherwise(checked))


def decision_rows(requests: DataFrame) -> DataFrame:
    return (element_rows(with_decisions(requests), ["request_id"], F.col("decisions"), "d", "ordinal")
            .select("request_id", "ordinal", "d.action", "d.data_class", "d.reason"))


def rounded_cost(tokens: Column) -> Column:
    """``tokens / 1000 * price`` as a binary float, rounded to 4 places by its exact value.

    Only a float that prints as a tie (``...5`` in the fifth place) needs care: the stored
    number lies a little above or below the tie, and that side decides. The sign of the
    gap comes from splitting the float in halves whose products are exact.
    """
    price = reg.MICRO_USD_PER_TOKEN * 1000 / 1_000_000
    value = tokens.cast("double") / F.lit(1000.0) * F.lit(price)
    micro = tokens * F.lit(reg.MICRO_USD_PER_TOKEN)
    million = F.lit(1_000_000.0)
    nearest = micro.cast("double") / million
    scaled = nearest * F.lit(134_217_729.0)          # 2**27 + 1
    high = scaled - (scaled - nearest)
    gap = (micro.cast("double") - high * million) - (nearest - high) * million
    whole = F.call_function("div", micro, F.lit(100))
    up = (gap < 0) | ((gap == 0) & (whole % 2 == 1))
    tie = (micro % 100 == 50) & (value == nearest)
    settled = (whole + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("double") / F.lit(10_000.0)
    return F.when(tie, settled).otherwise(F.round(value, 4)).cast("decimal(18,4)")


# --- the guardrail ------------------------------------------------------------------------
def with_cost(requests: DataFrame) -> DataFrame:
    """Token estimate and its price, exact in millionths of a dollar and rounded to 4 places."""
    return (requests.withColumn("est_tokens", text.estimated_tokens(F.col("prompt")))
            .withColumns({
                "est_cost_micro_usd": F.col("est_tokens") * F.lit(reg.MICRO_USD_PER_TOKEN),
                "est_cost_usd": rounded_cost(F.col("est_tokens"))}))


def govern(requests: DataFrame, key: bytes, now: Column, *, mode: str = "good",
           tools: Mapping[str, tuple] = reg.TOOLS) -> DataFrame:
    """One result row per request: detections, decisions, safe prompt, vault, verdict."""
    if mode == "bad":
        return pass_through(requests)
    if mode != "good":
        raise ValueError(f"mode must be 'good' or 'bad', not {mode!r}")
    checked = with_decisions(with_cost(requests), tools).withColumn(
        "identity", verify_chain(F.col("chain_tokens"), key, now))
    forged = _decision("BLOCK", F.lit(None), filled(
        reg.FORGED_REASON, reason=F.col("identity.reason")))
    failed = F.col("identity.verified") == F.lit(False)
    actions = F.transform("decisions", lambda d: d["action"])
    return (
        checked
        .withColumn("decisions", F.concat("decisions", F.when(failed, F.array(forged))
                                          .otherwise(empty_array(DECISION))))
        .withColumns({
            "blocked": F.array_contains(actions, "BLOCK"),
            "rerouted": F.array_contains(actions, "ROUTE"),
            "sanitized_prompt": text.sanitize(F.col("prompt"), F.col("detections")),
            "vault": text.vault_entries(F.col("detections")),
        })
        .withColumn("allowed", ~F.col("blocked") & ~F.col("rerouted"))
    )


def pass_through(requests: DataFrame) -> DataFrame:
    """The uncontrolled mode: the raw prompt is allowed and nothing is recorded."""
    uncontrolled = F.array(_decision("ALLOW", F.lit(None), F.lit(reg.PASS_REASON)))
    return with_cost(requests).withColumns({
        "allowed": F.lit(True),
        "detections": empty_array(text.DETECTION),
        "decisions": uncontrolled,
        "sanitized_prompt": F.col("prompt"),
        "vault": empty_array("struct<token:string,value:string>"),
        "audit_note": F.lit(reg.PASS_NOTE),
    })


def audit_records(governed: DataFrame, recorded_at: Column) -> DataFrame:
    """The audit table; raw prompts, values and the vault never enter it."""
    classes = F.transform("detections", lambda d: d["data_class"])
    return governed.select(
        "request_id",
        recorded_at.alias("timestamp"),
        F.transform("actor_chain", lambda h: F.concat(h["role"], F.lit(":"), h["actor"]))
        .alias("actor_chain"),
        F.col("identity.verified").alias("chain_verified"),
        F.col("identity.reason").alias("chain_reason"),
        F.try_element_at("actor_chain", F.lit(-1))["intent"].alias("intent"),
        "destination", "destination_approved",
        F.array_sort(F.array_distinct(classes)).alias("data_classes"),
        F.transform("decisions", lambda d: d["action"]).alias("actions"),
        "allowed",
        F.array_distinct(F.transform("vault", lambda v: v["token"])).alias("tokens_redacted"),
        "est_tokens", "est_cost_micro_usd", "est_cost_usd", "cost_center",
        F.lit(reg.AUDIT_CONTROL).alias("control"),
        string_array(reg.AUDIT_EVIDENCE).alias("evidence_for"),
    )


def vault_rows(requests: DataFrame) -> DataFrame:
    """Per request: each token it introduced and the value behind it."""
    entries = text.vault_entries(F.col("detections"))
    return (element_rows(with_detections(requests), ["request_id"], entries, "v")
            .select("request_id", "v.token", "v.value"))


def governed_vault_rows(governed: DataFrame) -> DataFrame:
    """As ``vault_rows``, of requests that are governed already."""
    return (element_rows(governed, ["request_id"], F.col("vault"), "v")
            .select("request_id", "v.token", "v.value"))


def vault_table(requests: DataFrame) -> DataFrame:
    """The restricted re-identification table, one row per token and value."""
    return vault_rows(requests).select("token", "value").distinct()


def spend_by_cost_center(requests: DataFrame) -> DataFrame:
    spend = with_cost(requests).groupBy("cost_center").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("est_tokens").alias("est_tokens"),
        F.sum("est_cost_micro_usd").alias("est_cost_micro_usd"))
    return spend
