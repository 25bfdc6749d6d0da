"""The same results as the registered queries, as plain SQL over the benchmark tables.

Written on its own: positions, merges, folds and chains are set operations here, not
translations of the column expressions. Streaming queries are compared to their batch twin.
"""

from __future__ import annotations

from string import Formatter

from wardline import registries as reg
from wardline.functions.identity import hmac_pads
from wardline.plans import views as v

ORACLE_SQL: dict[str, str] = {}


def text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def scalar(value: object) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, (int, float)) else text(value)


def values(names, rows) -> str:
    body = ", ".join("(" + ", ".join(scalar(x) for x in row) + ")" for row in rows)
    return f"(VALUES {body}) AS r({', '.join(names)})"


def regex(pattern: str, ignore_case: bool = False) -> str:
    return text(("(?i)" if ignore_case else "") + pattern)


def fill(template: str, **parts: str) -> str:
    """A fixed text with SQL expressions in the places that its braces name."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        pieces += [text(literal)] if literal else []
        pieces += [parts[name]] if name else []
    return " || ".join(pieces)


def view(name: str) -> str:
    return f"({v.sql_of(name)})"


def add(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


def case_of(column: str, table: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {scalar(k)} THEN {scalar(x)}" for k, x in table.items())
    return f"CASE {column} {whens} ELSE {default} END"


# --- sources ------------------------------------------------------------------------------------
add("src_1_load_findings", f"SELECT * FROM {view('findings')}")
add("src_2_load_contacts", f"""
SELECT contact_id, seq, name, timezone, consent FROM {view('contact_updates')}
QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY seq DESC) = 1""")
add("src_3_load_pentest", f"""
SELECT seq, id, severity, CAST(discovered AS VARCHAR) AS discovered, owner, coalesce(status, 'open') AS status
FROM {view('pentest')}""")
add("src_5_write_records", f"SELECT count(*) AS stored, count(*) AS written FROM {view('findings')}")

# --- detections ------------------------------------------------------------------------------------
_SPANS = "\nUNION ALL ".join(f"""
SELECT request_id, prompt, {text(label)} AS rule, hit AS match_text,
  CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS INTEGER) AS start_pos
FROM (SELECT *, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i
  FROM (SELECT request_id, prompt, regexp_extract_all(prompt, {regex(p, i)}, 0) AS hits,
    string_split_regex(prompt, {regex(p, i)}) AS gaps FROM req))""" for label, p, i, _ in reg.SECRET_RULES)


# \\b knows ASCII only here, so letters of all scripts become one ASCII letter for the
# number patterns, which look at nothing but digits, separators and word boundaries
_PLAIN = r"regexp_replace(prompt, '\p{L}', 'x', 'g')"


def detections_with(source: str, key: str = "request_id", column: str = "prompt") -> str:
    """Common table expressions from ``req`` to ``det`` (all detections with their ordinal)."""
    first = []
    for rank, (name, pattern, ignore_case, cut, reason) in enumerate((
            ("sensitive", reg.SENSITIVE_PATTERN, True, None,
             reg.FIRST_MATCH_REASONS["sensitive"]),
            ("customer", reg.CUSTOMER_PATTERN, True, None, reg.FIRST_MATCH_REASONS["customer"]),
            ("prod_log", reg.PROD_LOG_PATTERN, True, 40, reg.FIRST_MATCH_REASONS["prod_log"]),
            ("source_code", reg.SOURCE_CODE_PATTERN, False, 40, reg.FIRST_MATCH_REASONS["source_code"])), start=3):
        snippet = f"regexp_extract(prompt, {regex(pattern, ignore_case)}, 0)"
        if cut:
            snippet = f"substr({snippet}, 1, {cut})"
        first.append(f"""SELECT request_id, {rank} AS part, 1 AS nth, {text(name)} AS data_class,
  {snippet} AS snippet, 'medium' AS confidence, {text(reason)} AS reason FROM req
  WHERE regexp_matches(prompt, {regex(pattern, ignore_case)})""")
    first_sql = "\nUNION ALL ".join(first)
    return f"""
WITH req AS (SELECT {key} AS request_id, {column} AS prompt, * EXCLUDE ({key}, {column}) FROM {source}),
spans AS ({_SPANS}),
marked AS (SELECT *, start_pos + length(match_text) AS end_pos,
  max(start_pos + length(match_text)) OVER (PARTITION BY request_id
    ORDER BY start_pos, start_pos + length(match_text), rule
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
islands AS (SELECT *, sum(CASE WHEN reach >= start_pos THEN 0 ELSE 1 END) OVER (
  PARTITION BY request_id ORDER BY start_pos, end_pos, rule) AS island,
  row_number() OVER (PARTITION BY request_id ORDER BY start_pos, end_pos, rule) AS nth FROM marked),
labels AS (SELECT request_id, island, rule, min(nth) AS nth, min(start_pos) AS s, max(end_pos) AS e
  FROM islands GROUP BY request_id, island, rule),
merged AS (SELECT request_id, island, min(s) AS start_pos, max(e) AS end_pos,
  string_agg(rule, ' + ' ORDER BY nth) AS labels FROM labels GROUP BY request_id, island),
cards AS (SELECT request_id, unnest(c) AS candidate, generate_subscripts(c, 1) AS nth
  FROM (SELECT request_id, regexp_extract_all({_PLAIN}, {regex(reg.CARD_PATTERN)}, 0) AS c FROM req)),
digits AS (SELECT *, regexp_replace(candidate, '[^0-9]', '', 'g') AS digits FROM cards),
luhn AS (SELECT *, length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(
    range(1, length(digits) + 1), lambda k: CASE
      WHEN k % 2 = 1 THEN CAST(substr(reverse(digits), k, 1) AS INTEGER)
      WHEN CAST(substr(reverse(digits), k, 1) AS INTEGER) > 4
        THEN CAST(substr(reverse(digits), k, 1) AS INTEGER) * 2 - 9
      ELSE CAST(substr(reverse(digits), k, 1) AS INTEGER) * 2 END)) % 10 = 0 AS luhn_valid FROM digits),
found AS (
SELECT m.request_id, 0 AS part, m.island AS nth, 'secret' AS data_class,
  substr(prompt, start_pos + 1, end_pos - start_pos) AS snippet, 'high' AS confidence,
  {fill(reg.SECRET_REASON, labels='labels')} AS reason FROM merged m JOIN req USING (request_id)
UNION ALL SELECT request_id, 1, nth, 'pii', trim(candidate), 'high', {text(reg.CARD_REASON)}
  FROM luhn WHERE luhn_valid
UNION ALL SELECT request_id, 2, generate_subscripts(h, 1), 'pii', unnest(h), 'high', {text(reg.SSN_REASON)}
  FROM (SELECT request_id, regexp_extract_all({_PLAIN}, {regex(reg.SSN_PATTERN)}, 0) AS h FROM req)
UNION ALL {first_sql}),
det AS (SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY part, nth) - 1 AS INTEGER)
  AS ordinal, part, data_class, snippet, confidence, reason FROM found)"""


_REQ = view("requests")
_DET = detections_with(_REQ)
_TOK = ("'tok_' || data_class || '_' || substr(sha256(data_class || ':' || snippet), 1, 8)")

add("gov_1_secret_spans", f"""{_DET}
SELECT request_id, rule, start_pos, CAST(end_pos AS INTEGER) AS end_pos, match_text FROM marked""")
add("gov_2_merged_spans", f"""{_DET}
SELECT request_id, start_pos, CAST(end_pos AS INTEGER) AS end_pos, labels FROM merged""")


def part(name: str, part_no: int) -> None:
    add(name, f"""{_DET}
SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ordinal) - 1 AS INTEGER) AS ordinal,
  snippet, reason FROM det WHERE part = {part_no}""")


part("gov_3_secret_detections", 0)
add("gov_4_luhn", f"""{_DET}
SELECT request_id, CAST(nth - 1 AS INTEGER) AS ordinal, candidate, digits, luhn_valid FROM luhn""")
part("gov_5_card_detections", 1)
part("gov_6_ssn_detections", 2)
part("gov_7_sensitive_terms", 3)
part("gov_8_customer_terms", 4)
part("gov_9_production_logs", 5)
part("gov_10_source_code", 6)
add("gov_11_classification", f"""{_DET}
SELECT request_id, ordinal, data_class, snippet, confidence, reason FROM det""")
_TOKENS = "greatest(1, length(prompt) // 4)"
# the float written out in full: the digits after the fourth place decide, compared as text
_COST = f"""list_transform([format('{{:.90f}}', {_TOKENS}::DOUBLE / 1000::DOUBLE * 0.015::DOUBLE)], lambda d:
  CAST(CAST(CAST(replace(substr(d, 1, length(d) - 86), '.', '') AS BIGINT)
    + CASE WHEN right(d, 86) > '5' || repeat('0', 85) OR (right(d, 86) = '5' || repeat('0', 85)
        AND CAST(substr(d, length(d) - 86, 1) AS INTEGER) % 2 = 1) THEN 1 ELSE 0 END
    AS DECIMAL(18, 0)) / 10000 AS DECIMAL(18, 4))::VARCHAR)[1]"""
add("gov_12_cost_estimate", f"""
SELECT request_id, {_TOKENS} AS est_tokens, {_TOKENS} * 15 AS est_cost_micro_usd,
  {_COST} AS est_cost_usd FROM {_REQ}""")
add("gov_13_pass_through", f"""
SELECT request_id, true AS allowed, prompt AS sanitized_prompt, 0 AS detections,
  'no control plane' AS decision_reason, 0 AS vault,
  'no audit emitted in bad state' AS audit_note, {_TOKENS} AS est_tokens FROM {_REQ}""")
add("gov_14_value_tokens", f"""{_DET}
SELECT request_id, ordinal, data_class, {_TOK} AS token FROM det""")
_POSTURE = ", ".join(
    f"{case_of('destination', {n: p[i] for n, p in reg.TOOLS.items()}, 'false')} AS {name}"
    for i, name in enumerate(("destination_approved", "zero_retention", "dpa")))
add("gov_15_destinations", f"SELECT request_id, destination, {_POSTURE} FROM {_REQ}")

add("gov_15_destinations_as_of", f"""
SELECT request_id, r.destination, coalesce(approved, false) AS destination_approved,
  coalesce(zero_retention, false) AS zero_retention, coalesce(dpa, false) AS dpa
FROM (SELECT *, CASE WHEN seq % 71 <> 4 THEN seq END AS asked_at FROM {_REQ}) r
LEFT JOIN {view('postures')} p ON p.destination = r.destination AND p.valid_from <= r.asked_at
QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY valid_from DESC NULLS LAST) = 1""")

_DECIDED = f"""{_DET},
posture AS (SELECT *, {_POSTURE} FROM req),
facts AS (SELECT p.request_id, p.destination, destination_approved, dpa, p.prompt IS NULL AS unread,
  coalesce(bool_or(data_class = 'secret'), false) AS has_secret,
  coalesce(bool_or(data_class IN ('pii', 'sensitive', 'customer')), false) AS regulated,
  count(d.ordinal) AS n FROM posture p LEFT JOIN det d USING (request_id) GROUP BY ALL),
decided AS (
SELECT request_id, 0 AS step, 0 AS nth, 'BLOCK' AS action, 'secret' AS data_class,
  {text(reg.BLOCK_REASON)} AS reason FROM facts WHERE has_secret
UNION ALL SELECT request_id, 1, 0, 'TICKET', 'secret',
  {text(reg.TICKET_REASON)} FROM facts WHERE has_secret
UNION ALL SELECT request_id, 2, ordinal, 'REDACT', data_class,
  {fill(reg.REDACT_REASON, data_class='data_class')} FROM det
  WHERE data_class IN ('pii', 'sensitive', 'customer')
UNION ALL SELECT request_id, 0, 0, 'BLOCK', NULL, {text(reg.NO_PROMPT_REASON)} FROM facts WHERE unread
UNION ALL SELECT request_id, 3, 0, 'ROUTE', NULL, {fill(reg.UNAPPROVED_REASON, destination="coalesce(destination, '(none)')")}
  FROM facts WHERE NOT destination_approved AND NOT unread
UNION ALL SELECT request_id, 3, 0, 'ROUTE', NULL, {fill(reg.UNCOVERED_REASON, destination='destination')}
  FROM facts WHERE destination_approved AND regulated AND NOT dpa
UNION ALL SELECT request_id, 4, 0, 'LOG', NULL, {text(reg.LOG_REASON)}
  FROM facts WHERE n > 0
UNION ALL SELECT request_id, 5, 0, 'ALLOW', NULL, {text(reg.ALLOW_REASON)}
  FROM facts WHERE n = 0 AND destination_approved AND NOT unread)"""
add("gov_16_decisions", f"""{_DECIDED}
SELECT request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY step, nth) - 1 AS INTEGER) AS ordinal,
  action, data_class, reason FROM decided""")
add("gov_17_sanitized_prompts", f"""{_DET},
steps AS (SELECT request_id, list({{'s': '', 'a': snippet,
  'b': CASE WHEN data_class = 'secret' THEN '[BLOCKED:secret]' ELSE {_TOK} END}} ORDER BY ordinal) AS l
  FROM det GROUP BY request_id)
SELECT request_id, coalesce(list_reduce(list_prepend({{'s': prompt, 'a': '', 'b': ''}}, l),
  lambda x, y: {{'s': replace(x.s, y.a, y.b), 'a': '', 'b': ''}}).s, prompt) AS sanitized_prompt
FROM req LEFT JOIN steps USING (request_id)""")
add("gov_18_vault", f"""{_DET}
SELECT DISTINCT request_id, {_TOK} AS token, snippet AS value FROM det WHERE data_class <> 'secret'""")
add("gov_18_vault_table", f"""{_DET}
SELECT DISTINCT {_TOK} AS token, snippet AS value FROM det WHERE data_class <> 'secret'""")

# the fixture says which chains are broken and how: verdicts follow without any signature
_NO_CLOCK, _NO_EXPIRY = "seq % 43 = 5", "seq % 47 = 6"
_CHAIN_ERROR = f"""CASE WHEN {_NO_CLOCK} THEN 'no clock' WHEN {_NO_EXPIRY} THEN 'no expiry'
  ELSE CASE seq % 5 WHEN 1 THEN 'bad signature' WHEN 2 THEN 'expired' WHEN 3 THEN 'malformed token' END END"""
_CHAIN_REASON = f"""CASE WHEN seq % 5 = 4 THEN {text(reg.CHAIN_UNSIGNED)}
  WHEN ({_CHAIN_ERROR}) IS NULL THEN {text(reg.CHAIN_VERIFIED)}
  ELSE {fill(reg.CHAIN_FAILED, error=f"({_CHAIN_ERROR})")} END"""
_CHAIN_OK = f"CASE WHEN seq % 5 <> 4 THEN ({_CHAIN_ERROR}) IS NULL END"
_VERDICT = f"""{_DECIDED},
verdict AS (SELECT r.request_id, r.seq,
  f.unread OR coalesce(f.has_secret, false) OR coalesce(NOT ({_CHAIN_OK}), false) AS blocked,
  NOT f.unread AND (NOT f.destination_approved OR (f.regulated AND NOT f.dpa)) AS rerouted
  FROM req r JOIN facts f USING (request_id))"""
add("gov_19_verdicts", f"""{_VERDICT}
SELECT request_id, blocked, rerouted, NOT blocked AND NOT rerouted AS allowed FROM verdict""")
_ROLES = ["'%s-' || CAST(seq AS VARCHAR)" % role for role in v.CHAIN_ROLES]
_ACTORS = " || ' > ' || ".join(f"'{role}:' || {actor}" for role, actor in zip(v.CHAIN_ROLES, _ROLES))
add("gov_20_audit_records", f"""{_VERDICT},
acts AS (SELECT request_id, string_agg(action, ', ' ORDER BY step, nth) AS actions FROM (
    SELECT request_id, step, nth, action FROM decided
    UNION ALL SELECT request_id, 9, 0, 'BLOCK' FROM req WHERE NOT ({_CHAIN_OK})) GROUP BY request_id),
classes AS (SELECT request_id, string_agg(data_class, ', ' ORDER BY data_class) AS data_classes
  FROM (SELECT DISTINCT request_id, data_class FROM det) GROUP BY request_id),
toks AS (SELECT request_id, string_agg(token, ', ' ORDER BY o) AS tokens_redacted FROM (
  SELECT request_id, {_TOK} AS token, min(ordinal) AS o FROM det WHERE data_class <> 'secret'
  GROUP BY request_id, token) GROUP BY request_id)
SELECT p.request_id, {text(v.RECORDED_AT)} AS timestamp, {_ACTORS} AS actor_chain,
  {_CHAIN_OK} AS chain_verified, {_CHAIN_REASON} AS chain_reason, 'intent 2' AS intent,
  p.destination, p.destination_approved, coalesce(data_classes, '') AS data_classes,
  coalesce(actions, '') AS actions,
  NOT blocked AND NOT rerouted AS allowed, coalesce(tokens_redacted, '') AS tokens_redacted,
  {_TOKENS} AS est_tokens, {_TOKENS} * 15 AS est_cost_micro_usd,
  {_COST} AS est_cost_usd, p.cost_center,
  'ai-prompt-governance' AS control, 'SOC2-CC6.1, AI-Acceptable-Use, Data-Protection' AS evidence_for
FROM posture p JOIN (SELECT request_id, blocked, rerouted FROM verdict) USING (request_id)
LEFT JOIN acts USING (request_id) LEFT JOIN classes USING (request_id) LEFT JOIN toks USING (request_id)""")
add("gov_21_spend", f"""
SELECT cost_center, count(*) AS requests, CAST(sum({_TOKENS}) AS BIGINT) AS est_tokens,
  CAST(sum({_TOKENS} * 15) AS BIGINT) AS est_cost_micro_usd FROM {_REQ} GROUP BY cost_center""")

# --- signed identity -----------------------------------------------------------------------------------
_INNER, _OUTER = (p.hex() for p in hmac_pads(v.SIGNING_KEY))


def _b64url(blob: str) -> str:
    return f"rtrim(replace(replace(base64({blob}), '+', '-'), '/', '_'), '=')"


def _hmac(body: str) -> str:
    inner = f"unhex(sha256(unhex('{_INNER}') || encode({body})))"
    return _b64url(f"unhex(sha256(unhex('{_OUTER}') || {inner}))")


def minted(issued: str) -> str:
    """Rows (seq, hop_no, actor, role, intent, aud, iat, body, sig) of every chain."""
    hops = ", ".join(f"({n}, {text(r)}, {text(a)})" for n, (r, a) in enumerate(
        zip(v.CHAIN_ROLES, (*v.CHAIN_ROLES[1:], reg.LAST_AUDIENCE))))
    return f"""(SELECT *, {_hmac('body')} AS sig FROM (SELECT *, {_b64url('encode(claims)')} AS body FROM (
SELECT *, '{{"actor":"' || actor || '","role":"' || role || '","intent":"' || intent || '","aud":"' || aud
  || '","iat":' || iat || ',"exp":' || (iat + {reg.TOKEN_TTL_SECONDS}) || '}}' AS claims FROM (
SELECT c_custkey AS seq, hop_no, role || '-' || c_custkey AS actor, role, 'intent ' || hop_no AS intent, aud,
  {issued} AS iat FROM customer, (VALUES {hops}) AS h(hop_no, role, aud)))))"""


_FRESH = minted(str(v.NOW))
add("idn_1_signatures", f"SELECT seq, hop_no, CASE WHEN seq % 41 <> 3 THEN sig END AS signature FROM {_FRESH}")
add("idn_2_minted_tokens", f"SELECT seq, hop_no, CASE WHEN seq % 41 <> 3 THEN body || '.' || sig END AS token FROM {_FRESH}")
add("idn_3_verified_tokens", f"""
SELECT seq, hop_no, error, CASE WHEN error IS NULL THEN actor END AS actor,
  CASE WHEN error IS NULL THEN role END AS role, CASE WHEN error IS NULL THEN intent END AS intent,
  CASE WHEN error IS NULL THEN aud END AS aud, CASE WHEN error IS NULL THEN CAST(iat AS BIGINT) END AS iat,
  CASE WHEN error IS NULL THEN CAST(iat + {reg.TOKEN_TTL_SECONDS} AS BIGINT) END AS exp
FROM (SELECT *, CASE WHEN hop_no = 1 AND {_NO_EXPIRY} THEN 'no expiry' WHEN hop_no = 1 AND seq % 5 = 1 THEN 'bad signature'
  WHEN hop_no = 1 AND seq % 5 = 3 THEN 'malformed token' WHEN {_NO_CLOCK} THEN 'no clock'
  WHEN hop_no = 1 AND seq % 5 = 2 THEN 'expired' END AS error FROM {_FRESH} WHERE seq % 5 <> 4)""")
add("idn_4_audiences", f"SELECT seq, hop_no, aud AS audience FROM {_FRESH}")
add("idn_5_verified_chains", f"""
SELECT seq, verified, CASE WHEN verified THEN {_ACTORS.replace(' > ', ', ')}
  WHEN verified IS NULL OR {_NO_CLOCK} THEN '' ELSE '{v.CHAIN_ROLES[0]}:' || {_ROLES[0]} END AS chain, reason
FROM (SELECT c_custkey AS seq, {_CHAIN_OK.replace('seq', 'c_custkey')} AS verified,
  {_CHAIN_REASON.replace('seq', 'c_custkey')} AS reason FROM customer)""")

_LOG = f"""(SELECT c_custkey AS seq, {_CHAIN_OK.replace('seq', 'c_custkey')} AS verified,
  {_CHAIN_REASON.replace('seq', 'c_custkey')} AS reason FROM customer)"""
_FAILED_HOP = f"CASE WHEN NOT verified THEN CASE WHEN {_NO_CLOCK} THEN 0 ELSE 1 END END"
add("idn_5_log_verdicts", f"""
SELECT seq, verified, CAST({_FAILED_HOP} AS INTEGER) AS failed_hop,
  CAST(CASE WHEN verified IS NULL THEN 0 ELSE {len(v.CHAIN_ROLES)} END AS BIGINT) AS hops, reason FROM {_LOG}""")
add("idn_5_log_chains", f"""
SELECT seq, hop_no, role || ':' || actor AS label FROM {_FRESH} JOIN (
  SELECT seq, verified, {_FAILED_HOP} AS failed_hop FROM {_LOG}) USING (seq) WHERE verified OR hop_no < failed_hop""")

# --- model input and output --------------------------------------------------------------------------------
_USER = f"(SELECT * FROM {view('turns')} WHERE role = 'user')"
_MODEL = f"(SELECT * FROM {view('turns')} WHERE role = 'assistant')"
_FIRED = "\nUNION ALL ".join(f"""SELECT seq, {n} AS nth, {text(rule)} AS rule, {text(sev)} AS severity,
  substr(regexp_extract(text, {regex(p, True)}, 0), 1, {reg.INJECTION_SNIPPET_LENGTH}) AS snippet
FROM {_USER} WHERE regexp_matches(text, {regex(p, True)})"""
                               for n, (rule, sev, p, _) in enumerate(reg.INJECTION_RULES))
add("red_1_injections", f"""
SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY nth) - 1 AS INTEGER) AS ordinal,
  rule, severity, snippet FROM ({_FIRED})""")
_OUT = detections_with(_MODEL, "seq", "text")
_LEAKS = f"""{_OUT},
leaky AS (SELECT r.request_id AS seq, r.prompt AS text,
  coalesce(bool_or(data_class IN ('secret', 'pii')), false) AS leaks
  FROM req r LEFT JOIN det d USING (request_id) GROUP BY ALL)"""
add("red_2_data_leaks", f"{_LEAKS} SELECT seq, leaks FROM leaky")
_REVEALS = f"regexp_matches(text, {regex(reg.REVEAL_PATTERN, True)})"
add("red_3_revealed_instructions", f"SELECT seq, {_REVEALS} AS reveals FROM {_MODEL}")
_ALLOWED = ", ".join(text(t) for t in v.ALLOWED_TOOLS)
_CALLS = f"""SELECT seq, tool, nth FROM (SELECT seq, unnest(t) AS tool, generate_subscripts(t, 1) AS nth FROM
  (SELECT seq, regexp_extract_all(text, {regex(reg.TOOL_CALL_PATTERN, True)}, 1) AS t FROM {_MODEL}))
  WHERE tool NOT IN ({_ALLOWED})"""
add("red_4_unauthorized_tools", f"""
SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY nth) - 1 AS INTEGER) AS ordinal, tool
FROM ({_CALLS})""")


def verdicts(with_tools: bool) -> str:
    tools = ("UNION ALL SELECT seq, 2, nth, " + fill(reg.TOOL_REASON, tool="tool") + " "
             f"FROM ({_CALLS})") if with_tools else ""
    return f"""{_LEAKS},
why AS (SELECT seq, 0 AS step, 0 AS nth, {text(reg.LEAK_REASON)} AS reason FROM leaky WHERE leaks
UNION ALL SELECT seq, 1, 0, {text(reg.REVEAL_REASON)}
  FROM leaky WHERE {_REVEALS} {tools})
SELECT l.seq, count(reason) = 0 AS allowed,
  coalesce(string_agg(reason, ' | ' ORDER BY step, nth), 'clean') AS reasons
FROM leaky l LEFT JOIN why w ON l.seq = w.seq GROUP BY l.seq"""


add("red_5_verdicts", verdicts(True))
add("red_5_verdicts_any_tool", verdicts(False))

# --- consent -----------------------------------------------------------------------------------------------------
_CONSENT_REASON = f"""CASE WHEN contact_known IS NOT NULL AND consent = 'opted_in' THEN NULL
  WHEN consent = 'opted_out' THEN {text(reg.OPTED_OUT_REASON)} ELSE {text(reg.NO_CONSENT_REASON)} END"""
_GOOD_ZONE = "timezone IN ('America/New_York', 'America/Chicago', 'America/Los_Angeles', 'America/Denver', 'Asia/Kolkata')"


def evaluated(sends: str) -> str:
    return f"""
WITH joined AS (SELECT s.*, c.timezone, c.consent, c.contact_id AS contact_known,
  CASE WHEN c.{_GOOD_ZONE} THEN s.send_ts AT TIME ZONE 'UTC' AT TIME ZONE
    CASE WHEN c.{_GOOD_ZONE} THEN c.timezone ELSE 'UTC' END END AS local_ts
  FROM {sends} s LEFT JOIN {view('contacts')} c ON s.contact_id = c.contact_id),
judged AS (SELECT *, {_CONSENT_REASON} AS r1,
  CASE WHEN contact_known IS NOT NULL AND local_ts IS NULL THEN {text(reg.NO_LOCAL_TIME_REASON)}
    WHEN contact_known IS NOT NULL AND (hour(local_ts) < 8 OR hour(local_ts) >= 21)
    THEN {fill(reg.QUIET_HOURS_REASON, time="strftime(local_ts, '%H:%M')", zone='timezone')} END AS r2
  FROM joined),
decided AS (SELECT *, r1 IS NULL AND r2 IS NULL AS allowed,
  CASE WHEN r1 IS NULL AND r2 IS NULL THEN {text(reg.CLEARED_REASON)}
    ELSE concat_ws(' | ', r1, r2) END AS reasons FROM judged)"""


_SENT = evaluated(view("sends"))
add("con_1_consent_status", f"{_SENT} SELECT seq, contact_known IS NOT NULL AS known, r1 AS reason FROM judged")
add("con_2_quiet_hours",
    f"{_SENT} SELECT seq, strftime(local_ts, '%Y-%m-%d %H:%M') AS local_time, r2 AS reason FROM judged")
add("con_3_send_decisions", f"{_SENT} SELECT seq, allowed, reasons FROM decided")
add("con_4_evidence", f"""{_SENT}
SELECT seq, 'tok_contact_' || substr(sha256(contact_id), 1, 8) AS contact_token, campaign,
  CASE WHEN allowed THEN 'ALLOW' ELSE 'BLOCK' END AS decision, reasons, 'tcpa-sms-consent' AS control,
  'TCPA, SOC2-CC6.3' AS evidence_for, {text(v.RECORDED_AT)} AS evaluated_at FROM decided""")
add("con_5_campaign_totals", f"""{_SENT}
SELECT campaign, count(*) FILTER (allowed) AS cleared, count(*) FILTER (NOT allowed) AS blocked,
  count(*) AS total FROM decided GROUP BY campaign""")
_FAN = f"""(SELECT seq, contact_id, 'Brand_X_Outreach' AS campaign,
  TIMESTAMP '2026-06-22 13:00:00' AS send_ts FROM {view('contacts')})"""
add("con_6_campaign_fan_out", f"""{evaluated(_FAN)}
SELECT seq, contact_id, campaign, strftime(send_ts, '%Y-%m-%d %H:%M:%S.%f') AS send_ts, allowed FROM decided""")

_FANS = f"""(SELECT c.seq, c.contact_id, r_name AS campaign,
  TIMESTAMP '2026-06-22 03:00:00' + CAST(r_regionkey * 5 AS INTEGER) * INTERVAL '1' HOUR AS send_ts
  FROM {view('contacts')} c, region)"""
add("con_6_campaign_table", f"""{evaluated(_FANS)}
SELECT seq, contact_id, campaign, strftime(send_ts, '%Y-%m-%d %H:%M:%S.%f') AS send_ts, allowed FROM decided""")
add("con_7_registry_violations", f"""
SELECT seq, contact_id, 'unusable time zone: ' || coalesce(timezone, 'none') AS violation
FROM {view('contacts')} WHERE NOT coalesce({_GOOD_ZONE}, false)
UNION ALL SELECT seq, contact_id, 'unknown consent: ' || coalesce(consent, 'none on record')
FROM {view('contacts')} WHERE NOT coalesce(consent IN ('opted_in', 'opted_out', 'none'), false)""")

# --- triage --------------------------------------------------------------------------------------------------------
_SCORE = " + ".join(f"CASE WHEN {f} THEN {w} ELSE 0 END" for f, w in reg.RISK_WEIGHTS.items())
_FACTORS = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {f} THEN '{f}' END" for f in reg.RISK_WEIGHTS) + ")"
_PATH = "(internet_facing AND sensitive_data AND exploitable_high)"
_BAND = f"""CASE WHEN {_SCORE} >= 85 THEN 'Critical' WHEN {_SCORE} >= 55 THEN 'High'
  WHEN {_SCORE} >= 30 THEN 'Medium' ELSE 'Low' END"""
_RANK = case_of("vendor_severity", reg.SEVERITY_RANK, "9")
_F = view("findings")
add("tri_1_risk_scores", f"SELECT seq, id, {_SCORE} AS risk_score FROM {_F}")
add("tri_2_factors", f"SELECT seq, {_FACTORS} AS factors FROM {_F}")
add("tri_3_attack_paths", f"SELECT seq, id, owner FROM {_F} WHERE {_PATH}")
add("tri_4_risk_bands", f"SELECT seq, {_BAND} AS risk_band FROM {_F}")
add("tri_5_vendor_order", f"""
SELECT seq, id, vendor_severity, row_number() OVER (ORDER BY {_RANK}, seq) AS position FROM {_F}""")
_RISK_ORDER = f"ORDER BY {_PATH} DESC, {_SCORE} DESC, seq"
add("tri_6_risk_order", f"SELECT seq, id, row_number() OVER ({_RISK_ORDER}) AS position FROM {_F}")
add("tri_7_deduped", f"""
SELECT seq, id, title, resource, vendor_severity, owner FROM {_F}
QUALIFY row_number() OVER (PARTITION BY title, resource ORDER BY seq) = 1""")
add("tri_8_top_queue", f"""
SELECT CAST(row_number() OVER ({_RISK_ORDER}) AS INTEGER) AS position, id,
  CASE WHEN {_PATH} THEN 'ATTACK-PATH' ELSE {_BAND} END AS label, {_SCORE} AS risk_score, owner,
  {_FACTORS} AS factors FROM {_F} QUALIFY position <= {v.QUEUE_LENGTH}""")
add("tri_9_totals", f"""
SELECT count(*) AS findings, count(*) FILTER ({_PATH}) AS attack_paths,
  count(*) FILTER (owner = 'unassigned') AS unassigned FROM {_F}""")

# --- remediation -----------------------------------------------------------------------------------------------------
_TODAY = f"DATE '{v.PENTEST_TODAY}'"
_TRACKED = f"""(SELECT *, coalesce(status IN ('open', 'in_progress', 'retest'), false) AS is_open,
  coalesce(status NOT IN ('open', 'in_progress', 'retest', 'remediated', 'accepted'), true) AS unknown,
  coalesce(coalesce(status NOT IN ('remediated', 'accepted'), true) AND {_TODAY} > due, false) AS overdue,
  due - {_TODAY} AS days_left
  FROM (SELECT *, discovered + {case_of('severity', reg.SLA_DAYS)} AS due FROM {view('pentest')}))"""
add("pen_1_due_dates", f"SELECT seq, id, CAST(due AS VARCHAR) AS sla_due FROM {_TRACKED}")
add("pen_1_due_dates_as_of", f"""
SELECT seq, id, CAST(CAST(discovered + days AS DATE) AS VARCHAR) AS sla_due
FROM {view('pentest')} f LEFT JOIN {view('deadlines')} d ON d.severity = f.severity AND d.valid_from <= f.discovered
QUALIFY row_number() OVER (PARTITION BY seq ORDER BY valid_from DESC NULLS LAST) = 1""")
add("pen_2_overdue", f"SELECT seq, id, overdue FROM {_TRACKED}")
add("pen_3_days_left", f"SELECT seq, id, CAST(days_left AS INTEGER) AS days_left FROM {_TRACKED}")
add("pen_4_summary", f"""
SELECT total, critical, high, medium, low, open, overdue, unrated_open, closed, unknown_status, unassigned_open,
  CASE WHEN open + unknown_status = 0 THEN 100
    ELSE CAST(round_even(100.0 * in_time / (open + unknown_status), 0) AS INTEGER) END AS on_time_pct
FROM (SELECT count(*) AS total, count(*) FILTER (severity = 'critical') AS critical,
  count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium,
  count(*) FILTER (severity = 'low') AS low, count(*) FILTER (is_open) AS open,
  count(*) FILTER (overdue) AS overdue, count(*) FILTER (is_open AND due IS NULL) AS unrated_open, count(*) FILTER (status IN ('remediated', 'accepted')) AS closed,
  count(*) FILTER (unknown) AS unknown_status, count(*) FILTER (is_open AND due >= {_TODAY}) AS in_time,
  count(*) FILTER (is_open AND owner = 'unassigned') AS unassigned_open FROM {_TRACKED})""")
add("pen_5_worklist", f"""
SELECT row_number() OVER (ORDER BY overdue DESC, days_left NULLS FIRST, seq) AS position, seq, id, overdue,
  CAST(days_left AS INTEGER) AS days_left FROM {_TRACKED} WHERE is_open OR unknown""")

# --- release gate --------------------------------------------------------------------------------------------------------
_GATE = f"""
WITH cand AS (SELECT seq, release_id, id, CASE WHEN {_BAND} = 'Critical' THEN 'critical'
  ELSE vendor_severity END AS severity, {_PATH} AS attack_path FROM {_F}),
blocking AS (SELECT * FROM cand WHERE severity = 'critical' OR attack_path),
valid AS (SELECT DISTINCT candidate_id FROM {view('exceptions')} WHERE expires >= DATE '{v.GATE_DATE}'),
judged AS (SELECT *, id IN (SELECT candidate_id FROM valid) AS accepted FROM blocking)"""
add("rel_1_candidates", f"{_GATE} SELECT * FROM cand")
add("rel_2_blocking", f"{_GATE} SELECT release_id, id FROM blocking")
add("rel_3_valid_exceptions", f"{_GATE} SELECT candidate_id FROM valid")
add("rel_4_accepted_or_blocker", f"{_GATE} SELECT seq, release_id, id, accepted FROM judged")
add("rel_5_gate", f"""{_GATE}
SELECT release_id, decision, blockers, accepted, decision || ': ' || blockers || ' open blocker(s), ' || accepted
  || ' accepted via time-boxed exception' AS summary
FROM (SELECT *, CASE WHEN blockers > 0 THEN 'BLOCK' ELSE 'SHIP' END AS decision FROM (
  SELECT r.release_id, count(j.seq) FILTER (NOT accepted) AS blockers, count(j.seq) FILTER (accepted) AS accepted
  FROM {view('releases')} r LEFT JOIN judged j ON r.release_id = j.release_id GROUP BY r.release_id))""")
add("rel_5_gate_lists", f"""{_GATE}
SELECT release_id, list, row_number() OVER (PARTITION BY release_id, list ORDER BY seq) AS position,
  id AS candidate_id FROM (SELECT *, CASE WHEN accepted THEN 'accepted' ELSE 'blockers' END AS list FROM judged)""")

# --- connector access ------------------------------------------------------------------------------------------------------
_SCOPES = ", ".join(text(f"{c} {s}") for c, scopes in reg.CONNECTOR_SCOPES.items() for s in scopes)
_CONNECTORS = ", ".join(text(c) for c in reg.CONNECTOR_SCOPES)
_RISKY = ", ".join(text(f"{c} {a}") for c, a in reg.HIGH_RISK_ACTIONS)
_ACCESS = f"""
WITH req AS (SELECT *, coalesce(connector IN ({_CONNECTORS}), false) AS known_connector,
  coalesce(connector || ' ' || action IN ({_SCOPES}), false) AS valid_scope,
  coalesce(connector || ' ' || action IN ({_RISKY}), false) AS high_risk FROM {view('access')}),
granted AS (SELECT principal, connector, scope_names FROM {view('grants')}
  QUALIFY row_number() OVER (PARTITION BY principal, connector ORDER BY seq) = 1),
seen AS (SELECT DISTINCT principal, connector FROM {view('access')} WHERE ts < TIMESTAMP '{v.HISTORY_BEFORE}'),
checked AS (SELECT r.*, s.principal IS NULL AS anomalous, g.scope_names,
  CASE WHEN NOT known_connector THEN {fill(reg.UNKNOWN_CONNECTOR_REASON, connector="coalesce(r.connector, '(none)')")}
    WHEN NOT valid_scope THEN {fill(reg.INVALID_SCOPE_REASON, action="coalesce(action, '(none)')", connector='r.connector')} END AS error,
  'tok_' || substr(sha256(r.principal), 1, 8) AS principal_token
  FROM req r LEFT JOIN granted g ON r.principal = g.principal AND r.connector = g.connector
  LEFT JOIN seen s ON r.principal = s.principal AND r.connector = s.connector)"""


def reason_for(who: str) -> str:
    return f"""CASE WHEN error IS NOT NULL THEN error
  WHEN scope_names IS NULL THEN {fill(reg.NO_GRANT_REASON, who=who, connector='connector')}
  WHEN NOT list_contains(string_split(scope_names, ','), action)
    THEN {fill(reg.LACKS_SCOPE_REASON, who=who, action='action', connector='connector')}
  ELSE 'granted' END"""


add("aut_1_registry_check", f"{_ACCESS} SELECT seq, known_connector, valid_scope, error FROM checked")
add("aut_2_first_grants",
    f"{_ACCESS} SELECT principal, connector, replace(scope_names, ',', ', ') AS scopes FROM granted")
add("aut_3_decisions",
    f"{_ACCESS} SELECT seq, {reason_for('principal')} = 'granted' AS allowed, {reason_for('principal')} AS reason FROM checked")
add("aut_4_high_risk", f"{_ACCESS} SELECT seq, high_risk FROM checked")
add("aut_5_first_time_access", f"{_ACCESS} SELECT seq, anomalous FROM checked")
add("aut_6_audit_records", f"""{_ACCESS}
SELECT seq, principal_token, connector, action,
  CASE WHEN {reason_for('principal')} = 'granted' THEN 'ALLOW' ELSE 'DENY' END AS decision,
  {reason_for('principal_token')} AS reason, high_risk, anomalous, 'connector-authz' AS control,
  'SOC2-CC6.1, SOC2-CC6.3' AS evidence_for FROM checked""")

# --- detection response --------------------------------------------------------------------------------------------------------
_RULE_ROWS = ", ".join(f"({n}, {text(p)}, {text(', '.join(a))})"
                       for n, (p, a) in enumerate(reg.RESPONSE_RULES, start=1))
_RULES = f"(SELECT * FROM (VALUES {_RULE_ROWS}) AS r(rule_no, prefix, actions))"


def plan_of(detections: str, rules: str) -> str:
    """Common table expressions from detections and rules to ``hit`` and ``plan``."""
    return f"""
WITH det AS (SELECT seq, coalesce(type, '') AS type, coalesce(severity, 0.0) AS severity,
  coalesce(resource, 'unknown') AS resource FROM {detections}),
rules AS {rules},
hit AS (SELECT d.*, r.rule_no, coalesce(r.actions, '') AS actions FROM det d
  LEFT JOIN rules r ON starts_with(d.type, r.prefix)
  QUALIFY row_number() OVER (PARTITION BY d.seq ORDER BY r.rule_no) = 1),
plan AS (
SELECT seq, generate_subscripts(a, 1) AS nth, unnest(a) AS action, resource AS target, true AS destructive,
  {fill(reg.DESTRUCTIVE_REASON, type='type', severity='CAST(severity AS VARCHAR)')} AS reason
  FROM (SELECT *, string_split(actions, ', ') AS a FROM hit WHERE rule_no IS NOT NULL AND severity >= 7.0)
UNION ALL SELECT seq, 1, 'alert', resource, false, {fill(reg.BELOW_REASON, type='type')}
  FROM hit WHERE rule_no IS NOT NULL AND severity < 7.0
UNION ALL SELECT seq, 1, 'alert', resource, false, {fill(reg.UNKNOWN_TYPE_REASON,
    type="CASE WHEN type = '' THEN 'n/a' ELSE type END")} FROM hit WHERE rule_no IS NULL
UNION ALL SELECT seq, 100, 'open_incident', resource, false, {text(reg.INCIDENT_ACTION_REASON)} FROM hit
UNION ALL SELECT seq, 101, 'notify', 'security-oncall', false, {text(reg.NOTIFY_REASON)} FROM hit)"""


_PLAN = plan_of(view("detections"), _RULES)
_TABLE_PLAN = plan_of(
    f"""(SELECT seq, type, severity, resource FROM {view('detections')}
    UNION ALL SELECT seq + 1000000000, type, severity, resource FROM {view('probes')})""",
    f"(FROM {_RULES} UNION ALL SELECT rule_no, prefix, action FROM {view('response_rules')})")
_PLAN_ROWS = """SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY nth) - 1 AS INTEGER) AS ordinal,
  action, target, destructive, reason FROM plan"""
add("rsp_1_rule_table", f"{_TABLE_PLAN} SELECT seq, rule_no, actions FROM hit")
add("rsp_2_rule_table_plans", f"{_TABLE_PLAN} {_PLAN_ROWS}")
add("rsp_1_matched_rules", f"{_PLAN} SELECT seq, rule_no, actions FROM hit")
add("rsp_2_plans", f"{_PLAN} {_PLAN_ROWS}")
add("rsp_3_defaults", f"{_PLAN} SELECT * FROM det")
add("rsp_4_destructive", f"{_PLAN} SELECT seq, bool_or(destructive) AS destructive FROM plan GROUP BY seq")

# --- configuration -----------------------------------------------------------------------------------------------------------------
_CFG = f"""(SELECT account_id, rule, CASE WHEN list_contains(string_split(bad_flags, ','), state_key)
  THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS status, severity, remediation
  FROM {view('accounts')}, {values(['rule', 'severity', 'state_key', 'remediation'], reg.CONFIG_RULES)})"""
add("cfg_1_compliance", f"SELECT * FROM {_CFG}")
add("cfg_2_noncompliant", f"SELECT * FROM {_CFG} WHERE status = 'NON_COMPLIANT'")
_IDS = ", ".join(text(t[0]) for t in reg.THREATS)
add("cfg_3_unknown_threats", f"""
SELECT account_id, policy_id, prevents FROM (SELECT account_id, policy_id,
  CASE WHEN seq % 10 = 3 AND policy_id = 'scp-004' THEN 'T99' ELSE prevents END AS prevents
  FROM {view('accounts')}, {values(['policy_id', 'name', 'prevents'], reg.GUARDRAIL_POLICIES)})
WHERE prevents NOT IN ({_IDS})""")
add("cfg_4_repeated_state_keys", f"""
SELECT account_id, state_key, count(*) AS uses FROM (SELECT account_id,
  CASE WHEN seq % 4 = 1 AND rule = 'ENCRYPTED_VOLUMES' THEN 's3_unencrypted' ELSE state_key END AS state_key
  FROM {view('accounts')}, {values(['rule', 'severity', 'state_key', 'remediation'], reg.CONFIG_RULES)})
GROUP BY ALL HAVING count(*) > 1""")

# --- source scan ------------------------------------------------------------------------------------------------------------------------
_HITS = "\nUNION ALL ".join(f"""SELECT path, 0 AS part, n, {k} AS nth, {text(rule)} AS rule, {text(sev)} AS severity,
  line, {text(msg)} AS message FROM lines WHERE regexp_matches(line, {regex(p, i)})"""
                              for k, (rule, sev, p, i, _, msg) in enumerate(reg.SCAN_RULES))
_AUTH = " OR ".join(f"contains(line, {text(m)})" for m in reg.AUTH_MARKERS)
def scan_of(files: str) -> str:
    """Common table expressions from ``files`` (path, content) to the findings and their sums."""
    return rf"""
WITH files AS (SELECT path, string_split(content, chr(10)) AS l FROM {files}),
numbered AS (SELECT path, unnest(l) AS line, generate_subscripts(l, 1) AS n, len(l) AS total FROM files),
lines AS (SELECT path, line, n FROM numbered WHERE NOT (n = total AND line = '')),
flagged AS (SELECT *, contains(line, '@app.route(') AS is_route,
  starts_with(regexp_replace(line, '^\s+', ''), 'def ') AS is_def, ({_AUTH}) AS is_auth FROM lines),
ahead AS (SELECT *, min(CASE WHEN is_def THEN n END) OVER w AS next_def,
  min(CASE WHEN is_auth THEN n END) OVER w AS next_auth FROM flagged
  WINDOW w AS (PARTITION BY path ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
hits AS ({_HITS}
UNION ALL SELECT path, 1, n, 0, 'unauthenticated-endpoint', 'high', line,
  'Route exposed without an authentication decorator' FROM ahead
  WHERE is_route AND NOT coalesce(next_auth < coalesce(next_def, 1000000000), false)),
found AS (SELECT path, part, rule, severity, CAST(n AS INTEGER) AS line, nth,
  substr(regexp_replace(line, '^\s+|\s+$', '', 'g'), 1, 80) AS snippet, message FROM hits),
sums AS (SELECT f.path, count(*) FILTER (severity = 'high') AS high,
  count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low,
  count(severity) AS total FROM files f LEFT JOIN found h ON f.path = h.path GROUP BY f.path)"""


_SCAN = scan_of(view("source"))
_PARTS = f"""(SELECT seq // 200 AS path, string_agg(content, chr(10) ORDER BY seq) || chr(10) AS content
  FROM {view('source')} GROUP BY ALL)"""


def scanned(where: str, scan: str = _SCAN, name: str = "path") -> str:
    return f"""{scan}
SELECT path AS {name}, CAST(row_number() OVER (PARTITION BY path ORDER BY part, line, nth) - 1 AS INTEGER) AS ordinal,
  rule, severity, line, snippet, message FROM found WHERE {where}"""


add("scn_1_line_findings", scanned("part = 0"))
add("scn_2_open_routes", scanned("part = 1"))
add("scn_3_scan", scanned("true"))
add("scn_4_file_summaries", f"{_SCAN} SELECT * FROM sums")
add("scn_5_gate", f"{_SCAN} SELECT path, high = 0 AS passed FROM sums")
add("scn_5_corpus_gate", f"""{_SCAN}
SELECT count(*) AS files, count(*) FILTER (high > 0) AS failed, bool_and(high = 0) AS passed FROM sums""")
add("scn_3_line_scan", scanned("true", scan_of(_PARTS), "part"))
add("scn_4_line_summaries", f"{scan_of(_PARTS)} SELECT path AS part, * EXCLUDE (path) FROM sums")
add("src_4_read_source_files", f"""{_SCAN}
SELECT rule, severity, count(*) AS findings FROM found WHERE part = 0 GROUP BY ALL""")

add("src_4_file_contents", f"""
SELECT part, length(content) AS length, sha256(content) AS digest FROM (
  SELECT seq // 200 AS part, string_agg(content, chr(10) ORDER BY seq) || chr(10) AS content
  FROM {view('source')} GROUP BY part)""")

# --- http responses ---------------------------------------------------------------------------------------------------------------------------
_MISSING = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN NOT coalesce(list_contains(string_split(header_names, ','), {text(h)}), false) THEN {text(h)} END"
    for h in reg.REQUIRED_HEADERS) + ")"
_ROUTES = ", ".join(text(r) for r in reg.PROTECTED_ROUTES)
_WEB = f"""
WITH resp AS (SELECT *, {_MISSING} AS missing FROM {view('http')} WHERE endpoint IN ({_ROUTES})),
found AS (
SELECT seq, 'missing-authentication' AS rule, 'high' AS severity, endpoint,
  {fill(reg.OPEN_ROUTE_MESSAGE, status="coalesce(CAST(status AS VARCHAR), 'no status')")} AS message
  FROM resp WHERE NOT authed AND coalesce(status NOT IN (401, 403), true)
UNION ALL SELECT seq, 'missing-security-headers', 'medium', endpoint, {fill(reg.HEADERS_MESSAGE, headers='missing')}
  FROM resp WHERE authed AND missing <> ''
UNION ALL SELECT seq, 'error-leakage', 'high', endpoint, {text(reg.LEAKAGE_MESSAGE)}
  FROM resp WHERE authed AND (contains(body, 'Traceback') OR contains(body, 'Werkzeug')))"""
add("web_1_missing_authentication", f"{_WEB} SELECT * FROM found WHERE rule = 'missing-authentication'")
add("web_2_missing_headers", f"{_WEB} SELECT * FROM found WHERE rule = 'missing-security-headers'")
add("web_3_error_leakage", f"{_WEB} SELECT * FROM found WHERE rule = 'error-leakage'")
add("web_4_findings", f"{_WEB} SELECT * FROM found")
add("web_4_summary", f"""{_WEB}
SELECT count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium,
  count(*) FILTER (severity = 'low') AS low, count(*) AS total FROM found""")

# --- registers --------------------------------------------------------------------------------------------------------------------------------
_BREAK = {"status": "CASE (row_no + seq) % 3 WHEN 0 THEN 'mitigated' WHEN 1 THEN 'partial' ELSE 'accepted' END"}
for _ident, _every, _rest, _column, _value in v.BROKEN_THREATS:
    _BREAK[_column] = (f"CASE WHEN r.threat_id = {text(_ident)} AND seq % {_every} = {_rest} THEN {text(_value)} "
                       f"ELSE {_BREAK.get(_column, 'r.' + _column)} END")
_THREAT_SELECT = ", ".join(
    f"{_BREAK[c]} AS {c}" if c in _BREAK else f"r.{c}" for c in v.THREAT_COLUMNS)
_THREATS = f"""(SELECT org_id, {_THREAT_SELECT} FROM {view('organisations')},
  {values(['row_no', *v.THREAT_COLUMNS], [(n, *t) for n, t in enumerate(reg.THREATS)])})"""
_PCT = "CAST(round_even(CAST({a} AS DOUBLE) / {b} * 100.0, 0) AS INTEGER)"
_COUNTS = ", ".join(
    [f"count(*) FILTER (status = {text(s)}) AS status_{s}" for s in reg.THREAT_STATUSES]
    + [f"count(*) FILTER (stride = {text(c)}) AS stride_{c.lower()}" for c in reg.STRIDE_CLASSES])
add("reg_1_threat_coverage", f"""
SELECT *, {_PCT.format(a='status_mitigated', b='total')} AS mitigated_pct
FROM (SELECT org_id, count(*) AS total, {_COUNTS} FROM {_THREATS} GROUP BY org_id)""")
_DIMENSIONS = ", ".join([f"('status', {text(s)})" for s in reg.THREAT_STATUSES]
                        + [f"('stride', {text(c)})" for c in reg.STRIDE_CLASSES])
add("reg_1_coverage_rows", f"""
WITH t AS (SELECT * FROM {_THREATS})
SELECT o.org_id, d.dimension, d.value, count(t.org_id) AS n
FROM (SELECT DISTINCT org_id FROM t) o CROSS JOIN (VALUES {_DIMENSIONS}) AS d(dimension, value)
LEFT JOIN t ON t.org_id = o.org_id AND d.value = CASE d.dimension WHEN 'status' THEN t.status ELSE t.stride END
GROUP BY ALL""")
add("reg_3_controls_not_in_register", f"""
SELECT org_id, threat_id, control FROM {_THREATS} WHERE control NOT IN ({', '.join(text(c) for c in reg.KNOWN_CONTROLS)})""")
add("cfg_3_threats_not_in_register", f"""
SELECT account_id, policy_id, prevents FROM ({ORACLE_SQL['cfg_3_unknown_threats']})
WHERE prevents NOT IN (SELECT threat_id FROM {_THREATS})""")
add("reg_2_open_gaps", f"""
SELECT org_id, threat_id, stride, component, description, control, status FROM {_THREATS}
WHERE status <> 'mitigated'""")
_KNOWN = ", ".join(text(c) for c in reg.KNOWN_CONTROLS)
add("reg_3_unknown_controls",
    f"SELECT org_id, threat_id, control FROM {_THREATS} WHERE control NOT IN ({_KNOWN})")
_CLASSES = ", ".join(f"({text(c)})" for c in reg.STRIDE_CLASSES)
add("reg_4_missing_stride", f"""
SELECT org_id, stride FROM {view('organisations')}, (VALUES {_CLASSES}) AS s(stride)
EXCEPT SELECT org_id, stride FROM {_THREATS}""")
_IN_CLASSES = ", ".join(text(c) for c in reg.STRIDE_CLASSES)
_IN_STATUSES = ", ".join(text(s) for s in reg.THREAT_STATUSES)
add("reg_5_violations", f"""
WITH t AS (SELECT * FROM {_THREATS})
SELECT org_id, threat_id, 'invalid stride' AS violation FROM t WHERE stride NOT IN ({_IN_CLASSES})
UNION ALL SELECT org_id, threat_id, 'invalid status' FROM t WHERE status NOT IN ({_IN_STATUSES})
UNION ALL SELECT org_id, threat_id, 'blank mitigation' FROM t WHERE trim(mitigation) = ''
UNION ALL SELECT org_id, threat_id, 'blank description' FROM t WHERE trim(description) = ''
UNION ALL SELECT org_id, threat_id, 'duplicate id' FROM t GROUP BY ALL HAVING count(*) > 1""")
_CONTROLS = f"""(SELECT org_id, control_id, name, owner, system, evidence, cadence,
  (row_no + seq) % 3 <> 0 AS automated FROM {view('organisations')},
  {values(['row_no', *v.CONTROL_COLUMNS], [(n, *c) for n, c in enumerate(reg.CONTROLS)])})"""
add("reg_6_control_coverage", f"""
SELECT *, controls - automated AS manual, {_PCT.format(a='automated', b='controls')} AS automation_pct
FROM (SELECT org_id, count(*) AS controls, count(*) FILTER (automated) AS automated
  FROM {_CONTROLS} GROUP BY org_id)""")
add("reg_7_evidence_map", f"SELECT * FROM {_CONTROLS}")

# --- incidents ------------------------------------------------------------------------------------------------------------------------------------
_INCIDENTS = f"""(SELECT seq, 'INC-' || substr(sha256(CAST(seq AS VARCHAR)), 1, {reg.INCIDENT_ID_DIGITS}) AS incident_id, ts
  FROM {view('detections')})"""
_STEPS = values(["step_no", "minutes", "actor", "action", "evidence"],
                [(n, *s) for n, s in enumerate(reg.PLAYBOOK, start=1)])
_TIMELINE = f"""(SELECT seq, incident_id, step_no, ts, ts + to_minutes(minutes) AS step_at, actor, action, evidence
  FROM {_INCIDENTS}, {_STEPS})"""


def _iso(column: str) -> str:
    return (f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE strftime({column}, '%f') WHEN '000000' THEN '' "
            f"ELSE '.' || strftime({column}, '%f') END || '+00:00'")


add("inc_1_timelines", f"""
SELECT seq, incident_id, step_no, strftime(step_at, '%Y-%m-%d %H:%M:%S.%f') AS "at", actor, action, evidence
FROM {_TIMELINE}""")
add("inc_2_records", f"""
SELECT seq, incident_id AS id, {text(reg.INCIDENT_TITLE)} AS title, 'Sev2' AS severity,
  {text(reg.SEVERITY_MEANING['Sev2'])} AS severity_meaning, {_iso('ts')} AS declared_at,
  'contained' AS status, {text('; '.join(f'{r}: {who}' for r, who in reg.INCIDENT_ROLES))} AS roles,
  string_agg({_iso('step_at')} || ' | ' || actor || ' | ' || action || ' | ' || evidence, '; ' ORDER BY step_no) AS timeline,
  {text('; '.join(reg.INCIDENT_FOLLOW_UPS))} AS postmortem_actions,
  {text(', '.join(reg.INCIDENT_EVIDENCE))} AS evidence_for
FROM {_TIMELINE} GROUP BY seq, incident_id, ts""")

# --- streaming: the batch result of the whole table ---------------------------------------------------------------------------------------------------
add("str_1_guardrail_stream", f"""
SELECT request_id, data_classes, actions, allowed, chain_verified, est_tokens, cost_center
FROM ({ORACLE_SQL['gov_20_audit_records']})""")
add("str_1_sanitized_stream", ORACLE_SQL["gov_17_sanitized_prompts"])
add("str_1_vault_stream", ORACLE_SQL["gov_18_vault"])
add("str_2_response_stream", ORACLE_SQL["rsp_2_plans"])
add("str_3_first_seen_stream", f"""
SELECT seq, principal, connector FROM {view('access')} a WHERE ts >= TIMESTAMP '{v.HISTORY_BEFORE}'
  AND NOT EXISTS (SELECT 1 FROM {view('access')} h WHERE h.ts < TIMESTAMP '{v.HISTORY_BEFORE}'
    AND h.principal = a.principal AND h.connector = a.connector)
QUALIFY row_number() OVER (PARTITION BY principal, connector ORDER BY ts, seq) = 1""")
add("str_3_expiring_stream", ORACLE_SQL["str_3_first_seen_stream"])
