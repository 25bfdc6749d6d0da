"""Signed per-hop tokens: HMAC-SHA256 over compact JSON claims, in built-in functions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import bind, filled

CLAIMS = "actor string, role string, intent string, aud string, iat bigint, exp bigint"
_BLOCK = 64


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    """The two key blocks of the HMAC construction (RFC 2104)."""
    block = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def _replaced(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """``text`` with pieces exchanged; searches bytes, which is faster than a pattern or ``translate``."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def base64url(raw: Column) -> Column:
    # padding is at the end only; a session may ask for lines, whose ends are always both characters
    return _replaced(F.rtrim(F.base64(raw), F.lit("=")), [("\r\n", ""), ("+", "-"), ("/", "_")])


def from_base64url(text: Column) -> Column:
    return F.try_to_binary(_replaced(text, [("-", "+"), ("_", "/")]), F.lit("base64"))


def sign(body: Column, key: bytes) -> Column:
    inner_pad, outer_pad = hmac_pads(key)
    inner = F.unhex(F.sha2(F.concat(F.lit(inner_pad), F.encode(body, "UTF-8")), 256))
    return base64url(F.unhex(F.sha2(F.concat(F.lit(outer_pad), inner), 256)))


# control characters that have no short escape and a letter in their code
_LETTERED_CONTROLS = [code for code in range(0x20)
                      if chr(code) not in "\b\t\n\f\r" and code % 16 > 9]


def _ascii_json(json: Column) -> Column:
    """Escape every character outside printable ASCII as ``\\uxxxx``, in lower-case hex."""
    def lower_controls(text: Column) -> Column:
        lowered = text
        for code in _LETTERED_CONTROLS:
            # an even run of backslashes before it does not belong to the escape
            lowered = F.regexp_replace(
                lowered, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
        return F.when(F.contains(text, F.lit(r"\u00")), lowered).otherwise(text)

    def escape(c: Column) -> Column:
        units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        return F.when(F.rlike(c, F.lit("[^ -~]")),
                      F.regexp_replace(units, "(.{4})", r"\\u$1")).otherwise(c)

    def escape_all(text: Column) -> Column:
        escaped = F.array_join(F.transform(F.split(text, ""), escape), "")
        return F.when(F.rlike(text, F.lit("[^ -~]")), escaped).otherwise(text)

    return bind(bind(json, lower_controls), escape_all)


def mint(actor: Column, role: Column, intent: Column, audience: Column, issued_at: Column,
         key: bytes, ttl: int = reg.TOKEN_TTL_SECONDS) -> Column:
    """``body.signature`` for one hop; claim order and compactness are part of the format.

    Without a time of issue there is no token: it would never expire.
    """
    issued = issued_at.cast("bigint")
    claims = F.struct(actor.alias("actor"), role.alias("role"), intent.alias("intent"),
                      audience.alias("aud"), issued.alias("iat"), (issued + ttl).alias("exp"))
    body = base64url(F.encode(_ascii_json(F.to_json(claims, {"ignoreNullFields": "false"})), "UTF-8"))
    return F.when(issued.isNotNull(), bind(body, lambda b: F.concat(b, F.lit("."), sign(b, key))))


def audiences(hops: Column) -> Column:
    """For each hop the role of the next one; the last hop is addressed to the guardrail."""
    return F.transform(hops, lambda _, i: F.coalesce(
        F.try_element_at(hops, (i + 2).cast("int"))["role"], F.lit(reg.LAST_AUDIENCE)))


def mint_chain(hops: Column, issued_at: Column, key: bytes,
               ttl: int = reg.TOKEN_TTL_SECONDS) -> Column:
    return F.zip_with(hops, audiences(hops), lambda hop, aud: mint(
        hop["actor"], hop["role"], hop["intent"], aud, issued_at, key, ttl))


def verify(token: Column, key: bytes, now: Column) -> Column:
    """``struct<error, claims>``; exactly one of the two is set.

    Checks run in order: two parts, signature, expiry (equal to ``now`` is valid). A token without an expiry and
    a check without a clock are errors, as is a missing token.
    """
    claims_type = f"struct<{','.join(f'{n}:{t}' for n, t in (c.split() for c in CLAIMS.split(', ')))}>"
    no_claims = F.lit(None).cast(claims_type)

    def checked(parts: Column) -> Column:
        signed = (F.size(parts) == 2) & (parts[1] == sign(parts[0], key))
        claims = F.when(signed, F.from_json(
            F.decode(from_base64url(parts[0]), "UTF-8"), CLAIMS)).otherwise(no_claims)

        def outcome(c: Column) -> Column:
            error = (F.when(F.size(parts) != 2, F.lit(reg.MALFORMED_TOKEN))
                     .when(c.isNull(), F.lit(reg.BAD_SIGNATURE))
                     .when(c["exp"].isNull(), F.lit(reg.NO_EXPIRY))
                     .when(now.isNull(), F.lit(reg.NO_CLOCK))
                     .when(c["exp"] < now, F.lit(reg.EXPIRED_TOKEN)))
            return F.struct(error.alias("error"),
                            F.when(error.isNull(), c).otherwise(no_claims).alias("claims"))

        return bind(claims, outcome)

    return bind(F.split(token, r"\.", -1), checked)


def verify_chain(tokens: Column, key: bytes, now: Column) -> Column:
    """``struct<verified, chain, reason>``; verified is NULL when nothing was presented.

    The chain of a failed verification holds the hops before the first bad one.
    """
    state = "struct<error:string,chain:array<string>>"
    start = F.struct(F.lit(None).cast("string").alias("error"),
                     F.array().cast("array<string>").alias("chain")).cast(state)

    def step(acc: Column, hop: Column) -> Column:
        label = F.concat(hop["claims"]["role"], F.lit(":"), hop["claims"]["actor"])
        grown = F.struct(
            hop["error"].alias("error"),
            F.when(hop["error"].isNull(), F.concat(acc["chain"], F.array(label)))
            .otherwise(acc["chain"]).alias("chain")).cast(state)
        return F.when(acc["error"].isNotNull(), acc).otherwise(grown)

    def result(acc: Column) -> Column:
        return F.struct(
            acc["error"].isNull().alias("verified"), acc["chain"].alias("chain"),
            F.coalesce(filled(reg.CHAIN_FAILED, error=acc["error"]),
                       F.lit(reg.CHAIN_VERIFIED)).alias("reason"))

    unsigned = F.struct(F.lit(None).cast("boolean").alias("verified"),
                        F.array().cast("array<string>").alias("chain"),
                        F.lit(reg.CHAIN_UNSIGNED).alias("reason"))
    checked = F.aggregate(F.transform(tokens, lambda t: verify(t, key, now)), start, step, result)
    return F.when(F.coalesce(F.size(tokens), F.lit(0)) < 1, unsigned).otherwise(checked)
