"""Minting and checking the signed actor chains of a whole token log.

A chain is one array column, so its order is the array's order and no grouping,
sorting or shuffle is needed to mint or verify it. A token log has one row for each hop instead: tokens are checked where they
lie, the first hop that fails is a partial aggregate, and a chain stays rows, however many hops a request has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions import identity as idn
from wardline.functions.exprs import element_rows, filled
from wardline.functions.lookups import lookup_join
from wardline.session import written

# in the order of their codes; a code fits in the lowest digit of a place
_ERRORS = (reg.MALFORMED_TOKEN, reg.BAD_SIGNATURE, reg.NO_EXPIRY, reg.NO_CLOCK, reg.EXPIRED_TOKEN, reg.NO_HOP)


def with_minted_chain(requests: DataFrame, issued_at: Column, key: bytes, *,
                      hops: str = "actor_chain", ttl: int = reg.TOKEN_TTL_SECONDS) -> DataFrame:
    return requests.withColumn("chain_tokens", idn.mint_chain(F.col(hops), issued_at, key, ttl))


def token_rows(requests: DataFrame) -> DataFrame:
    return element_rows(requests, ["seq"], F.col("chain_tokens"), "token", "hop_no")


def audience_rows(requests: DataFrame, hops: str = "actor_chain") -> DataFrame:
    return element_rows(requests, ["seq"], idn.audiences(F.col(hops)), "audience", "hop_no")


def signature_rows(tokens: DataFrame, key: bytes) -> DataFrame:
    """Signature of every token body, as the signer would produce it."""
    body = F.substring_index("token", ".", 1)
    return tokens.select("seq", "hop_no", idn.sign(body, key).alias("signature"))


def verified_token_rows(tokens: DataFrame, key: bytes, now: Column) -> DataFrame:
    """Each token with its error, or its claims when it is good."""
    return (tokens.withColumn("check", idn.verify(F.col("token"), key, now))
            .select("seq", "hop_no", F.col("check.error").alias("error"), "check.claims.*"))


def verified_chain_rows(requests: DataFrame, key: bytes, now: Column) -> DataFrame:
    return (requests.withColumn("check", idn.verify_chain(F.col("chain_tokens"), key, now))
            .select("seq", "check.verified", "check.chain", "check.reason"))


def checked_log(tokens: DataFrame, key: bytes, now: Column) -> DataFrame:
    """seq, hop_no, place and label of every row of a log (seq, hop_no, token), written once.

    ``place`` orders the hops that fail, by hop and then by error, and is NULL for good ones. A token without a number of
    its hop fails before all others.
    """
    check = idn.verify(F.col("token"), key, now)
    rows = tokens.withColumn("check", check).select(
        "seq", "hop_no", F.when(F.col("hop_no").isNull(), F.lit(reg.NO_HOP)).otherwise(F.col("check.error")).alias("error"),
        F.concat("check.claims.role", F.lit(":"), "check.claims.actor").alias("label"))
    code = F.array_position(F.array(*map(F.lit, _ERRORS)), F.col("error")) - 1
    place = F.when(F.col("error").isNotNull(), F.coalesce("hop_no", F.lit(-1)).cast("bigint") * 10 + code)
    return written(rows.select("seq", "hop_no", place.alias("place"), "label"), "checked-tokens")


def log_verdicts(checked: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """seq, verified, failed_hop, hops and reason of each request, from ``checked_log``.

    Reduced to one row a request before it is shuffled. ``requests`` (seq) adds those that presented no token: their verdict is NULL.
    """
    counts = checked.groupBy("seq").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("hops"))
    if requests is not None:
        counts = requests.select("seq").distinct().join(counts, "seq", "left")
    code = F.pmod("place", F.lit(10))
    error = F.element_at(F.array(*map(F.lit, _ERRORS)), (F.coalesce(code, F.lit(0)) + 1).cast("int"))
    unsigned = F.coalesce("hops", F.lit(0)) == 0
    return counts.select(
        "seq", F.when(~unsigned, F.col("place").isNull()).alias("verified"),
        F.floor((F.col("place") - code) / 10).cast("int").alias("failed_hop"),
        F.coalesce("hops", F.lit(0)).cast("bigint").alias("hops"),
        F.when(unsigned, F.lit(reg.CHAIN_UNSIGNED)).when(F.col("place").isNull(), F.lit(reg.CHAIN_VERIFIED))
        .otherwise(filled(reg.CHAIN_FAILED, error=error)).alias("reason"))


def log_chain_rows(checked: DataFrame, verdicts: DataFrame) -> DataFrame:
    """seq, hop_no and label of the hops before the first that fails; all of a verified chain."""
    failed = verdicts.filter("NOT verified").select("seq", "failed_hop")
    return lookup_join(checked.filter("place IS NULL"), failed, ["seq"], spread_by="hop_no").filter(
        "failed_hop IS NULL OR hop_no < failed_hop").select("seq", "hop_no", "label")
