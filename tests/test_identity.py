import base64
import hashlib
import hmac
import json

from pyspark.sql import functions as F

from wardline.functions import identity as idn

KEY = b"test-key"
HOPS = "array<struct<actor:string,role:string,intent:string>>"
CHAIN = [("alice", "human", "debug"), ("zoé \U0001f600\"\\", "agent", "x" * 120), ("r", "reader", "y")]


def url64(raw):
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def signed(body, key=KEY):
    return body + "." + url64(hmac.new(key, body.encode(), hashlib.sha256).digest())


def token(actor, role, intent, aud, now=1000, ttl=300):
    claims = {"actor": actor, "role": role, "intent": intent, "aud": aud, "iat": now, "exp": now + ttl}
    return signed(url64(json.dumps(claims, separators=(",", ":")).encode()))


def chain_of(spark, hops=CHAIN, now=1000, key=KEY):
    df = spark.createDataFrame([(hops,)], f"hops {HOPS}")
    return df.select(idn.mint_chain(F.col("hops"), F.lit(now), key).alias("t")).first().t


def check(spark, tokens, now):
    df = spark.createDataFrame([(tokens,)], "t array<string>")
    return df.select(idn.verify_chain(F.col("t"), KEY, F.lit(now)).alias("c")).first().c


def test_tokens_equal_a_standard_hmac(spark):
    expected = [token(*hop, aud) for hop, aud in zip(CHAIN, ("agent", "reader", "guardrail"))]
    assert chain_of(spark) == expected


def test_claims_are_escaped_like_json_dumps(spark):
    odd = ["\x0b\x1f\x0e\x01", "\\u000B", "\\\x0b\\\\\x0b", "\x7f\x80 ", "\t\n\r\b\f/"]
    hops = [(o, "r", "i") for o in odd]
    auds = ["r"] * (len(odd) - 1) + ["guardrail"]
    assert chain_of(spark, hops) == [token(*h, a) for h, a in zip(hops, auds)]


def test_long_keys_are_hashed_first(spark):
    key = b"k" * 100
    df = spark.createDataFrame([("body",)], "b string")
    assert "body." + df.select(idn.sign(F.col("b"), key).alias("s")).first().s == signed("body", key)


def test_chain_verdicts(spark):
    good = chain_of(spark)
    ok = check(spark, good, 1300)
    assert ok.verified and ok.reason == "all hops verified"
    assert ok.chain == [f"{role}:{actor}" for actor, role, _ in CHAIN]
    assert check(spark, good, 1301).reason == "chain verification failed: expired"
    for tokens in (None, []):
        unsigned = check(spark, tokens, 1000)
        assert unsigned.verified is None and unsigned.reason == "no signed identity presented"


def test_first_bad_hop_ends_the_chain(spark):
    good = chain_of(spark)
    tampered = check(spark, [good[0], good[1][:-3] + "zzz", "x"], 1000)
    assert tampered.verified is False and tampered.chain == ["human:alice"]
    assert tampered.reason == "chain verification failed: bad signature"
    for bad in ("nodots", "a.b.c", good[0].replace(".", "")):
        assert check(spark, [bad], 1000).reason == "chain verification failed: malformed token"
    assert check(spark, ["%%.%%"], 1000).reason == "chain verification failed: bad signature"
    assert check(spark, chain_of(spark, key=b"other"), 1000).verified is False


def test_a_token_log_has_the_verdicts_of_its_chains(spark):
    from wardline.operators import identity

    good = chain_of(spark)
    late, forged = chain_of(spark, now=1), good[1][:-3] + "zzz"
    chains = {1: good, 2: [good[0], forged, late[2]], 3: [late[0], good[1], good[2]], 4: [good[0], None, good[2]], 5: []}
    rows = [(seq, hop, token) for seq, tokens in chains.items() for hop, token in enumerate(tokens)]
    rows += [(6, None, good[0]), (6, 0, good[0])] + [(7, hop, good[hop % 3] if hop != 1500 else forged) for hop in range(2000)]
    log = spark.createDataFrame(rows, "seq long, hop_no int, token string").repartition(4)
    checked = identity.checked_log(log, KEY, F.lit(1200))
    requests = spark.createDataFrame([(s,) for s in range(1, 8)], "seq long")
    verdicts = {r.seq: r for r in identity.log_verdicts(checked, requests).collect()}
    labels = {}
    for r in identity.log_chain_rows(checked, identity.log_verdicts(checked)).orderBy("seq", "hop_no").collect():
        labels.setdefault(r.seq, []).append(r.label)
    for seq, tokens in chains.items():
        one = check(spark, tokens, 1200)
        assert (verdicts[seq].verified, verdicts[seq].reason) == (one.verified, one.reason)
        assert labels.get(seq, []) == one.chain
    assert verdicts[6].reason.endswith("no hop number") and 6 not in labels and verdicts[6].failed_hop == -1
    assert verdicts[7].failed_hop == 1500 and len(labels[7]) == 1500 and verdicts[7].hops == 2000
