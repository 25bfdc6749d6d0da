"""Sensitive-text detection: spans, checks, detections and tokens.

Every function maps a text Column to a Column, so one document is one row's work:
no shuffle, no Python worker, and a text of any length is scanned whole.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline import registries as reg
from wardline.functions.exprs import bind, empty_array, filled, fold_out
from wardline.functions.patterns import folded, jvm, may_match

DETECTION = "struct<data_class:string,snippet:string,confidence:string,reason:string>"
SPAN = "struct<start:int,stop:int,label:string>"
MERGED_SPAN = "struct<start:int,stop:int,labels:array<string>>"

_CARD = jvm(reg.CARD_PATTERN)
_SSN = jvm(reg.SSN_PATTERN)
_DEFINITION = jvm(reg.DEFINITION_PATTERN)
_SELECT_IN_LINE = jvm(rf"(?m)^((?>[^\n]*?(?=SELECT\s)))({reg.SELECT_PATTERN})")
_SELECT_AT_END = jvm(r"(?=SELECT\s*\n)" + reg.SELECT_PATTERN)
# both number patterns begin with a digit and go on with at least ten of these
_NUMBER_RUN = r"(?U)\d[\d -]{10}"


def _each(terms: Sequence[str]) -> tuple[tuple[str], ...]:
    return tuple((t,) for t in terms)


# class -> (pattern, ignore case, needs, longest snippet); only the first match counts
_FIRST_MATCH = (
    ("sensitive", reg.SENSITIVE_PATTERN, True, _each(reg.SENSITIVE_TERMS), None),
    ("customer", reg.CUSTOMER_PATTERN, True, _each(reg.CUSTOMER_TERMS), None),
    ("prod_log", reg.PROD_LOG_PATTERN, True, reg.PROD_LOG_NEEDS, reg.MARKER_LENGTH),
    ("source_code", reg.SOURCE_CODE_PATTERN, False, reg.SOURCE_CODE_NEEDS, reg.MARKER_LENGTH),
)
_NON_ASCII_DIGITS = [
    c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"
]
_DIGIT_FROM = "".join(_NON_ASCII_DIGITS)
_DIGIT_TO = "".join(str(unicodedata.decimal(c)) for c in _NON_ASCII_DIGITS)


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def match_spans(text: Column, pattern: str, label: str) -> Column:
    """Every match as ``(start, stop, label)``, 0-based, stop exclusive.

    The engine returns matches without positions, but the gaps between matches are
    what ``split`` returns, so a running length over both gives each position.
    """
    def step(position: Column, pair: Column) -> tuple[Column, Column]:
        begin = position + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        return end, F.array(F.struct(begin.alias("start"), end.alias("stop"),
                                     F.lit(label).alias("label")))

    def positions(hits: Column) -> Column:
        # there is one more gap than matches; the last pair has no match
        pairs = F.zip_with(hits, F.split(text, pattern, -1),
                           lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap")))
        matched = F.filter(pairs, lambda p: p["hit"].isNotNull())
        found = fold_out(matched, F.lit(0), "int", step, SPAN)
        return F.when(F.size(hits) > 0, found).otherwise(empty_array(SPAN))

    return bind(all_matches(text, pattern), positions)


def with_fold(text: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the case-folded view of the text, which is computed once."""
    return bind(folded(text), body)


def rule_applies(text: Column, fold: Column, ignore_case: bool,
                 needs: Sequence[Sequence[str]]) -> Column:
    return may_match(text, needs, fold if ignore_case else None)


def _secret_spans(text: Column, fold: Column) -> Column:
    spans = [
        F.when(rule_applies(text, fold, ignore_case, needs),
               match_spans(text, jvm(pattern, ignore_case), label)).otherwise(empty_array(SPAN))
        for label, pattern, ignore_case, needs in reg.SECRET_RULES]
    return F.sort_array(F.concat(*spans))


def secret_spans(text: Column) -> Column:
    """All spans of all secret rules, ordered by (start, stop, label)."""
    return with_fold(text, lambda fold: _secret_spans(text, fold))


def has_secret(text: Column, fold: Column) -> Column:
    """Whether any secret rule matches, without positions."""
    return reduce(lambda a, b: a | b, [
        rule_applies(text, fold, ignore_case, needs)
        & F.rlike(text, F.lit(jvm(pattern, ignore_case)))
        for _, pattern, ignore_case, needs in reg.SECRET_RULES])


def merge_spans(spans: Column) -> Column:
    """Join overlapping or touching spans; labels keep first-seen order, no repeats."""

    def step(last: Column, span: Column) -> tuple[Column, Column]:
        fresh = F.struct(span["start"].alias("start"), span["stop"].alias("stop"),
                         F.array(span["label"]).alias("labels"))
        grown = F.struct(
            last["start"].alias("start"),
            F.greatest(last["stop"], span["stop"]).alias("stop"),
            F.array_union(last["labels"], F.array(span["label"])).alias("labels"))
        touches = F.coalesce(span["start"] <= last["stop"], F.lit(False))
        done = F.when(touches | last.isNull(), empty_array(MERGED_SPAN)).otherwise(F.array(last))
        return F.when(touches, grown).otherwise(fresh), done

    # the span still open at the end is closed by one that touches nothing
    closing = F.array(F.struct(F.lit(2**31 - 1).alias("start"), F.lit(2**31 - 1).alias("stop"),
                               F.lit("").alias("label")))
    return fold_out(F.concat(spans, closing.cast(f"array<{SPAN}>")),
                    F.lit(None).cast(MERGED_SPAN), MERGED_SPAN, step, MERGED_SPAN)


def merged_secret_spans(text: Column) -> Column:
    return merge_spans(secret_spans(text))


def _detection(data_class: str, snippet: Column, confidence: str, reason: Column) -> Column:
    return F.struct(F.lit(data_class).alias("data_class"), snippet.alias("snippet"),
                    F.lit(confidence).alias("confidence"), reason.alias("reason"))


def _secret_detections(text: Column, fold: Column) -> Column:
    return F.transform(merge_spans(_secret_spans(text, fold)), lambda s: _detection(
        "secret", F.substring(text, s["start"] + 1, s["stop"] - s["start"]), "high",
        filled(reg.SECRET_REASON, labels=F.array_join(s["labels"], " + "))))


def secret_detections(text: Column) -> Column:
    return with_fold(text, lambda fold: _secret_detections(text, fold))


def ascii_digits(value: Column) -> Column:
    """Only the decimal digits of ``value``, those of other scripts turned into 0-9."""
    plain = F.translate(value, _DIGIT_FROM, _DIGIT_TO)
    folded = F.when(F.rlike(value, F.lit(r"[^\x00-\x7f]")), plain).otherwise(value)
    return F.regexp_replace(folded, "[^0-9]", "")


def is_luhn_valid(number: Column) -> Column:
    """13 to 19 digits with a correct mod-10 check digit; separators are ignored."""
    return bind(ascii_digits(number),
                lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def _number_like(text: Column, matches: Column) -> Column:
    """``matches``, sought only where a digit starts a long run of digits and separators."""
    return (F.when(F.rlike(text, F.lit(_NUMBER_RUN)), matches)
            .otherwise(F.array().cast("array<string>")))


def card_candidates(text: Column) -> Column:
    return _number_like(text, all_matches(text, _CARD))


def card_detections(text: Column) -> Column:
    return F.transform(F.filter(card_candidates(text), is_luhn_valid), lambda m: _detection(
        "pii", F.trim(m), "high", F.lit(reg.CARD_REASON)))


def ssn_detections(text: Column) -> Column:
    return F.transform(_number_like(text, all_matches(text, _SSN)),
                       lambda m: _detection("pii", m, "high", F.lit(reg.SSN_REASON)))


def source_code_match(text: Column) -> Column:
    """The first match of ``SOURCE_CODE_PATTERN``, or an empty text, in time that grows with the text only.

    Trying each SELECT would read the rest of its line each time. But if the first one of a line finds no FROM, no other
    one of the line does, unless the line ends with it: it alone can go on in the next line. So two searches find
    the first SELECT that matches, one reading each line once, one trying the SELECTs at ends of lines.
    """
    def found(at: Column, snippet: Column) -> Column:
        return F.when(at > 0, F.struct(at.alias("at"), snippet.alias("snippet")))

    line, last = F.regexp_instr(text, F.lit(_SELECT_IN_LINE)), F.regexp_instr(text, F.lit(_SELECT_AT_END))
    # places are counted in UTF-16 units
    indent = F.octet_length(F.encode(F.regexp_extract(text, _SELECT_IN_LINE, 1), "UTF-16BE")) / 2
    selects = [found(F.when(line > 0, line + indent.cast("int")), F.regexp_extract(text, _SELECT_IN_LINE, 2)),
               found(last, F.regexp_extract(text, _SELECT_AT_END, 0))]
    definition = F.regexp_extract(text, _DEFINITION, 0)
    first = F.least(found(F.regexp_instr(text, F.lit(_DEFINITION)), definition), *selects)
    has_select = F.contains(text, F.lit("SELECT")) & F.contains(text, F.lit("FROM"))
    return F.when(has_select, F.coalesce(first["snippet"], F.lit(""))).otherwise(definition)


def _first_match_detections(text: Column, fold: Column, classes: Sequence[str]) -> Column:
    found = []
    for data_class, pattern, ignore_case, needs, longest in _FIRST_MATCH:
        if classes and data_class not in classes:
            continue
        snippet = (source_code_match(text) if data_class == "source_code"
                   else F.regexp_extract(text, jvm(pattern, ignore_case), 0))
        if longest:
            snippet = F.substring(snippet, 1, longest)
        snippet = F.when(rule_applies(text, fold, ignore_case, needs), snippet).otherwise("")
        found.append(_detection(data_class, snippet, "medium",
                                F.lit(reg.FIRST_MATCH_REASONS[data_class])))
    return F.filter(F.array(*found), lambda d: d["snippet"] != "")


def first_match_detections(text: Column, *classes: str) -> Column:
    """First match of each term class, in class order; all four when none is named."""
    return with_fold(text, lambda fold: _first_match_detections(text, fold, classes))


def classify(text: Column) -> Column:
    """Everything sensitive in ``text``, most severe class first.

    The parts are concatenated in severity order, so no sort is needed.
    """
    return with_fold(text, lambda fold: F.concat(
        _secret_detections(text, fold), card_detections(text), ssn_detections(text),
        _first_match_detections(text, fold, ())))


def value_token(data_class: Column, value: Column) -> Column:
    """Deterministic stand-in for a sensitive value."""
    digest = F.sha2(F.concat(data_class, F.lit(":"), value), 256)
    return F.concat(F.lit("tok_"), data_class, F.lit("_"), F.substring(digest, 1, 8))


def short_hash_token(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(value, 256), 1, 8))


def sanitize(text: Column, detections: Column) -> Column:
    """Replace each detected snippet in turn: secrets by a marker, the rest by a token.

    A snippet of one class is replaced everywhere at its first turn, so repeats have none.
    """
    distinct = F.array_distinct(F.transform(detections, lambda d: F.struct(
        d["data_class"].alias("data_class"), d["snippet"].alias("snippet"))))
    return F.aggregate(distinct, text, lambda acc, d: F.replace(
        acc, d["snippet"],
        F.when(d["data_class"] == "secret", F.lit(reg.BLOCKED_MARKER))
        .otherwise(value_token(d["data_class"], d["snippet"]))))


def vault_entries(detections: Column) -> Column:
    """Distinct ``(token, value)`` pairs of a record, in first-use order."""
    tokenized = F.filter(detections, lambda d: d["data_class"] != "secret")
    return F.array_distinct(F.transform(tokenized, lambda d: F.struct(
        value_token(d["data_class"], d["snippet"]).alias("token"),
        d["snippet"].alias("value"))))


def estimated_tokens(text: Column) -> Column:
    quarter = F.call_function("div", F.length(text), F.lit(reg.CHARS_PER_TOKEN))
    return F.greatest(F.lit(1).cast("bigint"), quarter)
