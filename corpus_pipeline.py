"""From raw documents to token ids: the operators of ``wardline.llm`` one after the other.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the docs of the next. All but the last return the columns
of their docs. Extra columns pass through; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.lookups import lookup_join
from wardline.llm import language, line_dedup, mixing, near_duplicates, sentencepiece_codec
from wardline.llm.common import fresh
from wardline.llm.queries import TOKENIZER
from wardline.session import written
from wardline.sources.tables import read_parquet


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (or a text) go; a missing ``lang`` is filled in, if there is a language to learn from."""
    model = language.train(language.held_out(docs).filter("NOT held_out"))
    name, score = (fresh(docs.columns, n) for n in ("lang_pred", "score"))
    found = language.predict(docs, model, prediction=name, score=score, keep_text=True)
    told = F.when(F.col(name) != language.UNDETERMINED, F.col(name))
    return found.filter(language.has_letter(F.col("text"))).withColumn(
        "lang", F.coalesce(F.col("lang"), told)).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left with them."""
    name = fresh(docs.columns, "n_removed")
    out = line_dedup.remove_repeated_lines(docs, removed=name)
    left = out.filter((F.col(name) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col(name) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once.

    Different texts under one id are documents of their own, equal ones are one. Documents without an id can't be told
    apart and stay.
    """
    key = fresh(docs.columns, "_key")
    named, others = _with_keys(docs.filter("doc_id IS NOT NULL"), key)
    found = near_duplicates.near_duplicates(named.select(F.col(key).alias("doc_id"), "text"))
    if others is None:
        first = found.filter("kept").select(F.col("doc_id").alias(key)).distinct()
    else:
        known = lookup_join(found.select(F.col("doc_id").alias(key), "component_id").distinct(),
                            others.select(key, "_id"), [key], spread_by=key)
        first = known.groupBy("component_id").agg(F.min(F.struct(
            F.coalesce("_id", key).alias("id"), F.col(key).alias("key"))).alias("_first")).select(
            F.col("_first.key").alias(key))
    # equal rows: one stays; a shuffle by the key has been made already
    rest = ["text", *[c for c in docs.columns if c != "text"]]
    once = named.join(first, key, "left_semi").groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return once.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id IS NULL"))


def _with_keys(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a number for each id and text, and the numbers (with ``_id``) that are not the id, if any.

    Of the texts under one id one has the id as its number; the others have numbers above all ids.
    """
    number = F.col("doc_id").cast("bigint")
    texts = docs.select(number.alias("_id"), F.xxhash64("text").alias("_hash"))
    several = texts.groupBy("_id").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high")).filter("_low < _high")
    others = texts.distinct().join(several, "_id").filter("_hash > _low").select("_id", "_hash")
    others = written(others, "repeated-ids")
    if others.isEmpty():
        return docs.withColumn(key, number), None
    above = texts.agg(F.max("_id")).first()[0] + 1
    others = written(others.withColumn(key, F.monotonically_increasing_id() + F.lit(above)), "repeated-ids")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), number.alias("_id"), F.xxhash64("text").alias("_hash"))
    found = lookup_join(rows, others, ["_id", "_hash"], spread_by="_hash")
    return found.select("_row.*", F.coalesce(key, "_id").alias(key)), others


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it, whole, to the nearest copy."""
    return mixing.repeated(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, their number, and whether they decode to the text."""
    pieces = sentencepiece_codec.load_pieces(TOKENIZER)
    codec = sentencepiece_codec.build(docs, pieces)
    coded = sentencepiece_codec.encode(docs.select("doc_id", "lang", "source", "text"), codec,
                                       restored="restored")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"),
                        "token_ids", "restored")


STAGES = [
    ("language identification", identify_language),
    ("line dedup", remove_repeated_lines),
    ("near duplicates", remove_near_duplicates),
    ("source mixing", mix_sources),
    ("SentencePiece", tokenize),
]

# language identification cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
