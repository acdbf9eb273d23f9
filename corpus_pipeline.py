"""A corpus from raw documents to packed sequences, in five stages.

Each stage works on all that the one before kept; between stages the documents
are written as Parquet to the shared folder and read back.  What a stage
decides about a text holds for that text: rows are told apart by id and text,
so neither a missing id nor one that occurs twice mixes them up.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import fourier_quality, gru_langid, harmonic_packing, ngram_join, spaced_seeds
from marquee.llm.common import bit_table, bits_for, crc_mod, marked, read
from marquee.session import stage

#: A text whose most likely language has less than this share of its letters is no prose.
MIN_LANGUAGE_SCORE = 0.4
#: Documents below this chance of good quality go.
MIN_QUALITY = 0.3

#: SQL expresses none of the stages.
ORACLE_SQL = None


def _number() -> Column:
    """A number for the id and the text together: 63 bits, so among 10^9 rows two share one with a chance of 1 in 20."""
    return F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 63) - 1))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those in no language the model knows."""
    plain = docs.select("doc_id", "text", "lang")
    model = gru_langid.train(plain.filter(crc_mod("doc_id", 4) != 2))
    found = _fresh(docs, "langid")
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias(found))
    told = gru_langid.identify(packed, model, text=found, carry=("row",))
    kept = told.filter(
        (F.col("lang_pred") != gru_langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    )
    return kept.select("row.*")


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of low quality, as learnt from the labels of those not held out."""
    labels = read(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("y"))
    part = crc_mod("doc_id", 4)
    rows = fourier_quality.statistics(docs.select("doc_id", "text")).join(labels, "doc_id")
    model = fourier_quality.fit(stage(rows.filter(part != 2), "labelled-stats"), part == 3)
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    # Two Python steps in one task would be two workers, whose memory the later stages have to bear.
    return (
        fourier_quality.score(packed, model, carry=("row",), text="text")
        .filter(F.col("score") >= MIN_QUALITY)
        .select("row.*")
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays.

    Ids that are missing come last, and of several texts under one id the one with the smallest
    number is taken.  Texts without words are in no component and stay.  Of rows that repeat id and
    text one stays, whatever their other columns hold.
    """
    number = _fresh(docs, "number")
    numbered = docs.withColumn(number, _number())
    members, _ = ngram_join.join_similar(numbered.select(F.col(number), "text"), doc=number)
    ids = numbered.groupBy(F.col(number).alias("doc_id")).agg(
        F.first("doc_id").alias("id"), F.count("*").alias("rows")
    )
    groups = members.select("doc_id", "component_id").distinct().join(ids, "doc_id")
    groups = stage(groups.withColumnRenamed("doc_id", number), "document-groups")
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", number, "rows"))
    kept = stage(
        groups.groupBy("component_id").agg(first.alias("first")).select(f"first.{number}", "first.rows"),
        "kept-documents",
    )
    # Numbers that go, or of whose rows one stays, become bits that every task gets.  Rows without
    # one stay where they are; those to keep that have one are picked exactly, and only they are shuffled.
    bits = bits_for(groups.count())
    others = groups.select(number).join(kept.filter("rows = 1").select(number), number, "left_anti")
    table = stage(bit_table(others, number, bits), "dropped-bits")
    check = stage(marked(kept.select(number), number, table, bits), "kept-to-check")
    left = marked(numbered, number, table, bits, "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    once = (
        marked(numbered, number, bit_table(check, number, bits), bits)
        .join(check, number)
        .groupBy(number)
        .agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("row"))
        .select("row.*")
    )
    return left.unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item."""
    number = _fresh(docs, "number")
    numbered = docs.withColumn(number, _number())
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    found = spaced_seeds.find_overlaps(numbered.select(number, "text"), items, doc=number)
    found = stage(found.select(number).distinct(), "contaminated")
    return numbered.join(found, number, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents; a digest stands for the ids of each piece."""
    pieces = harmonic_packing.pack(
        docs.select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("language identification", identify_language),
    ("quality classifier", judge_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
