"""From raw documents to a training mix, in five stages. Every stage takes what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.llm.decontaminate import find_contamination
from vanewatch.llm.line_dedup import LEAST_WORDS, many_sites, remove_lines
from vanewatch.llm.ngram_join import group_similar, restrict
from vanewatch.llm.source_mix import mix_sources
from vanewatch.llm.toxicity import THRESHOLD, fit_network, score_texts
from vanewatch.llm.words import free_names
from vanewatch.scratch import remove, settle, shared_dir

# near copies in a corpus: similarity in hundredths of the sets of so many words; the query of the operator has its own
COPY_WORDS, COPY_SIMILAR = 5, 80


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells documents apart, and its name: their id if all have one of their own.

    Else it is a hash of id and text, so that rows without an id, and different texts of one id, count as documents;
    rows that agree in both are one document.
    """
    rows, distinct = docs.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if rows == distinct:
        return docs, "doc_id"
    (key,) = free_names(docs.columns, "row_key")
    return docs.withColumn(key, F.xxhash64("doc_id", "text")), key


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the network rejects, whatever the number of rows that hold their text.

    Null and empty texts have the network's base score, which is low, and stay. Without labels of both kinds nothing
    is rejected. Ties do not matter, as each row is judged on its own. An empty table gives an empty one; columns of
    any name are kept.
    """
    network = fit_network(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = free_names(docs.columns, "toxicity_score")
    return score_texts(docs, network, score=score).filter(F.col(score) < THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines of ``LEAST_WORDS`` words or more that stand on many sites; every row stays.

    Many is half of the sites, from 3 to 10. A null source is a site; null texts stay null, texts of such lines alone
    become empty. Repeated rows are treated alike. ``n_chars`` is set anew, to null for a null text. An empty table
    gives an empty one; columns of any name are kept.
    """
    cleaned = remove_lines(docs, min_sites=many_sites(docs), min_words=LEAST_WORDS)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id.

    Rows without an id come last in their group, and of those the one with the smallest hash stays. Rows that agree
    in id and text are one document, of which one row stays; different texts of one id are different documents.
    Texts without words are copies of nothing. An empty table gives an empty one; columns of any name are kept.
    """
    rows, key = keyed(docs)
    groups = settle(group_similar(rows, id_column=key, shingle_words=COPY_WORDS, similar=COPY_SIMILAR))
    if key == "doc_id":
        copies = groups.filter("doc_id <> component_id").select("doc_id")
        return restrict(docs, "doc_id", settle(copies), keep=False)
    own = rows.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("id")).distinct()
    order = F.struct(F.col("id").isNull().alias("last"), "id", "doc_id")
    groups = settle(groups.distinct().join(own, "doc_id"))
    first = groups.groupBy("component_id").agg(F.min(order).alias("first")).select("first.doc_id")
    copies = groups.join(first, "doc_id", "left_anti").select("doc_id")
    kept = restrict(rows, key, settle(copies), keep=False)
    # one row of each document
    repeated = settle(kept.groupBy(key).count().filter("count > 1").select(key))
    once = restrict(kept, key, repeated, keep=True).dropDuplicates([key])
    return restrict(kept, key, repeated, keep=False).unionByName(once).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, with all their rows, whether they have an id or not.

    Null and empty texts hold nothing and null and empty items are in nothing. Of several texts of one id only those
    that hold an item go. Without items nothing is dropped, an empty table gives an empty one, and columns of any name
    are kept.
    """
    rows, key = keyed(docs)
    found = find_contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column=key)
    return restrict(rows, key, settle(found.select("doc_id").distinct()), keep=False).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words from, with the number of words.

    Null and empty texts give no words and go. A null source is a source. Rows that repeat each other may be taken
    one without the other, in the same number in every run. An empty table gives an empty one; of columns with the
    names of results (``size``, ``source_size``, ``target``, ``taken``) the results stay.
    """
    return mix_sources(docs).filter("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# a trained network and set signatures have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two of them the rows are written and read again.

    A stage's rows are removed once the next one's are written.
    """
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
