"""From raw documents to packed training bins: five stages over the table ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the
shared folder and reads again as the next stage's docs. All but the last return the columns of
documents. Each case of the operators (NULLs, empty and long texts, repeats, empty tables)
has the result their docstrings state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gustline.llm import language, mixing, packing, secrets, simhash
from gustline.llm.common import WORD, fresh
from gustline.session import staged_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a language; those without a letter go. A NULL ``lang`` is filled."""
    model = language.learn(docs)
    (found,) = fresh("found")
    labelled = docs.withColumn(found, language.identify(docs, model))
    kept = labelled.where(F.col(found)["lang"] != language.UNKNOWN)
    return kept.withColumn("lang", F.coalesce(F.col("lang"), F.col(found)["lang"])).drop(found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with a mark in the place of every secret; ``n_chars`` follows the text."""
    masked = secrets.mask(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the words of the blocks that the mix places: one row per document and pass.

    A pass that takes all words of a document takes its text as it is; of any other the taken
    words come in text order, joined by blanks. So a source has exactly the words that
    ``mixing.mix`` takes of it. ``n_chars`` follows the text; documents of which no block is
    taken go. Repeated rows have placements of their own.
    """
    same = fresh("no_id", "id", "hash", "no_source", "source")
    size, placements, copy, taken = fresh("size", "placements", "copy", "taken")

    def names(table: DataFrame, digest: Column) -> list[Column]:
        values = []
        for name in ("doc_id", "source"):
            kind = table.schema[name].dataType
            values.append([F.col(name).isNull(), F.coalesce(F.col(name), F.lit(0 if name == "doc_id" else "").cast(kind))])
        return [v.alias(n) for v, n in zip([*values[0], digest, *values[1]], same)]

    mixed = mixing.mix(docs).where("taken > 0")
    found = mixed.select(*names(mixed, F.col("text_hash")), F.col("size").alias(size), F.col("placements").alias(placements))
    found = found.groupBy(*same).agg(F.max(size).alias(size), F.array_sort(F.collect_list(placements)).alias(placements))
    rows = docs.select(*docs.columns, *names(docs, F.xxhash64("text")))
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(*same).orderBy(*same)))
    met = rows.join(found, same).where(F.col(copy) <= F.size(placements))
    blocks = F.element_at(placements, F.col(copy))

    def of_pass(number: Column) -> Column:
        own = F.filter(blocks, lambda p: p["pass"] == number)
        return F.array_sort(F.transform(own, lambda p: F.struct(p["from_word"].alias("at"), p["words"].alias("words"))))

    passes = F.transform(F.array_distinct(F.transform(blocks, lambda p: p["pass"])), of_pass)
    met = met.withColumn(taken, F.explode(passes))
    n_taken = F.aggregate(taken, F.lit(0).cast("long"), lambda n, p: n + p["words"])

    def some(words: Column) -> Column:
        parts = F.transform(taken, lambda p: F.slice(words, (p["at"] + 1).cast("int"), p["words"].cast("int")))
        return F.array_join(F.flatten(parts), " ")

    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    part = F.element_at(F.transform(F.array(words), some), 1)  # the words are found once
    kind = docs.schema["n_chars"].dataType
    cut = met.withColumn("text", F.when(n_taken == F.col(size), F.col("text")).otherwise(part))
    return cut.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins and texts; copies never share a bin."""
    return packing.with_text(docs, packing.pack(docs))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_bins),
]
#: The learned model, the hashes and the greedy packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        path = staged_path(spark, f"stage{number}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
