"""The corpus pipeline: language identification, near-duplicates, repeated passages, packing.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written and read again as the next one's input.
The first three return the columns of ``documents``; the last returns packed
pieces.

A stage's result reads the intermediate tables of its operator.  ``run`` hands
each stage a list of its own for their folders and removes them when the result
has been written.  A stage called without such a list leaves its folder to
``finish_stages``, which is to be called when nothing reads the result any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from drayline.llm import use_small_batches
from drayline.llm.language_id import fit, predict
from drayline.llm.packing import pack_documents
from drayline.llm.queries import vocabulary
from drayline.llm.simhash_dedup import keep_one
from drayline.llm.suffix_dedup import repeated_spans
from drayline.registry.base import Query
from drayline.session import RunFolder, use_utc

#: Several steps of the pipeline cannot be put in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


_alone: list[RunFolder] = []  # folders of stages that were called by themselves


def _folder(spark: SparkSession, label: str, held: list[RunFolder] | None) -> RunFolder:
    held = _alone if held is None else held
    held.append(RunFolder(spark, label))
    return held[-1]


def finish_stages(held: list[RunFolder] | None = None) -> None:
    """Remove the intermediate tables of the stages that were given this list, or of those called without one."""
    held = _alone if held is None else held
    while held:
        held.pop().close()


def _by_place(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns named by place, and the place of each name: no name can clash with a stage's own."""
    return docs.toDF(*[f"d{i}" for i in range(len(docs.columns))]), {c: f"d{i}" for i, c in enumerate(docs.columns)}


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[f"d{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, held: list[RunFolder] | None = None) -> DataFrame:
    """Drop documents that language identification rejects: null, without a letter, or like no known language.

    The models are fitted on a bounded sample of the labelled documents of the
    input.  Documents that stay are unchanged.
    """
    use_small_batches(spark)
    plain, place = _by_place(docs)
    judged = predict(plain, fit(docs, "text", "lang"), place["text"])
    return _named(judged.where(~F.col("rejected")), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, held: list[RunFolder] | None = None) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of SimHash near-duplicates."""
    use_small_batches(spark)
    return keep_one(docs, _folder(spark, "near_duplicates", held))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, held: list[RunFolder] | None = None) -> DataFrame:
    """Cut every passage of 200 bytes or more that also stands elsewhere out of the texts.

    A character of which only a part is covered goes as a whole.  ``n_chars``
    follows the text.  A document of which nothing but blanks is left after a
    cut is dropped; all others stay, untouched where nothing repeats.
    """
    use_small_batches(spark)
    plain, place = _by_place(docs)
    text = place["text"]
    found = repeated_spans(plain, _folder(spark, "repeated_passages", held), text).withColumn(text, F.col("kept"))
    found = found.where((F.col("n_removed") == 0) | (F.length(F.trim(text)) > 0))
    if "n_chars" in place:
        counted = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col(place["n_chars"]))
        found = found.withColumn(place["n_chars"], counted.cast(docs.schema["n_chars"].dataType))
    return _named(found, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, held: list[RunFolder] | None = None) -> DataFrame:
    """Pack the token ids of the documents into sequences of at most 4096."""
    use_small_batches(spark)
    run = _folder(spark, "packing", held)
    return pack_documents(docs.select("doc_id", "text"), run, vocabulary("word_bpe_49k.json"), want_ids=False)


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", repeated_passage_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored before the next begins."""
    use_utc(spark)
    folder, held = RunFolder(spark, "pipeline"), []
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    try:
        for name, stage in STAGES:
            docs = folder.keep(stage(spark, docs, sf_dir, held), name)
            finish_stages(held)
        return folder.result(docs)
    except BaseException:
        finish_stages(held)
        folder.close()
        raise


QUERIES = {"pipeline": Query("pipeline", run, ORACLE_SQL)}
