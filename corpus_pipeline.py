"""A training corpus from raw documents: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's rows as
Parquet to the folder in ``spark.checkpoint.dir`` and reads them back for the next one.  All stages but
the last return the columns of ``documents``.

* language ID drops texts without a letter (or null) and texts whose best language has a posterior
  under one half; the model learns from the stage's own labelled rows, and where there are none it
  drops only texts without a letter;
* line dedup rewrites each text to its kept lines (``n_chars`` follows); a document that loses lines and
  has no word left goes, since smaller ids hold all its lines;
* near-dedup keeps the smallest id of each group (5-word shingles, similarity 0.8);
* decontamination drops documents that hold a window similar to a benchmark item;
* packing returns the pieces of the remaining documents with their bins.
"""

from pyspark.sql import functions as F

from vigil.llm import decontaminate, langid, linededup, neardup, packing
from vigil.llm.shared import free_name, written

LEAST_POSTERIOR = 0.5
WORD = r"[^\x20\x09-\x0D]"


def language_id(spark, docs, sf_dir):
    model = langid.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    name = free_name("_language", docs)
    predict = langid.predictor(model, spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.select(*columns, predict(F.col("text").cast("binary")).alias(name))
    known = (F.col(f"{name}.lang_pred") != langid.UNKNOWN) & (F.col(f"{name}.score") >= LEAST_POSTERIOR)
    return out.where(known).select(*columns)


def line_dedup(spark, docs, sf_dir):
    # columns of documents that have the operator's result names keep their values
    aside = {c: free_name("_" + c, docs) for c in docs.columns if c in ("n_lines", "n_dropped")}
    out = linededup.dedup_lines(docs.withColumnsRenamed(aside))
    out = out.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def near_dedup(spark, docs, sf_dir):
    return neardup.drop_near_duplicates(docs, k=5, percent=80)


def decontamination(spark, docs, sf_dir):
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]
# no SQL expresses the classifier or the packing; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
