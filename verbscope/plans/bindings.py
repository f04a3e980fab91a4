"""Binding of the reference's tables to the driver's test data.

tweets -> ``documents`` (doc_id -> tweet id, text -> text_orig, source -> folder),
pages of a query -> ``conversations`` (conv_id -> topic, turn -> page),
users / places -> ``customer`` / ``nation``, flagged / registered ids -> ``labels`` and
``supplier``. The verb dimension is a literal stand-in: the prose is invented, so the
verbs are word pieces that occur in it at every scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Stand-in verb dimension (verb, verb_type, ord). ``indicativo`` (the
# blank-separated conjugations) is the verb and the verb plus "s".
STAND_IN_VERBS = (
    ("ther", "epistemic", 0), ("erer", "epistemic", 1), ("oner", "stative", 2),
    ("eriner", "stative", 3), ("aner", "volitional", 4), ("ener", "volitional", 5),
    ("iner", "epistemic", 6), ("reer", "stative", 7), ("eder", "volitional", 8),
    ("heer", "epistemic", 9), ("nder", "stative", 10), ("haer", "volitional", 11),
)
# Complementisers used with the stand-in verbs (most documents are English).
BINDING_COMPLEMENTISERS = ("que", "q", "the", "that")
# The 14 headers of a corpus concordance file.
CORPUS_HEADERS = ("BIBLIOGRAFÍA", "AUTOR", "TITULO", "FECHA", "CRITERIO", "BLOQUE", "MEDIO", "SOPORTE",
                  "TEMA", "PAÍS", "ZONA", "TIPOLOGÍA", "NOTAS", "CONCORDANCIA")


def verb_rows():
    return [(v, t, f"{v} {v}s", o) for v, t, o in STAND_IN_VERBS]


def verbs_frame(spark: SparkSession) -> DataFrame:
    """The verb dimension: ``verb, verb_type, indicativo, ord``."""
    return spark.sql(f"SELECT * FROM {verbs_values_sql()}")


def verbs_values_sql() -> str:
    """The same dimension as a SQL ``VALUES`` list (for the DuckDB oracle)."""
    rows = ", ".join(f"('{v}', '{t}', '{i}', {o})" for v, t, i, o in verb_rows())
    return f"(VALUES {rows}) AS verbs(verb, verb_type, indicativo, ord)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
