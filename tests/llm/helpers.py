"""Small tables with the awkward cases."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list[tuple], extra: bool = False) -> DataFrame:
    """Rows of (doc_id, text, source); `extra` adds columns whose names the operators use inside."""
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("row", "text_key", "cut", "rest", "new", "words", "word", "anchor", "score", "score_0", "label", "key", "hub",
                     "component_id", "kept", "contaminated", "token_ids", "signature", "n_words", "y", "place", "block"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def folded(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed: int, n: int) -> list[str]:
    """Words that hardly repeat from seed to seed."""
    import random
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)]
