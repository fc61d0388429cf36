"""Small tables with the odd cases that every operator meets."""

import random

import pandas as pd
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOICES = ["the", "und", "ñandú", "ridge", "Stone", "river", "été", "open", "quiet", "marl", "fern", "loom", "gate", "salt"]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(VOICES) + str(pick.randrange(40)) for _ in range(n))


def odd_texts():
    a, b, c = prose(1, 60), prose(2, 90), prose(3, 45)
    return [
        a, a, a.upper(), b, b + " tail", "intro " + b, c, None, "", "   \t\n ", "word", "one two three four",
        f"{c}\n{a}\nshared closing line\n", f"shared closing line\n{b}", "  Shared Closing LINE \r\nother", "\n\n\n",
        " ".join([prose(4, 30)] * 3), prose(5, 6000), prose(5, 6000) + " x", "ſecret K ﬁ Σίσυφος é́   end", "日本語 テキスト " * 30,
    ]


def frame(spark, texts=None, ids=None):
    texts = odd_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "s", len(t) if t is not None else None) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def odd(spark):
    """Odd texts, a null id, a row twice, and columns whose names operators use themselves."""
    texts = odd_texts()
    docs = frame(spark, [*texts, texts[3], prose(9, 70)], [*range(len(texts)), 3, None])
    return docs.withColumns({"score": F.lit("mine"), "n_lines": F.lit(-1), "kept": F.lit("?"), "labels": F.lit(None).cast("string"), "n_words": F.lit(1)})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df) -> pd.DataFrame:
    return df.toPandas()
