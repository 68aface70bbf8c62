"""What the two classifiers share: a bounded training sample, one fitting task, and scoring of every whole text."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import give_back


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most max_rows labelled documents, drawn by a hash of their id from those that docs holds. labels may
    hold nulls and repeated rows; of several documents with one id, the text with the least hash is taken."""
    drawn = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_x_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_x_label"))
        .join(docs.select(F.col(id_col).alias("_x_id")), "_x_id", "left_semi")
        .orderBy(F.xxhash64(F.lit(17), "_x_id"), "_x_id")
        .limit(max_rows)
    )
    # at most max_rows rows of two numbers: small enough to broadcast at any corpus size
    found = docs.select(F.col(id_col).alias("_x_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")  # merged in every task first: an id can have any number of rows
    return found.join(F.broadcast(drawn), "_x_id").groupBy("_x_id", "_x_label").agg(one).select("_x_id", F.col("one.text").alias("text"), F.col("_x_label").alias("label"))


def fitted(rows: list[tuple], train: Callable[[list[str], list[int]], bytes]) -> bytes:
    """The model of rows (id, text, label), which are let go, with all that training took."""
    rows.sort()
    model = train([r[1] for r in rows], [r[2] for r in rows])
    rows.clear()
    give_back()
    return model


def fit(sample: DataFrame, train: Callable[[list[str], list[int]], bytes]) -> bytes:
    """Run train over the bounded sample in one task; its result is the model."""

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for b in batches for r in zip(b["_x_id"], b["text"], b["label"])]
        yield pd.DataFrame({"model": [fitted(rows, train)]})

    found = sample.repartition(1).mapInPandas(one, "model binary").collect()
    return bytes(found[0][0]) if found else train([], [])


def informed(model: bytes) -> bool:
    """Whether the model tells texts apart: it has weights, which only labelled rows of both classes give."""
    with np.load(io.BytesIO(model)) as f:
        return any(bool(np.any(f[name])) for name in f.files if name != "bias")


def score(df: DataFrame, scorer: Callable[[], Callable[[str | None], float]], text_col: str) -> DataFrame:
    """df with a score column from every whole text; scorer builds the function once a task."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return df.withColumn("score", scored(F.col(text_col).cast("string")))
