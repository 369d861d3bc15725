"""Streaming form of the scoring route: parse, build features, predict; by one model, or by whoever is champion."""

from __future__ import annotations

import uuid

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.contract import INSURED, Contract, accepted_requests, judge_requests
from plumbline.operators.scoring import score
from plumbline.sources import ledger, registry
from plumbline.sources.files import load_model


def request_schema(contract: Contract = INSURED) -> T.StructType:
    """A request: its id and every form field as text."""
    names = [name for name, _ in contract.columns if name != contract.target]
    return T.StructType([T.StructField("id", T.LongType()),
                         *[T.StructField(name, T.StringType()) for name in names]])


def request_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None,
    contract: Contract = INSURED,
) -> DataFrame:
    """Requests as they arrive in a folder."""
    reader = spark.readStream.schema(request_schema(contract)).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def score_stream(
    model: Model, stream: DataFrame, contract: Contract = INSURED, form_bounds: bool = True,
) -> DataFrame:
    """Predictions of the accepted requests alone; ``answer_stream`` also answers the refused ones."""
    return score(model, accepted_requests(judge_requests(stream, contract, form_bounds), contract))


def answer_stream(
    model: Model, stream: DataFrame, contract: Contract = INSURED, form_bounds: bool = True,
) -> DataFrame:
    """One row per request: a prediction if it was accepted, else the ``reason`` for its refusal.

    Rejected requests go through the model with the numbers of an arbitrary good one, and their
    prediction is blanked: so the source is read once. There is no state; any number of executors helps.
    """
    judged = judge_requests(stream, contract, form_bounds)
    fields = [name for name, _ in contract.columns if name != contract.target]
    rest = [name for name in judged.columns
            if name not in fields and name != "reason" and not name.startswith("typed_")]
    good, kinds = F.col("reason").isNull(), dict(contract.columns)

    def filler(name: str):
        if kinds[name] == "category":
            return F.lit(contract.choices.get(name, [""])[0])
        return F.lit(contract.form_bounds.get(name, (0,))[0]).cast("bigint" if kinds[name] == "int" else "double")

    cells = [F.when(good, F.col(f"typed_{name}")).otherwise(filler(name)).alias(name) for name in fields]
    scored = score(model, judged.select(*rest, *cells, F.col("reason").alias("__reason")))
    blank = F.col("__reason").isNotNull()
    outputs = {name: F.when(~blank, F.col(name)) for name in scored.columns if name not in (*rest, "__reason")}
    return scored.withColumns(outputs).withColumnRenamed("__reason", "reason")


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, once per file also across restarts, then stop."""
    return (df.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())


def follow_registry(
    stream: DataFrame, base: str, path: str, checkpoint: str, contract: Contract = INSURED, form_bounds: bool = True,
) -> StreamingQuery:
    """Answer what has arrived batch by batch, each by the champion that the registry below ``base`` names as the batch
    starts; one row per request, refused ones with their reason, and the ``version`` that answered.

    A batch is written to a folder of its own number below ``path``, which appears once it is whole. A batch that
    is run again after a crash replaces its folder, so no request is answered twice. Without a champion a batch fails,
    and is run again when the query is started anew. ``read_answers`` gives the answers of all batches.
    """
    spark, loaded = stream.sparkSession, {}

    def answer(batch: DataFrame, number: int) -> None:
        champion = registry.current(spark, base).first()
        if champion is None:
            raise ValueError(f"no champion is published below {base}")
        if champion["path"] not in loaded:
            loaded.clear()
            loaded[champion["path"]] = load_model(champion["path"])
        answers = answer_stream(loaded[champion["path"]], batch, contract, form_bounds)
        draft = f"{path}/.draft-{number}-{uuid.uuid4().hex}"
        answers.withColumn("version", F.lit(champion["version"])).write.parquet(draft)
        ledger.replace_folder(spark, draft, f"{path}/batch={number}")

    return (stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The answers of all finished batches, with their ``batch`` number."""
    return spark.read.parquet(path)
