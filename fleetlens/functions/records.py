"""Hooks for a user's own per-record code."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetlens.functions.scalar import feature_name

Handler = Callable[[str, str], list[dict]]


def apply_preprocessor(records: DataFrame, preprocessor: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A preprocessor written as a DataFrame transformation; it stays in the plan."""
    return records.transform(preprocessor)


def apply_handler(records: DataFrame, handler: Handler, schema: T.StructType) -> DataFrame:
    """A preprocessor written in Python: request and response text in, rows as dictionaries out.

    ``records`` has the columns ``inferenceId``, ``request`` and ``response``. Records stay in
    their partitions and pass in Arrow batches.
    """
    names = schema.names

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                {"inferenceId": key, **row}
                for key, request, response in zip(frame["inferenceId"], frame["request"], frame["response"])
                for row in handler(request, response)
            ]
            yield pd.DataFrame(rows, columns=names)

    return records.select("inferenceId", "request", "response").mapInPandas(batches, schema)


def positional_features(request: str, response: str) -> list[dict]:
    """Default handler: each inner list of the request becomes a row of positional features."""
    return [{feature_name(i): value for i, value in enumerate(record)} for record in json.loads(request)]
