"""User code in the flow: per-message handlers and stage functions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Stage = Callable[[DataFrame, Mapping[str, str]], DataFrame]


def apply_handler(
    messages: DataFrame, handler: Callable[[Any], Any], value: str = "value"
) -> DataFrame:
    """Call ``handler`` on every decoded JSON payload; one bad message never stops the rest.

    Adds ``result`` (JSON text of what the handler returned), ``error_type`` and
    ``error_message``. Decoding problems are reported like handler errors.
    """
    schema = T.StructType(
        [
            *messages.schema.fields,
            T.StructField("result", T.StringType()),
            T.StructField("error_type", T.StringType()),
            T.StructField("error_message", T.StringType()),
        ]
    )

    def one(raw: bytes | None) -> tuple[str | None, str | None, str | None]:
        try:
            payload = json.loads(bytes(raw).decode("utf-8"))
            return json.dumps(handler(payload), default=str), None, None
        except Exception as exc:  # noqa: BLE001 - isolation is the feature
            return None, type(exc).__name__, str(exc)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            done = [one(v) for v in pdf[value]]
            yield pdf.assign(
                result=[d[0] for d in done],
                error_type=[d[1] for d in done],
                error_message=[d[2] for d in done],
            )

    return messages.mapInPandas(batches, schema)


def run_stages(df: DataFrame, context: Mapping[str, str], *stages: Stage) -> DataFrame:
    """Compose stage functions; each gets the data and the run's context."""
    return reduce(lambda acc, stage: acc.transform(stage, context), stages, df)
