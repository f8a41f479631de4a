"""Objects of bounded size sent to every task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` inside tasks; it is sent once per executor.

    The bytes carry the value's class along, so workers need no copy of this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get():
        if not held:
            held.append(pickle.loads(sent.value))
        return held[0]

    return get
