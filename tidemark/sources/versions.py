"""Model versions: a folder for each fit, published by one file creation, picked up between batches.

A version counts from the moment an empty marker with its name appears. A fit that dies before leaves a folder that nobody
reads; publishing the same fit again makes another version. Versions are numbered by one publisher at a time; should
two take one number, both markers stand and the later name wins for every reader alike.

Layout: ``versions/<number>-<token>`` and ``published/<number>-<token>``.

Defined cases: before the first version there is no model, and asking for one is an error; removing keeps the newest ``keep`` versions,
and a folder without a marker goes with the first removal whose kept versions are all newer.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import SparkSession

from tidemark.operators.ml import load_model, save_model
from tidemark.sources import latest

_DIGITS = 20


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    model: Model


def _number(name: str) -> int:
    return int(name[:_DIGITS])


def publish(spark: SparkSession, model: Model, path: str) -> int:
    """Save a fit and make it the current version; gives its number, from 1."""
    made = latest.published(spark, path)
    number = _number(made[-1]) + 1 if made else 1
    name = f"{number:0{_DIGITS}d}-{uuid.uuid4().hex}"
    save_model(model, f"{path}/versions/{name}")
    latest.publish(spark, path, name)
    return number


def load(spark: SparkSession, path: str, kind: str, number: int | None = None) -> Version:
    """The current version, or the one with a number."""
    made = [n for n in latest.published(spark, path) if number is None or _number(n) == number]
    if not made:
        raise LookupError(f"no published version {'' if number is None else number} in {path}")
    return Version(_number(made[-1]), made[-1], load_model(f"{path}/versions/{made[-1]}", kind))


def remove_old(spark: SparkSession, path: str, keep: int = 3) -> None:
    """Drop all but the newest versions: markers first, so that none names a folder that is gone."""
    kept = latest.published(spark, path)[-max(keep, 1):]
    if not kept:
        return
    for part in ("published", "versions"):
        for name in latest.names(spark, f"{path}/{part}"):
            if name not in kept and _number(name) < _number(kept[0]):
                latest.remove(spark, f"{path}/{part}/{name}")


class Current:
    """The current version for a running job: looks at the markers when asked, loads only what is new."""

    def __init__(self, path: str, kind: str):
        self.path, self.kind = path, kind
        self._held: Version | None = None

    def get(self, spark: SparkSession) -> Version:
        made = latest.published(spark, self.path)
        if self._held is None or not made or made[-1] != self._held.name:
            self._held = load(spark, self.path, self.kind)
        return self._held
