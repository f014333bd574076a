"""Shared parameters of the fit/transform stages.

The stages are ordinary ``pyspark.ml`` transformers, estimators and models: they chain in a
``Pipeline``, each fitted on the output of the one before, and persist with ``write().save``.
Columns a stage names but a table lacks are skipped, so a pipeline fitted with targets scores
rows without them.
"""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame


def param(name: str, doc: str, convert=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, convert)


class Persisted(DefaultParamsReadable, DefaultParamsWritable):
    """JSON persistence of all params, fitted state included."""


class HasRoles(Params):
    """Column roles: numeric and categorical column names."""

    numericCols = param("numericCols", "numeric column names", TypeConverters.toListString)
    categoricalCols = param("categoricalCols", "categorical column names", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[])

    def _numeric(self, df: DataFrame) -> list[str]:
        return [c for c in self.getOrDefault("numericCols") if c in df.columns]

    def _categorical(self, df: DataFrame) -> list[str]:
        return [c for c in self.getOrDefault("categoricalCols") if c in df.columns]
