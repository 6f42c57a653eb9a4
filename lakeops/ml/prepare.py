"""The preparation of a table as a stage of a ``pyspark.ml`` chain, kept with all it has learned."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame

from lakeops.ml.features import Preparation

DICTIONARY = "column string, value string, code bigint"


class _Columns(Params):
    """The columns a preparation is about; ``date`` is empty where there is none."""

    numeric = Param(Params._dummy(), "numeric", "columns whose nulls are filled with the median", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "columns that become codes", TypeConverters.toListString)
    date = Param(Params._dummy(), "date", "a date that becomes its parts", TypeConverters.toString)

    def columns(self) -> tuple[list[str], list[str], str | None]:
        return self.getOrDefault(self.numeric), self.getOrDefault(self.categories), self.getOrDefault(self.date) or None


class Prepare(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the medians and codes of one table; see ``features.Preparation``."""

    @keyword_only
    def __init__(self, *, numeric=None, categories=None, date=""):
        super().__init__()
        self._setDefault(numeric=[], categories=[], date="")
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _fit(self, dataset: DataFrame) -> Prepared:
        return self._copyValues(Prepared(Preparation.fit(dataset, *self.columns())))


class Prepared(Model, _Columns, MLReadable, MLWritable):
    """A fitted preparation. Saved, its dictionary is a table of its own beside the medians, however many codes there are."""

    def __init__(self, preparation: Preparation | None = None):
        super().__init__()
        self._setDefault(numeric=[], categories=[], date="")
        self.preparation = preparation

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.preparation.transform(dataset)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: Prepared):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        held = self.stage.preparation
        learned = {"fills": held.fills, "flagged": held.flagged}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"learned": learned})
        if held.dictionary is not None:
            held.dictionary.write.parquet(f"{path}/dictionary")


class _Reader(MLReader):
    def load(self, path: str) -> Prepared:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = Prepared()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        _, categories, date = stage.columns()
        codes = self.sparkSession.read.schema(DICTIONARY).parquet(f"{path}/dictionary") if categories else None
        stage.preparation = Preparation(date, metadata["learned"]["fills"], metadata["learned"]["flagged"], codes, categories)
        return stage
