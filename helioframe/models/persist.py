"""Writing and reading of the models that MLlib does not have.

A stored model gives its state as JSON-able values, and its parts, if any,
as fitted MLlib models; both go under one folder, so the model can be saved
alone or as a stage of a pipeline.
"""

from __future__ import annotations

from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)


class StoredModel(MLWritable, MLReadable):
    """Needs ``state()``, ``parts()`` and the class method ``restored(state, parts)``."""

    def parts(self) -> list:
        return []

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        parts = self.instance.parts()
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"state": self.instance.state(), "parts": len(parts)})
        for i, part in enumerate(parts):
            part.write().save(f"{path}/parts/{i}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = [DefaultParamsReader.loadParamsInstance(f"{path}/parts/{i}", self.sparkSession)
                 for i in range(meta["parts"])]
        model = self.cls.restored(meta["state"], parts)
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
