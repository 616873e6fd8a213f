"""Models kept as SQL files."""

from __future__ import annotations

from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# The models that come with the library.
FOLDER = Path(__file__).resolve().parent.parent / "models"


def register_sql_models(spark: SparkSession, folder: str | Path = FOLDER) -> list[str]:
    """Register every ``*.sql`` file of a folder as a view named like the file; returns the names in the order they took.

    A file holds one SELECT and may refer to other files' models, in any order, and to views and tables that are there
    already. Spark finds out which: a model whose statement names one still missing waits for it. Models that refer to one
    another in a circle, or to themselves, are a ValueError; any other error of a statement is raised as it is. Views of
    the same names are replaced, and keep the models they referred to when they were registered.
    """
    paths = sorted(Path(folder).glob("*.sql"))
    waiting = {path.stem: path.read_text(encoding="utf-8").strip().removesuffix(";") for path in paths}
    for name in waiting:  # else a model could take an old view for one of the folder's
        spark.catalog.dropTempView(name)
    registered: list[str] = []
    while waiting:
        missing: dict[str, AnalysisException] = {}
        for name, sql in waiting.items():
            try:
                spark.sql(sql).createOrReplaceTempView(name)
                registered.append(name)
            except AnalysisException as error:
                if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                    raise
                missing[name] = error
        if len(missing) == len(waiting):
            for error in missing.values():
                if error.getMessageParameters()["relationName"].strip("`") not in waiting:
                    raise error
            raise ValueError(f"models refer to one another in a circle: {', '.join(missing)}")
        waiting = {name: waiting[name] for name in missing}
    return registered
