"""From raw review files to the evaluation document of a classifier, as one job that can go on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import sampling
from . import modelling, training_data
from .stages import run_stages


def run(spark: SparkSession, csv_path: str, out: str, cap: int = sampling.CLASS_CAP, multi_line: bool = True,
        resume: bool = True) -> list[str]:
    """Run what is not done yet of both jobs; the names of the stages that ran. The document is in ``out``."""
    data = training_data.job(spark, csv_path, f"{out}/data", cap, multi_line)
    fit = modelling.job(spark, f"{out}/data/sampled_csv", f"{out}/data/remaining", f"{out}/model")
    return run_stages(spark, out, [*data, *fit], resume)
