"""Spark-native document harvesting and publishing pipeline.

Pages, postings and extracted document text come in as tables; selector
extraction, rules with a recorded reason, text clean-up, de-duplication
against a target, append-only targets and a run report go out.  Every
operator is a DataFrame -> DataFrame (or Column -> Column) function.
"""

from quarry.params import RunParams

__all__ = ["RunParams"]
