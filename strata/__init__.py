"""strata: a Spark-native layered batch pipeline.

Raw files -> quarantine/staging -> SCD2 history -> incremental intermediate
tables -> marts -> data-quality checks and report -> exports.  Every operator
takes and returns Spark DataFrames; nothing is collected to the driver except
small scalar results (counts, watermarks, verdicts).
"""

from strata.session import get_spark, prepare_session, checkpoint_dir

__all__ = ["get_spark", "prepare_session", "checkpoint_dir"]
