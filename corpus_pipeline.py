"""The training-data pipeline: its stages are in ``ledgerline.llm.pipeline``. Goes with that subpackage."""

from ledgerline.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
