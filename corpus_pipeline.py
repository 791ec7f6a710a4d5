"""The corpus pipeline: STAGES in order, and run(), which applies them to documents. The stages are in quadrangle.llm.stages."""

from quadrangle.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
