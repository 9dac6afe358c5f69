"""All queries of the subpackage: the operators' and the pipeline's."""

from __future__ import annotations

import corpus_pipeline
from tallyline.llm.queries import ORACLES as OPERATOR_ORACLES
from tallyline.llm.queries import QUERIES as OPERATOR_QUERIES

QUERIES = OPERATOR_QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = dict(OPERATOR_ORACLES)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
