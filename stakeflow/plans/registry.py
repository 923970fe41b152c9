"""The queries over the driver's tables, by name, and the SQL that each must agree with."""

from stakeflow.plans import artifact_queries, audit_queries, feature_queries, live_queries, model_queries, ranking_queries, sequence_queries, training_queries

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (sequence_queries, feature_queries, ranking_queries, audit_queries, model_queries, training_queries, live_queries, artifact_queries):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
