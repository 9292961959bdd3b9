"""Replay-corpus analytics on Spark: DataFrame operators for event logs, splits, sequences and audits."""
