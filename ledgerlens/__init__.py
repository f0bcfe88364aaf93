"""Loan-ledger features, loss scoring and score-tiered pricing as PySpark jobs."""
