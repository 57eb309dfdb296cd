"""Loan-default features, labels, scoring and monitoring as PySpark DataFrame jobs."""
