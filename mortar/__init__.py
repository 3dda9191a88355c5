"""Loan-pool analytics for securitised mortgages as lazy Spark DataFrame operators."""
