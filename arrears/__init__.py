"""Loan data mart, delinquency labels and credit scoring as Spark jobs."""
