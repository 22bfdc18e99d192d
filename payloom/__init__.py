"""Payroll and people-data warehouse built from Spark DataFrame operators."""
