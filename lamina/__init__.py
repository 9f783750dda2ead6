"""Medallion change-data jobs for PySpark: change feeds, SCD2 history, quality counts, gold views."""
