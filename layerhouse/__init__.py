"""Layered retail warehouse (bronze, silver, gold) as composable PySpark operators."""
