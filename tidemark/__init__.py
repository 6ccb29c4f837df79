"""Growth, unit-economics and ledger analytics as composable PySpark DataFrame operators."""
