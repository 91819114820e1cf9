"""Composable PySpark operators for card and loan risk analytics."""
