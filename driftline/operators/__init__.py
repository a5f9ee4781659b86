"""Composable DataFrame operators: distributed ranking, drift tests, prep, features, training, evaluation, run history."""
