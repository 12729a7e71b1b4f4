"""Listening and weather mood analytics as composable Spark DataFrame functions."""
