"""Column-level building blocks: text keys, time parsing, banded rules."""
