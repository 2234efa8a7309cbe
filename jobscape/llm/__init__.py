"""Operators of a training-data pipeline; each module states its method and its rules for odd rows."""
