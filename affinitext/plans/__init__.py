"""Compositions of operators: preparing a corpus, searching it, evaluating models."""
