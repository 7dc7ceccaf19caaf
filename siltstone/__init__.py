"""Siltstone: curation, validation, splitting and scoring of training data as Spark plans."""
