"""Relational operators: DataFrame -> DataFrame functions composed lazily by the plans."""
