"""Relational operators on the transaction relation: DataFrame in, DataFrame out."""
