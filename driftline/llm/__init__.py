"""Operators for preparing language-model training text.

One module per operator (``secrets``, ``quality``, ``neardup``, ``decontam``,
``bpe``, ``arc``, ``omh``, ``token_counts``, ``substring``, ``sharding``);
``queries`` registers one query per operator over the driver tables.
"""
