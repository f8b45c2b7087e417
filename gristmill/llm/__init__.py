"""Operators for building training corpora; each module holds one operator, ``queries`` registers them."""
