"""Operators for preparing the training data of language models; nothing else in the library imports them."""
