"""Layers put together from the operators, and the run over all of them."""
