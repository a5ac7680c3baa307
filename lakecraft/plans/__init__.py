"""Whole plans: the pipeline of layers and the registered queries."""
