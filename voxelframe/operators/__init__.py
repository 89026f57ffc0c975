"""Relational, signal and modelling operators."""
