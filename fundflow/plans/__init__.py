"""Whole tables and the run over all layers."""
