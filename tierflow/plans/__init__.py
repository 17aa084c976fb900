"""Logical plans: domain frames, the layered model, the semantic layer."""
