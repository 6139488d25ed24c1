"""Composites: the de-duplicating load, its state, synthetic tables, replay, model fitting."""
