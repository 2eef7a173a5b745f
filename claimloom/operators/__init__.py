"""Distributed building blocks: joins, ordinals, order statistics, mapping, validation."""
