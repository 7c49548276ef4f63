"""Structured Streaming runners: file drops -> landing -> bronze, incremental
type-1 / type-2 merges, and complete-mode profiles."""
