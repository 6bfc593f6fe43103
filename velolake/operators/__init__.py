"""Layer operators: pure DataFrame -> DataFrame transforms (batch and streaming)."""
