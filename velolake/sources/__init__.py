"""Sources: message envelopes, table scans and payloads derived from driver tables."""
