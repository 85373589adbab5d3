"""The daily batch and the realtime refresh, layer by layer with quality gates."""
