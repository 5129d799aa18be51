"""The operators on streams: watermarks, state and once-only messages."""
