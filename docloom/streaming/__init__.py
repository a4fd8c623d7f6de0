"""The page stages on streams, an extension."""
