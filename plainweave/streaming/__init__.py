"""The stateless column expressions on streams."""
