"""DataFrame -> DataFrame operators without side effects."""
