"""Reading, writing and registering tables. All side effects of the package live here and in streaming."""
