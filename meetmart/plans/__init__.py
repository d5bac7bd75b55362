"""Jobs that put sources, operators and sinks together."""
