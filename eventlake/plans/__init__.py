"""Models and the jobs that put sources, operators and sinks together."""
