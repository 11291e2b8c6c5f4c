"""Composed jobs: silver (cleaning), gold (star schema), marts (reports), measures."""
